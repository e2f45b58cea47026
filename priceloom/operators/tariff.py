"""Tariffs of a page: header roles, price buckets, acceptance and labels, for two kinds of pages."""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.html import page_text, parse_pages, piece_text
from ..functions.money import range_of, scan_money
from ..functions.text import bind, fold

ROLES = ("kurum", "kamu", "sivil")
YEAR = "2026"
FLAGS = "(?iuU)"


@dataclass(frozen=True)
class Profile:
    """Fixed values of a kind of pages: least and top price of a room, least highest price, prices a role needs, words that rule out."""

    name: str
    floor: float
    top: float
    highest: float
    needed: int
    labels: tuple
    tables: tuple = ()


PROBE = Profile("probe", 300.0, 25000.0, 600.0, 1, ("ek yatak", "toplantı", "toplanti", "kart", "kahvaltı ayrı"))
SCAN = Profile(
    "scan", 400.0, 25000.0, 900.0, 2,
    ("ek yatak", "oda kart", "kayıp kart", "kayip kart", "manyetik", "çamaşır", "camasir", "ütü", "utu", "kahvaltı", "kahvalti", "saç", "sac ", "fön", "fon ", "ağda", "agda", "makyaj", "perma", "röfle", "rofle", "tabldot", "çorba", "corba"),
    ("kuaför", "kuafor", "çamaşır", "camasir", "yemek list", "tabldot", "salon fiyat"),
)

#: Patterns of header cells.
COMPOUND = r"[üu]ye\s*/\s*(kamu|öğretmen|ogretmen)|uye\s*/\s*"
MEMBER, MEMBER_STRICT = r"meb|öğretmen|ogretmen|[üu]ye", r"meb|öğretmen|[üu]ye"
CIVILIAN = r"sivil|diğer|diger|öğrenci|ogrenci"
SCAN_HINTS = {"kurum": r"te[şs]kilat|emniyet\s*mensub|%?\s*30\s*indirim", "kamu": r"kamu\s*(personel|mensub)|konaklama\s*[üu]cret[iı]?", "sivil": r"onayl[ıi]\s*misafir|yabanc[ıi]\s*(misafir|konuk)|onayl[ıi]\s*veya"}


def _like(c: Column, pattern: str) -> Column:
    return c.rlike(FLAGS + pattern)


def _places(cells: Column, test) -> Column:
    """Indexes from 0 of the cells that pass."""
    return F.filter(F.transform(cells, lambda c, i: F.when(test(F.trim(c)), i)), lambda i: i.isNotNull())


def roles_probe(cells: Column) -> Column:
    """struct(kurum, kamu, sivil) of column indexes, or null: a member/public compound cell rules, else the first fitting cell."""
    compound = lambda c: _like(c, COMPOUND)
    both = _places(cells, compound)
    public = _places(cells, lambda c: compound(c) & _like(c, "kamu"))
    member = _places(cells, lambda c: ~compound(c) & _like(c, MEMBER))
    kamu = _places(cells, lambda c: ~compound(c) & _like(c, "kamu") & ~_like(c, MEMBER_STRICT))
    sivil = _places(cells, lambda c: ~compound(c) & _like(c, CIVILIAN))
    made = F.struct(F.coalesce(F.array_max(both), F.array_min(member)).alias("kurum"), F.coalesce(F.array_max(public), F.array_min(kamu)).alias("kamu"), F.array_min(sivil).alias("sivil"))
    two = lambda r: (r["kurum"].isNotNull() & (r["sivil"].isNotNull() | r["kamu"].isNotNull())) | (r["kamu"].isNotNull() & r["sivil"].isNotNull())
    return bind(made, lambda r: F.when(two(r), r))


def roles_scan(cells: Column) -> Column:
    """struct(kurum, kamu, sivil) of the first fitting cells, or null without kurum and sivil."""
    made = F.struct(*[F.array_min(_places(cells, lambda c, p=SCAN_HINTS[r]: _like(c, p))).alias(r) for r in ROLES])
    return bind(made, lambda r: F.when(r["kurum"].isNotNull() & r["sivil"].isNotNull(), r))


def pick(prices: Column, profile: Profile) -> Column:
    """A cell's price: the first (probe); the last of three or more (fee, tax, total), else the highest (scan)."""
    if profile.name == "probe":
        return F.get(prices, F.lit(0))
    return F.when(F.size(prices) >= 3, F.element_at(prices, -1)).otherwise(F.array_max(prices))


def table_prices(parsed: Column, profile: Profile) -> Column:
    """struct(kurum, kamu, sivil) of the arrays of room prices in all tables of a page of parse_pages; null for a null page.

    A table's header is the first of its first five rows whose cells give roles; rows after it count whose first cell has none of
    the profile's words. A table's rows are those of tables within it too. All of it is narrow, arrays of the page's own row: no shuffle,
    and each cell's text is made once, tables and rows being ranges of cells.
    """
    roles = roles_probe if profile.name == "probe" else roles_scan
    words, others = "|".join(map(re.escape, profile.labels)), "|".join(map(re.escape, profile.tables))
    texts = lambda spans: F.transform(spans, lambda s: piece_text(parsed["pieces"], s))
    size = lambda row: row["last"] - row["first"]

    def of_page(cells: Column) -> Column:
        def of_table(table: Column) -> Column:
            rows = F.slice(parsed["rows"], table["first_row"] + 1, table["last_row"] - table["first_row"])
            return bind(rows, lambda rows: F.when((F.size(rows) >= 2) & ~ruled_out(table), below(rows)))

        def ruled_out(table: Column) -> Column:
            if not others:
                return F.lit(False)
            heads = F.slice(parsed["heads"], table["first_head"] + 1, F.least(table["last_head"] - table["first_head"], F.lit(8)))
            return fold(F.array_join(texts(heads), " ")).rlike(others)

        def below(rows: Column) -> Column:
            told = F.transform(F.slice(rows, 1, 5), lambda r, i: F.struct(i.alias("at"), roles(F.slice(cells, r["first"] + 1, size(r))).alias("roles")))
            head = F.get(F.filter(told, lambda h: h["roles"].isNotNull()), F.lit(0))

            def kept(first: Column) -> Column:
                named = F.filter(rows, lambda r, i: (i > first["at"]) & (size(r) >= 2) & ~F.coalesce(fold(F.get(cells, r["first"])).rlike(words), F.lit(False)))
                return F.when(first.isNotNull(), F.struct(first["roles"].alias("roles"), named.alias("rows")))

            return bind(head, kept)

        def prices(tables: Column, role: str) -> Column:
            cell = lambda t, r: F.when(t["roles"][role] < size(r), F.get(cells, r["first"] + t["roles"][role]))
            asked = F.flatten(F.transform(tables, lambda t: F.transform(t["rows"], lambda r: cell(t, r))))
            picked = F.transform(asked, lambda c: bind(scan_money(c), lambda found: pick(found, profile)))
            return F.filter(picked, lambda p: p.between(profile.floor, profile.top)).alias(role)

        found = F.filter(F.transform(parsed["tables"], of_table), lambda t: t.isNotNull())
        return bind(found, lambda tables: F.struct(*[prices(tables, r) for r in ROLES]))

    return bind(texts(parsed["cells"]), of_page)


def accepted(prices: Column, profile: Profile) -> Column:
    """Whether buckets are plausible: a price high enough (probe); two prices for kurum and sivil, a high sivil, kurum below it (scan)."""
    if profile.name == "probe":
        top = F.array_max(F.flatten(F.array(*[prices[r] for r in ROLES])))
        return F.coalesce(top, F.lit(0.0)) >= profile.highest
    kurum, sivil = prices["kurum"], prices["sivil"]
    return F.coalesce((F.size(kurum) >= profile.needed) & (F.size(sivil) >= profile.needed) & (F.array_max(sivil) >= profile.highest) & (F.array_min(kurum) < F.array_max(sivil)), F.lit(False))


#: Labels by the first pattern found, in the order of each path.
DEFAULT_LABEL = "2026 yılı (sayfada yayımlanan liste)"
VALIDITY = {
    "probe": ((r"01[./.]01[./.]2026|1\s*ocak\s*2026", "01.01.2026 itibarıyla"), (r"02\s*[şs]ubat\s*2026|02[./.]02[./.]2026", "02 Şubat 2026 – 30 Haziran 2026"), (r"1\s*temmuz\s*2026|01[./.]07[./.]2026", "1 Temmuz 2026 itibarıyla")),
    "scan": ((r"01[./.]05[./.]2026", "01.05.2026 itibarıyla"), (r"19[./.]01[./.]2026", "19.01.2026 itibarıyla")),
    "stacked": ((r"19[./.]01[./.]2026", "19.01.2026 itibarıyla"), (r"01[./.]05[./.]2026", "01.05.2026 itibarıyla")),
}
TAX = ((r"%\s*2\s*konaklama\s*vergisi\s*(dahil|DAHİL)", " (%2 konaklama vergisi dahil)"), (r"%\s*1\s*konaklama\s*vergisi\s*(dahil|DAHİL)", " (%1 konaklama vergisi dahil)"), (r"vergisi\s*HAR[İI][ÇC]|vergisi\s*hari[çc]", " (sayfada vergi HARİÇ belirtilmiş olabilir)"))


def _first(text: Column, cases: tuple, other: str) -> Column:
    return F.coalesce(*[F.when(_like(text, p), F.lit(label)) for p, label in cases], F.lit(other))


def validity(text: Column, path: str) -> Column:
    return _first(text, VALIDITY[path], DEFAULT_LABEL)


def tax_note(text: Column) -> Column:
    return _first(text, TAX, "")


#: Words on lodging, and of averages and estimates; names of rooms, of other things, and of guests.
TOPIC, GUESS = r"konaklama|oda|fiyat|ücret|ucret", r"ortalama\s*(öğretmenevi|ogretmenevi)|tahmini\s*aral"
ROOM, OTHER = r"oda|yatak|suit|süit|su[iı]t|vip|aile|double|m[uü]stakil", r"ek yatak|çamaşır|camasir|[uü]t[uü]|oda kart|kahvalt"
GUEST = r"onayl[ıi]|misafir"


def gates_probe(html: Column, text: Column, year: str = YEAR, topic: str = TOPIC, guess: str = GUESS) -> Column:
    """The year in source and text, a word on lodging, and no averages or estimates."""
    return html.contains(year) & text.contains(year) & _like(text, topic) & ~_like(text, guess)


def parse_of_year(pages: DataFrame, profile: Profile) -> DataFrame:
    """parse_pages with html_year: whether the source has the year. Pages without it needn't be parsed for the probe."""
    marked = pages.withColumn("html_year", F.coalesce(F.col("html").contains(YEAR), F.lit(False)))
    return parse_pages(marked.where("html_year") if profile.name == "probe" else marked)


def text_lines(text: Column) -> Column:
    """The lines of a text, where an amount with a currency mark ends one; texts of under eight such lines are cut at wide gaps instead."""
    lines = lambda x, cut: F.filter(F.transform(F.split(x, FLAGS + cut), lambda y: F.regexp_replace(y, r"(?U)^\s+|\s+$", "")), lambda y: y != "")
    by_mark = lines(F.regexp_replace(text, FLAGS + r"(?<=\d)\s*(TL\b|₺)", " $1\n"), r"[\n\r]+")
    return bind(by_mark, lambda x: F.when(F.size(x) >= 8, x).otherwise(lines(text, r"\s{2,}|\n")))


def stacked_of(text: Column) -> Column:
    """struct(kurum, kamu, sivil) of price arrays of a text without tables.

    A line that names a room and has no amount opens a section, which ends before the next such line. Of a section the first three
    lines with amounts count if they are room prices that don't fall and rise to five times the first at most; from the sixth line
    of the section on, a line without an amount before the third price ends it. All of it is narrow: arrays of the text's own row.
    Texts without the year, a word on members and one on guests have empty buckets, as null texts do.
    """

    def line(x: Column, i: Column) -> Column:
        price = bind(F.when(x.rlike("[0-9]"), scan_money(x)), lambda found: pick_line(found))
        return bind(price, lambda v: F.struct(i.alias("i"), v.alias("v"), (v.isNull() & _like(x, ROOM)).alias("head"), (v.isNull() & _like(x, OTHER)).alias("other")))

    def triples(rows: Column) -> Column:
        heads = F.filter(rows, lambda r: r["head"])
        ends = F.transform(heads, lambda h, k: F.coalesce(F.get(heads, k + 1)["i"], F.size(rows)))
        sections = F.filter(F.arrays_zip(heads.alias("head"), ends.alias("end")), lambda s: ~s["head"]["other"])

        def three(s: Column) -> Column:
            first = s["head"]["i"]
            inside = F.slice(rows, first + 2, s["end"] - first - 1)
            found = F.slice(F.filter(inside, lambda r: r["v"].isNotNull()), 1, 3)
            gaps = lambda last: F.exists(inside, lambda r: r["v"].isNull() & (r["i"] - first >= 6) & (r["i"] < last))

            def good(f: Column) -> Column:
                a, b, c = (F.get(f, F.lit(k))["v"] for k in range(3))
                fits = F.forall(f, lambda r: r["v"].between(SCAN.floor, SCAN.top)) & (a <= b) & (b <= c) & (c <= 5 * a)
                return F.when((F.size(f) == 3) & fits & ~gaps(F.get(f, F.lit(2))["i"]), F.transform(f, lambda r: r["v"]))

            return bind(found, good)

        return F.filter(F.transform(sections, three), lambda t: t.isNotNull())

    def of_text(value: Column) -> Column:
        wanted = value.contains(YEAR) & _like(value, SCAN_HINTS["kurum"]) & (_like(value, SCAN_HINTS["sivil"]) | _like(value, GUEST))
        return F.when(wanted, bind(F.transform(text_lines(value), line), triples))

    # Bound, since the text may itself be an expression, which would be computed wherever it stands.
    made = bind(text, of_text)
    return bind(made, lambda t: F.struct(*[F.coalesce(F.transform(t, lambda x: F.get(x, F.lit(k))), F.array().cast("array<double>")).alias(r) for k, r in enumerate(ROLES)]))


def stacked_prices(df: DataFrame, text: str = "text") -> DataFrame:
    """df with stacked: stacked_of the text column."""
    return df.withColumn("stacked", stacked_of(F.col(text)))


def pick_line(found: Column) -> Column:
    """A line's price: the last of three or more amounts, else the first."""
    return F.when(F.size(found) >= 3, F.element_at(found, -1)).otherwise(F.get(found, F.lit(0)))


def bucket_stats(prices: Column) -> Column:
    """struct(counts, mins, maxs) of a page's buckets, each a struct by role; null where a bucket is empty, but for counts."""
    by_role = lambda f: F.struct(*[f(prices[r]).alias(r) for r in ROLES])
    return F.struct(by_role(F.size).alias("counts"), by_role(F.array_min).alias("mins"), by_role(F.array_max).alias("maxs"))


def price_stats(df: DataFrame, keys: list[str], price: str, profile: Profile) -> DataFrame:
    """keys, n, lowest, highest and any_high of the room prices of each group, of groups that have one high enough; others are left out."""
    kept = df.where(F.col(price).between(profile.floor, profile.top)).groupBy(*keys)
    made = kept.agg(F.count("*").alias("n"), F.min(price).alias("lowest"), F.max(price).alias("highest"), F.bool_or(F.col(price) >= profile.highest).alias("any_high"))
    return made.where(F.col("highest") >= profile.highest)


def entries(parsed: DataFrame, profile: Profile, url: str = "url", keep: tuple = ()) -> DataFrame:
    """url, three price ranges, kaynak and gecerlilik of accepted pages, and of keep "stats" (bucket_stats) and columns of parsed.

    parsed comes from parse_of_year, or from parse_pages over pages with the year.

    scan: where tables give fewer than two prices for kurum or sivil, the stacked lines of the text count instead.

    All of a page is one expression, whose parts are bound, and a page without an entry generates no row: were the entries filtered
    instead, Catalyst would put the filter below and compute the prices once for each place that they stand at.
    """
    named = {"fiyat_sivil": "sivil", "fiyat_kamu_personeli": "kamu", "fiyat_kurum_personeli": "kurum"}
    year = F.col("html_year") if "html_year" in parsed.columns else F.lit(True)

    def row(prices: Column, label: Column) -> Column:
        ranges = [range_of(prices[r]).alias(n) for n, r in named.items()]
        made = F.struct(*ranges, F.col(url).alias("kaynak"), label.alias("gecerlilik"), *[bucket_stats(prices).alias("stats")] * ("stats" in keep))
        return F.when(accepted(prices, profile), F.array(made))

    def of_text(text: Column) -> Column:
        tables = table_prices(F.col("parsed"), profile)
        if profile.name == "probe":
            return F.when(year & gates_probe(F.lit(YEAR), text), bind(tables, lambda prices: row(prices, validity(text, "probe"))))

        def of_tables(prices: Column) -> Column:
            thin = (F.size(prices["kurum"]) < profile.needed) | (F.size(prices["sivil"]) < profile.needed)
            lines = bind(stacked_of(text), lambda stacked: row(stacked, validity(text, "stacked")))
            return F.when(thin, lines).otherwise(row(prices, F.concat(validity(text, "scan"), tax_note(text))))

        return F.when(year | text.contains(YEAR), bind(tables, of_tables))

    found = F.inline(bind(page_text(F.col("parsed")), of_text))
    rows = parsed.select(url, *[c for c in keep if c != "stats"], found)
    return rows.select(url, *named, "kaynak", "gecerlilik", *keep)
