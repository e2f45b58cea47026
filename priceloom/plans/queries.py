"""Registered queries over the driver's tables, each with SQL that says the same."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import html, money, text, urls
from ..operators import frontier, match, runs, search, tariff, upsert
from ..sources import documents
from ..streaming import buckets

QUERIES: dict = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            SQL[f.__name__] = sql
        return f

    return add


def _t(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _turkish(amount):
    """1.234,56 TL"""
    return F.concat(F.translate(F.format_number(amount, 2), ",.", ".,"), F.lit(" TL"))


#: Shared SQL: amounts of a text, parsed as Turkish notation with dots between thousands.
_SCAN = r"list_transform(regexp_extract_all({0}, '(?:₺|TL)?\s*(\d{{1,3}}(?:[.\s]\d{{3}})*(?:[.,]\d{{1,2}})?|\d+(?:[.,]\d{{1,2}})?)\s*(?:₺|TL)?', 1, 'i'), lambda x: TRY_CAST(replace(replace(replace(x, ' ', ''), '.', ''), ',', '.') AS DOUBLE))"
_TL = "translate(format('{{:,}}', round_even({0}, 0)::BIGINT), ',', '.')"
_RANGE = "CASE WHEN {1} - {0} < 0.5 THEN " + _TL.format("{0}") + " || ' TL' ELSE " + _TL.format("{0}") + " || ' – ' || " + _TL.format("{1}") + " || ' TL' END"
_NORM = "regexp_replace(translate(replace(lower(coalesce({0}, '')), 'ß', 'ss'), 'çğıöşü', 'cgiosu'), '[^a-z0-9]+', '', 'g')"


def _fill(form: str, *parts: str) -> str:
    for i, p in enumerate(parts):
        form = form.replace("{%d}" % i, p)
    return form.replace("{{", "{").replace("}}", "}")


@query(f"""
WITH said AS (SELECT o_orderpriority, translate(format('{{:,.2f}}', o_totalprice), ',.', '.,') || ' TL' AS said FROM orders),
prices AS (SELECT o_orderpriority, unnest({_fill(_SCAN, 'said')}) AS v FROM said)
SELECT o_orderpriority, count(*) AS n_prices, {_fill(_RANGE, 'min(v)', 'max(v)')} AS price_range FROM prices WHERE v BETWEEN 300 AND 25000 GROUP BY 1""")
def tariff_range_by_priority(spark, sf_dir):
    """Order totals rendered in Turkish notation, read back, held to room prices, and given as a range by priority."""
    said = _t(spark, sf_dir, "orders").select("o_orderpriority", F.explode(money.scan_money(_turkish(F.col("o_totalprice")))).alias("v"))
    kept = said.where(F.col("v").between(tariff.PROBE.floor, tariff.PROBE.top))
    return kept.groupBy("o_orderpriority").agg(F.count("*").alias("n_prices"), money.format_range(F.min("v"), F.max("v")).alias("price_range")).orderBy("o_orderpriority")


_CENTS = "round(o_totalprice * 100)::BIGINT % 20000000"


@query(f"""
WITH o AS (SELECT o_orderkey, o_orderkey % 8 AS kind, {_CENTS} AS c FROM orders),
n AS (SELECT *, c // 100 AS whole, lpad((c % 100)::VARCHAR, 2, '0') AS part, format('{{:,}}', c // 100) AS grouped FROM o),
t AS (SELECT o_orderkey, CASE kind WHEN 0 THEN replace(grouped, ',', '.') || ',' || part WHEN 1 THEN grouped || '.' || part WHEN 2 THEN whole || ',' || part WHEN 3 THEN replace(grouped, ',', '.')
  WHEN 4 THEN ' ' || replace(grouped, ',', ' ') || ' TL ' WHEN 5 THEN '₺' || replace(grouped, ',', '.') || ',' || part[1] WHEN 6 THEN 'abc' || whole ELSE whole || '.' || part END AS token,
  CASE WHEN kind IN (3, 4) THEN whole::DOUBLE WHEN kind = 5 THEN (c // 10) / 10 WHEN kind < 6 OR kind = 7 THEN c / 100 END AS v FROM n)
SELECT o_orderkey, token, CASE WHEN v BETWEEN 1 AND 100000 THEN v END AS amount FROM t""")
def money_parse_cases(spark, sf_dir):
    """Order totals in eight notations, parsed."""
    cents = F.round(F.col("o_totalprice") * 100).cast("long") % 20_000_000
    o = _t(spark, sf_dir, "orders").select("o_orderkey", (F.col("o_orderkey") % 8).alias("kind"), cents.alias("c"))
    whole, part, grouped = F.expr("c div 100"), F.lpad((F.col("c") % 100).cast("string"), 2, "0"), F.format_number(F.expr("c div 100"), 0)
    dotted = F.replace(grouped, F.lit(","), F.lit("."))
    forms = [F.concat(dotted, F.lit(","), part), F.concat(grouped, F.lit("."), part), F.concat(whole, F.lit(","), part), dotted, F.concat(F.lit(" "), F.replace(grouped, F.lit(","), F.lit(" ")), F.lit(" TL ")), F.concat(F.lit("₺"), dotted, F.lit(","), F.substring(part, 1, 1)), F.concat(F.lit("abc"), whole), F.concat(whole, F.lit("."), part)]
    return o.select("o_orderkey", F.element_at(F.array(*forms), (F.col("kind") + 1).cast("int")).alias("token")).withColumn("amount", money.parse_money(F.col("token")))


@query(rf"""
WITH said AS (SELECT o_orderkey, translate(format('{{:,.2f}}', o_totalprice), ',.', '.,') || ' TL' AS grouped, round_even(o_totalprice, 0)::BIGINT || ' TL' AS plain FROM orders)
SELECT o_orderkey, list_sum(list_filter({_fill(_SCAN, 'grouped')}, lambda v: v BETWEEN 1 AND 100000)) AS grouped_sum,
       len(list_filter({_fill(_SCAN, 'plain')}, lambda v: v BETWEEN 1 AND 100000))::INT AS plain_found FROM said""")
def money_scan_totals(spark, sf_dir):
    """Grouped numbers are read whole; ungrouped ones are cut after three digits."""
    orders = documents.spread(_t(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice"))
    plain = F.concat(F.translate(F.format_number("o_totalprice", 0), ",", ""), F.lit(" TL"))
    total = lambda a: F.when(F.size(a) > 0, F.aggregate(a, F.lit(0.0), lambda x, y: x + y))
    return orders.select("o_orderkey", total(money.scan_money(_turkish(F.col("o_totalprice")))).alias("grouped_sum"), F.size(money.scan_money(plain)).alias("plain_found"))


@query(f"SELECT o_orderpriority, o_orderstatus, {_fill(_RANGE, 'min(o_totalprice)', 'max(o_totalprice)')} AS price_range, {_fill(_TL, 'min(o_totalprice)')} AS lowest FROM orders GROUP BY 1, 2")
def range_format_orders(spark, sf_dir):
    orders = _t(spark, sf_dir, "orders").groupBy("o_orderpriority", "o_orderstatus").agg(F.min("o_totalprice").alias("a"), F.max("o_totalprice").alias("b"))
    return orders.select("o_orderpriority", "o_orderstatus", money.format_range(F.col("a"), F.col("b")).alias("price_range"), money.format_tl(F.col("a")).alias("lowest"))


@query(f"SELECT 'n' || n_nationkey AS id, {_fill(_NORM, 'n_name')} AS norm FROM nation UNION ALL SELECT 'c' || c_custkey, {_fill(_NORM, 'c_name')} FROM customer UNION ALL SELECT 'd' || doc_id, {_fill(_NORM, 'text')} FROM documents")
def norm_names(spark, sf_dir):
    parts = [("n", "nation", "n_nationkey", F.col("n_name")), ("c", "customer", "c_custkey", F.col("c_name")), ("d", "documents", "doc_id", F.col("text"))]
    made = [documents.spread(_t(spark, sf_dir, t).select(k, c)).select(F.concat(F.lit(p), F.col(k)).alias("id"), text.norm_name(c).alias("norm")) for p, t, k, c in parts]
    return made[0].unionByName(made[1]).unionByName(made[2])


@query(f"SELECT doc_id, {_fill(_NORM, 'text')} AS norm FROM documents")
def norm_texts(spark, sf_dir):
    """The documents' part of norm_names by itself."""
    return _t(spark, sf_dir, "documents").select("doc_id", text.norm_name(F.col("text")).alias("norm"))


_NAMES = ("Çorum", "Şırnak", "İzmir", "Yeni Şehir", "Bolu", "Iğdır")
_SLUGS = ("corum", "sirnak", "izmir", "yenisehir", "bolu", "igdir")


@query("SELECT n_nationkey, il, slug FROM nation, (VALUES " + ", ".join(f"('{a}', '{b}')" for a, b in zip(_NAMES, _SLUGS)) + ") v(il, slug) UNION ALL SELECT n_nationkey, n_name, replace(lower(n_name), ' ', '') FROM nation")
def slug_lookup_fallback(spark, sf_dir):
    nation = _t(spark, sf_dir, "nation")
    names = spark.createDataFrame([(n,) for n in _NAMES], "il string")
    both = nation.select("n_nationkey").join(F.broadcast(names)).unionByName(nation.select("n_nationkey", F.col("n_name").alias("il")))
    return both.select("n_nationkey", "il", text.province_slug(F.col("il")).alias("slug"))


#: Header cells, and whether each is a compound of members and public, with public, of members, public, civilian; and of the scan's three roles.
_CELLS = (
    ("Oda Tipi", 0, 0, 0, 0, 0, 0, 0, 0), ("Üye / Öğretmen", 1, 0, 0, 0, 0, 0, 0, 0), ("Üye/Kamu", 1, 1, 0, 0, 0, 0, 0, 0), ("MEB", 0, 0, 1, 0, 0, 0, 0, 0), ("Kamu", 0, 0, 0, 1, 0, 0, 0, 0), ("SİVİL", 0, 0, 0, 0, 1, 0, 0, 0), ("Diğer", 0, 0, 0, 0, 1, 0, 0, 0),
    (" Teşkilat Mensubu", 0, 0, 0, 0, 0, 1, 0, 0), ("Kamu Personeli", 0, 0, 0, 1, 0, 0, 1, 0), ("Onaylı Misafir", 0, 0, 0, 0, 0, 0, 0, 1), ("Konaklama Ücreti", 0, 0, 0, 0, 0, 0, 1, 0), ("%30 indirim", 0, 0, 0, 0, 0, 1, 0, 0), ("", 0, 0, 0, 0, 0, 0, 0, 0),
)


@query(f"""
WITH cells(n, said, compound, public, member, kamu, sivil, s_kurum, s_kamu, s_sivil) AS (VALUES {", ".join(str((n, *c)) for n, c in enumerate(_CELLS))}),
placed AS (SELECT o_orderkey, i, c.* FROM orders, range(5) r(i), cells c WHERE c.n = (o_orderkey * (i + 1) + o_custkey * i) % {len(_CELLS)}),
found AS (SELECT o_orderkey, coalesce(max(i) FILTER (compound = 1), min(i) FILTER (member = 1)) AS pk, coalesce(max(i) FILTER (public = 1), min(i) FILTER (kamu = 1)) AS pp, min(i) FILTER (sivil = 1) AS ps,
  min(i) FILTER (s_kurum = 1) AS sk, min(i) FILTER (s_kamu = 1) AS sp, min(i) FILTER (s_sivil = 1) AS ss FROM placed GROUP BY o_orderkey)
SELECT o_orderkey, 'probe' AS profile, pk::INT AS kurum, pp::INT AS kamu, ps::INT AS sivil FROM found WHERE (pk IS NOT NULL AND (ps IS NOT NULL OR pp IS NOT NULL)) OR (pp IS NOT NULL AND ps IS NOT NULL)
UNION ALL SELECT o_orderkey, 'scan', sk::INT, sp::INT, ss::INT FROM found WHERE sk IS NOT NULL AND ss IS NOT NULL""")
def role_header(spark, sf_dir):
    """A header of five cells for each order, picked by its keys, and the roles that both kinds of pages find in it."""
    said = F.lit([c[0] for c in _CELLS])
    cells = F.transform(F.sequence(F.lit(0), F.lit(4)), lambda i: F.get(said, ((F.col("o_orderkey") * (i + 1) + F.col("o_custkey") * i) % len(_CELLS)).cast("int")))
    o = _t(spark, sf_dir, "orders").select("o_orderkey", cells.alias("cells"))
    found = [o.select("o_orderkey", F.lit(name).alias("profile"), roles(F.col("cells")).alias("r")) for name, roles in (("probe", tariff.roles_probe), ("scan", tariff.roles_scan))]
    return found[0].unionByName(found[1]).where("r IS NOT NULL").select("o_orderkey", "profile", "r.kurum", "r.kamu", "r.sivil")


_MONTHS = ("Ocak", "ŞUBAT", "mart", "nisan", "mayıs", "haziran", "Temmuz", "ağustos", "eylül", "ekim", "kasım", "aralık")
_TAXES = (("", ""), ("% 2 konaklama vergisi dahil", " (%2 konaklama vergisi dahil)"), ("%1 Konaklama Vergisi Dahil", " (%1 konaklama vergisi dahil)"), ("konaklama vergisi hariç", " (sayfada vergi HARİÇ belirtilmiş olabilir)"), ("% 3 konaklama vergisi dahil", ""))


@query(f"""
WITH o AS (SELECT o_orderkey, day(o_orderdate) AS d, month(o_orderdate) AS m, o_orderkey % 3 AS form FROM orders)
SELECT o_orderkey, CASE WHEN form < 2 AND d = 1 AND m = 1 OR form = 2 AND d % 10 = 1 AND m = 1 THEN '01.01.2026 itibarıyla' WHEN d = 2 AND m = 2 THEN '02 Şubat 2026 – 30 Haziran 2026'
  WHEN form < 2 AND d = 1 AND m = 7 OR form = 2 AND d % 10 = 1 AND m = 7 THEN '1 Temmuz 2026 itibarıyla' ELSE '{tariff.DEFAULT_LABEL}' END AS probe_label,
  CASE WHEN form < 2 AND d = 1 AND m = 5 THEN '01.05.2026 itibarıyla' WHEN form < 2 AND d = 19 AND m = 1 THEN '19.01.2026 itibarıyla' ELSE '{tariff.DEFAULT_LABEL}' END AS scan_label,
  [{", ".join(repr(t) for _, t in _TAXES)}][o_orderkey % 5 + 1] AS tax FROM o""")
def validity_label(spark, sf_dir):
    """Order dates as said on pages, moved to the year, in three forms and with notes on taxes; the labels that they give."""
    day = F.date_format("o_orderdate", "dd")
    name = F.get(F.lit(list(_MONTHS)), F.month("o_orderdate") - 1)
    form = F.element_at(F.array(F.concat(day, F.date_format("o_orderdate", ".MM.")), F.concat(day, F.date_format("o_orderdate", "/MM/")), F.concat(day, F.lit(" "), name, F.lit(" "))), (F.col("o_orderkey") % 3 + 1).cast("int"))
    tax = F.get(F.lit([t for t, _ in _TAXES]), (F.col("o_orderkey") % 5).cast("int"))
    said = _t(spark, sf_dir, "orders").select("o_orderkey", F.concat(F.lit("Liste "), form, F.lit("2026, "), tax).alias("said"))
    c = F.col("said")
    return said.select("o_orderkey", tariff.validity(c, "probe").alias("probe_label"), tariff.validity(c, "scan").alias("scan_label"), tariff.tax_note(c).alias("tax"))


_BARE = r"trim(regexp_replace(regexp_replace(regexp_replace(html, '(?is)<script.*?</script>|<style.*?</style>|<!--.*?-->', ' ', 'g'), '(?s)<[^>]*>', ' ', 'g'), '\s+', ' ', 'g'))"


@query(rf"SELECT page_id, trim(regexp_extract(html, '(?is)<title[^>]*>(.*?)</title>', 1)) AS title, length({_BARE}) AS n_text FROM pages")
def page_title_text(spark, sf_dir):
    return _t(spark, sf_dir, "pages").select("page_id", html.title_of(F.col("html")).alias("title"), F.length(html.text_of(F.col("html"))).cast("long").alias("n_text"))


@query(r"""
WITH found AS (SELECT page_id, regexp_extract(url, '^(https?://[^/]+)', 1) AS site, unnest(h) AS href, unnest(range(len(h))) AS place
               FROM (SELECT page_id, url, regexp_extract_all(html, '(?is)<a\s[^>]*href="(/[^"]*)"', 1) AS h FROM pages)),
 kept AS (SELECT page_id, site || split_part(href, '#', 1) AS link, min(place) AS place FROM found GROUP BY ALL)
SELECT page_id, link, rank::INT AS rank FROM (SELECT page_id, link, row_number() OVER (PARTITION BY page_id ORDER BY place) AS rank FROM kept) WHERE rank <= 40""")
def page_links_topk(spark, sf_dir):
    """Root-relative links of each page from the parser, absolute, without fragments and repeats, in order, the first 40."""
    parsed = html.parse_pages(_t(spark, sf_dir, "pages").select("page_id", "url", "html"))
    return urls.page_links(parsed, "page_id", lambda href, text, link: href.startswith("/"))


@query(r"""
WITH found AS (SELECT page_id, regexp_extract(url, '^(https?://[^/]+)', 1) AS site, unnest(h) AS a, unnest(range(len(h))) AS place
               FROM (SELECT page_id, url, regexp_extract_all(html, '(?is)<a\s[^>]*href="/[^"]*"[^>]*>[^<]*</a>') AS h FROM pages)),
 cut AS (SELECT page_id, site, place, regexp_extract(a, 'href="([^"]*)"', 1) AS href, trim(regexp_extract(a, '>([^<]*)<', 1)) AS said FROM found),
 kept AS (SELECT page_id, site || split_part(href, '#', 1) AS link, min(place) AS place FROM cut WHERE site LIKE '%example.com' AND regexp_matches(lower(href || ' ' || said), 'th|fiyat') GROUP BY ALL)
SELECT page_id, link, (row_number() OVER (PARTITION BY page_id ORDER BY place))::INT AS rank FROM kept QUALIFY rank <= 40""")
def page_links_gate(spark, sf_dir):
    """Links whose address or text has one of two words and whose host is in a domain, absolute, in order."""
    parsed = html.parse_pages(_t(spark, sf_dir, "pages").select("page_id", "url", "html"))
    return urls.page_links(parsed, "page_id", lambda href, text, link: urls.link_wanted(href, text, link, ("th", "fiyat"), "example.com"))


@query(r"""
WITH p AS (SELECT page_id, html, regexp_extract(url, '^[a-z]+://([^/?#]*)', 1) AS netloc FROM pages)
SELECT page_id, netloc, replace(replace(replace(lower(netloc), 'www.', ''), 'ogretmenevi.com.tr', ''), '.com.tr', '') AS core, netloc LIKE '%.org' AS in_domain,
       regexp_matches(html, '(?i)copyright|privacy') AND NOT regexp_matches(html, '(?i)average') AS gate FROM p""")
def page_hosts_gates(spark, sf_dir):
    u, h = F.col("url"), F.col("html")
    return _t(spark, sf_dir, "pages").select("page_id", urls.netloc(u).alias("netloc"), urls.host_core(u).alias("core"), urls.netloc(u).endswith(".org").alias("in_domain"), tariff.gates_probe(h, h, "", "copyright|privacy", "average").alias("gate"))


@query(f"""
WITH n AS (SELECT n_nationkey, {_fill(_NORM, 'n_name')} AS core, replace(lower(n_name), ' ', '') AS slug FROM nation),
f AS (SELECT n_nationkey, 'facility' AS kind, 'https://' || w || core || 'ogretmenevi.com.tr' || p AS url, row_number() OVER (PARTITION BY n_nationkey ORDER BY wi, pi) AS rank
      FROM n, (VALUES ('', 0), ('www.', 1)) a(w, wi), (VALUES ('/fiyatlistesi.php', 0), ('/fiyat-listesi', 1), ('/fiyatlar', 2)) b(p, pi)),
q AS (SELECT n_nationkey, 'province' AS kind, 'https://' || w || slug || '.pol.tr' || replace(p, '{{}}', slug) AS url, row_number() OVER (PARTITION BY n_nationkey ORDER BY wi, pi) AS rank
      FROM n, (VALUES ('www.', 0), ('', 1)) a(w, wi), (VALUES {', '.join(f"('{p}', {i})" for i, p in enumerate(urls.PROVINCE_PATHS))}) b(p, pi))
SELECT n_nationkey, kind, url, rank::INT AS rank FROM (FROM f UNION ALL FROM q) WHERE kind = 'province' OR rank <= 8""".replace("{{}}", "{}"))
def url_candidates(spark, sf_dir):
    nation = _t(spark, sf_dir, "nation")
    name = F.col("n_name")
    lists = F.array(F.struct(F.lit("facility").alias("kind"), urls.facility_urls(F.concat(name, F.lit(" Öğretmenevi")), name).alias("urls")), F.struct(F.lit("province").alias("kind"), urls.province_urls(name).alias("urls")))
    made = nation.select("n_nationkey", F.explode(lists).alias("l")).select("n_nationkey", "l.kind", F.posexplode("l.urls").alias("rank", "url"))
    return made.select("n_nationkey", "kind", "url", (F.col("rank") + 1).alias("rank"))


@query("""
WITH a AS (SELECT url, 0 AS src, min(page_id) AS ord FROM pages GROUP BY url UNION ALL SELECT url, 1, page_id + 1000000 FROM pages WHERE page_id % 3 = 0
           UNION ALL SELECT 'https://seed' || n_nationkey || '.example', 2, n_nationkey FROM nation)
SELECT url, min(src)::INT AS src FROM a GROUP BY url""")
def url_union_distinct(spark, sf_dir):
    pages, nation = _t(spark, sf_dir, "pages"), _t(spark, sf_dir, "nation")
    seeds = nation.select(F.concat(F.lit("https://seed"), "n_nationkey", F.lit(".example")).alias("url"), F.col("n_nationkey").alias("ord"))
    return documents.url_list(pages.select("url", F.col("page_id").alias("ord")), pages.where("page_id % 3 = 0").select("url", F.col("page_id").alias("ord")), seeds).select("url", "src")


@query("SELECT page_id, url AS target FROM pages")
def search_redirect_unwrap(spark, sf_dir):
    """The address of every other page, wrapped as a redirect, and unwrapped."""
    wrapped = F.concat(F.lit("//r.example/l/?uddg="), urls.form_encode(F.col("url")), F.lit("&rut=1"))
    href = F.when(F.col("page_id") % 2 == 0, wrapped).otherwise(F.col("url"))
    return _t(spark, sf_dir, "pages").select("page_id", urls.unwrap_redirect(href).alias("target"))


@query("""
WITH p AS (SELECT page_id // 50 AS search, page_id, page_id % 5 AS kind FROM pages),
r AS (SELECT search, page_id, CASE WHEN kind IN (0, 1) THEN 0 WHEN kind = 2 THEN 1 END AS part,
  CASE kind WHEN 0 THEN 'https://h' || page_id // 2 || '.pol.tr/a' WHEN 1 THEN 'http://h' || page_id || '.gov.tr/' ELSE 'https://h' || page_id || '.gov.tr/a?b=c+d' END AS url FROM p),
firsts AS (SELECT search, url, min((part, page_id)) AS place FROM r WHERE part IS NOT NULL GROUP BY ALL)
SELECT search, url, rank::INT AS rank FROM (SELECT search, url, row_number() OVER (PARTITION BY search ORDER BY place) AS rank FROM firsts) WHERE rank <= 12""")
def search_results(spark, sf_dir):
    """A search page of each 50 pages: results, redirects, other links; the addresses that count, in order."""
    n, kind = F.col("page_id"), (F.col("page_id") % 5).cast("int")
    a = lambda css, *href: F.concat(F.lit(f'<li><a class="{css}" href="'), *href, F.lit('">x</a>'))
    target = F.concat(F.lit("https://h"), n, F.lit(".gov.tr/a?b=c+d"))
    links = [a("big result__a", F.lit("https://h"), F.expr("page_id div 2"), F.lit(".pol.tr/a")), a("result__a", F.lit("http://h"), n, F.lit(".gov.tr/")), a("other", F.lit("/l/?uddg="), urls.form_encode(target), F.lit("&amp;rut=1")), a("result__b", F.lit("https://no.pol.tr/")), a("result__a", F.lit("ftp://x.pol.tr/"))]
    one = _t(spark, sf_dir, "pages").select(F.expr("page_id div 50").alias("search"), F.struct("page_id", F.element_at(F.array(*links), kind + 1).alias("a")).alias("link"))
    made = one.groupBy("search").agg(F.concat(F.lit("<ul>"), F.array_join(F.transform(F.sort_array(F.collect_list("link")), lambda x: x["a"]), "")).alias("html"))
    found = html.parse_pages(made, select=urls.RESULT_LINK).select("search", F.posexplode(urls.result_urls(F.col("parsed"))).alias("rank", "url"))
    return found.select("search", "url", (F.col("rank") + 1).alias("rank"))


@query("""
SELECT p_partkey, p_type = 'PROMO' AS same_kind, regexp_matches(lower(p_name), 'part') OR lower(coalesce(p_brand, '')) = 'brand#1' AS wide, regexp_matches(lower(p_name), '1') AND NOT regexp_matches(lower(p_name), '2|salon') AS narrow FROM part""")
def facility_filters(spark, sf_dir):
    name, brand = F.col("p_name"), F.col("p_brand")
    return _t(spark, sf_dir, "part").select("p_partkey", (F.col("p_type") == "PROMO").alias("same_kind"), match.kind_filter(name, brand, "part", "brand#1").alias("wide"), match.candidate_filter(name, "1", "2|salon").alias("narrow"))


@query("SELECT DISTINCT n_name FROM customer JOIN nation ON c_nationkey = n_nationkey WHERE c_acctbal > 0 ORDER BY 1")
def distinct_sorted_keys(spark, sf_dir):
    rich = _t(spark, sf_dir, "customer").where("c_acctbal > 0").select(F.col("c_nationkey").alias("n_nationkey")).distinct()
    return match.sorted_keys(_t(spark, sf_dir, "nation").join(rich, "n_nationkey", "left_semi"), "n_name")


@query(f"""
WITH p AS (SELECT doc_id, {_fill(_NORM, "' ' || substr(text, 1, 4000)")} AS blob FROM documents),
f AS (SELECT n_nationkey AS ord, n_name AS isim, {_fill(_NORM, 'n_name')} AS fn FROM nation UNION ALL SELECT * FROM (VALUES (100, 'onthe', 'onthe'), (101, 'there', 'there'), (102, 'onthe', 'onthe')) v)
SELECT doc_id, isim, ord::INT AS ord, score::INT AS score FROM (
  SELECT doc_id, isim, ord, 120 + length(fn) AS score, row_number() OVER (PARTITION BY doc_id ORDER BY length(fn) DESC, ord) AS k FROM p JOIN f ON contains(blob, fn)) WHERE k = 1""")
def match_theta_argmax(spark, sf_dir):
    """Documents against names by containment, the best score, the first listed on ties."""
    pages = documents.spread(_t(spark, sf_dir, "documents").select("doc_id", "text")).select("doc_id", F.lit("").alias("url"), F.lit("").alias("title"), "text")
    extra = spark.createDataFrame([(100, "onthe"), (101, "there"), (102, "onthe")], "ord int, isim string")
    fac = _t(spark, sf_dir, "nation").select(F.col("n_nationkey").alias("ord"), F.col("n_name").alias("isim")).unionByName(extra).withColumn("il", F.lit(""))
    return match.match_pages(pages, fac, "doc_id").select("doc_id", "isim", "ord", "score")


@query("""
WITH f AS (SELECT s_nationkey, s_suppkey AS ord, CASE s_suppkey % 5 WHEN 0 THEN n_name || ' Polis Evi' WHEN 1 THEN n_name || ' Polisevi' WHEN 2 THEN 'Polis Kampı ' || s_suppkey WHEN 3 THEN n_name || ' Polisevi Düğün Salonu' END AS isim, s_suppkey % 5 < 2 AS exact
  FROM supplier JOIN nation ON s_nationkey = n_nationkey WHERE s_suppkey % 5 < 3),
r AS (SELECT *, count(*) OVER (PARTITION BY s_nationkey) AS n, bool_or(exact) OVER (PARTITION BY s_nationkey) AS named, row_number() OVER (PARTITION BY s_nationkey ORDER BY NOT exact, length(isim), ord) AS k FROM f)
SELECT n_name AS il, ord::INT AS ord, isim FROM r JOIN nation ON s_nationkey = n_nationkey WHERE k = 1 AND (named OR n = 1)""")
def pick_exact_or_single(spark, sf_dir):
    """Suppliers as facilities of their nations, some named like them: the one of each nation, if it is clear."""
    both = _t(spark, sf_dir, "supplier").join(F.broadcast(_t(spark, sf_dir, "nation")), F.col("s_nationkey") == F.col("n_nationkey"))
    names = F.array(*[F.concat("n_name", F.lit(x)) for x in (" Polis Evi", " Polisevi")], F.concat(F.lit("Polis Kampı "), "s_suppkey"), F.concat("n_name", F.lit(" Polisevi Düğün Salonu")), F.lit(None).cast("string"))
    return match.pick_facility(both.select(F.col("s_suppkey").cast("int").alias("ord"), F.col("n_name").alias("il"), F.element_at(names, (F.col("s_suppkey") % 5 + 1).cast("int")).alias("isim")))


@query("SELECT user_id, event_id, event_type FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS k FROM events) WHERE k = 1")
def first_page_per_key(spark, sf_dir):
    return match.first_per_key(_t(spark, sf_dir, "events"), ["user_id"], ["ts", "event_id"]).select("user_id", "event_id", "event_type")


@query("SELECT l_returnflag, l_linestatus, count(*) AS n, min(l_extendedprice) AS lowest, max(l_extendedprice) AS highest, bool_or(l_extendedprice >= 600) AS any_high FROM lineitem WHERE l_extendedprice BETWEEN 300 AND 25000 GROUP BY 1, 2 HAVING max(l_extendedprice) >= 600")
def bucket_stats(spark, sf_dir):
    return tariff.price_stats(_t(spark, sf_dir, "lineitem"), ["l_returnflag", "l_linestatus"], "l_extendedprice", tariff.PROBE)


_PRICE = "500 + o_orderkey % 4000"


def _price_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """HTML pages with a table of room prices for each customer's orders, for parsers to be held against the base table."""
    orders = _t(spark, sf_dir, "orders").select("o_custkey", "o_orderkey", F.expr(_PRICE).cast("double").alias("v"))
    cell = lambda add: F.concat(F.lit("<td>"), money.format_tl(F.col("v") + add), F.lit(" TL</td>"))
    row = F.concat(F.lit("<tr><td>Oda "), "o_orderkey", F.lit("</td>"), cell(0), cell(100), cell(250), F.lit("</tr>"))
    rows = orders.groupBy("o_custkey").agg(F.array_join(F.sort_array(F.collect_list(row)), "").alias("rows"))
    head = "<html><head><title>Fiyat</title><script>var a='</p>';</script></head><body><p>2026 konaklama &amp; oda, 01.01.2026</p><table><tr><th colspan=4>Liste</th></tr><tr><th>Oda</th><th>Teşkilat / MEB</th><th>Kamu Personeli</th><th>Onaylı Misafir / Sivil</th></tr>"
    tail = "<tr><td>Ek yatak</td><td>300 TL</td><td>300 TL</td><td>9.000 TL</td></tr></table></body></html>"
    return rows.select(F.concat(F.lit("c"), "o_custkey").alias("url"), F.concat(F.lit(head), "rows", F.lit(tail)).alias("html"))


def _page_sql(needed: int, label: str, extra: str) -> str:
    r = lambda add: _fill(_RANGE, f"min(v + {add})", f"max(v + {add})")
    return f"""WITH o AS (SELECT o_custkey, ({_PRICE})::DOUBLE AS v FROM orders)
SELECT 'c' || o_custkey AS url, {r(250)} AS fiyat_sivil, {r(100)} AS fiyat_kamu_personeli, {r(0)} AS fiyat_kurum_personeli, 'c' || o_custkey AS kaynak, '{label}' AS gecerlilik
FROM o GROUP BY o_custkey HAVING count(*) >= {needed} AND {extra}"""


@query(_page_sql(1, "01.01.2026 itibarıyla", "max(v + 250) >= 600"))
def html_table_prices_probe(spark, sf_dir):
    return tariff.entries(html.parse_pages(_price_pages(spark, sf_dir)), tariff.PROBE)


@query(_page_sql(2, tariff.DEFAULT_LABEL, "max(v + 250) >= 900"))
def html_table_prices_scan(spark, sf_dir):
    return tariff.entries(html.parse_pages(_price_pages(spark, sf_dir)), tariff.SCAN)


@query(_page_sql(2, tariff.DEFAULT_LABEL, "max(v + 250) >= 900"))
def html_stacked_fallback(spark, sf_dir):
    """Pages whose tables are of a hairdresser, have one price, or don't close, with the prices in stacked lines."""
    orders = _t(spark, sf_dir, "orders").select("o_custkey", "o_orderkey", F.expr(_PRICE).cast("double").alias("v"))
    line = F.concat(F.lit("Tek oda\n"), *[F.concat(money.format_tl(F.col("v") + add), F.lit(" TL\n")) for add in (0, 100, 250)])
    lines = orders.groupBy("o_custkey").agg(F.array_join(F.collect_list(line), "").alias("lines"))
    head = "<tr><th>Oda</th><th>Teşkilat</th><th>Kamu Personeli</th><th>Onaylı Misafir</th></tr>"
    row = "<tr><td>Kesim</td><td>500 TL</td><td>600 TL</td><td>950 TL</td></tr>"
    tables = [f"<table><caption>Kuaför</caption>{head}{row * 3}</table>", f"<table>{head}{row}</table>", f"<table>{head}<tr><td>Çamaşır<td>500 TL<td>600 TL<td>950 TL<td><table><tr><td>yok</table></table>"]
    table = F.element_at(F.array(*map(F.lit, tables)), (F.col("o_custkey") % 3 + 1).cast("int"))
    page = F.concat(F.lit("<p>2026 Teşkilat Kamu Onaylı misafir</p>"), table, F.lit("<pre>"), "lines", F.lit("</pre>"))
    pages = lines.select(F.concat(F.lit("c"), "o_custkey").alias("url"), page.alias("html"))
    return tariff.entries(tariff.parse_of_year(pages, tariff.SCAN), tariff.SCAN)


@query("SELECT o_orderkey, 3::INT AS n_triples, ((500 + o_orderkey % 300) * 3 + 300)::DOUBLE AS kurum_sum, ((900 + o_orderkey % 300) * 3 + 300)::DOUBLE AS sivil_sum FROM orders")
def stacked_line_prices(spark, sf_dir):
    """Three room names, each followed by three rising prices; a broken fourth group yields nothing."""
    base = F.col("o_orderkey") % 300
    group = lambda k: F.concat(F.lit(f"Oda {chr(65 + k)} kişilik\n"), *[F.concat(money.format_tl(base + lo + 100 * k), F.lit(" TL\n")) for lo in (500, 700, 900)])
    said = F.concat(F.lit("2026 Teşkilat / Kamu / Onaylı misafir\n"), *[group(k) for k in range(3)], F.lit("Aile odası\n900 TL\nOda\n"))
    orders = documents.spread(_t(spark, sf_dir, "orders").select("o_orderkey"), 50_000)
    made = tariff.stacked_prices(orders.select("o_orderkey", said.alias("text")))
    total = lambda c: F.aggregate(F.col(c), F.lit(0.0), lambda a, x: a + x)
    return made.select("o_orderkey", F.size("stacked.sivil").alias("n_triples"), total("stacked.kurum").alias("kurum_sum"), total("stacked.sivil").alias("sivil_sum"))


@query("SELECT o_custkey, o_orderkey AS first_ok FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) AS k FROM orders WHERE o_orderstatus = 'F') WHERE k = 1")
def first_success(spark, sf_dir):
    good = _t(spark, sf_dir, "orders").where("o_orderstatus = 'F'")
    return match.first_per_key(good, ["o_custkey"], ["o_orderdate", "o_orderkey"]).select("o_custkey", F.col("o_orderkey").alias("first_ok"))


_UPSERT_SQL = """SELECT c_custkey, CASE WHEN c_custkey % 2 = 0 THEN c_name || '*' ELSE c_name END AS c_name, CASE WHEN c_custkey % 4 <> 0 THEN c_mktsegment END AS c_mktsegment FROM customer"""
_JSON_SQL = f"""SELECT c_custkey, '{{"c_custkey":' || c_custkey || ',"c_name":"' || c_name || '"' || coalesce(',"c_mktsegment":"' || c_mktsegment || '"', '') || '}}' AS entry FROM ({_UPSERT_SQL})"""


def _upserted(spark, sf_dir):
    """Every customer as an old row, of which the even ones are replaced."""
    c = _t(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_mktsegment")
    new = c.where("c_custkey % 2 = 0").select("c_custkey", F.concat("c_name", F.lit("*")).alias("c_name"), F.when(F.col("c_custkey") % 4 != 0, F.col("c_mktsegment")).alias("c_mktsegment"))
    return upsert.upsert(c, new, ["c_custkey"])


def _entries(spark, sf_dir):
    return _upserted(spark, sf_dir).select("c_custkey", upsert.without_nulls("c_custkey", "c_name", "c_mktsegment").alias("entry"))


@query(_UPSERT_SQL)
def upsert_replace(spark, sf_dir):
    return _upserted(spark, sf_dir)


@query(_JSON_SQL)
def null_drop_json(spark, sf_dir):
    return _entries(spark, sf_dir)


@query(_UPSERT_SQL)
def upsert_replace_all(spark, sf_dir):
    """upsert_replace by another name."""
    return _upserted(spark, sf_dir)


@query(_JSON_SQL)
def null_drop_json_all(spark, sf_dir):
    """null_drop_json by another name."""
    return _entries(spark, sf_dir)


@query("SELECT count(*) AS scanned, count(*) FILTER (event_type = 'purchase') AS found_count, string_agg(DISTINCT CASE WHEN event_type = 'purchase' THEN 'u/' || user_id END, ',' ORDER BY CASE WHEN event_type = 'purchase' THEN 'u/' || user_id END) AS found FROM events")
def run_report(spark, sf_dir):
    e = _t(spark, sf_dir, "events").select(F.lit("u").alias("il"), F.col("user_id").cast("string").alias("isim"), F.when(F.col("event_type") == "purchase", "found").otherwise("none").alias("status"))
    return upsert.run_report(e)


@query("SELECT DISTINCT 'u/' || user_id AS key FROM events WHERE event_type = 'purchase'")
def run_found_keys(spark, sf_dir):
    e = _t(spark, sf_dir, "events").select(F.lit("u").alias("il"), F.col("user_id").cast("string").alias("isim"), F.when(F.col("event_type") == "purchase", "found").otherwise("none").alias("status"))
    return upsert.found_keys(e)


_RUN_SQL = f"""WITH o AS (SELECT o_custkey, ({_PRICE})::DOUBLE AS v FROM orders),
new AS (SELECT 'n' || c_nationkey AS il, c_name AS isim, {_fill(_RANGE, 'min(v + 250)', 'max(v + 250)')} AS fiyat_sivil, {_fill(_RANGE, 'min(v + 100)', 'max(v + 100)')} AS fiyat_kamu_personeli,
  {_fill(_RANGE, 'min(v)', 'max(v)')} AS fiyat_kurum_personeli, 'https://a.example/c' || c_custkey AS kaynak, '01.01.2026 itibarıyla' AS gecerlilik
  FROM o JOIN customer ON o_custkey = c_custkey WHERE c_custkey % 5 > 0 GROUP BY ALL HAVING max(v + 250) >= 600),
old AS (SELECT 'n' || c_nationkey AS il, c_name AS isim, 'old' AS fiyat_sivil, NULL AS fiyat_kamu_personeli, NULL AS fiyat_kurum_personeli, 'old' AS kaynak, 'old' AS gecerlilik FROM customer WHERE c_custkey % 3 = 0)
SELECT * FROM new UNION ALL SELECT * FROM old WHERE isim NOT IN (SELECT isim FROM new)"""


@query(_RUN_SQL)
def run_merged_entries(spark, sf_dir):
    """A whole run: each customer is a facility with two pages, the second of which must not count; every fifth page isn't fetched."""
    customers = _t(spark, sf_dir, "customer")
    made = _price_pages(spark, sf_dir).withColumn("c_custkey", F.substring("url", 2, 20).cast("long")).join(customers, "c_custkey")
    html_ = F.replace(F.col("html"), F.lit("<title>Fiyat"), F.concat(F.lit("<title>"), "c_name", F.lit(" ")))
    page = lambda host, ord_, body: made.select(F.concat(F.lit(f"https://{host}.example/c"), "c_custkey").alias("url"), F.lit(ord_).alias("ord"), body.alias("html"), F.when(F.col("c_custkey") % 5 == 0, 404).otherwise(200).alias("status"))
    pages = page("a", 0, html_).unionByName(page("b", 1, F.replace(html_, F.lit("01.01.2026"), F.lit("1 Temmuz 2026"))))
    facilities = customers.select(F.col("c_custkey").alias("ord"), F.concat(F.lit("n"), "c_nationkey").alias("il"), F.col("c_name").alias("isim"))
    old = facilities.where("ord % 3 = 0").select("il", "isim", *[F.lit(x).cast("string").alias(c) for c, x in zip(runs.COLUMNS[2:], ("old", None, None, "old", "old"))])
    return runs.run(pages, facilities, old).merged


@query(f"""SELECT 'c' || o_custkey AS url, count(*)::INT AS n_kurum, min({_PRICE})::DOUBLE AS min_kurum, max({_PRICE} + 250)::DOUBLE AS max_sivil FROM orders GROUP BY o_custkey HAVING max({_PRICE} + 250) >= 600""")
def page_bucket_stats(spark, sf_dir):
    made = tariff.entries(tariff.parse_of_year(_price_pages(spark, sf_dir), tariff.PROBE), tariff.PROBE, keep=("stats",))
    return made.select("url", F.col("stats.counts.kurum").alias("n_kurum"), F.col("stats.mins.kurum").alias("min_kurum"), F.col("stats.maxs.sivil").alias("max_sivil"))


@query("SELECT user_id, count(*) AS n, count(*) // 3 AS flushes FROM events GROUP BY user_id")
def every_third_flush(spark, sf_dir):
    return buckets.flush_counts(_t(spark, sf_dir, "events"), ["user_id"])


@query("""
WITH hits AS (SELECT user_id, event_id, value, row_number() OVER (ORDER BY event_id) AS n, count(*) OVER () AS total FROM events WHERE event_type = 'purchase'),
last AS (SELECT user_id, event_id, value, total, row_number() OVER (PARTITION BY user_id ORDER BY event_id DESC) AS k FROM hits WHERE n <= total // 3 * 3)
SELECT user_id, event_id, value, total // 3 AS flushes FROM last WHERE k = 1""")
def flushed_state(spark, sf_dir):
    """The purchases of the event stream, in batches, merged by threes into state in buckets: the last of each user up to the last flush."""
    events = _t(spark, sf_dir, "events").select("user_id", "event_id", "event_type", "value")
    state = buckets.BucketState(spark, f"{documents.shared_dir(spark).rstrip('/')}/flushed-{uuid.uuid4().hex}", ["user_id"], "event_id", events.drop("event_type").schema, 16)
    sink = buckets.FlushSink(state, "true")
    cuts = events.approxQuantile("event_id", [0.1, 0.5, 0.9], 0.01)
    for number, (low, high) in enumerate(zip([None, *cuts], [*cuts, None])):
        inside = F.lit(True) if low is None else F.col("event_id") > low
        sink(events.where(inside & (F.lit(True) if high is None else F.col("event_id") <= high) & (F.col("event_type") == "purchase")).drop("event_type"), number)
    return state.result().withColumn("flushes", F.lit(sink.counts()["flushes"]).cast("long"))


@query("SELECT user_id, event_id, event_type, value FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY event_id DESC) AS k FROM events) WHERE k = 1")
def incremental_upsert(spark, sf_dir):
    """A stream over the events, merged batch by batch: the last event of each user."""
    columns = ["user_id", "event_id", "event_type", "value"]
    base = documents.shared_dir(spark)
    folder = f"{base.rstrip('/')}/stream-{uuid.uuid4().hex}"
    _t(spark, sf_dir, "events").select(*columns).repartition(3).write.parquet(f"{folder}/in")
    stream = spark.readStream.schema(spark.read.parquet(f"{folder}/in").schema).option("maxFilesPerTrigger", 1).parquet(f"{folder}/in")
    # Files come in any order, so an older event in a later batch must not win: the batch meets the state on event_id.
    state = buckets.BucketState(spark, f"{folder}/out", ["user_id"], "event_id", buckets=16)
    buckets.run_available(stream, state.merge, f"{folder}/state")
    return state.result()


@query(r"""
WITH tops AS (
  SELECT k, u, row_number() OVER (PARTITION BY k ORDER BY ord, u) AS n
  FROM (SELECT l_suppkey AS k, 'part' || l_partkey AS u, min(l_orderkey) AS ord FROM lineitem GROUP BY ALL) QUALIFY n <= 35
), links AS (
  SELECT u, 'order' || o AS link, row_number() OVER (PARTITION BY u ORDER BY o) AS j
  FROM (SELECT DISTINCT 'part' || l_partkey AS u, l_orderkey AS o FROM lineitem) QUALIFY j <= 10
), good AS (
  SELECT 'part' || p_partkey AS u FROM part WHERE p_size % 3 > 0
), places AS (
  SELECT k, u AS url, {'n': n, 'j': 0} AS place, u IN (FROM good) AS ok FROM tops
  UNION ALL SELECT k, link, {'n': n, 'j': j}, true FROM tops JOIN good USING (u) JOIN links USING (u)
), visits AS (
  SELECT k, url, min(place) AS place, bool_or(ok) AS ok FROM places GROUP BY k, url
), hits AS (
  SELECT k, min(place) AS best FROM visits JOIN orders ON url = 'order' || o_orderkey WHERE ok AND o_totalprice > 300000 GROUP BY k
)
SELECT v.k AS l_suppkey, max(v.url) FILTER (v.place = h.best) AS url, count(*) AS n_tried
FROM visits v LEFT JOIN hits h ON v.k = h.k WHERE h.best IS NULL OR v.place <= h.best GROUP BY v.k""")
def search_first_success(spark, sf_dir):
    """For each supplier: its first 35 parts as pages, the orders of a part as links, and the first dear order as success."""
    return _searched(spark, sf_dir)


@query(SQL["search_first_success"])
def search_first_success_35(spark, sf_dir):
    """search_first_success by another name."""
    return _searched(spark, sf_dir)


def _pages_of(items, parts, orders):
    """Parts as pages of suppliers, with orders as links: candidates, links of parts, and all pages."""
    of_part = F.concat(F.lit("part"), "l_partkey")
    tops = items.groupBy("l_suppkey", of_part.alias("url")).agg(F.min("l_orderkey").alias("ord"))
    links = items.groupBy(of_part.alias("url")).agg(F.slice(F.array_sort(F.collect_set("l_orderkey")), 1, 10).alias("orders"))
    links = links.select("url", F.transform("orders", lambda o: F.concat(F.lit("order"), o.cast("string"))).alias("links"))
    pages = parts.select(F.concat(F.lit("part"), "p_partkey").alias("url"), (F.col("p_size") % 3 > 0).alias("ok")).join(links, "url", "left")
    return tops, links, pages.unionByName(orders.select(F.concat(F.lit("order"), "o_orderkey").alias("url"), F.lit(True).alias("ok"), F.array().cast("array<string>").alias("links")))


def _searched(spark, sf_dir):
    orders = _t(spark, sf_dir, "orders")
    tops, _, pages = _pages_of(_t(spark, sf_dir, "lineitem"), _t(spark, sf_dir, "part"), orders)
    dear = orders.where("o_totalprice > 300000").select(F.concat(F.lit("order"), "o_orderkey").alias("url"))
    return search.first_success(search.visits(tops, pages, "l_suppkey"), dear, "l_suppkey")


@query(SQL["search_first_success"])
def crawl_first_success(spark, sf_dir):
    """search_first_success as a crawl in rounds, which looks at the pages that it asks for only."""
    return frontier.crawl(*_frontier(spark, sf_dir), f"{documents.shared_dir(spark).rstrip('/')}/crawl-{uuid.uuid4().hex}", "l_suppkey", 400).first()


def _frontier(spark, sf_dir):
    items, parts, orders = (_t(spark, sf_dir, t) for t in ("lineitem", "part", "orders"))
    tops, links, pages = _pages_of(items, parts, orders)
    known = pages.join(orders.where("o_totalprice > 300000").select(F.concat(F.lit("order"), "o_orderkey").alias("url"), F.lit(True).alias("hit")), "url", "left")
    known = documents.written(known, "known")  # each round asks it
    return tops, lambda asked: known.join(asked, "url", "left_semi")


_PROVINCE_SQL = f"""
WITH c AS (SELECT n_name AS il, c_custkey, c_acctbal < 0 AS priced, row_number() OVER (PARTITION BY n_nationkey ORDER BY c_custkey) AS rank FROM customer JOIN nation ON c_nationkey = n_nationkey),
o AS (SELECT o_custkey, ({_PRICE})::DOUBLE AS v FROM orders),
p AS (SELECT o_custkey, {_fill(_RANGE, 'min(v + 250)', 'max(v + 250)')} AS fiyat_sivil, {_fill(_RANGE, 'min(v)', 'max(v)')} AS fiyat_kurum_personeli FROM o GROUP BY o_custkey HAVING count(*) >= 2 AND max(v + 250) >= 900),
hits AS (SELECT il, rank, c_custkey, p.* FROM c JOIN p ON o_custkey = c_custkey WHERE priced AND rank <= 13 QUALIFY row_number() OVER (PARTITION BY il ORDER BY rank) = 1)
SELECT il, CASE WHEN rank IS NULL THEN 'not_found' ELSE 'found' END AS status, 22 + coalesce(rank, (SELECT least(13, count(*)) FROM c WHERE c.il = n.n_name)) AS n_tried, fiyat_sivil, fiyat_kurum_personeli, 'c' || c_custkey AS page
FROM (SELECT n_name, n_name AS il FROM nation) n LEFT JOIN hits USING (il)"""


@query(_PROVINCE_SQL)
def province_run(spark, sf_dir):
    """The scan as a whole over nations as provinces: no guess has a page, the home page lists the customers, of whom those with debts have prices."""
    customers, nation = _t(spark, sf_dir, "customer"), F.broadcast(_t(spark, sf_dir, "nation"))
    named = customers.join(nation, F.col("c_nationkey") == F.col("n_nationkey"))
    page = F.concat(F.lit("https://x.pol.tr/c"), "c_custkey")
    homes = named.groupBy("n_name").agg(F.array_join(F.transform(F.slice(F.sort_array(F.collect_list("c_custkey")), 1, 40), lambda c: F.concat(F.lit('<a href="https://x.pol.tr/c'), c, F.lit('">2026</a>'))), "").alias("html"))
    homes = homes.select(F.get(urls.province_homes(F.col("n_name")), F.lit(0)).alias("url"), "html")
    prices = _price_pages(spark, sf_dir).join(customers.where("c_acctbal < 0"), F.concat(F.lit("c"), "c_custkey") == F.col("url"), "left_semi")
    prices = prices.select(F.concat(F.lit("https://x.pol.tr/"), "url").alias("url"), "html")
    empty = customers.where("c_acctbal >= 0").select(page.alias("url"), F.lit("<p>yok").alias("html"))
    pages = documents.written(homes.unionByName(prices).unionByName(empty).withColumn("err", F.lit(None).cast("string")), "pages")
    facilities = nation.select(F.col("n_nationkey").alias("ord"), F.col("n_name").alias("il"), F.concat("n_name", F.lit(" Polisevi")).alias("isim"), F.lit(None).cast("string").alias("tip"))
    old = documents.tariff_document(spark, None)
    fetch = lambda asked: asked.join(pages, "url", "left")
    ran = frontier.run_provinces(facilities, old, fetch, f"{documents.shared_dir(spark).rstrip('/')}/provinces-{uuid.uuid4().hex}", width=35)
    told = ran.results.join(ran.entries.select("il", "fiyat_sivil", "fiyat_kurum_personeli"), "il", "left")
    return told.select("il", "status", "n_tried", "fiyat_sivil", "fiyat_kurum_personeli", F.replace("url", F.lit("https://x.pol.tr/"), F.lit("")).alias("page"))
