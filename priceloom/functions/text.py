"""Names: folding, normal forms and slugs, as Column functions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Letters of names and what they become in normal forms.
LETTERS, PLAIN = "çğıöşü", "cgiosu"

#: Letters of province names and what they become in slugs.
SLUG_LETTERS = "çÇğĞıİIöÖşŞüÜ", "ccggiiioossuu"

#: Provinces whose slug is set by hand.
SLUGS = {
    "Afyonkarahisar": "afyon", "Kahramanmaraş": "kahramanmaras", "Şanlıurfa": "sanliurfa", "Şırnak": "sirnak", "İstanbul": "istanbul", "İzmir": "izmir",
    "Çanakkale": "canakkale", "Çankırı": "cankiri", "Çorum": "corum", "Iğdır": "igdir", "Kilis": "kilis", "Osmaniye": "osmaniye", "Düzce": "duzce",
    "Gümüşhane": "gumushane", "Ağrı": "agri", "Muş": "mus", "Uşak": "usak", "Elazığ": "elazig", "Muğla": "mugla", "Nevşehir": "nevsehir", "Niğde": "nigde",
    "Tekirdağ": "tekirdag", "Kırklareli": "kirklareli", "Kırıkkale": "kirikkale", "Kırşehir": "kirsehir", "Balıkesir": "balikesir", "Eskişehir": "eskisehir",
    "Kütahya": "kutahya", "Kocaeli": "kocaeli", "Sakarya": "sakarya", "Hatay": "hatay", "Adıyaman": "adiyaman", "Diyarbakır": "diyarbakir",
}

#: Words of institutions that names lose, in this order.
INSTITUTION = ("veaksamsanatokulu", "veaso", "aso", "mudurlugu", "ogretmenevi")


def bind(value: Column, use) -> Column:
    """use(value) with the value computed once: inside lambdas, where common subexpressions aren't shared, this saves their repetition."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def fold(c: Column) -> Column:
    """Lower case with ß as ss; null as the empty text."""
    return F.replace(F.lower(F.coalesce(c, F.lit(""))), F.lit("ß"), F.lit("ss"))


def norm_name(c: Column) -> Column:
    """Folded, Turkish letters made plain, everything but a-z and 0-9 deleted."""
    return F.regexp_replace(F.translate(fold(c), LETTERS, PLAIN), "[^a-z0-9]+", "")


def province_slug(c: Column) -> Column:
    """The slug set by hand, else plain letters in lower case without spaces."""
    table = F.create_map(*[F.lit(x) for pair in SLUGS.items() for x in pair])
    plain = F.translate(c, *SLUG_LETTERS)
    return F.coalesce(F.try_element_at(table, c), F.replace(F.lower(plain), F.lit(" "), F.lit("")))


def name_cores(name: Column, province: Column) -> Column:
    """Candidate slugs in a fixed order: the name without institution words, the province, what follows the province in the name."""
    core = norm_name(name)
    for word in INSTITUTION:
        core = F.replace(core, F.lit(word), F.lit(""))
    home = norm_name(province)
    after = F.when((home != "") & core.startswith(home), F.substr(core, F.length(home) + 1))
    return F.array_distinct(F.filter(F.array(core, home, after), lambda x: F.length(x) >= 3))
