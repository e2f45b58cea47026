"""URLs: parts, candidates, redirects and joins."""

from __future__ import annotations

import re
from urllib.parse import urljoin

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from .text import name_cores, province_slug

#: Paths that a facility's and a province's site may have prices at; {} is the province's slug.
FACILITY_PATHS = ("/fiyatlistesi.php", "/fiyat-listesi", "/fiyatlar")
PROVINCE_PATHS = (
    "/polisevi", "/polis-evi", "/polisevi-sube-mudurlugu", "/polis-evi-sube-mudurlugu", "/polisevi-sube-mudurlugu-fiyat-listesi", "/{}-polisevi-2026-yili-fiyat-listesi",
    "/{}-polisevi", "/{}-polis-evi", "/gaziantep-pol-evi", "/konaklama-fiyat-listesi", "/fiyat-listesi",
)
LINK_WORDS = ("polisevi", "polis-evi", "polis evi", "fiyat", "konaklama", "2026")


def netloc(url: Column) -> Column:
    return F.coalesce(F.try_parse_url(url, F.lit("AUTHORITY")), F.lit(""))


def host_core(url: Column) -> Column:
    """The host without www., the institution's domain and .com.tr."""
    host = F.replace(F.lower(netloc(url)), F.lit("www."), F.lit(""))
    return F.replace(F.replace(host, F.lit("ogretmenevi.com.tr"), F.lit("")), F.lit(".com.tr"), F.lit(""))


def no_fragment(url: Column) -> Column:
    return F.substring_index(url, "#", 1)


def facility_urls(name: Column, province: Column, most: int = 8) -> Column:
    """Guesses in order: each core's bare and www host at each path, distinct, the first `most`."""
    hosts = F.flatten(F.transform(name_cores(name, province), lambda c: F.array(F.concat(c, F.lit("ogretmenevi.com.tr")), F.concat(F.lit("www."), c, F.lit("ogretmenevi.com.tr")))))
    urls = F.flatten(F.transform(hosts, lambda h: F.array(*[F.concat(F.lit("https://"), h, F.lit(p)) for p in FACILITY_PATHS])))
    return F.slice(F.array_distinct(urls), 1, most)


def province_urls(province: Column) -> Column:
    """Both hosts of a province's site at each path, in order."""
    slug = province_slug(province)
    paths = [F.concat(*[x for part in p.split("{}") for x in (slug, F.lit(part))][1:]) for p in PROVINCE_PATHS]
    return F.array_distinct(F.array(*[F.concat(F.lit("https://" + www), slug, F.lit(".pol.tr"), p) for www in ("www.", "") for p in paths]))


def province_homes(province: Column) -> Column:
    """Both addresses of a province's home page."""
    return F.array(*[F.concat(F.lit("https://" + www), province_slug(province), F.lit(".pol.tr")) for www in ("www.", "")])


#: What is searched for, with the province's slug and name; the search page; the links on it that are results; what results must have
#: in their addresses, as they stand and behind a redirect.
SEARCHES = ("site:{slug}.pol.tr 2026 polisevi fiyat", "{il} polisevi 2026 fiyat listesi site:pol.tr")
SEARCH_PAGE, RESULT_LINK = "https://html.duckduckgo.com/html/?q=", "a.result__a"
RESULT_WORDS, TARGET_WORDS = ("pol.tr", "gov.tr", "meb.gov.tr"), (".pol.tr", ".gov.tr", "meb.gov.tr")


def form_encode(c: Column) -> Column:
    """c as a form's value: blanks as plus, all but letters, digits and _ . - ~ percent-encoded in UTF-8."""
    return F.replace(F.replace(F.url_encode(c), F.lit("*"), F.lit("%2A")), F.lit("%7E"), F.lit("~"))


def search_queries(province: Column) -> Column:
    """The two searches for a province, in order."""
    filled = lambda said: F.concat(*[{"slug": province_slug(province), "il": province}.get(x, F.lit(x)) for x in re.split("[{}]", said) if x])
    return F.array(*[filled(said) for said in SEARCHES])


def search_urls(province: Column, page: str = SEARCH_PAGE) -> Column:
    """The addresses of the result pages of search_queries."""
    return F.transform(search_queries(province), lambda q: F.concat(F.lit(page), form_encode(q)))


def result_urls(parsed: Column, most: int = 12) -> Column:
    """The results on a search page of parse_pages with select=RESULT_LINK: an array of the first `most` distinct addresses.

    First the marked links with a word of RESULT_WORDS in their address, then the targets of all redirects that have one of
    TARGET_WORDS, each in the page's order; only those that begin with http. Null for a null page.
    """
    has = lambda url, words: F.greatest(*[url.contains(w) for w in words])
    plain = F.transform(F.filter(parsed["links"], lambda x: x["marked"] & has(x["href"], RESULT_WORDS)), lambda x: x["href"])
    wrapped = F.transform(F.filter(parsed["links"], lambda x: x["href"].rlike("uddg=[^&]")), lambda x: unwrap_redirect(x["href"]))
    found = F.concat(plain, F.filter(wrapped, lambda x: has(x, TARGET_WORDS)))
    return F.slice(F.array_distinct(F.filter(found, lambda x: x.startswith("http"))), 1, most)


def link_wanted(href: Column, text: Column, url: Column, words: tuple = LINK_WORDS, domain: str = "pol.tr") -> Column:
    """Whether a link's address or text has one of the words and its absolute URL is in the domain."""
    blob = F.lower(F.concat_ws(" ", href, text))
    return blob.rlike("|".join(words)) & netloc(url).endswith(domain)


def page_links(parsed: DataFrame, key: str, wanted, most: int = 40) -> DataFrame:
    """key, rank and link: of each page of parse_pages (with url) the links that wanted(href, text, absolute URL) holds for.

    Links are absolute, without fragments and repeats, in the page's order, the first `most`. A page's own links alone are held together.
    Pages that are null, have no url or no wanted link give no rows, as an empty table does; pages of one key count together.
    """
    links = parsed.select(key, "url", F.posexplode("parsed.links").alias("at", "x"))
    full = links.withColumn("link", join_url(F.col("url"), F.col("x.href")))
    kept = full.where(wanted(F.col("x.href"), F.col("x.text"), F.col("link"))).withColumn("link", no_fragment(F.col("link")))
    firsts = kept.groupBy(key, "link").agg(F.min("at").alias("at")).groupBy(key).agg(F.slice(F.sort_array(F.collect_list(F.struct("at", "link"))), 1, most).alias("links"))
    return firsts.select(key, F.posexplode("links").alias("rank", "y")).select(key, (F.col("rank") + 1).alias("rank"), F.col("y.link").alias("link"))


def unwrap_redirect(href: Column) -> Column:
    """The target in a redirect's uddg parameter, percent-decoded with plus signs kept; the link itself without one."""
    target = F.regexp_extract(href, "uddg=([^&]+)", 1)
    return F.when(target != "", F.try_url_decode(F.replace(target, F.lit("+"), F.lit("%2B")))).otherwise(href)


@F.pandas_udf(StringType())
def join_url(base: pd.Series, href: pd.Series) -> pd.Series:
    """Absolute URL of a link on a page; null where either is null or the link can't be read."""

    def one(b, h):
        try:
            return None if b is None or h is None else urljoin(b, h.strip())
        except ValueError:
            return None

    return pd.Series([one(b, h) for b, h in zip(base, href)], dtype=object)
