"""First-success search over ordered URLs: a page, then the links on it, each URL visited once per key."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

VISIT = "struct<ord:int,link_ord:int,url:string>"


def _ranked(candidates: DataFrame, key: str) -> DataFrame:
    return candidates.withColumn("k", F.row_number().over(Window.partitionBy(key).orderBy("ord", "url")))


def first_candidates(candidates: DataFrame, key: str, most: int) -> DataFrame:
    """key, ord and url of the candidates that visits takes: the first `most` of each key; null keys and URLs are left out."""
    named = candidates.where(F.col(key).isNotNull() & F.col("url").isNotNull()).select(key, F.col("ord").cast("long").alias("ord"), "url")
    return _ranked(named, key).where(F.col("k") <= most).drop("k")


def visits(candidates: DataFrame, pages: DataFrame, key: str, most: int = 35, most_links: int = 10) -> DataFrame:
    """key, ord, link_ord, url, ok: the URLs that a search without success would visit, in the order of (ord, link_ord).

    ord is a candidate's rank from 1, by the ord of candidates and then the URL. candidates has key, ord, url; pages has url, ok, links (array<string>), one row for each url. Of a key the first `most`
    candidates are taken; one that was visited before, as a candidate or as a link, is skipped with its links. A candidate's page
    that is ok has its first `most_links` links visited after it (link_ord from 1; 0 is the page); links of these aren't followed.
    A URL without a page is visited and not ok. Null keys and URLs are left out; empty tables give no rows. A key's visits are
    folded as one array, of at most most * (most_links + 1) URLs.
    """
    named = candidates.where(F.col(key).isNotNull() & F.col("url").isNotNull()).select(F.col(key).alias("key"), F.col("ord").cast("long").alias("ord"), "url")
    first = _ranked(named, "key").where(F.col("k") <= most)
    known = pages.select("url", F.coalesce("ok", F.lit(False)).alias("ok"), "links")
    links = F.when(F.col("ok"), F.slice(F.filter("links", lambda x: x.isNotNull()), 1, most_links))
    opened = first.join(known, "url", "left").select("key", F.struct("k", "url", F.coalesce(links, F.array().cast("array<string>")).alias("links")).alias("c"))
    start = F.array().cast(f"array<{VISIT}>")

    def step(done, c):
        seen = F.transform(done, lambda v: v["url"])
        top = F.struct(c["k"].alias("ord"), F.lit(0).alias("link_ord"), c["url"].alias("url"))
        fresh = F.array_except(c["links"], F.concat(seen, F.array(c["url"])))  # distinct, in order
        deeper = F.transform(fresh, lambda u: F.struct(c["k"].alias("ord"), F.array_position(c["links"], u).cast("int").alias("link_ord"), u.alias("url")))
        return F.when(F.array_contains(seen, c["url"]), done).otherwise(F.concat(done, F.array(top), deeper))

    folded = opened.groupBy("key").agg(F.sort_array(F.collect_list("c")).alias("cs"))
    out = folded.select("key", F.inline(F.aggregate("cs", start, step)))
    return out.join(known.select("url", "ok"), "url", "left").select(F.col("key").alias(key), "ord", "link_ord", "url", F.coalesce("ok", F.lit(False)).alias("ok"))


def first_success(visited: DataFrame, entries: DataFrame, key: str) -> DataFrame:
    """key, url, n_tried: the first visited URL of each key that has a row in entries (url), and how many were tried up to it.

    Keys without any have a null url and all their visits as tried.
    """
    found = entries.select("url").distinct().withColumn("hit", F.lit(True))
    at = F.struct("ord", "link_ord", "url")
    marked = visited.join(found, "url", "left").select(key, at.alias("at"), (F.col("ok") & F.coalesce("hit", F.lit(False))).alias("hit"))
    best = marked.groupBy(key).agg(F.min(F.when(F.col("hit"), F.col("at"))).alias("best"))
    tried = marked.join(best, key).where("best IS NULL OR at <= best")
    return tried.groupBy(key).agg(F.max("best.url").alias("url"), F.count("*").alias("n_tried"))
