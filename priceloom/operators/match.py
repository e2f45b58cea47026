"""Matching pages to facilities, and choosing one of several."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import norm_name
from ..functions.urls import host_core
from ..sources.documents import small, written
from .contain import best_contained, contained, first_listed

#: Facilities, and hosts that a name holds, up to which they are broadcast to the rows that matched them.
BROADCAST_ROWS = 200_000

#: Names of guesthouses, and of halls and the like that are none.
WANTED, UNWANTED = r"polis", r"d[uü][gğ][uü]n|salon|spor|yemek|kayak|kongre|pekom|moral"


def kind_filter(name: Column, kind: Column, wanted: str = WANTED, kind_is: str = "polisevi") -> Column:
    return name.rlike("(?iu)" + wanted) | (F.lower(F.coalesce(kind, F.lit(""))) == kind_is)


def candidate_filter(name: Column, wanted: str = WANTED, unwanted: str = UNWANTED) -> Column:
    name = F.coalesce(name, F.lit(""))
    return name.rlike("(?iu)" + wanted) & ~name.rlike("(?iu)" + unwanted)


#: What a name found whole, a host's core inside a name, and a name's core found count for, besides their length; least length of cores.
BY_NAME, BY_HOST, BY_CORE, LEAST_CORE = 120, 80, 60, 4


def page_blob(url: Column, title: Column, text: Column) -> Column:
    """What names are looked for in: title, host and the first 4,000 characters of the text, in normal form."""
    host = F.lower(F.replace(F.coalesce(F.try_parse_url(url, F.lit("AUTHORITY")), F.lit("")), F.lit("www."), F.lit("")))
    return norm_name(F.concat_ws(" ", title, host, F.substring(text, 1, 4000)))


def match_pages(pages: DataFrame, facilities: DataFrame, page_key: str = "url") -> DataFrame:
    """page_key, ord, il, isim and score of each page's best facility; the first listed wins ties.

    pages has page_key, url, title and text (nulls: empty), facilities ord (each once), il and isim. A name found whole in a page counts
    120 and its length, a name's core (what stands before "ogretmen") found there 60, and a host's core inside a name 80, cores from four
    characters on. A facility counts as the largest of the three; the first exceeds the others wherever it holds. So each kind is one
    containment join, of pages for names and cores and of names for the distinct cores of hosts, and no page meets a facility with
    which it has nothing in common. Pages that match nothing have no row; pages of one key count together; empty tables give none.
    """
    named = facilities.select("ord", norm_name(F.col("isim")).alias("fn")).withColumn("core", F.regexp_extract("fn", "^(.+?)ogretmen", 1))
    cores = named.where(F.length("core") >= LEAST_CORE)
    wanted = first_listed(named, F.col("fn"), BY_NAME).unionByName(first_listed(cores, F.col("core"), BY_CORE))
    # A string that is both a name and a core counts as the name.
    wanted = wanted.groupBy("pattern").agg(F.max("weight").alias("weight"), F.max_by("ord", "weight").alias("ord"))
    told = pages.select(F.col(page_key).alias("key"), page_blob(F.col("url"), F.col("title"), F.col("text")).alias("text"))
    in_pages = best_contained(told, wanted).select("key", "ord", F.col("weight").alias("score"))

    hosts = pages.select(F.col(page_key).alias("key"), host_core(F.col("url")).alias("pattern")).where(F.length("pattern") >= LEAST_CORE)
    names = named.select(F.col("ord").alias("key"), F.col("fn").alias("text"))
    of_host = contained(names, hosts.select("pattern").distinct()).groupBy("pattern").agg(F.min("key").cast("long").alias("ord"))
    by_host = hosts.join(small(written(of_host, "hosts"), BROADCAST_ROWS), "pattern").select("key", "ord", (F.length("pattern") + BY_HOST).cast("long").alias("score"))

    best = in_pages.unionByName(by_host).groupBy("key").agg(F.max_by(F.struct("ord", "score"), F.struct("score", -F.col("ord"))).alias("best"))
    listed = small(facilities.select("ord", "il", "isim"), BROADCAST_ROWS)
    return best.select("key", "best.*").join(listed, "ord").select(F.col("key").alias(page_key), "ord", "il", "isim", F.col("score").cast("int").alias("score"))


def pick_facility(facilities: DataFrame) -> DataFrame:
    """il, ord and isim of each province's facility: the shortest of those named like the province, else the only candidate.

    Of equally short names the first listed counts. Null names are no candidates, a null province has none named like it; provinces without a
    clear facility, and empty tables, give no rows.
    """
    found = facilities.where(candidate_filter(F.col("isim")))
    exact = norm_name(F.col("isim")) == F.concat(norm_name(F.col("il")), F.lit("polisevi"))
    ranked = found.groupBy("il").agg(F.count("*").alias("n"), F.bool_or(exact).alias("named"), F.min(F.struct((~exact).alias("other"), F.length("isim").alias("len"), "ord", "isim")).alias("best"))
    return ranked.where("named OR n = 1").select("il", "best.ord", "best.isim")


def first_per_key(df: DataFrame, keys: list[str], order: list) -> DataFrame:
    """The first row of each key by order."""
    ranked = df.withColumn("first_rank_", F.row_number().over(Window.partitionBy(*keys).orderBy(*order)))
    return ranked.where("first_rank_ = 1").drop("first_rank_")


def sorted_keys(df: DataFrame, key: str) -> DataFrame:
    """The distinct values of a column, sorted."""
    return df.select(key).distinct().orderBy(key)
