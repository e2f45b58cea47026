"""A crawl in rounds: the next pages of all keys still searching are fetched together, until each key has its success or no page left."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import urls as addresses
from ..functions.html import parse_pages
from ..sources.documents import Rounds, written
from .match import kind_filter, pick_facility
from .runs import COLUMNS
from .search import first_candidates, first_success, visits
from .tariff import SCAN, YEAR, Profile, entries
from .upsert import upsert

Look = Callable[[DataFrame], DataFrame]


@dataclass(frozen=True)
class Crawl:
    """What a crawl knows: pages (the rows of look) and the candidates it went through."""

    candidates: DataFrame
    pages: DataFrame
    key: str
    most: int
    most_links: int
    rounds: int

    def visits(self) -> DataFrame:
        """key, ord, link_ord, url and ok of the pages that the search takes in, with those after a success."""
        return visits(self.candidates, self.pages, self.key, self.most, self.most_links)

    def first(self) -> DataFrame:
        """key, url and n_tried: the first success of each key, and how many pages were tried up to it (all, without one)."""
        return first_success(self.visits(), self.pages.where("hit"), self.key)


def waiting(candidates: DataFrame, pages: DataFrame, key: str, width: int, most: int, most_links: int) -> DataFrame:
    """key and url of the next `width` pages of each key that pages doesn't have yet: those before its first success, in the order of the search."""
    known = pages.select("url", F.lit(True).alias("known"), "hit")
    seen = visits(candidates, pages, key, most, most_links).join(known, "url", "left")
    at = F.struct("ord", "link_ord")
    by_key = Window.partitionBy(key)
    first = F.min(F.when(F.col("hit"), at)).over(by_key)
    left = seen.withColumn("first", first).where(F.col("known").isNull() & (F.col("first").isNull() | (at < F.col("first"))))
    return left.withColumn("turn", F.row_number().over(by_key.orderBy("ord", "link_ord"))).where(F.col("turn") <= width).select(key, "url")


def crawl(candidates: DataFrame, look: Look, folder: str, key: str, width: int = 1, most: int = 35, most_links: int = 10) -> Crawl:
    """Visits each key's candidates (key, ord, url) in order, and the links of each page after it, until a page is a hit.

    look takes distinct addresses (url) and returns a row for each with url, ok, hit, links (array<string>) and columns of its own; of an
    address that it leaves out the page isn't ok. The order of visits is that of search.visits. A round asks for the next `width`
    addresses of every key without success; so with 1 no page is asked for that a loop over each key wouldn't ask for, and a page that
    several keys share is asked for once; a larger width takes fewer rounds and asks for some pages in vain. The result is the same.
    Rounds are kept in the folder. A crawl that broke off goes on from its last whole round, given the same candidates and folder.
    A key's visits, at most most * (1 + most_links), are folded as one row; keys that have ended take no part in later rounds.
    Candidates are cut to the first `most` of each key, as visits does, and written: each round and the result read them.
    """
    spark = candidates.sparkSession
    candidates = written(first_candidates(candidates, key, most), "candidates")
    rounds = Rounds(spark, folder)
    none = spark.createDataFrame([], "url string, ok boolean, hit boolean, links array<string>")
    number, active = rounds.done(), candidates
    while True:
        pages = rounds.read(number) if number else none
        turn = written(waiting(active, pages, key, width, most, most_links), "waiting")
        if turn.isEmpty():
            return Crawl(candidates, pages, key, most, most_links, number)
        asked = turn.select("url").distinct()
        told = asked.join(look(asked), "url", "left").withColumns({c: F.coalesce(c, F.lit(False)) for c in ("ok", "hit")})
        rounds.add(told, number)
        active = candidates.join(turn.select(key).distinct(), key, "left_semi")
        number += 1


@dataclass(frozen=True)
class Site:
    """Where a province's pages are looked for: columns of addresses by its name, and which links are followed."""

    guesses: Callable[[Column], Column] = addresses.province_urls
    homes: Callable[[Column], Column] = addresses.province_homes
    searches: Callable[[Column], Column] = addresses.search_urls
    domain: str = "pol.tr"

    def wanted(self, href: Column, text: Column, url: Column) -> Column:
        return addresses.link_wanted(href, text, url, domain=self.domain)


def page_look(fetch: Look, profile: Profile = SCAN, site: Site = Site(), select: str = "") -> Look:
    """A look for crawl: pages fetched (url, html, err), parsed once, with links, err, results of a search page and the prices as entry."""

    def look(asked: DataFrame) -> DataFrame:
        fetched = fetch(asked).select("url", "html", "err").withColumn("html_year", F.coalesce(F.col("html").contains(YEAR), F.lit(False)))
        parsed = written(parse_pages(fetched, select=select), "parsed")
        links = addresses.page_links(parsed.withColumn("page", F.col("url")), "page", site.wanted)
        links = links.groupBy("page").agg(F.transform(F.sort_array(F.collect_list(F.struct("rank", "link"))), lambda x: x["link"]).alias("links"))
        read = parsed.where("parsed IS NOT NULL")
        priced = entries(read, profile).withColumn("entry", F.struct(*COLUMNS[2:])).select("url", "entry")
        pages = parsed.select("url", "err", F.col("parsed").isNotNull().alias("ok"), addresses.result_urls(F.col("parsed")).alias("results"))
        both = pages.join(links.withColumnRenamed("page", "url"), "url", "left").join(priced, "url", "left")
        return both.select("url", "ok", F.col("entry").isNotNull().alias("hit"), "links", "err", "results", "entry")

    return look


@dataclass(frozen=True)
class ProvinceRun:
    """entries: new rows; merged: those and the old ones; results: (il, isim, status, url, n_tried) of all provinces; crawl: the pages."""

    entries: DataFrame
    merged: DataFrame
    results: DataFrame
    crawl: Crawl


def run_provinces(facilities: DataFrame, old: DataFrame, fetch: Look, folder: str, profile: Profile = SCAN, site: Site = Site(), width: int = 1) -> ProvinceRun:
    """The scan as a whole: each province's facility, the pages that may have its prices, the first page that has them, merged entries.

    facilities has ord, il, isim and tip; old the rows of the tariff document. A province with a facility of the kind takes part; without one
    clear facility its status is ambiguous_or_no_facility. Its candidates are the guessed addresses, then the links of both home pages,
    then the results of both searches, each once, the first 35; a candidate's links, the first 10, are looked at after it. status
    is found or not_found, url the page with the prices, n_tried the pages tried besides home and search pages. fetch takes addresses (url) and returns url,
    html (null if there is none) and err. All pages that were fetched stay in the folder, so a run that broke off goes on from there.
    """
    provinces = facilities.where(kind_filter(F.col("isim"), F.col("tip"))).select("il").where("il IS NOT NULL").distinct()
    picked = pick_facility(facilities).join(provinces, "il", "left_semi").select("il", "isim")
    # Home and search pages are asked for in two rounds of their own, whether or not a guess succeeds.
    first = picked.select("il", F.concat(site.homes(F.col("il")), site.searches(F.col("il"))).alias("urls"))
    first = written(first.select("il", F.posexplode("urls").alias("ord", "url")), "first")
    before = Rounds(first.sparkSession, f"{folder.rstrip('/')}/first")
    if not before.done():
        before.add(page_look(fetch, profile, site, addresses.RESULT_LINK)(first.select("url").distinct()), 0)
    opened = first.join(before.read(1).select("url", "links", "results"), "url")
    homes = F.size(site.homes(F.col("il")))
    found = opened.select("il", (F.col("ord") + 1).alias("list"), F.when(F.col("ord") < homes, F.col("links")).otherwise(F.col("results")).alias("urls"))
    listed = picked.select("il", F.lit(0).alias("list"), site.guesses(F.col("il")).alias("urls")).unionByName(found)
    places = listed.select("il", "list", F.posexplode("urls").alias("place", "url"))
    candidates = places.groupBy("il", "url").agg(F.min(F.struct("list", "place")).alias("at"))
    candidates = written(candidates.select("il", (F.col("at.list") * 1000 + F.col("at.place")).alias("ord"), "url"), "candidates")

    crawled = crawl(candidates, page_look(fetch, profile, site), f"{folder.rstrip('/')}/pages", "il", width)
    outcome = picked.join(crawled.first(), "il", "left")
    named = outcome.join(crawled.pages.where("hit").select("url", "entry"), "url").select("il", "isim", "entry.*")
    status = F.when(F.col("isim").isNull(), "ambiguous_or_no_facility").when(F.col("url").isNull(), "not_found").otherwise("found")
    results = provinces.join(outcome, "il", "left").select("il", "isim", status.alias("status"), "url", F.coalesce("n_tried", F.lit(0)).alias("n_tried"))
    return ProvinceRun(named, upsert(old.select(*COLUMNS), named.select(*COLUMNS), ["il", "isim"]), results, crawled)
