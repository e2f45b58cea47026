"""A whole run: fetched pages to parsed prices, facilities, merged entries, document and report."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.html import page_text
from ..sources.documents import live_pages, written
from .match import first_per_key, match_pages
from .tariff import PROBE, Profile, entries, parse_of_year
from .upsert import found_keys, upsert, write_document

COLUMNS = ("il", "isim", "fiyat_sivil", "fiyat_kamu_personeli", "fiyat_kurum_personeli", "kaynak", "gecerlilik")


@dataclass(frozen=True)
class Run:
    """entries: the new rows; merged: those and the old ones; results: (il, isim, status) of all facilities."""

    entries: DataFrame
    merged: DataFrame
    results: DataFrame

    def write(self, note: str, path: str, mirror: str | None = None) -> None:
        write_document(self.merged, note, path, mirror)

    def found(self) -> DataFrame:
        return found_keys(self.results)


def run(pages: DataFrame, facilities: DataFrame, old: DataFrame, profile: Profile = PROBE) -> Run:
    """pages (url, ord, html, status) in the order of visits, facilities (ord, il, isim), old rows of the tariff document.

    Pages that weren't fetched, lack the year or have no accepted prices give nothing. Each of the others goes to the facility that
    it matches best; a facility's first page counts, and replaces its old row whole. Pages with a null url are left out.
    """
    live = live_pages(pages).where("url IS NOT NULL").select("url", F.col("ord").alias("page_ord"), "html")
    parsed = parse_of_year(live, profile)
    # Written, since matching and merging both read it: each page is parsed once. A page is (url, page_ord): an address may stand twice.
    priced = entries(parsed, profile, keep=("page_ord", "parsed")).withColumn("page", F.struct("url", "page_ord"))
    priced = written(priced.withColumn("title", F.col("parsed.title")).withColumn("text", F.substring(page_text(F.col("parsed")), 1, 4000)).drop("parsed"), "priced")
    words = priced.select("page", "url", "title", "text")
    matched = match_pages(words, facilities, "page").select("page", "il", "isim")
    named = priced.drop("title", "text").join(matched, "page")
    first = first_per_key(named, ["il", "isim"], ["page_ord", "url"]).select(*COLUMNS)
    hit = first.select("il", "isim").withColumn("status", F.lit("found"))
    results = facilities.select("il", "isim").distinct().join(hit, ["il", "isim"], "left").withColumn("status", F.coalesce("status", F.lit("none")))
    return Run(first, upsert(old.select(*COLUMNS), first, ["il", "isim"]), results)
