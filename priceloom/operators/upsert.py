"""Keyed upserts of whole rows, and reports."""

from __future__ import annotations

from datetime import UTC, datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..sources.json_files import write_json


def upsert(old: DataFrame, new: DataFrame, keys: list[str], order: str | None = None) -> DataFrame:
    """old with each key's row replaced whole by the last of new (by order); nulls of the new row replace too.

    One partial aggregate over a union, so both sides shuffle once and shrink before it.
    """
    columns = old.columns
    place = F.col(order).cast("long") if order else F.lit(0).cast("long")
    rows = old.select(*columns, F.lit(0).alias("side_"), F.lit(0).cast("long").alias("at_")).unionByName(new.select(*columns, F.lit(1).alias("side_"), place.alias("at_")))
    best = rows.groupBy(*keys).agg(F.max_by(F.struct(*columns), F.struct("side_", "at_")).alias("row_"))
    return best.select("row_.*")


def without_nulls(*columns: str) -> Column:
    """The columns as a JSON object that omits nulls."""
    return F.to_json(F.struct(*columns))


def write_document(entries: DataFrame, note: str, path: str, mirror: str | None = None) -> None:
    """The tariff document: a note, and the rows sorted by (il, isim) without their nulls. mirror gets a copy if its folder exists."""
    write_json(entries.sparkSession, path, {"not": note}, {"tesisler": (entries, ["il", "isim"])}, mirror)


def utc_now() -> str:
    return datetime.now(UTC).isoformat()


def write_report(results: DataFrame, found: DataFrame, path: str, note: str) -> None:
    """The report of a scan: when it ended, how many were scanned and found, the entries found, and the result of each province."""
    counts = results.agg(F.count("*").alias("scanned"), F.count_if(F.col("status") == "found").alias("hits")).first()
    fields = {"started_note": note, "finished_at": utc_now(), "iller_scanned": counts["scanned"], "found_count": counts["hits"]}
    write_json(results.sparkSession, path, fields, {"found": (found, ["il", "isim"]), "results": (results, ["il"])})


def run_report(results: DataFrame, status: str = "status") -> DataFrame:
    """scanned, found_count and the sorted keys found, from (il, isim, status)."""
    hit = F.col(status) == "found"
    keys = F.array_join(F.sort_array(F.collect_set(F.when(hit, F.concat_ws("/", "il", "isim")))), ",")
    return results.agg(F.count("*").alias("scanned"), F.count_if(hit).alias("found_count"), keys.alias("found"))


def found_keys(results: DataFrame, status: str = "status") -> DataFrame:
    """key: il/isim of what was found, distinct and sorted, a row each. For runs of any size, where run_report's list is one value."""
    return results.where(F.col(status) == "found").select(F.concat_ws("/", "il", "isim").alias("key")).distinct().orderBy("key")
