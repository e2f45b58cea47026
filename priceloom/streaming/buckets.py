"""State in key buckets: a batch rewrites the buckets that its keys fall in, and a manifest says which version of each bucket counts."""

from __future__ import annotations

import json
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.upsert import upsert


class Files:
    """Small files of a folder in any store that Spark reaches."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder.rstrip("/")
        self._path = spark._jvm.org.apache.hadoop.fs.Path
        self._fs = self._path(self.folder).getFileSystem(spark._jsparkSession.sessionState().newHadoopConf())

    def names(self, pattern: str) -> list[str]:
        """Names in the folder that fit a pattern, without their folder."""
        found = self._fs.globStatus(self._path(f"{self.folder}/{pattern}")) or []
        return [f.getPath().getName() for f in found]

    def read(self, name: str) -> str:
        return self.spark.read.text(f"{self.folder}/{name}", wholetext=True).first()[0]

    def write(self, name: str, said: str) -> None:
        """Writes beside and renames, so that a file is there whole or not at all."""
        beside, place = self._path(f"{self.folder}/_{name}"), self._path(f"{self.folder}/{name}")
        out = self._fs.create(beside, True)
        out.write(bytearray(said.encode()))
        out.close()
        self._fs.delete(place, False)
        if not self._fs.rename(beside, place):
            raise OSError(f"{name} can't be written")

    def delete(self, name: str) -> None:
        self._fs.delete(self._path(f"{self.folder}/{name}"), True)


class BucketState:
    """Rows by key in a folder: data/v<batch>/bucket_=<n> holds a bucket as a batch left it, manifest-<batch> which version of each counts.

    A batch of any number is merged with the state of the newest manifest below its own, and reads and writes the buckets of its own keys only.
    So bytes written follow the batch, not the state; a batch that is run again writes what it wrote before, and a restart goes on from the
    newest manifest. A manifest is written when its data are whole. Versions that the last `keep` manifests don't name are removed.
    Null keys are keys like others. With order the last row of a key by it wins, else that of the batch.
    """

    def __init__(self, spark: SparkSession, folder: str, keys: list[str], order: str | None = None, schema: str | None = None, buckets: int = 64, keep: int = 2):
        self.spark, self.keys, self.order, self.schema, self.buckets, self.keep = spark, keys, order, schema, buckets, keep
        self.files = Files(spark, folder)

    def manifest(self, below: int | None = None) -> dict:
        """The newest manifest, below a batch's number if one is given: its number, the version of each bucket, and what `more` said."""
        numbers = [int(n.split("-")[1]) for n in self.files.names("manifest-*")]
        newest = max((n for n in numbers if below is None or n < below), default=None)
        return {"number": -1, "buckets": {}, "more": {}} if newest is None else json.loads(self.files.read(f"manifest-{newest}"))

    def _rows(self, versions: dict, schema) -> DataFrame:
        places = [f"{self.files.folder}/data/v{v}/bucket_={b}" for b, v in versions.items()]
        return self.spark.read.schema(schema).parquet(*places) if places else self.spark.createDataFrame([], schema)

    def merge(self, batch: DataFrame, number: int, more: dict | None = None) -> int:
        """Merges a batch; returns how many buckets were written. more is kept with the manifest."""
        before = self.manifest(number)
        of_key = F.pmod(F.xxhash64(*self.keys), F.lit(self.buckets)).cast("int")
        touched = [str(r[0]) for r in batch.select(of_key).distinct().collect()]  # as many as there are buckets at most
        if touched:
            old = self._rows({b: v for b, v in before["buckets"].items() if b in touched}, batch.schema)
            if self.order:  # a row of the state that is later by order stays
                merged = upsert(batch.limit(0), old.unionByName(batch), self.keys, self.order)
            else:
                merged = upsert(old, batch, self.keys)
            dealt = merged.withColumn("bucket_", of_key).repartition(len(touched), "bucket_")
            dealt.write.mode("overwrite").partitionBy("bucket_").parquet(f"{self.files.folder}/data/v{number}")
        made = {"number": number, "buckets": before["buckets"] | dict.fromkeys(touched, number), "more": more or {}}
        self.files.write(f"manifest-{number}", json.dumps(made))
        self._clean()
        return len(touched)

    __call__ = merge

    def _clean(self) -> None:
        """Removes what no manifest that stays names: whole versions, and buckets of versions that are named in part."""
        numbers = sorted(int(n.split("-")[1]) for n in self.files.names("manifest-*"))
        for n in numbers[: -self.keep]:
            self.files.delete(f"manifest-{n}")
        named = {(v, b) for n in numbers[-self.keep :] for b, v in json.loads(self.files.read(f"manifest-{n}"))["buckets"].items()}
        for version in (int(n[1:]) for n in self.files.names("data/v*")):
            if version > numbers[-1]:
                continue  # another batch is at it
            own = {b for v, b in named if v == version}
            if not own:
                self.files.delete(f"data/v{version}")
            else:
                for bucket in {n.split("=")[1] for n in self.files.names(f"data/v{version}/bucket_=*")} - own:
                    self.files.delete(f"data/v{version}/bucket_={bucket}")

    def result(self) -> DataFrame:
        """All rows; before any batch none, with the schema if one was given."""
        versions = self.manifest()["buckets"]
        if not versions:
            return self.spark.createDataFrame([], self.schema or "none int")
        first = next(iter(versions.items()))
        schema = self.schema or self.spark.read.parquet(f"{self.files.folder}/data/v{first[1]}/bucket_={first[0]}").schema
        return self._rows(versions, schema)


def run_available(stream: DataFrame, sink: Callable[[DataFrame, int], object], checkpoint: str) -> None:
    """Runs the stream over all that is there, in micro-batches, and waits."""
    call = lambda batch, number: sink(batch, number) and None
    stream.writeStream.foreachBatch(call).option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()


def flush_counts(hits: DataFrame, keys: list[str], every: int = 3) -> DataFrame:
    """keys, n and flushes: how often a run of its own for each key would have flushed its hits before its end."""
    return hits.groupBy(*keys).agg(F.count("*").alias("n"), F.expr(f"count(*) div {every}").alias("flushes"))


class FlushSink:
    """foreachBatch target that merges hits into a BucketState whenever `every` more of them have come in, over all batches.

    Hits are rows that the condition holds for, in the order of the state's order column (unique). Those since the last flush, under
    `every`, wait in the folder; finish merges them too, as a run does at its end. How many hits were seen, and how many flushes they
    make, goes on over batches and restarts; a batch that is run again counts once.
    """

    def __init__(self, state: BucketState, hit: str, every: int = 3):
        if not state.order:
            raise ValueError("hits are counted in the order of a column")
        self.state, self.hit, self.every = state, hit, every

    def _waiting(self, number: int, schema) -> DataFrame:
        spark, files = self.state.spark, self.state.files
        return spark.read.schema(schema).parquet(f"{files.folder}/waiting/v{number}") if files.names(f"waiting/v{number}/_SUCCESS") else spark.createDataFrame([], schema)

    def __call__(self, batch: DataFrame, number: int) -> None:
        before = self.state.manifest(number)
        waiting = self._waiting(before["number"], batch.schema)
        hits = batch.where(self.hit)
        both = waiting.unionByName(hits)
        seen = before["more"].get("hits", 0) + hits.count()
        over = seen % self.every
        last = both.orderBy(F.desc(self.state.order)).limit(over)
        last.write.mode("overwrite").parquet(f"{self.state.files.folder}/waiting/v{number}")
        held = self._waiting(number, batch.schema)
        flushed = both.join(F.broadcast(held.select(self.state.order)), self.state.order, "left_anti")  # under `every` rows
        self.state.merge(flushed.select(batch.columns), number, {"hits": seen, "flushes": seen // self.every})
        for old in self.state.files.names("waiting/v*"):
            if int(old[1:]) < before["number"]:
                self.state.files.delete(f"waiting/{old}")

    def finish(self) -> None:
        """Merges the hits that still wait."""
        newest = self.state.manifest()
        if newest["number"] >= 0:
            waiting = self._waiting(newest["number"], self.state.result().schema if newest["buckets"] else self.state.schema)
            self.state.merge(waiting, newest["number"] + 1, newest["more"])

    def counts(self) -> dict:
        """hits seen and flushes made so far."""
        return {"hits": 0, "flushes": 0} | self.state.manifest()["more"]
