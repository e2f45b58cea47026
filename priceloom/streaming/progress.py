"""Progress of a stream as one small JSON file, written anew after every micro-batch."""

from __future__ import annotations

import json
from collections.abc import Callable
from datetime import UTC, datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQueryListener

from .buckets import Files


def record(held: dict, number: int, done: int, found: int) -> dict:
    """held with the counts of a batch: a batch counts once, with its last counts, in whatever order batches come.

    held is {} at first. Batches that have come without a gap from 0 on are kept as a sum up to the last but one, so it stays small.
    """
    through, base = held.get("through", -1), held.get("base", [0, 0])
    batches = {int(k): v for k, v in held.get("batches", {}).items()}
    if number > through:
        batches[number] = [done, found]
    while through + 1 in batches and through + 2 in batches:  # the last may still be run again
        through += 1
        base = [a + b for a, b in zip(base, batches.pop(through))]
    return {"through": through, "base": base, "batches": batches}


def counted(held: dict) -> tuple[int, int]:
    """done and found of all batches that were recorded."""
    own = [held.get("base", [0, 0]), *held.get("batches", {}).values()]
    return sum(x[0] for x in own), sum(x[1] for x in own)


class ProgressListener(StreamingQueryListener):
    """Writes updated_at, done, total and found to a file after each batch of the queries that observe(name) done and found.

    Counts come with Spark's own progress events: no batch is computed a second time for them. A batch whose event is delivered again, or
    after a later one's, counts once. Register it with spark.streams.addListener; marked() makes the observation.
    """

    def __init__(self, spark: SparkSession, path: str, total: int, name: str = "progress"):
        self.spark, self.total, self.name = spark, total, name
        folder, _, self.file = path.rpartition("/")
        self.files = Files(spark, folder)

    def marked(self, stream: DataFrame, found: str) -> DataFrame:
        return stream.observe(self.name, F.count(F.lit(1)).alias("done"), F.count_if(F.expr(found)).alias("found"))

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        row = event.progress.observedMetrics.get(self.name)
        if row is not None:
            self.add(event.progress.batchId, row["done"] or 0, row["found"] or 0)

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        pass

    def add(self, number: int, done: int, found: int) -> None:
        beside = f"{self.file}.batches"
        held = record(json.loads(self.files.read(beside)) if self.files.names(beside) else {}, number, done, found)
        self.files.write(beside, json.dumps(held))
        all_done, all_found = counted(held)
        self.files.write(self.file, json.dumps({"updated_at": datetime.now(UTC).isoformat(timespec="seconds"), "done": all_done, "total": self.total, "found": all_found}))

    def read(self) -> dict | None:
        return json.loads(self.files.read(self.file)) if self.files.names(self.file) else None


class ProgressSink:
    """foreachBatch target that calls another one, then overwrites path with updated_at, done, total and found.

    done counts rows, found those that the condition holds for. A second file, path with .batch, has the last batch and the counts
    before it, so a batch that is run again counts once, and counts go on after a restart.
    """

    def __init__(self, sink: Callable[[DataFrame, int], None], path: str, total: int, found: str):
        self.sink, self.path, self.total, self.found = sink, path, total, found

    def __call__(self, batch: DataFrame, number: int) -> None:
        self.sink(batch, number)
        spark = batch.sparkSession
        last = self.read(spark, ".batch") or {"batch": None, "before": [0, 0], "after": [0, 0]}
        before = last["before" if last["batch"] == number else "after"]
        row = batch.agg(F.count("*").alias("done"), F.count_if(F.expr(self.found)).alias("found")).first()
        after = [before[0] + row["done"], before[1] + row["found"]]
        self.write(spark, {"batch": number, "before": before, "after": after}, ".batch")
        self.write(spark, {"updated_at": datetime.now(UTC).isoformat(timespec="seconds"), "done": after[0], "total": self.total, "found": after[1]})

    def _file(self, spark: SparkSession, of: str):
        path = spark._jvm.org.apache.hadoop.fs.Path(self.path + of)
        return path, path.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf())

    def read(self, spark: SparkSession, of: str = "") -> dict | None:
        path, files = self._file(spark, of)
        return json.loads(spark.read.text(self.path + of, wholetext=True).first()[0]) if files.exists(path) else None

    def write(self, spark: SparkSession, said: dict, of: str = "") -> None:
        path, files = self._file(spark, of)
        out = files.create(path, True)
        out.write(bytearray(json.dumps(said).encode()))
        out.close()
