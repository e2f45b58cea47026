"""Facility masters, tariff documents and page tables as DataFrames with explicit schemas."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

FACILITY = "tesisler array<struct<il:string,isim:string,tip:string>>"
ENTRY = "il string, isim string, fiyat_sivil string, fiyat_kamu_personeli string, fiyat_kurum_personeli string, kaynak string, gecerlilik string"
PAGE = "url string, html string, status int, err string"


def shared_dir(spark: SparkSession) -> str:
    """The folder that all executors share, as spark.checkpoint.dir names it. Only a master on this machine alone can do without."""
    named = spark.sparkContext.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None)
    master = spark.sparkContext.master
    if not named and (not master.startswith("local") or master.startswith("local-cluster")):
        raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
    return named or "/tmp/checkpoints/priceloom"


def written(df: DataFrame, name: str) -> DataFrame:
    """df, written to a new place in the shared folder and read again: what follows reads it instead of computing it anew."""
    path = f"{shared_dir(df.sparkSession).rstrip('/')}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def small(df: DataFrame, most: int) -> DataFrame:
    """df marked for broadcast if it has at most `most` rows, by a count, else as it is."""
    return F.broadcast(df) if df.limit(most + 1).count() <= most else df


class Rounds:
    """Tables round0, round1, ... in a folder, each written once and whole; a round that broke off is written anew."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder.rstrip("/")

    def done(self) -> int:
        """How many rounds are whole."""
        jvm, conf = self.spark._jvm, self.spark._jsparkSession.sessionState().newHadoopConf()
        found = jvm.org.apache.hadoop.fs.Path(f"{self.folder}/round*/_SUCCESS")
        return len(found.getFileSystem(conf).globStatus(found) or [])

    def add(self, df: DataFrame, number: int) -> None:
        df.write.mode("overwrite").parquet(f"{self.folder}/round{number}")

    def read(self, number: int) -> DataFrame:
        """The rows of the first `number` rounds, one at least."""
        return self.spark.read.parquet(*[f"{self.folder}/round{k}" for k in range(number)])


def spread(df: DataFrame, rows: int | None = None) -> DataFrame:
    """df in as many partitions as there are cores, if it has fewer: for costly work on small files, which one task would read.

    With rows, in as many more as leave about that many rows, which are counted, to a task: so no task grows with the input.
    """
    least = df.sparkSession.sparkContext.defaultParallelism
    if rows:
        least = max(least, -(-df.count() // rows))
    return df.repartition(least) if df.rdd.getNumPartitions() < least else df


def facilities(spark: SparkSession, paths: list[str], required: bool = True) -> DataFrame:
    """ord, il, isim and tip of the first of the paths that exists; ord is the place in its list."""
    hadoop = spark._jvm.org.apache.hadoop.fs.Path
    conf = spark._jsparkSession.sessionState().newHadoopConf()
    found = next((p for p in paths if hadoop(p).getFileSystem(conf).exists(hadoop(p))), None)
    if found is None:
        raise FileNotFoundError(", ".join(paths))
    rows = spark.read.schema(FACILITY).json(found, multiLine=True)
    listed = F.col("tesisler") if required else F.coalesce("tesisler", F.array().cast("array<struct<il:string,isim:string,tip:string>>"))
    return rows.select(F.posexplode(listed).alias("ord", "f")).select("ord", "f.*")


def tariff_document(spark: SparkSession, path: str | None) -> DataFrame:
    """Rows of a tariff document; none without a path."""
    if path is None:
        return spark.createDataFrame([], ENTRY)
    columns = [c.split()[0] for c in ENTRY.split(", ")]
    kind = f"not string, tesisler array<struct<{','.join(f'{c}:string' for c in columns)}>>"
    return spark.read.schema(kind).json(path, multiLine=True).select(F.inline("tesisler"))


def live_pages(pages: DataFrame) -> DataFrame:
    """Pages that were fetched: status under 400, a body, and no PDF."""
    return pages.where("html IS NOT NULL AND coalesce(status, 200) < 400 AND NOT lower(url) LIKE '%.pdf'")


def url_list(*lists: DataFrame) -> DataFrame:
    """Ordered union of (url, ord) lists without repeats: earlier lists first, within them by ord; ord is dealt anew per list."""
    ranked = [d.select("url", F.lit(i).alias("src"), F.col("ord").cast("long").alias("ord")) for i, d in enumerate(lists)]
    both = ranked[0]
    for r in ranked[1:]:
        both = both.unionByName(r)
    return both.groupBy("url").agg(F.min(F.struct("src", "ord")).alias("first")).select("url", "first.src", "first.ord")
