"""Shared pieces: text columns through Arrow in slices of bounded size, word hashes, scratch tables."""

from __future__ import annotations

import ctypes
import re
import uuid
from collections.abc import Callable, Iterator, Sequence
from functools import lru_cache
from sys import getsizeof

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import ArrayType, MapType, StructField, StructType, VariantType

#: Words of the corpus contracts: runs of anything but space and \t\n\v\f\r.
WORD = re.compile(r"[^\x20\x09-\x0D]+")
_BREAK = re.compile(r"[\x20\x09-\x0D]")
_BYTE_BREAK = re.compile(rb"[\x20\x09-\x0D]")

SLICE_BYTES = 2 << 20
PIECE_CHARS = 1 << 20
#: Bytes that a cache of words may hold, and the longest word that one keeps.
CACHE_BYTES = 16 << 20
LONG_WORD = 64


def lower_az(text: str) -> str:
    """Lower-cases A-Z only."""
    return text.lower() if text.isascii() else text.encode("utf-8", "surrogatepass").lower().decode("utf-8", "surrogatepass")


def pieces(text: str | bytes, size: int = PIECE_CHARS) -> Iterator:
    """Consecutive parts of about size characters or bytes, cut at white space so that no word is split.

    A run without white space stays whole, however long it is.
    """
    at, n, gap = 0, len(text), _BREAK if isinstance(text, str) else _BYTE_BREAK
    while n - at > size:
        cut = gap.search(text, at + size)
        if not cut:
            break
        yield text[at : cut.start()]
        at = cut.start()
    yield text[at:]


class Memo(dict):
    """key -> value of a function. Strings over LONG_WORD characters aren't kept.

    Once the values hold about most bytes they become the older ones, which are looked up but not added to, and the older ones
    before them are let go: what is asked for often stays, and 2 most bytes are held at most.
    """

    def __init__(self, fn: Callable, most: int = CACHE_BYTES):
        super().__init__()
        self.fn, self.most, self.held, self.older = fn, most, 0, {}

    def __missing__(self, key):
        value = self.older.get(key, self)
        if value is self:
            value = self.fn(key)
        if len(key) <= LONG_WORD:
            self.held += getsizeof(key) + getsizeof(value) + 100
            if self.held > self.most:
                self.older = dict(self)
                self.clear()
                self.held = 0
            self[key] = value
        return value


def word_hash(word: str | bytes) -> int:
    return xxhash.xxh3_64_intdigest(word.encode("utf-8", "surrogatepass") if isinstance(word, str) else word)


def release() -> None:
    """What a task's caches and buffers held goes back to the system: a worker lives on, with other tasks and stages."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (AttributeError, OSError):  # a C library without it
        pass


def freeing(run: Callable) -> Callable:
    """An Arrow function that releases memory when it ends."""

    def freed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from run(batches)
        finally:
            release()

    return freed


class ByteHash:
    """Hash of each word of UTF-8 text at once: sums of random numbers by byte, times a power of an odd base by place in the word.

    Words of over LONG_WORD bytes are hashed one by one, since sums of that kind are weak for long strings.
    """

    CHUNK = 1 << 18

    def __init__(self, seed: int = 20):
        draw = np.random.default_rng(seed)
        self.of_byte = draw.integers(0, 1 << 63, 256, np.uint64) * np.uint64(2) + np.uint64(1)
        self.space = np.zeros(256, bool)
        self.space[[32, *range(9, 14)]] = True
        self.of_byte[self.space] = 0
        base = 0x9E3779B97F4A7C15
        self.power = self._powers(base)
        self.inverse = self._powers(pow(base, -1, 1 << 64))

    def _powers(self, base: int) -> np.ndarray:
        out = np.full(self.CHUNK + 1, base, np.uint64)
        out[0] = 1
        return np.multiply.accumulate(out)

    def of(self, raw: bytes) -> np.ndarray:
        """The hashes of the words of raw, in order."""
        parts = [self._part(part) for part in pieces(raw, self.CHUNK // 2)]
        return parts[0] if len(parts) == 1 else np.concatenate(parts)

    def _part(self, raw: bytes) -> np.ndarray:
        n = len(raw)
        if n > self.CHUNK:  # a run without white space reaches over a chunk's end
            return np.array([word_hash(w) for w in raw.split()], np.uint64)
        data = np.frombuffer(raw, np.uint8)
        edges = np.flatnonzero(np.diff(self.space[data], prepend=True, append=True))
        starts, ends = edges[::2], edges[1::2]
        sums = np.zeros(n + 1, np.uint64)
        np.cumsum(self.of_byte[data] * self.power[:n], out=sums[1:])
        sizes = ends - starts
        out = mix((sums[ends] - sums[starts]) * self.inverse[starts] + sizes.astype(np.uint64))
        for i in np.flatnonzero(sizes > LONG_WORD).tolist():
            out[i] = word_hash(raw[starts[i] : ends[i]])
        return out


byte_hash = lru_cache(1)(ByteHash)


def mix(h: np.ndarray) -> np.ndarray:
    """A bijective scrambling of 64-bit values."""
    h = (h ^ (h >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    h = (h ^ (h >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return h ^ (h >> np.uint64(32))


def grams(h: np.ndarray, n: int) -> np.ndarray:
    """Hash of each window of n consecutive word hashes; none if there are fewer."""
    if len(h) < n:
        return h[:0]
    m = len(h) - n + 1
    out = h[:m].copy()
    for k in range(1, n):
        out *= np.uint64(0xD1342543DE82EF95)
        out += h[k : k + m]
    return mix(out)


def distinct(h: np.ndarray) -> np.ndarray:
    """Sorted, each value once."""
    s = np.sort(h)
    return s[np.concatenate([[True], s[1:] != s[:-1]])] if len(s) else s


def slices(batch: pa.RecordBatch, column: str, most: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Parts of the batch whose values in column have about most bytes; a longer value is a part of its own."""
    sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
    start, held = 0, 0
    for i, size in enumerate(sizes.tolist()):
        if i > start and held + size > most:
            yield batch.slice(start, i - start)
            start, held = i, 0
        held += size
    if start < batch.num_rows:
        yield batch.slice(start)


def map_texts(df: DataFrame, make: Callable[[], Callable[[list], Sequence]], fields: list[StructField], keys: Sequence[str] = ("doc_id",), text: str = "text") -> DataFrame:
    """keys and the columns that the function from make() derives from the values of one column.

    make runs once a task. Its function gets the values of a slice (nulls as None) and returns one list or array for each field.
    text may be one of keys, which are all returned. Only keys and text are read, so further columns, whatever their names, do no harm; a batch is worked on in slices of
    SLICE_BYTES, so memory doesn't follow the number of rows in a batch.
    """
    source = df.select(*keys) if text in keys else df.select(*keys, text)
    schema = StructType([source.schema[k] for k in keys] + fields)
    types = [f.type for f in to_arrow_schema(StructType(fields))]
    names = schema.fieldNames()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        work = make()
        for batch in batches:
            for part in slices(batch, text):
                out = work(part.column(text).to_pylist())
                made = [x if isinstance(x, pa.Array) else pa.array(x, t) for x, t in zip(out, types, strict=True)]
                yield pa.RecordBatch.from_arrays([*(part.column(k) for k in keys), *made], names)
            batch = part = out = made = None  # else they stay beside the next batch

    return source.mapInArrow(freeing(run), schema)


def shared_dir(spark: SparkSession) -> str:
    """The folder that all executors share, as spark.checkpoint.dir names it. Only a master on this machine alone can do without."""
    named = spark.sparkContext.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None)
    if not named and not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
        raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
    return named or "/tmp/checkpoints/priceloom"


class Scratch:
    """Tables written to the shared folder to cut lineage; drop() removes those that nothing reads any more."""

    def __init__(self, spark: SparkSession):
        self.spark, self.at = spark, {}

    def save(self, df: DataFrame, name: str, **more: Column) -> DataFrame:
        """df, written and read again. The rows are counted on the way, and `more` aggregates with them: see noted()."""
        path = f"{shared_dir(self.spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"
        seen = Observation()
        df.observe(seen, F.count(F.lit(1)).alias("rows"), *(c.alias(k) for k, c in more.items())).write.parquet(path)
        self.at[name] = path
        out = self.spark.read.schema(df.schema).parquet(path)
        out.noted_ = seen.get
        return out

    def drop(self, *names: str) -> None:
        jvm, conf = self.spark._jvm, self.spark._jsparkSession.sessionState().newHadoopConf()
        for name in names:
            path = jvm.org.apache.hadoop.fs.Path(self.at.pop(name))
            path.getFileSystem(conf).delete(path, True)


def noted(df: DataFrame) -> dict:
    """What save() counted of a table; nothing for other frames."""
    return df.__dict__.get("noted_", {})


def small(df: DataFrame, most: int, of: DataFrame | None = None, times: int = 1) -> DataFrame:
    """df marked for broadcast if it has at most `most` rows, else as it is.

    A saved table was counted when it was written. Another frame is counted, unless `of`, a saved table, has so few rows that
    df, at most `times` as many, fits in any case.
    """
    rows = noted(df).get("rows")
    if rows is None and of is not None and (bound := noted(of).get("rows")) is not None and bound * times <= most:
        return F.broadcast(df)
    if rows is None:
        rows = df.limit(most + 1).count()
    return F.broadcast(df) if rows <= most else df


class WordTable:
    """A row of small integers for each word, computed once while it is kept; emptied between pieces when about most bytes are held."""

    class _Rows(dict):
        def __init__(self, table: WordTable):
            super().__init__()
            self.table = table

        def __missing__(self, word: str) -> int:
            return self.table.add(word)

    def __init__(self, fn: Callable[[str], tuple], width: int, most: int = 2 * CACHE_BYTES):
        self.fn, self.most, self.held = fn, most, 0
        self.at = self._Rows(self)
        self.rows = np.zeros((1024, width), np.int64)

    def add(self, word: str) -> int:
        n = len(self.at)
        if n == len(self.rows):
            self.rows = np.concatenate([self.rows, np.zeros_like(self.rows)])
        self.rows[n] = self.fn(word)
        self.at[word] = n
        self.held += getsizeof(word) + 132 + self.rows.itemsize * self.rows.shape[1]
        return n

    def of(self, words: list[str]) -> np.ndarray:
        """The rows of the words, in order."""
        if self.held > self.most:
            self.at.clear()
            self.rows, self.held = self.rows[:1024].copy(), 0
        index = np.fromiter(map(self.at.__getitem__, words), np.int64, len(words))
        return self.rows[index]


def crc_mod(column: str, n: int):
    """crc32 of the value as text, modulo n; a null counts as the empty text."""
    return F.crc32(F.coalesce(F.col(column).cast("string"), F.lit("")).cast("binary")) % n


def labelled_sample(docs: DataFrame, labels: DataFrame, label: str, keep, rows: int, key: str = "doc_id", text: str = "text") -> DataFrame:
    """key, y and text of about `rows` labelled documents of each class among those that keep holds for.

    A document is drawn by a hash of its key against the share that its class allows, so reruns draw the same ones and the sample
    is bounded by the parameter whatever the input's size; a class with fewer is taken whole. Labels other than 0 and 1 and null
    keys are left out. Of repeated labels of a key the largest counts, of repeated documents the last text by code point.
    """
    y = labels.where(F.col(key).isNotNull() & F.col(label).isin(0, 1)).where(keep).groupBy(key).agg(F.max(label).cast("int").alias("y"))
    counts = {r["y"]: r["n"] for r in y.groupBy("y").agg(F.count("*").alias("n")).collect()}
    draw = F.pmod(F.xxhash64(F.lit("sample"), key), F.lit(1 << 30)) / float(1 << 30)
    share = F.coalesce(*[F.when(F.col("y") == c, F.lit(min(1.0, rows / n))) for c, n in counts.items()], F.lit(0.0))
    chosen = small(y.where(draw < share), 4 * rows)
    return docs.select(key, text).join(chosen, key).groupBy(key).agg(F.max("y").alias("y"), F.max(text).alias(text))


def row_key(docs: DataFrame) -> Column:
    """128 bits of hash over all columns of a row: equal for rows that are equal in all columns, nulls told apart from other values."""
    parts = []
    for field in docs.schema:
        c = docs[f"`{field.name}`"]
        nested = isinstance(field.dataType, ArrayType | MapType | StructType | VariantType)
        parts += [c.isNull(), F.to_json(F.struct(c.alias("c")), {"ignoreNullFields": "false"}) if nested else c]
    return F.struct(F.xxhash64(F.lit("a"), *parts).alias("a"), F.xxhash64(F.lit("b"), *parts).alias("b"))
