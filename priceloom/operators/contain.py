"""Containment joins: which of many patterns occur in which texts, without comparing each with each."""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..sources.documents import written

#: Patterns, and characters of them, up to which every task gets all of them as one automaton; about 60 bytes a character.
AUTOMATON_ROWS, AUTOMATON_CHARS = 200_000, 4_000_000
#: Bits, as a power of two, up to which the filter of patterns beyond that grows: 16 MB in each task.
FILTER_BITS = 27


def contained(texts: DataFrame, patterns: DataFrame) -> DataFrame:
    """key and pattern for each pattern (distinct, column pattern) that a text (key, text) contains, once for a text.

    Empty and null patterns and texts meet nothing. While the patterns are few, by a count of rows and characters, each task searches
    its texts with an automaton of all of them, in time that follows the text and its hits. Beyond that, the texts' substrings that
    pass a filter of the patterns' hashes meet the patterns by shuffle (contained_by_hash).
    """
    ranked = patterns.select("pattern", F.lit(0).cast("long").alias("weight"), F.lit(0).cast("long").alias("ord"))
    return _found(texts.select("key", "text"), ranked, best=False).select("key", "pattern")


def best_contained(texts: DataFrame, patterns: DataFrame) -> DataFrame:
    """key, pattern, weight and ord of the best pattern that each text (key, text) contains: the largest weight, of equal ones the smallest ord.

    patterns has pattern (each once), weight and ord. They meet as in contained; a text without any has no row, and texts of one key
    count together.
    """
    ranked = patterns.select("pattern", *[F.col(c).cast("long").alias(c) for c in ("weight", "ord")])
    found = _found(texts.select("key", "text"), ranked, best=True)
    best = found.groupBy("key").agg(F.max_by(F.struct("pattern", "weight", "ord"), F.struct("weight", -F.col("ord"))).alias("best"))
    return best.select("key", "best.*")


def first_listed(df: DataFrame, pattern: Column, weight: int, place: str = "ord") -> DataFrame:
    """pattern, its weight (its length and `weight`) and ord: each pattern once, with its smallest ord; none that are empty or null."""
    once = df.select(pattern.alias("pattern"), F.col(place).alias("ord")).where("pattern <> ''").groupBy("pattern").agg(F.min("ord").alias("ord"))
    return once.withColumn("weight", F.length("pattern") + weight)


def _found(texts: DataFrame, patterns: DataFrame, best: bool) -> DataFrame:
    texts, patterns = texts.where("text <> ''"), patterns.where("pattern <> ''")
    size = patterns.limit(AUTOMATON_ROWS + 1).agg(F.count("*").alias("rows"), F.coalesce(F.sum(F.length("pattern")), F.lit(0)).alias("chars")).first()
    few = size["rows"] <= AUTOMATON_ROWS and size["chars"] <= AUTOMATON_CHARS
    return _searched(texts, patterns, best) if few else contained_by_hash(texts, patterns)


@lru_cache(2)
def _automaton(patterns) -> ahocorasick.Automaton:
    """The automaton of a broadcast list of (pattern, weight, ord), with the pattern's place in the list as value; once for a worker."""
    found = ahocorasick.Automaton()
    for place, (pattern, _, _) in enumerate(patterns.value):
        found.add_word(pattern, place)
    found.make_automaton()
    return found


def _searched(texts: DataFrame, patterns: DataFrame, best: bool) -> DataFrame:
    """The patterns in each text by the automaton: the best one, or each once."""
    listed = [tuple(r) for r in patterns.collect()]  # bounded by AUTOMATON_ROWS and AUTOMATON_CHARS
    schema = f"key {texts.schema['key'].dataType.simpleString()}, pattern string, weight long, ord long"
    if not listed:
        return texts.sparkSession.createDataFrame([], schema)
    shared = texts.sparkSession.sparkContext.broadcast(listed)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        automaton, patterns = _automaton(shared), shared.value
        better = lambda place: (patterns[place][1], -patterns[place][2])
        for batch in batches:
            rows, places = [], []
            for i, said in enumerate(batch.column(1).to_pylist()):
                found = {place for _, place in automaton.iter(said)}
                found = [max(found, key=better)] if best and found else found
                rows += [i] * len(found)
                places += found
            made = [pa.array([patterns[p][k] for p in places], kind) for k, kind in enumerate((pa.string(), pa.int64(), pa.int64()))]
            yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(rows, pa.int64())), *made], ["key", "pattern", "weight", "ord"])

    return texts.mapInArrow(run, schema)


def _mixed(h: np.ndarray) -> np.ndarray:
    for _ in range(2):
        h = (h ^ (h >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return h ^ (h >> np.uint64(32))


@lru_cache(1)
def _powers(base: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    """The powers of an odd base from 0 to n, and of its inverse, modulo 2^64."""
    made = []
    for b in (base, pow(base, -1, 1 << 64)):
        out = np.full(n + 1, b, np.uint64)
        out[0] = 1
        made.append(np.multiply.accumulate(out))
    return made[0], made[1]


class Substrings:
    """Hashes of all substrings of a text that have one length, by sums of code points times powers of an odd base."""

    def __init__(self, text: str):
        points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
        self.n = len(points)
        powers, self.inverse = _powers(0x9E3779B97F4A7C15, max(1 << 13, 1 << self.n.bit_length()))
        self.sums = np.zeros(self.n + 1, np.uint64)
        np.cumsum(_mixed(points.astype(np.uint64) + np.uint64(1)) * powers[: self.n], out=self.sums[1:])

    def of(self, size: int) -> np.ndarray:
        last = self.n - size + 1
        return _mixed((self.sums[size:] - self.sums[:last]) * self.inverse[:last] + np.uint64(size)) if last > 0 else self.sums[:0]


def _hash(pattern: str) -> int:
    return int(Substrings(pattern).of(len(pattern)).view(np.int64)[0])


class Filter:
    """Which hashes may be a pattern's: two bits of 2^bits for each pattern, and the lengths of patterns.

    The driver gets the words of 64 bits that aren't empty, 16 bytes each: 2^21 rows at most. With more than about 2^25 patterns
    more substrings pass that are none, which the join drops.
    """

    def __init__(self, patterns: DataFrame, rows: int):
        self.bits = min(FILTER_BITS, max(16, (16 * rows).bit_length()))
        hashed = patterns.mapInArrow(_hash_patterns, "size long, h long")
        self.sizes = sorted(r["size"] for r in hashed.select("size").distinct().collect())
        cells = [F.shiftrightunsigned("h", 64 - self.bits), F.col("h").bitwiseAND((1 << self.bits) - 1)]
        set_ = hashed.select(F.explode(F.array(*cells)).alias("cell"))
        word = F.expr("shiftleft(1L, cast(cell & 63 AS int))")
        words = set_.groupBy(F.shiftright("cell", 6).alias("at")).agg(F.bit_or(word).alias("word")).toArrow()
        held = np.zeros(1 << (self.bits - 6), np.int64)
        held[words.column("at").to_numpy()] = words.column("word").to_numpy()
        self.words = held.view(np.uint64)

    def may(self, h: np.ndarray) -> np.ndarray:
        """Places of the hashes that pass."""
        at = np.flatnonzero(self._set(h >> np.uint64(64 - self.bits)))
        return at[self._set(h[at] & np.uint64((1 << self.bits) - 1))]

    def _set(self, cells: np.ndarray) -> np.ndarray:
        return (self.words[(cells >> np.uint64(6)).astype(np.int64)] >> (cells & np.uint64(63))) & np.uint64(1) == 1


def _hash_patterns(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        said = batch.column("pattern").to_pylist()
        yield pa.RecordBatch.from_arrays([pa.array([len(x) for x in said], pa.int64()), pa.array([_hash(x) for x in said], pa.int64())], ["size", "h"])


def contained_by_hash(texts: DataFrame, patterns: DataFrame) -> DataFrame:
    """key, pattern, weight and ord for every pattern in every text (key, text), once for a text, by shuffle.

    The substrings of a text that have a pattern's length and a pattern's hash, by a filter that each task gets, meet the patterns as
    whole strings: nearly all rows that are shuffled are results, however many patterns share a piece. Hashes cost the text's
    length for each different length of patterns.
    """
    patterns = written(patterns, "patterns")
    shared = texts.sparkSession.sparkContext.broadcast(Filter(patterns.select("pattern"), patterns.count()))
    schema = f"key {texts.schema['key'].dataType.simpleString()}, pattern string"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = shared.value
        for batch in batches:
            for first in range(0, batch.num_rows, 256):
                part = batch.slice(first, 256)
                index, found = [], []
                for i, said in enumerate(part.column("text").to_pylist()):
                    made = Substrings(said)
                    own = {said[at : at + size] for size in known.sizes if size <= made.n for at in known.may(made.of(size)).tolist()}
                    index += [i] * len(own)
                    found += own
                yield pa.RecordBatch.from_arrays([part.column("key").take(pa.array(index, pa.int64())), pa.array(found, pa.string())], ["key", "pattern"])

    return texts.select("key", "text").mapInArrow(run, schema).join(patterns, "pattern").select("key", "pattern", "weight", "ord")
