"""N-gram Jaccard join: universe partitions by size band, one-deletion neighbourhoods where exact segments aren't enough."""

from __future__ import annotations

from dataclasses import dataclass
from functools import lru_cache, partial
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import ArrayType, BinaryType, IntegerType, LongType, StructField, StructType

from .arrow import Scratch, byte_hash, distinct, freeing, grams, map_texts, mix, noted, row_key, slices, small

#: Members outside a bucket's largest component up to which the pairs between components are listed; more make it crowded.
BUCKET = 32
#: Rows of ids, components or keys up to which they are broadcast, about 8 MB; beyond, the tables are joined by shuffle.
BROADCAST_ROWS = 200_000
#: Members that are verified against one copy of their pivot's set in one group.
GROUP = 200
#: Crowded keys up to which they are sent to the executors, 8 bytes each; beyond, each document gets those among its own keys by a join.
CROWDED = 200_000
#: One document in so many is looked at for keys that very many have: those are dealt over several tasks. Results don't depend on it.
SAMPLE = 64
#: Share of a partition's segments that may get one-deletion neighbourhoods; documents that need more are taken by counted shingles.
REACH = 0.1
#: Sketches of counts that one task adds up.
FAN = 16
#: 64-bit words of the bitmaps that bound the differences of two documents from below: in rows of counted shingles, and in rows of
#: neighbourhoods and for pairs. Bits of a set must be few among them, or sets that differ by little more than they may seem close.
SKETCH, WIDE = 8, 64
#: Low bits of a key that hold its partition.
PARTITION_BITS = 8


@lru_cache(8)
def _bounds(num: int) -> tuple[int, ...]:
    """Upper ends (exclusive) of the size bands: each is a fourth wider than the one before, and sizes from 1 to 3 stand alone."""
    out = [2]
    while out[-1] < 1 << 40:
        out.append(max(out[-1] + 1, out[-1] * 5 // 4))
    return tuple(out)


@dataclass(frozen=True)
class Partition:
    """How sets of one band, and larger ones that can be similar to them, are cut: by hash of the elements into segments.

    Similar sets differ in at most `differences` elements together, so at least `spare` of the segments are equal.
    """

    number: int
    differences: int
    segments: int

    @property
    def spare(self) -> int:
        return self.segments - self.differences


@lru_cache(4096)
def partition(number: int, num: int) -> Partition:
    """num: similarity in hundredths. With sizes x <= y <= 100 x / num, sets differ in (x + y)(100 - num) / (100 + num) at most."""
    x = _bounds(num)[number] - 1
    differences = (x + x * 100 // num) * (100 - num) // (100 + num)
    return Partition(number, differences, 1 if not differences else differences + 2 + round(0.12 * differences))


def partitions_of(n: int, num: int) -> list[Partition]:
    """The partitions that a set of n elements takes part in: its own band's, as the smaller, and those below that reach it."""
    bounds = _bounds(num)
    own = int(np.searchsorted(bounds, n, "right"))
    out = []
    for b in range(own, -1, -1):
        if (bounds[b] - 1) * 100 < num * n:
            break
        out.append(partition(b, num))
    return out


def shingles(text: str | None, width: int) -> np.ndarray:
    """Sorted distinct hashes of the text's shingles; of all its words as one if it has fewer than width; none without words."""
    h = byte_hash().of((text or "").encode("utf-8", "surrogatepass").lower())  # bytes lower-case A-Z alone
    return distinct(grams(h, min(width, len(h)))) if len(h) else h


class Segments:
    """A set cut by one partition: the key of each segment's content, and the number of its elements."""

    def __init__(self, s: np.ndarray, p: Partition):
        scrambled = mix(s ^ np.uint64(0x5851F42D4C957F2D + p.number))
        self.p = p
        self.at = (scrambled % np.uint64(p.segments)).astype(np.int64)
        self.values = mix(scrambled)
        self.sizes = np.bincount(self.at, minlength=p.segments)
        self.sums = np.zeros(p.segments, np.uint64)
        np.add.at(self.sums, self.at, self.values)

    def key(self, segment: np.ndarray, sums: np.ndarray) -> np.ndarray:
        salt = segment.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) + np.uint64(self.p.number * 0x2545F4914F6CDD1D % 2**64)
        h = mix(mix(sums) + salt)
        return ((h >> np.uint64(PARTITION_BITS) << np.uint64(PARTITION_BITS)) | np.uint64(self.p.number)).astype(np.int64)

    def exact(self, empty: bool = False) -> tuple[np.ndarray, np.ndarray]:
        """Numbers and keys of the segments, those without elements only if asked for."""
        chosen = np.arange(self.p.segments) if empty else np.flatnonzero(self.sizes)
        return chosen, self.key(chosen, self.sums[chosen])

    def deletions(self, segments: np.ndarray) -> np.ndarray:
        """Keys of what is left of the given segments when any one element is taken out."""
        wanted = np.zeros(self.p.segments, bool)
        wanted[segments] = True
        out = wanted[self.at]
        return self.key(self.at[out], self.sums[self.at[out]] - self.values[out])


def _schema(df: DataFrame, key: str, *more: tuple) -> StructType:
    return StructType([StructField("rep", df.schema[key].dataType)] + [StructField(n, t) for n, t in more])


def _signatures(df: DataFrame, key: str, text: str, width: int, num: int, hot=None) -> DataFrame:
    """key, lane, rep, n: a row for each segment with elements, and for each document one with n = its number of shingles + 1.

    A segment's -n is how many of such keys a similar set must share at least: those that its partition spares, less the
    document's empty ones; 0 if they are as many or more. The keys of the other rows mean nothing. lane is 0 but for the hot keys
    (sorted, broadcast), whose rows are dealt over lanes from 1 on.
    """
    schema = StructType([StructField("key", LongType()), StructField("lane", IntegerType()), *_schema(df, key), StructField("n", LongType())])

    def run(batches):
        for batch in batches:
            for part in slices(batch, text):
                keys, index, ns = [], [], []
                for i, value in enumerate(part.column(text).to_pylist()):
                    s = shingles(value, width)
                    for p in partitions_of(len(s), num) if len(s) else ():
                        chosen, made = Segments(s, p).exact()
                        keys.append(made)
                        index.append(np.full(len(made), i, np.int32))
                        ns.append(np.full(len(made), min(0, p.segments - len(chosen) - p.spare)))
                    keys.append(mix(s.sum(dtype=np.uint64, keepdims=True) + np.uint64(i)).astype(np.int64))
                    index.append(np.array([i], np.int32))
                    ns.append(np.array([len(s) + 1]))
                if keys:
                    at, found = np.concatenate(index), np.concatenate(keys)
                    lanes = np.zeros(len(found), np.int32)
                    if hot is not None and len(hot.value):
                        lanes[_in(found, hot.value)] = 1
                        lanes *= 1 + mix(at.astype(np.uint64) + found.astype(np.uint64)).astype(np.int32) % 509
                    ids = part.column(key).take(pa.array(at))
                    yield pa.RecordBatch.from_arrays([pa.array(found), pa.array(lanes), ids, pa.array(np.concatenate(ns))], schema.fieldNames())

    return df.select(key, text).mapInArrow(freeing(run), schema)


def _sets(df: DataFrame, key: str, text: str, groups: str, width: int) -> DataFrame:
    """pivot, salt, member (whether the row isn't the pivot's own), rep, shingles: a row for each of the document's groups."""
    id_type = df.schema[key].dataType
    schema = StructType([StructField("pivot", id_type), StructField("salt", LongType()), StructField("member", LongType()), StructField("rep", id_type), StructField("shingles", BinaryType())])
    names, kinds = schema.fieldNames(), [f.type for f in to_arrow_schema(schema)]

    def run(batches):
        for batch in batches:
            for part in slices(batch, text):
                rows = []
                for rep, value, held in zip(part.column(key).to_pylist(), part.column(text).to_pylist(), part.column(groups).to_pylist()):
                    raw = shingles(value, width).tobytes()
                    rows += [(g["pivot"], g["salt"], g["member"], rep, raw) for g in held]
                for i in range(0, len(rows), 512):
                    yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*rows[i : i + 512]), kinds)], names)

    return df.select(key, text, groups).mapInArrow(freeing(run), schema)


def similar(a: np.ndarray, b: np.ndarray, num: int) -> bool:
    """Whether two sorted sets have at least num hundredths of their union in common; empty ones never do."""
    least, most = sorted((len(a), len(b)))
    if not least or least * 100 < num * most:
        return False
    same = int((a[np.minimum(np.searchsorted(a, b), len(a) - 1)] == b).sum())
    return 100 * same >= num * (len(a) + len(b) - same)


def _verify(sets: DataFrame, num: int) -> DataFrame:
    """a, b of the groups' pivots and members whose sets are similar; rows come sorted with pivots first, one set is held at a time."""
    id_type = sets.schema["rep"].dataType
    schema = StructType([StructField("a", id_type), StructField("b", id_type)])
    kind = to_arrow_schema(schema)[0].type

    def run(batches):
        now, pivots = None, []
        for batch in batches:
            a, b = [], []
            for pivot, salt, member, rep, raw in zip(*(batch.column(c).to_pylist() for c in ("pivot", "salt", "member", "rep", "shingles"))):
                if (pivot, salt) != now:
                    now, pivots = (pivot, salt), []
                s = np.frombuffer(raw, np.uint64)
                if not member:
                    pivots.append(s)
                elif any(similar(p, s, num) for p in pivots):
                    a.append(pivot)
                    b.append(rep)
            yield pa.RecordBatch.from_arrays([pa.array(a, kind), pa.array(b, kind)], ["a", "b"])

    return sets.mapInArrow(freeing(run), schema)


def _bitmap(s: np.ndarray, words: int) -> list[int]:
    """Sets that differ in d elements have bitmaps that differ in d bits at most."""
    bits = np.zeros(64 * words, np.uint8)
    bits[(mix(s) % np.uint64(64 * words)).astype(np.int64)] = 1
    return np.packbits(bits).view(np.int64).tolist()


def _bitmaps(width: int):
    def make(texts: list) -> list:
        sets = [shingles(x, width) for x in texts]
        return [[len(s) for s in sets], [_bitmap(s, WIDE) for s in sets]]

    return make


def likely(pairs: DataFrame, docs: DataFrame, key: str, text: str, width: int, num: int, scratch: Scratch, name: str) -> DataFrame:
    """The pairs (a, b) that sizes and bitmaps of the documents don't rule out."""
    ids = pairs.select(F.col("a").alias("rep")).unionByName(pairs.select(F.col("b").alias("rep"))).distinct()
    texts = docs.select(F.col(key).alias("rep"), F.col(text).alias("text")).join(small(ids, BROADCAST_ROWS, pairs, 2), "rep")
    maps = map_texts(texts, partial(_bitmaps, width), [StructField("size", LongType()), StructField("map", ArrayType(LongType()))], ("rep",)).dropDuplicates(["rep", "map"])
    maps = small(scratch.save(maps, f"{name}-maps"), BROADCAST_ROWS // 16)
    of = lambda side: maps.select(F.col("rep").alias(side), F.col("size").alias(f"size_{side}"), F.col("map").alias(f"map_{side}"))
    differ = F.aggregate(F.zip_with("map_a", "map_b", lambda x, y: F.bit_count(x.bitwiseXOR(y))), F.lit(0), lambda x, y: x + y)
    close = differ * (100 + num) <= (F.col("size_a") + F.col("size_b")) * (100 - num)
    of_a, of_b = (F.broadcast(of(c)) if noted(maps).get("rows", BROADCAST_ROWS) <= BROADCAST_ROWS // 16 else of(c) for c in "ab")
    return scratch.save(pairs.join(of_a, "a").join(of_b, "b").where(close).select("a", "b").distinct(), f"{name}-likely")


def verified(pairs: DataFrame, docs: DataFrame, key: str, text: str, width: int, num: int, scratch: Scratch, name: str) -> DataFrame:
    """The pairs (a, b), distinct, whose whole texts are similar. A pivot a of many pairs is copied to a group for each GROUP of them."""
    sizes = pairs.groupBy("a").agg(F.count("*").alias("members"))
    dealt = pairs.join(sizes, "a").withColumn("groups", F.ceil(F.col("members") / GROUP))
    dealt = dealt.select("a", "b", F.pmod(F.xxhash64("b"), F.col("groups")).alias("salt"))
    group = lambda pivot, member: F.struct(F.col("a").alias("pivot"), F.col("salt"), F.lit(member).cast("long").alias("member"))
    rows = dealt.select(F.col("b").alias("rep"), group("a", 1).alias("g")).unionByName(dealt.select(F.col("a").alias("rep"), group("a", 0).alias("g")))
    need = scratch.save(rows.groupBy("rep").agg(F.collect_set("g").alias("groups")), f"{name}-need")
    texts = docs.select(F.col(key).alias("rep"), F.col(text).alias("text")).join(small(need, BROADCAST_ROWS // 4), "rep")
    sets = _sets(texts, "rep", "text", "groups", width)
    met = sets.repartition("pivot", "salt").sortWithinPartitions("pivot", "salt", "member")
    return scratch.save(_verify(met, num).distinct(), f"{name}-links")


def components(links: DataFrame, scratch: Scratch, name: str, most: int | None = None) -> DataFrame:
    """rep, comp: each end of the links (a, b) with the smallest end that it reaches, by alternating large and small stars.

    Stars are minimum aggregates joined back, so no node's neighbours meet in one place; a round's edges are written and read again.
    With at most `most` rounds comp is one that rep reaches, not always the smallest.
    """
    edges = scratch.save(links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("u <> v").distinct(), f"{name}-edges")
    before, held, k = None, f"{name}-edges", 0
    while k != most:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        star = large.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").unionByName(least.select("u", F.col("m").alias("v"))).distinct()
        k += 1
        edges = scratch.save(star, f"{name}-star{k}", h=F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")))
        scratch.drop(held)
        held = f"{name}-star{k}"
        if noted(edges) == before:
            break
        before = noted(edges)
    roots = edges.select(F.col("v").alias("rep"), F.col("v").alias("comp"))
    both = edges.select(F.col("u").alias("rep"), F.col("v").alias("comp")).unionByName(roots)
    return scratch.save(both.groupBy("rep").agg(F.min("comp").alias("comp")), f"{name}-comps")


class Budget:
    """What a document's segments of one partition can be asked for: costs are crowded buckets, which are never looked up.

    A segment that is crowded or empty is skipped (budget 0), another is matched exactly (1). A segment is matched with one element
    taken out on either side too (2), if none of what then is left is crowded or empty. Sets in which no such match is found differ
    in the sum of the budgets at least. heavy: exact matches alone don't reach over the differences of similar sets.
    """

    def __init__(self, s: np.ndarray, p: Partition, crowded: np.ndarray):
        self.seg, self.p = Segments(s, p), p
        self.keys = self.seg.exact(empty=True)[1]
        self.skipped = (self.seg.sizes == 0) | _in(self.keys, crowded)
        taken = self.seg.deletions(np.arange(p.segments))
        bad = _in(taken, crowded) | (self.seg.sizes[self.seg.at] == 1)
        self.near = ~self.skipped
        self.near[self.seg.at[bad]] = False
        self.taken, self.of = taken[~bad], self.seg.at[~bad]
        self.heavy = int(self.skipped.sum()) >= p.spare

    def reach(self, order: np.ndarray) -> int | None:
        """How many segments, in the given order, must have neighbourhoods for the sum to exceed the differences; None if all don't do."""
        total = int((~self.skipped).sum()) + np.cumsum(self.near[order])
        enough = np.flatnonzero(total > self.p.differences)
        return int(enough[0]) + 1 if len(enough) else None


def _in(keys: np.ndarray, of: np.ndarray) -> np.ndarray:
    """Whether each key is one of the sorted ones."""
    if not len(of):
        return np.zeros(len(keys), bool)
    return of[np.minimum(np.searchsorted(of, keys), len(of) - 1)] == keys


def _budgets(part: pa.RecordBatch, width: int, num: int, shared):
    """(row, set, Budget) of each partition in which a document of (rep, text) is heavy; crowded keys are shared or in the row."""
    crowded = repeat(shared.value) if shared is not None else (np.sort(x.values.to_numpy()) if x.is_valid else np.zeros(0, np.int64) for x in part.column("crowded"))
    for i, (value, hot) in enumerate(zip(part.column("text").to_pylist(), crowded)):
        s = shingles(value, width)
        for p in partitions_of(len(s), num) if len(s) else ():
            found = Budget(s, p, hot)
            if found.heavy:
                yield i, s, found


class Neighbourhoods:
    """One-deletion neighbourhoods of the documents (rep, text) that can't do with exact matches because of crowded buckets.

    A partition's segments are allocated by counted cost: those first whose deletions are fewest for each document that gains by
    them. All documents of a partition use as many segments as the one that needs most, of those that need REACH of them at most.
    """

    def __init__(self, texts: DataFrame, crowded: DataFrame, width: int, num: int, scratch: Scratch):
        self.spark, self.width, self.num, self.scratch = texts.sparkSession, width, num, scratch
        found = crowded.limit(CROWDED + 1).toArrow().column("key").to_numpy()
        self.shared = None
        if len(found) <= CROWDED:
            self.shared = self.spark.sparkContext.broadcast(np.sort(found))
        else:
            own = self._own_keys(texts).join(crowded, "key", "left_semi").groupBy("rep").agg(F.collect_set("key").alias("crowded"))
            texts = texts.join(scratch.save(own, "own-crowded"), "rep", "left")
        self.texts = scratch.save(texts, "heavy-texts")

    def _own_keys(self, texts: DataFrame) -> DataFrame:
        """key, rep: all keys that a Budget of the document looks for among crowded ones."""
        schema, width, num = StructType([StructField("key", LongType()), *_schema(texts, "rep")]), self.width, self.num

        def run(batches):
            for batch in batches:
                for part in slices(batch, "text"):
                    for i, value in enumerate(part.column("text").to_pylist()):
                        s = shingles(value, width)
                        for p in partitions_of(len(s), num) if len(s) else ():
                            seg = Segments(s, p)
                            keys = np.unique(np.concatenate([seg.exact(empty=True)[1], seg.deletions(np.arange(p.segments))]))
                            yield pa.RecordBatch.from_arrays([pa.array(keys), part.column("rep").take(pa.array(np.full(len(keys), i)))], ["key", "rep"])

        return texts.select("rep", "text").mapInArrow(freeing(run), schema)

    def _heavy(self, make, schema: StructType) -> DataFrame:
        """Rows that make(i, set, Budget) gives as arrays, of each heavy document's partitions; the first column comes from rep by i."""
        width, num, shared = self.width, self.num, self.shared

        def run(batches):
            for batch in batches:
                for part in slices(batch, "text"):
                    index, columns = [], []
                    for i, s, found in _budgets(part, width, num, shared):
                        made = make(s, found)
                        index.append(np.full(len(made[0]), i))
                        columns.append(made)
                    if columns:
                        ids = part.column("rep").take(pa.array(np.concatenate(index)))
                        yield pa.RecordBatch.from_arrays([ids, *(pa.array(np.concatenate(c)) for c in zip(*columns))], schema.fieldNames())

        return self.texts.mapInArrow(freeing(run), schema)

    def allocate(self) -> tuple[DataFrame, dict[int, np.ndarray]]:
        """rep, p, reach of heavy documents (-1: no allocation of REACH does), and the segments of each partition that get neighbourhoods.

        The driver gets a row for each segment of a partition: together a few times the size of the largest set.
        """
        width, num, shared_keys = self.width, self.num, self.shared
        long = lambda *names: StructType([*_schema(self.texts, "rep"), *(StructField(n, LongType()) for n in names)])

        def run(batches):
            sums: dict[int, np.ndarray] = {}
            for batch in batches:
                for _, _, b in _budgets(batch, width, num, shared_keys):
                    held = sums.setdefault(b.p.number, np.zeros((2, b.p.segments), np.int64))
                    held += b.seg.sizes, b.near
            for number, (cost, gain) in sums.items():
                n = len(cost)
                yield pa.RecordBatch.from_arrays([*map(pa.array, (np.full(n, number), np.arange(n), cost, gain))], ["p", "segment", "size", "gain"])

        costs = self.texts.mapInArrow(freeing(run), "p long, segment long, size long, gain long")
        counted = costs.groupBy("p", "segment").agg(F.sum("size").alias("cost"), F.sum("gain").alias("gain"))
        rows = counted.toArrow()
        p, segment, cost, gain = (rows.column(c).to_numpy() for c in ("p", "segment", "cost", "gain"))
        orders = {}
        for number in np.unique(p).tolist():
            own = np.flatnonzero(p == number)
            own = own[np.lexsort((segment[own], cost[own] / np.maximum(gain[own], 0.5)))]
            orders[number] = segment[own]
        shared = self.spark.sparkContext.broadcast(orders)
        need = self._heavy(lambda s, b: (np.array([b.p.number]), np.array([_within(b, shared.value[b.p.number])])), long("p", "reach"))
        need = self.scratch.save(need, "reaches")
        most = {r["p"]: r["reach"] for r in need.groupBy("p").agg(F.max("reach").alias("reach")).collect()}
        return need, {number: order[: max(0, most.get(number, 0))] for number, order in orders.items()}

    def rows(self, chosen: dict[int, np.ndarray]) -> DataFrame:
        """rep, key, kind, size, x0..: of the chosen segments, those that aren't crowded whole (kind 0) and with an element taken out (1)."""
        shared = self.spark.sparkContext.broadcast(chosen)

        def make(s: np.ndarray, b: Budget) -> tuple:
            wanted = np.zeros(b.p.segments, bool)
            wanted[shared.value[b.p.number]] = True
            whole, taken = b.keys[wanted & ~b.skipped], np.unique(b.taken[wanted[b.of]])
            n = len(whole) + len(taken)
            maps = np.tile(np.array(_bitmap(s, WIDE), np.int64), (n, 1))
            return np.concatenate([whole, taken]), np.repeat([0, 1], [len(whole), len(taken)]), np.full(n, len(s)), *maps.T

        fields = ["key", "kind", "size", *_map(WIDE)]
        return self._heavy(make, StructType([*_schema(self.texts, "rep"), *(StructField(n, LongType()) for n in fields)]))


def _within(b: Budget, order: np.ndarray) -> int:
    reach = b.reach(order)
    return reach if reach and reach <= REACH * b.p.segments else -1


def _map(words: int) -> list[str]:
    return [f"x{k}" for k in range(words)]


def _close(num: int, other: str, words: int) -> Column:
    """Whether sizes and bitmaps of two rows, the other's columns with a suffix, allow similar sets."""
    differ = sum((F.bit_count(F.col(x).bitwiseXOR(F.col(x + other))) for x in _map(words)), F.lit(0))
    sizes = F.col("size"), F.col("size" + other)
    return (differ * (100 + num) <= (sizes[0] + sizes[1]) * (100 - num)) & (F.least(*sizes) * 100 >= F.greatest(*sizes) * num)


def _met(left: DataFrame, right: DataFrame, on: str, where: str, num: int, words: int = SKETCH) -> DataFrame:
    """a, b: pairs of rows with equal keys for which where holds (columns of right end in _2), of different components and close."""
    other = right.select(*[F.col(c).alias(f"{c}_2") for c in right.columns])
    met = left.join(other, (left[on] == other[f"{on}_2"]) & F.expr(f"c <> c_2 AND ({where})") & _close(num, "_2", words))
    return met.select(F.least("rep", "rep_2").alias("a"), F.greatest("rep", "rep_2").alias("b"))


def _sketch(texts: DataFrame, width: int, bits: int, scratch: Scratch) -> np.ndarray:
    """Counts of shingles by the upper bits of a hash: at least the number of documents that hold a shingle. Each task counts in one
    array; arrays are added up by a tree of tasks, FAN at a time."""

    def count(batches):
        held = np.zeros(1 << bits, np.int64)
        for batch in batches:
            for part in slices(batch, "text"):
                for value in part.column("text").to_pylist():
                    held += np.bincount(_cell(shingles(value, width), bits), minlength=1 << bits)
        yield pa.RecordBatch.from_arrays([pa.array([held.tobytes()], pa.binary())], ["counts"])

    def add(batches):
        held = np.zeros(1 << bits, np.int64)
        for batch in batches:
            for raw in batch.column("counts"):
                held += np.frombuffer(raw.as_buffer(), np.int64)
        yield pa.RecordBatch.from_arrays([pa.array([held.tobytes()], pa.binary())], ["counts"])

    found = scratch.save(texts.select("text").mapInArrow(freeing(count), "counts binary"), "sketches")
    while (n := noted(found)["rows"]) > FAN:
        found = scratch.save(found.repartition(-(-n // FAN)).mapInArrow(freeing(add), "counts binary"), "sketches")
    return sum((np.frombuffer(r["counts"], np.int64) for r in found.toLocalIterator()), np.zeros(1 << bits, np.int64))


def _cell(s: np.ndarray, bits: int) -> np.ndarray:
    return (mix(s) >> np.uint64(64 - bits)).astype(np.int64)


def _prefixes(texts: DataFrame, shared, bits: int, width: int, num: int, bucket: int) -> DataFrame:
    """rep, g, count, size, common, x0..: the shingles by which a document meets similar ones, its size, a hash of its common
    shingles (those that count over bucket), and its bitmap."""
    names = ["g", "count", "size", "common", *_map(SKETCH)]
    schema = StructType([*_schema(texts, "rep"), *(StructField(n, LongType()) for n in names)])

    def run(batches):
        for batch in batches:
            for part in slices(batch, "text"):
                for i, value in enumerate(part.column("text").to_pylist()):
                    s = shingles(value, width)
                    counts = shared.value[_cell(s, bits)]
                    n = len(s) - -(-len(s) * num // 100) + 1 if len(s) else 0
                    first = np.lexsort((s, counts))[:n]
                    common = mix(s[counts > bucket]).sum(dtype=np.uint64, keepdims=True).astype(np.int64)
                    rest = np.array([len(s), common[0], *_bitmap(s, SKETCH)], np.int64)
                    yield pa.RecordBatch.from_arrays([part.column("rep").take(pa.array(np.full(n, i))), *map(pa.array, (s[first].astype(np.int64), counts[first], *np.tile(rest, (n, 1)).T))], schema.fieldNames())

    return texts.select("rep", "text").mapInArrow(freeing(run), schema)


def _residual(texts: DataFrame, rows: int, comps: DataFrame, width: int, num: int, bucket: int, scratch: Scratch) -> DataFrame:
    """a, b: candidates among documents of which crowded segments hold so much that no allocation of neighbourhoods does.

    Their shingles are counted among them, in a sketch that grows with their number up to 2^22 cells, and ordered by count, then by
    hash: similar sets share a shingle of both sets' first size - ceil(num size / 100) + 1, whatever the order. Rare ones (counted
    bucket times at most) list their pairs. Two sets that share common shingles alone are similar only if either is similar to the
    smallest set with the same common shingles as the other, and those two to each other: so each document meets one document for
    each different set of common shingles, not all that have it.
    """
    bits = min(22, max(16, (16 * rows).bit_length()))
    shared = texts.sparkSession.sparkContext.broadcast(_sketch(texts, width, bits, scratch))
    docs = _prefixes(texts, shared, bits, width, num, bucket).join(comps, "rep", "left").withColumn("c", F.coalesce("comp", "rep")).drop("comp")
    prefix = scratch.save(docs, "prefixes")
    rare, often = prefix.where(F.col("count") <= bucket), prefix.where(F.col("count") > bucket)
    least = often.groupBy("g", "common").agg(F.min(F.struct("size", "rep", "c", *_map(SKETCH))).alias("m")).select("g", "m.*")
    return _met(rare, rare, "g", "rep < rep_2", num).unionByName(_met(often, scratch.save(least, "least"), "g", "true", num))


def _partition(key: str):
    return F.col(key).bitwiseAND(F.lit((1 << PARTITION_BITS) - 1)).alias("p")


class Links:
    """The stages of jaccard_components over kept, one document for each class of equal texts."""

    def __init__(self, kept: DataFrame, rows: int, width: int, num: int, bucket: int, scratch: Scratch):
        self.kept, self.rows, self.width, self.num, self.bucket, self.scratch = kept, rows, width, num, bucket, scratch

    def hot_keys(self):
        """Broadcast, sorted: keys of which a sample of documents holds many; at most 10,000 times the keys of a document."""
        sample = self.kept.where(F.pmod(F.xxhash64(F.lit("hot"), "doc_id"), F.lit(SAMPLE)) == 0)
        keys = _signatures(sample, "doc_id", "text", self.width, self.num).where("n <= 0").groupBy("key").count()
        most = max(SAMPLE, self.rows // SAMPLE // 10_000)
        found = keys.where(F.col("count") >= most).select("key").toArrow().column("key").to_numpy()
        return self.kept.sparkSession.sparkContext.broadcast(np.sort(found))

    def buckets(self) -> DataFrame:
        """key, rep, n of _signatures: rows whose key another row has (shared), and those of the documents' sizes."""
        sigs = _signatures(self.kept, "doc_id", "text", self.width, self.num, self.hot_keys())
        met = sigs.withColumn("g", F.count("*").over(Window.partitionBy("key", "lane")))
        return self.scratch.save(met.where("g > 1 OR n >= 0 OR lane > 0").withColumn("shared", F.expr("n <= 0 AND (g > 1 OR lane > 0)")).drop("g", "lane"), "buckets")

    def verified(self, pairs: DataFrame, name: str) -> DataFrame:
        return verified(pairs, self.kept, "doc_id", "text", self.width, self.num, self.scratch, name)

    def stars(self, rows: DataFrame) -> DataFrame:
        """Links between each member (key, rep, share) of a bucket and its smallest one."""
        pivots = self.scratch.save(rows.groupBy("key").agg(F.min("rep").alias("a")), "pivots")
        seen = rows.join(pivots, "key").where("a <> rep").groupBy("a", F.col("rep").alias("b"), _partition("key")).agg(F.count("*").alias("k"), F.max("share").alias("share"))
        return self.verified(self.scratch.save(seen.where("k >= share").select("a", "b").distinct(), "star-pairs"), "star")

    def place(self, rows: DataFrame, links: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
        """comps (rep, comp) so far; rows with theirs as c, those of buckets that hold several; and these buckets' keys with main
        (the component with most members) and crowded: whether over bucket members belong to others."""
        comps = small(components(links, self.scratch, "star", 2), BROADCAST_ROWS)
        placed = rows.join(comps, "rep", "left").withColumn("c", F.coalesce("comp", "rep")).drop("comp")
        counted = placed.groupBy("key", "c").agg(F.count("*").alias("k")).groupBy("key").agg(F.max(F.struct("k", "c")).alias("top"), F.sum("k").alias("all")).where("all > top.k")
        ruled = self.scratch.save(counted.select("key", F.col("top.c").alias("main"), (F.col("all") - F.col("top.k") > self.bucket).alias("crowded")), "ruled")
        return comps, self.scratch.save(placed.join(ruled, "key"), "open"), ruled

    def across(self, open_: DataFrame, skipped: DataFrame) -> DataFrame:
        """a, b: pairs of different components that share as many keys that aren't crowded as similar sets must."""
        few = open_.where("NOT crowded").withColumn("p", _partition("key"))
        few = few.join(small(skipped.select("rep", "p", "skipped"), BROADCAST_ROWS, skipped), ["rep", "p"], "left").withColumn("share", F.col("share") - F.coalesce("skipped", F.lit(0)))
        left, right = few.where("c <> main"), few.select("key", F.col("rep").alias("rep2"), F.col("c").alias("c2"), F.col("share").alias("share2"))
        met = left.join(right, "key").where("c <> c2 AND (c2 = main OR rep < rep2)")
        shared = met.groupBy(F.least("rep", "rep2").alias("a"), F.greatest("rep", "rep2").alias("b"), "p").agg(F.count("*").alias("k"), F.max(F.greatest("share", "share2")).alias("share"))
        return shared.where("k >= share").select("a", "b")

    def near(self, heavy: DataFrame, ruled: DataFrame, comps: DataFrame) -> DataFrame:
        """a, b: candidates among the heavy documents, by neighbourhoods or, where these don't do, by counted shingles."""
        texts = self.kept.select(F.col("doc_id").alias("rep"), "text").join(small(heavy, BROADCAST_ROWS), "rep")
        made = Neighbourhoods(texts, ruled.where("crowded").select("key"), self.width, self.num, self.scratch)
        need, chosen = made.allocate()
        rows = made.rows(chosen).distinct().join(comps, "rep", "left").withColumn("c", F.coalesce("comp", "rep")).drop("comp")
        rows = self.scratch.save(rows, "deletions")
        found = _met(rows.where("kind = 0"), rows.where("kind = 1"), "key", "true", self.num, WIDE)
        beyond = self.scratch.save(need.where("reach < 0").select("rep").distinct(), "beyond")
        if not noted(beyond)["rows"]:
            return found
        rest = made.texts.join(small(beyond, BROADCAST_ROWS), "rep", "left_semi")
        return found.unionByName(_residual(rest, noted(beyond)["rows"], comps, self.width, self.num, self.bucket, self.scratch))


def jaccard_components(docs: DataFrame, width: int = 5, num: int = 80, key: str = "doc_id", text: str = "text", bucket: int = BUCKET, scratch: Scratch | None = None) -> DataFrame:
    """doc_id, n_shingles, component_id: the smallest doc_id that a document reaches by links, itself included.

    Documents link when 100 x shared shingles >= num x shingles of both together. Exactly equal texts with words are one class; each
    class is cut into segments for each partition of its size, and classes that share a segment meet in a bucket. There they are
    verified against one of them; classes so joined need no further proof. Buckets that still hold several components list the pairs across them, up to `bucket` members outside the largest one, and those pairs are
    verified that share as many keys as similar sets must. What is more crowded is skipped for classes that can spare it; those
    that can't meet by one-deletion neighbourhoods of segments chosen by cost, and those with too little outside crowded segments
    by counted shingles. So no link between components is lost.
    Null texts and texts without words have 0 shingles and are linked with nothing. Rows with a null doc_id count their shingles but take no
    links: their component is null. Rows with equal doc_ids are one node with the links of all its texts; each row is returned.
    An empty table gives no rows; further columns are left out. One text's set is held at a time, 8 bytes a shingle.
    """
    scratch = scratch or Scratch(docs.sparkSession)
    source = docs.select(F.col(key).alias("doc_id"), F.col(text).alias("text"))
    named = source.where("doc_id IS NOT NULL")
    hashed = scratch.save(named.select("doc_id", F.unhex(F.md5(F.col("text").cast("binary"))).alias("md5"), F.col("text").rlike(r"[^\x20\x09-\x0D]").alias("worded")), "hashed")
    # A doc_id whose rows hold different texts stays out of classes.
    texts_of = hashed.groupBy("doc_id").agg(F.min("md5").alias("x"), F.max("md5").alias("y"), F.count("md5").alias("n"), F.count("*").alias("m"))
    mixed = small(scratch.save(texts_of.where("x <> y OR n <> m").select("doc_id"), "mixed"), BROADCAST_ROWS)
    classes = hashed.join(mixed, "doc_id", "left_anti").where("worded").groupBy("md5").agg(F.min("doc_id").alias("rep"), F.max("doc_id").alias("last"))
    several = scratch.save(classes.where("rep <> last").select("md5", "rep"), "classes")
    copies = hashed.join(small(several, BROADCAST_ROWS), "md5").where("doc_id <> rep").join(mixed, "doc_id", "left_anti")
    copies = scratch.save(copies.select("doc_id", "rep"), "copies")  # a row for each row of theirs
    kept = named.join(small(copies.select("doc_id").distinct(), BROADCAST_ROWS, copies), "doc_id", "left_anti")

    job = Links(kept, noted(hashed)["rows"], width, num, bucket, scratch)
    buckets = job.buckets()
    rows = buckets.where("shared").select("key", "rep", (-F.col("n")).alias("share"))
    links = job.stars(rows)
    comps, open_, ruled = job.place(rows, links)
    crowd = open_.where("crowded")
    skipped = scratch.save(crowd.groupBy("rep", _partition("key")).agg(F.count("*").alias("skipped"), F.max("share").alias("share")), "skipped")
    short = buckets.where("n = 0").select("rep")  # so many empty segments that a similar set needn't share one with elements
    heavy = scratch.save(skipped.where("skipped >= share").select("rep").unionByName(short).distinct(), "heavy")
    pairs = job.across(open_, skipped)
    if noted(heavy)["rows"]:
        pairs = pairs.unionByName(job.near(heavy, ruled, comps))
    close = likely(scratch.save(pairs.distinct(), "across"), kept, "doc_id", "text", width, num, scratch, "across")
    last = job.verified(close, "across")

    same = copies.select(F.col("rep").alias("a"), F.col("doc_id").alias("b"))
    final = components(links.unionByName(last).unionByName(same), scratch, "final")
    sizes = buckets.where("n > 0").select(F.col("rep").alias("doc_id"), (F.col("n") - 1).alias("n_shingles"))
    of_class = sizes.withColumnRenamed("doc_id", "rep").distinct()
    out = sizes.unionByName(copies.join(of_class, "rep").select("doc_id", "n_shingles"))
    out = out.join(small(final, BROADCAST_ROWS), out["doc_id"] == final["rep"], "left")
    out = out.select("doc_id", "n_shingles", F.coalesce("comp", "doc_id").alias("component_id"))
    unnamed = _signatures(source.where("doc_id IS NULL"), "doc_id", "text", width, num).where("n > 0")
    return out.unionByName(unnamed.select(F.col("rep").alias("doc_id"), (F.col("n") - 1).alias("n_shingles"), F.lit(None).cast(source.schema["doc_id"].dataType).alias("component_id")))


def keep_one(docs: DataFrame, found: DataFrame, scratch: Scratch, key: str = "doc_id") -> DataFrame:
    """docs without those that aren't the smallest of their component, and one row for each key that stays; null keys stay as they are.

    Of several rows with one key that stays the one with the smallest hash of all its columns is taken, so reruns agree.
    """
    lost = scratch.save(found.where("doc_id <> component_id").select(F.col("doc_id").alias(key)).distinct(), "lost")
    left = docs.join(small(lost, BROADCAST_ROWS), key, "left_anti").select(*[F.col(f"`{c}`") for c in docs.columns])
    if found.where("doc_id = component_id").groupBy("doc_id").count().where("count > 1").isEmpty():
        return left
    named = left.where(F.col(key).isNotNull())
    one = named.groupBy(key).agg(F.min_by(F.struct(*[F.col(f"`{c}`") for c in named.columns]), row_key(named)).alias("kept_row")).select("kept_row.*")
    return one.unionByName(left.where(F.col(key).isNull()))
