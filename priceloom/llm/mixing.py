"""Mixing sources to target weights by pivotal dependent rounding, in DataFrame functions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .arrow import Scratch, row_key, small

#: Units that one task holds together: those of a leaf or node of the reduction tree.
FAN = 64
#: Probabilities this near to 0 or 1 count as such.
EPS = 1e-9
BROADCAST_ROWS = 50_000
#: Copies of repeated rows that one task makes together.
CHUNK = 1_000


def words(text: str = "text") -> Column:
    """Number of runs of anything but space and \\t\\n\\v\\f\\r; 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def _ranked(stats: DataFrame, scratch: Scratch) -> DataFrame:
    """Adds place: from 0, sources by code point, null last; a range partitioning and the counts of its parts, no single task."""
    n = max(1, min(200, stats.count() // 1000))
    null_last = F.col("source").isNull()
    dealt = stats.repartitionByRange(n, null_last, "source").withColumn("part", F.spark_partition_id())
    dealt = scratch.save(dealt, "ranges")
    inside = dealt.withColumn("row", F.row_number().over(Window.partitionBy("part").orderBy(null_last, "source")) - 1)
    counts = dealt.groupBy("part").agg(F.count("*").alias("rows"))  # at most n rows
    before = counts.withColumn("before", F.sum("rows").over(Window.orderBy("part")) - F.col("rows")).select("part", "before")
    return inside.join(F.broadcast(before), "part").withColumn("place", F.col("row") + F.col("before")).drop("part", "row", "before")


def source_targets(sized: DataFrame, weights: tuple = (1, 2, 3), cap: float = 3.0, scratch: Scratch | None = None) -> DataFrame:
    """source, source_size, source_rows and target of each source of (source, size).

    Sources by code point, null last, weigh as weights repeat, and share the sum of all sizes; a target over cap times its
    source's size stops there and the excess is shared anew by weight. Only sums come to the driver: one level a round, at which
    uncapped targets stand per weight, until no more sources reach their cap.
    """
    scratch = scratch or Scratch(sized.sparkSession)
    stats = scratch.save(sized.groupBy("source").agg(F.sum("size").alias("source_size"), F.count("*").alias("source_rows")), "stats")
    placed = _ranked(stats, scratch)
    weight = F.element_at(F.array(*map(F.lit, map(float, weights))), (F.col("place") % len(weights) + 1).cast("int"))
    placed = scratch.save(placed.select("source", "source_size", "source_rows", weight.alias("weight")), "weights")
    most = F.col("source_size") * cap
    level, capped = 0.0, -1
    while True:
        over = most < F.lit(level) * F.col("weight")
        r = placed.agg(F.sum("source_size").alias("all"), F.sum(F.when(over, most)).alias("held"), F.sum(F.when(~over, F.col("weight"))).alias("open"), F.count_if(over).alias("n")).first()
        if r["n"] == capped or not r["open"]:
            break
        level, capped = (r["all"] - (r["held"] or 0.0)) / r["open"], r["n"]
    return placed.select("source", "source_size", "source_rows", F.least(most, F.lit(level) * F.col("weight")).cast("double").alias("target"))


def _uniform(*parts) -> Column:
    return F.xxhash64(*parts).bitwiseAND(F.lit((1 << 53) - 1)) / F.lit(float(1 << 53))


def _fold(units: Column, kind: str, done: str, seed: str, level: int, last: Column) -> Column:
    """Pairs the units of a sorted array in turn; struct(done, left): decided units, and the one whose chance is still between.

    Of two units with chances p, q and sizes s, t, either s(1-p) and tq, or sp and t(1-q) are compared, and the smaller number of
    words moves: at random, so that neither chance changes on average and s p + t q never does. One chance gets to 0 or 1. The
    random number is that of the unit which has waited longer: it goes on in one direction, up or down, until it is whole, so a
    large unit is settled by several smaller ones instead of being moved to and fro by them. In the last fold of a source, a unit
    that all smaller ones together could settle in one direction only takes that one.
    """
    sum_of = lambda f: F.aggregate(units, F.lit(0.0), lambda t, x: t + x["size"] * f(x["p"]))
    give, take = sum_of(lambda p: p), sum_of(lambda p: 1 - p)
    zero = F.struct(F.array().cast(f"array<{done}>").alias("done"), F.lit(None).cast(kind).alias("left"), give.alias("give"), take.alias("take"))

    def out(u: Column, add: Column) -> Column:
        return F.struct(*[u[c].alias(c) for c in _DONE], add.cast("long").alias("add"))

    def merge(acc: Column, x: Column) -> Column:
        i = acc["left"]
        i_up, j_down = i["size"] * (1 - i["p"]), x["size"] * x["p"]
        i_down, j_up = i["size"] * i["p"], x["size"] * (1 - x["p"])
        up, down = F.least(i_up, j_down), F.least(i_down, j_up)
        can_rise, can_fall = i_up <= acc["give"] + EPS, i_down <= acc["take"] + EPS
        drawn = _uniform(F.lit(seed), F.lit(level), i["u"]) * (up + down) < down
        rises = F.when(last & (can_rise != can_fall), can_rise).otherwise(drawn)
        i_ends = F.when(rises, i_up <= j_down).otherwise(i_down <= j_up)
        p = F.when(rises & i_ends, (j_down - i_up) / x["size"]).when(rises, i["p"] + j_down / i["size"]).when(i_ends, x["p"] + i_down / x["size"]).otherwise(i["p"] - j_up / i["size"])
        ended, stays = F.when(i_ends, i).otherwise(x), F.when(i_ends, x).otherwise(i)
        whole = (p <= EPS) | (p >= 1 - EPS)
        met = F.concat(acc["done"], F.array(out(ended, rises == i_ends)), F.when(whole, F.array(out(stays, p > 0.5))).otherwise(F.array().cast(f"array<{done}>")))
        on = F.when(~whole, F.struct(*[stays[c].alias(c) for c in _UNIT], p.alias("p")))
        rest = (acc["give"] - x["size"] * x["p"]).alias("give"), (acc["take"] - x["size"] * (1 - x["p"])).alias("take")
        return F.when(i.isNull(), F.struct(acc["done"].alias("done"), x.alias("left"), *rest)).otherwise(F.struct(met.alias("done"), on.alias("left"), *rest))

    return F.aggregate(units, zero, merge)


#: Of a unit: n equal rows, of which `more` get a copy besides their base ones, and one more does if the unit's chance turns to 1.
_DONE = ("doc_id", "size", "base", "n", "more")
_UNIT = ("neg", "u", *_DONE)


def _rows_of(units: DataFrame) -> DataFrame:
    """A row for each of a unit's equal rows, with its copies. Many are made in parts of CHUNK, dealt over the tasks."""
    one = units.where("n = 1").withColumn("copies", F.col("base") + F.col("more") + F.col("add"))
    several = units.where("n > 1")
    if several.isEmpty():
        return one
    up = F.col("more") + F.col("add")
    kinds = F.array(F.struct((F.col("base") + 1).alias("copies"), up.alias("k")), F.struct(F.col("base").alias("copies"), (F.col("n") - up).alias("k")))
    parts = several.select("*", F.inline(F.filter(kinds, lambda x: x["k"] > 0)))
    parts = parts.withColumn("start", F.explode(F.sequence(F.lit(0).cast("long"), F.col("k") - 1, F.lit(CHUNK).cast("long"))))
    parts = parts.repartition("doc_id", "copies", "start").withColumn("i", F.explode(F.sequence(F.lit(1).cast("long"), F.least(F.lit(CHUNK).cast("long"), F.col("k") - F.col("start")))))
    return one.unionByName(parts.select(*one.columns))


def mix_sources(docs: DataFrame, weights: tuple = (1, 2, 3), cap: float = 3.0, seed: str = "mix", key: str = "doc_id", source: str = "source", text: str = "text", scratch: Scratch | None = None, row: Column | None = None) -> DataFrame:
    """doc_id, source, size, source_size, target, copies and taken (copies x size) of each document.

    row, if given, is put into doc_id in place of the key, which still draws; row_key() names each row, nulls or not.

    A document is due target / source_size copies: the whole ones are given, the fraction is a chance. Chances are rounded
    together in a reduction tree: a source's units go by hash to leaves of about FAN, each leaf folds its units from the largest to
    the smallest, and what it leaves, one unit at most, meets the rests of FAN neighbours of its source on the next level. Words only
    move between units of one source; the last unit of a source goes to the nearer of 0 and 1, so taken words miss a target by half
    of that unit's size at most. All randomness is a hash of seed, level and units: reruns agree, whatever the partitions.
    Texts without words have size 0 and take nothing. A null source is a source, the last; null keys are told apart by their text.
    Rows with equal key, source and text are one unit of n rows: n times the fraction is split into whole copies, for so many of
    these rows, and one chance, so no leaf gets them row by row. An empty table gives no rows; further columns are left out.
    """
    spark = docs.sparkSession
    scratch = scratch or Scratch(spark)
    hashed = F.xxhash64(F.lit(seed), F.col(key), F.col(text))
    sized = scratch.save(docs.select((F.col(key) if row is None else row).alias("doc_id"), F.col(source).alias("source"), words(text).alias("size"), hashed.alias("u")), "sized")
    targets = scratch.save(source_targets(sized, weights, cap, scratch), "targets")
    chance = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    t = small(targets, BROADCAST_ROWS)
    units = sized.groupBy("doc_id", "source", "size", "u").agg(F.count("*").alias("n"))
    units = units.join(t.withColumnRenamed("source", "of"), F.col("source").eqNullSafe(F.col("of")), "left").drop("of")
    units = units.withColumn("base", F.floor(chance + EPS).cast("long"))
    due = F.when(F.col("size") > 0, F.greatest(F.lit(0.0), chance - F.col("base")) * F.col("n")).otherwise(0.0)
    units = units.withColumn("more", F.floor(due + EPS).cast("long")).withColumn("p", F.greatest(F.lit(0.0), due - F.col("more")))
    of_source = ["source", "source_size", "target"]
    open_ = F.col("p") > EPS
    results = [units.where(~open_).select(*_DONE, F.lit(0).cast("long").alias("add"), *of_source)]
    groups = max(1, -(-(targets.agg(F.max("source_rows")).first()[0] or 0) // FAN))  # of the largest source
    parts = F.ceil(F.col("source_rows") / FAN)
    unit = F.struct((-F.col("size")).alias("neg"), *_UNIT[1:], "p").alias("unit")
    rest = units.where(open_).select(F.pmod("u", parts).alias("group"), parts.alias("parts"), *of_source, unit)
    kind = rest.schema["unit"].dataType.simpleString()
    done = f"struct<doc_id:{sized.schema['doc_id'].dataType.simpleString()},{','.join(f'{c}:bigint' for c in _DONE[1:])},add:bigint>"
    level = 0
    while True:
        met = rest.groupBy("group", "parts", *of_source).agg(F.sort_array(F.collect_list("unit")).alias("units"))
        folded = _fold(F.col("units"), kind, done, seed, level, F.col("parts") == 1)
        made = scratch.save(met.select("group", "parts", *of_source, folded.alias("made")), f"level{level}")
        results.append(made.select(F.explode("made.done").alias("d"), *of_source).select("d.*", *of_source))
        left = made.where("made.left IS NOT NULL")
        if groups == 1:
            results.append(left.select(*[F.col(f"made.left.{c}").alias(c) for c in _DONE], (F.col("made.left.p") >= 0.5).cast("long").alias("add"), *of_source))
            break
        groups = -(-groups // FAN)
        parts = F.ceil(F.col("parts") / FAN)
        rest = left.select((F.col("group") % parts).alias("group"), parts.alias("parts"), *of_source, F.struct(*[F.col(f"made.left.{f}").alias(f) for f in (*_UNIT, "p")]).alias("unit"))
        level += 1
    out = results[0]
    for r in results[1:]:
        out = out.unionByName(r)
    out = _rows_of(out)
    return out.select("doc_id", "source", "size", "source_size", "target", "copies", (F.col("copies") * F.col("size")).alias("taken"))


def repeat_documents(docs: DataFrame, mixed: DataFrame, scratch: Scratch | None = None) -> DataFrame:
    """docs with each row as often as mixed, made with row=row_key(docs), has copies of it.

    Rows that are equal in all columns can't be told apart, so one of them stands for all and gets the sum of their copies.
    """
    scratch = scratch or Scratch(docs.sparkSession)
    n = mixed.groupBy(F.col("doc_id").alias("mixed_key")).agg(F.sum("copies").alias("mixed_copies"), F.count("*").alias("mixed_rows"))
    n = scratch.save(n.where("mixed_copies > 0"), "copies")
    keyed = docs.withColumn("mixed_key", row_key(docs))

    def taken(which: str) -> DataFrame:
        return keyed.join(small(n.where(which), 20 * BROADCAST_ROWS), "mixed_key")

    def times(df: DataFrame) -> DataFrame:
        return df.withColumn("mixed_k", F.explode(F.sequence(F.lit(1).cast("long"), "mixed_copies"))).select(*[F.col(f"`{c}`") for c in docs.columns])

    out = times(taken("mixed_rows = 1"))
    if n.where("mixed_rows > 1").isEmpty():
        return out
    start = F.explode(F.sequence(F.lit(0).cast("long"), F.col("mixed_copies") - 1, F.lit(CHUNK).cast("long")))
    parts = taken("mixed_rows > 1").dropDuplicates(["mixed_key"]).withColumn("mixed_start", start)
    parts = parts.withColumn("mixed_copies", F.least(F.lit(CHUNK).cast("long"), F.col("mixed_copies") - F.col("mixed_start")))
    return out.unionByName(times(parts.repartition("mixed_key", "mixed_start")))
