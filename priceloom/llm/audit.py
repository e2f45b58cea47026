"""Filter interaction audit: what each of five filters removes in every order of application, by part of the corpus."""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from itertools import permutations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, IntegerType, StructField

from .arrow import PIECE_CHARS, Scratch, map_texts, pieces, small

FILTERS = "ABCDE"
SUBSETS = 1 << len(FILTERS)
#: Bit s of WORDS[m] says that a document which fails the filters of mask m survives the filters of subset s: they share none.
WORDS = np.array([sum(1 << s for s in range(SUBSETS) if not s & m) for m in range(SUBSETS)], np.uint32)

_CAPITALS = bytes(range(65, 91))
_SYMBOL = re.compile(rb"[#$%&*|]")
#: Labels up to which they are broadcast; beyond, documents and labels meet by shuffle.
BROADCAST_ROWS = 500_000


def _failures(texts: list) -> list[list]:
    """Mask of the filters A to D that each text fails, and its digest; a null is the empty text."""
    masks, digests = [], []
    for text in texts:
        raw = (text or "").encode("utf-8", "surrogatepass")
        n, seen = 0, set()
        for part in pieces(raw, PIECE_CHARS):
            words = part.split()
            n += len(words)
            seen.update(words)
        capitals = len(raw) - len(raw.translate(None, _CAPITALS))
        fails = (n < 50, 100 * len(seen) < 65 * n, 100 * capitals > 5 * len(text or ""), _SYMBOL.search(raw) is not None)
        masks.append(sum(1 << k for k, bad in enumerate(fails) if bad))
        digests.append(hashlib.sha256(raw).digest())
    return [masks, digests]


def failure_masks(docs: DataFrame, key: str = "doc_id", part: str = "source", text: str = "text") -> DataFrame:
    """key, part and mask (bit k: the document fails filter k of FILTERS) of each row of docs.

    A fails under 50 words, B with under 65 distinct words in 100, C with over 5 capitals A-Z in 100 code points, D with any of
    #$%&*|, E if a smaller key has the same text. Null texts are empty; a null part is the empty string. A row with a null key never
    fails E and makes no other row fail it; of rows that repeat key and text none fails E for the other.

    Equal texts meet as digests: the smallest key of each is found by a partial aggregate, and a row looks itself up there by digest
    and key together, so copies, however many, are spread over all tasks. Texts are read once, and never shuffled.
    """
    named = docs.select(F.col(key).alias("key"), F.coalesce(part, F.lit("")).alias("part"), F.col(text).alias("text"))
    fields = [StructField("mask", IntegerType()), StructField("digest", BinaryType())]
    failed = Scratch(docs.sparkSession).save(map_texts(named, lambda: _failures, fields, ("key", "part")), "failures")
    firsts = failed.where("key IS NOT NULL").groupBy("digest").agg(F.min("key").alias("key")).withColumn("first", F.lit(True))
    late = F.col("key").isNotNull() & F.col("first").isNull()
    marked = failed.join(firsts, ["digest", "key"], "left")
    return marked.select(F.col("key").alias(key), "part", (F.col("mask") + F.when(late, 16).otherwise(0)).alias("mask"))


def add_carry(a: np.ndarray, b: np.ndarray, c: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sum and carry words of three words of equal weight, bit by bit."""
    half = a ^ b
    return half ^ c, (a & b) | (half & c)


def positional_popcount(words: np.ndarray) -> np.ndarray:
    """How many of the words have each bit set, by carry-save adders: three words of a weight become one and one of twice the weight."""
    counts, weight = np.zeros(SUBSETS, np.int64), 1
    while len(words):
        carried = []
        while len(words) > 2:
            n = len(words) // 3
            kept, carry = add_carry(words[:n], words[n : 2 * n], words[2 * n : 3 * n])
            carried.append(carry)
            words = np.concatenate([kept, words[3 * n :]])
        for word in words.tolist():
            counts += weight * ((word >> np.arange(SUBSETS)) & 1)
        words, weight = np.concatenate(carried) if carried else words[:0], 2 * weight
    return counts


def subset_survivors(masks: DataFrame) -> DataFrame:
    """part, subset, and n, good and toxic: how many documents of the part, and of each label in it, survive the subset of filters.

    masks has part, mask, good and toxic (booleans; null counts as false). Each batch counts its words by part and label, so a row for
    each part and subset leaves it at most; rows of zeros don't.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            parts = batch.column(0).dictionary_encode()
            code, words = parts.indices.to_numpy(), WORDS[batch.column(1).to_numpy()]
            labels = [np.asarray(batch.column(k).fill_null(False).to_numpy(zero_copy_only=False), bool) for k in (2, 3)]
            order = np.argsort(code, kind="stable")
            for rows in np.split(order, np.flatnonzero(np.diff(code[order])) + 1):
                if len(rows):
                    counts = [positional_popcount(words[r]) for r in (rows, rows[labels[0][rows]], rows[labels[1][rows]])]
                    some = np.flatnonzero(counts[0])
                    name = parts.dictionary[int(code[rows[0]])].as_py()
                    yield pa.RecordBatch.from_arrays([pa.array([name] * len(some), pa.string()), pa.array(some, pa.int32()), *(pa.array(c[some]) for c in counts)], ["part", "subset", "n", "good", "toxic"])

    found = masks.select("part", "mask", "good", "toxic").mapInArrow(run, "part string, subset int, n long, good long, toxic long")
    return found.groupBy("part", "subset").agg(*[F.sum(c).alias(c) for c in ("n", "good", "toxic")])


def _subset(letters: Column) -> Column:
    """The subset with these letters as a number."""
    bits = [F.when(letters.contains(x), 1 << k).otherwise(0) for k, x in enumerate(FILTERS)]
    return sum(bits[1:], bits[0])


def order_audit(survivors: DataFrame) -> DataFrame:
    """One row for each part, order of the filters and step: kept, removed, redundant, unique_fails, good_lost, toxic_lost, shapley.

    survivors comes from subset_survivors. A part's 32 subsets become one map; all else is arithmetic on it, in rows of 600 a part.
    """
    counts = F.struct("n", "good", "toxic")
    by_part = survivors.groupBy("part").agg(F.map_from_entries(F.collect_list(F.struct("subset", counts))).alias("left"))
    orders = F.lit(["".join(p) for p in permutations(FILTERS)])
    steps = by_part.select("part", "left", F.explode(orders).alias("filter_order")).select("*", F.explode(F.sequence(F.lit(1), F.lit(len(FILTERS)))).alias("step"))
    letter = F.substr("filter_order", F.col("step"), F.lit(1))
    steps = steps.withColumn("letter", letter).withColumn("before", _subset(F.substr("filter_order", F.lit(1), F.col("step") - 1))).withColumn("own", _subset(F.col("letter")))
    left = lambda subset, of="n": F.coalesce(F.try_element_at("left", subset)[of], F.lit(0).cast("long"))
    everything, before = F.lit(SUBSETS - 1), F.col("before")
    after = before + F.col("own")
    told = steps.select(
        "part", "filter_order", "step", "letter",
        left(after).alias("kept"), (left(before) - left(after)).alias("removed"), (left(F.lit(0)) - left(F.col("own"))).alias("failing"),
        (left(everything - F.col("own")) - left(everything)).alias("unique_fails"),
        *[(left(before, c) - left(after, c)).alias(f"{c}_lost") for c in ("good", "toxic")],
    )
    shapley = F.sum("removed").over(Window.partitionBy("part", "letter"))  # 120 rows each
    return told.select("part", "filter_order", "step", "kept", "removed", (F.col("failing") - F.col("removed")).alias("redundant"), "unique_fails", "good_lost", "toxic_lost", shapley.alias("shapley"))


def filter_audit(docs: DataFrame, labels: DataFrame, key: str = "doc_id", part: str = "source", text: str = "text") -> DataFrame:
    """order_audit of docs by part, with the labels of key, quality and toxic; no rows for an empty table.

    A document is good or toxic if any of its labels says 1; labels of null keys and of unknown documents count nowhere.
    """
    said = labels.where(F.col(key).isNotNull()).groupBy(F.col(key).alias("label_key")).agg(F.max(F.col("quality") == 1).alias("good"), F.max(F.col("toxic") == 1).alias("toxic"))
    said = small(said.where("good OR toxic"), BROADCAST_ROWS)
    masks = failure_masks(docs, key, part, text)
    return order_audit(subset_survivors(masks.join(said, masks[key] == said["label_key"], "left")))
