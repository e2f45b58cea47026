"""Source divergence audit: how the sources of a language differ in their use of its terms, in exact integers."""

from __future__ import annotations

import uuid
from collections import Counter
from collections.abc import Iterator
from itertools import count

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .arrow import PIECE_CHARS, Scratch, freeing, noted, pieces, slices, small

LEAST_DOCS, TOP_TERMS = 30, 50
#: Digests up to which a table of them is broadcast: 24 bytes each.
BROADCAST_ROWS = 1_000_000
#: Terms by group that a task holds before their counts go on. Cells of terms by sources, and least terms, of a block of the pair sums.
HELD_TERMS = 400_000
BLOCK_CELLS, BLOCK_TERMS = 1 << 16, 64

#: What counting keeps: letters A-Z and a-z and all beyond ASCII, A-Z lower-cased; else blanks. In UTF-8 the bytes from 0x80 on are letters.
_LETTERS = bytes(b + 32 if 65 <= b <= 90 else b if 97 <= b <= 122 or b >= 128 else 32 for b in range(256))

TERMS = "lang_id long, source_id long, digest long, docs long, occurs long, part long, term string"


def terms_of(text: str | None) -> Counter:
    """The terms of a text in UTF-8, with how often each occurs."""
    found: Counter = Counter()
    for part in pieces((text or "").encode("utf-8", "surrogatepass").translate(_LETTERS), PIECE_CHARS):
        found.update(part.split())
    return found


def count_terms(docs: DataFrame, bits: int = 64) -> DataFrame:
    """TERMS of docs (lang_id, source_id, text): documents and occurrences of each term, added up until a task holds HELD_TERMS of them.

    digest is the low `bits` bits of the term's hash: few bits make terms collide, for tests. Of what a task gives at once, which part names,
    a language's term stands in the first row of its digest only, and is null in the others; where terms share a digest it stands in all.
    """
    mask, names = (1 << bits) - 1, [f.split()[0] for f in TERMS.split(", ")]

    def gathered(held: dict) -> Iterator[pa.RecordBatch]:
        part = uuid.uuid4().int >> 65
        for lang in {lang for lang, _ in held}:
            groups = [(source, *counts) for (own, source), counts in held.items() if own == lang]
            sizes = [len(in_docs) for _, in_docs, _ in groups]
            terms = pa.array([t for _, in_docs, _ in groups for t in in_docs], pa.binary())
            digests = np.fromiter((xxhash.xxh3_64_intdigest(t) & mask for _, in_docs, _ in groups for t in in_docs), np.uint64, len(terms))
            first, of = np.unique(digests, return_index=True, return_inverse=True)[1:]
            clash = np.zeros(len(first), bool)
            clash[of[pc.not_equal(terms, terms.take(pa.array(first[of]))).to_numpy(zero_copy_only=False)]] = True
            said = clash[of]
            said[first] = True
            numbers = [np.fromiter((c[at][t] for c in groups for t in c[1]), np.int64, len(terms)) for at in (1, 2)]
            source = np.repeat(np.array([g[0] for g in groups], np.int64), sizes)
            same = [pa.array(np.full(len(terms), x, np.int64)) for x in (lang, part)]
            term = pc.if_else(pa.array(said), terms, None).cast(pa.string())
            yield pa.RecordBatch.from_arrays([same[0], pa.array(source), pa.array(digests.view(np.int64)), *map(pa.array, numbers), same[1], term], names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict = {}
        for batch in batches:
            for part in slices(batch, "text"):
                for lang, source, text in zip(*(part.column(c).to_pylist() for c in ("lang_id", "source_id", "text"))):
                    in_docs, occurs = held.setdefault((lang, source), (Counter(), Counter()))
                    found = terms_of(text)
                    in_docs.update(found.keys())
                    occurs.update(found)
                if sum(len(c) for c, _ in held.values()) >= HELD_TERMS:
                    yield from gathered(held)
                    held = {}
        yield from gathered(held)

    return docs.select("lang_id", "source_id", "text").mapInArrow(freeing(run), TERMS)


def group_ids(docs: DataFrame, scratch: Scratch) -> tuple[DataFrame, DataFrame]:
    """docs with lang_id and source_id, and the (lang, source) groups with these ids, which are as distinct as the names."""
    names = docs.select("lang", "source").distinct()
    for seed in count():
        ids = {f"{c}_id": F.xxhash64(F.lit(seed), c) for c in ("lang", "source")}
        groups = scratch.save(names.withColumns(ids), f"groups{seed}")
        clash = [groups.groupBy(f"{c}_id").agg(F.min(c).alias("a"), F.max(c).alias("b")).where("a <> b") for c in ("lang", "source")]
        if clash[0].select("a").unionByName(clash[1].select("a")).isEmpty():
            return docs.withColumns(ids), groups


def kept_counts(terms: DataFrame, least: int, scratch: Scratch) -> tuple[DataFrame, DataFrame]:
    """counts (lang_id, source_id, digest, variant, occurs) and strings (lang_id, digest, variant, term) of terms in at least `least` documents of a language.

    terms is a written table of TERMS. Only its fixed-width columns are shuffled to count by digest. A digest that enough documents of a
    language share has its smallest and largest term looked up; where these differ, its terms are counted again by themselves,
    and told apart by variant, from 1 in their order (else 0). So the result is exact whatever collides.
    """
    totals = scratch.save(terms.groupBy("lang_id", "source_id", "digest").agg(F.sum("docs").alias("docs"), F.sum("occurs").alias("occurs")), "totals")
    often = scratch.save(totals.groupBy("lang_id", "digest").agg(F.sum("docs").alias("docs")).where(F.col("docs") >= least).select("lang_id", "digest"), "often")
    few = noted(often)["rows"] <= BROADCAST_ROWS
    asked = terms.where("term IS NOT NULL").select("lang_id", "digest", "term")
    asked = asked.join(F.broadcast(often), ["lang_id", "digest"], "left_semi") if few else asked
    ends = asked.groupBy("lang_id", "digest").agg(F.min("term").alias("term"), F.max("term").alias("last"))
    ends = scratch.save(ends if few else ends.join(often, ["lang_id", "digest"], "left_semi"), "strings", clashes=F.count_if(F.col("term") != F.col("last")))
    strings = ends.where("term = last").select("lang_id", "digest", F.lit(0).alias("variant"), "term")
    single = small(strings.select("lang_id", "digest"), BROADCAST_ROWS, of=ends)
    counts = totals.join(single, ["lang_id", "digest"], "left_semi").select("lang_id", "source_id", "digest", F.lit(0).alias("variant"), "occurs")
    if noted(ends)["clashes"]:
        mixed = small(ends.where("term <> last").select("lang_id", "digest"), BROADCAST_ROWS, of=ends)
        own = terms.join(mixed, ["lang_id", "digest"], "left_semi")
        said = own.where("term IS NOT NULL").select("lang_id", "digest", "part", F.col("term").alias("said"))
        # A row without a term has the only one that its part and digest have.
        named = own.where("term IS NULL").join(said, ["lang_id", "digest", "part"]).withColumn("term", F.col("said")).drop("said")
        again = own.where("term IS NOT NULL").unionByName(named).groupBy("lang_id", "source_id", "digest", "term").agg(F.sum("docs").alias("docs"), F.sum("occurs").alias("occurs"))
        again = scratch.save(again, "again")
        split = again.groupBy("lang_id", "digest", "term").agg(F.sum("docs").alias("docs")).where(F.col("docs") >= least)
        split = scratch.save(split.select("lang_id", "digest", F.row_number().over(Window.partitionBy("lang_id", "digest").orderBy("term")).alias("variant"), "term"), "split")
        counts = counts.unionByName(again.join(split, ["lang_id", "digest", "term"]).select(counts.columns))
        strings = strings.unionByName(split)
    return scratch.save(counts, "counts"), strings


def share(occurs: Column, total: Column, kept: Column) -> Column:
    """1 + floor(10^9 (occurs + 5) / (total + 5 kept)), in decimals, which don't overflow; null if nothing is kept."""
    wide = lambda c: c.cast("decimal(19,0)")
    above = F.lit(1_000_000_000).cast("decimal(10,0)") * wide(occurs + 5)
    return 1 + F.call_function("div", above, F.nullif(wide(total + 5 * kept), F.lit(0).cast("decimal(19,0)")))


def _pair_sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Each block of terms: for every two sources the sum of the absolute differences of their shares."""
    names = ["lang_id", "low", "high", "value"]
    for batch in batches:
        for i in range(batch.num_rows):
            lang = batch.column("lang_id")[i].as_py()
            sources, cells = batch.column("sources")[i].values, batch.column("cells")[i].values
            ids, zeros = (sources.field(c).to_numpy() for c in ("source_id", "zero"))
            source, digest, variant, p = (cells.field(c).to_numpy() for c in ("source_id", "digest", "variant", "p"))
            term = np.unique(np.stack([digest, variant.astype(np.int64)]), axis=1, return_inverse=True)[1].ravel()
            shares = np.repeat(zeros[:, None], term.max() + 1, axis=1)
            shares[np.searchsorted(ids, source), term] = p
            for k in range(len(ids) - 1):
                sums = np.abs(shares[k + 1 :] - shares[k]).sum(axis=1)
                same = [pa.array(np.full(len(sums), x, np.int64)) for x in (lang, ids[k])]
                yield pa.RecordBatch.from_arrays([*same, pa.array(ids[k + 1 :]), pa.array(sums)], names)


def pair_sums(shares: DataFrame, groups: DataFrame) -> DataFrame:
    """lang_id, low, high, value: for every two sources of a language (low before high by id) the sum of |p - q| over its kept terms.

    shares has lang_id, source_id, digest, variant and p of terms that occur; groups, a written table, lang_id, source_id, kept and
    zero, the share of a term that doesn't. A language's terms are dealt into blocks by hash, so many that each has about BLOCK_CELLS
    cells, but BLOCK_TERMS terms at least; a block makes one row for two sources, whatever its terms.
    """
    listed = groups.groupBy("lang_id").agg(F.sort_array(F.collect_list(F.struct("source_id", "zero"))).alias("sources"), F.max("kept").alias("kept"))
    a_block = F.greatest(F.lit(BLOCK_TERMS), F.lit(BLOCK_CELLS) / F.size("sources"))
    listed = small(listed.withColumn("blocks", F.ceil(F.col("kept") / a_block).cast("int")), BROADCAST_ROWS, of=groups)
    block = F.pmod(F.hash("digest", "variant"), F.col("blocks"))
    dealt = shares.join(listed.select("lang_id", "blocks"), "lang_id").withColumn("block", block)
    cells = dealt.groupBy("lang_id", "block").agg(F.collect_list(F.struct("source_id", "digest", "variant", "p")).alias("cells"))
    made = cells.join(listed, "lang_id").select("lang_id", "sources", "cells").mapInArrow(freeing(_pair_sums), "lang_id long, low long, high long, value long")
    return made.groupBy("lang_id", "low", "high").agg(F.sum("value").alias("value"))


def source_divergence(docs: DataFrame, least: int = LEAST_DOCS, top: int = TOP_TERMS, bits: int = 64, lang: str = "lang", source: str = "source", text: str = "text") -> DataFrame:
    """lang, source, part, item, value, rank: how each source of a language differs from the others ("pair") and from the language ("term").

    Nulls are empty strings. Terms are runs of letters A-Z, lower-cased, and of characters beyond ASCII; those in at least `least` documents
    of a language are kept. A term's share is that of share() by its group's or language's occurrences. "pair" has every other source with
    the sum of absolute differences over kept terms (0 if none is kept), "term" the `top` kept terms that occur in the source with a
    share above the language's, by that difference. Ranks go from 1 by value from the largest, then by item in UTF-8. An empty table
    gives no rows; a language with one source no pairs. Terms are digests until the last join; see kept_counts.
    """
    scratch = Scratch(docs.sparkSession)
    named = docs.select(*[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(n) for c, n in ((lang, "lang"), (source, "source"), (text, "text"))])
    keyed, names = group_ids(named, scratch)
    counts, strings = kept_counts(scratch.save(count_terms(keyed, bits), "terms"), least, scratch)
    strings = scratch.save(strings, "kept")
    totals = counts.groupBy("lang_id", "source_id").agg(F.sum("occurs").alias("total"))
    kept = strings.groupBy("lang_id").agg(F.count("*").alias("kept"))
    whole = F.sum("total").over(Window.partitionBy("lang_id"))
    sized = names.join(totals, ["lang_id", "source_id"], "left").join(kept, "lang_id", "left").fillna(0, ["total", "kept"]).withColumn("lang_total", whole)
    groups = scratch.save(sized.withColumn("zero", share(F.lit(0), F.col("total"), F.col("kept"))), "groups")
    by_group = small(groups.select("lang_id", "source_id", "total", "kept", "lang_total"), BROADCAST_ROWS, of=groups)
    in_lang = F.sum("occurs").over(Window.partitionBy("lang_id", "digest", "variant"))
    shares = counts.withColumn("in_lang", in_lang).join(by_group, ["lang_id", "source_id"])
    shares = shares.select("lang_id", "source_id", "digest", "variant", share(F.col("occurs"), F.col("total"), F.col("kept")).alias("p"), share(F.col("in_lang"), F.col("lang_total"), F.col("kept")).alias("q"))
    shares = scratch.save(shares, "shares")

    told = small(groups.select("lang_id", "source_id", "lang", "source"), BROADCAST_ROWS, of=groups)
    other = told.select("lang_id", F.col("source_id").alias("other_id"), F.col("source").alias("item"))
    sums = pair_sums(shares.select("lang_id", "source_id", "digest", "variant", "p"), groups)
    both = told.join(other, "lang_id").where("source_id <> other_id").select("lang_id", "source_id", "lang", "source", "item", F.least("source_id", "other_id").alias("low"), F.greatest("source_id", "other_id").alias("high"))
    pairs = both.join(sums, ["lang_id", "low", "high"], "left").select("lang", "source", F.lit("pair").alias("part"), "item", F.coalesce("value", F.lit(0)).cast("long").alias("value"))

    ahead = shares.where("p > q").withColumn("value", F.col("p") - F.col("q"))
    near = ahead.withColumn("place", F.rank().over(Window.partitionBy("lang_id", "source_id").orderBy(F.desc("value")))).where(F.col("place") <= top)
    near = scratch.save(near.select("lang_id", "source_id", "digest", "variant", "value"), "near")
    wanted = small(near.select("lang_id", "digest", "variant").distinct(), BROADCAST_ROWS, of=near)
    texts = strings.join(wanted, ["lang_id", "digest", "variant"], "left_semi")
    terms = near.join(texts, ["lang_id", "digest", "variant"]).join(told, ["lang_id", "source_id"]).select("lang", "source", F.lit("term").alias("part"), F.col("term").alias("item"), "value")
    order = Window.partitionBy("lang", "source", "part").orderBy(F.desc("value"), "item")
    return pairs.unionByName(terms).withColumn("rank", F.row_number().over(order)).where((F.col("part") == "pair") | (F.col("rank") <= top))
