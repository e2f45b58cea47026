"""A corpus pipeline: documents filtered, made distinct, mixed and encoded, each stage over all that the one before kept."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from priceloom.llm import bpe, jaccard, mixing, rules, toxicity
from priceloom.llm.arrow import Scratch, crc_mod


def _apart(docs: DataFrame) -> tuple[DataFrame, dict[str, str]]:
    """docs with names that no operator's own columns have, and the new name of each column."""
    names = {c: f"column_{k}" for k, c in enumerate(docs.columns)}
    return docs.toDF(*names.values()), names


def _back(kept: DataFrame, names: dict[str, str]) -> DataFrame:
    return kept.select(*[F.col(new).alias(old) for old, new in names.items()])


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules keep."""
    df, names = _apart(docs)
    return _back(rules.quality_rules(df, text=names["text"], keys=tuple(names.values())).where("kept"), names)


def harmless(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity model, learnt from labelled ones among them, scores below 0.5."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    model = toxicity.train(docs, labels, crc_mod("doc_id", 5) != 0)
    df, names = _apart(docs)
    return _back(toxicity.score_toxicity(df, model, text=names["text"], keys=tuple(names.values())).where(F.col("score") < 0.5), names)


def distinct(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest doc_id of each component of near copies."""
    scratch = Scratch(spark)
    found = scratch.save(jaccard.jaccard_components(docs, 5, 80), "components")
    return jaccard.keep_one(docs, found, scratch)


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix takes it, from no to three times; those without doc_id too, each for itself."""
    df, names = _apart(docs)
    taken = mixing.mix_sources(df, (1, 2, 3), 3.0, key=names["doc_id"], source=names["source"], text=names["text"], row=mixing.row_key(df))
    return _back(mixing.repeat_documents(df, taken), names)


def encoded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, source, n_tokens, ids and the digests of ids and decoded text of each document of the mix."""
    path = public_tokenizers.path("word_bpe_49k.json")
    return bpe.bpe_round_trip(docs, path, keys=("doc_id", "source"), keep_text=False)


STAGES = [("quality rules", quality), ("toxicity", harmless), ("near duplicates", distinct), ("source mix", mixed), ("bpe", encoded)]

#: The stages' verdicts come from models, zstandard and tokenizers, which SQL can't express.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents; each but the last is written to the shared folder and read again."""
    scratch, docs = Scratch(spark), spark.read.parquet(f"{sf_dir}/documents.parquet")
    for number, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if number < len(STAGES) - 1:
            docs = scratch.save(docs, f"stage{number}")
    return docs
