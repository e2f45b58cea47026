"""Quality rules: word, symbol and repetition counts, then zstandard ratios held to bands by length."""

from __future__ import annotations

from dataclasses import dataclass
from functools import partial

import numpy as np
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql.types import BooleanType, DoubleType, LongType, StringType, StructField

from .arrow import WORD, byte_hash, grams, map_texts

SYMBOLS = "#*$%&|<>"
BLANK = " \t\n\v\f\r"


@dataclass(frozen=True)
class Bands:
    """Limits on compressed / raw bytes.

    whole: (least bytes, lowest, highest ratio) by length of the document, the last whose least bytes it reaches holds. Short
    texts compress less, so their bands lie higher. chunk_bytes, chunk_low, chunk_high: for each chunk of fixed size, the last of
    which ends with the text and may overlap the one before; a document is rejected when over chunk_share of them lie outside.
    """

    whole: tuple = ((0, 0.10, 1.30), (256, 0.20, 0.95), (1024, 0.18, 0.85), (4096, 0.15, 0.75), (16384, 0.12, 0.70))
    chunk_bytes: int = 4096
    chunk_low: float = 0.15
    chunk_high: float = 0.75
    chunk_share: float = 0.25
    level: int = 3


def _repeated(h: np.ndarray) -> int:
    """Words inside 3-word windows that are found twice or more."""
    g = grams(h, 3)
    if not len(g):
        return 0
    _, place, count = np.unique(g, return_inverse=True, return_counts=True)
    twice = count[place] > 1
    covered = np.zeros(len(h), bool)
    for k in range(3):
        covered[k : k + len(g)] |= twice
    return int(covered.sum())


def _rules(bands: Bands):
    zstd = zstandard.ZstdCompressor(level=bands.level)

    def verdict(raw: bytes) -> tuple:
        n = len(raw)
        ratio = len(zstd.compress(raw)) / n if n else None
        size = bands.chunk_bytes
        starts = [*range(0, n - size + 1, size), *([n - size] if n > size and n % size else [])]
        parts = [len(zstd.compress(raw[i : i + size])) / size for i in starts]
        low, high = next((lo, hi) for least, lo, hi in reversed(bands.whole) if n >= least)
        outside = sum(not bands.chunk_low <= x <= bands.chunk_high for x in parts)
        why = None
        if n and ratio < low:
            why = "repetitive"
        elif n and ratio > high:
            why = "incompressible"
        elif parts and outside > bands.chunk_share * len(parts):
            why = "chunks"
        return ratio, min(parts, default=None), max(parts, default=None), why

    def measure(texts: list) -> list:
        rows = []
        for text in texts:
            text = text or ""
            raw = text.encode("utf-8", "surrogatepass")
            h = byte_hash().of(raw)
            n_chars = len(text) - sum(map(text.count, BLANK))
            seen, again = set(), 0
            for line in text.split("\n"):
                if WORD.search(line):
                    again += line in seen
                    seen.add(line)
            repeat = _repeated(h)
            failed = len(h) < 50 or 100 * repeat > 50 * len(h)
            ratio, least, most, why = verdict(raw)
            rows.append((len(h), n_chars, sum(map(text.count, SYMBOLS)), again, repeat, failed, not failed and why is None, ratio, least, most, "base" if failed else why))
        return list(zip(*rows)) or [[]] * 11

    return measure


def quality_rules(df: DataFrame, bands: Bands = Bands(), text: str = "text", keys: tuple = ("doc_id",)) -> DataFrame:
    """Counts, ratios and verdict of each text.

    n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words; base_failed (under 50 words, or over half of the words in
    repeated 3-word windows); kept: neither base_failed nor outside a compression band. zstd_ratio, chunk_min, chunk_max
    (null without bytes or chunks: shorter texts have none) and reason (null if kept) follow. Null texts count as empty, which base_failed rejects.
    Long texts are hashed piecewise; every byte is compressed. Repeated rows each give a row, an empty table gives none;
    further columns are left out.
    """
    kinds = [("n_words", LongType()), ("word_chars", LongType()), ("n_symbols", LongType()), ("n_dup_lines", LongType()), ("n_repeat_words", LongType()), ("base_failed", BooleanType()), ("kept", BooleanType()), ("zstd_ratio", DoubleType()), ("chunk_min", DoubleType()), ("chunk_max", DoubleType()), ("reason", StringType())]
    return map_texts(df, partial(_rules, bands), [StructField(*k) for k in kinds], keys, text)
