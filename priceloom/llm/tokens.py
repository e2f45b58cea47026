"""Token counts: lengths from batch encoding, nothing else leaves the Arrow function."""

from __future__ import annotations

import json
import os
import re
from functools import lru_cache, partial

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField

from .arrow import map_texts

BATCH_BYTES = 1 << 20
PIECE_CHARS = 1 << 18

#: A byte-level pre-tokeniser never joins a character with the white space after it, so each change from another character to
#: white space is a safe boundary: the parts encode as they do within the whole.
_SAFE = re.compile(r"(?<=\S)(?=[ \n])")
#: Up to here letters, digits and white space are the same in every version of Unicode that the two libraries use.
SETTLED = re.compile(r"[^\x00-\x1b\x20-\x84\x86-\u024f\u2010-\u2027]")
#: The pattern of byte-level pre-tokenisers of this kind, a fixed value.
_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


@lru_cache(4)
def load(path: str):
    """The tokenizer in the file at path, without truncation and padding, on the calling thread alone."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    found = Tokenizer.from_file(path)
    found.no_truncation()
    found.no_padding()
    return found


def safe_pieces(text: str, size: int = PIECE_CHARS):
    """Parts of at least size characters that encode as they do within text; a text without a boundary stays whole."""
    at = 0
    while len(text) - at > size:
        cut = _SAFE.search(text, at + size)
        if not cut:
            break
        yield text[at : cut.start()]
        at = cut.start()
    yield text[at:]


def _batches(parts: list[tuple[int, str]], most: int):
    """Groups of parts of about most bytes of UTF-8 together."""
    held, size = [], 0
    for part in parts:
        n = len(part[1]) if part[1].isascii() else len(part[1].encode("utf-8", "surrogatepass"))
        if held and size + n > most:
            yield held
            held, size = [], 0
        held.append(part)
        size += n
    if held:
        yield held


@lru_cache(4)
def _fast(path: str):
    return with_special(path, {})


def with_special(path: str, special: dict[str, int]):
    """The same vocabulary as ranks for tiktoken, which encodes several times as fast; None where the file isn't of that kind."""
    spec = json.load(open(path, encoding="utf-8"))
    model, before = spec["model"], spec["pre_tokenizer"] or {}
    vocab = model["vocab"]
    plain = spec["normalizer"] is None and before.get("type") == "ByteLevel" and not before["add_prefix_space"] and before.get("use_regex", True)
    if not plain or any(model.get(k) for k in ("dropout", "unk_token", "continuing_subword_prefix", "end_of_word_suffix", "ignore_merges")):
        return None
    made = [vocab["".join(m if isinstance(m, list) else m.split(" "))] for m in model["merges"]]
    if any(a >= b for a, b in zip(made, made[1:])):
        return None
    import tiktoken

    back = {c: b for b, c in byte_chars().items()}
    ranks = {bytes(map(back.__getitem__, token)): i for token, i in vocab.items()}
    return tiktoken.Encoding("own", pat_str=_PATTERN, mergeable_ranks=ranks, special_tokens=special)


def byte_chars() -> dict[int, str]:
    """The printable character that stands for each byte in byte-level vocabularies."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {b: chr(b) for b in plain} | {b: chr(256 + i) for i, b in enumerate(rest)}


def _counter(path: str):
    """texts -> their numbers of tokens. Pieces that both libraries read alike go to the faster one."""
    tok, fast = load(path), _fast(path)
    special = [t.content for t in tok.get_added_tokens_decoder().values()]
    split = re.compile("|".join(map(re.escape, sorted(special, key=len, reverse=True)))) if special else None

    def count(texts: list) -> list:
        out = np.zeros(len(texts), np.int64)
        quick, slow = [], []
        for i, text in enumerate(texts):
            for piece in safe_pieces(text or ""):
                if fast is None or SETTLED.search(piece):
                    slow.append((i, piece))
                    continue
                parts = split.split(piece) if split else [piece]
                out[i] += len(parts) - 1
                quick += [(i, part) for part in parts if part]
        for group in _batches(quick, BATCH_BYTES):
            for (i, _), ids in zip(group, fast.encode_ordinary_batch([x for _, x in group], num_threads=1)):
                out[i] += len(ids)
        for group in _batches(slow, BATCH_BYTES):
            for (i, _), made in zip(group, tok.encode_batch([x for _, x in group], add_special_tokens=False)):
                out[i] += len(made.ids)
        return [out]

    return count


def count_tokens(df: DataFrame, path: str, limit: int = 1024, text: str = "text", keys: tuple = ("doc_id",)) -> DataFrame:
    """keys, n_bytes (UTF-8), n_tokens and over_limit (n_tokens > limit) of each text.

    path: a byte-level BPE file of the tokenizers library. No begin, end or added tokens, no truncation; special strings inside
    texts are single tokens, as by the library's default. Null and empty texts have 0 bytes and tokens. Long texts are cut at
    safe boundaries (one without any stays whole) and batches hold about BATCH_BYTES. Rows with equal keys or texts each give a row;
    an empty table gives none; further columns are left out.
    """
    n = f"{text}_bytes_"
    sized = df.select(*keys, text, F.coalesce(F.octet_length(text), F.lit(0)).cast("long").alias(n))
    out = map_texts(sized, partial(_counter, path), [StructField("n_tokens", LongType())], (*keys, n), text)
    return out.select(*keys, F.col(n).alias("n_bytes"), "n_tokens", (F.col("n_tokens") > limit).alias("over_limit"))
