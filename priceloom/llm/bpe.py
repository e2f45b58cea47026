"""Exact BPE by backtracking over Aho-Corasick matches, and decoding by an offset table."""

from __future__ import annotations

import hashlib
import json
import re
import unicodedata
from functools import lru_cache, partial
from struct import pack

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql.types import ArrayType, IntegerType, LongType, StringType, StructField

from .arrow import Memo, map_texts
from .tokens import byte_chars

#: Up to here letters, digits and white space are the same in every version of Unicode that the libraries use.
_SETTLED = re.compile(r"[^\x00-\x1b\x20-\x84\x86-ɏ‐-‧]")
_PIECE = re.compile(r"[^\W\d_²³¹¼½¾]+|[^\W_]|'(?:s|t|re|ve|m|ll|d)|(?:[^\w\s]|_)+")
#: What is implemented here of a file of the tokenizers library, fixed values; other files are refused.
NORMALIZER = {"type": "Sequence", "normalizers": [{"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": r"\s+"}, "content": " "}, {"type": "Lowercase"}]}
SPLIT = {"type": "Split", "pattern": {"Regex": r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"}, "behavior": "Removed", "invert": True}
BYTES = {"type": "ByteLevel", "add_prefix_space": False, "use_regex": False}
PLAIN = ("dropout", "unk_token", "continuing_subword_prefix", "fuse_unk", "byte_fallback", "ignore_merges")
#: Bytes that the newer half of a task's cache of encoded words may hold, and that of its cache of pairs; twice as many are held at most.
WORD_BYTES = 24 << 20
PAIR_BYTES = 16 << 20


def refuse(spec: dict) -> None:
    """Raises ValueError, with the reason, for a file that would be encoded or decoded in another way than the library does."""
    model, pre = spec.get("model") or {}, spec.get("pre_tokenizer") or {}
    steps = [{k: v for k, v in step.items() if k != "trim_offsets"} for step in pre.get("pretokenizers", [pre])]
    wrong = None
    if model.get("type") != "BPE" or any(model.get(k) for k in PLAIN):
        wrong = "its model is no plain BPE"
    elif spec.get("normalizer") != NORMALIZER:
        wrong = "it has another normalizer"
    elif pre.get("type") != "Sequence" or steps != [SPLIT, BYTES]:
        wrong = "it has another pre-tokenizer"
    elif spec.get("decoder"):
        wrong = "it has a decoder"
    elif any(x["single_word"] or x["lstrip"] or x["rstrip"] or x["normalized"] for x in spec.get("added_tokens") or []):
        wrong = "an added token takes more than its own text"
    elif len(ids := {*model["vocab"].values(), *(x["id"] for x in spec.get("added_tokens") or [])}) != max(ids) + 1:
        wrong = "its ids have gaps"
    if wrong:
        raise ValueError(f"can't encode by this tokenizer file: {wrong}")


class Backtracker:
    """Encodes words of a byte-level BPE vocabulary whose ids rise with the rank of their merge."""

    def __init__(self, path: str):
        spec = json.load(open(path, encoding="utf-8"))
        refuse(spec)
        model = spec["model"]
        self.suffix = model["end_of_word_suffix"] or ""
        vocab: dict[str, int] = model["vocab"]
        added = sorted(spec.get("added_tokens") or [], key=lambda x: x["id"])
        self.special = {x["content"]: x["id"] for x in added}
        names = {i: t for t, i in vocab.items()} | {i: t for t, i in self.special.items()}
        # A worker keeps these tables, so they are lists by id, and pairs are single numbers.
        self.size = len(names)
        self.merged: dict[int, int] = {}
        self.left, self.right = list(range(self.size)), list(range(self.size))
        for m in model["merges"]:
            a, b = m if isinstance(m, list) else m.split(" ")
            whole = vocab[(a.removesuffix(self.suffix) if self.suffix else a) + b]
            left, right = vocab[a], vocab[b]
            if whole <= max(left, right):
                raise ValueError("ids don't rise with the rank of merges")
            self.merged[left * self.size + right] = whole
            self.left[whole], self.right[whole] = left, right
        # A word's last character is another symbol than the same one inside the word, if the vocabulary marks ends.
        self.trie = ahocorasick.Automaton()
        self.length, self.shorter, key_of = [0] * self.size, [None] * self.size, {}
        for token, i in vocab.items():
            key = self._key(token.removesuffix(self.suffix), True) if self.suffix and token.endswith(self.suffix) and token != self.suffix else token
            self.trie.add_word(key, i)
            key_of[key], self.length[i] = i, len(key)
        self.trie.make_automaton()
        for key, i in key_of.items():
            self.shorter[i] = next((key_of[key[:n]] for n in range(len(key) - 1, 0, -1) if key[:n] in key_of), None)
        self.bytes = byte_chars()
        self.split = re.compile("(" + "|".join(map(re.escape, sorted(self.special, key=len, reverse=True))) + ")") if self.special else None
        table = [names[i].encode() + b" " for i in range(len(names))]
        self.offsets = np.concatenate([[0], np.cumsum([len(t) for t in table])]).astype(np.int64)
        self.blob = np.frombuffer(b"".join(table), np.uint8)

    def _key(self, symbols: str, end: bool) -> str:
        return symbols[:-1] + chr(ord(symbols[-1]) + 0x1000) if end else symbols

    def fits(self, pair: tuple[int, int]) -> bool:
        """Whether merging leaves the two tokens side by side: no merge of a suffix of one and a prefix of the other comes early enough."""
        left, right = pair
        limit = 1 << 60
        while True:
            if self.merged.get(left * self.size + right, limit) < limit:
                return False
            last, first = self.right[left], self.left[right]
            if left > right:
                if last != left:
                    limit, left = left, last
                elif first != right:
                    limit, right = right + 1, first
                else:
                    return True
            elif first != right:
                limit, right = right + 1, first
            elif last != left:
                limit, left = left, last
            else:
                return True

    def word(self, fits: dict, piece: str) -> bytes:
        """The ids of one pre-token, as little-endian 32-bit integers. fits: answers of fits() by pair."""
        text = "".join(map(self.bytes.__getitem__, piece.encode("utf-8")))
        if self.suffix:
            text = text[:-1] + chr(ord(text[-1]) + 0x1000)
        n, lengths = len(text), self.length
        longest = [None] * n
        for end, token in self.trie.iter(text):  # ends only grow, so the last token of a start is its longest
            longest[end - lengths[token] + 1] = token
        out: list[int] = []
        open_at = [True] * (n + 1)
        at, token = 0, longest[0]
        while at < n:
            before = out[-1] if out else None
            while token is not None:
                end = at + lengths[token]
                if open_at[end] and (before is None or fits[before, token]):
                    break
                token = self.shorter[token]
            if token is not None:
                out.append(token)
                at = end
                token = longest[at] if at < n else None
            elif before is None:
                raise ValueError(f"no encoding of {piece!r}")
            else:  # nothing fits after the last token: a shorter one must stand there
                open_at[at] = False
                out.pop()
                at -= lengths[before]
                token = before
        return pack(f"<{len(out)}I", *out)

    def decode(self, ids: np.ndarray) -> bytes:
        """UTF-8 of the tokens' strings with a space between, gathered by the offset table."""
        if not len(ids):
            return b""
        start = self.offsets[ids]
        size = self.offsets[ids.astype(np.int64) + 1] - start
        ends = np.cumsum(size)
        index = np.arange(ends[-1]) + np.repeat(start - (ends - size), size)
        return self.blob[index].tobytes()[:-1]


@lru_cache(2)
def backtracker(path: str) -> Backtracker:
    return Backtracker(path)


@lru_cache(2)
def _splitter(path: str):
    """The library's tokenizer without its vocabulary: normalizer and pre-tokenizer are all that is used of it."""
    from tokenizers import Tokenizer

    spec = json.load(open(path, encoding="utf-8"))
    return Tokenizer.from_str(json.dumps(spec | {"added_tokens": [], "post_processor": None, "model": {"type": "BPE", "vocab": {}, "merges": []}}))


def _pieces(path: str, text: str) -> list[str]:
    """Pre-tokens, as the file's normalizer and pre-tokenizer give them; the library is loaded where characters ask for it."""
    if _SETTLED.search(text):
        tok = _splitter(path)
        normal = tok.normalizer.normalize_str(text) if tok.normalizer else text
        back = {c: b for b, c in byte_chars().items()}
        return [bytes(map(back.__getitem__, x)).decode("utf-8", "surrogateescape") for x, _ in tok.pre_tokenizer.pre_tokenize_str(normal)]
    return _PIECE.findall(unicodedata.normalize("NFC", text).lower())


def _encoder(path: str, keep_ids: bool, keep_text: bool):
    bpe = backtracker(path)
    # The caches are the task's own: kept by the worker, they would stand beside what later stages need.
    words = Memo(partial(bpe.word, Memo(bpe.fits, PAIR_BYTES)), WORD_BYTES)
    special = {t: np.array([i], "<u4").tobytes() for t, i in bpe.special.items()}

    def ids_of(text: str) -> bytes:
        if bpe.split is None:
            parts = [text]
        else:
            parts = bpe.split.split(text)
        made = []
        for part in parts:
            if part in special:
                made.append(special[part])
            elif part:
                made.extend(map(words.__getitem__, _pieces(path, part)))
        return b"".join(made)

    def encode(texts: list) -> list:
        n, ids, id_hash, texts_out, text_hash = [], [], [], [], []
        for text in texts:
            raw = ids_of(text or "")
            array = np.frombuffer(raw, "<u4")
            said = bpe.decode(array)
            n.append(len(array))
            id_hash.append(hashlib.sha256(raw).hexdigest())
            text_hash.append(hashlib.sha256(said).hexdigest())
            if keep_ids:
                ids.append(array.astype(np.int32))
            if keep_text:
                texts_out.append(said.decode("utf-8"))
        return [n, id_hash, text_hash, *([pa.array(ids, pa.list_(pa.int32()))] if keep_ids else []), *([texts_out] if keep_text else [])]

    return encode


def bpe_round_trip(df: DataFrame, path: str, text: str = "text", keys: tuple = ("doc_id",), keep_ids: bool = True, keep_text: bool = True) -> DataFrame:
    """keys, n_tokens, ids_sha256 and decoded_sha256 of each text, with ids (array) and decoded (string) if kept.

    path: a BPE file of the tokenizers library (NFC, lower case, words with an end mark); any other raises ValueError in the tasks. Null and empty texts have no ids and
    decode to the empty string. Special strings inside a text are their single tokens. Long texts need 4 bytes a token and one
    list of their words. Repeated rows each give a row, an empty table gives none; further columns are left out.
    """
    fields = [StructField("n_tokens", LongType()), StructField("ids_sha256", StringType()), StructField("decoded_sha256", StringType())]
    fields += [StructField("ids", ArrayType(IntegerType()))] * keep_ids + [StructField("decoded", StringType())] * keep_text
    return map_texts(df, partial(_encoder, path, keep_ids, keep_text), fields, keys, text)
