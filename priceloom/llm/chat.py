"""Chat formatting: conversations rendered whole, encoded once with offsets, masked by turn spans."""

from __future__ import annotations

import re
from dataclasses import dataclass
from functools import lru_cache, partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BooleanType, IntegerType, LongType, StringType, StructField, StructType

from .arrow import freeing, map_texts
from .tokens import SETTLED, safe_pieces, with_special

PIECE_CHARS = 4 << 20

#: The template's control strings. Each is a token of its own, so no token crosses the edge of a text.
START, TEXT, END = "<|im_start|>", "<|im_sep|>", "<|im_end|>"
_ESCAPE = re.compile(r"<(\\*)\|")
_UNESCAPE = re.compile(r"<\\(\\*)\|")
_TURN = re.compile(re.escape(START) + "(.*?)" + re.escape(TEXT) + "(.*?)" + re.escape(END), re.S)


def escape(text: str) -> str:
    """Puts one more backslash between each < and |, whatever backslashes stand there: no control string is left."""
    return _ESCAPE.sub(lambda m: f"<{m[1]}\\|", text)


def unescape(text: str) -> str:
    return _UNESCAPE.sub(lambda m: f"<{m[1]}|", text)


@dataclass(frozen=True)
class Rendered:
    text: str
    starts: list[int]  # of the escaped texts, in characters
    ends: list[int]
    roles: list[str]


def render(turns: list[tuple[str, str]]) -> Rendered:
    parts, starts, ends, at = [], [], [], 0
    for role, text in turns:
        head, body = f"{START}{escape(role)}{TEXT}", escape(text)
        parts += [head, body, END]
        starts.append(at + len(head))
        ends.append(starts[-1] + len(body))
        at = ends[-1] + len(END)
    return Rendered("".join(parts), starts, ends, [r for r, _ in turns])


def parse(text: str) -> list[tuple[str, str]]:
    """The turns that render() made the text from."""
    return [(unescape(m[1]), unescape(m[2])) for m in _TURN.finditer(text)]


@lru_cache(2)
def _tokenizer(path: str):
    import os

    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import AddedToken, Tokenizer

    tok = Tokenizer.from_file(path)
    tok.no_truncation()
    tok.no_padding()
    tok.add_special_tokens([AddedToken(x, normalized=False, special=True) for x in (START, TEXT, END)])
    return tok


class _Encoder:
    """Ids and (first, end) characters of a text's tokens.

    Where the vocabulary is of the kind that tiktoken reads alike (tokens._fast) and the text holds characters of settled classes
    only, that library encodes; spans then follow from the tokens' lengths in bytes. The tokenizers library does the rest.
    """

    def __init__(self, path: str):
        self.tok = _tokenizer(path)
        own = {x: self.tok.token_to_id(x) for x in (START, TEXT, END)}
        self.fast = with_special(path, own)
        if self.fast:
            self.sizes = np.zeros(self.fast.max_token_value + 1, np.int64)
            for token, i in self.fast._mergeable_ranks.items():
                self.sizes[i] = len(token)
            for token, i in own.items():
                self.sizes[i] = len(token)

    def __call__(self, text: str) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """A text of over PIECE_CHARS is cut where tokens end in any case."""
        parts, at = [], 0
        for piece in safe_pieces(text, PIECE_CHARS):
            ids, first, end = self._quick(piece) if self.fast and not SETTLED.search(piece) else self._slow(piece)
            parts.append((ids, first + at, end + at))
            at += len(piece)
        return parts[0] if len(parts) == 1 else tuple(map(np.concatenate, zip(*parts)))

    def _quick(self, text: str) -> tuple:
        ids = np.array(self.fast.encode(text, allowed_special="all"), np.int32)
        sizes = self.sizes[ids]
        end = np.cumsum(sizes)
        first = end - sizes
        if not text.isascii():
            number = np.cumsum(np.frombuffer(text.encode(), np.uint8) & 0xC0 != 0x80) - 1  # of the character that holds a byte
            first, end = number[first], number[end - 1] + 1
        return ids, first.astype(np.int32), end.astype(np.int32)

    def _slow(self, text: str) -> tuple:
        made = self.tok.encode(text, add_special_tokens=False)
        spans = np.array(made.offsets, np.int32).reshape(-1, 2)
        return np.array(made.ids, np.int32), spans[:, 0], spans[:, 1]


def _mask(first: np.ndarray, end: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Whether a token lies in one of the sorted spans: by binary search for the last that starts at or before it."""
    if not len(starts) or not len(first):
        return np.zeros(len(first), bool)
    at = np.searchsorted(starts, first, "right") - 1
    return (at >= 0) & (end <= ends[at]) & (end > first)


def _lists(parts: list[np.ndarray], kind: pa.DataType) -> pa.ListArray:
    offsets = np.concatenate([[0], np.cumsum([len(x) for x in parts])]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.concatenate(parts) if parts else [], kind))


def _formatter(path: str, loss_roles: frozenset):
    encode = _Encoder(path)

    def form(column: pa.ListArray) -> list:
        said = column.flatten()
        turns = list(zip(said.field("role").to_pylist(), said.field("text").to_pylist()))
        texts, ids, masks, firsts, ends, at = [], [], [], [], [], 0
        for n in column.value_lengths().to_pylist():
            r = render(turns[at : at + n])
            at += n
            learn = np.array([role in loss_roles for role in r.roles], bool)
            found, first, end = encode(r.text)
            texts.append(r.text)
            ids.append(found)
            masks.append(_mask(first, end, np.array(r.starts, np.int64)[learn], np.array(r.ends, np.int64)[learn]))
            firsts.append(first)
            ends.append(end)
        return [texts, _lists(ids, pa.int32()), _lists(masks, pa.bool_()), _lists(firsts, pa.int32()), _lists(ends, pa.int32())]

    return form


def format_conversations(df: DataFrame, path: str, loss_roles: tuple = ("assistant",), conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """One row a conversation: formatted, token ids, loss_mask (by token), and first and end character of each token.

    path: a file of the tokenizers library; the template's control strings join it as special tokens. Turns come by number; those
    with equal numbers by role, then text; repeated rows are turns of their own; a null turn comes first. Null roles and texts are
    empty, and an empty text has no tokens under the mask. Rows with a null conversation form one conversation with id null.
    Control strings inside roles and texts are escaped reversibly. A conversation is one value and is held by one task, one at a
    time; texts over PIECE_CHARS are encoded in parts. An empty table gives no rows; further columns are left out.
    """
    rows = df.select(F.col(conv).alias("conv_id"), F.struct(F.col(turn).alias("turn"), F.coalesce(role, F.lit("")).alias("role"), F.coalesce(text, F.lit("")).alias("text")).alias("said"))
    whole = rows.groupBy("conv_id").agg(F.sort_array(F.collect_list("said")).alias("turns"))
    ints = ArrayType(IntegerType())
    fields = [StructField("formatted", StringType()), StructField("ids", ints), StructField("loss_mask", ArrayType(BooleanType())), StructField("token_first", ints), StructField("token_end", ints)]
    return map_lists(whole, partial(_formatter, path, frozenset(loss_roles)), fields, ("conv_id",), "turns")


def map_lists(df: DataFrame, make, fields: list[StructField], keys: tuple, column: str) -> DataFrame:
    """As map_texts for a column of lists or structs, a few rows at a time, which the function gets as an Arrow array."""
    from pyspark.sql.pandas.types import to_arrow_schema

    source = df.select(*keys, column)
    schema = StructType([source.schema[k] for k in keys] + fields)
    types = [f.type for f in to_arrow_schema(StructType(fields))]
    names = schema.fieldNames()

    def run(batches):
        work = make()
        for batch in batches:
            step = max(1, min(256, batch.num_rows * (4 << 20) // max(1, batch.nbytes)))
            for i in range(0, batch.num_rows, step):
                part = batch.slice(i, step)
                out = work(part.column(column))
                made = [x if isinstance(x, pa.Array) else pa.array(x, t) for x, t in zip(out, types, strict=True)]
                yield pa.RecordBatch.from_arrays([*(part.column(k) for k in keys), *made], names)

    return source.mapInArrow(freeing(run), schema)


def _digester():
    import hashlib

    def digest(made: pa.StructArray) -> list:
        texts, lists = made.field("formatted").to_pylist(), [made.field(c) for c in ("loss_mask", "token_first", "token_end")]
        masks, firsts, ends = (x.flatten().to_numpy(zero_copy_only=False) for x in lists)
        rows, at = [], 0
        for text, n in zip(texts, lists[0].value_lengths().to_pylist()):
            turns = parse(text)
            sha = hashlib.sha256("".join(f"{role}\n{said}\n" for role, said in turns).encode("utf-8", "surrogatepass"))
            mask = masks[at : at + n]
            first, end = firsts[at : at + n][mask], ends[at : at + n][mask]
            at += n
            # Tokens that hold parts of one character have the same span; runs of touching spans are joined and read once.
            new = np.flatnonzero(np.concatenate([[True], first[1:] > end[:-1]])) if len(first) else first
            learned = [unescape(text[a:b]) for a, b in zip(first[new].tolist(), end[np.append(new[1:], len(first)) - 1].tolist())] if len(first) else []
            loss = hashlib.sha256("".join(learned).encode("utf-8", "surrogatepass")).hexdigest()
            rows.append((len(turns), sha.hexdigest(), sum(map(len, learned)), loss, len(text)))
        return list(zip(*rows)) or [[]] * 5

    return digest


def digests(formatted: DataFrame) -> DataFrame:
    """conv_id and what can be read back from format_conversations: n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars."""
    packed = formatted.select("conv_id", F.struct("formatted", "loss_mask", "token_first", "token_end").alias("made"))
    fields = [StructField("n_turns", LongType()), StructField("turns_sha256", StringType()), StructField("loss_chars", LongType()), StructField("loss_sha256", StringType()), StructField("formatted_chars", LongType())]
    return map_lists(packed, _digester, fields, ("conv_id",), "made")
