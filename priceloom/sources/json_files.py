"""JSON documents of any size: written as sorted pieces that are joined as bytes, read by ranges of bytes."""

from __future__ import annotations

import json
import re
import uuid
from collections.abc import Iterator, Sequence
from itertools import pairwise

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

#: Bytes of a range that one task reads, and how far a task looks back for the name of an array.
RANGE_BYTES, BACK_BYTES = 32 << 20, 4096

#: What a scan is in at a place: plain JSON, a string, or a string just after a backslash.
PLAIN, STRING, ESCAPED = range(3)
_PLAIN, _STRING = re.compile(rb'["\[\]{}]'), re.compile(rb'["\\]')
_NAME = re.compile(rb'"((?:[^"\\]|\\.)*)"\s*:\s*\[\Z', re.S)


class Store:
    """A file system as Spark reaches it, for whole files."""

    def __init__(self, spark: SparkSession, path: str):
        self.jvm, self.conf = spark._jvm, spark._jsparkSession.sessionState().newHadoopConf()
        self.fs = self.path(path).getFileSystem(self.conf)

    def path(self, said: str):
        return self.jvm.org.apache.hadoop.fs.Path(said)

    def parts(self, folder: str) -> list[tuple[str, int]]:
        """Name and size of a written folder's files that hold something, in order."""
        found = [(f.getPath().toString(), f.getLen()) for f in self.fs.globStatus(self.path(f"{folder}/part-*")) or []]
        return sorted(x for x in found if x[1])

    def append(self, out, source: str, count: int) -> None:
        """Copies the first count bytes of a file to an open one, by pieces."""
        into = self.fs.open(self.path(source))
        self.jvm.org.apache.commons.io.IOUtils.copyLarge(into, out, 0, count)
        into.close()


def json_row(columns: Sequence[str], indent: int = 4) -> Column:
    """The columns as a JSON object with a line for each, indented; nulls are left out."""
    value = lambda c: F.expr(f"substr(to_json(array(`{c}`)), 2, length(to_json(array(`{c}`))) - 2)")
    said = F.array(*[F.when(F.col(f"`{c}`").isNotNull(), F.concat(F.lit(f"{' ' * (indent + 2)}{json.dumps(c, ensure_ascii=False)}: "), value(c))) for c in columns])
    return F.concat(F.lit(" " * indent + "{\n"), F.array_join(said, ",\n"), F.lit("\n" + " " * indent + "}"))


def write_json(spark: SparkSession, path: str, fields: dict, lists: dict[str, tuple[DataFrame, list[str]]], mirror: str | None = None) -> None:
    """A JSON object in one file: fields, then an array of rows for each of lists (name: rows and the columns that sort them).

    Rows are written by all tasks as pieces sorted by range, and these joined as bytes, by copies of bounded pieces: no task and no frame
    holds the document. The file is replaced whole, by a rename. mirror gets a copy if its folder exists.
    """
    store, end = Store(spark, path), "/" + uuid.uuid4().hex
    at = path.rstrip("/") + ".pieces" + end
    for k, (rows, order) in enumerate(lists.values()):
        made = rows.orderBy(*order).select(json_row(rows.columns).alias("value"))
        made.write.option("lineSep", ",\n").text(f"{at}/{k}")
    beside = store.path(f"{at}/whole")
    out = store.fs.create(beside, True)
    put = lambda said: out.write(bytearray(said.encode()))
    put("{\n" + "".join(f"  {json.dumps(k, ensure_ascii=False)}: {json.dumps(v, ensure_ascii=False)},\n" for k, v in fields.items()).removesuffix("" if lists else ",\n"))
    for k, name in enumerate(lists):
        parts = store.parts(f"{at}/{k}")
        put((",\n" if k else "") + f"  {json.dumps(name, ensure_ascii=False)}: [" + ("\n" if parts else ""))
        for n, (part, size) in enumerate(parts):
            store.append(out, part, size - (2 if n == len(parts) - 1 else 0))  # the last row has no comma
        put("\n  ]" if parts else "]")
    put("\n}\n")
    out.close()
    store.fs.delete(store.path(path), True)
    if not store.fs.rename(beside, store.path(path)):
        raise OSError(f"{path} can't be written")
    store.fs.delete(store.path(at.removesuffix(end)), True)
    if mirror:
        other = Store(spark, mirror)
        if other.fs.exists(store.path(mirror).getParent() or store.path("/")):
            store.jvm.org.apache.hadoop.fs.FileUtil.copy(store.fs, store.path(path), other.fs, other.path(mirror), False, True, store.conf)


def scan(data: bytes, state: int) -> Iterator[tuple[int, int]]:
    """Place and byte of each bracket outside of strings; at last the state at the end, with place -1."""
    at, n = 0, len(data)
    while at < n:
        if state == ESCAPED:
            at, state = at + 1, STRING
            continue
        found = (_STRING if state == STRING else _PLAIN).search(data, at)
        if not found:
            break
        at, byte = found.end(), data[found.start()]
        if state == STRING:
            state = PLAIN if byte == 0x22 else ESCAPED
        elif byte == 0x22:
            state = STRING
        else:
            yield found.start(), byte
    yield -1, state


def _read(path: str, first: int, last: int) -> bytes:
    from pyarrow import fs

    at, place = fs.FileSystem.from_uri(path if "://" in path else "file://" + path.removeprefix("file:"))
    with at.open_input_file(place) as file:
        file.seek(first)
        return file.read(last - first)


def _size(path: str) -> int:
    from pyarrow import fs

    at, place = fs.FileSystem.from_uri(path if "://" in path else "file://" + path.removeprefix("file:"))
    return at.get_file_info(place).size


def _mapped(ranges: DataFrame, work, schema: str) -> DataFrame:
    """work(row) yields rows of the schema for each range; a task for each."""
    names = [f.split()[0] for f in schema.split(", ")]
    kinds = {"long": pa.int64(), "int": pa.int32(), "string": pa.string()}
    types = pa.schema([(f.split()[0], kinds[f.split()[1]]) for f in schema.split(", ")])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                held, size = [], 0
                for made in work(row):
                    held.append(dict(zip(names, made)))
                    size += len(str(made[-1]))
                    if size > 4 << 20:
                        yield pa.RecordBatch.from_pylist(held, types)
                        held, size = [], 0
                yield pa.RecordBatch.from_pylist(held, types)

    return ranges.mapInArrow(run, schema)


def array_elements(spark: SparkSession, path: str, name: str, range_bytes: int = RANGE_BYTES) -> DataFrame:
    """place and value (JSON text) of the objects in the array `name` of a document's outermost object, by tasks that each read a range of bytes.

    Whether a place is in a string, and how deep, depends on all before it. So each range is first scanned from each state that it can
    begin in; the driver chains these (a row for each range and state), and only then are elements cut out, by the task in whose range they begin. path is one file
    in a store that pyarrow reaches, in UTF-8. Without such an array there are no rows; of a name that stands twice the first array counts.
    """
    size = _size(path)
    cuts = [*range(0, size, range_bytes), size]
    pairs = [(k, a, b) for k, (a, b) in enumerate(pairwise(cuts))]
    if not pairs:
        return spark.createDataFrame([], "place long, value string")
    ranges = spark.createDataFrame(pairs, "k long, first long, last long").repartition(len(pairs), "k")

    def chained(row: dict) -> Iterator[tuple]:
        data = _read(path, row["first"], row["last"])
        for state in (PLAIN, STRING, ESCAPED):
            depth = 0
            for at, byte in scan(data, state):
                if at < 0:
                    yield row["k"], state, byte, depth
                else:
                    depth += 1 if byte in b"[{" else -1

    told = {(r["k"], r["state"]): (r["next"], r["depth"]) for r in _mapped(ranges, chained, "k long, state int, next int, depth long").collect()}
    state, depth, begun = PLAIN, 0, []
    for k, first, last in pairs:
        begun.append((k, first, last, state, depth))
        state, more = told[k, state]
        depth += more
    ranges = spark.createDataFrame(begun, "k long, first long, last long, state int, depth long").repartition(len(pairs), "k")

    def arrays(row: dict) -> Iterator[tuple]:
        """Where arrays right in the outermost object begin, and where they end."""
        back = max(0, row["first"] - BACK_BYTES)
        data = _read(path, back, row["last"])
        depth, skip = row["depth"], row["first"] - back
        for at, byte in scan(data[skip:], row["state"]):
            if at < 0:
                return
            if byte in b"[{":
                depth += 1
            named = _NAME.search(data[max(0, skip + at + 1 - BACK_BYTES) : skip + at + 1]) if byte == 0x5B and depth == 2 else None
            if named:
                yield row["first"] + at, json.loads(b'"' + named[1] + b'"')
            elif byte == 0x5D and depth == 2:
                yield row["first"] + at, None
            depth -= byte in b"]}"

    found = sorted((r["place"], r["name"]) for r in _mapped(ranges, arrays, "place long, name string").collect())
    span = next(((a, b) for (a, said), (b, end) in pairwise([*found, (size, None)]) if said == name), None)
    if span is None:
        return spark.createDataFrame([], "place long, value string")
    inside = ranges.where((F.col("last") > span[0]) & (F.col("first") < span[1]))

    def elements(row: dict) -> Iterator[tuple]:
        """The objects that begin in the range, read on beyond its end where they go on."""
        data, depth, start, at0, state = _read(path, row["first"], row["last"]), row["depth"], None, 0, row["state"]
        while True:
            for at, byte in scan(data[at0:], state):
                if at < 0:
                    state = byte
                    break
                place = at0 + at
                if byte in b"[{":
                    depth += 1
                    if byte == 0x7B and depth == 3 and start is None and span[0] < row["first"] + place < span[1]:
                        if row["first"] + place >= row["last"]:
                            return
                        start = place
                else:
                    if byte == 0x7D and depth == 3 and start is not None:
                        yield row["first"] + start, data[start : place + 1].decode()
                        start = None
                    depth -= 1
            at0, more = len(data), _read(path, row["first"] + len(data), min(size, row["first"] + 2 * len(data))) if start is not None else b""
            if not more:
                return
            data += more

    return _mapped(inside, elements, "place long, value string")


def read_array(spark: SparkSession, path: str, name: str, schema: StructType | str, range_bytes: int = RANGE_BYTES) -> DataFrame:
    """place (of the object's first byte, which rises in the array's order) and the fields of array_elements."""
    rows = array_elements(spark, path, name, range_bytes)
    return rows.select("place", F.from_json("value", schema).alias("e")).select("place", "e.*")
