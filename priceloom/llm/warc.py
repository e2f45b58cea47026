"""WARC archives: a data source that writes a record for each row, one gzip member each, and reads archives sequentially."""

from __future__ import annotations

import base64
import hashlib
import posixpath
import re
import uuid
import zlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, DataSourceReader, InputPartition, WriterCommitMessage

from .arrow import Scratch, noted, shared_dir, small

#: What the writer takes and the reader returns; page_id names a record, refers_to the record that a revisit repeats.
PAGES = "page_id long, url string, record_type string, refers_to long, html string"
READ = "page_id long, url string, record_type string, refers_to long, payload_bytes long, payload_digest string, html string, archive string, problem string"
_READ = pa.schema([("page_id", pa.int64()), ("url", pa.string()), ("record_type", pa.string()), ("refers_to", pa.int64()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()), ("html", pa.string()), ("archive", pa.string()), ("problem", pa.string())])

#: Bytes read and decompressed at a time; bytes after which an archive is closed; bytes that a record's headers may have.
CHUNK = 1 << 16
ARCHIVE_BYTES = 256 << 20
HEAD_BYTES = 1 << 16
#: Rows of a batch that the reader gives to Spark, and bytes of payloads in it.
BATCH_ROWS, BATCH_BYTES = 1000, 8 << 20

#: Payloads from this size on are written once.
LEAST_REPEATED = 1000
#: Payloads with copies up to which their table is broadcast; beyond, those with over a part in HOT of all rows are, and the others meet by shuffle.
BROADCAST_ROWS, HOT = 200_000, 10_000

#: Fixed values of the format.
VERSION = b"WARC/1.1"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_URN = "<urn:x-page:{}>"
_PAGE = re.compile(r"<urn:x-page:(-?\d+)>")
_UNSAFE = re.compile(r"[\x00-\x20\x7f-\U0010ffff<>]")


def _uri(url: str) -> str:
    """url with what a header can't hold percent-encoded."""
    return _UNSAFE.sub(lambda m: "".join(f"%{b:02X}" for b in m[0].encode("utf-8", "surrogatepass")), url)


def _digest(sha1: bytes) -> str:
    return "sha1:" + base64.b32encode(sha1).decode()


def record(page_id: int | None, url: str | None, kind: str, refers_to: int | None, payload: bytes) -> bytes:
    """A record as one gzip member: header, HTTP header and, but for revisits, the payload."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http if kind == "revisit" else http + payload
    named = {
        "WARC-Type": kind, "WARC-Record-ID": _URN.format("none" if page_id is None else page_id), "WARC-Date": "1970-01-01T00:00:00Z", "WARC-Target-URI": None if url is None else _uri(url),
        "WARC-Profile": PROFILE if kind == "revisit" else None, "WARC-Refers-To": _URN.format(refers_to) if kind == "revisit" else None,
        "WARC-Payload-Digest": _digest(hashlib.sha1(payload).digest()), "WARC-Block-Digest": _digest(hashlib.sha1(block).digest()), "Content-Type": "application/http; msgtype=response", "Content-Length": str(len(block)),
    }
    head = "".join(f"{k}: {v}\r\n" for k, v in named.items() if v is not None)
    packer = zlib.compressobj(6, zlib.DEFLATED, 31)
    return b"".join((packer.compress(VERSION + b"\r\n" + head.encode() + b"\r\n"), packer.compress(block), packer.compress(b"\r\n\r\n"), packer.flush()))


class Members:
    """The gzip members of a stream, one after the other, decompressed by pieces of CHUNK bytes."""

    def __init__(self, read: Callable[[int], bytes]):
        self.read, self.rest, self.member, self.held = read, b"", None, b""

    def next(self) -> bool:
        """Whether there is another member; what is left of the one before is passed over."""
        while self.member is not None and not self.member.eof:
            if not self._more():
                break
        if self.member is not None:
            self.rest = self.member.unused_data or self.rest
        self.rest = self.rest or self.read(CHUNK)
        self.member, self.held = (zlib.decompressobj(31) if self.rest else None), b""
        return self.member is not None

    def _more(self) -> bytes:
        """Some more bytes of the member, none at its end; an archive that breaks off within one is an error."""
        while not self.member.eof:
            data = self.rest or self.read(CHUNK)
            if not data:
                raise EOFError("the archive ends within a record")
            out = self.member.decompress(data, CHUNK)
            self.rest = self.member.unconsumed_tail
            if out:
                return out
        return b""

    def until(self, mark: bytes, most: int = HEAD_BYTES) -> bytes:
        """The bytes before mark, which is passed over."""
        while (at := self.held.find(mark)) < 0:
            if len(self.held) > most:
                raise ValueError("a header doesn't end")
            if not (more := self._more()):
                raise ValueError("a header isn't whole")
            self.held += more
        out, self.held = self.held[:at], self.held[at + len(mark) :]
        return out

    def take(self, n: int) -> Iterator[bytes]:
        """The next n bytes by pieces."""
        while n > 0:
            data = self.held or self._more()
            if not data:
                raise ValueError("the block is shorter than its length")
            yield data[:n]
            n, self.held = n - len(data[:n]), data[n:]

    def ends(self) -> bool:
        """Whether two line ends, and nothing else, are left of the member."""
        left = self.held
        while len(left) <= 4 and (more := self._more()):
            left += more
        return left == b"\r\n\r\n"


def _fields(head: bytes) -> dict[str, str]:
    lines = (line.partition(b":") for line in head.split(b"\r\n")[1:])
    return {k.strip().lower().decode("latin-1"): v.strip().decode("utf-8", "replace") for k, _, v in lines}


def _size(said: str | None) -> int:
    if said is None or not re.fullmatch(r"\d{1,18}", said):
        raise ValueError("no content length")
    return int(said)


def _page(said: str | None) -> int | None:
    named = _PAGE.fullmatch(said or "")
    return int(named[1]) if named else None


def _hex(said: str | None) -> str | None:
    """The hexadecimal form of a digest header with a base-32 or hexadecimal SHA-1."""
    value = (said or "").removeprefix("sha1:")
    if re.fullmatch(r"[0-9a-fA-F]{40}", value):
        return value.lower()
    return base64.b32decode(value).hex() if re.fullmatch(r"[A-Z2-7]{32}", value) else None


def _record(members: Members, payload: bool) -> dict:
    """The record at hand as a row of READ; problem says what is wrong with it, null if nothing is."""
    row: dict = dict.fromkeys(_READ.names)
    try:
        if members.until(b"\r\n") not in (VERSION, b"WARC/1.0"):
            raise ValueError("no record")
        said = _fields(b"\r\n" + members.until(b"\r\n\r\n"))
        row |= {"page_id": _page(said.get("warc-record-id")), "url": said.get("warc-target-uri"), "record_type": said.get("warc-type"), "refers_to": _page(said.get("warc-refers-to"))}
        whole, body, kept, start, size = hashlib.sha1(), hashlib.sha1(), [], b"", 0
        for part in members.take(_size(said.get("content-length"))):
            whole.update(part)
            if start is not None:  # within the HTTP header
                start += part
                if (at := start.find(b"\r\n\r\n")) < 0:
                    if len(start) > HEAD_BYTES:
                        raise ValueError("an HTTP header doesn't end")
                    continue
                http, part, start = _fields(start[:at]), start[at + 4 :], None
            body.update(part)
            size += len(part)
            if payload:
                kept.append(part)
        if start is not None:
            raise ValueError("no HTTP header")
        if not members.ends():
            raise ValueError("the record is longer than its length")
        digest = _hex(said.get("warc-payload-digest"))
        if row["record_type"] == "revisit":
            row |= {"payload_bytes": _size(http.get("content-length")), "payload_digest": digest}
        else:
            row |= {"payload_bytes": size, "payload_digest": body.hexdigest(), "html": b"".join(kept).decode("utf-8", "replace") if payload else None}
        told = _hex(said.get("warc-block-digest"))
        if told not in (None, whole.hexdigest()):
            raise ValueError("the block's digest differs")
        if digest not in (None, row["payload_digest"]):
            raise ValueError("the payload's digest differs")
    except (ValueError, zlib.error) as wrong:
        row["problem"] = str(wrong)
        if isinstance(wrong, zlib.error):
            raise
    return row


def records(read: Callable[[int], bytes], payload: bool = True) -> Iterator[dict]:
    """The records of an archive in order, as rows of READ without archive.

    A record that is framed or digested wrongly says so in problem and the next one follows. An archive that breaks off, or isn't gzip
    from some place on, ends with a row whose problem says so. Without payload a record of any length takes CHUNK bytes or so.
    """
    members = Members(read)
    while True:
        try:
            if not members.next():
                return
            row = _record(members, payload)
        except (EOFError, zlib.error) as wrong:
            yield dict.fromkeys(_READ.names) | {"problem": str(wrong)}
            return
        yield row


def _place(path: str) -> tuple[fs.FileSystem, str]:
    """The file system and path of a URI as Spark writes it, or of a local path."""
    uri = re.sub(r"^s3[an]://", "s3://", path)
    return fs.FileSystem.from_uri(uri if "://" in uri else "file://" + posixpath.abspath(uri.removeprefix("file:")))


@dataclass
class _Written(WriterCommitMessage):
    files: list[str]


class _Writer(DataSourceArrowWriter):
    """Each task writes archives under _temporary; those of the attempts that count are moved out when all have ended."""

    def __init__(self, path: str, overwrite: bool):
        self.path, self.overwrite = path, overwrite

    def write(self, iterator: Iterator[pa.RecordBatch]) -> _Written:
        at, folder = _place(self.path)
        made, out, size = [], None, 0
        try:
            for batch in iterator:
                columns = [batch.column(batch.schema.get_field_index(n)) for n in ("page_id", "url", "record_type", "refers_to", "html")]
                for i in range(batch.num_rows):
                    page_id, url, kind, refers_to, html = (c[i].as_py() for c in columns)
                    if out is None:
                        made.append(f"part-{uuid.uuid4().hex}.warc.gz")
                        at.create_dir(f"{folder}/_temporary", recursive=True)
                        out, size = at.open_output_stream(f"{folder}/_temporary/{made[-1]}", compression=None), 0
                    data = record(page_id, url, kind or "response", refers_to, (html or "").encode("utf-8", "surrogatepass"))
                    out.write(data)
                    size += len(data)
                    if size >= ARCHIVE_BYTES:
                        out = out.close()
        finally:
            if out is not None:
                out.close()
        return _Written(made)

    def commit(self, messages: list) -> None:
        at, folder = _place(self.path)
        if self.overwrite:
            for old in at.get_file_info(fs.FileSelector(folder, allow_not_found=True)):
                if old.base_name.endswith(".warc.gz"):
                    at.delete_file(old.path)
        at.create_dir(folder, recursive=True)
        for name in (f for m in messages if m for f in m.files):
            at.move(f"{folder}/_temporary/{name}", f"{folder}/{name}")
        self._clear(at, folder)
        at.open_output_stream(f"{folder}/_SUCCESS", compression=None).close()

    def abort(self, messages: list) -> None:
        self._clear(*_place(self.path))

    @staticmethod
    def _clear(at: fs.FileSystem, folder: str) -> None:
        if at.get_file_info(f"{folder}/_temporary").type != fs.FileType.NotFound:
            at.delete_dir(f"{folder}/_temporary")


@dataclass
class _Archive(InputPartition):
    paths: list[str]


class _Reader(DataSourceReader):
    """A task for each archive, or for several small ones."""

    def __init__(self, path: str, payload: bool, task_bytes: int):
        self.path, self.payload, self.task_bytes = path, payload, task_bytes

    def partitions(self) -> list[_Archive]:
        at, folder = _place(self.path)
        info = at.get_file_info(folder)
        found = [info] if info.is_file else [f for f in at.get_file_info(fs.FileSelector(folder)) if f.is_file and f.base_name.endswith((".warc.gz", ".warc"))]
        tasks, held = [], self.task_bytes
        for f in sorted(found, key=lambda f: f.path):
            if held >= self.task_bytes:
                tasks.append(_Archive([]))
                held = 0
            tasks[-1].paths.append(f.path)
            held += f.size + (4 << 20)  # a file's opening counts as some bytes
        return tasks or [_Archive([])]

    def read(self, partition: _Archive) -> Iterator[pa.RecordBatch]:
        at = _place(self.path)[0]
        for path in partition.paths:
            with at.open_input_stream(path, compression=None) as file:
                rows, size = [], 0
                for row in records(file.read, self.payload):
                    rows.append(row | {"archive": posixpath.basename(path)})
                    size += len(row["html"] or "")
                    if len(rows) >= BATCH_ROWS or size >= BATCH_BYTES:
                        yield pa.RecordBatch.from_pylist(rows, _READ)
                        rows, size = [], 0
                if rows:
                    yield pa.RecordBatch.from_pylist(rows, _READ)


class Warc(DataSource):
    """spark.read and df.write with format "warc": a folder of .warc.gz files, in any store that pyarrow reaches.

    Writing takes the columns of PAGES (nulls: no id, no URL, a response, an empty payload), reading returns those of READ. Options
    of the reader: payload (true: html holds the payload of responses), task_bytes (bytes of archives for a task).
    """

    @classmethod
    def name(cls) -> str:
        return "warc"

    def schema(self) -> str:
        return READ

    def reader(self, schema) -> _Reader:
        return _Reader(self.options["path"], self.options.get("payload", "true").lower() == "true", int(self.options.get("task_bytes", 64 << 20)))

    def writer(self, schema, overwrite: bool) -> _Writer:
        return _Writer(self.options["path"], overwrite)


def mark_revisits(pages: DataFrame, key: str = "page_id", url: str = "url", html: str = "html", least: int = LEAST_REPEATED) -> DataFrame:
    """The columns of PAGES: of rows with equal payloads of at least `least` bytes that with the largest key is the response, others revisit it.

    Smaller ones are responses all, as rows with a null key are, which nothing refers to; rows that repeat the largest key are responses
    too. Payloads meet as digests, counted by a partial aggregate, and only payloads with copies are looked up: their table is broadcast
    if it is small, a counted bound. Else the hot ones among them, HOT at most, are broadcast and the others meet by shuffle, where
    a payload holds a part in HOT of all rows at most.
    """
    named = pages.select(F.col(key).alias("page_id"), F.col(url).alias("url"), F.coalesce(html, F.lit("")).alias("html"))
    long_ = (F.octet_length("html") >= least) & F.col("page_id").isNotNull()
    digest = F.when(long_, F.sha2("html", 256))
    counted = named.select("page_id", digest.alias("digest")).where("digest IS NOT NULL").groupBy("digest").agg(F.count("*").alias("n"), F.max("page_id").alias("first"))
    scratch = Scratch(pages.sparkSession)
    copied = scratch.save(counted.where("n > 1"), "copied", all=F.sum("n"))
    keyed = named.withColumn("digest", digest)
    if noted(copied)["rows"] <= BROADCAST_ROWS:
        met = keyed.join(F.broadcast(copied.select("digest", "first")), "digest", "left")
    else:
        bound = noted(copied)["all"] // HOT
        hot = small(copied.where(F.col("n") > bound).select("digest", F.col("first").alias("hot")), HOT)
        rest = copied.where(F.col("n") <= bound).select("digest", "first")
        met = keyed.join(hot, "digest", "left")
        # Payloads that meet nothing by shuffle keep a null key, of which each is dealt by itself.
        met = met.withColumn("digest", F.when(F.col("hot").isNull(), F.col("digest"))).join(rest, "digest", "left").withColumn("first", F.coalesce("first", "hot"))
    repeats = F.coalesce(F.col("first") != F.col("page_id"), F.lit(False))
    return met.select("page_id", "url", F.when(repeats, "revisit").otherwise("response").alias("record_type"), F.when(repeats, F.col("first")).alias("refers_to"), "html")


def write_archives(marked: DataFrame, path: str) -> None:
    """Archives of the rows of mark_revisits in the folder path."""
    marked.sparkSession.dataSource.register(Warc)
    marked.write.format("warc").mode("append").save(path)


def read_archives(spark: SparkSession, path: str, payload: bool = True) -> DataFrame:
    """The records of the archives in the folder path, in READ's columns."""
    spark.dataSource.register(Warc)
    return spark.read.format("warc").option("payload", str(payload).lower()).load(path)


def round_trip(pages: DataFrame, payload: bool = False) -> DataFrame:
    """pages written as archives to a new place in the shared folder and read back."""
    path = f"{shared_dir(pages.sparkSession).rstrip('/')}/warc-{uuid.uuid4().hex}"
    write_archives(mark_revisits(pages), path)
    return read_archives(pages.sparkSession, path, payload)
