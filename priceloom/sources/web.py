"""Pages fetched over HTTP by the executors, as rows with either a body or the reason why there is none."""

from __future__ import annotations

import json
import posixpath
import re
import time
import urllib.error
import urllib.request
import uuid
from collections.abc import Iterator
from dataclasses import asdict, dataclass, field
from urllib.parse import urlsplit

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from ..functions.charset import guess
from .documents import PAGE, Rounds, shared_dir

_META = re.compile(rb"<meta[^>]{0,200}charset\s*=\s*[\"']?([A-Za-z0-9_-]+)", re.I)
_TYPES = pa.schema([("url", pa.string()), ("html", pa.string()), ("status", pa.int32()), ("err", pa.string())])


@dataclass(frozen=True)
class Fetch:
    """How pages are asked for: seconds to wait, headers, kinds of content that are taken, whether PDF addresses are refused.

    pause: seconds between the requests of a host. most_bytes: a longer body is refused. declared: whether the charset that the response or
    the page names counts before the guess from the bytes.
    """

    timeout: float = 12.0
    headers: dict = field(default_factory=lambda: {"User-Agent": "Mozilla/5.0", "Accept-Language": "tr-TR,tr;q=0.9"})
    kinds: tuple = ("html", "text")
    refuse_pdf: bool = True
    pause: float = 0.0
    most_bytes: int = 16 << 20
    declared: bool = True


#: Waiting times, languages and contents that the two kinds of pages are asked for with.
PROBE = Fetch(pause=0.05)
SCAN = Fetch(
    timeout=18.0, kinds=("html", "text", "xml"), refuse_pdf=False, pause=0.15,
    headers={"User-Agent": "Mozilla/5.0", "Accept": "text/html,application/xhtml+xml,application/xml;q=0.9,*/*;q=0.8", "Accept-Language": "tr-TR,tr;q=0.9,en;q=0.8"},
)


def decoded(body: bytes, declared: str | None, trust: bool = True) -> str:
    """The body as text: by the charset that the response or the page names, if it can be, else by that which its bytes fit best."""
    inside = _META.search(body)
    for name in (declared, inside and inside[1].decode("ascii")) if trust else ():
        try:
            if name:
                return body.decode(name)
        except (LookupError, UnicodeDecodeError):
            continue
    return body.decode(guess(body), "replace")


def fetch(url: str | None, how: Fetch) -> tuple[str | None, int | None, str | None]:
    """html, status, err; redirects are followed, and whatever goes wrong ends in err."""
    if not url:
        return None, None, "no url"
    try:
        with urllib.request.urlopen(urllib.request.Request(url, headers=how.headers), timeout=how.timeout) as r:
            kind = (r.headers.get("Content-Type") or "").lower()
            if how.refuse_pdf and ("pdf" in kind or url.lower().endswith(".pdf")):
                return None, r.status, "pdf"
            if kind and not any(k in kind for k in how.kinds):
                return None, r.status, f"skip content-type {kind}"
            body = r.read(how.most_bytes + 1)
            if len(body) > how.most_bytes:
                return None, r.status, f"over {how.most_bytes} bytes"
            return decoded(body, r.headers.get_content_charset(), how.declared), r.status, None
    except urllib.error.HTTPError as e:
        return None, e.code, f"HTTP {e.code}"
    except Exception as e:  # noqa: BLE001 - any failure of one page is that page's result
        return None, None, str(e) or type(e).__name__


def fetch_all(urls: Iterator[str], how: Fetch) -> Iterator[pa.RecordBatch]:
    """A batch for each address, with a pause before a host is asked again."""
    asked: dict[str, float] = {}
    for url in urls:
        host = _host(url)
        if how.pause and host in asked:
            time.sleep(max(0.0, asked[host] + how.pause - time.monotonic()))
        row = fetch(url, how)
        asked[host] = time.monotonic()
        yield pa.RecordBatch.from_pylist([dict(zip(_TYPES.names, (url, *row)))], _TYPES)


def _host(url: str) -> str:
    try:
        return urlsplit(url).netloc.lower()
    except ValueError:
        return url


def _by_host(urls: DataFrame, partitions: int | None) -> DataFrame:
    """The distinct addresses, those of a host together."""
    host = F.lower(F.regexp_extract("url", "^[A-Za-z]+://([^/?#]*)", 1))
    distinct = urls.where("url IS NOT NULL").select("url").distinct()
    return distinct.repartition(partitions, host) if partitions else distinct.repartition(host)


def fetch_pages(urls: DataFrame, how: Fetch = PROBE, partitions: int | None = None) -> DataFrame:
    """url, html, status, err for each distinct url; hosts are kept together, so one task at a time asks a host.

    A task that is run again asks again: write the result before it is used twice, or use fetch_into. Null urls are left out.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return fetch_all((url for batch in batches for url in batch.column(0).to_pylist()), how)

    return _by_host(urls, partitions).mapInArrow(run, PAGE)


@dataclass
class _List(InputPartition):
    path: str


class _Reader(DataSourceReader):
    """A task for each file of addresses: JSON lines with url, those of a host in one file, as fetch_into writes them."""

    def __init__(self, path: str, how: Fetch):
        self.path, self.how = path, how

    def _at(self) -> tuple[fs.FileSystem, str]:
        return fs.FileSystem.from_uri(self.path if "://" in self.path else "file://" + posixpath.abspath(self.path.removeprefix("file:")))

    def partitions(self) -> list[_List]:
        at, folder = self._at()
        found = [f.path for f in at.get_file_info(fs.FileSelector(folder)) if f.is_file and f.base_name.endswith(".json")]
        return [_List(p) for p in sorted(found)] or [_List("")]

    def read(self, partition: _List) -> Iterator[pa.RecordBatch]:
        if not partition.path:
            return iter(())
        with self._at()[0].open_input_stream(partition.path) as file:
            urls = [json.loads(line)["url"] for line in file.read().splitlines()]
        return fetch_all(iter(urls), self.how)


class WebPages(DataSource):
    """spark.read.format("web_pages").load(folder of lists of addresses): PAGE's columns for each address.

    Options: timeout, pause (seconds), most_bytes, headers (a JSON object), kinds (with commas between), refuse_pdf and declared (true or false).
    """

    @classmethod
    def name(cls) -> str:
        return "web_pages"

    def schema(self) -> str:
        return PAGE

    def reader(self, schema) -> _Reader:
        said, how = self.options, Fetch()
        flag = lambda name, other: said.get(name, str(other)).lower() == "true"
        headers = json.loads(said["headers"]) if "headers" in said else how.headers
        kinds = tuple(said["kinds"].split(",")) if "kinds" in said else how.kinds
        made = Fetch(float(said.get("timeout", how.timeout)), headers, kinds, flag("refuse_pdf", how.refuse_pdf), float(said.get("pause", how.pause)), int(said.get("most_bytes", how.most_bytes)), flag("declared", how.declared))
        return _Reader(said["path"], made)


def options(how: Fetch) -> dict[str, str]:
    """how as options of the web_pages format."""
    return {k: json.dumps(v) if k == "headers" else ",".join(v) if k == "kinds" else str(v).lower() for k, v in asdict(how).items()}


def fetch_into(urls: DataFrame, folder: str, how: Fetch = PROBE, partitions: int = 200) -> DataFrame:
    """The pages of the distinct addresses, kept in the folder: those that it has already aren't asked for again.

    Each call adds the pages that are missing as one table, so what was fetched stays after a restart, and an address that failed counts as
    fetched, with its err. Null addresses are left out.
    """
    spark = urls.sparkSession
    rounds = Rounds(spark, folder)
    number = rounds.done()
    wanted = urls.where("url IS NOT NULL").select("url").distinct()
    if number:
        wanted = wanted.join(rounds.read(number).select("url"), "url", "left_anti")
    lists = f"{shared_dir(spark).rstrip('/')}/urls-{uuid.uuid4().hex}"
    _by_host(wanted, partitions).write.json(lists)
    spark.dataSource.register(WebPages)
    if not spark.read.text(lists).isEmpty():
        rounds.add(spark.read.format("web_pages").options(**options(how)).load(lists), number)
        number += 1
    pages = rounds.read(number) if number else spark.createDataFrame([], PAGE)
    return pages.join(urls.select("url").distinct(), "url", "left_semi")
