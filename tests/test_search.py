import http.server
import json
import threading
import time
from dataclasses import replace

import pytest

from priceloom.functions import charset
from priceloom.operators import search
from priceloom.sources import web
from priceloom.streaming.progress import ProgressSink


def visited(tops, pages, most=35):
    """The search as a loop, for one key."""
    seen, out = set(), []
    for n, (_, url) in enumerate(tops[:most], 1):
        if url in seen:
            continue
        seen.add(url)
        out.append((n, 0, url))
        ok, links = pages.get(url, (False, []))
        for k, link in enumerate(links[:10] if ok else [], 1):
            if link not in seen:
                seen.add(link)
                out.append((n, k, link))
    return out


PAGES = {"a": (True, ["b", "x", "x", "a", "y"]), "b": (True, ["z"]), "c": (False, ["q"]), "d": (True, ["y", "w", "c"]), "e": (True, [f"l{i}" for i in range(14)])}
TOPS = {"one": [(0, "a"), (1, "b"), (2, "c"), (3, "d"), (4, "a")], "two": [(0, "e"), (1, "d"), (2, "l3"), (3, "none")]}


def test_visits_and_first_success(spark):
    tops = spark.createDataFrame([(k, n, u) for k, v in TOPS.items() for n, u in v] + [(None, 0, "a"), ("one", 9, None)], "il string, ord int, url string")
    pages = spark.createDataFrame([(u, ok, links) for u, (ok, links) in PAGES.items()], "url string, ok boolean, links array<string>")
    got = search.visits(tops, pages, "il")
    rows = sorted((r["il"], r["ord"], r["link_ord"], r["url"]) for r in got.collect())
    assert rows == sorted((k, *v) for k, tops_of in TOPS.items() for v in visited(tops_of, PAGES))
    entries = spark.createDataFrame([("d",), ("z",), ("c",)], "url string")
    best = {r["il"]: (r["url"], r["n_tried"]) for r in search.first_success(got, entries, "il").collect()}
    # "z" hangs on "b", which was visited as a link; "c" has no page that is ok.
    assert best == {"one": ("d", 6), "two": ("d", 12)}
    none = search.first_success(got, entries.limit(0), "il").collect()
    assert all(r["url"] is None for r in none) and sum(r["n_tried"] for r in none) == len(rows)
    assert search.visits(tops.limit(0), pages, "il").count() == 0


class Pages(http.server.BaseHTTPRequestHandler):
    asked: list = []

    def do_GET(self):
        Pages.asked.append((self.path, time.monotonic(), dict(self.headers)))
        found = {"/a": ("text/html; charset=iso-8859-9", "Öğretmenevi ş".encode("iso-8859-9")), "/b": ("application/pdf", b"%PDF"), "/m": ("text/html", b" " * 9000 + '<meta charset="windows-1254">ğ'.encode("cp1254")), "/g": ("text/html", "Şanlıurfa öğretmenevi".encode("cp1254")), "/i": ("image/png", b"x"), "/l": ("text/html", b"x" * 5000)}
        status, kind, body = (200, *found[self.path]) if self.path in found else (404, "text/html", b"no")
        self.send_response(status)
        self.send_header("Content-Type", kind)
        self.end_headers()
        self.wfile.write(body)

    def log_message(self, *args):
        pass


@pytest.fixture
def base():
    server = http.server.ThreadingHTTPServer(("127.0.0.1", 0), Pages)
    threading.Thread(target=server.serve_forever, daemon=True).start()
    Pages.asked.clear()
    yield f"http://127.0.0.1:{server.server_port}"
    server.shutdown()


def test_fetch_pages(spark, base):
    urls = spark.createDataFrame([(f"{base}{p}",) for p in ("/a", "/a", "/b", "/m", "/g", "/i", "/none", "/l")] + [("nonsense",), (None,), ("http://[bad",)], "url string")
    got = {r["url"].removeprefix(base): (r["html"], r["status"], r["err"]) for r in web.fetch_pages(urls, replace(web.PROBE, most_bytes=4999 + 5000)).collect()}
    scan = {r["url"].removeprefix(base): r["err"] for r in web.fetch_pages(urls, replace(web.SCAN, most_bytes=4999, pause=0)).collect()}
    assert got["/a"] == ("Öğretmenevi ş", 200, None) and got["/m"][0].endswith("ğ") and got["/b"] == (None, 200, "pdf") and got["/g"][0] == "Şanlıurfa öğretmenevi"
    assert got["/none"] == (None, 404, "HTTP 404") and got["nonsense"][2] and got["http://[bad"][2] and len(got) == 9 and got["/l"][0] == "x" * 5000
    assert scan["/i"] == "skip content-type image/png" and scan["/b"].startswith("skip") and scan["/l"] == "over 4999 bytes"


def test_pages_as_a_source(spark, base, tmp_path):
    """What was fetched isn't asked for again; headers go out; a host is asked with pauses."""
    how = replace(web.SCAN, pause=0.2)
    first = spark.createDataFrame([(f"{base}{p}",) for p in ("/a", "/g", "/none")] + [(None,)], "url string")
    more = first.unionByName(spark.createDataFrame([(f"{base}/l",)], "url string"))
    one = {r["url"].removeprefix(base): r["status"] for r in web.fetch_into(first, str(tmp_path), how).collect()}
    times = sorted(t for _, t, _ in Pages.asked)
    assert one == {"/a": 200, "/g": 200, "/none": 404} and all(b - a >= 0.18 for a, b in zip(times, times[1:]))
    assert {h["Accept-Language"] for _, _, h in Pages.asked} == {how.headers["Accept-Language"]} and all("xhtml" in h["Accept"] for _, _, h in Pages.asked)
    two = web.fetch_into(more, str(tmp_path), how)
    assert two.count() == 4 and sorted(p for p, _, _ in Pages.asked) == ["/a", "/g", "/l", "/none"]
    assert web.fetch_into(more, str(tmp_path), how).count() == 4 and len(Pages.asked) == 4
    assert web.fetch_into(first.limit(0), f"{tmp_path}/none", how).count() == 0


def test_progress(spark, tmp_path):
    seen = []
    sink = ProgressSink(lambda batch, n: seen.append(n), str(tmp_path / "progress.json"), 5, "x > 1")
    for n, rows in enumerate(([(1,), (2,)], [(3,), (None,)])):
        for _ in range(2):  # a batch that is run again
            sink(spark.createDataFrame(rows, "x int"), n)
    said = json.loads((tmp_path / "progress.json").read_text())
    assert said.pop("updated_at") and said == {"done": 4, "total": 5, "found": 2} and seen == [0, 0, 1, 1]


TURKISH = "Öğretmenevi konaklama ücretleri 2026 yılı için İl Özel İdaresi tarafından belirlenmiştir. Üye ve öğretmen, çift kişilik oda – Şanlıurfa, Iğdır, Ağrı’da."


def test_charsets_of_documents(spark):
    """Whole documents in four charsets read back as they were, and Turkish among them."""
    texts = [r[0] for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("text").where("text IS NOT NULL").collect()]
    texts += [TURKISH, "Şehir", "ağaç", "İl", "çay ve ılık su"]
    for name in ("utf-8", "cp1254", "iso-8859-9", "cp1252"):
        bodies = [t.encode(name, "ignore") for t in texts]
        right = sum(web.decoded(b, None) == b.decode(name) for b in bodies)
        assert right >= 0.99 * len(texts), (name, right)
    assert charset.guess(b"") == charset.guess(b"plain") == "utf-8" and charset.guess("é".encode()[:1]) in charset.CHARSETS
    assert charset.guess(TURKISH.encode()[:-30] + b"\xc4") == "utf-8"  # breaks off within a character
    assert charset.guess(bytes(range(256)) * 50) in charset.CHARSETS


@pytest.mark.parametrize("body, name, text", [("ğ".encode(), None, "ğ"), ("ğ".encode("cp1254"), "no-such", "ğ")])
def test_decoded(body, name, text):
    assert web.decoded(body, name) == text
