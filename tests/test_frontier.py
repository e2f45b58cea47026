import collections
import http.server
import re
import threading
from urllib.parse import unquote_plus, urljoin

import pytest
from pyspark.sql import functions as F

from priceloom.functions import urls
from priceloom.operators import frontier
from priceloom.operators.runs import COLUMNS
from priceloom.operators.search import first_success, visits
from priceloom.sources import documents, web

KIND = "url string, ok boolean, hit boolean, links array<string>"
PAGES = {"a": (True, False, ["b", "x", "x", "a", "y"]), "b": (True, False, ["z"]), "c": (False, False, ["q"]), "d": (True, True, ["y", "w"]), "e": (True, False, [f"l{i}" for i in range(14)]), "l9": (True, True, []), "y": (True, False, ["never"])}
TOPS = {"one": ["a", "b", "c", "d", "a", "e"], "two": ["e", "d", "l3", "none"], "three": ["none", "q", "c"], "four": ["d"], "five": ["l9", "e"]}


def loop(tops, ask, most=35):
    """The search as a loop over one key: the hit and what was asked for, in order."""
    seen, asked = set(), []

    def visit(url):
        seen.add(url)
        asked.append(url)
        return ask(url)

    for url in tops[:most]:
        if url in seen:
            continue
        ok, hit, links = visit(url)
        if ok and hit:
            return url, asked
        for link in links[:10] if ok else []:
            if link not in seen:
                ok2, hit2, _ = visit(link)
                if ok2 and hit2:
                    return link, asked
    return None, asked


@pytest.mark.parametrize("width", [1, 3, 100])
def test_crawl(spark, tmp_path, width):
    tops = spark.createDataFrame([(k, n, u) for k, v in TOPS.items() for n, u in enumerate(v)] + [(None, 0, "a"), ("one", 9, None)], "il string, ord int, url string")
    table = spark.createDataFrame([(u, *v) for u, v in PAGES.items()], KIND)
    asked = []

    def look(df):
        asked.append([r["url"] for r in df.collect()])
        if len(asked) == 2 and width < 100:
            raise RuntimeError("broke off")
        return table.join(df, "url", "left_semi")

    with pytest.raises(RuntimeError) if width < 100 else pytest.MonkeyPatch.context():
        done = frontier.crawl(tops, look, str(tmp_path), "il", width)
    done = frontier.crawl(tops, look, str(tmp_path), "il", width)  # goes on after the first round
    got = {r["il"]: (r["url"], r["n_tried"]) for r in done.first().collect()}
    want = {k: loop(v, lambda u: PAGES.get(u, (False, False, []))) for k, v in TOPS.items()}
    assert got == {k: (hit, len(tried)) for k, (hit, tried) in want.items()}
    flat = [u for urls_ in asked[:1] + asked[2:] for u in urls_] if width < 100 else [u for urls_ in asked for u in urls_]
    assert len(flat) == len(set(flat)) == done.pages.count()
    needed = {u for _, tried in want.values() for u in tried}
    assert set(flat) == needed if width == 1 else set(flat) >= needed
    whole = first_success(visits(tops, table, "il"), table.where("hit"), "il")
    assert {(r["il"], r["url"]) for r in whole.collect()} == {(k, u) for k, (u, _) in got.items()}
    assert frontier.crawl(tops.limit(0), look, f"{tmp_path}/none", "il").first().count() == 0


TABLE = "<table><tr><th>Oda</th><th>Teşkilat</th><th>Kamu personeli</th><th>Onaylı misafir</th></tr>" + "".join(f"<tr><td>Oda {i}</td><td>{500 + i} TL</td><td>700 TL</td><td>950 TL</td></tr>" for i in range(3)) + "</table>"
PRICES = f"<p>2026 konaklama</p>{TABLE}"


def site_pages(base):
    links = lambda *paths: "".join(f'<a href="{p}">fiyat</a>' for p in paths)
    result = lambda *paths: "".join(f'<a class="result__a" href="//e/?uddg={base.replace(":", "%3A").replace("/", "%2F")}{p.replace("/", "%2F")}&x=.pol.tr">r</a>' for p in paths)
    return {
        "/bolu/home1": links("/bolu/p1", "/bolu/p2", "/bolu/p1#x", "http://other.example/fiyat") + '<a href="/bolu/no">x</a>',
        "/bolu/home2": links("/bolu/p2", "/bolu/p3"), "/bolu/p1": links("/bolu/p4", "/bolu/g1"), "/bolu/p2": links("/bolu/p5"), "/bolu/p5": "2025", "/bolu/p3": PRICES,
        "/mus/g2": PRICES, "/mus/home1": links("/mus/p9"), "/van/search1": result("/van/.pol.tr/s1"), "/van/search2": result("/van/.pol.tr/s2"), "/van/.pol.tr/s2": PRICES.replace("950", "990"), "/van/.pol.tr/s1": "nothing",
    }


def test_run_provinces_over_http(spark, tmp_path):
    asked, pages = collections.Counter(), {}

    class Pages(http.server.BaseHTTPRequestHandler):
        def do_GET(self):
            asked[self.path] += 1
            body = pages.get(self.path)
            self.send_response(200 if body is not None else 404)
            self.send_header("Content-Type", "text/html; charset=utf-8")
            self.end_headers()
            self.wfile.write((body or "no").encode())

        def log_message(self, *args):
            pass

    server = http.server.ThreadingHTTPServer(("127.0.0.1", 0), Pages)
    threading.Thread(target=server.serve_forever, daemon=True).start()
    base = f"http://127.0.0.1:{server.server_port}"
    pages |= site_pages(base)
    at = lambda *names: lambda il: F.array(*[F.concat(F.lit(f"{base}/"), urls.province_slug(il), F.lit(f"/{n}")) for n in names])
    site = frontier.Site(at("g1", "g2"), at("home1", "home2"), at("search1", "search2"), f":{server.server_port}")
    facilities = spark.createDataFrame([(0, "Bolu", "Bolu Polisevi", None), (1, "Muş", "Muş Polis Evi", "Polisevi"), (2, "Van", "Van Polis Konukevi", None), (3, "Ağrı", "Ağrı Polis A", None), (4, "Ağrı", "Ağrı Polis B", None), (5, "Uşak", "Uşak Polisevi", None), (6, "Ordu", "Otel", "otel")], "ord int, il string, isim string, tip string")
    old = spark.createDataFrame([("Bolu", "Bolu Polisevi", "1 TL", "x", None, "u", "g"), ("Ordu", "Otel", "2 TL", None, None, None, None)], ", ".join(f"{c} string" for c in COLUMNS))
    calls = []

    def fetch(df):
        calls.append(1)
        if len(calls) == 3:
            raise RuntimeError("broke off")
        return web.fetch_pages(df, web.SCAN)

    with pytest.raises(RuntimeError):
        frontier.run_provinces(facilities, old, fetch, str(tmp_path), site=site)
    ran = frontier.run_provinces(facilities, old, fetch, str(tmp_path), site=site)
    got = {r["il"]: (r["status"], r["url"] and r["url"].removeprefix(base), r["n_tried"]) for r in ran.results.collect()}
    merged = {r["il"]: r for r in ran.merged.collect()}
    server.shutdown()

    def links_of(path):
        return list(dict.fromkeys(urljoin(base + path, h).split("#")[0].removeprefix(base) for h in re.findall(r'href="([^"]*)">fiyat', pages.get(path, "")) if "other" not in h))[:40]

    want, total = {}, collections.Counter()
    for il in ("bolu", "mus", "van", "usak"):
        first = [f"/{il}/{x}" for x in ("home1", "home2", "search1", "search2")]
        total.update(first)
        tops = [f"/{il}/g1", f"/{il}/g2", *links_of(first[0]), *links_of(first[1])]
        tops += [unquote_plus(h).removeprefix(base) for p in first[2:] for h in re.findall(r"uddg=([^&]*)", pages.get(p, ""))]
        hit, tried = loop(list(dict.fromkeys(tops)), lambda p: (p in pages, TABLE[:30] in pages.get(p, ""), links_of(p)))
        total.update(tried)
        want[il] = ("found" if hit else "not_found", hit, len(tried))
    assert {"Bolu": want["bolu"], "Muş": want["mus"], "Van": want["van"], "Uşak": want["usak"], "Ağrı": ("ambiguous_or_no_facility", None, 0)} == got
    assert asked == total and len(calls) > 5  # no page was asked for that the loop doesn't ask for, nor twice, with a restart between
    assert merged["Bolu"]["fiyat_kurum_personeli"] == "500 – 502 TL" and merged["Bolu"]["kaynak"] == f"{base}/bolu/p3" and merged["Ordu"]["fiyat_sivil"] == "2 TL" and merged["Van"]["fiyat_sivil"] == "990 TL" and len(merged) == 4


def test_written_needs_no_partition(spark):
    assert documents.written(spark.range(0), "none").count() == 0


def test_candidates_of_a_crawl_are_computed_once(spark, tmp_path):
    """Each round reads what was written: the candidates' source is read in one job, however many rounds follow."""
    seen = spark.sparkContext.accumulator(0)

    def counted(batches):
        for batch in batches:
            seen.add(batch.num_rows)
            yield batch

    listed = spark.createDataFrame([(k, n, f"u{k}-{n}") for k in (1, 2) for n in range(50)], "key int, ord int, url string").mapInArrow(counted, "key int, ord int, url string")
    look = lambda asked: asked.select("url", F.lit(True).alias("ok"), (F.col("url") == "u1-9").alias("hit"), F.array().cast("array<string>").alias("links"))
    made = frontier.crawl(listed, look, str(tmp_path / "crawl"), "key", 20)
    assert {r["key"]: (r["url"], r["n_tried"]) for r in made.first().collect()} == {1: ("u1-9", 10), 2: (None, 35)}
    assert made.rounds > 1 and seen.value == 100
