import json
import random
import time
from datetime import datetime
from urllib.parse import quote_plus

import pytest
from pyspark.sql import functions as F

from priceloom.functions import html, money, text, urls
from priceloom.operators import match, tariff, upsert
from priceloom.sources import documents, json_files


def values(spark, items, fn, kind="string"):
    return [r[0] for r in spark.createDataFrame([(i, x) for i, x in enumerate(items)], f"i int, x {kind}").orderBy("i").select(fn(F.col("x"))).collect()]


def test_scan_money(spark):
    cases = {
        "1.500 TL": [1500], "1.500,00 ₺": [1500], "₺1.250 (vergi dahil 1.275)": [1250, 1275], "850 TL 1.020 TL": [850, 1020], "1.000 - 1.200": [1000, 1200],
        "1500 TL": [150], "4500": [450], "12500": [125], "2026": [202, 6], "500 300": [], "850 1020": [], "1.500 TL": [1500], "": [],
    }
    assert values(spark, list(cases), money.scan_money) == [list(map(float, v)) for v in cases.values()]


def stacked(spark, texts):
    made = tariff.stacked_prices(spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, text string")).orderBy("i").collect()
    return [tuple(r["stacked"][x] for x in tariff.ROLES) for r in made]


def test_stacked_lines(spark):
    head = "2026 Teşkilat / Kamu / Onaylı misafir\n"
    three = lambda name, *prices: name + "\n" + "\n".join(f"{p} TL" for p in prices) + "\n"
    pad = "x\ny\nz\nv\nw\n"
    texts = [
        head + three("Tek oda", "500", "700", "900") + three("Suit", "600,50", "600,50", "950") + pad,
        head + three("Tek oda", "500", "700") + three("Ek yatak", "500", "600", "700") + pad,  # two prices; not a room
        head + three("Tek oda", "900", "700", "500") + three("Aile", "400", "500", "2.500") + pad,  # falling; over five times
        head + "Tek oda\na\nb\nc\nd\n500 TL\ne\n700 TL\n900 TL\n" + pad,  # a line without an amount too late
        head + "Tek oda\na\nb\nc\nd\n500 TL\n700 TL\n900 TL\n" + pad,
        head + "Tek oda\n500 TL\n99 TL\n700 TL\n900 TL\n" + pad,  # a price that no room has, in between
        head.replace("2026", "2025") + three("Tek oda", "500", "700", "900") + pad,
        head + "Tek oda  500 TL  700 TL  900 TL",  # few lines: cut at wide gaps
        None,
    ]
    none = ([], [], [])
    assert stacked(spark, texts) == [([500.0, 600.5], [700.0, 600.5], [900.0, 950.0]), none, none, none, ([500.0], [700.0], [900.0]), none, none, ([500.0], [700.0], [900.0]), none]


def test_scan_falls_back_to_stacked_lines(spark):
    lines = "<pre>" + "".join(f"{n} oda\n{a} TL\n{b} TL\n{c} TL\n" for n, a, b, c in (("Tek", 500, 700, 900), ("Çift", 600, 800, "1.000"), ("Aile", 700, 900, "1.100"))) + "</pre>"
    page = f"<p>2026 Teşkilat Kamu Onaylı misafir 01.05.2026</p><table><tr><td>Yemek listesi</td></tr></table>{lines}"
    table = "<table><caption>Kuaför</caption><tr><th>Oda</th><th>Teşkilat</th><th>Kamu personeli</th><th>Onaylı misafir</th></tr>" + "".join(f"<tr><td>s{i}</td><td>500 TL</td><td>700 TL</td><td>950 TL</td></tr>" for i in range(3)) + "</table>"
    pages = spark.createDataFrame([("a", page), ("b", f"<p>2026</p>{table}"), ("c", f"<p>2026</p>{table.replace('Kuaför', 'Odalar')}"), ("d", table), ("e", f"<p>2025</p>{table}<!-- 2026 -->".replace("Kuaför", ""))], "url string, html string")
    got = {r["url"]: r for r in tariff.entries(tariff.parse_of_year(pages, tariff.SCAN), tariff.SCAN).collect()}
    assert set(got) == {"a", "c", "e"} and got["a"]["fiyat_sivil"] is not None and got["c"]["fiyat_kurum_personeli"] == "500 TL"


def test_page_links(spark):
    page = '<a href="/fiyat#x">a</a><a href="fiyat">b</a><a href="https://x.pol.tr/p">Polis evi</a><a href="https://y.com/fiyat">c</a><a href="/other">d</a><a href="/fiyat">e</a>'
    parsed = html.parse_pages(spark.createDataFrame([(1, "https://www.bolu.pol.tr/a/b", page), (2, None, page), (3, "https://www.bolu.pol.tr", None)], "id int, url string, html string"))
    got = [tuple(r) for r in urls.page_links(parsed, "id", urls.link_wanted).orderBy("id", "rank").collect()]
    assert got == [(1, 1, "https://www.bolu.pol.tr/fiyat"), (1, 2, "https://www.bolu.pol.tr/a/fiyat"), (1, 3, "https://x.pol.tr/p")]


def test_format(spark):
    assert values(spark, [1000.5, 1001.5, 1500.0], money.format_tl, "double") == ["1.000", "1.002", "1.500"]
    ranges = [[], [1500.0], [2500.0, 1500.0], [1000.0, 1000.4]]
    assert values(spark, ranges, money.range_of, "array<double>") == [None, "1.500 TL", "1.500 – 2.500 TL", "1.000 TL"]


def test_round_trip(spark):
    df = spark.range(1, 100_001, 7).select(F.col("id").cast("double").alias("v"))
    assert df.where(money.parse_money(money.format_tl(F.col("v"))) != F.col("v")).count() == 0


def test_norm(spark):
    names = ["Çorum Öğretmenevi", "İSKİLİP", "IĞDIR", "Hâkim", "Straße", None]
    assert values(spark, names, text.norm_name) == ["corumogretmenevi", "iskilip", "igdir", "hkim", "strasse", ""]


def test_parser_nested_and_broken(spark):
    page = "<title>T &amp; U</title><style>x</style><table><caption>K</caption><tr><td>a<td>b<table><tr><td>c</table></table><a href='/x'>go <b>on</b></a><p>end"
    got = html.parse_pages(spark.createDataFrame([(1, page), (2, None), (3, "")], "id int, html string")).orderBy("id").collect()
    p = got[0]["parsed"]
    assert p["title"] == "T & U" and p["links"][0]["href"] == "/x" and p["links"][0]["text"] == "go on"
    rows, heads = tables(p)
    assert rows == [[["a", "b c", "c"], ["c"]], [["c"]]] and heads == [["K"], []]
    assert got[1]["parsed"] is None and got[2]["parsed"]["pieces"] == []


def tables(p):
    """The rows and the heads of each table of a parsed page, as texts."""
    said = lambda span: " ".join(p["pieces"][span["first"] : span["last"]])
    row = lambda r: [said(c) for c in p["cells"][r["first"] : r["last"]]]
    return [[row(r) for r in p["rows"][t["first_row"] : t["last_row"]]] for t in p["tables"]], [[said(h) for h in p["heads"][t["first_head"] : t["last_head"]]] for t in p["tables"]]


def parsed(source, select=""):
    return html._column([html._Page(source, html.selector(select))]).to_pylist()[0]


PAGES = {
    "<table><tr><td>a<td>b<tr><td>c</table>": [[["a", "b"], ["c"]]],
    "<table><tr><td><div>a<td>b</div>c</table>d": [[["a", "bc"]]],
    "<table><tr><td>a</tr></div></tr><tr><th>b</table>": [[["a"], ["b"]]],
    "<table><tbody><tr><td>a<tfoot><tr><td>b<caption>k<tr><td>c": [[["a"], ["b"], ["c"]]],
    "<table><tr><td>a<table><tr><td>b</td></tr></table>c<td>d</table>": [[["a b c", "b", "d"], ["b"]], [["b"]]],
    "<table><tr><td>a</td><table><tr><td>b": [[["a"]], [["b"]]],
    "<TABLE><TR><TD>a&amp;&lt;b&nbsp;</TD></TR></TABLE>": [[["a&<b"]]],
    "<tr><td>no table</td></tr>": [],
    "<table><tr><td>a</b></i>b<!-- x -->c</td></tr></table>": [[["ab c"]]],
    "<table><tr><td><script>if (a<b) '</td>'</script>x<style>y</style></table>": [[["x"]]],
    "<table><tr><td title='a>b' class=\"x\" y=1>c": [[["c"]]],
    "<table><td>a</td><tr><td>b": [[["b"]]],
}


@pytest.mark.parametrize("source", PAGES)
def test_tables_of_broken_pages(source):
    assert tables(parsed(source))[0] == PAGES[source]


def test_stray_text_stands_before_its_table():
    p = parsed("a<table>x<tr>y<td>b<table>z<tr><td>c</table>d</td></tr>w<tr><td>e</table>f")
    assert p["pieces"] == ["a", "x", "y", "w", "b", "z", "c", "d", "e", "f"]
    assert tables(p)[0] == [[["b z c d", "c"], ["c"], ["e"]], [["c"]]]


def test_selectors():
    source = '<div class="hits big"><p><a class="x result" href=1>a</a><a href=2 class=result>b</a></div><a class=result href=3>c</a><a class=result>d</a>'
    marked = lambda select: [x["href"] for x in parsed(source, select)["links"] if x["marked"]]
    assert marked("a.result") == ["1", "2", "3"] and marked("div.hits a.result") == ["1", "2"] and marked(".hits.big p a.x") == ["1"] and marked("") == marked("td a") == []


@pytest.mark.parametrize("source", ["<![foo bar]]>x", "<!", "<!-", "<!-->x", "<!--", "<?php", "</", "<a", "<a href='", "<a href=x", "&#" + "9" * 5000 + ";x", "<table" * 9, "</table></td></a>", "\x00<\x00>", "<title>a<title>b", "<script>", "<![CDATA[<td>]]>"])
def test_no_page_fails(source):
    assert parsed(source) is not None


def test_random_pages_dont_fail():
    draw = random.Random(11)
    parts = ["<table>", "<tr>", "<td>", "<th>", "</td>", "</tr>", "</table>", "<caption>", "<tbody>", "<a href=x>", "</a>", "<p>", "<div class='a b'>", "</div>", "<title>", "</title>", "<script>", "</script>", "<!--", "-->", "<", ">", "&", "&amp;", "&#x;", "'", '"', "x", " ", "<li>", "<template>", "</template>", "<br>", "<![", "]]>", "<b", "=", "/"]
    for _ in range(3000):
        p = parsed("".join(draw.choices(parts, k=draw.randrange(60))), "div.a a")
        spans = [*p["cells"], *p["heads"]]
        assert all(0 <= s["first"] <= s["last"] <= len(p["pieces"]) for s in spans) and all(0 <= r["first"] <= r["last"] <= len(p["cells"]) for r in p["rows"])
        assert all(0 <= t["first_row"] <= t["last_row"] <= len(p["rows"]) and 0 <= t["first_head"] <= t["last_head"] <= len(p["heads"]) for t in p["tables"])


HOSTILE = {"tables": "<table><tr><td>x", "cells": "<td>x", "deep": "<div><b>", "links": "<a href=x>y", "titles": "<title>", "quotes": "<a b='", "comments": "<!--x", "ends": "<p></table></i>", "strays": "<table>x<b>y"}


@pytest.mark.parametrize("part", HOSTILE)
def test_time_and_size_follow_the_source(part):
    took = []
    for n in (4_000, 16_000):
        began = time.process_time()
        made = html._column([html._Page(HOSTILE[part] * n)])
        took.append(time.process_time() - began)
        assert made.nbytes < 40 * len(HOSTILE[part]) * n + 10_000
    assert took[1] < 10 * took[0] + 0.2


def test_nested_tables_in_spark(spark):
    pages = spark.createDataFrame([("u", "2026 oda" + "<table><tr><td>Üye/Öğretmen<td>Sivil<tr><td>700 TL" * 2000)], "url string, html string")
    assert tariff.entries(html.parse_pages(pages), tariff.PROBE).first()["fiyat_kurum_personeli"] == "700 TL"


def test_search_pages(spark):
    page = """<a href="https://x.gov.tr/p">no result</a><div class=r><a class="result__a" href="https://www.bolu.pol.tr/a">A</a><a class=result__a href="/l?uddg=https%3A%2F%2Fb.gov.tr%2Fc%2Bd&z">B</a></div>
    <a class=result__a href="ftp://pol.tr/x">F</a><a href="?uddg=">E</a><a href="//e/?uddg=http%3A%2F%2Fother.com">O</a><a class=result__a href="https://www.bolu.pol.tr/a">A</a>""" + "".join(f"<a class=result__a href=http://s{i}.pol.tr>S</a>" for i in range(20))
    got = html.parse_pages(spark.createDataFrame([(1, page), (2, None), (3, "")], "id int, html string"), select=urls.RESULT_LINK).select("id", urls.result_urls(F.col("parsed")).alias("u")).orderBy("id").collect()
    assert got[0]["u"] == ["https://www.bolu.pol.tr/a", *[f"http://s{i}.pol.tr" for i in range(11)]] and got[1]["u"] is None and got[2]["u"] == []
    few = html.parse_pages(spark.createDataFrame([(page[: page.index("<a class=result__a href=http://s0")],)], "html string"), select=urls.RESULT_LINK).select(urls.result_urls(F.col("parsed"))).first()[0]
    assert few == ["https://www.bolu.pol.tr/a", "https://b.gov.tr/c+d"]


def test_form_encode(spark):
    said = ["a b", "çğ*~-_.", "site:x.pol.tr 100%+&=?/", "", None, "日本"]
    assert values(spark, said, urls.form_encode) == [None if s is None else quote_plus(s) for s in said]
    assert values(spark, ["Çorum"], urls.search_urls)[0] == [urls.SEARCH_PAGE + quote_plus(q) for q in ("site:corum.pol.tr 2026 polisevi fiyat", "Çorum polisevi 2026 fiyat listesi site:pol.tr")]


def test_fixture_page(spark):
    rows = "".join("<tr>" + "".join(f"<td>{c}</td>" for c in r) + "</tr>" for r in (("Oda", "Üye/Öğretmen", "Kamu", "Sivil"), ("Tek", "700 TL", "850 TL", "1.100 TL"), ("Çift", "900 TL", "1.050 TL", "1.400 TL"), ("Ek yatak", "300 TL", "350 TL", "400 TL")))
    pages = spark.createDataFrame([("u", f"<p>2026 konaklama</p><table>{rows}</table>")], "url string, html string")
    got = tariff.entries(html.parse_pages(pages), tariff.PROBE).first()
    assert (got["fiyat_kurum_personeli"], got["fiyat_kamu_personeli"], got["fiyat_sivil"]) == ("700 – 900 TL", "850 – 1.050 TL", "1.100 – 1.400 TL")


def test_match_score_and_ties(spark):
    fac = spark.createDataFrame([(0, "Çorum", "İskilip Öğretmenevi"), (1, "Çorum", "İskilip Öğretmenevi")], "ord int, il string, isim string")
    pages = spark.createDataFrame([("https://www.iskilipogretmenevi.com.tr/x", "", "")], "url string, title string, text string")
    got = match.match_pages(pages, fac).first()
    assert (got["ord"], got["score"]) == (0, 138)


def test_upsert_replaces_whole_rows_and_is_idempotent(spark):
    old = spark.createDataFrame([("a", "x", "1"), ("b", "y", "2")], "il string, isim string, v string")
    new = spark.createDataFrame([("a", "x", None, 1), ("a", "x", "9", 0), ("c", "z", "3", 2)], "il string, isim string, v string, o int")
    once = upsert.upsert(old, new, ["il", "isim"], "o")
    rows = sorted(map(tuple, once.collect()), key=str)
    assert rows == [("a", "x", None), ("b", "y", "2"), ("c", "z", "3")]
    assert sorted(map(tuple, upsert.upsert(once, new, ["il", "isim"], "o").collect()), key=str) == rows


def test_documents(spark, tmp_path):
    path = tmp_path / "m.json"
    path.write_text('{"tesisler": [{"il": "Bolu", "isim": "B", "tip": null}, {"il": "Ağrı", "isim": "A", "tip": "Polisevi"}]}', encoding="utf-8")
    got = documents.facilities(spark, [str(tmp_path / "none.json"), str(path)])
    assert [tuple(r) for r in got.orderBy("ord").collect()] == [(0, "Bolu", "B", None), (1, "Ağrı", "A", "Polisevi")]
    with pytest.raises(FileNotFoundError):
        documents.facilities(spark, [str(tmp_path / "none.json")])
    assert documents.tariff_document(spark, None).count() == 0
    entry = spark.createDataFrame([("Bolu", "B", "1.000 TL", None, None, "u", None)], documents.ENTRY)
    upsert.write_document(entry, "n", str(tmp_path / "out.json"), str(tmp_path / "mirror.json"))
    assert documents.tariff_document(spark, str(tmp_path / "out.json")).collect() == entry.collect()
    assert (tmp_path / "mirror.json").read_text() == (tmp_path / "out.json").read_text() and sorted(p.name for p in tmp_path.glob("[!.]*.json")) == ["m.json", "mirror.json", "out.json"]


def test_json_in_pieces(spark, tmp_path):
    """A document of many parts is what json.dumps writes, and comes back by ranges of any size."""
    draw = random.Random(2)
    said = ['a "b" \\ {[', "ç\n\t", "", None, "]}", "日本 \\\\", 'x": [{']
    rows = [(f"il{draw.randrange(9)}", f"isim{i:03}", draw.choice(said), draw.choice(said)) for i in range(150)]
    df = spark.createDataFrame(rows, "il string, isim string, fiyat_sivil string, kaynak string").repartition(7)
    path = str(tmp_path / "d.json")
    fields = {"not": 'n "tesisler": [{"il": "no"}] ', "deep": {"tesisler": [{"il": "deeper"}]}, "n": 3}
    json_files.write_json(spark, path, fields, {"other": (df.limit(3), ["isim"]), "tesisler": (df, ["il", "isim"]), "none": (df.limit(0), ["il"])}, str(tmp_path / "no" / "mirror.json"))
    names = ["il", "isim", "fiyat_sivil", "kaynak"]
    want = [{k: v for k, v in zip(names, r) if v is not None} for r in sorted(rows)]
    read = json.loads(open(path).read())
    assert read["tesisler"] == want and read["none"] == [] and len(read["other"]) == 3 and {k: read[k] for k in fields} == fields and not (tmp_path / "no").exists()
    listed = json.dumps({"tesisler": want}, ensure_ascii=False, indent=2)
    json_files.write_json(spark, path + "2", {}, {"tesisler": (df, ["il", "isim"])})
    assert open(path + "2").read() == listed + "\n"
    for size in (64, 1000, 1 << 20):
        got = json_files.read_array(spark, path, "tesisler", "il string, isim string, fiyat_sivil string, kaynak string", size)
        assert [tuple(r)[1:] for r in got.orderBy("place").collect()] == sorted(rows)
    assert got.rdd.getNumPartitions() == 1 and json_files.read_array(spark, path, "not", "il string").count() == json_files.read_array(spark, path, "none", "il string").count() == 0
    many = json_files.array_elements(spark, path, "tesisler", 1000)
    assert many.rdd.getNumPartitions() > 5 and [json.loads(r["value"]) for r in many.orderBy("place").collect()] == want


def test_report(spark, tmp_path):
    results = spark.createDataFrame([("b", None, "not_found", 3), ("a", "x", "found", 1)], "il string, isim string, status string, n_tried int")
    upsert.write_report(results, results.where("status = 'found'").select("il", "isim"), str(tmp_path / "r.json"), "n")
    said = json.loads((tmp_path / "r.json").read_text())
    assert datetime.fromisoformat(said.pop("finished_at")).tzinfo is not None
    assert said == {"started_note": "n", "iller_scanned": 2, "found_count": 1, "found": [{"il": "a", "isim": "x"}], "results": [{"il": "a", "isim": "x", "status": "found", "n_tried": 1}, {"il": "b", "status": "not_found", "n_tried": 3}]}


def test_pages_are_parsed_in_parts_of_bounded_size():
    import pyarrow as pa

    from priceloom.functions import html

    sizes = [10] * 300 + [html.PART_BYTES + 5, 0] + [html.PART_BYTES // 4] * 20
    batch = pa.record_batch({"html": pa.array(["x" * n for n in sizes] + [None])})
    parts = list(html._parts(batch, "html"))
    assert [x for p in parts for x in p.column("html").to_pylist()] == batch.column("html").to_pylist()
    assert all(p.num_rows <= 256 and (p.num_rows == 1 or sum(len(x or "") for x in p.column("html").to_pylist()) <= html.PART_BYTES) for p in parts)


def test_spread_leaves_so_many_rows_to_a_task(spark):
    from priceloom.sources import documents

    few, many = (documents.spread(spark.range(0, n, 1, 1), 50) for n in (10, 5000))
    assert few.rdd.getNumPartitions() == spark.sparkContext.defaultParallelism and many.rdd.getNumPartitions() == 100
