"""The audits and the archives against slow versions, hostile input and the edge cases of their docstrings."""

import base64
import collections
import gzip
import hashlib
import io
import itertools
import random
import re

import numpy as np
import pytest

from priceloom.llm import audit, divergence, warc

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def texts(seed, n):
    draw = random.Random(seed)
    words = ["the", "The", "a", "é", "日本", "x$", "BIG", "word", "İ", "don't", " "] + [f"w{i}" for i in range(60)]
    made = [" ".join(draw.choice(words) for _ in range(draw.choice((0, 3, 49, 50, 51, 90)))) for _ in range(n)]
    return [None, "", "", " \n\t", "x" * 300_000, "w " * 200_000, *made, *made[: n // 4]]


@pytest.fixture(scope="module")
def docs(spark):
    draw = random.Random(7)
    rows = [(i, t, draw.choice(("en", "de", None)), draw.choice(("s", "t", "", None)), True, 5) for i, t in enumerate(texts(1, 120))]
    rows += [(None, rows[9][1], "en", "s", None, None), (None, "", None, None, None, None), rows[12], (3, rows[40][1], "en", "only", True, 1)]
    return rows, spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, first boolean, n long").repartition(5)


def failures(text):
    words = WORD.findall(text)
    return {f for f, bad in zip("ABCD", (len(words) < 50, 100 * len(set(words)) < 65 * len(words), 100 * len(re.findall("[A-Z]", text)) > 5 * len(text), re.search("[#$%&*|]", text))) if bad}


def audited(rows, labels):
    """Every order of the filters applied one after the other."""
    good, toxic = ({k for k, *v in labels if v[at] == 1 and k is not None} for at in (0, 1))
    named = [(k, s or "", failures(t or "") | ({"E"} if k is not None and any(o[0] is not None and o[0] < k and (o[1] or "") == (t or "") for o in rows) else set())) for k, t, _, s, *_ in rows]
    out, shapley = {}, collections.Counter()
    for part in {p for _, p, _ in named}:
        own = [(k, bad) for k, p, bad in named if p == part]
        for order in itertools.permutations("ABCDE"):
            left = own
            for step, f in enumerate(order, 1):
                gone = [x for x in left if f in x[1]]
                left = [x for x in left if f not in x[1]]
                failing = sum(f in bad for _, bad in own)
                out[part, "".join(order), step] = (len(left), len(gone), failing - len(gone), sum(bad == {f} for _, bad in own), sum(k in good for k, _ in gone), sum(k in toxic for k, _ in gone))
                shapley[part, f] += len(gone)
    return {k: (*v, shapley[k[0], k[1][k[2] - 1]]) for k, v in out.items()}


def test_audit(spark, docs, monkeypatch):
    rows, df = docs
    labels = [(i, i % 2, i % 3) for i in range(0, 90)] + [(1, 1, 1), (None, 1, 1), (7, None, None), (10**9, 1, 1)]
    said = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    want = audited(rows, labels)
    for most in (audit.BROADCAST_ROWS, 0):
        monkeypatch.setattr(audit, "BROADCAST_ROWS", most)
        got = {(r["part"], r["filter_order"], r["step"]): tuple(r)[3:] for r in audit.filter_audit(df, said).collect()}
        assert got == want
    assert audit.filter_audit(df.limit(0), said).count() == 0
    assert audit.filter_audit(df.select("doc_id", "text", "source").where("source = 's'"), said.limit(0)).where("good_lost + toxic_lost > 0").count() == 0


@pytest.mark.parametrize("n", [0, 1, 2, 3, 5, 1000, 4096])
def test_positional_popcount(n):
    words = np.random.default_rng(n).integers(0, 1 << 32, n, np.uint32)
    assert audit.positional_popcount(words).tolist() == [int(((words >> k) & 1).sum()) for k in range(32)]


def diverging(rows, least, top):
    occurs, in_docs = collections.defaultdict(collections.Counter), collections.defaultdict(collections.Counter)
    groups = {(l or "", s or "") for _, _, l, s, *_ in rows}
    for _, text, lang, source, *_ in rows:
        found = re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
        occurs[lang or "", source or ""].update(found)
        in_docs[lang or ""].update(set(found))
    out = []
    for lang, source in groups:
        kept = [t for t, n in in_docs[lang].items() if n >= least]
        of = lambda c: {t: 1 + 10**9 * (c[t] + 5) // (sum(c[x] for x in kept) + 5 * len(kept)) for t in kept}  # noqa: E731, B023
        whole, own = of(sum((occurs[g] for g in groups if g[0] == lang), collections.Counter())), of(occurs[lang, source])
        pairs = [(s, sum(abs(own[t] - other[t]) for t in kept)) for l, s in groups if l == lang and s != source for other in (of(occurs[lang, s]),)]
        terms = [(t, own[t] - whole[t]) for t in kept if occurs[lang, source][t] and own[t] > whole[t]]
        for part, found in (("pair", pairs), ("term", terms)):
            ranked = sorted(found, key=lambda x: (-x[1], x[0].encode()))
            out += [(lang, source, part, item, value, k) for k, (item, value) in enumerate(ranked, 1) if part == "pair" or k <= top]
    return sorted(out)


def test_divergence(docs, monkeypatch):
    rows, df = docs
    # Few bits make terms collide, so that clashes are split; small bounds take the ways of large tables.
    for least, top, bits, most, held, cells in ((30, 50, 64, 10**6, 400_000, 1 << 16), (5, 3, 3, 10**6, 50, 1), (12, 7, 5, 0, 10**6, 64)):
        monkeypatch.setattr(divergence, "BROADCAST_ROWS", most)
        monkeypatch.setattr(divergence, "HELD_TERMS", held)
        monkeypatch.setattr(divergence, "BLOCK_CELLS", cells)
        monkeypatch.setattr(divergence, "BLOCK_TERMS", min(cells, 64))
        got = sorted(map(tuple, divergence.source_divergence(df, least, top, bits).collect()))
        assert got == diverging(rows, least, top)
    assert divergence.source_divergence(df.limit(0)).count() == 0
    none = divergence.source_divergence(df.where("doc_id < 4")).collect()
    assert {r["value"] for r in none} <= {0} and all(r["part"] == "pair" for r in none)


def test_share_doesnt_overflow(spark):
    big = 4 * 10**15
    row = spark.range(1).select(divergence.share(divergence.F.lit(big), divergence.F.lit(10 * big), divergence.F.lit(7)).alias("p")).first()
    assert row["p"] == 1 + 10**9 * (big + 5) // (10 * big + 35)


def pages():
    long_, other = "é<p>" * 400, "y" * 1000
    return [
        (1, "http://a/ü b\r\nX: 1", long_), (5, "http://b/", long_), (3, None, long_), (5, "http://b/", long_), (None, "http://n/", long_), (None, None, long_), (7, "http://c/", "y" * 999), (8, "http://c/", "y" * 999),
        (9, "u", other), (-2, "u", other), (10, "", None), (11, "u", ""), (12, "u", "\x00\r\n\r\nWARC/1.1\r\n"), (13, "u", "long " * 300_000), (14, "u", "日本" * 200), (15, "u", "日本" * 200),
    ]


def revisits(rows):
    out = []
    for key, _, html in rows:
        raw = (html or "").encode()
        last = max((k for k, _, h in rows if k is not None and (h or "").encode() == raw), default=None)
        again = len(raw) >= 1000 and key is not None and key != last
        out.append((key, len(raw), hashlib.sha1(raw).hexdigest(), "revisit" if again else "response", last if again else None))
    return sorted(out, key=repr)


def test_warc_round_trip(spark, tmp_path, monkeypatch):
    rows = pages()
    df = spark.createDataFrame([(*r, "x", 1) for r in rows], "page_id long, url string, html string, record_type string, first int").repartition(3)
    columns = ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"]
    for most, hot, size in ((10**5, 10**4, 1 << 28), (0, 4, 1), (0, 10**6, 500)):
        monkeypatch.setattr(warc, "BROADCAST_ROWS", most)
        monkeypatch.setattr(warc, "HOT", hot)
        monkeypatch.setattr(warc, "ARCHIVE_BYTES", size)
        read = warc.round_trip(df, payload=True).collect()
        assert sorted((tuple(r[c] for c in columns) for r in read), key=repr) == revisits(rows)
        assert all(r["problem"] is None for r in read) and {r["html"] for r in read if r["record_type"] == "response"} == {h or "" for _, _, h in rows}
    assert {r["url"] for r in read} >= {"http://a/%C3%BC%20b%0D%0AX:%201", None}
    assert warc.round_trip(df.limit(0)).count() == 0
    warc.write_archives(warc.mark_revisits(df), f"{tmp_path}/w")
    warc.write_archives(warc.mark_revisits(df), f"{tmp_path}/w")  # appended
    assert warc.read_archives(spark, f"{tmp_path}/w").count() == 2 * len(rows)
    assert not list((tmp_path / "w").glob("_temporary*"))
    for f in (tmp_path / "w").glob("*.warc.gz"):  # any gzip reader reads them
        assert gzip.decompress(f.read_bytes()).startswith(b"WARC/1.1\r\n")


def read(data, payload=True):
    return list(warc.records(io.BytesIO(data).read, payload))


def member(head, block, end=b"\r\n\r\n"):
    return gzip.compress(head + b"\r\n\r\n" + block + end)


def test_warc_records_one_by_one():
    data = b"".join(warc.record(k, "u", "response", None, b"p" * (k * 40_000)) for k in range(5))
    assert [(r["page_id"], len(r["html"]), r["problem"]) for r in read(data)] == [(k, 40_000 * k, None) for k in range(5)]
    assert [(r["payload_bytes"], r["html"]) for r in read(data, False)] == [(40_000 * k, None) for k in range(5)]
    assert read(b"") == []


def test_warc_tells_what_is_wrong():
    good = warc.record(1, "u", "response", None, b"hello")
    raw = gzip.decompress(good)
    hexed = raw.replace(base64.b32encode(hashlib.sha1(b"hello").digest()), hashlib.sha1(b"hello").hexdigest().encode())
    cases = {
        "payload's digest": gzip.compress(raw.replace(base64.b32encode(hashlib.sha1(b"hello").digest()), base64.b32encode(hashlib.sha1(b"other").digest()))),
        "block's digest": gzip.compress(raw.replace(b"hello", b"hellO")), "shorter": gzip.compress(raw[:-7]), "longer": gzip.compress(raw + b"more"), "no record": gzip.compress(b"nonsense\r\n"),
        "no content length": member(b"WARC/1.1\r\nWARC-Type: response", b""), "no HTTP header": member(b"WARC/1.1\r\nContent-Length: 3", b"abc"), "isn't whole": gzip.compress(b"WARC/1.1"), "doesn't end": gzip.compress(b"WARC/1.1\r\n" + b"x" * 200_000),
    }
    for said, bad in cases.items():
        rows = read(good + bad + good)
        assert len(rows) == 3 and said in rows[1]["problem"] and rows[0] == rows[2] and rows[0]["problem"] is None, said
    assert read(gzip.compress(hexed))[0]["problem"] is None and hexed != raw
    for broken in (good + good[:-9], good + b"\x00junk"):
        rows = read(broken)
        assert rows[0]["problem"] is None and len(rows) == 2 and rows[1]["problem"]
    draw = random.Random(5)
    for _ in range(300):
        data = bytearray(good * 2)
        data[draw.randrange(len(data))] ^= 1 << draw.randrange(8)
        assert read(bytes(data)) is not None  # nothing raises
