import collections
import hashlib
import json
import random
import re
import struct
import tracemalloc
import zlib
from fractions import Fraction

import numpy as np
import public_tokenizers as P
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import license_texts

from priceloom.llm import bpe, chat, jaccard, licenses, media, mixing, quality_model, queries, rules, tokens, toxicity
from priceloom.llm.arrow import crc_mod, lower_az
from priceloom.llm.notices import NOTICES

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LONG = "wort " * 60_000 + "<|endoftext|>"
TEXTS = [None, "", " \n\t ", "one", "Same text here", "Same text here", LONG, "x" * 200_000, "İstanbul ΑΣ ßé ½ ² '\u0085\u001c日本 <|endoftext|><|startoftext|>", "<|im_end|> <\\|im_sep|> a<|b"]


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(i, t, "en", "s", 1, 2.0) for i, t in enumerate(TEXTS)] + [(None, "lost", None, None, None, None), (4, "Same text here", "en", "s", 1, 2.0)]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_tokens int, score double")


def empty(docs):
    return docs.where("false")


@pytest.mark.parametrize("name", sorted(queries.oracle_sql()))
def test_query_equals_sql(name, same):
    same(queries.queries()[name], queries.oracle_sql()[name])


def test_tokens(docs):
    path = P.path("byte_bpe_50k.json")
    lib = Tokenizer.from_file(path)
    got = tokens.count_tokens(docs, path).collect()
    assert len(got) == len(TEXTS) + 2 and tokens.count_tokens(empty(docs), path).count() == 0
    for r in got:
        if r["doc_id"] is not None:
            t = TEXTS[r["doc_id"]] or ""
            n = len(lib.encode(t, add_special_tokens=False).ids)
            assert (r["n_bytes"], r["n_tokens"], r["over_limit"]) == (len(t.encode()), n, n > 1024)


def test_bpe(docs):
    path = P.path("word_bpe_49k.json")
    lib = Tokenizer.from_file(path)
    for r in bpe.bpe_round_trip(docs, path).collect():
        if r["doc_id"] is not None:
            ids = lib.encode(TEXTS[r["doc_id"]] or "", add_special_tokens=False).ids
            assert r["ids"] == ids and r["decoded"] == lib.decode(ids, skip_special_tokens=False)
            assert r["ids_sha256"] == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
    assert bpe.bpe_round_trip(empty(docs), path).count() == 0


def test_bpe_refuses_other_files():
    with pytest.raises(ValueError, match="another normalizer"):
        bpe.Backtracker(P.path("byte_bpe_50k.json"))
    spec = json.load(open(P.path("word_bpe_49k.json"), encoding="utf-8"))
    bpe.refuse(spec)
    added, split, last = spec["added_tokens"], *spec["pre_tokenizer"]["pretokenizers"]
    lenient = {"type": "Sequence", "pretokenizers": [{**split, "behavior": "Isolated"}, last]}
    for change in ({"decoder": {"type": "ByteLevel"}}, {"pre_tokenizer": last}, {"pre_tokenizer": lenient}, {"pre_tokenizer": None}, {"normalizer": None}, {"model": {**spec["model"], "dropout": 0.1}},
                   {"model": {**spec["model"], "type": "Unigram"}}, {"added_tokens": [{**added[0], "lstrip": True}]}, {"added_tokens": [{**added[0], "id": 60_000}]}):
        with pytest.raises(ValueError, match="can't encode"):
            bpe.refuse(spec | change)


def test_tokens_of_random_texts():
    path = P.path("byte_bpe_50k.json")
    lib, count, draw = Tokenizer.from_file(path), tokens._counter(path), random.Random(4)
    vocab = sorted(lib.get_vocab())
    texts = ["".join(draw.choice(["a", " ", "\n", "é", "日", "'s", "7", "!", "<|endoftext|>", "\u00a0", "Ⅷ", draw.choice(vocab)]) for _ in range(draw.randint(0, 90))) for _ in range(2000)]
    assert count(texts)[0].tolist() == [len(lib.encode(t, add_special_tokens=False).ids) for t in texts]


def test_bpe_random_words():
    path = P.path("word_bpe_49k.json")
    lib, encode, draw = Tokenizer.from_file(path), bpe._encoder(path, True, False), random.Random(3)
    texts = ["".join(draw.choice("abcdeghinorst'.,!- é\n0ñ") for _ in range(draw.randint(0, 60))) for _ in range(800)]
    assert [x.as_py() for x in encode(texts)[3]] == [lib.encode(t, add_special_tokens=False).ids for t in texts]


def test_bpe_caches_end_with_their_task():
    path = P.path("word_bpe_49k.json")
    lib, draw = Tokenizer.from_file(path), random.Random(6)
    texts = [" ".join("".join(draw.choices("abdeghilmnorstu", k=9)) for _ in range(100)) + " 日本 ΑΣ" for _ in range(200)]
    bpe._encoder(path, True, False)(["ΑΣ"])  # the tables, which a worker keeps
    tracemalloc.start()
    try:
        encode = bpe._encoder(path, True, False)
        made = [x.as_py() for x in encode(texts)[3]]
        assert made == [lib.encode(t, add_special_tokens=False).ids for t in texts]
        del made
        held = tracemalloc.get_traced_memory()[0]
        del encode
        assert held > 2_000_000 and tracemalloc.get_traced_memory()[0] < held / 10
    finally:
        tracemalloc.stop()


def test_chat(spark):
    rows = [(1, 2, "assistant", "<|im_end|>x"), (1, 1, "user", None), (1, None, None, "<\\\\|im_sep|>"), (2, 0, "assistant", None), (None, 0, "user", "é"), (1, 2, "assistant", "<|im_end|>x"), (3, 0, "assistant", "\n日本😀 " * 3)]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    path = P.path("byte_bpe_50k.json")
    made = chat.format_conversations(df, path)
    got = {r["conv_id"]: r for r in chat.digests(made).collect()}
    assert set(got) == {1, 2, 3, None} and chat.digests(chat.format_conversations(df.where("false"), path)).count() == 0
    turns = [("", "<\\\\|im_sep|>"), ("user", ""), ("assistant", "<|im_end|>x"), ("assistant", "<|im_end|>x")]
    assert got[1]["turns_sha256"] == hashlib.sha256("".join(f"{a}\n{b}\n" for a, b in turns).encode()).hexdigest()
    assert got[1]["loss_sha256"] == hashlib.sha256(b"<|im_end|>x<|im_end|>x").hexdigest() and got[1]["loss_chars"] == 22
    assert (got[2]["loss_chars"], got[3]["loss_chars"]) == (0, len("\n日本😀 " * 3))


def test_media(docs):
    stored = media.store_texts(docs)
    for r in media.describe_media(stored, digests=True).collect():
        if r["doc_id"] is not None:
            payload = media.payload_of(TEXTS[r["doc_id"]])
            assert len(payload) % 192 == 0 and r["sample_bytes"] == len(payload) and r["error"] is None
            assert r["sha256"] == hashlib.sha256(payload).hexdigest() and r["tail_crc32"] == zlib.crc32(payload[-16:])
            assert len(r["keyframes"]) == -(-r["n_samples"] // media.KEYFRAME_EVERY) and r["codec"] == "raw"
    assert media.describe_media(media.store_texts(empty(docs))).count() == 0


def test_media_reads_other_layouts(spark):
    data = media.write_container(b"a" * 192 * 100)
    moov = next(i for i in range(len(data)) if data[i + 4 : i + 8] == b"moov")
    bad = [None, b"", data[: moov + 50], data[:-1], b"junk" * 9]
    df = spark.createDataFrame([(i, x) for i, x in enumerate([data, *bad])], "doc_id long, media binary")
    got = {r["doc_id"]: r for r in media.describe_media(df).collect()}
    assert got[0]["n_samples"] == 100 and got[0]["keyframes"][1]["offset"] - got[0]["keyframes"][0]["offset"] == 12 * 192
    assert all(got[i]["error"] for i in range(1, len(bad) + 1))


def box(kind, *parts):
    return media._box(kind, *parts)


def u32(*values):
    return struct.pack(f">{len(values)}I", *values)


def movie(stbl, more=b"", mvex=b"", minf=b""):
    handler = media._full(b"hdlr", bytes(4), b"vide", bytes(12))
    trak = box(b"trak", media._full(b"tkhd", u32(0, 0, 7, 0, 0)), box(b"mdia", media._full(b"mdhd", u32(0, 0, 10, 0)), handler, box(b"minf", minf, box(b"stbl", *stbl))))
    return box(b"ftyp", b"isom", u32(0)) + box(b"moov", trak, mvex) + more


ENTRY = media._full(b"stsd", u32(1), box(b"avc1", bytes(24), struct.pack(">HH", 64, 48), bytes(40)))


def test_media_hostile_and_odd_files(spark):
    deep = b""
    for _ in range(2000):
        deep = box(b"moov", deep)
    tables = lambda size, sync=u32(1, 1), kind=b"stsz": [ENTRY, media._full(b"stts", u32(1, 4, 3)), media._full(b"stss", sync), media._full(b"stsc", u32(1, 1, 4, 1)), media._full(kind, size), media._full(b"stco", u32(1, 8))]
    data_handler = media._full(b"hdlr", bytes(4), b"alis", bytes(12))
    trun = media._full(b"trun", u32(3), struct.pack(">i", 0), u32(5, 7, 9), flags=0x201)
    moof = box(b"moof", box(b"traf", media._full(b"tfhd", u32(7, 0x10000), flags=0x20020), trun))
    fragment = movie([ENTRY], moof + box(b"mdat", bytes(50)), box(b"mvex", media._full(b"trex", u32(7, 1, 2, 5, 0))))
    files = {
        "deep": deep,
        "huge": movie(tables(u32(1, 0xFFFFFFFF))),
        "longer": movie(tables(u32(0, 1 << 30))),
        "zero": movie(tables(u32(2, 4), u32(1, 0))),
        "small": movie(tables(u32(4, 4) + bytes([0x12, 0x34]), kind=b"stz2")),
        "handler": movie(tables(u32(2, 4)), minf=data_handler),
        "fragment": fragment,
    }
    df = spark.createDataFrame(list(files.items()), "name string, media binary")
    got = {r["name"]: r for r in media.describe_media(df, keys=("name",)).collect()}
    assert all(got[x]["error"] for x in ("deep", "huge", "longer", "zero"))
    assert (got["small"]["n_samples"], got["small"]["sample_bytes"], got["small"]["error"]) == (4, 10, None)
    assert (got["handler"]["width"], got["handler"]["height"], got["handler"]["seconds"]) == (64, 48, 1.2)
    r, moof_at = got["fragment"], fragment.index(b"moof") - 4
    assert (r["n_samples"], r["sample_bytes"], r["seconds"], r["keyframes"], r["error"]) == (3, 21, 0.6, [], None)
    made = media._describe(fragment)
    assert made["offsets"].tolist() == [moof_at, moof_at + 5, moof_at + 12]


def test_media_tables_against_a_reader_by_entry():
    draw = random.Random(8)
    for _ in range(30):
        chunks = [draw.randint(1, 4) for _ in range(draw.randint(1, 6))]
        sizes = [draw.randint(1, 9) for _ in range(sum(chunks))]
        starts = [draw.randint(0, 300) for _ in chunks]
        runs = [(k + 1, c, 1) for k, c in enumerate(chunks) if not k or chunks[k - 1] != c]
        sync = sorted(draw.sample(range(1, len(sizes) + 1), draw.randint(0, len(sizes))))
        stbl = [ENTRY, media._full(b"stts", u32(1, len(sizes), 2)), media._full(b"stss", u32(len(sync), *sync)), media._full(b"stsc", u32(len(runs)), *(u32(*r) for r in runs)), media._full(b"stsz", u32(0, len(sizes), *sizes)), media._full(b"stco", u32(len(chunks), *starts))]
        want, k = [], 0
        for start, count in zip(starts, chunks):
            for _ in range(count):
                want.append((start, sizes[k]))
                start += sizes[k]
                k += 1
        d = media._describe(movie(stbl, bytes(400)))
        assert list(zip(d["offsets"].tolist(), d["sizes"].tolist())) == want and d["keys"].tolist() == [x - 1 for x in sync] and d["ticks"] == 2 * len(sizes)


def brute(rows, num=80):
    sets = {}
    for i, t in rows:
        w = WORD.findall((t or "").translate({c: c + 32 for c in range(65, 91)}))
        sets[i] = {tuple(w[k : k + 5]) for k in range(len(w) - 4)} if len(w) >= 5 else ({tuple(w)} if w else set())
    root = {i: i for i in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    held = collections.defaultdict(list)
    for i in sorted(sets):
        met = collections.Counter()
        for g in sets[i]:
            met.update(held[g])
            held[g].append(i)
        for j, k in met.items():
            if 100 * k >= num * (len(sets[i]) + len(sets[j]) - k):
                a, b = find(i), find(j)
                root[max(a, b)] = min(a, b)
    return {i: (len(sets[i]), find(i)) for i in sets}


def passages():
    """Pairs of documents that are one shared passage for the larger part and differ from each other in a word of the rest."""
    draw = random.Random(11)
    words, passage, rows = [f"w{k}" for k in range(4000)], [f"p{k}" for k in range(30)], []
    for _ in range(300):
        text = [draw.choice(words) for _ in range(draw.randint(5, 6))]
        other = list(text)
        other[len(text) // 2] = draw.choice(words)
        rows += [(len(rows), " ".join(passage + text)), (len(rows) + 1, " ".join(passage + other))]
    return rows


def test_jaccard_with_more_crowded_keys_than_are_broadcast(spark, monkeypatch):
    monkeypatch.setattr(jaccard, "CROWDED", 0)
    rows = passages()
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in jaccard.jaccard_components(df, bucket=1).collect()}
    assert got == brute(rows)


@pytest.mark.parametrize("bucket", [32, 1])
def test_jaccard_equals_brute_force(spark, bucket):
    draw = random.Random(5)
    words = [f"w{k}" for k in range(400)]
    passage = [f"p{k}" for k in range(60)]
    rows = [(0, None), (1, ""), (2, "A b"), (3, "a B"), (4, "a\tb c d"), (5, LONG)]
    for base in range(40):
        text = [draw.choice(words) for _ in range(draw.randint(3, 120))]
        if base % 2:
            at = draw.randint(0, len(text))
            text[at:at] = passage
        for _ in range(6):
            copy = list(text)
            for _ in range(draw.randint(0, 4)):
                copy[draw.randrange(len(copy))] = draw.choice(words)
            rows.append((len(rows), " ".join(copy)))
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumn("rep", F.lit(1)).withColumn("key", F.lit(2))
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in jaccard.jaccard_components(df, bucket=bucket).collect()}
    assert got == brute(rows)


@pytest.mark.parametrize("sample", [64, 1])
def test_jaccard_of_families_near_the_threshold(spark, monkeypatch, sample):
    """Copies of a few texts whose pairs lie on both sides of the threshold, beside texts that are mostly one shared passage."""
    monkeypatch.setattr(jaccard, "SAMPLE", sample)
    monkeypatch.setattr(jaccard, "GROUP", 5)
    draw = random.Random(17)
    words, rows = [f"w{k}" for k in range(3000)], []
    for size in (40, 160):
        text = [draw.choice(words) for _ in range(size)]
        for _ in range(70):
            copy = list(text)
            for _ in range(draw.randint(0, size // 20)):
                copy[draw.randrange(size)] = draw.choice(words)
            rows.append((len(rows), " ".join(copy)))
    for _ in range(60):
        own = [draw.choice(words) for _ in range(draw.randint(1, 9))]
        rows.append((len(rows), " ".join(text[:60] + own)))
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in jaccard.jaccard_components(df, bucket=2).collect()}
    assert got == brute(rows)


def test_jaccard_neighbourhood_rows_tell_sets_beyond_the_threshold_apart(spark):
    """Rows carry bitmaps that rule out sets of 390 shingles with 110 differences or more, and none with 40 (up to 86 are similar)."""
    draw = np.random.default_rng(23)
    base, made = draw.integers(0, 1 << 62, 370).astype(np.uint64), []
    for i in range(40):
        own = draw.integers(0, 1 << 62, 20).astype(np.uint64)  # 40 differences between two of the first ten, over 110 between others
        s = np.concatenate([base, own]) if i < 10 else np.concatenate([base[: 370 - 35], draw.integers(0, 1 << 62, 55).astype(np.uint64)])
        made.append((i, i, 7, i % 2, len(s), *jaccard._bitmap(s, jaccard.WIDE)))
    rows = spark.createDataFrame(made, "rep long, c long, key long, kind long, size long, " + ", ".join(f"{x} long" for x in jaccard._map(jaccard.WIDE)))
    met = jaccard._met(rows.where("kind = 0"), rows.where("kind = 1"), "key", "true", 80, jaccard.WIDE)
    assert sorted(map(tuple, met.collect())) == sorted((min(a, b), max(a, b)) for a in range(0, 10, 2) for b in range(1, 10, 2))
    texts = spark.createDataFrame([(1, "a b c d e f")], "rep long, text string")
    job = jaccard.Neighbourhoods(texts, rows.select("key").limit(0), 5, 80, jaccard.Scratch(spark))
    assert job.rows({}).columns[-1] == f"x{jaccard.WIDE - 1}"


def test_jaccard_links_no_texts_without_words(spark):
    rows = [(i, t) for i, t in enumerate(["", "", " ", " ", "\n", "\n", None, None, "a", "a", "\u00a0", "\u00a0"])]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in jaccard.jaccard_components(df).collect()}
    assert got == brute(rows) and [got[i] for i in (1, 3, 5, 7, 9, 11)] == [(0, 1), (0, 3), (0, 5), (0, 7), (1, 8), (1, 10)]


def test_jaccard_edges(docs):
    got = collections.Counter((r["doc_id"], r["n_shingles"], r["component_id"]) for r in jaccard.jaccard_components(docs).collect())
    assert sum(got.values()) == len(TEXTS) + 2 and got[(None, 1, None)] == 1 and got[(4, 1, 4)] == 2 and got[(5, 1, 4)] == 1 and got[(0, 0, 0)] == 1
    assert jaccard.jaccard_components(empty(docs)).count() == 0


def test_rules(docs):
    for r in rules.quality_rules(docs).collect():
        if r["doc_id"] is None:
            continue
        t = TEXTS[r["doc_id"]] or ""
        w = WORD.findall(t)
        n = collections.Counter(zip(w, w[1:], w[2:]))
        covered = {i + k for i, g in enumerate(zip(w, w[1:], w[2:])) if n[g] > 1 for k in range(3)}
        assert (r["n_words"], r["word_chars"], r["n_repeat_words"]) == (len(w), sum(map(len, w)), len(covered))
        assert r["n_symbols"] == sum(t.count(c) for c in "#*$%&|<>") and r["base_failed"] == (len(w) < 50 or 2 * len(covered) > len(w))
    assert rules.quality_rules(empty(docs)).count() == 0


def test_rules_bands(spark):
    draw = random.Random(1)
    noise = " ".join("".join(chr(draw.randint(33, 0x2FF)) for _ in range(9)) for _ in range(400))
    prose = " ".join("".join(draw.choice("etaoinshr") for _ in range(5)) for _ in range(400))
    got = {r["doc_id"]: r for r in rules.quality_rules(spark.createDataFrame([(1, noise), (2, prose), (3, "a b\na b\n\na b")], "doc_id long, text string")).collect()}
    assert got[1]["reason"] == "incompressible" and not got[1]["kept"] and got[2]["kept"] and got[3]["n_dup_lines"] == 2


def test_rules_verdicts_by_brute_force():
    draw, bands = random.Random(6), rules.Bands()
    prose = lambda n: " ".join("".join(draw.choice("etaoinshr") for _ in range(draw.randint(1, 7))) for _ in range(n))
    texts = [prose(draw.choice([40, 60, 300, 900, 3000])) for _ in range(40)] + ["ab cd ef " * 40 + prose(60), prose(900) + " spam and eggs" * 300, prose(700) + "".join(chr(draw.randint(33, 700)) for _ in range(4000)), "\n".join([prose(9)] * 4 + [" ", " "] + [prose(50)])]
    zstd = rules.zstandard.ZstdCompressor(level=bands.level)
    for t, row in zip(texts, zip(*rules._rules(bands)(texts))):
        raw = t.encode()
        ratio = len(zstd.compress(raw)) / len(raw)
        low, high = [(lo, hi) for least, lo, hi in bands.whole if len(raw) >= least][-1]
        chunks = [raw[i : i + 4096] for i in range(0, len(raw), 4096)]
        if len(raw) > 4096:
            chunks[-1] = raw[-4096:]
        out = [not bands.chunk_low <= len(zstd.compress(c)) / 4096 <= bands.chunk_high for c in chunks if len(c) == 4096]
        w = WORD.findall(t)
        n = collections.Counter(zip(w, w[1:], w[2:]))
        covered = {i + k for i, g in enumerate(zip(w, w[1:], w[2:])) if n[g] > 1 for k in range(3)}
        lines = [x for x in t.split("\n") if WORD.search(x)]
        bad = len(w) < 50 or 2 * len(covered) > len(w)
        assert row[3] == len(lines) - len(set(lines)) and row[4] == len(covered)
        assert (row[5], row[6]) == (bad, not bad and low <= ratio <= high and sum(out) <= bands.chunk_share * len(out))


def test_mix(spark, docs):
    draw = random.Random(2)
    rows = [(i, " ".join("w" for _ in range(draw.randint(0, 80))), f"s{min(4, int(draw.expovariate(0.7)))}" if i % 9 else None) for i in range(1500)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    got = mixing.mix_sources(df).collect()
    assert len(got) == 1500 and all(0 <= r["taken"] <= 3 * r["size"] for r in got)
    sums, due = collections.Counter(), {}
    for r in got:
        sums[r["source"]] += r["taken"]
        due[r["source"]] = (r["target"], r["source_size"])
    assert abs(sum(t for t, _ in due.values()) - sum(r["size"] for r in got)) < 1e-3 and all(t <= 3 * s + 1e-6 for t, s in due.values())
    assert all(abs(sums[s] - t) <= 80 for s, (t, _) in due.items())
    again = mixing.mix_sources(df.repartition(3)).collect()
    assert sorted((r["doc_id"], r["taken"]) for r in again) == sorted((r["doc_id"], r["taken"]) for r in got)
    assert mixing.mix_sources(docs).count() == len(TEXTS) + 2 and mixing.mix_sources(empty(docs)).count() == 0
    plan = mixing.mix_sources(docs)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Pandas" not in plan and "InArrow" not in plan


def slow_targets(sizes, cap=3):
    """Targets by filling up in exact fractions: sources that reach their cap leave one by one, the rest share anew by weight."""
    names = sorted((s for s in sizes if s is not None), key=lambda s: [*map(ord, s)]) + [None] * (None in sizes)
    weight = {s: k % 3 + 1 for k, s in enumerate(names)}
    target, open_ = {}, set(names)
    while open_:
        left = sum(sizes.values()) - sum(target.values())
        share = {s: Fraction(left * weight[s], sum(weight[x] for x in open_)) for s in open_}
        over = [s for s in open_ if share[s] > cap * sizes[s]]
        if not over:
            return target | share
        target[over[0]] = Fraction(cap * sizes[over[0]])
        open_.remove(over[0])
    return target


def test_targets_by_filling_up(spark):
    draw = random.Random(8)
    for n in (1, 2, 3, 7, 30):
        sizes = {f"{chr(draw.choice([65, 97, 0xE9, 0x1F600]))}{k}": int(draw.expovariate(1) ** 4 * 100) for k in range(n)} | ({None: draw.randint(0, 50)} if n != 2 else {})
        df = spark.createDataFrame([(s, part) for s, size in sizes.items() for part in (size // 2, size - size // 2)], "source string, size long")
        got = {r["source"]: r["target"] for r in mixing.source_targets(df).collect()}
        assert got == {s: pytest.approx(float(t)) for s, t in slow_targets(sizes).items()}


def test_mix_of_repeated_rows(spark, monkeypatch):
    monkeypatch.setattr(mixing, "CHUNK", 1000)
    many = spark.range(100_000).select(F.lit(7).alias("doc_id"), F.lit("a b c").alias("text"), F.lit("s0").alias("source"))
    more = spark.range(400).select(F.col("id").alias("doc_id"), F.concat(F.lit("w "), F.expr("repeat('x ', CAST(id % 50 AS INT))")).alias("text"), F.concat(F.lit("s"), (F.col("id") % 3).cast("string")).alias("source"))
    got = mixing.mix_sources(many.unionByName(more))
    sums = got.groupBy("source").agg(F.sum("taken").alias("taken"), F.max("target").alias("target"), F.count("*").alias("n"), F.max(F.col("taken") - 3 * F.col("size")).alias("over")).collect()
    assert sum(r["n"] for r in sums) == 100_400
    assert all(abs(r["taken"] - r["target"]) <= 0.01 * r["target"] and r["over"] <= 0 for r in sums)


def test_mix_targets_on_small_tables(spark):
    got = queries.op7_source_mix(spark, "/root/testdata/sf0.01").groupBy("source_size", "target").agg(F.sum("taken").alias("t")).collect()
    assert all(abs(r["t"] - r["target"]) <= 0.01 * r["target"] for r in got)


def test_mixed_stage_with_null_ids(spark, monkeypatch):
    import corpus_pipeline

    monkeypatch.setattr(mixing, "CHUNK", 4, raising=False)
    rows = [(i if i % 2 else None, f"t{i} " + "w " * (i % 40), f"s{i % 3}" if i % 5 else None, None if i % 7 else "x") for i in range(200)]
    rows += [(None, "same text", "s0", None)] * 30 + [(None, None, "s1", None), (None, "", None, None), (7, "other text", "s1", None)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string, lang string").repartition(3)
    got = collections.Counter(map(tuple, corpus_pipeline.mixed(spark, df, "").collect()))
    due = collections.Counter()
    for r in mixing.mix_sources(df, row=F.struct("doc_id", "text", "source", "lang")).collect():
        assert 0 <= r["copies"] <= 3
        due[tuple(r["doc_id"])] += r["copies"]
    assert got == +due and sum(got.values()) > 100 and got[(None, "same text", "s0", None)] > 1
    assert corpus_pipeline.mixed(spark, df.where("false"), "").count() == 0


def test_licenses(docs):
    for r in licenses.scan_licenses(docs).collect():
        if r["doc_id"] is not None:
            assert r["n_words"] == len(licenses.TOKEN.findall((TEXTS[r["doc_id"]] or "")))
    assert licenses.scan_licenses(empty(docs)).count() == 0
    assert len(licenses.rules()) > 300
    row = list(zip(*licenses._scanner()(["Under the MIT license, under the mit-license. Apache License, Version 2.0; cc by-nc 4.0. GNU GPL v3 or later"])))[0]
    assert row[1:6] == (4, 0, 13, ["apache-2", "cc-by-nc", "mit"], ["apache-2", "cc-by-nc", "cc-by-nc-4.0", "gpl-3", "mit"])


def slow_licenses(text):
    """Base places word by word; all rules on all texts, without the prefilter; suppression by comparing each pair."""
    words = licenses.TOKEN.findall((text or "").translate({c: c + 32 for c in range(65, 91)}))
    places, labels = [], set()
    for phrase, label in licenses.BASE:
        p = phrase.split()
        hits = [k for k in range(len(words)) if words[k : k + len(p)] == p]
        places += hits
        labels |= {label} if hits else set()
    padded = f" {' '.join(words)} "
    found = [(r.priority, m.start() - m.end(), m.start(), n, m.end(), r.label) for n, r in enumerate(licenses.rules()) if r.priority for m in re.finditer(rf"(?<= )(?:{r.pattern})(?= )", padded)]
    kept = []
    for x in sorted(found):
        if not any(k[2] <= x[2] and x[4] <= k[4] for k in kept):
            kept.append(x)
    return (len(words), len(places), min(places, default=None), max(places, default=None), sorted(labels), sorted(labels | {k[5] for k in kept}))


def test_licenses_against_slow_rules():
    draw = random.Random(9)
    bits = [phrase for phrase, _ in licenses.BASE] + ["MIT License", "gpl v2 or later", "GNU General Public License version 3", "apache-2.0", "Creative Commons Attribution 4.0", "cc by-nc-sa 3.0", "SPDX-License-Identifier: GPL-2.0-or-later", "SPDX-License-Identifier: MIT", "all rights reserved", "the", "license", "é", "by", "x11 license", "bsd 3 clause", "see the LICENSE file for details", "is a registered trademark of", "Under the MIT"]
    bits += [re.sub(r"[(]\?[:P<>\w]*|[|?)].*", "", p).strip() for _, _, p in licenses.SENTENCES]
    bits += [text for _, text in license_texts.TEXTS]
    texts = [None, ""] + [" ".join(draw.choice(bits) for _ in range(draw.randint(0, 14))) for _ in range(100)]
    got = list(zip(*licenses._scanner()(texts)))
    for text, row in zip(texts, got):
        assert row[:6] == slow_licenses(text), text
    for rule in licenses.rules():
        assert re.search(rf"\b{rule.keyword}\b", rule.pattern), rule


def test_each_signature_by_a_text():
    texts = [text for _, text in license_texts.TEXTS]
    for (labels, text), row in zip(license_texts.TEXTS, zip(*licenses._scanner()(texts))):
        assert set(labels.split(",")) <= set(row[5]), (text, row[5])
    padded = [f" {' '.join(licenses.TOKEN.findall(lower_az(text)))} " for text in texts]
    by_hand = (*licenses.SENTENCES, *NOTICES)
    assert len({pattern for _, _, pattern in by_hand}) == len(by_hand) >= 200
    for label, keyword, pattern in by_hand:
        met = [re.search(rf"(?<= )(?:{pattern})(?= )", words) for words in padded]
        assert any(met), (label, pattern)
        assert all(keyword in m[0].split() for m in met if m), (label, keyword)
    clean = ["We deal with art and a common game, and hope that either version of the package will sell.", "The user may choose the header; no fee for the open module."]
    assert all(row[5] == [] for row in zip(*licenses._scanner()(clean)))


def test_models(spark, docs):
    all_docs, labels = (spark.read.parquet(f"/root/testdata/sf0.1/{t}.parquet") for t in ("documents", "labels"))
    held = crc_mod("doc_id", 3) == 1
    model = quality_model.train(all_docs, labels, ~held, 600)
    scored = quality_model.predicted(quality_model.score_quality(all_docs.where(held), model)).join(labels, "doc_id")
    assert scored.agg(F.avg((F.col("predicted") == F.col("quality")).cast("int"))).first()[0] > 0.97
    held = crc_mod("doc_id", 5) == 0
    tox = toxicity.train(all_docs, labels, ~held, 600)
    scored = toxicity.score_toxicity(all_docs.where(held), tox).join(labels, "doc_id").withColumn("hit", (F.col("score") >= 0.5) == (F.col("toxic") == 1))
    assert scored.agg(F.avg(F.col("hit").cast("int"))).first()[0] > 0.97
    for made in (quality_model.score_quality(docs, model), toxicity.score_toxicity(docs, tox)):
        got = made.collect()
        assert len(got) == len(TEXTS) + 2 and all(0 <= r["score"] <= 1 for r in got)
    none = quality_model.train(all_docs, labels.where("false"), ~held)
    assert quality_model.score_quality(docs, none).first()["score"] == pytest.approx(0.5)
    assert toxicity.train(all_docs, labels.where("false"), ~held).bias == pytest.approx(0.0)


def test_swaps_are_penalised(spark):
    rows = [np.array([1, 2]), np.array([2, 3]), np.array([1, 9]), np.array([4, 5])] * 40
    y = np.array([1, 0, 1, 0] * 40)
    chosen = toxicity.choose(rows, y)
    at = chosen[1]
    free = toxicity.fit(rows, y, chosen)
    held = toxicity.fit(rows, y, chosen, {(at, at): 10.0}, 10, swap=50.0)
    assert abs(held.weights[at]) < 0.5 * abs(free.weights[at])
    assert toxicity.swaps("The Muslim women, said.")[0] == "The christian men said."
    # Sums of products from tasks are those of the swaps one by one.
    words = ["women", "men", "black", "zzz", "said"]
    table = toxicity.WordTable(toxicity.features, toxicity.WIDTH)
    places = {int(f): k for k, f in enumerate(toxicity._distinct(table, " ".join(words)))}
    text = "Black women said zzz. Men said. " * 50 + "No such word"
    shared = spark.sparkContext.broadcast(places)
    (i, j, v, n), _ = list(zip(*toxicity._swap_products(shared)([text, None])))
    want = np.zeros((len(places), len(places)))
    made = 0
    for sentence in toxicity._SENTENCE.split(text):
        for other in toxicity.swaps(sentence):
            d = np.zeros(len(places))
            for f, k in places.items():
                d[k] = (f in toxicity._distinct(table, sentence)) - float(f in toxicity._distinct(table, other))
            want += np.outer(d, d)
            made += 1
    got = np.zeros_like(want)
    got[list(i), list(j)] = v
    assert n == made and np.allclose(got, want)


def test_planted_terms(spark):
    """Texts without identity terms get some; the penalty draws the scores of held-out pairs nearer where labels go with terms."""
    known = toxicity._known()
    text = "One two three four. Short it. Five six seven eight nine! " * 5
    pairs = toxicity.counterfactuals(text, known)
    assert pairs == toxicity.counterfactuals(text, known) and 4 <= len(pairs) <= 20 and toxicity.counterfactuals(None, known) == toxicity.counterfactuals("a b", known) == []
    for old, new in pairs:
        differ = [(a, b) for a, b in zip(old.split(), new.split()) if a != b]
        assert len(differ) == 1 and differ[0][1] in toxicity._OTHERS[differ[0][0]] and len(old.split()) == len(new.split())
    assert toxicity.counterfactuals("The women said so. Not here.", known) == [("The women said so.", x) for x in toxicity.swaps("The women said so.")]
    draw = random.Random(6)
    rows = []
    for i in range(240):
        words = draw.choices("alpha beta gamma delta epsilon zeta".split(), k=12) + (draw.choices("vile awful".split(), k=2) + ["muslim"] * (i % 3 == 0) if i % 2 else ["christian"] * (i % 3 == 0))
        draw.shuffle(words)
        rows.append((i, " ".join(words) + ".", i % 2))
    docs = spark.createDataFrame([r[:2] for r in rows], "doc_id long, text string")
    labels = spark.createDataFrame([(i, y) for i, _, y in rows], "doc_id long, toxic int")
    neutral = [f"alpha {t} beta gamma." for t in ("muslim", "christian", "jewish", "hindu")]
    apart, wrong = [], []
    for swap in (0.0, 1.0, 20.0):
        model = toxicity.train(docs, labels, F.lit(True), swap=swap)
        assert model.swapped > 200
        scores = toxicity._scorer(spark.sparkContext.broadcast(model))(neutral)[0]
        apart.append(max(scores) - min(scores))
        wrong.append(sum(s >= 0.5 for s in scores))
        right = toxicity._scorer(spark.sparkContext.broadcast(model))([t for _, t, _ in rows])[0]
        assert sum((s >= 0.5) == (y == 1) for s, (_, _, y) in zip(right, rows)) > 230
    assert apart[0] > apart[1] > apart[2] and apart[1] < 0.7 * apart[0] and wrong[2] <= wrong[0]
    tables = [spark.read.parquet(f"/root/testdata/sf0.001/{t}.parquet") for t in ("documents", "labels")]
    assert toxicity.train(*tables, crc_mod("doc_id", 5) != 0).swapped > 100


def test_media_bombs():
    """Runs without bytes of their own can't name more samples than the file has bytes; keyframes cost no object each."""
    empty = media._full(b"trun", u32(24_000), flags=0)
    many = movie([ENTRY], box(b"moof", box(b"traf", media._full(b"tfhd", u32(7), flags=0x20000), *[empty] * 2000)), box(b"mvex", media._full(b"trex", u32(7, 1, 2, 0, 0))))
    ones = movie([ENTRY], box(b"moof", box(b"traf", media._full(b"tfhd", u32(7), flags=0x20000), *[media._full(b"trun", u32(400), flags=0)] * 2000)), box(b"mvex", media._full(b"trex", u32(7, 1, 2, 1, 0))))
    n = 1 << 20
    flat = movie([ENTRY, media._full(b"stts", u32(1, n, 1)), media._full(b"stsc", u32(1, 1, n, 1)), media._full(b"stsz", u32(1, n)), media._full(b"stco", u32(1, 8))], bytes(n))
    tracemalloc.start()
    for data in (many, ones, flat):
        rows = media._reader(False)([data])
        assert rows[8][0] if data is not flat else len(rows[7][0]) == n and rows[8][0] is None
    most = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert most < 120 * (1 << 20)


def test_fits_against_slow_solvers():
    draw = np.random.default_rng(3)
    rows = [np.unique(draw.integers(0, 12, 5)) for _ in range(60)]
    y = np.array([int((r < 5).sum() + draw.random() > 2.2) for r in rows])
    # The hinge loss: no small step from the solution in any direction of a thousand lowers the objective by more than its tolerance.
    model = quality_model.fit(rows, y, epochs=400)
    x = np.zeros((60, 13))
    for k, r in enumerate(rows):
        x[k, r] = np.sqrt(model.squares[r])
        x[k, :12] *= np.sign(np.divide(model.weights[:12], 1.0, where=True))
    p, q = 1 + sum(np.isin(range(12), r) for r, l in zip(rows, y) if l), 1 + sum(np.isin(range(12), r) for r, l in zip(rows, y) if not l)
    ratio = np.log(p / (y.sum() + 1)) - np.log(q / (60 - y.sum() + 1))
    assert np.allclose(np.sqrt(model.squares[:12]), np.abs(ratio), atol=1e-5)
    x = np.array([[*(ratio * np.isin(range(12), r)), 1.0] for r in rows])
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    sign, cost = np.where(y == 1, 1, -1), np.where(y == 1, 60 / (2 * y.sum()), 60 / (2 * (60 - y.sum())))
    loss = lambda w: 0.5 * w @ w + (cost * np.maximum(0, 1 - sign * (x @ w))).sum()
    found = np.array([*(model.weights[:12] / ratio), model.bias])
    slow = np.zeros(13)
    best = loss(slow)
    for t in range(1, 40001):
        slow = slow - 0.5 / np.sqrt(t) * 0.05 * (slow - ((cost * sign * (sign * (x @ slow) < 1)) @ x))
        best = min(best, loss(slow))
    assert loss(found) <= best + 0.02 * abs(best)
    # The logistic loss: Adam's end against plain gradient descent.
    chosen = toxicity.choose(rows, y, least_chi2=0.0)
    tox = toxicity.fit(rows, y, chosen, l2=0.01)
    hot = np.array([[f in r for f in chosen] for r in rows], float)
    weight = np.where(y == 1, 0.5 / y.sum(), 0.5 / (60 - y.sum()))
    w, b = np.zeros(len(chosen)), 0.0
    for _ in range(30000):
        g = weight * (1 / (1 + np.exp(-(hot @ w + b))) - y)
        w, b = w - 0.3 * (hot.T @ g + 0.01 * w), b - 0.3 * g.sum()
    value = lambda w, b: (weight * np.logaddexp(0, np.where(y == 1, -1, 1) * (hot @ w + b))).sum() + 0.005 * w @ w
    assert value(tox.weights, tox.bias) <= value(w, b) + 1e-3


def test_stages_with_columns_named_as_theirs(spark, tmp_path):
    import corpus_pipeline

    draw = random.Random(4)
    texts = [None, "", "too short", "a b " * 100] + [" ".join("".join(draw.choice("etaoinshr") for _ in range(5)) for _ in range(90)) for _ in range(20)]
    rows = [(i if i % 4 else None, t, None if i % 3 else "s") for i, t in enumerate(texts)]
    plain = spark.createDataFrame(rows, "doc_id long, text string, source string")
    taken = ["kept", "reason", "n_words", "score", "mixed_key", "mixed_copies", "mixed_k", "column_0"]
    more = plain.select("*", *[F.lit(c).alias(c) for c in taken])
    spark.createDataFrame([(i, 0) for i in range(9)], "doc_id long, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    for stage in (corpus_pipeline.quality, corpus_pipeline.harmless, corpus_pipeline.distinct, corpus_pipeline.mixed):
        got = stage(spark, more, str(tmp_path))
        assert got.columns == more.columns
        found = collections.Counter(map(tuple, got.collect()))
        assert found and all(r[3:] == tuple(taken) for r in found) and stage(spark, more.where("false"), str(tmp_path)).count() == 0
        if stage is not corpus_pipeline.mixed:
            want = rows[4:] if stage is corpus_pipeline.quality else rows
            assert found == collections.Counter((*r, *taken) for r in want)


def test_pipeline(spark):
    import corpus_pipeline

    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, "/root/testdata/sf0.001")
        assert docs.columns == ["doc_id", "text", "lang", "source", "n_chars"], name
    assert corpus_pipeline.STAGES[-1][1](spark, docs, "/root/testdata/sf0.001").count() == docs.count()
