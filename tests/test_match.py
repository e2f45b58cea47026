import random
import re

import pytest
from pyspark.sql import functions as F

from priceloom.operators import contain, match

PLAIN = str.maketrans("çğıöşüÇĞİIÖŞÜ", "cgiosucgiiosu")


def norm(s):
    return re.sub("[^a-z0-9]+", "", (s or "").translate(PLAIN).lower())


def best(facilities, title, url, text):
    """The best facility of a page by comparing with each."""
    host = re.sub("^[a-z]*:?//", "", (url or "")).split("/")[0].lower().replace("www.", "") if url else ""
    core_of_host = host.replace("ogretmenevi.com.tr", "").replace(".com.tr", "")
    blob, found, top = norm(f"{title or ''} {host} {(text or '')[:4000]}"), None, 0
    for ord_, _, isim in facilities:
        name = norm(isim)
        core = (re.match("(.+?)ogretmen", name) or ["", ""])[1]
        score = max(60 + len(core) if len(core) >= 4 and core in blob else 0, 80 + len(core_of_host) if len(core_of_host) >= 4 and core_of_host in name else 0)
        score = 120 + len(name) if name and name in blob else score
        if score > top:
            found, top = ord_, score
    return found, top


@pytest.fixture(scope="module")
def case():
    draw = random.Random(3)
    towns = ["Çorum", "İskilip", "Bolu", "Muş", "Ağrı", "Van", "Ordu", "Uşak", "Fatsa"]
    facilities = [(i, draw.choice(towns), draw.choice((f"{draw.choice(towns)} Öğretmenevi", f"{draw.choice(towns)}{draw.choice('ab ')} Öğretmenevi Müdürlüğü", draw.choice(towns), "", None, f"Polis Evi {draw.randrange(9)}"))) for i in range(80)]
    hosts = ["www.corumogretmenevi.com.tr", "bolu.com.tr", "x.example", "ordu.com.tr", "WWW.fatsaogretmenevi.com.tr", "ogretmen.com.tr"]
    pages = [(i, draw.choice([None, *(f"https://{h}/{i}" for h in hosts)]), draw.choice((None, "", "Çorum Öğretmenevi", "Fiyat")), draw.choice((None, " ".join(draw.choices([*towns, "Öğretmenevi", "oda", "evi"], k=draw.randrange(12))), "x " * 2500 + "Çorum Öğretmenevi"))) for i in range(300)]
    return facilities, pages


def frames(spark, case):
    facilities, pages = case
    return spark.createDataFrame(facilities, "ord long, il string, isim string"), spark.createDataFrame(pages, "page long, url string, title string, text string")


@pytest.mark.parametrize("rows", [contain.AUTOMATON_ROWS, 0])
def test_match_pages(spark, case, monkeypatch, rows):
    monkeypatch.setattr(contain, "AUTOMATON_ROWS", rows)
    monkeypatch.setattr(match, "BROADCAST_ROWS", rows)
    facilities, pages = frames(spark, case)
    made = match.match_pages(pages, facilities, "page")
    got = {r["page"]: (r["ord"], r["score"]) for r in made.collect()}
    want = {p: best(case[0], title, url, text) for p, url, title, text in case[1]}
    assert got == {p: x for p, x in want.items() if x[0] is not None} and len(set(got.values())) > 5
    assert "NestedLoop" not in made._jdf.queryExecution().toString() and "Cartesian" not in made._jdf.queryExecution().toString()
    assert match.match_pages(pages.limit(0), facilities, "page").count() == match.match_pages(pages, facilities.limit(0), "page").count() == 0


@pytest.mark.parametrize("rows", [contain.AUTOMATON_ROWS, 0])
def test_contained(spark, monkeypatch, rows):
    monkeypatch.setattr(contain, "AUTOMATON_ROWS", rows)
    draw = random.Random(9)
    texts = [(i, "".join(draw.choices("abé", k=draw.randrange(60)))) for i in range(60)] + [(1, "abab"), (99, None), (98, "")]
    patterns = {"".join(draw.choices("abé", k=draw.randrange(1, 9))) for _ in range(80)} | {""}
    got = contain.contained(spark.createDataFrame(texts, "key long, text string"), spark.createDataFrame([(p,) for p in patterns] + [(None,)], "pattern string"))
    assert sorted(map(tuple, got.collect())) == sorted((k, p) for k, t in texts for p in patterns if p and p in (t or ""))


def test_many_names_meet_by_gram(spark):
    """Beyond the automaton's bound: equi-joins only in the plan."""
    names = spark.range(contain.AUTOMATON_ROWS + 50_000).select(F.col("id").alias("ord"), F.lit("x").alias("il"), F.concat(F.lit("Ev "), F.conv(F.col("id") * 7919, 10, 36), F.lit(" Öğretmenevi")).alias("isim"))
    few = spark.range(200).select(F.col("id").alias("page"), F.lit(None).cast("string").alias("url"), F.lit("").alias("title"), F.concat(F.lit("bak: Ev "), F.conv(F.col("id") * 7919 * 31, 10, 36), F.lit(" Öğretmenevi burada")).alias("text"))
    assert names.count() > contain.AUTOMATON_ROWS
    made = match.match_pages(few, names, "page")
    assert "NestedLoop" not in made._jdf.queryExecution().toString()
    assert {r["page"]: r["ord"] for r in made.collect()} == {i: 31 * i for i in range(200)}


def test_patterns_with_common_pieces_meet_by_themselves(spark, monkeypatch):
    """Numbered names share all their pieces of a few characters: what meets is what is contained, not all that share a piece."""
    monkeypatch.setattr(contain, "AUTOMATON_ROWS", 0)
    names = spark.range(3000).select(F.format_string("customer%09d", F.col("id") * 111).alias("pattern"))
    texts = spark.range(3000).select(F.col("id").alias("key"), F.format_string("fiyat customer%09d und mehr", F.col("id") * 111).alias("text"))
    found = contain.contained(texts, names)
    assert sorted(map(tuple, found.collect())) == [(i, f"customer{i * 111:09d}") for i in range(3000)]
    known = contain.Filter(names, 3000)
    passed = sum(len(known.may(contain.Substrings(f"fiyat customer{i * 111:09d} und mehr").of(17))) for i in range(0, 3000, 10))
    assert 300 <= passed <= 400
