import re

import pytest

from priceloom.plans import queries as plans


@pytest.mark.parametrize("name", sorted(plans.SQL))
def test_query_equals_sql(name, same):
    same(plans.QUERIES[name], plans.SQL[name])


def test_every_query_has_sql():
    assert set(plans.QUERIES) == set(plans.SQL)


def test_norm_texts_takes_whole_texts(spark):
    sf = "/root/testdata/sf0.001"
    got = dict(plans.QUERIES["norm_texts"](spark, sf).collect())
    texts = dict(spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect())
    plain = str.maketrans("çğıöşü", "cgiosu")
    assert got == {i: re.sub("[^a-z0-9]+", "", (t or "").lower().replace("ß", "ss").translate(plain)) for i, t in texts.items()}
    assert max(map(len, got.values())) > 10_000


def test_upsert_of_all_customers(spark):
    sf = "/root/testdata/sf0.001"
    customers = spark.read.parquet(f"{sf}/customer.parquet").count()
    assert all(plans.QUERIES[n](spark, sf).count() == customers for n in ("upsert_replace_all", "null_drop_json_all"))


def test_search_tries_35_candidates(spark, tmp_path):
    spark.createDataFrame([(s, 100 * s + k, 100 * s + k) for s in (1, 2) for k in range(1, 41)], "l_suppkey int, l_partkey int, l_orderkey int").write.parquet(f"{tmp_path}/lineitem.parquet")
    spark.createDataFrame([(100 * s + k, 1) for s in (1, 2) for k in range(1, 41)], "p_partkey int, p_size int").write.parquet(f"{tmp_path}/part.parquet")
    spark.createDataFrame([(100 * s + k, 4e5 if (s, k) in ((1, 8), (2, 36)) else 1.0) for s in (1, 2) for k in range(1, 41)], "o_orderkey int, o_totalprice double").write.parquet(f"{tmp_path}/orders.parquet")
    got = {r["l_suppkey"]: (r["url"], r["n_tried"]) for r in plans.QUERIES["search_first_success_35"](spark, str(tmp_path)).collect()}
    assert got == {1: ("order108", 16), 2: (None, 70)}


def test_entry(spark):
    import __spark_entry__

    assert __spark_entry__.entry(spark).count() > 0
    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())
