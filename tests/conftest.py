import os
import sys

import duckdb
import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    conf = {"spark.master": "local[4]", "spark.sql.shuffle.partitions": "8", "spark.ui.enabled": "false", "spark.ui.showConsoleProgress": "false", "spark.driver.memory": "4g", "spark.sql.session.timeZone": "UTC", "spark.checkpoint.dir": str(tmp_path_factory.mktemp("shared"))}
    session = SparkSession.builder.config(map=conf).getOrCreate()
    yield session


@pytest.fixture(scope="session")
def duck():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"create view {t} as select * from '{SF}/{t}.parquet'")
    return c


@pytest.fixture(scope="session")
def same(spark, duck):
    """Holds a query against its SQL at the smallest size."""

    def check(query, sql):
        df = query(spark, SF)
        columns = sorted(df.columns)
        got = sorted(tuple(map(repr, r)) for r in df.select(columns).collect())
        rel = duck.execute(sql)
        names = [d[0] for d in rel.description]
        assert sorted(names) == columns
        at = [names.index(c) for c in columns]
        assert got == sorted(tuple(repr(r[i]) for i in at) for r in rel.fetchall())

    return check
