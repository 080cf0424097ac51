"""Every registered query of the reference's operators against its SQL in DuckDB, at the smallest size."""

import duckdb
import pytest

from wavelake import plans

DIR = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()
QUERIES, SQL = plans.load()


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from '{DIR}/{t}.parquet'")
    return con


def plain(v):
    return round(v, 7) if isinstance(v, float) else v


@pytest.mark.parametrize("name", list(QUERIES))
def test_query(spark, duck, name):
    df = QUERIES[name](spark, DIR)
    columns = sorted(df.columns)
    got = sorted(str([plain(v) for v in r]) for r in df.select(*columns).collect())
    rel = duck.execute(f"select * from ({SQL[name]})")
    have = [c[0] for c in rel.description]
    assert sorted(have) == columns
    at = [have.index(c) for c in columns]
    assert got == sorted(str([plain(r[i]) for i in at]) for r in rel.fetchall())


def test_entry(spark):
    import __spark_entry__

    assert __spark_entry__.entry(spark).count() > 0
    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())


def test_prompts_of_odd_texts(spark, tmp_path):
    texts = ["Straße süß", "ŉ ǰ ﬁ ᾳ ΐ dž ǆ", "a\r\nb", "é\r\nb", "éa", " x　", " ", " ", "", None, '{"prompt": 1', "{x}", "[1]", '"q"\\', "tab\t", "İıſK", "𐐨𐐩", "\U0001f468 z", "null"]
    rows = [(2 * i + k, t) for i, t in enumerate(texts) for k in range(2)]
    spark.createDataFrame(rows, "item_id long, text string").coalesce(1).write.parquet(str(tmp_path / "benchmark.parquet"))
    got = [tuple(r) for r in QUERIES["src12_prompt_manifest"](spark, str(tmp_path)).collect()]
    con = duckdb.connect()
    con.execute(f"create view benchmark as select * from '{tmp_path}/benchmark.parquet/*.parquet'")
    assert sorted(got) == sorted(con.execute(SQL["src12_prompt_manifest"]).fetchall())
