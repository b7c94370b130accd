import duckdb
import pytest
from compare import connect, differences

from fumarole.catalog.oracle import ORACLE
from fumarole.catalog.queries import QUERIES

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def con():
    return connect(SF)


def test_every_oracle_has_a_query():
    assert set(ORACLE) <= set(QUERIES)


@pytest.mark.parametrize("name", ["union_of_feeds", "union_sources_last_feed_wins"])
def test_unions_keep_other_and_null_types(spark, tmp_path, name):
    path = str(tmp_path / "events.parquet")
    kind = "case event_id % 7 when 0 then null when 1 then 'refund' else event_type end"
    spark.read.parquet("/root/testdata/sf0.001/events.parquet").selectExpr("* except (event_type)", f"{kind} as event_type").write.parquet(path)
    con = duckdb.connect()
    con.execute(f"create view events as select * from '{path}/*.parquet'")
    assert differences(QUERIES[name](spark, str(tmp_path)), con, ORACLE[name]) == ""


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_equals_sql(spark, con, name):
    assert differences(QUERIES[name](spark, SF), con, ORACLE[name]) == ""
