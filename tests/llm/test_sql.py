import duckdb
import pytest

from cases import SMALL
from genopile.llm.oracle import ORACLES
from genopile.llm.queries import QUERIES


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_sql(spark, name):
    con = duckdb.connect()
    for t in ("documents", "embeddings", "conversations", "benchmark"):
        con.execute(f"CREATE VIEW {t} AS FROM '{SMALL}/{t}.parquet'")
    frame = QUERIES[name](spark, SMALL)
    columns = sorted(frame.columns)
    found = con.execute(ORACLES[name])
    order = [[c[0] for c in found.description].index(c) for c in columns]
    want = sorted(repr(tuple(r[i] for i in order)) for r in found.fetchall())
    assert sorted(repr(tuple(r)) for r in frame.select(*columns).collect()) == want


def test_thirteen_queries():
    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES) == list(range(1, 14))
