"""Every query of the subpackage that has SQL equals it on the small tables, row by row."""

import duckdb
import pytest

import __spark_entry__ as entry
from provisio.llm import queries
from provisio.sources.tables import TABLES, table_path

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{table_path(SF, t)}')")
    return c


@pytest.mark.parametrize("name", sorted(queries.ORACLE))
def test_query_equals_sql(spark, con, name):
    got = queries.QUERIES[name](spark, SF)
    want = con.execute(queries.ORACLE[name])
    names = [c[0] for c in want.description]
    assert sorted(got.columns) == sorted(names)
    rows = lambda found: sorted(map(tuple, found), key=repr)
    assert rows(got.select(names).collect()) == rows(want.fetchall())


def test_all_operators_and_the_pipeline_are_registered():
    names = entry.queries()
    for n in range(1, 14):
        assert sum(k.startswith(f"op{n}_") for k in names) == 1
    assert "pipeline" in names
