import duckdb
import pytest

from tidelake.plans.queries import QUERIES, SQL

DIR = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events".split()


def rows(found):
    key = lambda v: round(v, 5) if isinstance(v, float) else v if v is None or isinstance(v, (int, bool)) else str(v)
    return sorted((tuple(map(key, r)) for r in found), key=repr)


@pytest.mark.parametrize("name", sorted(SQL))
def test_equals_sql(spark, name):
    got = QUERIES[name](spark, DIR)
    names = sorted(got.columns)
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{DIR}/{t}.parquet'")
    want = con.sql(SQL[name])
    assert sorted(want.columns) == names
    assert rows(got.select(*names).collect()) == rows(want.select(*(f'"{n}"' for n in names)).fetchall())
