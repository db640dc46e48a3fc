"""Every query of the library against the same in SQL, at the smallest scale."""

import math
import os
from collections import Counter

import pytest

from landloom.job_queries import ORACLE_SQL, QUERIES

DIR = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def norm(v):
    if v is None or isinstance(v, float) and math.isnan(v):
        return None
    return round(v, 6) if isinstance(v, float) else str(v)


@pytest.mark.skipif(not os.path.exists(DIR), reason="needs the given tables")
@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_sql(spark, name):
    import duckdb

    df = QUERIES[name](spark, DIR)
    columns = sorted(df.columns)
    db = duckdb.connect()
    for t in TABLES:
        db.execute(f"CREATE VIEW {t} AS SELECT * FROM '{DIR}/{t}.parquet'")
    want = db.sql(ORACLE_SQL[name])
    at = [want.columns.index(c) for c in columns]
    assert Counter(
        tuple(norm(r[c]) for c in columns) for r in df.collect()
    ) == Counter(tuple(norm(r[i]) for i in at) for r in want.fetchall())
