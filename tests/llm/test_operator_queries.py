"""The registered queries over the smallest tables, against their SQL or a brute force."""

import glob
import math
import os
from collections import Counter

import duckdb
import pytest

import __spark_entry__ as entry
from tillbridge.llm.queries import ORACLES, QUERIES

SF_DIR = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="generated tables are absent")


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for path in glob.glob(f"{SF_DIR}/*.parquet"):
        connection.execute(f"CREATE VIEW {os.path.basename(path).removesuffix('.parquet')} AS SELECT * FROM '{path}'")
    yield connection
    connection.close()


def plain(rows, columns):
    return Counter(tuple(round(r[c], 9) if isinstance(r[c], float) else r[c] for c in sorted(columns)) for r in rows)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_its_sql(spark, duck, name):
    frame, result = QUERIES[name](spark, SF_DIR), duck.execute(ORACLES[name])
    columns = [d[0] for d in result.description]
    assert sorted(frame.columns) == sorted(columns)
    rows = [dict(zip(columns, r)) for r in result.fetchall()]
    assert plain([r.asDict() for r in frame.collect()], columns) == plain(rows, columns)


def test_every_operator_has_its_query():
    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES) == list(range(1, 14))
    assert set(QUERIES) <= set(entry.queries()) and "pipeline" in entry.queries()
    assert set(ORACLES) <= set(entry.oracle_sql())


def test_neighbours_have_the_recall(spark, duck):
    found = QUERIES["op1_neighbours"](spark, SF_DIR).collect()
    rows = duck.execute("SELECT vec_id, embedding FROM embeddings ORDER BY vec_id").fetchall()
    hits = total = 0
    for query, vector in rows:
        if query % 50 == 0:
            size = math.sqrt(sum(x * x for x in vector))
            score = {i: sum(x * y for x, y in zip(v, vector)) / math.sqrt(sum(x * x for x in v)) / size for i, v in rows if i != query}
            best = sorted(score, key=lambda i: (-score[i], i))[:5]
            own = sorted((r for r in found if r.query_id == query), key=lambda r: r["rank"])
            assert all(r.score == pytest.approx(score[r.vec_id], abs=1e-12) for r in own) and len(own) == 5
            hits += len(set(best) & {r.vec_id for r in own})
            total += 5
    assert hits >= 0.9 * total
