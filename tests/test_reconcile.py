"""Id sets by fingerprint, against sets and counters of Python."""

from collections import Counter
from datetime import date

import pytest

from tillbridge.operators import reconcile

A, B, C = date(2025, 1, 1), date(2025, 1, 2), date(2025, 1, 3)


def frame(spark, rows):
    return spark.createDataFrame(rows, "batch_date date, source_row_id string")


def expected(left, right):
    dates = {d for d, _ in left + right}
    return {d for d in dates if Counter(r for r in left if r[0] == d) != Counter(r for r in right if r[0] == d)}


@pytest.mark.parametrize("left, right", [
    ([(A, "a"), (A, "b")], [(A, "b"), (A, "a")]),  # order
    ([(A, "a"), (A, "a"), (A, "b")], [(A, "b"), (A, "c"), (A, "c")]),  # repeats that a xor would cancel
    ([(A, "a"), (A, "a")], [(A, "a")]),  # equal sets, unequal counts
    ([(A, "a"), (B, "a")], [(B, "a"), (C, "a")]),  # dates of one side
    ([(None, "a"), (A, None)], [(None, "b"), (A, None)]),  # nulls
    ([(None, "a"), (A, "")], [(None, "a"), (A, "")]),
    ([], []), ([(A, "a")], []),
])
def test_fingerprints_and_differences(spark, left, right):
    l, r = frame(spark, left), frame(spark, right)
    assert {x[0] for x in reconcile.differing_dates(l, r).collect()} == expected(left, right)
    found = {(x.batch_date, x.source_row_id, x.side) for x in reconcile.id_differences(l, r).collect()}
    assert found == {(*x, "LEFT_ONLY") for x in set(left) - set(right)} | {(*x, "RIGHT_ONLY") for x in set(right) - set(left)}


def test_one_exchanged_id_among_many_is_found(spark):
    ids = spark.range(20000).selectExpr("date_add(DATE'2025-01-01', cast(id % 20 as int)) AS batch_date", "sha2(string(id), 256) AS source_row_id")
    other = ids.selectExpr("batch_date", "if(source_row_id = sha2('4217', 256), 'x', source_row_id) AS source_row_id")
    assert [x.batch_date for x in reconcile.differing_dates(ids, other).collect()] == [date(2025, 1, 18)]
    assert {x.side for x in reconcile.id_differences(ids, other).collect()} == {"LEFT_ONLY", "RIGHT_ONLY"}
    assert reconcile.id_differences(ids, ids.repartition(7)).count() == 0
