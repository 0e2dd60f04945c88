"""Base rules, duplicates, skewed ids, reasons and outliers."""

import random
from datetime import date, datetime, timedelta
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from fixtures import AT, DAY, raw_frame, raw_row
from tillbridge.contracts import ACCEPTED, QUARANTINE
from tillbridge.errors import ContractError
from tillbridge.operators.classification import (
    accepted_rows, canonicalize, classify, flag_outliers, mark_duplicates, quarantine_rows,
    reason_counts,
)
from tillbridge.operators.hotkeys import heavy_hitters, hot_keys


def outcome(spark, rows, **options):
    return {r.source_row_id: list(r.reason_codes)
            for r in classify(raw_frame(spark, rows), **options).collect()}


RULES = [
    (dict(), []),
    (dict(amount="0"), []),
    (dict(amount="-0.00"), []),
    (dict(amount="-0.01"), ["NEGATIVE_AMOUNT"]),
    *[(dict(amount=a), ["INVALID_AMOUNT"])
      for a in ("", " ", "N/A", "Infinity", "NaN", "1.0000000000", "9" * 30, None)],
    *[(dict(txn=t), ["MISSING_TXN"]) for t in ("", "  ", "\t\xa0", None)],
    *[(dict(dtts=d), ["INVALID_DTTS"]) for d in ("", "not-a-date", "2025-07-22", "2025-07-22T09:30:00")],
    (dict(dtts="2025-07-23 00:00:00"), ["DTTS_BATCH_DATE_MISMATCH"]),
    (dict(dtts="2025-07-22 23:59:60"), ["DTTS_BATCH_DATE_MISMATCH"]),
    (dict(dtts="2025-7-22 9:3:0"), []),
    (dict(currency=" usd "), []),
    (dict(currency="GBP"), ["INVALID_CURRENCY"]),
    (dict(currency=None), ["INVALID_CURRENCY"]),
    (dict(region="unknown"), ["INVALID_REGION"]),
    (dict(region=" bkk"), ["INVALID_REGION"]),
    (dict(region=None), ["INVALID_REGION"]),
    (dict(txn="", amount="N/A", currency="gbp", region="unknown"),
     ["MISSING_TXN", "INVALID_AMOUNT", "INVALID_CURRENCY", "INVALID_REGION"]),
]


def test_base_rules_and_reason_order(spark):
    rows = [raw_row(n, **change) for n, (change, _) in enumerate(RULES)]
    got = outcome(spark, rows)
    assert {k: v for k, v in got.items()} == {f"id-{n}": want for n, (_, want) in enumerate(RULES)}


def test_projections(spark):
    rows = [raw_row(1, txn=" T1 ", currency=" usd ", amount="1.50"), raw_row(2, amount="N/A", txn=" T2 ")]
    done = classify(raw_frame(spark, rows))
    accepted, quarantine = accepted_rows(done, AT), quarantine_rows(done, AT)
    assert accepted.columns == ACCEPTED.columns and quarantine.columns == QUARANTINE.columns
    assert [f.dataType for f in accepted.schema] == [f.dataType for f in ACCEPTED.schema]
    row = accepted.first()
    assert (row.txn, row.currency, row.amount, row.transaction_dt) == (
        "T1", "USD", Decimal("1.500000000"), datetime(2025, 7, 22, 9, 30))
    row = quarantine.first()
    assert (row.txn, row.amount, row.reason_codes) == (" T2 ", "N/A", ["INVALID_AMOUNT"])


def test_missing_column_is_named(spark):
    with pytest.raises(ContractError, match="source_row_id"):
        canonicalize(raw_frame(spark, [raw_row()]).drop("source_row_id"))


def test_duplicates(spark):
    rows = [
        raw_row(3, txn="R", source_file="a"), raw_row(1, txn=" R", amount="100.000", source_file="b"),
        raw_row(2, txn="R", source_file="a"),
        raw_row(4, txn="C"), raw_row(5, txn="C", amount="100.01"),
        raw_row(6, txn="X"), raw_row(7, txn="X", region="south"),
        raw_row(8, txn="P"), raw_row(9, txn="P", amount="N/A"),
        raw_row(10, txn="D"),
        raw_row(11, txn="D", batch_date=DAY + timedelta(1), dtts=f"{DAY + timedelta(1)} 09:30:00"),
    ]
    replay, conflict = ["DUPLICATE_REPLAY"], ["DUPLICATE_CONFLICT"]
    want = {"id-3": replay, "id-1": replay, "id-2": [], "id-4": conflict, "id-5": conflict,
            "id-6": conflict, "id-7": conflict, "id-8": [], "id-9": ["INVALID_AMOUNT"],
            "id-10": [], "id-11": []}
    assert outcome(spark, rows) == want
    assert outcome(spark, rows, hot_rows=2) == want


def labelled_rows(ids, hot_copies, seed):
    """Deliveries whose outcome is known from how they are made, in random order."""
    rnd = random.Random(seed)
    rows, want = [], {}

    def deliver(txn, day, place, amount, reasons):
        n = len(rows)
        rows.append(raw_row(
            n, txn=" " * rnd.randint(0, 1) + txn, batch_date=day, dtts=f"{day} 09:30:00", amount=amount,
            source_file=f"f{place // 100}", source_row_number=1 + place % 100))
        want[f"id-{n}"] = reasons

    for k in range(ids):
        day = DAY + timedelta(rnd.randint(0, 1))
        outcome_of = "conflict" if k == 0 else "replay" if k == 1 else rnd.choice(["one", "one", "conflict", "replay"])
        copies = hot_copies if k < 2 else 1 if outcome_of == "one" else rnd.randint(2, 4)
        odd = rnd.randrange(copies)
        if rnd.random() < 0.3:  # delivered first, yet without influence
            deliver(f"T{k}", day, 0, "N/A", ["INVALID_AMOUNT"])
        for place in range(copies):
            if outcome_of == "conflict":
                deliver(f"T{k}", day, place + 1, "7" if place == odd else "5.00", ["DUPLICATE_CONFLICT"])
            else:
                deliver(f"T{k}", day, place + 1, rnd.choice(["5.00", "5.0"]), ["DUPLICATE_REPLAY"] if place else [])
    rnd.shuffle(rows)
    return rows, want


@pytest.mark.parametrize("adaptive", ["true", "false"])
def test_hot_ids_are_judged_as_made(spark, adaptive):
    rows, want = labelled_rows(1200, 800, 7)
    spark.conf.set("spark.sql.adaptive.enabled", adaptive)
    try:
        assert outcome(spark, rows, hot_rows=200) == want
        assert outcome(spark, rows) == want
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")


def skewed(spark, n=60_000):
    """A third of all rows share one id; a third lack an id."""
    return raw_frame(spark, [raw_row()]).drop("txn", "source_row_id", "source_row_number").crossJoin(
        spark.range(0, n, 1, 8)).selectExpr(
        "CASE id % 3 WHEN 0 THEN 'HOT' WHEN 1 THEN ' ' ELSE concat('T', id) END AS txn",
        "id AS source_row_number", "concat('id-', id) AS source_row_id",
        "dtts", "amount", "currency", "region", "source_file", "source_checksum", "batch_date", "ingested_at")


def test_every_hot_key_is_found(spark):
    rows = skewed(spark)
    key = F.when(F.trim("txn") != "", F.xxhash64("txn"))
    found = [r.k for r in hot_keys(rows, key, 1000).collect()]
    assert found == [rows.where("txn = 'HOT'").select(F.xxhash64("txn")).first()[0]]
    assert hot_keys(rows.where("txn <> 'HOT'"), key, 1000).isEmpty()
    many = spark.range(0, 20_000, 1, 8).select((F.col("id") % 4000).alias("k"))
    assert hot_keys(many, F.col("k"), 5).count() == 4000 and hot_keys(many, F.col("k"), 6).isEmpty()


def test_heavy_hitters_are_the_hot_keys(spark):
    rows = skewed(spark)
    key = F.when(F.trim("txn") != "", F.xxhash64("txn"))
    hot = rows.where("txn = 'HOT'").select(F.xxhash64("txn")).first()[0]
    for counters in (1, 64, 4096, 100_000):  # counted whole, lowered, counted whole by each task
        assert [r.k for r in heavy_hitters(rows, key, 1000, counters).collect()] == [hot]
    assert heavy_hitters(rows.where("txn <> 'HOT'"), key, 1000, 64).isEmpty()
    assert heavy_hitters(rows.limit(0), key, 1000).isEmpty()
    many = spark.range(0, 20_000, 1, 8).select((F.col("id") % 4000).alias("k"))
    for counters in (8, 1000, 4000):
        assert heavy_hitters(many, F.col("k"), 5, counters).count() == 4000
        assert heavy_hitters(many, F.col("k"), 6, counters).isEmpty()


def test_heavy_hitters_at_the_bound(spark):
    # Counts around the bound, in an order that lowers them again and again.
    sizes = {k: 90 + k % 25 for k in range(60)}
    rows = [(k,) for r in range(115) for k, n in sizes.items() if r < n] + [(1000 + k,) for k in range(3000)]
    frame = spark.createDataFrame(rows, "k long").repartition(7)
    expected = sorted(k for k, n in sizes.items() if n >= 100)
    for counters in (20, 50, 200, 300):
        assert sorted(r.k for r in heavy_hitters(frame, F.col("k"), 100, counters).collect()) == expected


def test_no_shuffle_of_all_ids(spark):
    frame = spark.range(0, 100_000, 1, 8).select(F.expr("IF(id % 4 = 0, -1, id)").alias("k"))
    found = heavy_hitters(frame, F.col("k"), 20_000, 64)
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and [r.k for r in found.collect()] == [-1]


def test_skewed_rows_are_spread_over_partitions(spark):
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        marked = mark_duplicates(canonicalize(skewed(spark)), hot_rows=1000)
        sizes = [r.n for r in marked.groupBy(F.spark_partition_id()).agg(
            F.count("*").alias("n"), F.count("duplicate_reason")).collect()]
        assert len(sizes) == 8 and max(sizes) < 60_000 / 8 * 1.2
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    counts = {r.duplicate_reason: r["count"] for r in marked.groupBy("duplicate_reason").count().collect()}
    assert counts == {None: 40_001, "DUPLICATE_REPLAY": 19_999}
    first = marked.where("txn = 'HOT' and duplicate_reason is null").first()
    assert first.source_row_number == 0


def test_reason_counts(spark):
    rows = [raw_row(1, txn="", amount="N/A"), raw_row(2, amount="N/A"), raw_row(3)]
    got = {(r.reason_code, r.rows) for r in reason_counts(classify(raw_frame(spark, rows))).collect()}
    assert got == {("MISSING_TXN", 1), ("INVALID_AMOUNT", 2)}


def test_outliers_are_flagged_not_dropped(spark):
    rows = [raw_row(n, amount="10") for n in range(20)] + [raw_row(99, amount="1000")]
    flagged = flag_outliers(accepted_rows(classify(raw_frame(spark, rows)), AT))
    assert flagged.count() == 21
    assert [r.source_row_id for r in flagged.where("is_outlier").collect()] == ["id-99"]
    # 5 * 1200 / 21 rounded half-even
    assert flagged.first().outlier_threshold == Decimal("285.714285714")


def test_one_shuffle_for_the_rows(spark):
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        plan = classify(raw_frame(spark, [raw_row()]))._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert plan.count("Exchange hashpartitioning") == 1 and plan.count("Sort [") == 1
