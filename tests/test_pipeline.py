"""The three jobs over stored tables: first run, rerun, partial retry, failing dates."""

from datetime import date
from decimal import Decimal
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from fixtures import AT, DAY, register, write_day, write_fx, write_gz
from tillbridge.contracts import (
    ACCEPTED, FACT, FILE_AUDIT, MARTS, PIPELINE_RUNS, PUBLISHED, PUBLISHED_VERSIONS, QUARANTINE, RAW_FX_RATES,
    RAW_TRANSACTIONS,
)
from tillbridge.errors import BatchError, ContractError
from tillbridge.plans import pipeline
from tillbridge.plans.pipeline import build_fact, classify_and_load, load_raw, run_batches
from tillbridge.plans.marts import refresh_marts
from tillbridge.plans.publication import (
    create_public_views, current_versions, expire_versions, last_good, latest_runs, publish,
)
from tillbridge.sinks.store import Store, append_new, ensure_namespace, ensure_store, ensure_table

NEXT = date(2025, 7, 23)
LATER = date(2025, 7, 24)


@pytest.fixture
def store(spark, tmp_path, request):
    name = "t_" + request.node.name.replace("[", "_").replace("]", "")
    store = Store(name, str(tmp_path / "store"))
    assert set(ensure_store(spark, store).values()) == {"created"}
    return store


@pytest.fixture
def landed(tmp_path):
    root = tmp_path / "landing"
    write_day(root, DAY, {"bkk": [
        f" TX-1 ,{DAY} 09:30:00,214.29, thb ",
        f"TX-2,{DAY} 09:31:00,4.99,usd",
        f"TX-2,{DAY} 09:31:00,4.990,USD",
        f"TX-3,{DAY} 09:32:00,N/A,EUR",
        f"TX-4,{DAY} 09:32:00,45.74,EUR",
        ",,,",
        f'"TX-5, ""q""",{DAY} 09:33:00,1,THB',
    ]})
    write_day(root, NEXT, {})
    write_fx(root, DAY)
    return root


def test_first_run_and_rerun(spark, store, landed):
    known = register(spark, landed)
    first = {r.batch_date: r for r in load_raw(spark, store, str(landed), [DAY, NEXT], known, AT)}
    assert (first[DAY].tx_files, first[DAY].tx_source_rows, first[DAY].tx_inserted_rows) == (5, 11, 11)
    assert (first[DAY].fx_status, first[DAY].fx_inserted_rows) == ("LOADED", 2)
    assert (first[NEXT].fx_status, first[NEXT].fx_partition_rows) == ("NO_NEW_RATE", 0)
    again = load_raw(spark, store, str(landed), [DAY, NEXT], known, AT)
    assert [(r.tx_source_rows, r.tx_inserted_rows, r.fx_inserted_rows) for r in again] == [(11, 0, 0), (5, 0, 0)]

    raw = spark.table(store.table(RAW_TRANSACTIONS)).where("region = 'bkk'").where(F.col("batch_date") == DAY)
    texts = [tuple(r) for r in raw.orderBy("source_row_number").select("txn", "dtts", "amount", "currency").collect()]
    assert texts[0] == (" TX-1 ", f"{DAY} 09:30:00", "214.29", " thb ")
    assert texts[5] == ("", "", "", "")
    assert texts[6][0] == 'TX-5, "q"'

    done = {r.batch_date: r for r in classify_and_load(spark, store, [DAY, NEXT], AT)}
    assert (done[DAY].raw_rows, done[DAY].accepted_rows, done[DAY].quarantine_rows) == (11, 8, 3)
    assert done[DAY].reconciled and done[DAY].accepted_inserted_rows == 8
    rerun = classify_and_load(spark, store, [DAY, NEXT], AT)
    assert [(r.accepted_inserted_rows, r.quarantine_inserted_rows) for r in rerun] == [(0, 0), (0, 0)]

    fact = {r.batch_date: r for r in build_fact(spark, store, [DAY, NEXT], AT)}
    assert (fact[DAY].fact_inserted_rows, fact[DAY].staleness_days) == (8, 0)
    assert (fact[NEXT].is_carried_forward, fact[NEXT].staleness_days) == (True, 1)
    assert [r.fact_inserted_rows for r in build_fact(spark, store, [DAY, NEXT], AT)] == [0, 0]
    rows = {r.txn: r for r in spark.table(store.table(FACT)).collect()}
    assert (rows["TX-1"].amount_usd, rows["TX-1"].amount_eur) == (Decimal("6.640080317"), Decimal("5.684416597"))
    assert (rows["TX-2"].amount_thb, rows["TX-2"].amount_eur) == (Decimal("161.038278"), Decimal("4.271821645"))
    assert (rows["TX-4"].amount_thb, rows["TX-4"].amount_usd) == (Decimal("1724.297372"), Decimal("53.429805591"))


def test_partial_retry_fills_only_what_is_missing(spark, store, landed):
    load_raw(spark, store, str(landed), [DAY], register(spark, landed), AT)
    full = Store(store.prefix + "_full", store.location + "_full")
    ensure_store(spark, full)
    load_raw(spark, full, str(landed), [DAY], register(spark, landed), AT)
    classify_and_load(spark, full, [DAY], AT)
    # An earlier attempt stored every accepted row and part of the quarantine.
    append_new(spark.table(full.table(ACCEPTED)), store, ACCEPTED, [DAY])
    append_new(spark.table(full.table(QUARANTINE)).where("txn = ''"), store, QUARANTINE, [DAY])
    retry = classify_and_load(spark, store, [DAY], AT)[0]
    assert (retry.accepted_inserted_rows, retry.quarantine_inserted_rows) == (0, 2)
    assert retry.reconciled


def test_stored_surplus_fails_reconciliation(spark, store, landed):
    load_raw(spark, store, str(landed), [DAY], register(spark, landed), AT)
    classify_and_load(spark, store, [DAY], AT)
    extra = spark.table(store.table(ACCEPTED)).limit(1).withColumn("source_row_id", F.lit("other"))
    append_new(extra, store, ACCEPTED, [DAY])
    with pytest.raises(BatchError, match="stored raw 11, accepted 9"):
        classify_and_load(spark, store, [DAY], AT)


def test_bad_dates_do_not_sink_good_ones(spark, store, landed):
    known = register(spark, landed)
    (landed / f"transactions/business_date={NEXT}/sales_bkk_{NEXT:%Y%m%d}.csv.gz").rename(
        landed / f"transactions/business_date={NEXT}/extra.csv.gz")
    write_day(landed, LATER, {})  # not registered: checksum missing
    with pytest.raises(BatchError) as error:
        load_raw(spark, store, str(landed), [DAY, NEXT, LATER], known, AT)
    by_date = {r.batch_date: r for r in error.value.summary}
    assert by_date[DAY].status == "SUCCESS" and by_date[DAY].tx_inserted_rows == 11
    assert "MISSING bkk" in by_date[NEXT].error or "UNEXPECTED" in by_date[NEXT].error
    assert "MISSING_CHECKSUM" in by_date[LATER].error
    assert by_date[NEXT].tx_partition_rows == by_date[LATER].tx_partition_rows == 0


def test_altered_fx_leaves_transactions_stored(spark, store, landed):
    known = register(spark, landed)
    write_fx(landed, DAY, usd="33")
    summary = load_raw(spark, store, str(landed), [DAY], known, AT, on_error="return")[0]
    assert summary.tx_inserted_rows == 11 and "CHECKSUM_MISMATCH" in summary.error
    assert spark.table(store.table(RAW_FX_RATES)).count() == 0


def test_malformed_file_fails_its_own_date(spark, store, landed):
    write_gz(landed / f"transactions/business_date={NEXT}/sales_bkk_{NEXT:%Y%m%d}.csv.gz",
             f"txn,amount,dtts,currency\nT,1,{NEXT} 09:30:00,THB\n")
    known = register(spark, landed)
    runs = {r.batch_date: r for r in run_batches(
        spark, store, str(landed), [DAY, NEXT], known, "run-1", None, AT, on_error="return")}
    assert runs[DAY].status == "SUCCESS" and runs[DAY].raw_rows == 11
    assert runs[NEXT].status == "FAILED" and "cannot load" in runs[NEXT].error
    raw = spark.table(store.table(RAW_TRANSACTIONS)).select("batch_date").distinct().collect()
    assert [r.batch_date for r in raw] == [DAY]
    audit = {(r.batch_date, r.status): r.n for r in spark.table(store.table(FILE_AUDIT)).groupBy(
        "batch_date", "status").agg(F.count("*").alias("n")).collect()}
    assert audit == {(DAY, "LOADED"): 6, (NEXT, "NOT_LOADED"): 5}
    with pytest.raises(BatchError, match="cannot load"):
        load_raw(spark, store, str(landed), [NEXT], known, AT)


def test_files_are_parsed_once(spark, store, landed):
    write_gz(landed / f"transactions/business_date={LATER}/sales_bkk_{LATER:%Y%m%d}.csv.gz", "txn,dtts,amount,currency\nT,1\n")
    write_day(landed, LATER, {"bkk": [f"T,{LATER} 09:30:00,1,THB", "T,1", "T,1,2,3,4"], "south": []})
    calls = []
    original = pipeline.read_transactions

    def read(session, locations, *rest, **more):
        calls.append(len(locations))
        return original(session, locations, *rest, **more)

    pipeline.read_transactions = read
    try:
        summary = load_raw(spark, store, str(landed), [DAY, NEXT, LATER], register(spark, landed), AT, on_error="return")
    finally:
        pipeline.read_transactions = original
    assert calls == [15]  # one job for all dates, the bad one included
    assert [(r.status, r.tx_source_rows, r.tx_inserted_rows) for r in summary] == [
        ("SUCCESS", 11, 11), ("SUCCESS", 5, 5), ("FAILED", 0, 0)]
    assert "2 malformed rows in" in summary[2].error and "sales_bkk" in summary[2].error


def test_empty_file_fails_its_own_date(spark, store, landed):
    (landed / f"transactions/business_date={NEXT}/sales_bkk_{NEXT:%Y%m%d}.csv.gz").write_bytes(b"")
    summary = load_raw(spark, store, str(landed), [DAY, NEXT], register(spark, landed), AT, on_error="return")
    assert [(r.status, r.tx_inserted_rows) for r in summary] == [("SUCCESS", 11), ("FAILED", 0)]
    assert "header of" in summary[1].error


def test_file_that_is_no_gzip_fails_its_own_date(spark, store, landed):
    (landed / f"transactions/business_date={NEXT}/sales_bkk_{NEXT:%Y%m%d}.csv.gz").write_bytes(b"\x1f\x8bno gzip")
    summary = load_raw(spark, store, str(landed), [DAY, NEXT], register(spark, landed), AT, on_error="return")
    assert [(r.status, r.tx_inserted_rows) for r in summary] == [("SUCCESS", 11), ("FAILED", 0)]
    assert "cannot load" in summary[1].error


def test_stray_file_fails_the_date(spark, store, landed):
    write_gz(landed / f"transactions/business_date={DAY}/sub/EXTRA", "x")
    summary = load_raw(spark, store, str(landed), [DAY, NEXT], register(spark, landed), AT, on_error="return")
    assert "UNEXPECTED" in summary[0].error and summary[1].status == "SUCCESS"


def test_stored_rows_must_equal_the_files(spark, store, landed):
    known = register(spark, landed)
    load_raw(spark, store, str(landed), [DAY], known, AT)
    extra = spark.table(store.table(RAW_TRANSACTIONS)).limit(1).withColumn("source_row_id", F.lit("other"))
    append_new(extra, store, RAW_TRANSACTIONS, [DAY])
    summary = load_raw(spark, store, str(landed), [DAY], known, AT, on_error="return")[0]
    assert summary.tx_source_rows == 11 and summary.error == "transactions: source 11, stored 12"


def test_no_fx_publication_fails_the_date(spark, store, landed):
    before = date(2025, 7, 21)
    write_day(landed, before, {})
    load_raw(spark, store, str(landed), [before, DAY], register(spark, landed), AT)
    classify_and_load(spark, store, [before, DAY], AT)
    summary = {r.batch_date: r for r in build_fact(spark, store, [before, DAY], AT, on_error="return")}
    assert summary[before].error == "FX NO_PUBLICATION" and summary[before].fact_partition_rows == 0
    assert summary[DAY].status == "SUCCESS"


def test_run_batches_audits_and_publishes(spark, store, landed):
    known = register(spark, landed)
    manifest = spark.createDataFrame([(DAY, 11), (NEXT, 4)], "batch_date date, rows long")
    runs = {r.batch_date: r for r in run_batches(
        spark, store, str(landed), [DAY, NEXT], known, "run-1", manifest, AT, on_error="return")}
    assert runs[DAY].status == "SUCCESS" and runs[NEXT].status == "FAILED"
    assert "quality gate" in runs[NEXT].error
    transactions, daily = create_public_views(spark, store)
    assert {r.batch_date for r in spark.table(transactions).select("batch_date").distinct().collect()} == {DAY}
    assert [(r.batch_date, r.transactions) for r in spark.table(daily).collect()] == [(DAY, 8)]
    good = manifest.withColumn("rows", F.when(F.col("rows") == 4, 5).otherwise(F.col("rows")))
    later = AT.replace(hour=9)
    run_batches(spark, store, str(landed), [NEXT], known, "run-2", good, later)
    assert spark.table(daily).count() == 2
    assert spark.table(store.table(PIPELINE_RUNS)).count() == 3
    audit = spark.table(store.table(FILE_AUDIT)).where("run_id = 'run-1'")
    assert audit.where("status = 'LOADED'").count() == 11
    assert tuple(audit.agg(F.sum("loaded_rows"), F.sum("expected_rows")).first()) == (18, 18)


def test_failed_rerun_leaves_the_published_state(spark, store, landed):
    run_batches(spark, store, str(landed), [DAY, NEXT], register(spark, landed), "run-1", None, AT)
    transactions, daily = create_public_views(spark, store)
    before = sorted(map(tuple, spark.table(transactions).collect()), key=str)
    marts_before = {c.name: sorted(map(tuple, spark.table(store.table(c)).collect()), key=str) for c in MARTS}
    assert len(before) == 13 and len(marts_before["mart_data_quality"]) == 2
    # A later run of one date finds one row more, stores it, and fails at the gate.
    write_day(landed, NEXT, {"bkk": [f"bkk-1,{NEXT} 10:00:00,10.00,THB", f"bkk-2,{NEXT} 10:00:00,20.00,THB"]})
    known = register(spark, landed)
    bad = spark.createDataFrame([(NEXT, 99)], "batch_date date, rows long")
    failed = run_batches(spark, store, str(landed), [NEXT], known, "run-2", bad, AT, on_error="return")
    assert [r.status for r in failed] == ["FAILED"]
    assert sorted(map(tuple, spark.table(transactions).collect()), key=str) == before
    assert {c.name: sorted(map(tuple, spark.table(store.table(c)).collect()), key=str) for c in MARTS} == marts_before


def test_versions_move_with_changed_dates_only(spark, store, landed):
    run_batches(spark, store, str(landed), [DAY, NEXT], register(spark, landed), "run-1", None, AT)
    rows = spark.table(store.table(FACT))
    assert publish(rows, store, "run-2", 2, AT) == []
    more = rows.unionByName(rows.where(F.col("batch_date") == NEXT).limit(1).withColumn("source_row_id", F.lit("new")))
    assert publish(more, store, "run-3", 3, AT) == [NEXT]
    assert {(r.batch_date, r.version) for r in current_versions(spark.table(store.table(PUBLISHED_VERSIONS))).collect()} == {
        (DAY, 1), (NEXT, 3)}
    assert last_good(spark, store).count() == 14 and spark.table(store.table(PUBLISHED)).count() == 19
    expire_versions(spark, store, [NEXT])
    assert last_good(spark, store).count() == 14 == spark.table(store.table(PUBLISHED)).count()


def test_a_mart_of_one_date_rewrites_one_partition(spark, store, landed):
    run_batches(spark, store, str(landed), [DAY, NEXT], register(spark, landed), "run-1", None, AT)
    folder = Path(store.location) / "analytics" / "mart_daily_sales"
    files = {p: p.stat().st_mtime_ns for p in folder.glob("batch_date=*/*.parquet")}
    refresh_marts(spark, store, [NEXT])
    after = {p: p.stat().st_mtime_ns for p in folder.glob("batch_date=*/*.parquet")}
    same = {p for p in files if files[p] == after.get(p)}
    assert {p.parent.name for p in same} == {f"batch_date={DAY}"} and len(after) == len(files)
    _, daily = create_public_views(spark, store)
    plan = spark.table(daily)._jdf.queryExecution().executedPlan().toString()
    assert "fct_transactions" not in plan and "published_fact" not in plan
    assert {(r.batch_date, r.transactions) for r in spark.table(daily).collect()} == {(DAY, 8), (NEXT, 5)}


def test_later_run_decides_whatever_its_name(spark, store, landed):
    known = register(spark, landed)
    bad = spark.createDataFrame([(DAY, 1)], "batch_date date, rows long")
    run_batches(spark, store, str(landed), [DAY], known, "run-9", None, AT)
    run_batches(spark, store, str(landed), [DAY], known, "run-10", bad, AT, on_error="return")
    latest = latest_runs(spark.table(store.table(PIPELINE_RUNS))).first()
    assert (latest.run_id, latest.status) == ("run-10", "FAILED")
    left = [p for p in Path(spark.conf.get("spark.checkpoint.dir")).glob("*-*")
            if p.name.split("-")[0] in ("classified", "transactions", "fx", "staged")]
    assert left == []


def test_append_goes_by_name(spark, store, landed):
    load_raw(spark, store, str(landed), [DAY], register(spark, landed), AT)
    rows = spark.table(store.table(RAW_TRANSACTIONS))
    turned = rows.select(*reversed(rows.columns)).withColumn("source_row_id", F.concat("source_row_id", F.lit("x")))
    append_new(turned, store, RAW_TRANSACTIONS, [DAY])
    back = spark.table(store.table(RAW_TRANSACTIONS)).drop("source_row_id", "ingested_at")
    assert back.groupBy(*back.columns).count().where("count <> 2").isEmpty()


def test_columns_in_another_order_are_refused(spark, store):
    table = store.table(RAW_TRANSACTIONS)
    columns = [f"{c.name} {c.dataType}" + (" COMMENT 'required'" if c.description else "")
               for c in spark.catalog.listColumns(table)]
    columns[0], columns[1] = columns[1], columns[0]
    spark.sql(f"DROP TABLE {table}")
    spark.sql(f"CREATE TABLE {table} ({', '.join(columns)}) USING parquet "
              f"PARTITIONED BY (batch_date) LOCATION '{store.location}/turned'")
    with pytest.raises(ContractError, match="columns differ"):
        ensure_table(spark, store, RAW_TRANSACTIONS)


def test_stores_are_verified_not_altered(spark, store):
    assert set(ensure_store(spark, store).values()) == {"verified"}
    drifted = Store(store.prefix, store.location + "-elsewhere")
    with pytest.raises(ContractError, match="location"):
        ensure_namespace(spark, drifted, "raw")
    spark.sql(f"DROP TABLE {store.table(RAW_FX_RATES)}")
    assert ensure_table(spark, store, RAW_FX_RATES) == "created"
    table = store.table(FACT)
    spark.sql(f"DROP TABLE {table}")
    spark.sql(f"CREATE TABLE {table} (txn string, batch_date date) USING parquet "
              f"PARTITIONED BY (batch_date) LOCATION '{store.location}/other'")
    with pytest.raises(ContractError, match="columns differ"):
        ensure_table(spark, store, FACT)


def test_required_column_is_enforced(spark, store, landed):
    load_raw(spark, store, str(landed), [DAY], register(spark, landed), AT)
    broken = spark.table(store.table(RAW_TRANSACTIONS)).withColumn("region", F.lit(None).cast("string"))
    with pytest.raises(Exception, match="transactions.region is required"):
        append_new(broken.withColumn("batch_date", F.lit(LATER)), store, RAW_TRANSACTIONS, [LATER])
