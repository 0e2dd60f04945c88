"""Scans, row numbers, file checks, daily split, manifest and landing."""

import gzip
import hashlib
from datetime import date, timedelta

import pytest
from pyspark.sql import functions as F

from fixtures import AT, DAY, HEADER, register, write_day, write_fx, write_gz
from tillbridge.contracts import FX_HEADER, REGIONS, SOURCE_MANIFEST, TRANSACTION_HEADER
from tillbridge.errors import SourceError
from tillbridge.sinks.store import write_manifest
from tillbridge.sources import daily, files, landing, paths
from tillbridge.sources.scan import file_verdicts, instant, number_rows, read_transactions, scan_checked, scan_csv

NEXT = DAY + timedelta(1)


def test_scan_keeps_text(spark, tmp_path):
    body = (' T1 ,2025-07-22 09:30:00, 1.00 ,thb\n,,,\n\nNA,nan,null,None\n'
            '"q ""x"", y","a\nb",1,THB\n"",\'\',\\,"\\"\n')
    write_gz(tmp_path / "a.csv.gz", HEADER + body)
    rows = scan_csv(spark, str(tmp_path / "a.csv.gz"), TRANSACTION_HEADER).orderBy("source_row_number")
    got = [tuple(r)[:4] + (r.source_row_number,) for r in rows.collect()]
    assert got == [
        (" T1 ", "2025-07-22 09:30:00", " 1.00 ", "thb", 1), ("", "", "", "", 2),
        ("NA", "nan", "null", "None", 3), ('q "x", y', "a\nb", "1", "THB", 4), ("", "''", "\\", "\\", 5)]


@pytest.mark.parametrize("text", [
    "txn,dtts,currency,amount\nT,d,c,1\n", "txn,dtts,amount\nT,d,1\n", HEADER + "T,d,1\n", HEADER + "T,d,1,THB,x\n"])
def test_malformed_files_fail(spark, tmp_path, text):
    write_gz(tmp_path / "a.csv.gz", text)
    with pytest.raises(Exception):
        scan_csv(spark, str(tmp_path / "a.csv.gz"), TRANSACTION_HEADER).collect()


def test_row_numbers_over_many_files(spark, tmp_path):
    sizes = {f"f{n:02}": 1 + (n * 7919) % 3000 for n in range(30)} | {"empty": 0, "large": 25_000}
    for name, size in sizes.items():
        write_gz(tmp_path / f"{name}.csv.gz", HEADER + "".join(f"{i},d,1,THB\n" for i in range(1, size + 1)))
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "700")
    try:
        rows = scan_csv(spark, str(tmp_path), TRANSACTION_HEADER)
        assert rows.where("CAST(txn AS bigint) <> source_row_number").count() == 0
        assert rows.count() == sum(sizes.values())
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")


def test_row_numbers_need_no_shuffle(spark, tmp_path):
    write_gz(tmp_path / "a.csv.gz", HEADER + "T,d,1,THB\n")
    plan = scan_csv(spark, str(tmp_path), TRANSACTION_HEADER)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan


def test_row_identity_and_lineage(spark, tmp_path):
    write_day(tmp_path, DAY, {"bkk": ["A,x,1,THB", "B,y,2,THB"]})
    known = register(spark, tmp_path)
    rows = read_transactions(spark, f"{tmp_path}/transactions/*/*.gz", known, AT)
    row = rows.where("txn = 'B'").first()
    name = paths.transaction_file(DAY, "bkk")
    checksum = hashlib.sha256((tmp_path / name).read_bytes()).hexdigest()
    assert (row.region, row.batch_date, row.source_file, row.source_checksum) == ("bkk", DAY, name, checksum)
    assert row.source_row_id == hashlib.sha256(f"{name}|{checksum}|2".encode()).hexdigest()
    with pytest.raises(ValueError):
        instant(AT.replace(tzinfo=None))


def test_path_fields(spark):
    cases = {
        "transactions/business_date=2025-07-22/sales_bkk_20250722.csv.gz": (DAY, "bkk"),
        "transactions/business_date=2025-07-22/region=south/part-0.csv.gz": (DAY, "south"),
        "transactions/business_date=2025-07-22/sales_bkk_20250723.csv.gz": (DAY, None),
        "transactions/business_date=2025-07-22/sales_west_20250722.csv.gz": (DAY, None),
        "transactions/business_date=2025-13-22/sales_bkk_20251322.csv.gz": (None, None),
        "transactions/business_date=2025-07-22/sales_bkk_20250722.csv": (DAY, None),
    }
    name = F.col("n")
    got = spark.createDataFrame([(c,) for c in cases], "n string").select(
        "n", paths.day_of(name).alias("d"), paths.region_of(name).alias("r"))
    assert {r.n: (r.d, r.r) for r in got.collect()} == cases
    fx = {"fx/2025/07/fx_20250722.csv": DAY, "fx/2025/08/fx_20250722.csv": None, "fx/2025/07/fx_x.csv": None}
    got = spark.createDataFrame([(c,) for c in fx], "n string").select("n", paths.fx_day_of(name).alias("d"))
    assert {r.n: r.d for r in got.collect()} == fx
    assert paths.fx_file(DAY) == "fx/2025/07/fx_20250722.csv"


def completeness(spark, names):
    frame = spark.createDataFrame([(n,) for n in names], "source_file string")
    dates = files.date_frame(spark, [DAY])
    return sorted((r.problem, r.region or r.source_file) for r in files.completeness(dates, frame).collect())


def test_completeness(spark):
    full = [paths.transaction_file(DAY, r) for r in REGIONS]
    assert completeness(spark, full) == []
    assert completeness(spark, full[1:]) == [("MISSING", "bkk")]
    assert completeness(spark, full + full[:1]) == [("DUPLICATE", "bkk")]
    extra = f"{paths.transaction_folder(DAY)}/notes.csv.gz"
    assert completeness(spark, full + [extra]) == [("UNEXPECTED", extra)]
    parts = [f"{paths.transaction_folder(DAY)}/region=bkk/part-{n}.csv.gz" for n in range(2)]
    assert completeness(spark, full[1:] + parts) == []
    assert completeness(spark, full + parts) == [("DUPLICATE", "bkk")]


def test_checksums(spark, tmp_path):
    write_day(tmp_path, DAY, {"bkk": [f"T{n},{DAY} 10:00:00,1,THB" for n in range(5000)]})
    known = register(spark, tmp_path)
    pattern = f"{tmp_path}/transactions/*/*.csv.gz"
    hashed = files.file_hashes(spark, pattern, f"{tmp_path}/nowhere/*").withColumn(
        "source_file", paths.source_name(F.col("path")))
    done = files.verify_checksums(hashed, known)
    assert done.count() == 5 and done.where("problem is not null").count() == 0
    wrong = known.withColumn("source_checksum", F.when(F.col("source_file").contains("north_"), "0")
                             .when(F.col("source_file").contains("south"), "").otherwise(F.col("source_checksum")))
    done = {r.source_file.split("_")[-2]: r.problem for r in files.verify_checksums(
        hashed, wrong.where("source_file not like '%bkk%'")).collect()}
    assert done == {"bkk": "MISSING_CHECKSUM", "south": "MISSING_CHECKSUM", "north": "CHECKSUM_MISMATCH",
                    "central": None, "northeast": None}


def test_long_files_are_streamed(spark, tmp_path):
    texts = {f"f {n}%20.bin": bytes([n % 256]) * n for n in (1, 99, 100, 101, 5000)}
    for name, text in texts.items():
        (tmp_path / name).write_bytes(text)
    found = files.file_hashes(spark, f"{tmp_path}/*.bin", streamed_bytes=100).collect()
    assert {(r.path.rsplit("/", 1)[1], r.length, r.sha256) for r in found} == {
        (name, len(text), hashlib.sha256(text).hexdigest()) for name, text in texts.items()}


def test_a_file_above_two_gibibytes(spark, tmp_path):
    path = tmp_path / "large.bin"
    with path.open("wb") as out:  # takes no room on disk
        out.truncate((1 << 31) + 5)
    digest, zeros = hashlib.sha256(), bytes(1 << 20)
    for _ in range(1 << 11):
        digest.update(zeros)
    digest.update(bytes(5))
    assert [(r.length, r.sha256) for r in files.file_hashes(spark, str(path)).collect()] == [((1 << 31) + 5, digest.hexdigest())]


def test_one_pass_judges_files(spark, tmp_path):
    texts = {
        "good": 'txn,dtts,amount,currency\n a ,"b\nc",,"q ""x"""\n,,,\n', "only-header": "txn,dtts,amount,currency\n",
        "turned": "txn,amount,dtts,currency\n1,2,3,4\n", "no-header": "1,2,3,4\n5,6,7,8\n", "empty": "",
        "short": "txn,dtts,amount,currency\n1,2,3\n1,2,3,4\n", "long": "txn,dtts,amount,currency\n1,2,3,4,5\n",
        "long-header": "txn,dtts,amount,currency,more\n1,2,3,4\n"}
    for name, text in texts.items():
        write_gz(tmp_path / f"{name}.csv.gz", text)
    rows = scan_checked(spark, str(tmp_path), TRANSACTION_HEADER).withColumn("name", F.regexp_extract("path", r"([a-z-]+)\.csv", 1))
    verdicts = {r.name: (r.rows, r.malformed_rows, r.header_ok) for r in file_verdicts(rows, "name").collect()}
    assert verdicts == {
        "good": (2, 0, True), "only-header": (0, 0, True), "turned": (1, 0, False), "no-header": (1, 0, False),
        "short": (2, 1, True), "long": (1, 1, True), "long-header": (1, 0, False)}
    good = rows.where("name = 'good' and source_row_number > 0").orderBy("source_row_number")
    assert [tuple(r) for r in good.select("source_row_number", *TRANSACTION_HEADER.names).collect()] == [
        (1, " a ", "b\nc", "", 'q "x"'), (2, "", "", "", "")]


def test_discovery_sees_every_name(spark, tmp_path):
    write_day(tmp_path, DAY, {})
    folder = tmp_path / paths.transaction_folder(DAY)
    for name in ("EXTRA", "_hidden.csv.gz", "sub/sales_bkk_20250722.csv.gz"):
        write_gz(folder / name, HEADER)
    found = files.discover_transactions(spark, str(tmp_path), [DAY, NEXT])
    assert found.count() == 8
    problems = files.completeness(files.date_frame(spark, [DAY]), found).collect()
    assert sorted((r.problem, r.source_file.split("/", 2)[2]) for r in problems) == [
        ("UNEXPECTED", "EXTRA"), ("UNEXPECTED", "_hidden.csv.gz"), ("UNEXPECTED", "sub/sales_bkk_20250722.csv.gz")]


def test_many_dates_are_one_scan(spark, tmp_path):
    days = [DAY + timedelta(days=n) for n in range(20)]
    for day in days:
        write_day(tmp_path, day, {})
    listed = files.discover_transactions(spark, str(tmp_path), days)
    hashed = files.file_hashes(spark, *[r.path for r in listed.collect()])
    plan = hashed._jdf.queryExecution().executedPlan().toString()
    assert hashed.count() == 100 and plan.count("FileScan") == 2  # of the contents, and of the lengths
    assert plan.count("ReadSchema: struct<path:string,length:bigint,content:binary>") == 1


def test_missing_folder_lists_nothing(spark, tmp_path):
    assert files.list_files(spark, f"{tmp_path}/nowhere/*.csv").count() == 0
    assert files.discover_fx(spark, str(tmp_path), [DAY]).count() == 0


def test_split_to_daily(spark, tmp_path):
    write_gz(tmp_path / "in/2025/sales_bkk_202507.csv.gz", HEADER + "".join(
        f"T{n},2025-07-{22 + n % 3} 10:00:00,{'N/A' if n == 4 else n},\" t,b \"\n" for n in range(9)))
    write_gz(tmp_path / "in/2025/sales_south_202507.csv.gz", HEADER + "S,2025-07-22 11:00:00,,THB\n")
    out = tmp_path / "out/transactions"
    done = daily.split_to_daily(spark, str(tmp_path / "in"), str(out)).first()
    assert tuple(done) == (2, 4, 10, 3)
    rows = scan_csv(spark, f"{out}/*/*.csv.gz", TRANSACTION_HEADER).withColumn("name", paths.source_name(F.col("path")))
    got = rows.select("txn", "amount", "currency", "source_row_number", paths.region_of(F.col("name")).alias("r"),
                      paths.day_of(F.col("name")).alias("d")).orderBy("r", "d", "source_row_number").collect()
    assert [r.txn for r in got] == ["T0", "T3", "T6", "T1", "T4", "T7", "T2", "T5", "T8", "S"]
    assert (got[4].amount, got[4].currency, got[4].d) == ("N/A", " t,b ", NEXT)
    assert got[-1].amount == ""
    assert sorted(p.name for p in out.iterdir()) == [f"business_date=2025-07-{d}" for d in (22, 23, 24)]
    with gzip.open(out / "business_date=2025-07-22/sales_south_20250722.csv.gz", "rt") as f:
        assert f.readline() == HEADER
    with pytest.raises(SourceError, match="cannot write"):
        daily.split_to_daily(spark, str(tmp_path / "in"), str(out))


def test_split_validate_manifest_and_land(spark, tmp_path):
    for region in REGIONS:
        write_gz(tmp_path / f"in/sales_{region}_202507.csv.gz", HEADER + "".join(
            f"{region}{n},2025-07-{22 + n % 2} 10:00:00,{n},THB\n" for n in range(5)))
    root = tmp_path / "data/daily_regional_sales"
    daily.split_to_daily(spark, str(tmp_path / "in"), str(root))
    assert daily.validate_daily(spark, str(root)).count() == 0
    manifest = daily.source_manifest(spark, str(root))
    daily.enforce_corpus(manifest, (2, 10, 25, "2025-07-22", "2025-07-23"))
    write_manifest(manifest, str(tmp_path / "m"))
    (tmp_path / "data/daily_source_manifest.csv").write_bytes(next((tmp_path / "m").glob("*.csv")).read_bytes())
    write_fx(tmp_path / "fx/fx_daily", DAY)
    (tmp_path / "fx/fx_daily/fx").rename(tmp_path / "fx/x")
    (tmp_path / "fx/x/2025").rename(tmp_path / "fx/fx_daily/2025")
    (tmp_path / "fx/manifest.csv").write_text("x")
    local = landing.landing_inventory(spark, str(tmp_path))
    assert local.where("kind = 'transaction'").count() == 10
    landed = local.select("object_name", "sha256").where("kind <> 'fx'")
    assert {r.action: r.files for r in landing.landing_summary(landing.landing_decision(local, landed)).collect()} == {
        "SKIP": 12, "UPLOAD": 1}


@pytest.mark.parametrize("name, line", [
    ("sales_bkk_202507", "T,nonsense,1,THB"), ("sales_bkk_202507", "T,2025-07-22 10:00:60,1,THB"),
    ("sales_west_202507", "T,2025-07-22 10:00:00,1,THB")])
def test_split_rejects(spark, tmp_path, name, line):
    write_gz(tmp_path / f"in/{name}.csv.gz", HEADER + line + "\n")
    with pytest.raises(Exception, match="invalid dtts|unsupported source file"):
        daily.split_to_daily(spark, str(tmp_path / "in"), str(tmp_path / "out"))


def corpus(tmp_path):
    write_day(tmp_path, DAY, {"bkk": [f"A,{DAY} 10:00:00,1,THB", f"B,{DAY} 09:00:00,1,THB"]})
    write_day(tmp_path, NEXT, {})
    return tmp_path / "transactions"


def test_manifest_and_corpus(spark, tmp_path):
    root = corpus(tmp_path)
    assert daily.validate_daily(spark, str(root)).count() == 0
    manifest = daily.source_manifest(spark, str(root))
    rows = manifest.collect()
    assert manifest.columns == SOURCE_MANIFEST.names
    assert [(r.business_date, r.region) for r in rows] == [(str(d), r) for d in (DAY, NEXT) for r in REGIONS]
    first = rows[0]
    data = (root / first.file_path).read_bytes()
    assert (first.rows, first.min_dtts, first.max_dtts, first.compressed_bytes, first.sha256) == (
        2, f"{DAY} 09:00:00", f"{DAY} 10:00:00", len(data), hashlib.sha256(data).hexdigest())
    daily.enforce_corpus(manifest, (2, 10, 11, str(DAY), str(NEXT)))
    with pytest.raises(SourceError, match="expected"):
        daily.enforce_corpus(manifest)
    write_manifest(manifest, str(tmp_path / "manifest"))
    lines = next((tmp_path / "manifest").glob("*.csv")).read_text().splitlines()
    assert lines[0] == ",".join(SOURCE_MANIFEST.names) and len(lines) == 11
    assert lines[1].startswith(f"{DAY},bkk,business_date={DAY}/sales_bkk_")


def test_violations(spark, tmp_path):
    root = corpus(tmp_path)
    write_gz(root / f"business_date={DAY}/sales_bkk_{DAY:%Y%m%d}.csv.gz",
             HEADER + f"A,{NEXT} 10:00:00,1,THB\nB,x,1,THB\nC,{DAY} 10:00:00,1,THB\n")
    source = root / f"business_date={NEXT}/sales_south_{NEXT:%Y%m%d}.csv.gz"
    source.rename(root / f"business_date={NEXT}/sales_west_{NEXT:%Y%m%d}.csv.gz")
    got = sorted((r.rule, r.detail) for r in daily.validate_daily(spark, str(root)).collect())
    assert got == [("BAD_FILE_NAME", None), ("INVALID_DTTS", "x"), ("MISSING_REGION", "south"),
                   ("WRONG_DATE", f"{NEXT} 10:00:00")]
    with pytest.raises(SourceError):
        daily.validate_daily(spark, str(tmp_path / "nowhere"))


def test_landing(spark, tmp_path):
    name = f"business_date={DAY}/sales_bkk_{DAY:%Y%m%d}.csv.gz"
    write_gz(tmp_path / "data/daily_regional_sales" / name, HEADER)
    write_gz(tmp_path / "data/daily_regional_sales" / name.replace("bkk", "south"), HEADER)
    for n, p in enumerate(["fx/fx_daily/2025/07/fx_20250722.csv", "fx/fx_daily/2025/07/fx_20250723.csv",
                           "fx/manifest.csv", "data/daily_source_manifest.csv"]):
        (tmp_path / p).parent.mkdir(parents=True, exist_ok=True)
        (tmp_path / p).write_text(str(n))
    local = landing.landing_inventory(spark, str(tmp_path))
    names = [r.object_name for r in local.collect()]
    assert names == ["fx/2025/07/fx_20250722.csv", "fx/2025/07/fx_20250723.csv",
                     "manifests/daily_source_manifest.csv", "manifests/fx_manifest.csv",
                     f"transactions/{name}", f"transactions/{name.replace('bkk', 'south')}"]
    assert [r.object_name for r in landing.smoke_subset(local).collect()] == [names[0], *names[2:5]]

    landed = spark.createDataFrame([
        (names[0], local.first().sha256), (names[1], "other"), (names[2], None), (names[3], "")],
        "object_name string, sha256 string")
    decided = {r.object_name: r.action for r in landing.landing_decision(local, landed).collect()}
    assert decided == {names[0]: "SKIP", names[1]: "CONFLICT_CHECKSUM", names[2]: "CONFLICT_NO_CHECKSUM",
                       names[3]: "CONFLICT_NO_CHECKSUM", names[4]: "UPLOAD", names[5]: "UPLOAD"}
    counts = {r.action: r.files for r in landing.landing_summary(landing.landing_decision(local, landed)).collect()}
    assert counts == {"SKIP": 1, "CONFLICT_CHECKSUM": 1, "CONFLICT_NO_CHECKSUM": 2, "UPLOAD": 2}
    write_gz(tmp_path / f"data/daily_regional_sales/business_date={DAY}/odd.csv.gz", HEADER)
    with pytest.raises(Exception, match="unsupported source path"):
        landing.landing_inventory(spark, str(tmp_path)).collect()


def test_landing_needs_every_kind(spark, tmp_path):
    with pytest.raises(SourceError, match="nothing to land"):
        landing.landing_inventory(spark, str(tmp_path))


def test_fx_files(spark, tmp_path):
    write_fx(tmp_path, DAY)
    found = files.discover_fx(spark, str(tmp_path), [DAY, NEXT])
    assert [(r.batch_date, r.source_file) for r in found.collect()] == [(DAY, paths.fx_file(DAY))]
    status = files.fx_status(files.date_frame(spark, [DAY, NEXT]), found)
    assert {r.batch_date: r.fx_status for r in status.collect()} == {DAY: "LOADED", NEXT: "NO_NEW_RATE"}
    assert scan_csv(spark, f"{tmp_path}/{paths.fx_file(DAY)}", FX_HEADER).count() == 2
