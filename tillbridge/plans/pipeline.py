"""The batch jobs: load raw files, classify, build the fact - for any set of dates.

Each job judges its dates one by one: a date that fails a check is left out of the
append and reported, the others complete. Only per-date and per-file values reach the
driver. Every write is an idempotent append, so a job that lost its driver half-way is
simply run again.
"""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass, field
from datetime import date, datetime, timezone

from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, Row, SparkSession, functions as F

from tillbridge.contracts import (
    ACCEPTED, FACT, FILE_AUDIT, PIPELINE_RUNS, QUARANTINE, RAW_FX_RATES, RAW_TRANSACTIONS, REGIONS,
)
from tillbridge.errors import BatchError
from tillbridge.operators.classification import HOT_ROWS, accepted_rows, classify, quarantine_rows
from tillbridge.operators.conversion import accepted_violations, fact_rows
from tillbridge.operators.fx import publications, resolve_effective_fx, snapshots
from tillbridge.operators.reconcile import full_chain, id_differences
from tillbridge.plans.marts import refresh_marts
from tillbridge.plans.publication import SUCCESS, publish
from tillbridge.session import stored
from tillbridge.sinks.store import (
    Store, append, append_new, broadcast_if_small, partition_counts, read_partitions,
    read_through, scalar,
)
from tillbridge.sources import files as sources
from tillbridge.sources import paths
from tillbridge.sources.scan import file_verdicts, read_fx, read_transactions

FAILED = "FAILED"
EMPTY = "EMPTY"
_COUNTED = "source_file string, source_checksum string, batch_date date, rows long"


@dataclass
class _Dates:
    """Requested dates and what is wrong with some of them."""

    requested: list[date]
    errors: dict[date, str] = field(default_factory=dict)

    @classmethod
    def of(cls, dates: Iterable[date]) -> _Dates:
        requested = sorted(set(dates))
        if not requested:
            raise ValueError("no business dates given")
        return cls(requested)

    @property
    def good(self) -> list[date]:
        return [d for d in self.requested if d not in self.errors]

    def fail(self, day: date, error: str) -> None:
        self.errors.setdefault(day, error)

    def finish(self, job: str, summary: list[Row], on_error: str) -> list[Row]:
        if self.errors and on_error == "raise":
            detail = "; ".join(f"{d}: {e}" for d, e in sorted(self.errors.items()))
            raise BatchError(f"{job} failed for {len(self.errors)} date(s): {detail}", summary)
        return summary


def _now(at: datetime | None) -> datetime:
    at = at or datetime.now(timezone.utc)
    if at.tzinfo is None:
        raise ValueError("the instant must carry a time zone")
    return at


def _fail_by_file(days: _Dates, problems: DataFrame) -> None:
    """One message per date, however many of its files have a problem."""
    per_date = problems.groupBy("batch_date").agg(
        F.count("*").alias("n"),
        F.min(F.concat_ws(" ", "problem", F.coalesce("source_file", "region"))).alias("first"))
    for row in per_date.collect():
        days.fail(row.batch_date, row.first if row.n == 1 else f"{row.first} and {row.n - 1} more")


def _hashed(spark, files: DataFrame, registered: DataFrame) -> DataFrame:
    """Hash the listed files and compare; one row per file. At most a few files per date
    pass the checks before, so their paths are few. Spark's scans leave out empty files, so those
    are hashed from the listing."""
    locations = [r.path for r in files.select("path").collect()]
    empty = files.where("length = 0").select("path", "length", F.sha2(F.lit("").cast("binary"), 256).alias("sha256"))
    hashed = sources.file_hashes(spark, *locations).unionByName(empty).withColumn(
        "source_file", paths.source_name(F.col("path")))
    return sources.verify_checksums(hashed, registered)


def _cause(error: Exception) -> str:
    lines = [line.strip() for line in str(error).splitlines() if line.strip()]
    causes = [line for line in lines if line.startswith("Caused by:")]
    return " ".join((causes or lines or [type(error).__name__])[0].split())[:300]


def _load_dates(spark, store, contract, read, verified: DataFrame, days: _Dates, dates):
    """Parse the verified files of the dates once, into a staged table; judge each file by what is
    staged, and append the rows of the dates whose files are all well-formed.

    Inserted rows per date, and one row per file: ``source_file``, ``source_checksum``, ``batch_date``,
    ``rows``.
    """
    day = contract.partition_column
    wanted = verified.where(F.col("batch_date").isin(dates))
    locations = [r.path for r in wanted.select("path").toLocalIterator()]
    known = broadcast_if_small(wanted.select("source_file", "source_checksum"))
    with stored({"staged": read(spark, locations, known)}, [day]) as kept:
        staged = kept["staged"]
        judged = wanted.select("source_file", "source_checksum", "batch_date").join(
            file_verdicts(staged, "source_file"), "source_file", "left").fillna(0, ["rows"]).collect()
        for r in sorted(judged, key=lambda r: r.source_file):
            if not r.header_ok:
                days.fail(r.batch_date, f"cannot load: header of {r.source_file} differs or is missing")
            elif r.malformed_rows:
                days.fail(r.batch_date, f"cannot load: {r.malformed_rows} malformed rows in {r.source_file}")
        good = [d for d in dates if d in days.good]
        rows = staged.where(F.col(day).isin(good) & (F.col("source_row_number") > 0)).drop("malformed")
        inserted = append_new(rows, store, contract, good) if good else {}
    return inserted, [(r.source_file, r.source_checksum, r.batch_date, r.rows) for r in judged]


def _load_files(spark, store, contract, read, verified: DataFrame, days: _Dates, dates):
    """:func:`_load_dates` for all dates together. Only a file that cannot be read at all, such as one
    that is no gzip file, fails that job; then each date is loaded by itself, and its own date fails."""
    try:
        return _load_dates(spark, store, contract, read, verified, days, dates)
    except (PySparkException, Py4JJavaError):
        inserted, counted = {}, []
        for d in dates:
            try:
                done, files = _load_dates(spark, store, contract, read, verified, days, [d])
            except (PySparkException, Py4JJavaError) as error:
                days.fail(d, f"cannot load: {_cause(error)}")
            else:
                inserted.update(done)
                counted += files
        return inserted, counted


def _check_counts(spark, store, contract, days: _Dates, files: list[tuple], dates) -> dict[date, int]:
    """Source rows per date; a date whose stored rows of these files differ in number fails."""
    day = contract.partition_column
    expected = {}
    for _, _, d, rows in files:
        expected[d] = expected.get(d, 0) + rows
    counted = spark.createDataFrame(files, _COUNTED)
    stored = {d: n for d, n in read_partitions(
        spark, store, contract, dates, [day, "source_file", "source_checksum"],
    ).join(broadcast_if_small(counted.select("source_file", "source_checksum")),
           ["source_file", "source_checksum"], "left_semi").groupBy(day).agg(F.count("*")).collect()}
    for d in dates:
        if expected.get(d, 0) != stored.get(d, 0):
            days.fail(d, f"{contract.name}: source {expected.get(d, 0)}, stored {stored.get(d, 0)}")
    return {d: expected.get(d, 0) for d in dates}


def load_raw(spark: SparkSession, store: Store, root: str, dates: Iterable[date],
             registered: DataFrame, ingested_at: datetime | None = None,
             on_error: str = "raise") -> list[Row]:
    """Load the five regional files and the optional FX file of each date, unchanged.

    ``registered`` holds ``source_file`` and ``source_checksum`` of everything landed.
    Transactions are appended before FX files are looked at. A date whose files are
    incomplete, altered or malformed, or whose stored rows differ in number from those in
    the files, fails by itself.
    """
    days = _Dates.of(dates)
    summary, _ = _load_raw(spark, store, root, days, registered, _now(ingested_at))
    return days.finish("raw load", summary, on_error)


def _load_raw(spark, store, root, days: _Dates, registered, at) -> tuple[list[Row], list[tuple]]:
    """Summary rows, and the counted source files."""
    found = sources.discover_transactions(spark, root, days.requested)
    _fail_by_file(days, sources.completeness(sources.date_frame(spark, days.requested), found))
    tx_source, tx_inserted, counted = {}, {}, []
    if days.good:
        listed = found.where(paths.day_of(F.col("source_file")).isin(days.good))
        checked = _hashed(spark, listed, registered).withColumn(
            "batch_date", paths.day_of(F.col("source_file")))
        with stored({"transactions": checked}) as kept:
            verified = kept["transactions"]
            _fail_by_file(days, verified.where("problem is not null").withColumn("region", F.lit("")))
            if days.good:
                tx_inserted, files = _load_files(
                    spark, store, RAW_TRANSACTIONS,
                    lambda s, where, known: read_transactions(s, where, known, at, checked=True),
                    verified, days, days.good)
                counted += files
                if days.good:
                    tx_source = _check_counts(spark, store, RAW_TRANSACTIONS, days, files, days.good)
    tx_stored = partition_counts(spark, store, RAW_TRANSACTIONS, days.requested)

    fx_source, fx_inserted, fx_state = {}, {}, {}
    if days.good:
        fx_found = sources.discover_fx(spark, root, days.good)
        state = sources.fx_status(sources.date_frame(spark, days.good), fx_found)
        fx_state = {r.batch_date: r.fx_status for r in state.collect()}
        published = [d for d in days.good if fx_state[d] == "LOADED"]
        if published:
            checked = _hashed(spark, fx_found, registered).withColumn(
                "batch_date", paths.fx_day_of(F.col("source_file")))
            with stored({"fx": checked}) as kept:
                verified = kept["fx"]
                _fail_by_file(days, verified.where("problem is not null").withColumn("region", F.lit("")))
                published = [d for d in published if d in days.good]
                if published:
                    fx_inserted, files = _load_files(
                        spark, store, RAW_FX_RATES,
                        lambda s, where, known: read_fx(s, where, known, at, checked=True),
                        verified, days, published)
                    counted += files
                    published = [d for d in published if d in days.good]
                    if published:
                        fx_source = _check_counts(spark, store, RAW_FX_RATES, days, files, published)
    fx_stored = partition_counts(spark, store, RAW_FX_RATES, days.requested)

    summary = [
        Row(batch_date=d, status=FAILED if d in days.errors else SUCCESS,
            tx_files=len(REGIONS) if d in tx_source else 0,
            tx_source_rows=tx_source.get(d, 0), tx_inserted_rows=tx_inserted.get(d, 0),
            tx_partition_rows=tx_stored[d], fx_status=fx_state.get(d),
            fx_source_rows=fx_source.get(d, 0), fx_inserted_rows=fx_inserted.get(d, 0),
            fx_partition_rows=fx_stored[d], error=days.errors.get(d))
        for d in days.requested]
    return summary, counted


def classify_and_load(spark: SparkSession, store: Store, dates: Iterable[date],
                      classified_at: datetime | None = None, hot_rows: int = HOT_ROWS,
                      on_error: str = "raise") -> list[Row]:
    """Classify the stored raw rows of each date and append both outcomes.

    The classified rows are stored once in the shared folder, split by outcome; the two
    appends and the counts read that, each only its half.
    """
    at = _now(classified_at)
    days = _Dates.of(dates)
    raw_counts = partition_counts(spark, store, RAW_TRANSACTIONS, days.requested)
    raw = read_partitions(spark, store, RAW_TRANSACTIONS, days.requested)
    with stored({"classified": classify(raw, hot_rows)}, ["accepted"]) as kept:
        return _load_classified(spark, store, days, kept["classified"], raw_counts, at, on_error)


def _load_classified(spark, store, days: _Dates, classified: DataFrame, raw_counts, at, on_error) -> list[Row]:
    made = {(r.batch_date, r.accepted): r.n for r in classified.groupBy("batch_date", "accepted").agg(
        F.count("*").alias("n")).collect()}
    for d in days.requested:
        total = made.get((d, True), 0) + made.get((d, False), 0)
        if total != raw_counts[d]:
            days.fail(d, f"raw {raw_counts[d]}, classified {total}")

    accepted_new, quarantine_new = {}, {}
    if days.good:
        accepted_new = append_new(
            accepted_rows(classified, at), store, ACCEPTED, days.good, spread=True)
        quarantine_new = append_new(
            quarantine_rows(classified, at), store, QUARANTINE, days.good, spread=True)
    accepted = partition_counts(spark, store, ACCEPTED, days.requested)
    quarantine = partition_counts(spark, store, QUARANTINE, days.requested)
    for d in days.requested:
        if raw_counts[d] != accepted[d] + quarantine[d]:
            days.fail(d, f"stored raw {raw_counts[d]}, accepted {accepted[d]}, quarantine {quarantine[d]}")

    summary = [
        Row(batch_date=d,
            status=FAILED if d in days.errors else SUCCESS if raw_counts[d] else EMPTY,
            raw_rows=raw_counts[d], accepted_rows=made.get((d, True), 0),
            quarantine_rows=made.get((d, False), 0),
            accepted_inserted_rows=accepted_new.get(d, 0),
            quarantine_inserted_rows=quarantine_new.get(d, 0),
            accepted_partition_rows=accepted[d], quarantine_partition_rows=quarantine[d],
            reconciled=raw_counts[d] == accepted[d] + quarantine[d], error=days.errors.get(d))
        for d in days.requested]
    return days.finish("classification", summary, on_error)


def build_fact(spark: SparkSession, store: Store, dates: Iterable[date],
               created_at: datetime | None = None, on_error: str = "raise") -> list[Row]:
    """Resolve the effective FX of each date, convert its accepted rows, append the fact."""
    at = _now(created_at)
    days = _Dates.of(dates)
    accepted = read_partitions(spark, store, ACCEPTED, days.requested)
    history = read_through(spark, store, RAW_FX_RATES, days.requested[-1])
    effective = snapshots(resolve_effective_fx(
        sources.date_frame(spark, days.requested), publications(history)))
    fx = {r.batch_date: r for r in effective.collect()}
    for d in days.requested:
        if fx[d].fx_status != "OK":
            days.fail(d, f"FX {fx[d].fx_status}")

    if days.good:
        target = F.col("batch_date").isin(days.good)
        for row in accepted_violations(accepted.where(target), effective.where(target)).collect():
            broken = {k: v for k, v in row.asDict().items() if k != "batch_date" and v}
            if broken:
                days.fail(row.batch_date, f"accepted rows break the contract: {broken}")
    inserted = {}
    if days.good:
        target = F.col("batch_date").isin(days.good)
        fact = fact_rows(accepted.where(target), effective.where(target), at)
        inserted = append_new(fact, store, FACT, days.good)

    accepted_stored = partition_counts(spark, store, ACCEPTED, days.requested)
    fact_stored = partition_counts(spark, store, FACT, days.requested)
    for d in days.good:
        if accepted_stored[d] != fact_stored[d]:
            days.fail(d, f"stored accepted {accepted_stored[d]}, fact {fact_stored[d]}")
    if days.good:
        keys = ["batch_date", "source_row_id"]
        differing = id_differences(
            read_partitions(spark, store, ACCEPTED, days.good, keys),
            read_partitions(spark, store, FACT, days.good, keys),
        ).groupBy("batch_date").agg(F.count("*").alias("n"))
        for row in differing.collect():
            days.fail(row.batch_date, f"{row.n} row ids differ between accepted and fact")

    summary = [
        Row(batch_date=d,
            status=FAILED if d in days.errors else SUCCESS if accepted_stored[d] else EMPTY,
            accepted_rows=accepted_stored[d], fx_rate_date=fx[d].fx_rate_date,
            is_carried_forward=fx[d].is_carried_forward, staleness_days=fx[d].staleness_days,
            fact_rows=0 if d in days.errors else accepted_stored[d],
            fact_inserted_rows=inserted.get(d, 0),
            accepted_partition_rows=accepted_stored[d], fact_partition_rows=fact_stored[d],
            reconciled=accepted_stored[d] == fact_stored[d], error=days.errors.get(d))
        for d in days.requested]
    return days.finish("currency fact", summary, on_error)


def run_batches(spark: SparkSession, store: Store, root: str, dates: Iterable[date],
                registered: DataFrame, run_id: str, manifest: DataFrame | None = None,
                at: datetime | None = None, on_error: str = "raise") -> list[Row]:
    """All three jobs, the full-chain gate, and the audit rows that publication reads.

    ``manifest`` has ``batch_date`` and ``rows`` per source file. Without one, the rows
    counted in the files themselves stand in for it. Audit rows are written whatever fails.
    """
    started = _now(at)
    days = _Dates.of(dates)
    counts = {}
    runs_table = spark.table(store.table(PIPELINE_RUNS))
    sequence = scalar(runs_table.agg(F.coalesce(F.max("run_sequence"), F.lit(0)))) + 1

    def step(rows: list[Row]) -> None:
        for r in rows:
            counts.setdefault(r.batch_date, {}).update(r.asDict())
            if r.error:
                days.fail(r.batch_date, r.error)

    summary, counted = _load_raw(spark, store, root, days, registered, started)
    files = spark.createDataFrame(counted, _COUNTED)
    step(summary)
    if days.good:
        step(classify_and_load(spark, store, days.good, at, on_error="return"))
    if days.good:
        step(build_fact(spark, store, days.good, at, on_error="return"))
    if days.good:
        raw = read_partitions(spark, store, RAW_TRANSACTIONS, days.good, ["batch_date", "source_row_id"])
        expected = (files.where(paths.day_of(F.col("source_file")).isNotNull()) if manifest is None
                    else manifest).where(F.col("batch_date").isin(days.good))
        gate = full_chain(
            expected, raw,
            read_partitions(spark, store, ACCEPTED, days.good, ["batch_date"]),
            read_partitions(spark, store, QUARANTINE, days.good, ["batch_date"]),
            read_partitions(spark, store, FACT, days.good,
                            ["batch_date", "amount_thb", "amount_usd", "amount_eur", "fx_rate_date"]))
        for row in gate.where("not quality_gate").collect():
            days.fail(row.batch_date, f"quality gate: {row.asDict()}")

    done = [d for d in days.good if counts.get(d, {}).get("raw_rows")]
    if done:
        try:
            refresh_marts(spark, store, done)
            publish(read_partitions(spark, store, FACT, done), store, run_id, sequence, started)
        except (PySparkException, Py4JJavaError) as error:
            for d in done:
                days.fail(d, f"cannot publish: {_cause(error)}")
    _audit_files(spark, store, root, days, registered, files, run_id)
    ended = datetime.now(timezone.utc) if at is None else at
    runs = []
    for d in days.requested:
        c = counts.get(d, {})
        status = FAILED if d in days.errors else SUCCESS if c.get("raw_rows") else EMPTY
        runs.append((run_id, sequence, d, status, c.get("raw_rows"), c.get("accepted_rows"),
                     c.get("quarantine_rows"), c.get("fact_rows"), started, ended,
                     int((ended - started).total_seconds()), days.errors.get(d)))
    frame = spark.createDataFrame(runs, _nullable(PIPELINE_RUNS.schema))
    append(frame, store, PIPELINE_RUNS)
    return days.finish("run", frame.collect(), on_error)


def _nullable(schema):
    return type(schema)([type(f)(f.name, f.dataType, True) for f in schema])


def _audit_files(spark, store, root, days: _Dates, registered: DataFrame, files: DataFrame, run_id: str) -> None:
    """One audit row per source file found; ``expected_rows`` are those counted in the file,
    NULL for a file that was not read."""
    name = F.col("source_file")
    found = sources.discover_transactions(spark, root, days.requested).select(
        F.lit("transaction").alias("source_kind"), "source_file",
        paths.day_of(name).alias("batch_date"),
    ).where("batch_date is not null").unionByName(sources.discover_fx(spark, root, days.requested).select(
        F.lit("fx").alias("source_kind"), "source_file", "batch_date"))
    known = registered.groupBy("source_file").agg(F.max("source_checksum").alias("source_checksum"))
    loaded = read_partitions(
        spark, store, RAW_TRANSACTIONS, days.requested, ["source_file", "source_checksum"],
    ).unionByName(read_partitions(
        spark, store, RAW_FX_RATES, days.requested, ["source_file", "source_checksum"],
    )).groupBy("source_file", "source_checksum").agg(F.count("*").alias("loaded_rows"))
    audit = found.join(known, "source_file", "left").join(
        loaded, ["source_file", "source_checksum"], "left").join(
        files.select("source_file", F.col("rows").alias("expected_rows")), "source_file", "left").select(
        F.lit(run_id).alias("run_id"), "source_kind", "source_file", "source_checksum",
        "expected_rows",
        F.coalesce("loaded_rows", F.lit(0)).alias("loaded_rows"),
        F.when(F.col("loaded_rows") > 0, "LOADED").otherwise("NOT_LOADED").alias("status"),
        "batch_date")
    append(audit, store, FILE_AUDIT)
