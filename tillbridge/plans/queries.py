"""One query per operator over the generated tables, whole tables each.

Dates and decimals are given as text, reason codes joined by a pipe character, so that
results compare by value across engines.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from tillbridge.functions.dates import with_datetime
from tillbridge.functions.numeric import round_half_even, with_amount, with_rate
from tillbridge.functions.text import canonical_code, is_missing, strip
from tillbridge.operators import classification as cls
from tillbridge.operators import conversion, fx, reconcile
from tillbridge.plans import derive, marts, publication
from tillbridge.sinks.store import (
    Store, anti_filter, append_new, as_json, ensure_namespace, ensure_table, read_partitions,
    read_through,
)
from tillbridge.contracts import (
    MART_CURRENCY_SUMMARY, MART_DAILY_SALES, MART_REGION_SALES, PUBLISHED, PUBLISHED_VERSIONS, RAW_FX_RATES,
    RAW_TRANSACTIONS, REGIONS, TRANSACTION_HEADER,
)
from tillbridge.session import new_folder, write_and_read
from tillbridge.sources import daily, files, landing, paths
from tillbridge.sources.scan import file_verdicts, row_identity, scan_checked, scan_csv


def plain(frame: DataFrame) -> DataFrame:
    """Dates, times, decimals and arrays as text."""
    out = []
    for f in frame.schema:
        kind = f.dataType.typeName()
        c = F.col(f.name)
        if kind == "array":
            c = F.array_join(c, "|")
        elif kind in ("date", "decimal", "timestamp", "timestamp_ntz"):
            c = c.cast("string")
        out.append(c.alias(f.name))
    return frame.select(*out)


def _classified(spark, sf_dir, base="orders"):
    return cls.classify(derive.raw_transactions(spark, sf_dir, base))


def _kept(spark, sf_dir, base="orders", columns=()):
    """Classified rows, stored once for queries that use them more than once; only the named
    columns, if any are named."""
    rows = _classified(spark, sf_dir, base)
    return write_and_read(rows.select(*columns, "accepted") if columns else rows, "classified", ["accepted"])


def _halves(kept):
    """Raw, accepted and quarantined rows of stored classified ones."""
    raw = kept.select(*RAW_TRANSACTIONS.columns)
    return raw, cls.accepted_rows(kept, derive.AT), cls.quarantine_rows(kept, derive.AT)


def _accepted(spark, sf_dir, base="orders"):
    return cls.accepted_rows(_classified(spark, sf_dir, base), derive.AT)


def _quarantine(spark, sf_dir, base="orders"):
    return cls.quarantine_rows(_classified(spark, sf_dir, base), derive.AT)


def _effective(spark, sf_dir, base="orders"):
    return fx.resolve_effective_fx(
        derive.batch_dates(spark, sf_dir, base), fx.publications(derive.raw_fx(spark, sf_dir, base)))


def _snapshots(spark, sf_dir, base="orders"):
    return fx.snapshots(_effective(spark, sf_dir, base))


def _fact(spark, sf_dir, base="orders"):
    return conversion.fact_rows(
        _accepted(spark, sf_dir, base), _snapshots(spark, sf_dir, base), derive.AT)


# --- sources -----------------------------------------------------------------------

def src_row_identity(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = derive.raw_transactions(spark, sf_dir)
    identity = row_identity(F.col("source_file"), F.col("source_checksum"), F.col("source_row_number"))
    return rows.select("source_file", "source_checksum", "source_row_number", identity.alias("source_row_id"))


def src_path_fields(spark, sf_dir):
    """Date and region of every file name, as far as the name allows them."""
    name = F.col("source_file")
    names = derive.raw_transactions(spark, sf_dir).select("source_file").distinct()
    return plain(names.select(
        "source_file", paths.day_of(name).alias("batch_date"), paths.region_of(name).alias("region")))


def src_completeness(spark, sf_dir):
    found = derive.raw_transactions(spark, sf_dir).select("source_file").distinct()
    return plain(files.completeness(derive.batch_dates(spark, sf_dir), found))


def src_fx_status(spark, sf_dir):
    found = derive.raw_fx(spark, sf_dir).select(F.col("rate_date").alias("batch_date"), "source_file").distinct()
    return plain(files.fx_status(derive.batch_dates(spark, sf_dir), found))


def _inventory(spark, sf_dir):
    """Files of the events, each with a stand-in checksum over name and row count."""
    counted = derive.raw_transactions(spark, sf_dir, "events").groupBy("source_file").agg(
        F.count("*").alias("rows"))
    return counted.withColumn(
        "sha256", F.sha2(F.concat_ws("|", "source_file", F.col("rows").cast("string")), 256))


def src_checksums(spark, sf_dir):
    local = _inventory(spark, sf_dir)
    registered = local.select(
        "source_file",
        F.when(F.col("rows") % 5 == 0, "").when(F.col("rows") % 5 == 1, "0").otherwise(F.col("sha256"))
        .alias("source_checksum")).where(F.col("rows") % 5 != 2)
    checked = files.verify_checksums(local.select("source_file", "sha256"), registered)
    return checked.select("source_file", F.coalesce("problem", F.lit("OK")).alias("problem"))


def _write_lines(rows: DataFrame) -> str:
    """One uncompressed text file per business date and region below a new folder: the column
    ``line``, in order of ``n``."""
    folder = new_folder(rows.sparkSession, "lines")
    rows.repartition("business_date", "region").sortWithinPartitions("business_date", "region", "n").select(
        "line", "business_date", "region").write.partitionBy("business_date", "region").text(folder)
    return folder


def _delivered_lines(spark, sf_dir) -> DataFrame:
    """CSV lines of the valid-region deliveries of the events."""
    return derive.delivered(spark, sf_dir, "events").where(F.col("region").isin(*REGIONS)).selectExpr(
        "batch_date AS business_date", "region", "source_row_number AS n",
        "concat_ws(',', txn, dtts, amount, currency) AS line")


def _file_of():
    return [F.regexp_extract("path", f"{name}=([^/]+)/", 1).alias(name) for name in ("business_date", "region")]


def src_file_hashes(spark, sf_dir):
    """Digests of written files; those above 2,000 bytes are streamed."""
    folder = _write_lines(_delivered_lines(spark, sf_dir))
    hashed = files.file_hashes(spark, f"{folder}/business_date=*/region=*/*.txt", streamed_bytes=2000)
    return hashed.select(*_file_of(), "length", "sha256")


def src_file_verdicts(spark, sf_dir):
    """Files with turned headers, and rows of three or five fields, judged in one pass."""
    lines = _delivered_lines(spark, sf_dir).withColumn("line", F.expr(
        "CASE n % 50 WHEN 0 THEN concat(line, ',more') WHEN 1 THEN substring_index(line, ',', 3) ELSE line END"))
    turned = "region = 'north' AND day(business_date) % 5 = 0"
    headers = lines.select("business_date", "region").distinct().selectExpr(
        "business_date", "region", "CAST(0 AS BIGINT) AS n",
        f"IF({turned}, 'txn,dtts,currency,amount', 'txn,dtts,amount,currency') AS line")
    folder = _write_lines(lines.unionByName(headers))
    checked = scan_checked(spark, f"{folder}/business_date=*/region=*/*.txt", TRANSACTION_HEADER)
    return file_verdicts(checked, "path").select(*_file_of(), "rows", "malformed_rows", "header_ok")


def src_landing_diff(spark, sf_dir):
    local = _inventory(spark, sf_dir).select(
        paths.landing_name(F.lit("transaction"), F.regexp_replace("source_file", "^transactions/", ""))
        .alias("object_name"), "rows", "sha256").where("object_name is not null")
    landed = local.where("rows % 4 <> 0").select(
        "object_name",
        F.when(F.col("rows") % 4 == 1, F.lit("altered")).when(F.col("rows") % 4 == 2, F.lit(None))
        .otherwise(F.col("sha256")).alias("sha256"))
    return landing.landing_decision(local, landed).select("object_name", "action")


def src_landing_subset(spark, sf_dir):
    """The first landed name per kind, manifests all."""
    named = _inventory(spark, sf_dir).select(
        F.lit("transaction").alias("kind"), F.col("source_file").alias("object_name"),
    ).unionByName(derive.raw_fx(spark, sf_dir, "events").select(
        F.lit("fx").alias("kind"), F.col("source_file").alias("object_name")).distinct(),
    ).unionByName(_manifests(spark, sf_dir))
    return landing.smoke_subset(named)


def _manifests(spark, sf_dir):
    """Both manifests, as far as the tables they describe have rows."""
    present = derive.batch_dates(spark, sf_dir, "events").agg(F.count("*").alias("n")).where("n > 0")
    return present.select(
        F.lit("manifest").alias("kind"),
        F.explode(F.array(*map(F.lit, paths.MANIFEST_NAMES.values()))).alias("object_name"))


def src_manifest_stats(spark, sf_dir):
    rows = derive.raw_transactions(spark, sf_dir, "events")
    return plain(daily.file_statistics(rows, "batch_date", "region", "source_file"))


def src_source_rules(spark, sf_dir):
    """Rows that break the daily source contract, per file and rule."""
    rows = derive.raw_transactions(spark, sf_dir, "events").select(
        "dtts", F.col("source_file").alias("file_path"), F.col("batch_date").cast("string").alias("business_date"))
    return daily.row_violations(rows).groupBy("file_path", "rule").agg(
        F.count("*").alias("rows"), F.min("detail").alias("first_detail"))


def src_file_rules(spark, sf_dir):
    names = derive.raw_transactions(spark, sf_dir).select(
        F.regexp_replace("source_file", "^transactions/", "").alias("file_path")).distinct()
    return daily.file_violations(names)


def src_corpus_summary(spark, sf_dir):
    rows = derive.raw_transactions(spark, sf_dir, "events").withColumn(
        "business_date", F.col("batch_date").cast("string"))
    return daily.corpus_summary(daily.file_statistics(rows, "business_date", "region", "source_file"))


def src_daily_split(spark, sf_dir):
    """Rows of monthly files by business date and region."""
    rows = derive.delivered(spark, sf_dir, "events").where("dtts <> 'not-a-date' and region <> 'unknown'")
    monthly = rows.withColumn("path", F.concat(
        F.lit("in/sales_"), "region", F.lit("_"), F.date_format("batch_date", "yyyyMM"), F.lit(".csv.gz")))
    return daily.daily_rows(monthly.drop("region")).groupBy(
        F.col("business_date").cast("string").alias("business_date"), "region",
    ).agg(F.count("*").alias("rows"), F.min("dtts").alias("min_dtts"), F.max("dtts").alias("max_dtts"))


def _write_landing(spark, sf_dir) -> str:
    """The valid-region deliveries of the events as gzip CSV files, one per date and
    region, below a new folder. Rows lie in order of their number."""
    root = new_folder(spark, "landing")
    derive.delivered(spark, sf_dir, "events").where(F.col("region").isin(*REGIONS)).withColumnRenamed(
        "batch_date", "business_date").repartition("business_date", "region").sortWithinPartitions(
        "business_date", "region", "source_row_number").select(
        *TRANSACTION_HEADER.names, "business_date", "region").write.partitionBy(
        "business_date", "region").options(
        header=True, compression="gzip", escape='"', emptyValue="",
        ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False).csv(f"{root}/transactions")
    return root


def src_csv_scan(spark, sf_dir):
    """Files written and scanned back: text, date, region and row number of every row."""
    root = _write_landing(spark, sf_dir)
    rows = scan_csv(spark, f"{root}/transactions/business_date=*/region=*/*.csv.gz", TRANSACTION_HEADER)
    name = paths.source_name(F.col("path"))
    return plain(rows.select(
        paths.day_of(name).alias("batch_date"), paths.region_of(name).alias("region"),
        "source_row_number", *TRANSACTION_HEADER.names))


def _stored(spark, contract) -> Store:
    store = Store("t" + new_folder(spark, "s").rsplit("-", 1)[-1], new_folder(spark, "store"))
    ensure_namespace(spark, store, contract.namespace)
    ensure_table(spark, store, contract)
    return store


def _dates(frame, column="batch_date"):
    return [r[0] for r in frame.select(column).distinct().collect()]


def src_partition_read(spark, sf_dir):
    """A stored raw table read back by partition: its Mondays, two columns of them."""
    rows = derive.raw_transactions(spark, sf_dir, "events")
    store = _stored(spark, RAW_TRANSACTIONS)
    dates = _dates(derive.batch_dates(spark, sf_dir, "events"))
    append_new(rows, store, RAW_TRANSACTIONS, dates, spread=True)
    return plain(read_partitions(
        spark, store, RAW_TRANSACTIONS, [d for d in dates if d.weekday() == 0], ["batch_date", "source_row_id"]))


def src_read_through(spark, sf_dir):
    """Stored FX history up to ten days before the last business date."""
    rows = derive.raw_fx(spark, sf_dir, "events")
    store = _stored(spark, RAW_FX_RATES)
    append_new(rows, store, RAW_FX_RATES, _dates(rows, "rate_date"), spread=True)
    last = derive.batch_dates(spark, sf_dir, "events").agg(F.date_sub(F.max("batch_date"), 10)).first()[0]
    return plain(read_through(
        spark, store, RAW_FX_RATES, last, ["rate_date", "currency", "mid_rate", "source_row_id"]))


# --- sinks -------------------------------------------------------------------------

def sink_anti_join(spark, sf_dir):
    """Quarantined ids removed from the raw rows."""
    kept = _kept(spark, sf_dir, columns=["batch_date", "source_row_id"])
    return plain(anti_filter(kept, kept.where("not accepted")).select("batch_date", "source_row_id"))


def sink_idempotent_append(spark, sf_dir):
    """Accepted rows appended first, then all rows twice: each row is stored once."""
    raw = derive.raw_transactions(spark, sf_dir, "events")
    store = _stored(spark, RAW_TRANSACTIONS)
    dates = _dates(derive.batch_dates(spark, sf_dir, "events"))
    first = raw.join(_accepted(spark, sf_dir, "events").select("source_row_id"), "source_row_id", "left_semi")
    append_new(first, store, RAW_TRANSACTIONS, dates, spread=True)
    append_new(raw, store, RAW_TRANSACTIONS, dates, spread=True)
    append_new(raw, store, RAW_TRANSACTIONS, dates, spread=True)
    return plain(read_partitions(spark, store, RAW_TRANSACTIONS, dates).drop("ingested_at"))


def sink_json(spark, sf_dir):
    rows = _fact(spark, sf_dir).select(
        "source_row_id", "batch_date", "transaction_dt", "amount_thb", "is_carried_forward")
    return as_json(rows)


# --- functions ---------------------------------------------------------------------

def fn_strip_upper(spark, sf_dir):
    rows = derive.raw_transactions(spark, sf_dir)
    return rows.select(
        "source_row_id", strip(F.col("txn")).alias("txn_id"), is_missing(F.col("txn")).alias("missing"),
        canonical_code(F.col("currency")).alias("currency_code"))


def fn_parse_timestamp(spark, sf_dir):
    """Event times written in nine ways, seven of them readable."""
    rows = derive.base_rows(spark, sf_dir, "events").selectExpr("k", """
        CASE CAST(k % 9 AS INT)
            WHEN 0 THEN date_format(t, 'yyyy-M-d H:m:s')
            WHEN 1 THEN date_format(t, 'yyyy-MM-dd')
            WHEN 2 THEN date_format(t, "yyyy-MM-dd'T'HH:mm:ss")
            WHEN 3 THEN concat(date_format(t, 'yyyy-MM-dd HH:mm'), ':60')
            WHEN 4 THEN date_format(t, 'yyyy-MM-dd  HH:mm:ss')
            WHEN 5 THEN concat('15', date_format(t, 'yy-MM-dd HH:mm:ss'))
            WHEN 6 THEN concat(date_format(t, 'yyyy-'), '02-30 00:00:00')
            ELSE date_format(t, 'yyyy-MM-dd HH:mm:ss') END AS dtts""")
    return plain(with_datetime(rows, "dtts", "transaction_dt"))


def fn_parse_numeric(spark, sf_dir):
    """Line prices written in ten ways; literals, not values, decide what is storable."""
    rows = derive.table(spark, sf_dir, "lineitem").selectExpr(
        "CAST(round(l_extendedprice * 100) AS BIGINT) AS c", "(l_orderkey * 7 + l_linenumber) % 10 AS kind")
    texts = rows.selectExpr(
        "kind", "c", "concat(c div 100, '.', lpad(c % 100, 2, '0')) AS p").selectExpr("kind", """
        CASE CAST(kind AS INT)
            WHEN 0 THEN p WHEN 1 THEN concat('+', p) WHEN 2 THEN concat(c, 'E-2')
            WHEN 3 THEN concat(p, '0000000') WHEN 4 THEN concat(p, '00000000')
            WHEN 5 THEN concat(c, 'e3') WHEN 6 THEN concat('1_', p) WHEN 7 THEN concat(c, 'E+27')
            WHEN 8 THEN concat('.', c) ELSE concat('-', p, ' x') END AS amount""")
    parsed = with_amount(texts, "amount", "value")
    return plain(parsed.groupBy("kind").agg(
        F.count("*").alias("rows"), F.count("value").alias("valid"),
        F.sum("value").cast("decimal(38,9)").alias("total"), F.max("amount").alias("example")))


def fn_parse_rate(spark, sf_dir):
    rows = derive.raw_fx(spark, sf_dir).select("source_row_id", "mid_rate")
    return plain(with_rate(rows, "mid_rate", "rate"))


def fn_round_half_even(spark, sf_dir):
    """Price times discount and tax, exact to six decimals, rounded to four."""
    cents = [f"CAST(CAST(round({c} * 100) AS BIGINT) AS decimal(12,0)) * 0.01BD AS {n}"
             for c, n in (("l_extendedprice", "p"), ("l_discount", "d"), ("l_tax", "t"))]
    rows = derive.table(spark, sf_dir, "lineitem").selectExpr("l_returnflag", "l_linestatus", *cents)
    value = round_half_even((F.col("p") * F.col("d") * F.col("t")).cast("decimal(30,6)"), 4)
    return plain(rows.groupBy("l_returnflag", "l_linestatus").agg(
        F.count("*").alias("rows"), F.sum(value).cast("decimal(38,4)").alias("total")))


# --- classification ----------------------------------------------------------------

def cls_base_reasons(spark, sf_dir):
    rows = cls.canonicalize(derive.raw_transactions(spark, sf_dir))
    return plain(rows.select(
        "source_row_id", "txn_id", "transaction_dt", "amount_numeric", "currency_code",
        cls.base_reasons(F.col("reason_flags")).alias("base_reasons")))


def cls_classified(spark, sf_dir):
    return plain(_classified(spark, sf_dir).select("source_row_id", "batch_date", "accepted", "reason_codes"))


def cls_hot_ids(spark, sf_dir):
    """As cls_classified, with every id of two rows or more judged by pre-aggregation."""
    rows = cls.classify(derive.raw_transactions(spark, sf_dir), hot_rows=2)
    return plain(rows.select("source_row_id", "batch_date", "accepted", "reason_codes"))


def cls_accepted(spark, sf_dir):
    return plain(_accepted(spark, sf_dir).drop("ingested_at", "classified_at"))


def cls_quarantine(spark, sf_dir):
    return plain(_quarantine(spark, sf_dir).drop("ingested_at", "quarantined_at"))


def _duplicates(spark, sf_dir, reason):
    marked = cls.mark_duplicates(cls.canonicalize(derive.raw_transactions(spark, sf_dir)))
    return plain(marked.where(F.col("duplicate_reason") == reason).select(
        "batch_date", "txn_id", "source_file", "source_row_number", "duplicate_reason"))


def cls_conflicts(spark, sf_dir):
    return _duplicates(spark, sf_dir, "DUPLICATE_CONFLICT")


def cls_replays(spark, sf_dir):
    return _duplicates(spark, sf_dir, "DUPLICATE_REPLAY")


def cls_reason_counts(spark, sf_dir):
    return plain(cls.reason_counts(_classified(spark, sf_dir)))


def cls_balance(spark, sf_dir):
    return plain(reconcile.classified_balance(_classified(spark, sf_dir)))


def cls_outliers(spark, sf_dir):
    flagged = cls.flag_outliers(_halves(_kept(spark, sf_dir, "events"))[1])
    return plain(flagged.select("source_row_id", "amount", "outlier_threshold", "is_outlier"))


# --- exchange rates ----------------------------------------------------------------

def fx_publications(spark, sf_dir):
    return plain(fx.publications(derive.raw_fx(spark, sf_dir)))


def fx_asof(spark, sf_dir):
    return plain(_effective(spark, sf_dir))


def fx_staleness(spark, sf_dir):
    return _effective(spark, sf_dir).groupBy("fx_status", "staleness_days", "is_carried_forward").agg(
        F.count("*").alias("dates"))


def fx_daily_dim(spark, sf_dir):
    dates = fx.calendar_dates(derive.batch_dates(spark, sf_dir))
    return plain(fx.daily_fx_dimension(dates, fx.publications(derive.raw_fx(spark, sf_dir))))


# --- conversion --------------------------------------------------------------------

def fact_convert(spark, sf_dir):
    converted = conversion.convert(_accepted(spark, sf_dir), _snapshots(spark, sf_dir))
    return plain(converted.select(
        "source_row_id", "currency", "amount", "amount_thb", "amount_usd", "amount_eur"))


def fact_convert_large(spark, sf_dir):
    """Amounts a million million times larger, beyond bigint arithmetic."""
    accepted = _accepted(spark, sf_dir).withColumn(
        "amount", F.expr("CAST(amount * 1000000000000BD AS decimal(38,9))"))
    converted = conversion.convert(accepted, _snapshots(spark, sf_dir))
    return plain(converted.select(
        "source_row_id", "currency", "amount", "amount_thb", "amount_usd", "amount_eur"))


def fact_full(spark, sf_dir):
    return plain(_fact(spark, sf_dir).drop("ingested_at", "classified_at", "fact_created_at"))


def fact_excluded_dates(spark, sf_dir):
    """Dates whose accepted rows are not converted, as no exchange rate is usable."""
    return plain(conversion.excluded_dates(_accepted(spark, sf_dir), _effective(spark, sf_dir)))


def fact_prechecks(spark, sf_dir):
    """Raw rows passed off as accepted ones: repeated ids, bad amounts and currencies."""
    rows = _classified(spark, sf_dir)
    doubtful = rows.select(
        F.when(F.array_contains("reason_codes", "MISSING_TXN"), "").otherwise(
            F.concat_ws("-", "batch_date", "txn_id")).alias("source_row_id"),
        F.col("amount_numeric").alias("amount"), F.col("currency_code").alias("currency"),
        F.col("txn_id").alias("txn"), "transaction_dt", "region", "source_file", "source_checksum",
        "source_row_number", "batch_date", "ingested_at", F.col("ingested_at").alias("classified_at"))
    return plain(conversion.accepted_violations(doubtful, _snapshots(spark, sf_dir)))


# --- reconciliation ----------------------------------------------------------------

def set_except_both(spark, sf_dir):
    """Ids of raw rows against ids of accepted rows, both directions."""
    kept = _kept(spark, sf_dir, columns=["batch_date", "source_row_id"])
    return plain(reconcile.id_differences(kept, kept.where("accepted")))


def set_differing_dates(spark, sf_dir):
    """Dates whose ids differ by fingerprint: the other side lacks the rejected rows of even days only."""
    kept = _kept(spark, sf_dir, columns=["batch_date", "source_row_id"])
    other = kept.where(F.col("accepted") | (F.dayofmonth("batch_date") % 2 == 1))
    return plain(reconcile.differing_dates(kept, other))


def set_except_right(spark, sf_dir):
    """Rows of dates with usable rates against accepted rows: either side has ids of its own."""
    raw, accepted, _ = _halves(_kept(spark, sf_dir))
    usable = _effective(spark, sf_dir).where("fx_status = 'OK'").select("batch_date")
    return plain(reconcile.id_differences(raw.join(usable, "batch_date", "left_semi"), accepted))


def rec_classification(spark, sf_dir):
    return plain(reconcile.classification_balance(*_halves(_kept(spark, sf_dir))))


def rec_fact(spark, sf_dir):
    _, accepted, _ = _halves(_kept(spark, sf_dir))
    return plain(reconcile.fact_balance(
        accepted, conversion.fact_rows(accepted, _snapshots(spark, sf_dir), derive.AT)))


def _chain(spark, sf_dir):
    manifest = derive.delivered(spark, sf_dir, "orders").groupBy("batch_date", "source_file").agg(
        F.count("*").alias("rows"))
    raw, accepted, quarantine = _halves(_kept(spark, sf_dir))
    fact = conversion.fact_rows(accepted, _snapshots(spark, sf_dir), derive.AT)
    return reconcile.full_chain(manifest, raw, accepted, quarantine, fact)


def rec_full_chain(spark, sf_dir):
    return plain(_chain(spark, sf_dir))


# --- marts and publication ---------------------------------------------------------

def mart_daily_sales(spark, sf_dir):
    return plain(marts.daily_sales(_fact(spark, sf_dir)))


def mart_region_sales(spark, sf_dir):
    return plain(marts.region_sales(_fact(spark, sf_dir)))


def mart_currency_summary(spark, sf_dir):
    return plain(marts.currency_summary(_fact(spark, sf_dir)))


def mart_data_quality(spark, sf_dir):
    kept = _kept(spark, sf_dir, "events")
    return plain(marts.data_quality(kept, cls.flag_outliers(_halves(kept)[1])))


def _runs(spark, sf_dir):
    """Two runs per date: a failed one, then one that fails only on every seventh day."""
    days = derive.batch_dates(spark, sf_dir).selectExpr(
        "batch_date", "datediff(batch_date, DATE'1970-01-01') AS n")
    return days.selectExpr("batch_date", "n", "explode(array(1, 2)) AS attempt").selectExpr(
        "concat('run-', attempt) AS run_id", "batch_date",
        "IF(attempt = 1 OR n % 7 = 0, 'FAILED', 'SUCCESS') AS status",
        "CAST(attempt AS BIGINT) AS run_sequence")


def pub_latest_runs(spark, sf_dir):
    return plain(publication.latest_runs(_runs(spark, sf_dir)))


def pub_gate(spark, sf_dir):
    shown = publication.published(_fact(spark, sf_dir), _runs(spark, sf_dir))
    return plain(shown.select("batch_date", "source_row_id", "amount_thb"))


def pub_daily_sales(spark, sf_dir):
    shown = publication.published(_fact(spark, sf_dir), _runs(spark, sf_dir))
    return plain(marts.daily_sales(shown))


def _shared_store(spark, *contracts) -> Store:
    store = Store("t" + new_folder(spark, "s").rsplit("-", 1)[-1], new_folder(spark, "store"))
    for contract in contracts:
        ensure_namespace(spark, store, contract.namespace)
        ensure_table(spark, store, contract)
    return store


def pub_last_good(spark, sf_dir):
    """The published rows after two runs: the first stores every other row of all dates, the second all
    rows, but fails on every third date."""
    store = _shared_store(spark, PUBLISHED, PUBLISHED_VERSIONS)
    fact = write_and_read(_fact(spark, sf_dir, "events"), "fact")
    publication.publish(fact.where("source_row_number % 2 = 0"), store, "run-1", 1, derive.AT)
    publication.publish(fact.where("day(batch_date) % 3 <> 0"), store, "run-2", 2, derive.AT)
    return plain(publication.last_good(spark, store).select("batch_date", "source_row_id", "amount_thb"))


def mart_stored_daily_sales(spark, sf_dir):
    """The stored mart of all dates, from every other row; then of every third date from all rows."""
    store = _shared_store(spark, MART_DAILY_SALES, MART_REGION_SALES, MART_CURRENCY_SUMMARY)
    fact = write_and_read(_fact(spark, sf_dir, "events"), "fact")
    marts.refresh_sales(fact.where("source_row_number % 2 = 0"), store)
    marts.refresh_sales(fact.where("day(batch_date) % 3 = 0"), store)
    return plain(spark.table(store.table(MART_DAILY_SALES)))


QUERIES = {name: f for name, f in list(globals().items())
           if name.split("_")[0] in ("src", "sink", "fn", "cls", "fx", "fact", "set", "rec", "mart", "pub")
           and callable(f)}
