"""Raw transactions and FX rows derived from the generated tables.

The generated tables hold no sales files, so every row of ``orders`` or ``events``
becomes one delivered transaction, or two or three: some are delivered again unchanged,
some again with another amount. Keys decide which rows are dirty and how, so both engines
derive the same rows. Amounts are whole cents; no double is ever printed.
"""

from __future__ import annotations

from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession

from tillbridge.contracts import RAW_FX_RATES, RAW_TRANSACTIONS
from tillbridge.session import configure
from tillbridge.sources.scan import instant

AT = datetime(2026, 1, 2, 3, 4, 5, tzinfo=timezone.utc)

# key, time, cents per base table
BASES = {
    "orders": ("o_orderkey", "o_orderdate", "o_totalprice"),
    "events": ("event_id", "ts", "value"),
}
_TIME = "'yyyy-MM-dd HH:mm:ss'"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return configure(spark).read.parquet(f"{sf_dir}/{name}.parquet")


def base_rows(spark: SparkSession, sf_dir: str, base: str) -> DataFrame:
    """``k`` (unique), ``t`` and ``c`` (cents) of every row of a base table."""
    key, time, money = BASES[base]
    rows = table(spark, sf_dir, base).selectExpr(
        f"{key} AS k", f"CAST({time} AS TIMESTAMP_NTZ) AS t",
        f"CAST(round({money} * 100) AS BIGINT) AS c")
    return rows


def delivered(spark: SparkSession, sf_dir: str, base: str) -> DataFrame:
    """Source text of every delivery, with its region, date and place."""
    copies = base_rows(spark, sf_dir, base).selectExpr(
        "k", "t", "c", "CAST(t AS DATE) AS batch_date",
        "element_at(array('bkk', 'central', 'north', 'northeast', 'south'), CAST(k % 5 + 1 AS INT)) AS home",
        "explode(array_compact(array(0, IF(k % 37 = 0, 1, NULL), IF(k % 53 = 0, 2, NULL)))) AS copy",
    ).selectExpr("*", "c + IF(copy = 2, 100, 0) AS cents")
    text = copies.selectExpr(
        "*",
        "concat(cents div 100, '.', lpad(cents % 100, 2, '0')) AS plain",
        f"""CASE WHEN k % 101 = 0 THEN 'not-a-date'
            WHEN k % 103 = 0 THEN date_format(t + INTERVAL 1 DAY, {_TIME})
            ELSE date_format(t, {_TIME}) END AS dtts""",
        "IF(k % 107 = 0, 'unknown', home) AS region")
    return text.selectExpr(
        "k", "copy", "batch_date", "dtts", "region",
        "IF(k % 113 = 0, '  ', concat(' TX-', k, ' ')) AS txn",
        """CASE WHEN k % 97 = 0 THEN 'N/A' WHEN k % 89 = 0 THEN concat('-', plain)
            WHEN k % 83 = 0 THEN '' WHEN k % 109 = 0 THEN concat(plain, '00000000')
            ELSE plain END AS amount""",
        """CASE WHEN k % 41 = 0 THEN 'JPY' WHEN k % 4 = 0 THEN 'THB' WHEN k % 4 = 1 THEN ' usd '
            WHEN k % 4 = 2 THEN 'EUR' ELSE 'thb' END AS currency""",
        """concat('transactions/business_date=', date_format(batch_date, 'yyyy-MM-dd'), '/sales_',
            region, '_', date_format(batch_date, 'yyyyMMdd'), '.csv.gz') AS source_file""",
        "k * 3 + copy + 1 AS source_row_number")


def raw_transactions(spark: SparkSession, sf_dir: str, base: str = "orders") -> DataFrame:
    """Deliveries as rows of the raw table; the checksum is that of the file name."""
    return delivered(spark, sf_dir, base).selectExpr(
        "*", "sha2(source_file, 256) AS source_checksum",
    ).selectExpr(
        "*", "sha2(concat_ws('|', source_file, source_checksum, source_row_number), 256) AS source_row_id",
    ).withColumn("ingested_at", instant(AT)).select(*RAW_TRANSACTIONS.columns)


def batch_dates(spark: SparkSession, sf_dir: str, base: str = "orders") -> DataFrame:
    return base_rows(spark, sf_dir, base).selectExpr("CAST(t AS DATE) AS batch_date").distinct()


def raw_fx(spark: SparkSession, sf_dir: str, base: str = "orders") -> DataFrame:
    """One publication per weekday of the base table, apart from days off.

    ``n`` numbers the days. Some publications lack a currency, state another date, hold
    no number, or have more than nine decimals.
    """
    days = batch_dates(spark, sf_dir, base).selectExpr(
        "batch_date AS rate_date", "datediff(batch_date, DATE'1970-01-01') AS n",
    ).where("weekday(rate_date) < 5 AND n % 11 <> 0")
    pairs = days.selectExpr(
        "rate_date", "n",
        """explode(array(
            struct('EUR' AS code, 360000 + (n * 53) % 50000 AS r, 1 AS line),
            struct('USD' AS code, 300000 + (n * 37) % 40000 AS r, 2 AS line))) AS p""")
    rows = pairs.selectExpr(
        """date_format(CASE WHEN n % 43 = 0 THEN date_add(rate_date, 1) ELSE rate_date END,
            'yyyy-MM-dd') AS rate_date_raw""",
        "CASE WHEN n % 29 = 0 AND p.code = 'EUR' THEN 'GBP' ELSE concat(lower(p.code), ' ') END AS currency",
        """CASE WHEN n % 31 = 0 AND p.code = 'USD' THEN 'N/A'
            WHEN n % 47 = 0 THEN concat(p.r div 10000, '.', lpad(p.r % 10000, 4, '0'), '123455')
            ELSE concat(p.r div 10000, '.', lpad(p.r % 10000, 4, '0')) END AS mid_rate""",
        "concat('THB per 1 ', p.code) AS rate_unit",
        "'derived' AS source_provider", "'' AS source_url",
        """concat('fx/', date_format(rate_date, 'yyyy/MM'), '/fx_', date_format(rate_date, 'yyyyMMdd'),
            '.csv') AS source_file""",
        "CAST(p.line AS BIGINT) AS source_row_number", "rate_date")
    return rows.selectExpr("*", "sha2(source_file, 256) AS source_checksum").selectExpr(
        "*", "sha2(concat_ws('|', source_file, source_checksum, source_row_number), 256) AS source_row_id",
    ).withColumn("ingested_at", instant(AT)).select(*RAW_FX_RATES.columns)
