"""Domains, column lists and table contracts."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T

from tillbridge.errors import ContractError

# Domains.
REGIONS = ("bkk", "central", "north", "northeast", "south")
BASE_CURRENCY = "THB"
FOREIGN_CURRENCIES = ("USD", "EUR")
CURRENCIES = (BASE_CURRENCY, *FOREIGN_CURRENCIES)

# Reason codes, in the order in which they are reported.
BASE_REASONS = (
    "MISSING_TXN",
    "INVALID_DTTS",
    "DTTS_BATCH_DATE_MISMATCH",
    "INVALID_AMOUNT",
    "NEGATIVE_AMOUNT",
    "INVALID_CURRENCY",
    "INVALID_REGION",
)
DUPLICATE_CONFLICT = "DUPLICATE_CONFLICT"
DUPLICATE_REPLAY = "DUPLICATE_REPLAY"

# The four namespaces.
NAMESPACES = ("raw", "ops", "analytics", "public")

NUMERIC = T.DecimalType(38, 9)


def _struct(text: str) -> T.StructType:
    """``name type[!]`` per line; ``!`` marks a required column."""
    types = {
        "string": T.StringType(),
        "long": T.LongType(),
        "int": T.IntegerType(),
        "date": T.DateType(),
        "datetime": T.TimestampNTZType(),
        "timestamp": T.TimestampType(),
        "numeric": NUMERIC,
        "money": T.DecimalType(38, 2),
        "boolean": T.BooleanType(),
        "strings": T.ArrayType(T.StringType()),
    }
    fields = []
    for line in filter(str.strip, text.splitlines()):
        name, kind = line.split()
        fields.append(T.StructField(name, types[kind.rstrip("!")], not kind.endswith("!")))
    return T.StructType(fields)


# Source file headers.
TRANSACTION_HEADER = _struct("""
    txn string
    dtts string
    amount string
    currency string
""")
FX_HEADER = _struct("""
    rate_date string
    currency string
    mid_rate string
    rate_unit string
    source_provider string
    source_url string
""")
SOURCE_MANIFEST = _struct("""
    business_date string
    region string
    file_path string
    rows long
    min_dtts string
    max_dtts string
    compressed_bytes long
    sha256 string
""")

_LINEAGE = """
    source_file string!
    source_checksum string!
    source_row_number long!
    source_row_id string!
"""
_RAW_BUSINESS = """
    txn string
    dtts string
    amount string
    currency string
    region string!
"""
_ACCEPTED = """
    txn string!
    transaction_dt datetime!
    amount numeric!
    currency string!
    region string!
""" + _LINEAGE + """
    batch_date date!
    ingested_at timestamp!
    classified_at timestamp!
"""


@dataclass(frozen=True)
class TableContract:
    """Exact schema of a stored table and the date column that partitions it."""

    namespace: str
    name: str
    schema: T.StructType
    partition_column: str

    @property
    def columns(self) -> list[str]:
        return self.schema.names

    @property
    def required(self) -> list[str]:
        return [f.name for f in self.schema if not f.nullable]


RAW_TRANSACTIONS = TableContract(
    "raw", "transactions",
    _struct(_RAW_BUSINESS + _LINEAGE + "batch_date date!\ningested_at timestamp!"),
    "batch_date",
)
RAW_FX_RATES = TableContract(
    "raw", "fx_rates",
    _struct("""
        rate_date_raw string!
        currency string!
        mid_rate string!
        rate_unit string!
        source_provider string!
        source_url string!
    """ + _LINEAGE + """
        rate_date date!
        ingested_at timestamp!
    """),
    "rate_date",
)
ACCEPTED = TableContract(
    "analytics", "transactions_accepted", _struct(_ACCEPTED), "batch_date",
)
QUARANTINE = TableContract(
    "ops", "transactions_quarantine",
    _struct(_RAW_BUSINESS + _LINEAGE
            + "batch_date date!\ningested_at timestamp!\n"
              "reason_codes strings\nquarantined_at timestamp!"),
    "batch_date",
)
FACT = TableContract(
    "analytics", "fct_transactions",
    _struct(_ACCEPTED + """
        amount_thb numeric!
        amount_usd numeric!
        amount_eur numeric!
        fx_rate_date date!
        usd_thb_rate numeric!
        eur_thb_rate numeric!
        is_carried_forward boolean!
        staleness_days int!
        fact_created_at timestamp!
    """),
    "batch_date",
)
PIPELINE_RUNS = TableContract(
    "ops", "pipeline_runs",
    _struct("""
        run_id string!
        run_sequence long!
        batch_date date!
        status string!
        raw_rows long
        accepted_rows long
        quarantine_rows long
        fact_rows long
        started_at timestamp!
        ended_at timestamp!
        duration_seconds long!
        error string
    """),
    "batch_date",
)
FILE_AUDIT = TableContract(
    "ops", "file_ingestion_audit",
    _struct("""
        run_id string!
        source_kind string!
        source_file string!
        source_checksum string
        expected_rows long
        loaded_rows long!
        status string!
        batch_date date!
    """),
    "batch_date",
)
PUBLISHED = TableContract(
    "public", "published_fact",
    T.StructType([*FACT.schema, T.StructField("version", T.LongType(), False)]), "batch_date",
)
PUBLISHED_VERSIONS = TableContract(
    "public", "published_versions",
    _struct("""
        version long!
        run_id string!
        rows long!
        published_at timestamp!
        batch_date date!
    """),
    "batch_date",
)
_TOTALS = """
    transactions long!
    total_thb numeric
    total_usd numeric
    total_eur numeric
    report_thb money
    report_usd money
    report_eur money
    batch_date date!
"""
MART_DAILY_SALES = TableContract("analytics", "mart_daily_sales", _struct(_TOTALS), "batch_date")
MART_REGION_SALES = TableContract(
    "analytics", "mart_region_sales", _struct("region string!\n" + _TOTALS), "batch_date")
MART_CURRENCY_SUMMARY = TableContract(
    "analytics", "mart_currency_summary", _struct("currency string!\ntotal_original numeric\n" + _TOTALS), "batch_date")
MART_DATA_QUALITY = TableContract(
    "analytics", "mart_data_quality",
    _struct("""
        raw_rows long!
        accepted_rows long!
        quarantine_rows long!
        invalid_rows long!
        replay_rows long!
        conflict_rows long!
        warning_rows long!
        batch_date date!
    """),
    "batch_date",
)
MARTS = (MART_DAILY_SALES, MART_REGION_SALES, MART_CURRENCY_SUMMARY, MART_DATA_QUALITY)
TABLES = (
    RAW_TRANSACTIONS, RAW_FX_RATES, ACCEPTED, QUARANTINE, FACT, PIPELINE_RUNS, FILE_AUDIT, PUBLISHED,
    PUBLISHED_VERSIONS, *MARTS,
)


def require_columns(df, columns, label: str) -> None:
    """Fail with the names of the columns that ``df`` lacks."""
    present = set(df.columns)
    missing = [name for name in columns if name not in present]
    if missing:
        raise ContractError(f"{label}: missing columns {missing}")
