"""Own small source trees and rows."""

import gzip
import hashlib
from datetime import date, datetime, timezone
from pathlib import Path

from tillbridge.contracts import RAW_FX_RATES, RAW_TRANSACTIONS, REGIONS

DAY = date(2025, 7, 22)
AT = datetime(2026, 1, 2, 3, 4, 5, tzinfo=timezone.utc)
HEADER = "txn,dtts,amount,currency\n"
FX_HEADER = "rate_date,currency,mid_rate,rate_unit,source_provider,source_url\n"


def raw_row(n=1, **changes):
    row = dict(
        txn=f"T{n}", dtts=f"{DAY} 09:30:00", amount="100.00", currency="THB", region="bkk",
        source_file="transactions/a.csv.gz", source_checksum="c", source_row_number=n,
        source_row_id=f"id-{n}", batch_date=DAY, ingested_at=AT)
    row.update(changes)
    return row


def raw_frame(spark, rows):
    names = RAW_TRANSACTIONS.columns
    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in RAW_TRANSACTIONS.schema)
    return spark.createDataFrame([tuple(r[n] for n in names) for r in rows], schema)


def fx_row(currency, rate, day=DAY, n=1, **changes):
    row = dict(
        rate_date_raw=str(day), currency=currency, mid_rate=rate, rate_unit="u",
        source_provider="p", source_url="s", source_file="fx/x.csv", source_checksum="c",
        source_row_number=n, source_row_id=f"fx-{day}-{currency}-{n}", rate_date=day,
        ingested_at=AT)
    row.update(changes)
    return row


def fx_frame(spark, rows):
    names = RAW_FX_RATES.columns
    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in RAW_FX_RATES.schema)
    return spark.createDataFrame([tuple(r[n] for n in names) for r in rows], schema)


def write_gz(path: Path, text: str):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_bytes(gzip.compress(text.encode("utf-8"), mtime=0))


def write_day(root: Path, day: date, lines: dict):
    """``lines``: region -> list of CSV lines; other regions get one valid row."""
    for region in REGIONS:
        body = lines.get(region, [f"{region}-1,{day} 10:00:00,10.00,THB"])
        write_gz(root / f"transactions/business_date={day}/sales_{region}_{day:%Y%m%d}.csv.gz",
                 HEADER + "".join(line + "\n" for line in body))


def write_fx(root: Path, day: date, usd="32.2722", eur="37.6978"):
    path = root / f"fx/{day:%Y}/{day:%m}/fx_{day:%Y%m%d}.csv"
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text(FX_HEADER + f"{day},EUR,{eur},THB per 1 EUR,p,u\n{day},USD,{usd},THB per 1 USD,p,u\n")


def register(spark, root: Path):
    rows = [(str(p.relative_to(root)), hashlib.sha256(p.read_bytes()).hexdigest())
            for p in sorted(root.rglob("*.csv*")) if p.is_file() and not p.name.startswith(".")]
    return spark.createDataFrame(rows, "source_file string, source_checksum string")
