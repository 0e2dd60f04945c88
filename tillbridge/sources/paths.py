"""File names: where each source lies, and what its path says about it.

Every builder takes plain Python values; every reader takes a column, so paths of any
number of files are judged inside a Spark job.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, functions as F

from tillbridge.contracts import REGIONS

_REGION = "|".join(REGIONS)

# Path formats.
DAILY_NAME = rf"sales_({_REGION})_([0-9]{{8}})\.csv\.gz"
MONTHLY_NAME = rf"sales_({_REGION})_[0-9]{{6}}\.csv\.gz"
DAY_FOLDER = r"business_date=([0-9]{4}-[0-9]{2}-[0-9]{2})"
FX_NAME = r"fx_([0-9]{8})\.csv"
# The daily split writes this form: Spark picks file names, so the region is a folder.
SPLIT_NAME = rf"region=({_REGION})/[^/]+\.csv\.gz"
MANIFEST_NAMES = {
    "data/daily_source_manifest.csv": "manifests/daily_source_manifest.csv",
    "fx/manifest.csv": "manifests/fx_manifest.csv",
}


def transaction_folder(day: date) -> str:
    return f"transactions/business_date={day:%Y-%m-%d}"


def transaction_file(day: date, region: str) -> str:
    return f"{transaction_folder(day)}/sales_{region}_{day:%Y%m%d}.csv.gz"


def fx_file(day: date) -> str:
    return f"fx/{day:%Y}/{day:%m}/fx_{day:%Y%m%d}.csv"


def source_name(path: Column) -> Column:
    """Name below the landing root, taken from a full path or URI."""
    return F.regexp_extract(
        path,
        r"((?:transactions/[^/]+/(?:region=[^/]+/)?|fx/[^/]+/[^/]+/|manifests/)[^/]+)\z", 1)


def below_landing(path: Column) -> Column:
    """As :func:`source_name`, for files at any depth and of any name."""
    return F.regexp_extract(path, r"(?:.*/)?(transactions/business_date=[^/]*/.+)\z", 1)


def matched(text: Column, pattern: str, group: int = 1) -> Column:
    """Group of a pattern that covers the whole text, NULL without a match."""
    return F.when(
        text.rlike(rf"\A(?:{pattern})\z"),
        F.regexp_extract(text, rf"\A(?:{pattern})\z", group))


def day_of(name: Column) -> Column:
    """Business date of a transaction file, from its folder; NULL if malformed."""
    return F.regexp_extract(name, DAY_FOLDER + "/", 1).try_cast("date")


def region_of(name: Column) -> Column:
    """Region of a daily transaction file, NULL unless folder, file name and the date
    in both agree. Accepts the landed form and the form the daily split writes."""
    landed = rf"transactions/{DAY_FOLDER}/{DAILY_NAME}"
    written = rf"transactions/{DAY_FOLDER}/{SPLIT_NAME}"
    same_day = matched(name, landed, 3) == F.regexp_replace(matched(name, landed, 1), "-", "")
    return F.when(
        day_of(name).isNotNull(),
        F.coalesce(F.when(same_day, matched(name, landed, 2)), matched(name, written, 2)))


def fx_day_of(name: Column) -> Column:
    """Publication date of an FX file, NULL unless its folders agree with its name."""
    day = F.to_date(F.lit("1970-01-01"))
    compact = matched(name, rf"fx/[0-9]{{4}}/[0-9]{{2}}/{FX_NAME}")
    text = F.concat_ws("-", F.substring(compact, 1, 4), F.substring(compact, 5, 2),
                       F.substring(compact, 7, 2))
    folder = F.concat(F.lit("fx/"), F.substring(compact, 1, 4), F.lit("/"),
                      F.substring(compact, 5, 2), F.lit("/"))
    day = F.when(compact.isNotNull(), text.try_cast("date"))
    return F.when(name.startswith(folder), day)


def landing_name(kind: Column, relative: Column) -> Column:
    """Canonical landing name of a local file, NULL for an unsupported path.

    ``relative`` is relative to the transaction root, to the folder that holds
    ``fx_daily``, or (manifests) to the repository root.
    """
    transaction = matched(relative, rf"({DAY_FOLDER}/{DAILY_NAME})")
    fx = matched(relative, rf"fx_daily/([0-9]{{4}}/[0-9]{{2}}/{FX_NAME})")
    manifest = F.lit(None).cast("string")
    for local, landed in MANIFEST_NAMES.items():
        manifest = F.when(relative == local, F.lit(landed)).otherwise(manifest)
    return (
        F.when(kind == "transaction", F.concat(F.lit("transactions/"), transaction))
        .when(kind == "fx", F.concat(F.lit("fx/"), fx))
        .when(kind == "manifest", manifest)
    )
