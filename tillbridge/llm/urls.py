"""URL filter: fixed rules, then association rules mined from labelled URLs.

A URL becomes a set of tokens (scheme, host labels, registered part of the host, path segments
with digits masked, file ending, query names). FP-growth finds the token combinations that are
frequent among labelled URLs together with their class; rules "tokens -> block" are kept from a
support and a confidence on. An inverted index lists each rule under its rarest token; URLs
look up their tokens there and block if all tokens of a rule are present.

Fixed rules go before mined ones: a rule fits its host and all subdomains if the path starts
with the rule's; the longest that fits decides.

Column expressions, joins and Spark's own FP-growth only. A null URL, or one without ``://``,
has an empty host and path, no tokens, and is allowed. Repeated rows and ids count by
themselves; labels of unknown ids are ignored, and an id is bad if any of its labels is.
"""

from __future__ import annotations

import string

from pyspark.ml.fpm import FPGrowth
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillbridge.llm.common import Scratch

# Host, path, verdict.
RULES = (
    ("com", "/", "allow"),
    ("example.com", "/en/", "block"),
    ("www.example.com", "/en/", "allow"),
    ("net", "/es/", "block"),
    ("net", "/fr/", "block"),
)
MIN_SUPPORT = 0.002
MIN_COUNT = 25  # labelled URLs that hold a mined rule's tokens and are bad, at least
MIN_CONFIDENCE = 0.8
BAD = "class=block"


def parts(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path."""
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substring(url, at + 3, F.char_length(url))).otherwise("")
    rest = F.coalesce(rest, F.lit(""))
    host = F.regexp_extract(rest, r"^[^/?#]*", 0)
    path = F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)
    return F.translate(host, string.ascii_uppercase, string.ascii_lowercase), path


def fitting(host: Column, path: Column, rules=RULES) -> tuple[Column, Column]:
    """The longest fitting rule and its verdict, or nulls."""
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for h, p, says in sorted(rules, key=lambda r: len(r[0] + r[1])):  # the last that fits wins
        fits = ((host == h) | host.endswith("." + h)) & path.startswith(p)
        rule, verdict = F.when(fits, h + p).otherwise(rule), F.when(fits, says).otherwise(verdict)
    return rule, verdict


def tokens(url: Column, host: Column, path: Column) -> Column:
    """Distinct tokens of a URL; none without a host."""
    labels = F.split(F.regexp_replace(host, r":\d*$", ""), r"\.")
    segments = F.filter(F.split(path, "/"), lambda s: s != "")
    names = F.regexp_extract_all(F.regexp_extract(url, r"\?([^#]*)", 1), F.lit(r"(?:^|&)([^=&]+)"), 1)

    def named(prefix, values):
        return F.transform(values, lambda v: F.concat(F.lit(prefix), F.regexp_replace(v, r"\d+", "#")))

    found = F.concat(
        F.array(F.concat(F.lit("scheme="), F.lower(F.substring_index(url, "://", 1))),
                F.concat(F.lit("site="), F.array_join(F.slice(labels, F.greatest(F.size(labels) - 1, F.lit(1)), 2), "."))),
        named("label=", labels), named("path=", segments), named("query=", names),
        F.filter(F.array(F.concat(F.lit("ending="), F.regexp_extract(path, r"\.([A-Za-z]+)$", 1))), lambda e: e != "ending="))
    empty = F.array().cast("array<string>")
    return F.when(host != "", F.array_distinct(found)).otherwise(empty)


def mine(labelled: DataFrame, min_support: float, min_count: int, min_confidence: float):
    """Rules (rule_id, antecedent, rarest) from columns items (array) and bad (boolean)."""
    rows = labelled.where(F.size("items") > 0)
    items = rows.select(F.when(F.col("bad"), F.concat("items", F.array(F.lit(BAD)))).otherwise(F.col("items")).alias("items"))
    many = items.count()
    if not many:
        return None
    model = FPGrowth(itemsCol="items", minSupport=min(1.0, max(min_support, min_count / many)),
                     minConfidence=min_confidence).fit(items)
    rules = model.associationRules.where(F.col("consequent") == F.array(F.lit(BAD))).select(
        "antecedent", "confidence", F.monotonically_increasing_id().alias("rule_id"))
    counts = model.freqItemsets.where(F.size("items") == 1).select(F.col("items")[0].alias("token"), "freq")
    rarest = (rules.select("rule_id", F.explode("antecedent").alias("token")).join(counts, "token")
              .groupBy("rule_id").agg(F.min(F.struct("freq", "token")).alias("least")))
    return rules.join(rarest, "rule_id").select("antecedent", "confidence", F.col("least.token").alias("token"))


def judge(pages: DataFrame, labels: DataFrame, id_column: str = "page_id", url: str = "url", label_id: str = "doc_id",
          bad: Column | None = None, rules=RULES, min_support: float = MIN_SUPPORT, min_count: int = MIN_COUNT,
          min_confidence: float = MIN_CONFIDENCE) -> DataFrame:
    """One row per page: id, host, path, rule (or null), verdict, and how sure a mined rule is (or null)."""
    scratch = Scratch(pages.sparkSession, "urls")
    bad = (F.col("toxic") == 1) | (F.col("quality") == 0) if bad is None else bad
    host, path = parts(F.col("url"))
    source = pages.select(F.col(id_column), F.col(url).cast("string").alias("url")).withColumns({"host": host, "path": path})
    known = (labels.where(F.col(label_id).isNotNull()).groupBy(F.col(label_id).alias("_id"))
             .agg(F.max(F.coalesce(bad, F.lit(False))).alias("bad")))
    items = tokens(F.col("url"), F.col("host"), F.col("path")).alias("items")
    labelled = scratch.keep(source.join(known, source[id_column] == known["_id"]).select(items, "bad"), "labelled")
    mined = mine(labelled, min_support, min_count, min_confidence)
    rule, verdict = fitting(F.col("host"), F.col("path"), rules)
    judged = source.withColumns({"rule": rule, "said": verdict})
    if mined is None:
        blocked = None
    else:
        index = scratch.keep(mined, "rules")
        distinct = judged.where("said IS NULL AND host <> ''").select("url", "host", "path").distinct().select("url", items)
        blocked = (distinct.select("url", "items", F.explode("items").alias("token")).join(index, "token")
                   .where(F.size(F.array_except("antecedent", "items")) == 0)
                   .groupBy("url").agg(F.max("confidence").alias("confidence")))
    if blocked is None:
        judged = judged.withColumn("confidence", F.lit(None).cast("double"))
    else:
        judged = judged.join(blocked, "url", "left")
    return judged.select(id_column, "host", "path", "rule", F.coalesce(
        "said", F.when(F.col("confidence").isNotNull(), "block").otherwise("allow")).alias("verdict"),
        F.when(F.col("said").isNull(), F.col("confidence")).alias("confidence"))
