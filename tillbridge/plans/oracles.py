"""The queries once more as SQL for DuckDB, over the same tables.

Written apart from the Spark code: duplicates are judged by grouping, the as-of look-up is
an ASOF join, conversions multiply out in 128-bit integers.
"""

from __future__ import annotations

_BASES = {
    "orders": "SELECT o_orderkey AS k, o_orderdate AS t, CAST(round(o_totalprice * 100) AS BIGINT) AS c FROM orders",
    "events": "SELECT event_id AS k, ts AS t, CAST(round(value * 100) AS BIGINT) AS c FROM events",
}
_FORMAT = "'%Y-%m-%d %H:%M:%S'"


def _raw(base: str) -> str:
    return f"""
base AS ({_BASES[base]}),
copies AS (
  SELECT k, t, c, 0 AS copy FROM base
  UNION ALL SELECT k, t, c, 1 FROM base WHERE k % 37 = 0
  UNION ALL SELECT k, t, c + 100, 2 FROM base WHERE k % 53 = 0),
texts AS (
  SELECT k, copy, t, CAST(t AS DATE) AS batch_date,
    (c // 100)::VARCHAR || '.' || lpad((c % 100)::VARCHAR, 2, '0') AS plain,
    CASE WHEN k % 101 = 0 THEN 'not-a-date'
         WHEN k % 103 = 0 THEN strftime(t + INTERVAL 1 DAY, {_FORMAT})
         ELSE strftime(t, {_FORMAT}) END AS dtts,
    CASE WHEN k % 107 = 0 THEN 'unknown'
         ELSE ['bkk', 'central', 'north', 'northeast', 'south'][k % 5 + 1] END AS region
  FROM copies),
delivered AS (
  SELECT k, copy, batch_date, dtts, region,
    CASE WHEN k % 113 = 0 THEN '  ' ELSE ' TX-' || k || ' ' END AS txn,
    CASE WHEN k % 97 = 0 THEN 'N/A' WHEN k % 89 = 0 THEN '-' || plain WHEN k % 83 = 0 THEN ''
         WHEN k % 109 = 0 THEN plain || '00000000' ELSE plain END AS amount,
    CASE WHEN k % 41 = 0 THEN 'JPY' WHEN k % 4 = 0 THEN 'THB' WHEN k % 4 = 1 THEN ' usd '
         WHEN k % 4 = 2 THEN 'EUR' ELSE 'thb' END AS currency,
    'transactions/business_date=' || strftime(batch_date, '%Y-%m-%d') || '/sales_' || region
      || '_' || strftime(batch_date, '%Y%m%d') || '.csv.gz' AS source_file,
    k * 3 + copy + 1 AS source_row_number
  FROM texts),
raw AS (
  SELECT *, sha256(source_file) AS source_checksum,
    sha256(source_file || '|' || sha256(source_file) || '|' || source_row_number) AS source_row_id
  FROM delivered),
dates AS (SELECT DISTINCT CAST(t AS DATE) AS batch_date FROM base)"""


_NUMERIC = r"""
    regexp_full_match({t}, '[+-]?([0-9]+(\.[0-9]*)?|\.[0-9]+)([eE][+-]?[0-9]+)?') AS is_number,
    length(regexp_extract({t}, '\.([0-9]*)', 1))
      - coalesce(try_cast(regexp_extract({t}, '[eE]([+-]?[0-9]+)$', 1) AS INT), 0) AS scale,
    greatest(length(regexp_replace(regexp_replace(regexp_replace({t}, '[eE].*$', ''),
      '[^0-9]', '', 'g'), '^0+', '')), 1) AS digits"""

_CLASSIFIED = f"""
stripped AS (
  SELECT *, trim(txn) AS txn_id, upper(trim(currency)) AS currency_code,
    replace(trim(amount), '_', '') AS a,
    CASE WHEN regexp_full_match(trim(dtts), '[0-9]{{4}}-[0-9]{{2}}-[0-9]{{2}} [0-9]{{2}}:[0-9]{{2}}:[0-9]{{2}}')
         THEN try_strptime(trim(dtts), {_FORMAT}) END AS transaction_dt
  FROM raw),
measured AS (SELECT *, {_NUMERIC.format(t='a')} FROM stripped),
typed AS (
  SELECT *, CASE WHEN is_number AND scale <= 9 AND greatest(digits - scale, 0) <= 29
    THEN try_cast(a AS DECIMAL(38,9)) END AS amount_numeric FROM measured),
canonical AS (
  SELECT *, list_filter([
      CASE WHEN txn_id = '' THEN 'MISSING_TXN' END,
      CASE WHEN transaction_dt IS NULL THEN 'INVALID_DTTS' END,
      CASE WHEN CAST(transaction_dt AS DATE) <> batch_date THEN 'DTTS_BATCH_DATE_MISMATCH' END,
      CASE WHEN amount_numeric IS NULL THEN 'INVALID_AMOUNT' END,
      CASE WHEN amount_numeric < 0 THEN 'NEGATIVE_AMOUNT' END,
      CASE WHEN currency_code NOT IN ('THB', 'USD', 'EUR') THEN 'INVALID_CURRENCY' END,
      CASE WHEN region NOT IN ('bkk', 'central', 'north', 'northeast', 'south') THEN 'INVALID_REGION' END],
    lambda r: r IS NOT NULL) AS base_reasons FROM typed),
payloads AS (
  SELECT batch_date, txn_id, count(*) AS payloads FROM (
    SELECT DISTINCT batch_date, txn_id, transaction_dt, amount_numeric, currency_code, region
    FROM canonical WHERE len(base_reasons) = 0) GROUP BY ALL),
winners AS (
  SELECT batch_date, txn_id, arg_min(source_row_id, (source_file, source_row_number)) AS winner
  FROM canonical WHERE len(base_reasons) = 0 GROUP BY ALL),
judged AS (
  SELECT c.*, CASE WHEN len(base_reasons) > 0 THEN NULL
                   WHEN payloads > 1 THEN 'DUPLICATE_CONFLICT'
                   WHEN winner <> source_row_id THEN 'DUPLICATE_REPLAY' END AS duplicate_reason
  FROM canonical c LEFT JOIN payloads USING (batch_date, txn_id) LEFT JOIN winners USING (batch_date, txn_id)),
classified AS (
  SELECT *, CASE WHEN duplicate_reason IS NULL THEN base_reasons ELSE [duplicate_reason] END AS reasons,
    len(base_reasons) = 0 AND duplicate_reason IS NULL AS accepted FROM judged),
accepted AS (
  SELECT txn_id AS txn, transaction_dt, amount_numeric AS amount, currency_code AS currency, region,
    source_file, source_checksum, source_row_number, source_row_id, batch_date
  FROM classified WHERE accepted)"""

_FX = """
fx_days AS (
  SELECT batch_date AS rate_date, date_diff('day', DATE '1970-01-01', batch_date) AS n FROM dates
  WHERE isodow(batch_date) <= 5 AND date_diff('day', DATE '1970-01-01', batch_date) % 11 <> 0),
fx_pairs AS (
  SELECT rate_date, n, 'EUR' AS code, 360000 + (n * 53) % 50000 AS r, 1 AS line FROM fx_days
  UNION ALL SELECT rate_date, n, 'USD', 300000 + (n * 37) % 40000, 2 FROM fx_days),
raw_fx AS (
  SELECT *, sha256(source_file || '|' || sha256(source_file) || '|' || line) AS source_row_id FROM (
    SELECT rate_date, line,
      CASE WHEN n % 43 = 0 THEN rate_date + 1 ELSE rate_date END AS stated,
      CASE WHEN n % 29 = 0 AND code = 'EUR' THEN 'GBP' ELSE lower(code) || ' ' END AS currency,
      CASE WHEN n % 31 = 0 AND code = 'USD' THEN 'N/A'
           ELSE (r // 10000)::VARCHAR || '.' || lpad((r % 10000)::VARCHAR, 4, '0')
             || CASE WHEN n % 47 = 0 THEN '123455' ELSE '' END END AS mid_rate,
      'fx/' || strftime(rate_date, '%Y/%m') || '/fx_' || strftime(rate_date, '%Y%m%d') || '.csv' AS source_file
    FROM fx_pairs)),
fx_rated AS (
  SELECT *, upper(trim(currency)) AS code, try_cast(mid_rate AS DECIMAL(38,10)) AS exact,
    CASE WHEN mid_rate LIKE '%.__________' THEN
      (replace(mid_rate, '.', '')::HUGEINT // 10
       + CASE WHEN replace(mid_rate, '.', '')::HUGEINT % 10 > 5 THEN 1
              WHEN replace(mid_rate, '.', '')::HUGEINT % 10 = 5 THEN (replace(mid_rate, '.', '')::HUGEINT // 10) % 2
              ELSE 0 END)
    ELSE try_cast(try_cast(mid_rate AS DECIMAL(38,9)) * 1000000000 AS HUGEINT) END AS units
  FROM raw_fx),
publications AS (
  SELECT rate_date,
    max(units) FILTER (code = 'USD') AS usd, max(units) FILTER (code = 'EUR') AS eur,
    CASE WHEN count(*) <> 2 OR count(*) FILTER (code = 'USD') <> 1 OR count(*) FILTER (code = 'EUR') <> 1
         THEN 'NOT_EXACT_PAIR'
         WHEN NOT bool_and(stated = rate_date) THEN 'RATE_DATE_MISMATCH'
         WHEN NOT bool_and(coalesce(units > 0, false)) THEN 'INVALID_RATE'
         ELSE 'OK' END AS fx_status
  FROM fx_rated GROUP BY rate_date)"""


def _effective(dates: str = "dates") -> str:
    return f"""
effective AS (
  SELECT d.batch_date, p.rate_date AS fx_rate_date,
    CASE WHEN fx_status = 'OK' THEN usd END AS usd, CASE WHEN fx_status = 'OK' THEN eur END AS eur,
    p.rate_date < d.batch_date AS is_carried_forward,
    CAST(date_diff('day', p.rate_date, d.batch_date) AS INT) AS staleness_days,
    coalesce(fx_status, 'NO_PUBLICATION') AS fx_status
  FROM {dates} d ASOF LEFT JOIN publications p ON d.batch_date >= p.rate_date)"""


def _text(units: str, places: int = 9) -> str:
    """A count of 10^-places units as decimal text."""
    one = 10**places
    return (f"(({units}) // {one})::VARCHAR || '.' || lpad((({units}) % {one})::VARCHAR, {places}, '0')")


def _rounded(numerator: str, denominator: str) -> str:
    """Quotient rounded half-even."""
    n, d = f"({numerator})", f"({denominator})"
    return (f"({n} // {d} + CASE WHEN 2 * ({n} % {d}) > {d} THEN 1 "
            f"WHEN 2 * ({n} % {d}) = {d} THEN ({n} // {d}) % 2 ELSE 0 END)")


def _fact(factor: int = 1) -> str:
    """Amounts in 1e-9 THB, USD and EUR. Rates have at most ten digits after the point, so
    the product of amount and rate stays below 2^127."""
    return f"""
rated AS (
  SELECT a.*, e.* EXCLUDE (batch_date),
    CAST(CAST(amount * 100 AS HUGEINT) AS HUGEINT) * 10000000 * {factor} AS units,
    CASE currency WHEN 'THB' THEN 1000000000::HUGEINT WHEN 'USD' THEN usd ELSE eur END AS own_rate
  FROM accepted a JOIN effective e USING (batch_date) WHERE fx_status = 'OK'),
fact AS (
  SELECT *, {_rounded('units * own_rate', '1000000000::HUGEINT')} AS thb,
    CASE WHEN currency = 'USD' THEN units ELSE {_rounded('units * own_rate', 'usd')} END AS usd_units,
    CASE WHEN currency = 'EUR' THEN units ELSE {_rounded('units * own_rate', 'eur')} END AS eur_units
  FROM rated)"""


def _with(select: str, *parts: str) -> str:
    return "WITH " + ",".join(parts) + "\n" + select


_ORDERS, _EVENTS = _raw("orders"), _raw("events")
_FULL = (_ORDERS, _CLASSIFIED, _FX, _effective(), _fact())

_COUNTS = ("source_file, count(*) AS n", "GROUP BY source_file")
_INVENTORY = """
inventory AS (
  SELECT source_file, count(*) AS n, sha256(source_file || '|' || count(*)) AS sha FROM raw GROUP BY source_file)"""

_AMOUNTS = f"""{_text('units')} AS amount, {_text('thb')} AS amount_thb,
  {_text('usd_units')} AS amount_usd, {_text('eur_units')} AS amount_eur"""

_TOTALS = ", ".join(
    [f"count(*) AS transactions"]
    + [f"{_text(f'sum({u})::HUGEINT')} AS total_{c}" for c, u in (("thb", "thb"), ("usd", "usd_units"), ("eur", "eur_units"))]
    + [f"{_text(_rounded(f'sum({u})::HUGEINT', '10000000::HUGEINT'), 2)} AS report_{c}"
       for c, u in (("thb", "thb"), ("usd", "usd_units"), ("eur", "eur_units"))])

_REASONS = "array_to_string(reasons, '|') AS reason_codes"

_RUNS = """
run_rows AS (
  SELECT 'run-' || attempt AS run_id, batch_date, attempt,
    CASE WHEN attempt = 1 OR date_diff('day', DATE '1970-01-01', batch_date) % 7 = 0
         THEN 'FAILED' ELSE 'SUCCESS' END AS status
  FROM dates, (VALUES (1), (2)) v(attempt)),
latest AS (
  SELECT batch_date, arg_max(status, attempt) AS status, arg_max(run_id, attempt) AS run_id
  FROM run_rows GROUP BY batch_date),
shown AS (SELECT * FROM fact SEMI JOIN (SELECT batch_date FROM latest WHERE status = 'SUCCESS') g USING (batch_date))"""

_OUTLIERS = f"""
limits AS (
  SELECT batch_date, currency, {_rounded('5 * sum(CAST(amount * 100 AS HUGEINT))::HUGEINT * 10000000', 'count(*)::HUGEINT')} AS threshold
  FROM accepted GROUP BY ALL),
flagged AS (
  SELECT a.*, threshold, CAST(amount * 100 AS HUGEINT) * 10000000 > threshold AS is_outlier
  FROM accepted a JOIN limits USING (batch_date, currency))"""

_REGION = r"""CASE WHEN regexp_full_match(source_file,
    'transactions/business_date=[0-9-]{10}/sales_(bkk|central|north|northeast|south)_[0-9]{8}\.csv\.gz')
    THEN regexp_extract(source_file, 'sales_([a-z]+)_', 1) END"""

ORACLES = {
    "src_row_identity": _with(
        "SELECT source_file, source_checksum, source_row_number, source_row_id FROM raw", _ORDERS),
    "src_path_fields": _with(
        f"SELECT DISTINCT source_file, batch_date::VARCHAR AS batch_date, {_REGION} AS region FROM raw", _ORDERS),
    "src_completeness": _with(f"""
        SELECT d.batch_date::VARCHAR AS batch_date, r.region, NULL::VARCHAR AS source_file, 'MISSING' AS problem
        FROM dates d, (VALUES ('bkk'), ('central'), ('north'), ('northeast'), ('south')) r(region)
        WHERE NOT EXISTS (SELECT 1 FROM raw x WHERE x.batch_date = d.batch_date AND x.region = r.region)
        UNION ALL
        SELECT DISTINCT batch_date::VARCHAR, NULL, source_file, 'UNEXPECTED' FROM raw WHERE region = 'unknown'""", _ORDERS),
    "src_fx_status": _with("""
        SELECT batch_date::VARCHAR AS batch_date,
          CASE WHEN batch_date IN (SELECT rate_date FROM raw_fx) THEN 'LOADED' ELSE 'NO_NEW_RATE' END AS fx_status
        FROM dates""", _ORDERS, _FX),
    "src_checksums": _with("""
        SELECT source_file, CASE n % 5 WHEN 0 THEN 'MISSING_CHECKSUM' WHEN 2 THEN 'MISSING_CHECKSUM'
          WHEN 1 THEN 'CHECKSUM_MISMATCH' ELSE 'OK' END AS problem FROM inventory""", _EVENTS, _INVENTORY),
    "src_file_hashes": _with("""
        SELECT batch_date::VARCHAR AS business_date, region, strlen(whole)::BIGINT AS length, sha256(whole) AS sha256 FROM (
          SELECT batch_date, region, string_agg(concat_ws(',', txn, dtts, amount, currency) || chr(10), '' ORDER BY source_row_number) AS whole
          FROM raw WHERE region <> 'unknown' GROUP BY ALL)""", _EVENTS),
    "src_file_verdicts": _with("""
        SELECT batch_date::VARCHAR AS business_date, region,
          count(*) AS rows,
          count(*) FILTER (source_row_number % 50 IN (0, 1)) AS malformed_rows,
          NOT (region = 'north' AND day(batch_date) % 5 = 0) AS header_ok
        FROM raw WHERE region <> 'unknown' GROUP BY ALL""", _EVENTS),
    "src_landing_diff": _with("""
        SELECT source_file AS object_name, CASE n % 4 WHEN 0 THEN 'UPLOAD' WHEN 1 THEN 'CONFLICT_CHECKSUM'
          WHEN 2 THEN 'CONFLICT_NO_CHECKSUM' ELSE 'SKIP' END AS action
        FROM inventory WHERE source_file NOT LIKE '%unknown%'""", _EVENTS, _INVENTORY),
    "src_landing_subset": _with("""
        SELECT 'transaction' AS kind, min(source_file) AS object_name FROM raw
        UNION ALL SELECT 'fx', min(source_file) FROM raw_fx
        UNION ALL SELECT 'manifest', 'manifests/daily_source_manifest.csv'
        UNION ALL SELECT 'manifest', 'manifests/fx_manifest.csv'""", _EVENTS, _FX),
    "src_manifest_stats": _with("""
        SELECT batch_date::VARCHAR AS batch_date, region, source_file, count(*) AS rows,
          min(dtts) AS min_dtts, max(dtts) AS max_dtts FROM raw GROUP BY ALL""", _EVENTS),
    "src_source_rules": _with("""
        SELECT source_file AS file_path, rule, count(*) AS rows, min(dtts) AS first_detail FROM (
          SELECT *, CASE WHEN dtts = 'not-a-date' THEN 'INVALID_DTTS'
            WHEN left(dtts, 10) <> batch_date::VARCHAR THEN 'WRONG_DATE' END AS rule FROM raw)
        WHERE rule IS NOT NULL GROUP BY ALL""", _EVENTS),
    "src_file_rules": _with("""
        , names AS (SELECT DISTINCT batch_date, region, replace(source_file, 'transactions/', '') AS file_path FROM raw),
        found AS (
          SELECT batch_date, count(*) AS n,
            list_filter(['bkk', 'central', 'north', 'northeast', 'south'],
              lambda r: NOT list_contains(list(region), r)) AS missing
          FROM names GROUP BY batch_date)
        SELECT file_path, 'BAD_FILE_NAME' AS rule, NULL::VARCHAR AS detail FROM names WHERE region = 'unknown'
        UNION ALL
        SELECT 'business_date=' || batch_date, CASE WHEN len(missing) > 0 THEN 'MISSING_REGION' ELSE 'FILE_COUNT' END,
          array_to_string(missing, '|') FROM found WHERE len(missing) > 0 OR n <> 5""", _ORDERS),
    "src_corpus_summary": _with("""
        SELECT count(DISTINCT batch_date) AS business_dates, count(DISTINCT source_file) AS files,
          count(*) AS rows, min(batch_date)::VARCHAR AS start_date, max(batch_date)::VARCHAR AS end_date
        FROM raw""", _EVENTS),
    "src_daily_split": _with("""
        SELECT left(dtts, 10) AS business_date, region, count(*) AS rows, min(dtts) AS min_dtts, max(dtts) AS max_dtts
        FROM raw WHERE dtts <> 'not-a-date' AND region <> 'unknown' GROUP BY ALL""", _EVENTS),
    "src_csv_scan": _with("""
        SELECT batch_date::VARCHAR AS batch_date, region,
          row_number() OVER (PARTITION BY batch_date, region ORDER BY source_row_number) AS source_row_number,
          txn, dtts, amount, currency
        FROM raw WHERE region <> 'unknown'""", _EVENTS),
    "src_partition_read": _with(
        "SELECT batch_date::VARCHAR AS batch_date, source_row_id FROM raw WHERE isodow(batch_date) = 1", _EVENTS),
    "src_read_through": _with(
        "SELECT rate_date::VARCHAR AS rate_date, currency, mid_rate, source_row_id FROM raw_fx "
        "WHERE rate_date <= (SELECT max(batch_date) FROM dates) - 10", _EVENTS, _FX),
    "sink_anti_join": _with(
        "SELECT batch_date::VARCHAR AS batch_date, source_row_id FROM accepted", _ORDERS, _CLASSIFIED),
    "sink_idempotent_append": _with("""
        SELECT txn, dtts, amount, currency, region, source_file, source_checksum, source_row_number,
          source_row_id, batch_date::VARCHAR AS batch_date FROM raw""", _EVENTS),
    "sink_json": _with(f"""
        SELECT '{{"source_row_id":"' || source_row_id || '","batch_date":"' || batch_date
          || '","transaction_dt":"' || strftime(transaction_dt, '%Y-%m-%dT%H:%M:%S.%g')
          || '","amount_thb":"' || {_text('thb')} || '","is_carried_forward":' || is_carried_forward || '}}' AS json
        FROM fact""", *_FULL),
    "fn_strip_upper": _with("""
        SELECT source_row_id, trim(txn) AS txn_id, trim(txn) = '' AS missing, upper(trim(currency)) AS currency_code
        FROM raw""", _ORDERS),
    "fn_parse_timestamp": """
        WITH base AS (SELECT event_id AS k, ts AS t, date_trunc('second', ts) AS s FROM events)
        SELECT k, CASE k % 9
            WHEN 0 THEN strftime(t, '%Y-%-m-%-d %-H:%-M:%-S')
            WHEN 1 THEN strftime(t, '%Y-%m-%d') WHEN 2 THEN strftime(t, '%Y-%m-%dT%H:%M:%S')
            WHEN 3 THEN strftime(t, '%Y-%m-%d %H:%M:60') WHEN 4 THEN strftime(t, '%Y-%m-%d  %H:%M:%S')
            WHEN 5 THEN strftime(t, '15%y-%m-%d %H:%M:%S') WHEN 6 THEN strftime(t, '%Y-02-30 00:00:00')
            ELSE strftime(t, '%Y-%m-%d %H:%M:%S') END AS dtts,
          CASE WHEN k % 9 IN (1, 2, 5, 6) THEN NULL
            WHEN k % 9 = 3 THEN strftime(date_trunc('minute', t) + INTERVAL 1 MINUTE, '%Y-%m-%d %H:%M:%S')
            ELSE strftime(s, '%Y-%m-%d %H:%M:%S') END AS transaction_dt FROM base""",
    "fn_parse_numeric": f"""
        WITH texts AS (
          SELECT kind, CASE kind WHEN 0 THEN p WHEN 1 THEN '+' || p WHEN 2 THEN c || 'E-2'
            WHEN 3 THEN p || '0000000' WHEN 4 THEN p || '00000000' WHEN 5 THEN c || 'e3'
            WHEN 6 THEN '1_' || p WHEN 7 THEN c || 'E+27' WHEN 8 THEN '.' || c ELSE '-' || p || ' x' END AS amount
          FROM (SELECT (l_orderkey * 7 + l_linenumber) % 10 AS kind, c,
                  (c // 100)::VARCHAR || '.' || lpad((c % 100)::VARCHAR, 2, '0') AS p
                FROM (SELECT *, CAST(round(l_extendedprice * 100) AS BIGINT) AS c FROM lineitem))),
        measured AS (SELECT *, replace(amount, '_', '') AS a, {_NUMERIC.format(t="replace(amount, '_', '')")} FROM texts),
        parsed AS (
          SELECT *, CASE WHEN is_number AND scale <= 9 AND greatest(digits - scale, 0) <= 29
            THEN try_cast(a AS DECIMAL(38,9)) END AS value FROM measured)
        SELECT kind, count(*) AS rows, count(value) AS valid,
          sum(value)::DECIMAL(38,9)::VARCHAR AS total, max(amount) AS example
        FROM parsed GROUP BY kind""",
    "fn_parse_rate": _with(
        f"SELECT source_row_id, mid_rate, {_text('units')} AS rate FROM fx_rated", _ORDERS, _FX),
    "fn_round_half_even": f"""
        WITH exact AS (
          SELECT l_returnflag, l_linestatus, CAST(round(l_extendedprice * 100) AS HUGEINT)
            * CAST(round(l_discount * 100) AS HUGEINT) * CAST(round(l_tax * 100) AS HUGEINT) AS millionths
          FROM lineitem),
        rounded AS (SELECT *, {_rounded('millionths', '100::HUGEINT')} AS r FROM exact)
        SELECT l_returnflag, l_linestatus, count(*) AS rows, {_text('sum(r)::HUGEINT', 4)} AS total
        FROM rounded GROUP BY ALL""",
    "cls_base_reasons": _with("""
        SELECT source_row_id, txn_id, strftime(transaction_dt, '%Y-%m-%d %H:%M:%S') AS transaction_dt,
          amount_numeric::VARCHAR AS amount_numeric, currency_code, array_to_string(base_reasons, '|') AS base_reasons
        FROM canonical""", _ORDERS, _CLASSIFIED),
    "cls_classified": _with(
        f"SELECT source_row_id, batch_date::VARCHAR AS batch_date, accepted, {_REASONS} FROM classified",
        _ORDERS, _CLASSIFIED),
    "cls_accepted": _with("""
        SELECT txn, strftime(transaction_dt, '%Y-%m-%d %H:%M:%S') AS transaction_dt, amount::VARCHAR AS amount,
          currency, region, source_file, source_checksum, source_row_number, source_row_id,
          batch_date::VARCHAR AS batch_date FROM accepted""", _ORDERS, _CLASSIFIED),
    "cls_quarantine": _with(f"""
        SELECT txn, dtts, amount, currency, region, source_file, source_checksum, source_row_number, source_row_id,
          batch_date::VARCHAR AS batch_date, {_REASONS} FROM classified WHERE NOT accepted""", _ORDERS, _CLASSIFIED),
    **{name: _with(f"""
        SELECT batch_date::VARCHAR AS batch_date, txn_id, source_file, source_row_number, duplicate_reason
        FROM judged WHERE duplicate_reason = '{reason}'""", _ORDERS, _CLASSIFIED)
       for name, reason in (("cls_conflicts", "DUPLICATE_CONFLICT"), ("cls_replays", "DUPLICATE_REPLAY"))},
    "cls_reason_counts": _with("""
        SELECT batch_date::VARCHAR AS batch_date, reason_code, count(*) AS rows
        FROM (SELECT batch_date, unnest(reasons) AS reason_code FROM classified) GROUP BY ALL""", _ORDERS, _CLASSIFIED),
    "cls_balance": _with("""
        SELECT batch_date::VARCHAR AS batch_date, count(*) AS classified_rows,
          count(*) FILTER (accepted) AS accepted_rows, count(*) FILTER (NOT accepted) AS quarantine_rows
        FROM classified GROUP BY ALL""", _ORDERS, _CLASSIFIED),
    "cls_outliers": _with(f"""
        SELECT source_row_id, amount::VARCHAR AS amount, {_text('threshold')} AS outlier_threshold, is_outlier
        FROM flagged""", _EVENTS, _CLASSIFIED, _OUTLIERS),
    "fx_publications": _with(f"""
        SELECT rate_date::VARCHAR AS rate_date, {_text('usd')} AS usd_thb_rate, {_text('eur')} AS eur_thb_rate,
          fx_status FROM publications""", _ORDERS, _FX),
    "fx_asof": _with(f"""
        SELECT batch_date::VARCHAR AS batch_date, fx_rate_date::VARCHAR AS fx_rate_date,
          {_text('usd')} AS usd_thb_rate, {_text('eur')} AS eur_thb_rate, is_carried_forward, staleness_days, fx_status
        FROM effective""", _ORDERS, _FX, _effective()),
    "fx_staleness": _with("""
        SELECT fx_status, staleness_days, is_carried_forward, count(*) AS dates FROM effective GROUP BY ALL""",
        _ORDERS, _FX, _effective()),
    "fx_daily_dim": _with(f"""
        SELECT batch_date::VARCHAR AS business_date, currency, fx_rate_date::VARCHAR AS rate_date,
          CASE currency WHEN 'USD' THEN {_text('usd')} ELSE {_text('eur')} END AS thb_rate,
          is_carried_forward, staleness_days, fx_status
        FROM effective, (VALUES ('USD'), ('EUR')) v(currency)""", _ORDERS, _FX, """
calendar AS (
  SELECT CAST(unnest(generate_series(min(batch_date), max(batch_date), INTERVAL 1 DAY)) AS DATE) AS batch_date
  FROM dates)""", _effective("calendar")),
    "fact_convert": _with(f"SELECT source_row_id, currency, {_AMOUNTS} FROM fact", *_FULL),
    "fact_convert_large": _with(
        f"SELECT source_row_id, currency, {_AMOUNTS} FROM fact",
        _ORDERS, _CLASSIFIED, _FX, _effective(), _fact(10**12)),
    "fact_full": _with(f"""
        SELECT txn, strftime(transaction_dt, '%Y-%m-%d %H:%M:%S') AS transaction_dt, currency, region, source_file,
          source_checksum, source_row_number, source_row_id, batch_date::VARCHAR AS batch_date, {_AMOUNTS},
          fx_rate_date::VARCHAR AS fx_rate_date, {_text('usd')} AS usd_thb_rate, {_text('eur')} AS eur_thb_rate,
          is_carried_forward, staleness_days FROM fact""", *_FULL),
    "fact_excluded_dates": _with("""
        SELECT batch_date::VARCHAR AS batch_date, fx_status, count(*) AS excluded_rows
        FROM accepted JOIN effective USING (batch_date) WHERE fx_status <> 'OK' GROUP BY ALL""",
        _ORDERS, _CLASSIFIED, _FX, _effective()),
    "fact_prechecks": _with("""
        , ids AS (
          SELECT batch_date, CASE WHEN txn_id = '' THEN '' ELSE batch_date || '-' || txn_id END AS id, count(*) AS n,
            count(*) FILTER (coalesce(amount_numeric < 0, true)) AS bad_amounts,
            count(*) FILTER (currency_code NOT IN ('THB', 'USD', 'EUR')) AS bad_currencies
          FROM classified GROUP BY ALL)
        SELECT batch_date::VARCHAR AS batch_date, coalesce(sum(n) FILTER (id = ''), 0)::BIGINT AS blank_ids,
          coalesce(sum(n - 1) FILTER (id <> ''), 0)::BIGINT AS repeated_ids, sum(bad_amounts)::BIGINT AS bad_amounts,
          sum(bad_currencies)::BIGINT AS bad_currencies, 0::BIGINT AS overflows
        FROM ids GROUP BY batch_date""", _ORDERS, _CLASSIFIED),
    "set_except_both": _with("""
        SELECT batch_date::VARCHAR AS batch_date, source_row_id, 'LEFT_ONLY' AS side
        FROM classified WHERE NOT accepted""", _ORDERS, _CLASSIFIED),
    "set_differing_dates": _with("""
        SELECT DISTINCT batch_date::VARCHAR AS batch_date FROM classified
        WHERE NOT accepted AND day(batch_date) % 2 = 0""", _ORDERS, _CLASSIFIED),
    "set_except_right": _with("""
        SELECT batch_date::VARCHAR AS batch_date, source_row_id,
          CASE WHEN accepted THEN 'RIGHT_ONLY' ELSE 'LEFT_ONLY' END AS side
        FROM classified JOIN effective USING (batch_date)
        WHERE accepted <> (fx_status = 'OK')""", _ORDERS, _CLASSIFIED, _FX, _effective()),
    "rec_classification": _with("""
        SELECT batch_date::VARCHAR AS batch_date, count(*) AS raw_rows, count(*) FILTER (accepted) AS accepted_rows,
          count(*) FILTER (NOT accepted) AS quarantine_rows,
          count(*) = count(*) FILTER (accepted) + count(*) FILTER (NOT accepted) AS reconciled
        FROM classified GROUP BY ALL""", _ORDERS, _CLASSIFIED),
    "rec_fact": _with("""
        SELECT a.batch_date::VARCHAR AS batch_date, a.n AS accepted_rows, coalesce(f.n, 0) AS fact_rows,
          a.n = coalesce(f.n, 0) AS reconciled
        FROM (SELECT batch_date, count(*) AS n FROM accepted GROUP BY ALL) a
        LEFT JOIN (SELECT batch_date, count(*) AS n FROM fact GROUP BY ALL) f USING (batch_date)""", *_FULL),
    "rec_full_chain": _with("""
        SELECT r.batch_date::VARCHAR AS batch_date, r.n AS manifest_rows, r.n AS raw_rows, r.n AS raw_unique_rows,
          r.ok AS accepted_rows, r.n - r.ok AS quarantine_rows, coalesce(f.n, 0) AS fact_rows,
          0::BIGINT AS missing_fx_rows, r.n AS classified_rows, r.ok = coalesce(f.n, 0) AS quality_gate
        FROM (SELECT batch_date, count(*) AS n, count(*) FILTER (accepted) AS ok FROM classified GROUP BY ALL) r
        LEFT JOIN (SELECT batch_date, count(*) AS n FROM fact GROUP BY ALL) f USING (batch_date)""", *_FULL),
    "mart_daily_sales": _with(
        f"SELECT batch_date::VARCHAR AS batch_date, {_TOTALS} FROM fact GROUP BY batch_date", *_FULL),
    "mart_region_sales": _with(
        f"SELECT batch_date::VARCHAR AS batch_date, region, {_TOTALS} FROM fact GROUP BY batch_date, region", *_FULL),
    "mart_currency_summary": _with(f"""
        SELECT batch_date::VARCHAR AS batch_date, currency, {_text('sum(units)::HUGEINT')} AS total_original, {_TOTALS}
        FROM fact GROUP BY batch_date, currency""", *_FULL),
    "mart_data_quality": _with("""
        SELECT c.*, coalesce(w.n, 0) AS warning_rows FROM (
          SELECT batch_date::VARCHAR AS batch_date, count(*) AS raw_rows, count(*) FILTER (accepted) AS accepted_rows,
            count(*) FILTER (NOT accepted) AS quarantine_rows,
            count(*) FILTER (len(base_reasons) > 0) AS invalid_rows,
            count(*) FILTER (duplicate_reason = 'DUPLICATE_REPLAY') AS replay_rows,
            count(*) FILTER (duplicate_reason = 'DUPLICATE_CONFLICT') AS conflict_rows
          FROM classified GROUP BY ALL) c
        LEFT JOIN (SELECT batch_date::VARCHAR AS batch_date, count(*) FILTER (is_outlier) AS n FROM flagged GROUP BY ALL) w
        USING (batch_date)""", _EVENTS, _CLASSIFIED, _OUTLIERS),
    "pub_latest_runs": _with(
        "SELECT batch_date::VARCHAR AS batch_date, status, run_id FROM latest", *_FULL, _RUNS),
    "pub_gate": _with(
        f"SELECT batch_date::VARCHAR AS batch_date, source_row_id, {_text('thb')} AS amount_thb FROM shown", *_FULL, _RUNS),
    "pub_daily_sales": _with(
        f"SELECT batch_date::VARCHAR AS batch_date, {_TOTALS} FROM shown GROUP BY batch_date", *_FULL, _RUNS),
}
_EVENTS_FULL = (_EVENTS, *_FULL[1:])
ORACLES["pub_last_good"] = _with(
    f"SELECT batch_date::VARCHAR AS batch_date, source_row_id, {_text('thb')} AS amount_thb FROM fact "
    "WHERE day(batch_date) % 3 <> 0 OR source_row_number % 2 = 0", *_EVENTS_FULL)
ORACLES["mart_stored_daily_sales"] = _with(
    f"SELECT batch_date::VARCHAR AS batch_date, {_TOTALS} FROM fact "
    "WHERE day(batch_date) % 3 = 0 OR source_row_number % 2 = 0 GROUP BY batch_date", *_EVENTS_FULL)
ORACLES["cls_hot_ids"] = ORACLES["cls_classified"]
