"""SQL for DuckDB that gives the same rows as some of the queries.

Neighbour search, packing, alignment, and the language model have no SQL form here; tests
compare them with plain Python. Mined URL rules are left to tests as well.
"""

from __future__ import annotations

BEGIN, END = "chr(57344)", "chr(57345)"


def crc32(text: str) -> str:
    """CRC-32 of an ASCII string, bit by bit."""
    mixed = f"CASE WHEN b % 8 = 0 THEN xor(a, ascii(substr({text}, (b // 8 + 1)::INT, 1))::BIGINT) ELSE a END"
    step = f"xor(({mixed}) >> 1, CASE WHEN ({mixed}) & 1 = 1 THEN 3988292384::BIGINT ELSE 0 END)"
    return (f"xor(list_reduce(list_concat([4294967295::BIGINT], range(0, 8 * length({text}))::BIGINT[]), "
            f"lambda a, b: {step}), 4294967295::BIGINT)")


def parts(pattern: str) -> str:
    """Column ``whole`` cut before each match; a match ends at the mark within its part."""
    return f"string_split(regexp_replace(whole, '({pattern})', {BEGIN} || '\\1' || {END}, 'g'), {BEGIN})"


def spans(kind: str, number: int, keep: str) -> str:
    """List of (start, kind number, match, kind) from the parts of one kind."""
    return f"""list_filter(list_transform(range(2, len(p_{kind}) + 1), lambda i:
      {{'s': (list_sum(list_transform(p_{kind}[1:i - 1], lambda x: length(x))) - i + 2)::BIGINT,
        'n': {number}, 'm': split_part(p_{kind}[i], {END}, 1), 'k': '{kind}',
        'c': lower(right(p_{kind}[i - 1], 40) || ' ' || left(split_part(p_{kind}[i], {END}, 2), 40))}}),
      lambda f: {keep.replace('{m}', "f['m']")})"""


DIGITS = "regexp_replace({m}, '[^0-9]', '', 'g')"
LUHN = f"""(length({DIGITS}) BETWEEN 16 AND 19 AND list_sum(list_transform(range(1, length({DIGITS}) + 1),
      lambda p: CASE WHEN p % 2 = 1 THEN substr(reverse({DIGITS}), p, 1)::INT
        ELSE 2 * substr(reverse({DIGITS}), p, 1)::INT - CASE WHEN substr(reverse({DIGITS}), p, 1)::INT > 4 THEN 9 ELSE 0 END END)) % 10 = 0)"""
OCTETS = "list_bool_and(list_transform(string_split({m}, '.'), lambda p: try_cast(p AS HUGEINT) <= 255))"
IBAN = """(list_reduce(list_concat([0], list_transform(string_split(
      substr(replace({m}, ' ', ''), 5) || substr(replace({m}, ' ', ''), 1, 4), ''), lambda c: ascii(c)::INT)),
      lambda a, c: CASE WHEN c >= 65 THEN (a * 100 + c - 55) % 97 ELSE (a * 10 + c - 48) % 97 END) = 1)"""
PII = {
    "email": ("[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(?:\\.[A-Za-z0-9-]+)+", "true"),
    "ip": ("[0-9]+(?:\\.[0-9]+)(?:\\.[0-9]+)(?:\\.[0-9]+)", OCTETS),
    "card": ("[0-9](?:[ -]?[0-9])+", LUHN),
    "phone": ("\\+[0-9][ ().0-9-]+[0-9]", f"length({DIGITS}) BETWEEN 8 AND 15"),
    "iban": ("\\b[A-Z]{2}[0-9]{2}(?:[A-Z0-9]{11,30}|(?: [A-Z0-9]{4}){2,7}(?: [A-Z0-9]{1,3})?)\\b", IBAN),
    "ssn": ("\\b[0-9]{3}-[0-9]{2}-[0-9]{4}\\b",
            "NOT regexp_matches({m}, '^(000|666|9)|-00-|-0000$') AND regexp_matches(f['c'], '\\b(?:ssn|social security|tax)')"),
}
SECRETS = {
    "assign": ("(?i:password|passwd|secret|token|api_?key)[\"'']?\\x20*[:=]\\x20*[\"'']?[A-Za-z0-9+/_.=-]+",
               "length(regexp_replace({m}, '^(?i:password|passwd|secret|token|api_?key)[\"'']?\\x20*[:=]\\x20*[\"'']?', '')) >= 6"),
    "access": ("AKIA[A-Z0-9]+", "length({m}) >= 20"),
    "hex": ("[0-9a-f]{24,}", "true"),
    "github": ("\\bgh[oprsu]_[A-Za-z0-9]{36,}", "true"),
    "slack": ("\\bxox[abprs]-[A-Za-z0-9-]{10,}", "true"),
    "google": ("\\bAIza[A-Za-z0-9_-]{35}", "true"),
    "stripe": ("\\b[rs]k_live_[A-Za-z0-9]{16,}", "true"),
    "pem": ("-----BEGIN [A-Z ]*PRIVATE KEY[A-Z ]*-----", "true"),
    "webtoken": ("\\beyJ[A-Za-z0-9_-]{10,}\\.eyJ[A-Za-z0-9_-]{10,}\\.[A-Za-z0-9_-]{10,}", "true"),
}


def scan(rules: dict, base: int, by_start: bool) -> str:
    cut = ",\n".join(f"{parts(pattern)} AS p_{k}" for k, (pattern, _) in rules.items())
    found = ",\n".join(f"{spans(k, n, keep)} AS f_{k}" for n, (k, (_, keep)) in enumerate(rules.items()))
    kinds = list(rules)

    def joined(names):
        every = f"flatten([{', '.join('f_' + n for n in names)}])"
        label = "x['k'] || ':' || x['s'] || ':' || (x['s'] + length(x['m']))"
        ordered = f"list_sort(list_transform({every}, lambda x: {{'s': x['s'], 'n': x['n'], 'l': {label}}}))"
        rows = ordered if by_start else f"list_transform({every}, lambda x: {{'l': {label}}})"
        return f"coalesce(array_to_string(list_transform({rows}, lambda x: x['l']), ','), '')"

    counts = ", ".join(f"len(f_{k})::BIGINT AS n_{k}" for k in kinds[:base])
    return f"""WITH docs AS (SELECT doc_id, coalesce(text, '') AS whole FROM documents),
cut AS MATERIALIZED (SELECT doc_id, {cut} FROM docs),
found AS MATERIALIZED (SELECT doc_id, {found} FROM cut)
SELECT doc_id, {counts}, sha256({joined(kinds[:base])}) AS base_sha256, {joined(kinds)} AS spans FROM found"""


WARC = """
WITH d AS (SELECT page_id, strlen(coalesce(html, '')) AS size, sha1(coalesce(html, '')) AS x FROM pages),
tops AS (SELECT x, max(page_id) AS top FROM d GROUP BY x),
letters AS (SELECT x, array_to_string(list_transform(range(0, 32), lambda i:
    substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
      (((('0x' || substr(x, (i // 4 * 5 + 1)::INT, 5))::BIGINT >> (15 - 5 * (i % 4))::INT) & 31) + 1)::INT, 1)), '') AS digest FROM tops)
SELECT page_id, size::BIGINT AS payload_bytes, digest AS payload_digest,
  CASE WHEN page_id IS NOT DISTINCT FROM top THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN page_id IS NOT DISTINCT FROM top THEN NULL ELSE top END AS refers_to
FROM d JOIN tops USING (x) JOIN letters USING (x)"""

LANGUAGE = f"""
WITH docs AS (
  SELECT row_number() OVER () AS r, doc_id, lang, lower(text) AS t, coalesce({crc32('doc_id::VARCHAR')} % 4 = 2, false) AS held_out FROM documents),
words AS (
  SELECT r, w, ' ' || w || ' ' AS p, count(*) AS n
  FROM (SELECT r, unnest(regexp_extract_all(t, '\\p{{L}}+')) AS w FROM docs) GROUP BY ALL),
grams AS (
  SELECT r, g, sum(n) AS n FROM (SELECT r, n, unnest(list_concat(
      list_transform(range(1, length(w) + 1), lambda k: substr(w, k, 1)),
      list_transform(range(1, length(w) + 2), lambda k: substr(p, k, 2)),
      list_transform(range(1, length(w) + 1), lambda k: substr(p, k, 3)))) AS g FROM words) GROUP BY ALL),
own AS (
  SELECT r, g, row_number() OVER (PARTITION BY r ORDER BY n DESC, length(g), g) - 1 AS place FROM grams QUALIFY place < 400),
learned AS (
  SELECT lang, g, sum(n) AS n FROM grams JOIN docs USING (r) WHERE NOT held_out AND lang IS NOT NULL GROUP BY ALL),
profiles AS (
  SELECT lang, g, row_number() OVER (PARTITION BY lang ORDER BY n DESC, length(g), g) - 1 AS rank FROM learned QUALIFY rank < 400),
apart AS (
  SELECT r, l.lang, sum(coalesce(abs(rank - place), 400)) AS d, count(*) AS many
  FROM own CROSS JOIN (SELECT DISTINCT lang FROM profiles) l LEFT JOIN profiles p ON p.lang = l.lang AND p.g = own.g GROUP BY ALL),
best AS (SELECT r, arg_min(lang, (d, lang)) AS lang_pred, 1 - min(d)::DOUBLE / (400 * any_value(many)) AS score FROM apart GROUP BY r)
SELECT doc_id, held_out, coalesce(lang_pred, 'und') AS lang_pred, coalesce(score, 0.0)::DOUBLE AS score FROM docs LEFT JOIN best USING (r)"""



def nibble_table() -> list[int]:
    """Remainders of the sixteen half bytes for CRC-32."""
    table = []
    for value in range(16):
        for _ in range(4):
            value = value >> 1 ^ (0xEDB88320 if value & 1 else 0)
        table.append(value)
    return table


def crc32_latin(text: str) -> str:
    """CRC-32 of the UTF-8 bytes of a string of code points below 256, by half bytes."""
    points = f"list_transform(string_split({text}, ''), lambda c: unicode(c))"
    octets = f"flatten(list_transform({points}, lambda p: CASE WHEN p < 128 THEN [p] ELSE [192 + p // 64, 128 + p % 64] END))"
    halves = f"flatten(list_transform({octets}, lambda o: [o % 16, o // 16]))::BIGINT[]"
    table = "[" + ", ".join(f"{v}::BIGINT" for v in nibble_table()) + "]"
    return f"xor(list_reduce(list_concat([4294967295::BIGINT], {halves}), lambda a, h: xor(a >> 4, {table}[(xor(a, h) & 15) + 1])), 4294967295::BIGINT)"


SPELLING = f"""
WITH RECURSIVE runs AS (
  SELECT coalesce(doc_id::VARCHAR, '') || ':' AS id,
    translate(unnest(regexp_extract_all(text, '[A-Za-zÀ-ÿ]{{7,}}')), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS run
  FROM documents),
distinct_runs AS (SELECT id, run, count(*) AS many FROM runs GROUP BY ALL),
hashed AS (SELECT run, many, {crc32_latin('id || run')} AS h FROM distinct_runs),
spelled AS (
  SELECT CASE WHEN h % 31 = 0 THEN left(run, (h % length(run))::INT) || substr(run, (h % length(run) + 2)::INT) ELSE run END AS word, many
  FROM hashed),
words AS (SELECT word, sum(many)::BIGINT AS n FROM spelled WHERE length(word) >= 7 GROUP BY word HAVING sum(many) >= 2),
cut AS (
  SELECT word, n, i, left(word, i - 1) || substr(word, i + 1) AS rest
  FROM (SELECT word, n, unnest(range(1, length(word) + 1))::INT AS i FROM words)),
pairs AS (
  SELECT a.word, b.word AS near, b.n AS near_n FROM cut a JOIN cut b ON a.i = b.i AND a.rest = b.rest AND a.word <> b.word
  UNION SELECT a.word, b.word, b.n FROM cut a JOIN words b ON a.rest = b.word
  UNION SELECT b.word, a.word, a.n FROM cut a JOIN words b ON a.rest = b.word),
best AS (SELECT word, count(*) AS n_near, arg_min(near, (-near_n, encode(near))) AS near, max(near_n) AS near_n FROM pairs GROUP BY word),
formed AS (
  SELECT word, n, coalesce(n_near, 0)::BIGINT AS n_near, CASE WHEN near_n >= 10 * n THEN near END AS form,
    CASE WHEN near_n >= 10 * n THEN near_n END AS form_n
  FROM words LEFT JOIN best USING (word)),
walk AS (
  SELECT word, word AS root FROM formed UNION ALL SELECT walk.word, form FROM walk JOIN formed ON formed.word = root WHERE form IS NOT NULL),
roots AS (SELECT walk.word, root FROM walk JOIN formed ON formed.word = root WHERE form IS NULL)
SELECT word, form, root, n, n_near, form_n FROM formed JOIN roots USING (word)"""

FILTER_AUDIT = """
WITH RECURSIVE texts AS (
  SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS t,
    regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS words FROM documents),
marks AS (
  SELECT doc_id, part, [len(words) < 200, 100 * len(list_distinct(words)) < 50 * len(words),
    100 * length(regexp_replace(t, '[^A-Z]', '', 'g')) > 3 * length(t), regexp_matches(t, '[#$%&*|]'),
    coalesce(doc_id > min(doc_id) OVER (PARTITION BY t), false)] AS f FROM texts),
docs AS (
  SELECT part, f, list_sum(list_transform(f, lambda x: x::INT)) AS fails, count(*) AS n,
    count(*) FILTER (EXISTS (SELECT 1 FROM labels l WHERE l.doc_id = m.doc_id AND quality = 1)) AS good,
    count(*) FILTER (EXISTS (SELECT 1 FROM labels l WHERE l.doc_id = m.doc_id AND toxic = 1)) AS toxic
  FROM marks m GROUP BY ALL),
orders AS (
  SELECT '' AS o UNION ALL
  SELECT o || x FROM orders, (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS x) WHERE NOT contains(o, x)),
steps AS (SELECT o, s, substr(o, s, 1) AS x FROM orders, (SELECT unnest(range(1, 6))::INT AS s) WHERE length(o) = 5),
rows AS (
  SELECT part, o, s, x, n, good, toxic, fails, f[ascii(x) - 64] AS here,
    list_bool_or(list_transform(range(1, s), lambda k: f[ascii(substr(o, k::INT, 1)) - 64])) IS NOT DISTINCT FROM true AS before
  FROM steps, docs),
counted AS (
  SELECT part, o, s, x,
    sum(CASE WHEN NOT before AND NOT here THEN n ELSE 0 END)::BIGINT AS kept,
    sum(CASE WHEN NOT before AND here THEN n ELSE 0 END)::BIGINT AS removed,
    sum(CASE WHEN before AND here THEN n ELSE 0 END)::BIGINT AS redundant,
    sum(CASE WHEN here AND fails = 1 THEN n ELSE 0 END)::BIGINT AS unique_fails,
    sum(CASE WHEN NOT before AND here THEN good ELSE 0 END)::BIGINT AS good_lost,
    sum(CASE WHEN NOT before AND here THEN toxic ELSE 0 END)::BIGINT AS toxic_lost
  FROM rows GROUP BY ALL)
SELECT part, o AS filter_order, s AS step, kept, removed, redundant, unique_fails, good_lost, toxic_lost,
  (sum(removed) OVER (PARTITION BY part, x))::BIGINT AS shapley FROM counted"""

REPEATS = """
WITH d AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS h, strlen(coalesce(text, '')) AS n FROM documents),
pieces AS (
  SELECT doc_id, p, least(500, n - 99 - p) AS many, h[2 * p + 1:2 * p + 1200] AS h
  FROM (SELECT doc_id, n, h, unnest(range(0, n - 99, 500)) AS p FROM d)),
w AS (
  SELECT doc_id, p + k AS s, md5(h[2 * k + 1:2 * k + 200]) AS m FROM (SELECT doc_id, p, h, unnest(range(0, many)) AS k FROM pieces)),
gone AS (
  SELECT doc_id, s FROM w QUALIFY (doc_id, s) <> min((doc_id, s)) OVER (PARTITION BY m)),
islands AS (
  SELECT doc_id, s, sum(CASE WHEN s <= before + 100 THEN 0 ELSE 1 END) OVER (PARTITION BY doc_id ORDER BY s) AS island
  FROM (SELECT doc_id, s, lag(s) OVER (PARTITION BY doc_id ORDER BY s) AS before FROM gone)),
spans AS (SELECT doc_id, min(s) AS a, max(s) + 100 AS b FROM islands GROUP BY doc_id, island),
cuts AS (
  SELECT doc_id, list(a ORDER BY a) AS starts, list(b ORDER BY a) AS ends, sum(b - a) AS removed, count(*) AS many
  FROM spans GROUP BY doc_id),
kept AS (
  SELECT d.doc_id, n, coalesce(removed, 0) AS removed, coalesce(many, 0) AS many,
    CASE WHEN many IS NULL THEN h ELSE array_to_string(list_transform(range(0, many + 1), lambda k:
      h[2 * CASE WHEN k = 0 THEN 0 ELSE ends[k] END + 1:2 * CASE WHEN k = many THEN n ELSE starts[k + 1] END]), '') END AS rest
  FROM d LEFT JOIN cuts ON d.doc_id IS NOT DISTINCT FROM cuts.doc_id)
SELECT doc_id, n::BIGINT AS n_bytes, removed::BIGINT AS n_removed, many::BIGINT AS n_spans, sha256(unhex(rest)) AS kept_sha256 FROM kept"""

ORACLES = {
    "op2_secrets": scan(SECRETS, 3, True),
    "op4_warc": WARC,
    "op6_pii": scan(PII, 4, False),
    "op9_language": LANGUAGE,
    "op11_suffix_dedup": REPEATS,
    "op12_spelling_variants": SPELLING,
    "op13_filter_audit": FILTER_AUDIT,
}
