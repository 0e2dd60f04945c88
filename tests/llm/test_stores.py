"""Packing, archives, URL rules: exact round trips and brute force."""

import base64
import hashlib
import itertools
import random
import zlib
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from tillbridge.llm import packing, urls, warc

public_tokenizers = pytest.importorskip("public_tokenizers")
TOKENIZER = public_tokenizers.path("byte_bpe_50k.json")


# ---- packing

def test_closest_fill_equals_all_sums():
    rng = random.Random(2)
    for _ in range(500):
        capacity = rng.randint(5, 60)
        counts = {rng.randint(1, capacity + 5): rng.randint(1, 4) for _ in range(rng.randint(1, 6))}
        sums = {0}
        for length, many in counts.items():
            for _ in range(many):
                sums |= {s + length for s in sums if s + length <= capacity}
        found = packing.closest_fill(counts, capacity)
        assert all(n <= counts[length] for length, n in found.items())
        assert sum(length * n for length, n in found.items()) == max(sums)


def test_token_ids_equal_the_tokenizer():
    from tokenizers import Tokenizer

    encoder, tokenizer, rng = packing.Encoder(TOKENIZER), Tokenizer.from_file(TOKENIZER), random.Random(3)
    parts = [*" \n\tab1'é.!\u3000\xa0\x1c\x85\0s", "<|endoftext|>", "'ll", "'re", "😀"]
    for text in ["".join(rng.choices(parts, k=rng.randint(0, 12))) for _ in range(3000)]:
        ids = np.frombuffer(encoder.encode(text), "<u4").tolist()
        assert ids == tokenizer.encode(text, add_special_tokens=False).ids, repr(text)


@pytest.mark.parametrize("capacity, pool", [(64, 1 << 22), (64, 256), (48, 200)])
def test_packing_is_an_exact_round_trip(spark, capacity, pool):
    from tokenizers import Tokenizer

    tokenizer, rng = Tokenizer.from_file(TOKENIZER), random.Random(4)
    texts = [" ".join(rng.choices(["the", "world", "Ünïcode", "x1", "\n"], k=rng.randint(0, 120))) for _ in range(80)]
    texts += ["", None, "a" * 20_000]
    docs = spark.createDataFrame([(i, t, "x") for i, t in enumerate(texts)], "doc_id long, text string, ids string").repartition(3)
    rows = packing.pack(docs, TOKENIZER, capacity=capacity, pool_tokens=pool).collect()
    by_doc, by_sequence = defaultdict(list), defaultdict(list)
    for r in rows:
        assert r.length * 4 == len(r.ids)
        by_doc[r.doc_id].append(r)
        by_sequence[r.sequence_id].append(r)
    for i, text in enumerate(texts):
        ids = tokenizer.encode(text or "", add_special_tokens=False).ids + [0]
        pieces = sorted(by_doc[i], key=lambda r: r.start)
        assert b"".join(r.ids for r in pieces) == np.array(ids, "<u4").tobytes()
        assert [r.start for r in pieces] == [0, *itertools.accumulate(r.length for r in pieces)][:-1]
        assert {r.doc_tokens for r in pieces} == {len(ids)}
    for pieces in by_sequence.values():
        pieces.sort(key=lambda r: r.offset)
        ends = [0, *itertools.accumulate(r.length for r in pieces)]
        assert [r.offset for r in pieces] == ends[:-1]
        assert ends[-1] == capacity or ends[-1] < capacity and ends[-1] & (ends[-1] - 1) == 0  # no padding


def test_packing_of_no_and_of_repeated_rows(spark):
    docs = spark.createDataFrame([(1, "ab"), (1, "ab"), (None, "ab")], "doc_id long, text string").coalesce(1)
    rows = packing.pack(docs, TOKENIZER).collect()
    assert sum(r.length for r in rows) == 3 * rows[0].doc_tokens
    assert packing.pack(docs.limit(0), TOKENIZER).count() == 0


# ---- archives

PAGES = "page_id long, url string, html string, digest string"


def archive(spark, rows, **options):
    return warc.round_trip(spark.createDataFrame([(*r, "x") for r in rows], PAGES).repartition(3), **options)


def test_archives_read_back(spark):
    rows = [(i, f"http://h/{i}", f"page {i % 7} é\r\n\r\nWARC/1.1\r\n" * (i % 5)) for i in range(60)]
    rows += [(100, None, None), (101, "http://h/\r\nx", ""), (102, "u", "\0\x01"), (5, rows[5][1], rows[5][2]), (None, "n", "page 1")]
    found = archive(spark, rows).collect()
    assert len(found) == len(rows)
    largest = {}
    for page, _, html in rows:
        largest[html or ""] = max(largest.get(html or "", -1), -1 if page is None else page)
    for r in found:
        html = next(h or "" for p, _, h in rows if p == r.page_id)
        payload = html.encode()
        assert r.payload_bytes == len(payload)
        assert r.payload_digest == base64.b32encode(hashlib.sha1(payload).digest()).decode()
        top = None if largest[html] < 0 else largest[html]
        assert r.record_type == ("response" if r.page_id == top else "revisit")
        assert r.refers_to == (None if r.page_id == top else top)
        assert r.payload == (payload if r.record_type == "response" else None)
        if r.page_id == 101:
            assert r.url == "http://h/%0D%0Ax"


def test_smaller_payloads_are_responses(spark):
    rows = [(1, "u", "ab"), (2, "u", "ab"), (3, "u", "abcdef"), (4, "u", "abcdef")]
    assert {r.page_id: r.record_type for r in archive(spark, rows, least_bytes=3).collect()} == {
        1: "response", 2: "response", 3: "revisit", 4: "response"}
    assert archive(spark, []).count() == 0


def test_selected_records_are_read_by_few_ranges(spark, tmp_path):
    pages = spark.createDataFrame([(i, "u", f"{i}" * 50, "x") for i in range(100)], PAGES).coalesce(1)
    index = warc.write(pages, f"file://{tmp_path}/a")
    assert sorted(r.page_id for r in warc.read(index.where("page_id % 10 = 3")).collect()) == list(range(3, 100, 10))
    rows = index.orderBy("file", "offset").collect()
    assert all(a.offset + a.length == b.offset for a, b in zip(rows, rows[1:]))
    assert len(warc.coalesced(*zip(*[(r.file, r.offset, r.length) for r in rows]))) == 1
    apart = warc.coalesced(["a", "a", "b"], [0, 10 + warc.GAP_BYTES + 1, 0], [10, 5, 5])
    assert apart == [["a", 0, 10, 1], ["a", warc.GAP_BYTES + 11, warc.GAP_BYTES + 16, 1], ["b", 0, 5, 1]]


def test_damaged_payloads_are_reported():
    raw = warc.record(1, "u", b"payload", warc.base32(hashlib.sha1(b"other").digest()), None, False, "2020-01-01T00:00:00Z")
    with pytest.raises(ValueError, match="damaged"):
        warc.parse(zlib.compress(raw, wbits=31))


# ---- URLs

def judged(url):
    if url is None or "://" not in url:
        return "", "", None, None
    rest = url.split("://", 1)[1]
    cut = min([rest.find(c) for c in "/?#" if c in rest] or [len(rest)])
    host = "".join(c.lower() if c.isascii() else c for c in rest[:cut])
    path = rest[cut:]
    path = path[:min([path.find(c) for c in "?#" if c in path] or [len(path)])]
    fits = [(h + p, v) for h, p, v in urls.RULES if (host == h or host.endswith("." + h)) and path.startswith(p)]
    return host, path, *max(fits, key=lambda f: len(f[0]), default=(None, None))


URLS = [None, "", "x", "http://", "http://a.com", "http://a.com/", "HTTP://A.COM/x?y=1#z", "http://example.com/en/",
        "http://www.Example.com/en/1", "http://w.example.com/en/1", "https://x.net/es/", "https://net/fr/a",
        "https://inet/fr/a", "http://a?b://c/d", "http://é.net/fr/", "a://b://c", "http://x.com?q=/en/", "http://a.com#/"]


def test_fixed_rules_equal_plain_python(spark):
    pages = spark.createDataFrame([(i % 7, u, "x") for i, u in enumerate(URLS * 2)], "page_id long, url string, bad string")
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    rows = urls.judge(pages, labels).collect()
    wanted = sorted((i % 7, h, p, str(r), v or "allow") for i, (h, p, r, v) in enumerate(map(judged, URLS * 2)))
    assert sorted((r.page_id, r.host, r.path, str(r.rule), r.verdict) for r in rows) == wanted
    assert urls.judge(pages.limit(0), labels).count() == 0


def plain_tokens(spark, addresses):
    host, path = urls.parts(F.col("url"))
    frame = spark.createDataFrame([(u,) for u in addresses], "url string").withColumns({"host": host, "path": path})
    return {r.url: r.t for r in frame.select("url", urls.tokens(F.col("url"), F.col("host"), F.col("path")).alias("t")).collect()}


def test_mined_rules_equal_brute_force(spark):
    rng = random.Random(6)
    addresses = [f"http://{rng.choice('abc')}.{rng.choice(['farm', 'home'])}.org/{rng.choice(['win', 'news'])}/{n}?q={n}"
                 for n in range(240)]
    rows = list(enumerate(addresses))
    bad = {i: ("farm" in u and "win" in u) != (rng.random() < 0.05) for i, u in rows[:160]}
    labels = [(i, int(not b), 0) for i, b in bad.items()] + [(None, 0, 1), (9999, 0, 1), (3, 1, 0)]
    found = urls.judge(spark.createDataFrame(rows, "page_id long, url string"),
                       spark.createDataFrame(labels, "doc_id long, quality int, toxic int"), min_count=10).collect()
    sets = plain_tokens(spark, addresses)
    support, hits = defaultdict(int), defaultdict(int)
    for i, b in bad.items():
        for size in range(1, len(sets[addresses[i]]) + 1):
            for part in itertools.combinations(sorted(sets[addresses[i]]), size):
                support[part] += 1
                hits[part] += b
    rules = {p: hits[p] / n for p, n in support.items() if hits[p] >= 10 and hits[p] / n >= urls.MIN_CONFIDENCE}
    assert rules
    for r in found:
        sure = [c for p, c in rules.items() if set(p) <= set(sets[addresses[r.page_id]])]
        assert r.verdict == ("block" if sure else "allow")
        assert r.confidence == (pytest.approx(max(sure)) if sure else None)


def test_remainders_of_one_length_do_not_fill_the_pool():
    pool, sizes, kept = packing.Pool(1024), [], {}
    for k in range(12000):
        pool.add((k, 0, np.full(700, k, "<u4").tobytes(), 700))
        if pool.tokens > 1 << 20:
            sequences = list(pool.fills())
            assert not sequences  # no multiple of 700 is 1024
            for sequence in pool.down_to(1 << 19):
                sizes.append(sum(len(p[2]) // 4 for p in sequence))
                for id_, start, ids, _ in sequence:
                    kept.setdefault(id_, []).append((start, ids))
            assert pool.tokens <= 1 << 19
    for sequence in pool.down_to(0):
        sizes.append(sum(len(p[2]) // 4 for p in sequence))
        for id_, start, ids, _ in sequence:
            kept.setdefault(id_, []).append((start, ids))
    assert sum(sizes) == 12000 * 700 and all(n == 1024 or n & (n - 1) == 0 for n in sizes)
    assert sum(n != 1024 for n in sizes) <= 10
    for id_, pieces in kept.items():
        assert b"".join(ids for _, ids in sorted(pieces)) == np.full(700, id_, "<u4").tobytes()


def test_archive_folders_lie_where_spark_puts_them(spark, tmp_path):
    assert warc.qualified(spark, f"{tmp_path}/a") == f"file:{tmp_path}/a"
    assert warc.qualified(spark, f"file://{tmp_path}/a") == f"file:{tmp_path}/a"
    for path in (f"{tmp_path}/a", f"file:{tmp_path}/a", f"file://{tmp_path}/a"):
        assert warc.open_store(path)[1] == f"{tmp_path}/a"
