"""Repeated passages against a look-up of every window in all that comes before it."""

import hashlib
import random

import numpy as np
import pytest

from tillbridge.llm import suffixes


def brute(docs):
    seen, out = {}, []
    texts = sorted({(i is not None, i or 0, t or "") for i, t in docs})
    assert len({x[:2] for x in texts}) == len(texts)  # rows of one id but different texts: see below
    removed = {}
    for known, i, text in texts:
        data = text.encode()
        gone = np.zeros(len(data), bool)
        for s in range(len(data) - 99):
            window = data[s:s + 100]
            if window in seen:
                gone[s:s + 100] = True
            else:
                seen[window] = i, s
        removed[known, i] = data, gone
    for i, _ in docs:
        data, gone = removed[i is not None, i or 0]
        kept = bytes(np.frombuffer(data, np.uint8)[~gone])
        spans = int(gone[:1].sum() + (gone[1:] & ~gone[:-1]).sum())
        out.append((i, len(data), int(gone.sum()), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=str)


def made(seed):
    rng = random.Random(seed)
    def fresh(n):
        return "".join(rng.choices("abcdefgh \u00e9\u20ac\n", k=n))
    pool = [fresh(rng.choice([60, 99, 100, 101, 130, 400])) for _ in range(8)] + ["ab" * 90, "x" * 150, "line that repeats, short " * 9]
    docs = []
    for i in range(90):
        text = "".join(rng.choice([rng.choice(pool), fresh(rng.randint(0, 150))]) for _ in range(rng.randint(0, 6)))
        docs.append((i * 7 % 90, text))
    for i in range(90, 130):  # near copies
        text = rng.choice(docs)[1]
        k = rng.randrange(len(text) + 1)
        docs.append((i, text[:k] + rng.choice(["", "#", "longer edit"]) + text[k + rng.randint(0, 2):]))
    return docs + [(200, None), (201, ""), (7, dict(docs)[7]), (None, pool[5] * 2), (None, pool[5] * 2)]


@pytest.mark.parametrize("seed, most", [(1, 1000), (2, 1000), (3, 4), (4, 1)])
def test_repeats_equal_the_look_up(spark, seed, most):
    docs = made(seed)
    frame = spark.createDataFrame([(*d, "x", 1) for d in docs], "doc_id long, text string, row string, spots int").repartition(5)
    rows = suffixes.repeats(frame, most=most).collect()
    found = sorted(((r.doc_id, r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in rows), key=str)
    expected = brute(docs)
    assert found == expected and sum(r[2] for r in expected) > 5000
    assert all(sum(s.end - s.start for s in r.spans) == r.n_removed for r in rows)


def test_a_trie_orders_suffixes():
    rng = random.Random(1)
    for _ in range(100):
        pool = [bytes(rng.choices(b"ab", k=rng.choice([2, 90]))) for _ in range(3)]
        texts = [(b"same" + b"".join(rng.choices(pool, k=60)) + bytes(100))[:100] for _ in range(rng.randint(1, 30))]
        blob = b"".join(texts)
        groups = suffixes.trie_order(blob, [100 * k for k in range(len(texts))], 4)
        ordered = [blob[g[0]:g[0] + 100] for g in groups]
        assert ordered == sorted(set(texts))
        assert all({blob[x:x + 100] for x in g} == {t} for g, t in zip(groups, ordered))


def test_anchors_depend_on_their_windows_alone():
    rng = np.random.default_rng(1)
    data = rng.integers(97, 100, 5000).astype(np.uint8)
    data[1000:1400], data[3000:3400] = 97, data[:400]
    starts = np.arange(len(data) - 99)
    hashes, place, first, count = suffixes.anchors(data, starts)
    assert sorted(np.concatenate([np.arange(f, f + c) for f, c in zip(first, count)])) == starts.tolist()
    own = suffixes._hashes(data)
    for h, p, f, c in zip(hashes, place, first, count):
        for s in range(f, f + c):
            assert own[p] == h and s + int(np.argmin(own[s:s + 69] >> np.uint64(32))) == p


def test_rows_of_one_id_and_no_rows(spark):
    text = "".join(random.Random(3).choices("abcdefgh", k=300))
    docs = spark.createDataFrame([(1, text + "1"), (1, text + "2"), (0, "short")], "doc_id long, text string")
    assert sorted(r.n_removed for r in suffixes.repeats(docs).collect()) == [0, 0, 300]
    assert suffixes.repeats(docs.limit(0)).count() == 0


def test_a_very_long_text(spark):
    rng = random.Random(6)
    text = "".join(rng.choices("abcdefghijkl ", k=1 << 20)) * 3
    docs = spark.createDataFrame([(1, text), (2, text[-5000:])], "doc_id long, text string")
    rows = {r.doc_id: r for r in suffixes.repeats(docs, keep_text=True).collect()}
    assert rows[1].n_removed == 2 << 20 and bytes(rows[1].kept).decode() == text[:1 << 20] and rows[1].n_spans == 1
    assert rows[2].n_removed == 5000 and bytes(rows[2].kept) == b""
