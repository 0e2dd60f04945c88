"""Spelling variants against comparison of all pairs of words."""

import random
import re
import string
import zlib
from collections import Counter

import pytest

from tillbridge.llm import spelling

LOWER = str.maketrans(string.ascii_uppercase, string.ascii_lowercase)


def apart_by_one(a, b):
    if len(a) > len(b):
        a, b = b, a
    if len(b) - len(a) > 1 or a == b:
        return False
    k = next((k for k in range(len(a)) if a[k] != b[k]), len(a))
    return a[k + 1:] == b[k + 1:] if len(a) == len(b) else a[k:] == b[k + 1:]


def brute(docs):
    counts = Counter()
    for i, text in docs:
        for run in re.findall("[A-Za-z\u00c0-\u00ff]+", text or ""):
            run = run.translate(LOWER)
            h = zlib.crc32(f"{'' if i is None else i}:{run}".encode())
            if h % 31 == 0:
                run = run[:h % len(run)] + run[h % len(run) + 1:]
            if len(run) >= 7:
                counts[run] += 1
    counts = {w: n for w, n in counts.items() if n >= 2}
    near = {w: [v for v in counts if apart_by_one(w, v)] for w in counts}
    form = {}
    for w, others in near.items():
        top = min(others, key=lambda v: (-counts[v], v), default=None)
        if top is not None and counts[top] >= 10 * counts[w]:
            form[w] = top
    def root(w):
        return root(form[w]) if w in form else w
    return {w: (n, len(near[w]), form.get(w), counts.get(form.get(w)), root(w)) for w, n in counts.items()}


def made(seed, words=160, texts=400):
    rng = random.Random(seed)
    letters = "abe\u00e9\u00d7Z"
    pool = ["".join(rng.choices(letters, k=rng.randint(6, 12))) for _ in range(words // 8)] + ["aaaaaaa", "a" * 8, "a" * 9]
    for _ in range(words):
        w = rng.choice(pool)
        k = rng.randrange(len(w) + 1)
        pool.append(rng.choice([w[:k] + rng.choice(letters) + w[k:], w[:k] + w[k + 1:], w[:k] + rng.choice(letters) + w[k + 1:]]))
    weights = [rng.choice([1, 1, 4, 60, 700]) for _ in pool]
    docs = [(k, rng.choice([" ", ",", "1", "\n"]).join(rng.choices(pool, weights, k=rng.randint(0, 60)))) for k in range(texts)]
    return docs + [(None, "aaaaaaa aaaaaaab"), (None, None), (3, ""), (3, docs[3][1])]


@pytest.mark.parametrize("seed, most", [(1, 2048), (2, 2048), (3, 3), (4, 12)])
def test_variants_equal_all_pairs(spark, seed, most):
    docs = made(seed)
    frame = spark.createDataFrame([(*d, "x", 5) for d in docs], "doc_id long, text string, word string, n int").repartition(4)
    found = spelling.variants(frame, most).collect()
    expected = brute(docs)
    assert any(e[2] for e in expected.values())
    assert {r.word: (r.n, r.n_near, r.form, r.form_n, r.root) for r in found} == expected and len(found) == len(expected)


def test_a_block_equals_all_pairs():
    rng = random.Random(5)
    for _ in range(200):
        n = rng.randint(2, 6)
        words = sorted({"".join(rng.choices("ab", k=rng.choice([n, n + 1]))) for _ in range(20)})
        found = {(i, j) for i, near in spelling.near_in_block(words, n, 0, 0) for j in near}
        assert found == {(i, j) for i, a in enumerate(words) for j, b in enumerate(words) if len(a) == n and apart_by_one(a, b)}


def test_no_rows_and_a_very_long_word(spark):
    docs = spark.createDataFrame([(1, "q" * 20_000), (2, "q" * 20_000), (2, "q" * 20_001), (1, "q" * 20_001)], "doc_id long, text string")
    assert spelling.variants(docs.limit(0)).count() == 0
    assert {r.word: (r.n, r.n_near, r.form, r.form_n, r.root) for r in spelling.variants(docs).collect()} == brute(
        [tuple(r) for r in docs.collect()])
