"""Every order of the filters against a walk of each document through it."""

import random
import re
from collections import Counter, defaultdict
from itertools import permutations

import pytest

from tillbridge.llm import filter_audit

COLUMNS = ("kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley")


def test_ranks_are_those_of_the_sorted_orders():
    assert [filter_audit.lehmer_rank("".join(o)) for o in permutations("ABCDE")] == list(range(120))


def test_intervals_hold_each_order_once():
    for mask in range(32):
        fails = {f for k, f in enumerate("ABCDE") if mask >> k & 1}
        step_of = {rank: step for step, first, end in filter_audit.intervals(mask) for rank in range(first, end)}
        assert step_of == {
            rank: min(o.index(f) + 1 for f in fails) for rank, o in enumerate(permutations("ABCDE")) if fails}


def brute(docs, labels):
    least = {}
    for i, text, *_ in docs:
        if i is not None:
            least[text or ""] = min(i, least.get(text or "", i))
    good = {i for i, quality, _ in labels if quality == 1 and i is not None}
    toxic = {i for i, _, bad in labels if bad == 1 and i is not None}
    out = defaultdict(Counter)
    for i, text, lang in docs:
        text = text or ""
        words = re.findall(r"[^\x20\x09-\x0D]+", text)
        fails = {"A": len(words) < 200, "B": 100 * len(set(words)) < 50 * len(words),
                 "C": 100 * len(re.findall("[A-Z]", text)) > 3 * len(text), "D": bool(re.search("[#$%&*|]", text)),
                 "E": i is not None and i > least[text]}
        for order in map("".join, permutations("ABCDE")):
            gone = False
            for step, f in enumerate(order, 1):
                now = fails[f] and not gone
                row = out[lang or "", order, step]
                row["kept"] += not (gone or now)
                row["removed"] += now
                row["redundant"] += fails[f] and gone
                row["unique_fails"] += fails[f] and sum(fails.values()) == 1
                row["good_lost"] += now and i in good
                row["toxic_lost"] += now and i in toxic
                gone |= now
    for (part, order, step), row in out.items():
        row["shapley"] = sum(r["removed"] for (p, o, s), r in out.items() if p == part and o[s - 1] == order[step - 1])
    return {k: tuple(int(r[c]) for c in COLUMNS) for k, r in out.items()}


def made(seed):
    rng = random.Random(seed)
    def text():
        words = [rng.choice(["alpha", "Beta", "GAMMA", "d\u00e9lta", "x"]) + (str(k) if rng.random() < 0.5 else "") for k in range(rng.choice([3, 150, 200, 260]))]
        return rng.choice([" ", "\n", "\x0b", "\u00a0 "]).join(words) + rng.choice(["", "", "#", "|"])
    pool = [text() for _ in range(12)]
    docs = [(k, rng.choice(pool), rng.choice(["en", "de", None])) for k in range(60)]
    docs += [(None, pool[0], "en"), (None, pool[0], "en"), (None, None, None), (70, None, "fr"), (71, "", "fr"), (3, docs[3][1], "de"), (5, "other", "en")]
    labels = [(k, rng.choice([0, 1, None]), rng.choice([0, 1, None])) for k in rng.choices(range(75), k=50)] + [(None, 1, 1)]
    return docs, labels


@pytest.mark.parametrize("seed", [1, 2])
def test_audit_equals_the_walk(spark, seed):
    docs, labels = made(seed)
    frame = spark.createDataFrame([(*d, 1, "x") for d in docs], "doc_id long, text string, lang string, mask int, part string").repartition(5)
    known = spark.createDataFrame([(*r, 2) for r in labels], "doc_id long, quality int, toxic int, n int")
    rows = filter_audit.audit(frame, known).collect()
    found = {(r.part, r.filter_order, r.step): tuple(r[c] for c in COLUMNS) for r in rows}
    assert len(rows) == len(found) == 600 * len({d[2] or "" for d in docs})
    assert found == brute(docs, labels)


def test_empty_tables_and_a_very_long_text(spark):
    docs = spark.createDataFrame([(1, "one Two " * 400_000, "en")], "doc_id long, text string, lang string")
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert filter_audit.audit(docs.limit(0), labels).count() == 0
    rows = filter_audit.audit(docs, labels).collect()
    assert len(rows) == 600 and {r.shapley for r in rows if r.filter_order[r.step - 1] in "BC"} == {60}
