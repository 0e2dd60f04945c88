"""Neighbour search and the language model against brute force."""

import itertools
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from tillbridge.llm import markov, neighbours


# ---- neighbours

def vectors(spark, rows):
    return spark.createDataFrame(rows, "vec_id long, embedding array<float>, query string")


def exact(rows, many=5):
    """Best (id, score) for each id divisible by 50, among all other distinct rows."""
    usable = {(i, tuple(v)) for i, v, _ in rows
              if v is not None and len(v) == 8 and all(x is not None and math.isfinite(x) for x in v) and any(v)}
    found = {}
    for i, v in usable:
        if i is not None and i % 50 == 0:
            a = np.array(v, float)
            scored = [(-float(a @ np.array(w)) / math.sqrt(float(a @ a) * float(np.array(w) @ np.array(w))), math.inf if j is None else j)
                      for j, w in usable if j != i]
            found[i] = sorted(scored)[:many]
    return found


def test_neighbours_of_odd_vectors(spark):
    rng = np.random.default_rng(2)
    rows = [(i, rng.normal(size=8).astype(np.float32).tolist(), "x") for i in range(400)]
    same = rng.normal(size=8).astype(np.float32).tolist()
    rows += [(1000 + i, same, "x") for i in range(150)]  # one vector, many ids
    rows += [(5000, None, "x"), (5050, [0.0] * 8, "x"), (5100, [math.nan] + [1.0] * 7, "x"), (5150, [math.inf] + [1.0] * 7, "x"),
             (5200, [None] + [1.0] * 7, "x"), (5250, [1.0, 2.0], "x"), (5300, [], "x"), (0, rows[0][1], "x"), (None, rows[3][1], "x")]
    frame = vectors(spark, rows)
    found = neighbours.nearest_rows(frame, frame.where("vec_id % 50 = 0")).collect()
    wanted = exact(rows)
    assert {r.query_id for r in found} == set(wanted)
    hits = 0
    for query, best in wanted.items():
        own = sorted((r for r in found if r.query_id == query), key=lambda r: r["rank"])
        assert [r["rank"] for r in own] == [1, 2, 3, 4, 5]
        assert all(r.vec_id != query for r in own)
        assert [(-r.score, math.inf if r.vec_id is None else r.vec_id) for r in own] == sorted(
            (-r.score, math.inf if r.vec_id is None else r.vec_id) for r in own)
        hits += len({j for _, j in best} & {math.inf if r.vec_id is None else r.vec_id for r in own})
        assert -own[0].score == pytest.approx(best[0][0], abs=1e-12)
    assert hits >= 0.95 * 5 * len(wanted)


def test_few_and_no_vectors(spark):
    rows = [(50, [1.0, 0.0], "x"), (51, [0.0, 2.0], "x"), (52, [3.0, 0.1], "x")]
    found = neighbours.nearest_rows(vectors(spark, rows), vectors(spark, rows[:1])).collect()
    assert [r.vec_id for r in sorted(found, key=lambda r: r["rank"])] == [52, 51]
    none = vectors(spark, [])
    assert neighbours.nearest_rows(none, none).count() == 0
    alone = vectors(spark, rows[:1])
    assert neighbours.nearest_rows(alone, alone).count() == 0


def test_recall_among_clusters(spark):
    rng = np.random.default_rng(5)
    centres = rng.normal(size=(6, 24))
    data = np.concatenate([centres[rng.integers(0, 6, 2400)] + rng.normal(size=(2400, 24)),
                           centres[0] + 0.02 * rng.normal(size=(600, 24))]).astype(np.float32)
    frame = vectors(spark, [(i, v.tolist(), "x") for i, v in enumerate(data)])
    found = {}
    for r in neighbours.nearest_rows(frame, frame.where("vec_id % 50 = 0")).collect():
        found.setdefault(r.query_id, set()).add(r.vec_id)
    unit = data.astype(float) / np.linalg.norm(data.astype(float), axis=1, keepdims=True)
    hits = 0
    for i in range(0, len(data), 50):
        sims = unit @ unit[i]
        sims[i] = -9
        hits += len(set(np.argsort(-sims, kind="stable")[:5].tolist()) & found[i])
    assert hits / (5 * len(found)) >= 0.95


@pytest.mark.parametrize("noise", [1e-2, 1e-3])
def test_recall_among_thousands_of_near_copies(spark, noise):
    rng = np.random.default_rng(6)
    base = rng.normal(size=64)
    data = (base + noise * rng.normal(size=(4000, 64))).astype(np.float32)
    frame = vectors(spark, [(i, v.tolist(), "x") for i, v in enumerate(data)])
    found = {}
    for r in neighbours.nearest_rows(frame, frame.where("vec_id % 50 = 0")).collect():
        found.setdefault(r.query_id, set()).add(r.vec_id)
    unit = data.astype(float) / np.linalg.norm(data.astype(float), axis=1, keepdims=True)
    hits = 0
    for i in range(0, len(data), 50):
        apart = ((unit - unit[i]) ** 2).sum(1)
        apart[i] = 9
        hits += len(set(np.argsort(apart, kind="stable")[:5].tolist()) & found[i])
    assert hits / (5 * len(found)) >= 0.9


def test_each_length_of_vectors_is_searched(spark):
    rng = np.random.default_rng(8)
    sizes = {i: 3 + i % 3 for i in range(200)} | {200: 9}
    data = {i: rng.normal(size=n) for i, n in sizes.items()}
    frame = spark.createDataFrame([(i, v.tolist()) for i, v in data.items()], "vec_id long, embedding array<double>")
    found = {}
    for r in neighbours.nearest_rows(frame, frame.where("vec_id % 50 = 0")).collect():
        found.setdefault(r.query_id, {})[r["rank"]] = (r.vec_id, r.score)
    for i in (0, 50, 100, 150):
        unit = data[i] / np.linalg.norm(data[i])
        wanted = sorted(((-float(v @ unit / np.linalg.norm(v)), j) for j, v in data.items() if j != i and sizes[j] == sizes[i]))[:5]
        assert [found[i][k + 1][0] for k in range(5)] == [j for _, j in wanted]
        assert [found[i][k + 1][1] for k in range(5)] == pytest.approx([-s for s, _ in wanted], abs=1e-12)
    assert 200 not in found  # no other vector is as long


def test_scaled_copies_are_one_node(spark):
    rng = np.random.default_rng(7)
    base = rng.normal(size=8)
    rows = [(i, (base * (1 + i)).tolist(), "x") for i in range(3000)] + [(0, (base * k).tolist(), "x") for k in range(2, 30)]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>, query string")
    assert neighbours.nodes_of(neighbours.usable(frame, "vec_id", "embedding"), 6).count() <= 2
    found = neighbours.nearest_rows(frame, frame.where("vec_id IN (0, 2950)")).collect()
    assert [r.vec_id for r in sorted(found, key=lambda r: r["rank"]) if r.query_id == 0] == [1, 2, 3, 4, 5]
    assert all(r.score == pytest.approx(1, abs=1e-12) for r in found)


# ---- language model

def test_steps_take_few_exchanges(spark, monkeypatch):
    rng = np.random.default_rng(11)
    frame = vectors(spark, [(i, rng.normal(size=4).astype(np.float32).tolist(), "x") for i in range(600)])
    plans, keep = {}, neighbours.Scratch.keep

    def noted(self, table, name):
        plan = table._jdf.queryExecution().executedPlan().toString()
        plans.setdefault(name, []).append(plan.count("Exchange hashpartitioning") + plan.count("BroadcastExchange"))
        return keep(self, table, name)

    monkeypatch.setattr(neighbours.Scratch, "keep", noted)
    assert neighbours.nearest_rows(frame, frame.where("vec_id % 50 = 0")).count() == 60
    assert len(plans["beam"]) > 2 and max(plans["beam"]) <= 4  # nodes joined to those met, and the groups of the queries


def tokens(text):
    low = "".join(c.lower() if c.isascii() else c for c in text or "")
    return [*re.findall(r"[^\x20\x09-\x0D]+", low), "\0end"]


def test_unigram_part_equals_brute_force(spark):
    rng = random.Random(1)
    words = [f"W{n}" for n in range(300)] + ["é", "É", "a\u00a0b"]
    texts = [" ".join(rng.choices(words, k=rng.randint(0, 60), weights=[1 / (n + 1) for n in range(len(words))])) for _ in range(80)]
    texts += ["", None, "\t\n", texts[0], "never seen words"]
    docs = spark.createDataFrame([(i, t, "x") for i, t in enumerate(texts)], "doc_id long, text string, row string").repartition(3)
    held = [zlib.crc32(str(i).encode()) % 10 == 0 for i in range(len(texts))]
    counts = Counter(t for i, text in enumerate(texts) if not held[i] for t in tokens(text))
    total = sum(counts.values())
    scores = []
    for lookup, chunk in [(1 << 16, 1 << 21), (8, 300)]:  # the second: most words are joined, texts lie in many chunks
        rows = {r.doc_id: r for r in markov.score_documents(docs, lookup=lookup, chunk=chunk, iterations=2).collect()}
        assert len(rows) == len(texts)
        for i, text in enumerate(texts):
            own, row = tokens(text), rows[i]
            assert (row.held_out, row.n_tokens, row.n_known, row.train_tokens) == (
                held[i], len(own), sum(counts[t] > 0 for t in own), total)
            assert row.base_score == pytest.approx(sum(math.log10((counts[t] + 0.1) / (total + 0.1 * (len(counts) + 1))) for t in own))
            assert math.isfinite(row.score) and row.score < 0
        scores.append([rows[i].score for i in range(len(texts))])
    assert scores[0] == pytest.approx(scores[1], rel=1e-6)  # where emissions lie changes nothing


def every_path(symbols, model):
    """Probability of a sequence, and the expected counts, by listing all state paths."""
    states, total = range(len(model.start)), 0.0
    start, move, emit = np.zeros_like(model.start), np.zeros_like(model.move), np.zeros_like(model.emit)
    for path in itertools.product(states, repeat=len(symbols)):
        p = model.start[path[0]] * model.emit[symbols[0], path[0]]
        for a, b, s in zip(path, path[1:], symbols[1:]):
            p *= model.move[a, b] * model.emit[s, b]
        total += p
        start[path[0]] += p
        for a, b in zip(path, path[1:]):
            move[a, b] += p
        for s, k in zip(symbols, path):
            emit[s, k] += p
    return total, start / total, move / total, emit / total


def test_recursions_equal_the_sum_over_paths():
    rng = np.random.default_rng(4)
    model = markov.Model(rng.dirichlet(np.ones(3)), rng.dirichlet(np.ones(3), 3), rng.dirichlet(np.ones(5), 3).T)
    sequences = [rng.integers(0, 5, n) for n in (6, 6, 4, 1)]
    flat, offsets = np.concatenate(sequences), np.cumsum([0, 6, 6, 4, 1])
    brute = [every_path(s, model) for s in sequences]
    order = [2, 0, 3, 1]  # any order
    shuffled = np.concatenate([sequences[k] for k in order])
    ends = np.cumsum([0, *[len(sequences[k]) for k in order]])
    assert markov.log_likelihood(shuffled, ends, model) == pytest.approx([math.log(brute[k][0]) for k in order])
    for segment in (1, 2, 4, 99):  # whole sequences, however few steps are held at once
        start, move, emit, log = markov.expected_counts(flat, offsets[:-1], np.diff(offsets), model, segment)
        assert log == pytest.approx(sum(math.log(b[0]) for b in brute))
        for found, place in ((start, 1), (move, 2), (emit, 3)):
            assert np.allclose(found, sum(b[place] for b in brute))


@pytest.mark.parametrize("segment", [3, 99])
def test_recursions_of_tiny_probabilities(segment):
    rng = np.random.default_rng(13)
    model = markov.Model(rng.dirichlet(np.ones(2)), rng.dirichlet(np.ones(2), 2), 10.0 ** rng.uniform(-30, -20, (4, 2)))
    sequences = [rng.integers(0, 4, n) for n in (9, 7, 5, 4)]
    brute = [every_path(s, model) for s in sequences]
    flat, offsets = np.concatenate(sequences), np.cumsum([0, 9, 7, 5, 4])
    assert markov.log_likelihood(flat, offsets, model) == pytest.approx([math.log(b[0]) for b in brute])
    found = markov.expected_counts(flat, offsets[:-1], np.diff(offsets), model, segment)
    for values, place in zip(found, (1, 2, 3)):
        assert np.allclose(values, sum(b[place] for b in brute))
    assert found[3] == pytest.approx(sum(math.log(b[0]) for b in brute))


def test_one_pass_of_training_equals_brute_force(spark):
    rng = random.Random(3)
    words = ["a", "b", "c", "d", "once"]
    texts = [" ".join(rng.choices(words[:4], k=n)) for n in (4, 3, 5, 0, 4, 5, 5, 4)] + ["a once b"]
    docs = spark.createDataFrame([(i, t, False) for i, t in enumerate(texts)], "id long, text string, held_out boolean").repartition(2)
    scratch = markov.Scratch(spark, "test")
    counts = scratch.keep(markov.token_counts(docs), "counts")
    vocab = markov.vocabulary(counts, 1)  # the end token alone is shared
    assert len(vocab.words) == 1 and (vocab.other_tokens, vocab.other_distinct) == (1, 1)
    encoded = scratch.keep(markov.encode(docs, vocab, 8), "encoded")
    prepared = scratch.keep(markov.prepare(encoded, counts, vocab), "prepared")

    def table_of(emissions):
        return {r.word: np.frombuffer(r.e, np.float32) for r in emissions.collect()}

    first = table_of(markov.first_emissions(counts, vocab, 2))
    begin = markov.initial(vocab, markov.first_emissions(counts, vocab, 2), 2)
    parameters, emissions, history = markov.train(prepared, counts, vocab, scratch, 2, 1)
    hashes = {w: int(markov.word_hashes(pa.array([w], pa.large_string()))[0].view(np.int64)[0]) for w in words}
    order = [hashes[w] for w in "abcd"]
    model = markov.Model(begin.start, begin.move, np.concatenate([begin.emit, [first[w] for w in order]]) / begin.total)
    assert np.allclose(model.emit.sum(0), 1)
    sequences = [[1 if w == "once" else 2 + "abcd".index(w) for w in t.split()] + [0] for t in texts]
    brute = [every_path(s, model) for s in sequences]
    assert history == [pytest.approx(sum(math.log(b[0]) for b in brute))]
    start, move, emit = (sum(b[k] for b in brute) for k in (1, 2, 3))
    assert np.allclose(parameters.start, (start + 1) / (start + 1).sum())
    assert np.allclose(parameters.move, (move + 1) / (move + 1).sum(1, keepdims=True))
    n = np.bincount([s for q in sequences for s in q], minlength=6)
    wanted = emit + 10 * ((n + 1) / (n + 1).sum())[:, None]
    own = table_of(emissions)
    assert np.allclose(np.concatenate([parameters.emit, [own[w] for w in order]]), wanted) and np.allclose(parameters.total, wanted.sum(0))
    scratch.drop_all_but()


def test_emissions_are_dealt_in_bundles(spark):
    rng = random.Random(12)
    texts = [" ".join(rng.choices([f"w{n}" for n in range(40)], k=50)) for _ in range(60)]
    docs = spark.createDataFrame([(i, t, False) for i, t in enumerate(texts)], "id long, text string, held_out boolean").repartition(2)
    scratch = markov.Scratch(spark, "test")
    counts = scratch.keep(markov.token_counts(docs), "counts")
    vocab = markov.vocabulary(counts, 1)
    prepared = scratch.keep(markov.prepare(markov.encode(docs, vocab, 500), counts, vocab), "prepared")
    emissions = scratch.keep(markov.first_emissions(counts, vocab, 2), "emissions")
    listed = {(r.chunk, r.place, r.word) for r in markov.listed_words(prepared).collect()}
    wanted = {r.word: r.e for r in emissions.collect()}
    bundles, found = markov.chunk_words(prepared, emissions).collect(), set()
    for r in bundles:
        places, words = np.frombuffer(r.place, np.int32).tolist(), np.frombuffer(r.word, np.int64).tolist()
        found |= {(r.chunk, p, w) for p, w in zip(places, words)}
        assert r.e == b"".join(wanted[w] for w in words)
    assert found == listed and len(bundles) < len(listed) / 2
    scratch.drop_all_but()


def test_scoring_takes_turns(spark, monkeypatch):
    kept, keep = [], markov.Scratch.keep
    monkeypatch.setattr(markov.Scratch, "keep", lambda self, frame, name: kept.append(name) or keep(self, frame, name))
    docs = spark.createDataFrame([(i, f"a b c{i % 7}") for i in range(50)], "doc_id long, text string")
    assert sorted(r.doc_id for r in markov.score_documents(docs, chunk=10, lookup=1).collect()) == list(range(50))
    assert kept.count("scores") == markov.ROUNDS  # so the shuffle files of one round lie on disk at once


def test_passes_move_rows_of_many_words(spark, monkeypatch):
    rng = random.Random(14)
    texts = [" ".join(rng.choices([f"w{n}" for n in range(60)], k=40)) for _ in range(40)]
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string").repartition(2)
    kept, plans, keep = [], [], markov.Scratch.keep

    def noted(self, frame, name):
        kept.append(name)
        plans.append(frame._jdf.queryExecution().executedPlan().toString())
        return keep(self, frame, name)

    monkeypatch.setattr(markov.Scratch, "keep", noted)
    scores = []
    for part in (1 << 21, 100):  # tokens for each part of the words: one part, and many
        monkeypatch.setattr(markov, "PART", part)
        scores.append({r.doc_id: r.score for r in markov.score_documents(docs, chunk=500, lookup=1).collect()})
    assert scores[0] == pytest.approx(scores[1], rel=1e-6)
    assert not any("Generate" in plan for plan in plans)  # no row for each word of a chunk
    assert kept.count("prepared") == 2 * markov.ROUNDS  # so its shuffle files lie on disk for one round at once


def test_training_finds_the_states(spark):
    rng = random.Random(2)
    groups = [[f"a{n}" for n in range(30)], [f"b{n}" for n in range(30)]]
    texts = [" ".join(rng.choices(rng.choice(groups), k=60)) for _ in range(300)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(4)
    rows = markov.score_documents(docs, states=3, iterations=6).where("held_out").toPandas()
    assert rows.score.sum() > rows.base_score.sum() + 0.2 * rows.n_tokens.sum()  # knowing the group saves 0.3 a word


def test_nothing_to_learn_from(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert markov.score_documents(docs).count() == 0
    held = next(i for i in range(99) if zlib.crc32(str(i).encode()) % 10 == 0)
    row = markov.score_documents(spark.createDataFrame([(held, "a b")], "doc_id long, text string")).first()
    assert (row.train_tokens, row.n_known, row.n_tokens) == (0, 0, 3) and row.base_score == 0.0 and math.isfinite(row.score)


def test_token_slices_cover_all_words():
    texts = pa.array(["a b", None, "", "c"])
    found = [(at, len(words), offsets.tolist()) for at, words, offsets in markov.tokens_of(texts)]
    assert found == [(0, 7, [0, 3, 4, 5, 7])]


def test_long_texts_null_ids_and_clashing_columns(spark):
    rng = random.Random(9)
    long = " ".join(rng.choices([f"w{n}" for n in range(50)], k=5000))  # many pieces, and a chunk of its own
    rows = [(i, t, "x", "y") for i, t in enumerate([long, "", None, "w1 w2", long, "w1 w2"])] + [(None, "w3 unseen", "x", "y")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, chunk string, words string").repartition(2)
    found = markov.score_documents(docs, chunk=1000).collect()
    assert len(found) == 7 and all(math.isfinite(r.score) and math.isfinite(r.base_score) for r in found)
    by_id = {r.doc_id: r for r in found}
    assert (by_id[0].n_tokens, by_id[1].n_tokens, by_id[2].n_tokens) == (5001, 1, 1)
    assert by_id[None].held_out is False  # so its words are training words
    assert by_id[0].score == pytest.approx(by_id[4].score) and by_id[3].score == pytest.approx(by_id[5].score)
    assert by_id[1].score == pytest.approx(by_id[2].score)
    one = markov.score_documents(docs.unionByName(docs.where("doc_id = 3")), chunk=1000)
    assert one.where("doc_id = 3").count() == 2


def test_pieces_equal_one_sequence():
    rng = np.random.default_rng(10)
    model = markov.Model(rng.dirichlet(np.ones(4)), rng.dirichlet(np.ones(4), 4), rng.dirichlet(np.ones(30), 4).T)
    lengths = np.array([3000, 1, 700, 64, 65])
    symbols, starts = rng.integers(0, 30, lengths.sum()), np.cumsum(lengths) - lengths
    whole = markov.expected_counts(symbols, starts, lengths, model, 1 << 20)
    cut = markov.expected_counts(symbols, starts, lengths, model, 64)
    for a, b in zip(whole, cut):
        assert np.allclose(a, b, rtol=1e-9)
