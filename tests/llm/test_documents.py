"""Language, near duplicates and decontamination against brute force."""

import itertools
import random
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tillbridge.llm import common, contamination, language, near_duplicates
from tillbridge.llm.components import components

SCHEMA = "doc_id long, text string, lang string, row int, digest string"
WORDS = [f"w{i}" for i in range(3000)]


def documents(spark, texts, langs=None):
    rows = [(i, t, langs[i] if langs else None, i, "x") for i, t in enumerate(texts)]
    return spark.createDataFrame(rows, SCHEMA)


# ---- words and n-grams

def test_word_hashes_follow_the_words():
    texts = ["a b  c\tab", "", None, " Hello  hello\nx", "é É x", "abc" * 900_000 + " ab", "AB,c"]
    found = {}
    for _, part in common.slices(pa.array(texts), lower=True):
        hashes, offsets = common.word_hashes(part)
        for k, text in enumerate(part.to_pylist()):
            words = text.split()
            own = hashes[offsets[k]:offsets[k + 1]]
            assert len(own) == len(words)
            for word, code in zip(words, own):
                assert found.setdefault(word, code) == code
    assert len(set(found.values())) == len(found)
    hashes, offsets = common.word_hashes(pa.array(["AB,c--ab"], pa.large_string()), punctuation=False)
    assert len(hashes) == 3 and hashes[0] == hashes[2]


# ---- language

def grams(text):
    words = "".join(c if c.isalpha() else " " for c in text.lower()).split()
    return Counter(itertools.chain.from_iterable(
        [*w, *(f" {w} "[k:k + 2] for k in range(len(w) + 1)), *(f" {w} "[k:k + 3] for k in range(len(w)))] for w in words))


def ranks(counts, size):
    return [g for g, _ in sorted(counts.items(), key=lambda x: (-x[1], len(x[0]), x[0]))[:size]]


def test_gram_counts_equal_a_plain_count():
    for text in ["Ab, ab a", "1 2", "", None, "é—è xx", "İx ab1cd"]:
        codes, counts = language.gram_counts(text)
        read = {"".join(chr(c >> s & 0x1FFFFF) for s in (42, 21, 0) if c >> s & 0x1FFFFF): int(n) for c, n in zip(codes.tolist(), counts)}
        assert read == dict(grams(text or ""))


def test_languages_equal_brute_force(spark):
    rng = random.Random(4)
    sounds = {"aa": "bado kare mi", "bb": "xylo trink pfa", "cc": "ñu ção éte"}
    texts, langs = [], []
    for n in range(60):
        lang = rng.choice(list(sounds))
        texts.append(" ".join(rng.choice(sounds[lang].split()) + rng.choice("aeiou") for _ in range(rng.randint(1, 40))))
        langs.append(lang)
    texts += [None, "", "12 !", texts[0], texts[0]]
    langs += ["aa", None, "bb", langs[0], None]
    docs = documents(spark, texts, langs)
    size = 30
    result = {r.doc_id: r for r in language.identify(docs, size=size).collect()}
    held = {r.doc_id for r in docs.where(F.crc32(F.encode(F.col("doc_id").cast("string"), "UTF-8")) % 4 == 2).collect()}
    learned = {}
    for i, (text, lang) in enumerate(zip(texts, langs)):
        if i not in held and text and lang and grams(text):
            learned.setdefault(lang, Counter()).update(grams(text))
    profiles = {k: {g: p for p, g in enumerate(ranks(c, size))} for k, c in sorted(learned.items())}
    assert len(result) == len(texts)
    for i, text in enumerate(texts):
        own = ranks(grams(text or ""), size)
        row = result[i]
        assert row.held_out == (i in held)
        if not own:
            assert (row.lang_pred, row.score) == ("und", 0.0)
            continue
        apart = {k: sum(abs(p[g] - n) if g in p else size for n, g in enumerate(own)) for k, p in profiles.items()}
        best = min(apart, key=lambda k: (apart[k], k))
        assert row.lang_pred == best and row.score == pytest.approx(1 - apart[best] / (size * len(own)))


def test_identified_documents_keep_their_columns(spark):
    docs = documents(spark, ["bado kare bado kare", None, "", "12", "zzq xkq wwv"], ["aa", None, None, "aa", None])
    assert [r.doc_id for r in language.keep_identified(docs).orderBy("doc_id").collect()] == [0]
    assert language.keep_identified(docs).columns == docs.columns
    unlabelled = docs.withColumn("lang", F.lit(None).cast("string"))
    assert language.keep_identified(unlabelled).count() == 2
    assert language.identify(unlabelled).where("lang_pred <> 'und'").count() == 0
    assert language.identify(docs.limit(0)).count() == 0


# ---- near duplicates

def shingle_counts(text):
    words = (text or "").lower().split()
    return Counter(tuple(words[i:i + 5]) for i in range(max(1, len(words) - 4))) if words else Counter()


def probability_jaccard(x, y):
    return sum(1 / sum(max(x[e] / x[d], y[e] / y[d]) for e in x.keys() | y.keys()) for d in x.keys() & y.keys())


def alike(x, y):
    both = len(x.keys() & y.keys())
    return bool(both) and (both / len(x.keys() | y.keys()) >= 0.8 or probability_jaccard(x, y) >= 0.8)


def copies(seed):
    rng = random.Random(seed)
    texts = []
    for _ in range(2):
        base = [rng.choice(WORDS) for _ in range(rng.choice([50, 90]))]
        for _ in range(45):
            words = list(base)
            for _ in range(rng.choice([0, 1, 1, 2, 3, 4, 6, 9])):
                words[rng.randrange(len(words))] = rng.choice(WORDS)
            if rng.random() < 0.2:
                words += words[:20] * rng.randint(1, 3)
            texts.append(" ".join(words))
    return texts + ["a b", "a b", "A  b", "", "", None, "x"] + [" ".join(rng.choices(WORDS, k=40)) for _ in range(20)]


def brute_classes(texts):
    counts = [shingle_counts(t) for t in texts]
    least = list(range(len(texts)))
    pairs = [(i, j) for i, j in itertools.combinations(range(len(texts)), 2)
             if (texts[i] or "") == (texts[j] or "") or alike(counts[i], counts[j])]
    changed = True
    while changed:
        changed = False
        for i, j in pairs:
            low = min(least[i], least[j])
            changed |= least[i] != low or least[j] != low
            least[i] = least[j] = low
    return least


@pytest.mark.parametrize("few", [4, 0])  # 0: every class is found through shared first shingles
def test_classes_equal_brute_force(spark, monkeypatch, few):
    monkeypatch.setattr(near_duplicates, "FEW", few)
    texts = copies(5)
    docs = documents(spark, texts).repartition(4)
    found = {r.doc_id: r.class_id for r in near_duplicates.classes(docs).collect()}
    assert [found[i] for i in range(len(texts))] == brute_classes(texts)


def test_a_large_group_below_the_threshold(spark, monkeypatch):
    """Copies some 0.7 alike have few links, and few of their pairs are verified."""
    rng = random.Random(11)
    base = [rng.choice(WORDS) + str(k % 7) for k in range(100)]
    texts = []
    for k in range(260):
        words = list(base)
        for place in rng.sample(range(100), 1 if k % 25 == 0 else 2):
            words[place] = f"new{k}"
        texts.append(" ".join(words))
    sets = [set(shingle_counts(t)) for t in texts]
    links = {(i, j) for i, j in itertools.combinations(range(260), 2) if len(sets[i] & sets[j]) >= 0.8 * len(sets[i] | sets[j])}
    least = list(range(260))
    for _ in range(260):
        for i, j in links:
            least[i] = least[j] = min(least[i], least[j])
    verified, original = [], near_duplicates._Links.round
    monkeypatch.setattr(near_duplicates._Links, "round", lambda self, *a: (original(self, *a), verified.append(self.checked.count()))[0])
    found = {r.doc_id: r.class_id for r in near_duplicates.classes(documents(spark, texts).repartition(4)).collect()}
    assert [found[i] for i in range(260)] == least
    assert len(set(least)) > 20 and verified[-1] < 260 * 259 / 2 / 4


def test_copies_that_repeat_a_line_are_found(spark):
    rng = random.Random(9)
    texts = []
    for _ in range(12):
        words, line = rng.sample(WORDS, 120), " ".join(rng.sample(WORDS, 8))
        texts += [" ".join([*words, *[line] * many]) for many in (2, 100)]
    x, y = shingle_counts(texts[0]), shingle_counts(texts[1])
    assert alike(x, y) and probability_jaccard(x, y) < 0.3
    found = {r.doc_id: r.class_id for r in near_duplicates.classes(documents(spark, texts)).collect()}
    assert [found[i] for i in range(24)] == [i - i % 2 for i in range(24)]


def test_one_row_of_each_class_is_kept(spark):
    texts = ["a b c d e f"] * 3 + ["q r s t u v w", None, ""]
    docs = documents(spark, texts)
    docs = docs.union(docs.where("doc_id IN (0, 3)")).union(docs.where("doc_id = 3").withColumn("doc_id", F.lit(None).cast("long")))
    kept = near_duplicates.keep_one(docs)
    assert kept.columns == docs.columns
    assert sorted(r.doc_id for r in kept.collect()) == [0, 3, 4]
    assert near_duplicates.keep_one(docs.limit(0)).count() == 0


def test_signatures_estimate_the_probability_jaccard():
    rng = np.random.default_rng(3)
    codes = np.sort(rng.integers(1, 1 << 63, 300).astype(np.uint64))
    x, y = rng.integers(1, 6, 200), rng.integers(1, 6, 200)
    a, b = codes[:200], codes[60:260]
    signs = near_duplicates.signatures(np.concatenate([a, b]), np.concatenate([x, y]), np.array([0, 200, 400]), 2000)
    wanted = probability_jaccard(Counter(dict(zip(a.tolist(), x.tolist()))), Counter(dict(zip(b.tolist(), y.tolist()))))
    assert abs((signs[0] == signs[1]).mean() - wanted) < 0.04
    assert near_duplicates.similarities(a, x, b, y)[0] == pytest.approx(wanted)


def test_components_of_a_path_and_stars(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, k) for k in range(101, 130)] + [(200, 200)]
    frame = spark.createDataFrame(edges, "a long, b long")
    found = components(frame, common.Scratch(spark, "test"))
    roots = {r.node: r.root for r in found.collect()}
    assert roots == {**{i: 0 for i in range(1, 41)}, **{k: 100 for k in range(101, 130)}}


# ---- decontamination

def smith_waterman(a, b):
    last, best = [0] * (len(b) + 1), 0
    for x in a:
        row = [0]
        for j, y in enumerate(b, 1):
            row.append(max(0, last[j - 1] + (2 if x == y else -1), last[j] - 1, row[j - 1] - 1))
        best, last = max(best, *row), row
    return best


def test_alignment_equals_brute_force():
    rng = np.random.default_rng(1)
    rows = [rng.integers(1, 6, rng.integers(1, 20)).astype(np.uint64) for _ in range(150)]
    columns = [rng.integers(1, 6, rng.integers(1, 40)).astype(np.uint64) for _ in range(150)]
    scores, first, last = contamination.align(rows, columns)
    for a, b, score, left, right in zip(rows, columns, scores, first, last):
        assert smith_waterman(a, b) == score
        if score:
            assert smith_waterman(a, b[left:right + 1]) == score


def test_matches_equal_brute_force(spark):
    rng = random.Random(8)
    items = [" ".join(rng.choices(WORDS, k=rng.randint(15, 40))) for _ in range(8)] + ["w1 w2", None, ""]
    texts = []
    for _ in range(40):
        words = rng.choices(WORDS, k=rng.randint(0, 80))
        for _ in range(rng.randint(0, 2)):
            copy = items[rng.randrange(8)].split()
            for _ in range(rng.choice([0, 1, 2, 4])):
                copy[rng.randrange(len(copy))] = rng.choice(WORDS)
            if rng.random() < 0.3:
                del copy[rng.randrange(len(copy))]
            at = rng.randint(0, len(words))
            words[at:at] = copy
        texts.append(" ".join(words).replace("w1", "W1") + "!")
    texts += [None, "", texts[0], " ".join([items[0]] * 30)]
    docs = documents(spark, texts)
    benchmark = spark.createDataFrame([(i, t, "x") for i, t in enumerate(items)] + [(8, items[0], "x")], "item_id long, text string, doc_id string")
    rows = contamination.matches(docs, benchmark).collect()
    found = {(r.doc_id, r.item_id, round(r.score, 9)) for r in rows}
    assert len(found) == len(rows)
    plain = lambda t: "".join(c if c.isalnum() else " " for c in (t or "").lower()).split()
    wanted, sure = set(), set()
    run = contamination.GRAM + contamination.WINDOW - 1
    for i, text in enumerate(texts):
        for k, item in [*enumerate(items), (8, items[0])]:
            a, b = plain(item), plain(text)
            if len(a) >= 3 and (share := smith_waterman(a, b) / (2 * len(a))) >= 0.5:
                wanted.add((i, k, round(share, 9)))
                runs = {tuple(b[p:p + run]) for p in range(len(b) - run + 1)}
                if any(tuple(a[p:p + run]) in runs for p in range(len(a) - run + 1)):  # these hold a seed
                    sure.add((i, k, round(share, 9)))
    assert sure <= found <= wanted and len(sure) >= 0.9 * len(wanted)
    for r in rows:
        passage = plain(texts[r.doc_id])[r.first_word:r.end_word]
        assert smith_waterman(plain([*items[:8], items[0]][r.item_id]), passage) == round(r.score * 2 * len(plain([*items[:8], items[0]][r.item_id])))
    clean = contamination.clean(docs, benchmark)
    assert clean.columns == docs.columns
    assert {r.doc_id for r in clean.collect()} == set(range(len(texts))) - {i for i, _, _ in found}


def test_edited_copies_equal_plain_alignment(spark):
    rng = random.Random(12)
    few = WORDS[:400]
    items = [" ".join(rng.choices(few, k=k)) for k in (3, 4, 9, 16, 16, 18, 18, 19)]  # too short for a passage but by score
    every_fifth = " ".join(rng.sample(WORDS[1000:], 40))
    texts = [" ".join("gone" if p % 5 == 4 else w for p, w in enumerate(every_fifth.split()))]
    for _ in range(240):
        copy = items[rng.randrange(8)].split()
        for _ in range(rng.randint(len(copy) // 5, len(copy) // 2)):  # 20 % of edits and more
            at = rng.randrange(len(copy))
            copy[at:at + 1] = rng.choice([[rng.choice(few)], [], [copy[at], rng.choice(few)]])
        texts.append(" ".join([*rng.choices(few, k=rng.randint(0, 30)), *copy, *rng.choices(few, k=rng.randint(0, 30))]))
    texts.append(" ".join(f"{w} between" for w in items[3].split()))  # no two words unbroken
    texts += [" ".join(rng.choices(few, k=60)) for _ in range(100)]
    items.append(every_fifth)
    benchmark = spark.createDataFrame(list(enumerate(items)), "item_id long, text string")
    wanted = {(i, k, round(share, 9)) for i, text in enumerate(texts) for k, item in enumerate(items)
              if (share := smith_waterman(item.split(), text.split()) / (2 * len(item.split()))) >= 0.5}
    rows = contamination.matches(documents(spark, texts), benchmark).collect()
    assert {(r.doc_id, r.item_id, round(r.score, 9)) for r in rows} == wanted and len(rows) == len(wanted)
    assert {(0, 8, 0.7125), (241, 3, round(17 / 32, 9))} <= wanted and len(wanted) > 100


def holds_passage(a, b):
    """Whether an alignment has 16 matches or more, and misses in at most 7 and a fifth of its columns."""
    last = [[-99] * 8 for _ in range(len(b) + 1)]  # most matches by number of misses
    for x in a:
        row = [[-99] * 8]
        for j, y in enumerate(b, 1):
            cell = [-99] * 8
            for e in range(8):
                if x == y:
                    cell[e] = max(last[j - 1][e], 0 if e == 0 else -99) + 1
                    if cell[e] >= 16 and cell[e] >= 4 * e:
                        return True
                if e:
                    cell[e] = max(cell[e], last[j - 1][e - 1], last[j][e - 1], row[j - 1][e - 1])
            row.append(cell)
        last = row
    return False


def test_passages_equal_brute_force():
    rng = random.Random(4)
    rows, columns = [], []
    for _ in range(150):
        a = rng.choices(range(1, 90), k=rng.randint(1, 60))
        copy = a[rng.randint(0, 20):][:rng.randint(15, 40)]
        for _ in range(rng.randint(0, 8) if copy else 0):
            at = rng.randrange(len(copy) or 1)
            copy[at:at + 1] = rng.choice([[99], [], [99, 98]])
        rows.append(np.array(a, np.uint64))
        columns.append(np.array([*rng.choices(range(1, 90), k=rng.randint(1, 30)), *copy, *rng.choices(range(1, 90), k=9)], np.uint64))
    many, first, last = contamination.passages(rows, columns)
    wanted = [holds_passage(a.tolist(), b.tolist()) for a, b in zip(rows, columns)]
    assert (many > 0).tolist() == wanted and 20 < sum(wanted) < 130
    for a, b, n, left, right in zip(rows, columns, many, first, last):
        assert not n or holds_passage(a.tolist(), b[left:right + 1].tolist())


def test_passages_of_long_items_are_found(spark):
    rng = random.Random(3)
    long, item = rng.choices(WORDS, k=500), rng.choices(WORDS, k=59)
    edited = ["gone" if p % 6 == 5 else w for p, w in enumerate(long[100:140])]
    around = rng.choices(WORDS, k=60)
    texts = [[*around, *item[10:39], *around], [*around, *long[200:400]], [*edited, *around],
             [*around, *long[:15], *around], ["gone" if p % 4 == 3 else w for p, w in enumerate(long[:60])]]
    docs = documents(spark, [" ".join(t) for t in texts])
    benchmark = spark.createDataFrame([(0, " ".join(item)), (1, " ".join(long))], "item_id long, text string")
    found = {(r.doc_id, r.item_id): r for r in contamination.matches(docs, benchmark).collect()}
    assert set(found) == {(0, 0), (1, 1), (2, 1)}
    assert all(r.score < 0.5 for r in found.values())
    assert found[0, 0].first_word <= 60 and found[0, 0].end_word >= 89
    assert sorted(r.doc_id for r in contamination.clean(docs, benchmark).collect()) == [3, 4]


def test_decontamination_of_empty_tables(spark):
    docs, none = documents(spark, ["a b c d e"]), spark.createDataFrame([], "item_id long, text string")
    assert contamination.matches(docs, none).count() == 0
    assert contamination.clean(docs, none).count() == 1
    one = spark.createDataFrame([(1, "a b c d e")], "item_id long, text string")
    assert contamination.matches(docs.limit(0), one).count() == 0
    assert contamination.clean(docs, one).count() == 0


def test_benchmark_blocks_give_the_same(spark, monkeypatch):
    docs = documents(spark, ["a b c d e f g", "p q r s t u", "zz"])
    items = spark.createDataFrame([(1, "a b c d e f"), (2, "p q r s t u"), (3, "g h i j k")], "item_id long, text string")
    whole = sorted(contamination.matches(docs, items).collect())
    monkeypatch.setattr(contamination, "BLOCK", 2)
    assert sorted(contamination.matches(docs, items).collect()) == whole and len(whole) == 2
