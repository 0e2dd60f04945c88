"""Spelling variants: words one letter apart, found on a bit-sliced position index.

The vocabulary is the distinct words of all texts with their counts. Two words are near if one
inserted, deleted or replaced code point turns one into the other. Near words share a long
beginning or a long end: if the shorter has n letters, their common beginning and end are n - 1
letters or more together, so one of them is n // 2 or more. Words are therefore dealt to blocks by
the first and by the last n // 2 letters, for n their own length and one less.

In a block there is a bitset over its words for every (position, letter). A word of n letters is
followed letter by letter through three sets: the words that agree so far (zero errors), those of
its length with one replaced letter so far, and those of one letter more with one inserted letter so
far. A step takes the bitset of the letter at its position and, for the third set, at the position
shifted by one; all words of the block advance at once. A deletion is an insertion seen from the
other word. The letters that define a block are skipped. A block with more than ``BLOCK`` words is
dealt again by half of the letters left, as often as needed: the same argument holds for them,
and when one letter is left a block holds no more words than the alphabet allows. A pair that two
blocks see is reported by the one with the common beginning.

A word's form is its near word of largest count (ties: the smallest), if that is ten times as
common; the root is where forms end. As counts grow tenfold with each form, there is no circle.

Defined results: a null text has no words, a null id is written as the empty text before the
colon; ids and texts may repeat, each row counts. An empty table gives no rows. A run of letters is
one word however long; other columns are ignored. Counts combine before the shuffle, so a word
that a third of all texts repeat is one row for each task.
"""

from __future__ import annotations

import string

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillbridge.llm.common import Scratch
from tillbridge.operators.hotkeys import hot_keys
from tillbridge.sinks.store import broadcast_if_small

LETTERS = 7  # least length of a word
TIMES = 10  # how much more common a form is
BLOCK = 2048  # most words of a block that can still be dealt again
_KEY = ["n", "head", "tail", "bar", "letters"]


def occurrences(docs: DataFrame) -> DataFrame:
    """``word``, one row for each run of letters; every 31st run by its checksum lost a letter."""
    runs = docs.select(
        F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("id"),
        F.explode(F.regexp_extract_all("text", F.lit(f"[A-Za-zÀ-ÿ]{{{LETTERS},}}"), F.lit(0))).alias("run"))
    lower = runs.select("id", F.translate("run", string.ascii_uppercase, string.ascii_lowercase).alias("run"))
    hashed = lower.withColumns({"h": F.crc32(F.concat("id", F.lit(":"), "run").cast("binary")), "size": F.char_length("run")})
    return hashed.selectExpr(
        "IF(h % 31 = 0, overlay(run PLACING '' FROM CAST(h % size AS INT) + 1 FOR 1), run) AS word",
    ).where(F.char_length("word") >= LETTERS)


def vocabulary(docs: DataFrame) -> DataFrame:
    """``word``, ``n`` of the words that occur twice or more."""
    return occurrences(docs).groupBy("word").agg(F.count("*").alias("n")).where("n >= 2")


def _dealt(words: DataFrame) -> DataFrame:
    """A row for each word and block it belongs to. A block's words have n or n + 1 letters, and
    agree in the first ``head`` and the last ``tail`` ones; its pairs agree in fewer than ``bar`` first."""
    classes = words.select("word", F.col("n").alias("many"), F.explode(F.expr(
        f"filter(array(char_length(word), char_length(word) - 1), x -> x >= {LETTERS})")).alias("n"))
    none = (1 << 31) - 1
    return _lettered(classes.selectExpr(
        "word", "many", "n", "explode(array("
        f"struct(n div 2 AS head, 0L AS tail, {none}L AS bar), struct(0L AS head, n div 2 AS tail, n div 2 AS bar))) AS b",
    ).select("word", "many", "n", "b.*"))


def _dealt_again(rows: DataFrame) -> DataFrame:
    half = "((n - head - tail) div 2)"
    return _lettered(rows.selectExpr(
        "word", "many", "n", "explode(array("
        f"struct(head + {half} AS head, tail, bar), struct(head, tail + {half} AS tail, least(bar, head + {half}) AS bar))) AS b",
    ).select("word", "many", "n", "b.*"))


def _lettered(rows: DataFrame) -> DataFrame:
    return rows.withColumn("letters", F.expr(
        "concat(substr(word, 1, CAST(head AS INT)), substr(word, CAST(char_length(word) - tail + 1 AS INT)))"))


def _blocks(words: DataFrame, scratch: Scratch, most: int) -> DataFrame:
    """Blocks of two words or more: their key, ``words`` and ``many``, their counts."""
    done, rows = [], scratch.keep(_dealt(words), "dealt")
    while True:
        key = F.xxhash64(*_KEY)
        # A block that nothing can split is bounded by the alphabet.
        large = scratch.keep(hot_keys(rows, F.when(F.expr("n - head - tail > 1"), key), most + 1), "large")
        if large.isEmpty():
            done.append(rows)
            break
        small = broadcast_if_small(large)
        done.append(rows.join(small, key == F.col("k"), "left_anti"))
        rows = scratch.keep(_dealt_again(rows.join(small, key == F.col("k"), "left_semi")), "dealt")
    parts = [r.groupBy(*_KEY).agg(F.collect_list("word").alias("words"), F.collect_list("many").alias("many")).where(
        F.size("words") > 1) for r in done]
    union = parts[0]
    for part in parts[1:]:
        union = union.unionByName(part)
    return union


def near_in_block(words: list[str], n: int, head: int, tail: int):
    """(i, list of j) for the words of n letters: the near words of the block, of n or n + 1.

    All words have n or n + 1 letters, agree in the first ``head`` and last ``tail``, and differ.
    """
    index: list[dict[str, int]] = [{} for _ in range(n + 2 - tail)]
    long = 0
    for j, word in enumerate(words):
        bit = 1 << j
        if len(word) > n:
            long |= bit
        for p in range(head, len(word) - tail):
            index[p][word[p]] = index[p].get(word[p], 0) | bit
    every = (1 << len(words)) - 1
    for i, word in enumerate(words):
        if len(word) > n:
            continue
        zero, replaced, inserted = every, 0, 0
        for p in range(head, n - tail):
            here = index[p].get(word[p], 0)
            inserted = (inserted | zero) & index[p + 1].get(word[p], 0)
            agree = zero & here
            replaced = replaced & here | zero ^ agree
            zero = agree
        found = replaced & ~long | (inserted | zero) & long
        if found:
            near = []
            while found:
                low = found & -found
                near.append(low.bit_length() - 1)
                found ^= low
            yield i, near


def _near(batches):
    """For each word of a block: its near words there, counted, and the most common of them."""
    for batch in batches:
        out: list[tuple[str, int, int, str]] = []
        for n, head, tail, bar, words, many in zip(*(batch[c].to_pylist() for c in ("n", "head", "tail", "bar", "words", "many"))):
            best: dict[int, tuple] = {}
            for i, near in near_in_block(words, n, head, tail):
                for j in near:
                    if words[i][:bar] != words[j][:bar]:  # otherwise the block of the common beginning has it
                        for a, b in ((i, j), (j, i)) if len(words[j]) > n else ((i, j),):
                            count, top = best.get(a, (0, (0, "")))
                            best[a] = count + 1, min(top, (-many[b], words[b]))
            out += [(words[a], count, -top[0], top[1]) for a, (count, top) in best.items()]
            if len(out) > 10_000:
                yield _rows(out)
                out = []
        yield _rows(out)


def _rows(rows):
    columns = list(zip(*rows)) or [[], [], [], []]
    return pa.RecordBatch.from_arrays(
        [pa.array(c, t) for c, t in zip(columns, (pa.string(), pa.int64(), pa.int64(), pa.string()))],
        ["word", "n_near", "form_n", "form"])


def variants(docs: DataFrame, most: int = BLOCK) -> DataFrame:
    """``word``, ``n``, ``n_near``, ``form``, ``form_n``, ``root`` for every word of the vocabulary."""
    scratch = Scratch(docs.sparkSession, "spelling")
    words = scratch.keep(vocabulary(docs), "words")
    seen = _blocks(words, scratch, most).mapInArrow(_near, "word string, n_near long, form_n long, form string")
    near = seen.groupBy("word").agg(
        F.sum("n_near").alias("n_near"), F.min(F.struct((-F.col("form_n")).alias("less"), "form")).alias("top"))
    common = F.expr(f"-top.less >= {TIMES} * n")
    found = scratch.keep(words.join(near, "word", "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
        F.when(common, F.col("top.form")).alias("form"), F.when(common, -F.col("top.less")).alias("form_n")), "found")
    roots = _roots(found.where("form IS NOT NULL").select("word", F.col("form").alias("root")), scratch)
    whole = scratch.keep(found.join(roots, "word", "left").withColumn("root", F.coalesce("root", "word")), "variants")
    scratch.drop_all_but(whole)
    return whole


def _roots(links: DataFrame, scratch: Scratch) -> DataFrame:
    """Where each word's links end; every pass doubles the links that are followed."""
    at = scratch.keep(links, "links")
    while True:
        onward = at.select(F.col("word").alias("root"), F.col("root").alias("onward"))
        if at.join(onward, "root", "left_semi").isEmpty():
            return at
        at = scratch.keep(at.join(onward, "root", "left").select("word", F.coalesce("onward", "root").alias("root")), "links")
