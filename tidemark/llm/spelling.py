"""Spelling variants: words of one edit from a much more frequent word are its variants.

Words and their counts come from all texts; tasks count in a bounded table before Spark adds the counts up.
Near words are found by dynamic programming down a sorted list: the words of a list are read in order, the banded rows
of the edit matrix (three cells, since only one edit is allowed) that belong to the prefix shared with the word before
are used again, and where no cell of a row is 1 or less, all words with that prefix are passed over.

The lists are parts of the vocabulary that a task can hold. One edit touches one half of a word, so two near words
share either what is before or what is after that half, and their lists go by ``(length, half, what is before, what is
after)``; each word stands in four lists. A list of more than ``limit`` words is split by the same rule: the half is halved
again, so that more of the word is fixed, until the part is one letter long, where a list cannot be longer than the square of
the alphabet. So no list grows with the input, no pair is lost, and words with the same beginning do not all meet.

A word's form is its near word with the largest count, if that is at least twice its own; counts at least double along
forms, so following them ends after log2(count) steps, and doubling pointers takes the logarithm of that in joins.

Defined cases: a NULL text has no words; a NULL id counts as the empty text in the damage rule; rows that repeat an id count
each; ties go to the word that is least in code-point order; texts and words of any length; extra columns are
ignored; an empty table gives an empty result.
"""

from __future__ import annotations

import collections
import re
import zlib

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from tidemark.llm.common import chunks, materialize, only, partitions, prepare

RUN = re.compile("[A-Za-zÀ-ÿ]+")
MIN_CHARS, MIN_COUNT, RATIO, DAMAGE = 5, 3, 2, 97
# Distinct words that a task counts before it hands them on, and words of a list.
HELD_WORDS, LIST_LIMIT = 100_000, 4_000
# Hot lists are broadcast by their keys up to so many.
BROADCAST_LISTS = 100_000
LISTS = ("length", "part", "before", "after")


def runs_of(text: str | None) -> collections.Counter:
    """Letter runs with A-Z in lower case, counted."""
    if not text:
        return collections.Counter()
    # Lower-casing bytes touches A-Z alone.
    return collections.Counter(RUN.findall(text.encode("utf-8", "surrogatepass").lower().decode("utf-8", "surrogatepass")))


def damaged(run: str, id_crc: int, every: int = DAMAGE) -> str:
    """The run, or where ``every`` divides crc32 of ``<doc_id>:<run>``, the run without one letter.

    ``id_crc`` is the crc32 of ``<doc_id>:``, which crc32 continues from.
    """
    h = zlib.crc32(run.encode("utf-8"), id_crc)
    if h % every:
        return run
    at = h % len(run)
    return run[:at] + run[at + 1:]


def vocabulary(docs: DataFrame, min_chars: int = MIN_CHARS, min_count: int = MIN_COUNT, every: int = DAMAGE) -> DataFrame:
    """``word, n`` of words that are long and frequent enough, after the damage rule."""
    texts = only(docs, "doc_id", "text").select(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("id"), "text")

    def run(batches):
        held = collections.Counter()

        def hand_on():
            out = pa.record_batch({"word": pa.array(list(held.keys()), pa.string()),
                                   "n": pa.array(list(held.values()), pa.int64())})
            held.clear()
            return out

        for batch in batches:
            for part in chunks(batch):
                for doc_id, text in zip(part.column("id").to_pylist(), part.column("text").to_pylist()):
                    id_crc = zlib.crc32(f"{doc_id}:".encode())
                    for found, n in runs_of(text).items():
                        if len(found) >= min_chars and len(word := damaged(found, id_crc, every)) >= min_chars:
                            held[word] += n
                if len(held) >= HELD_WORDS:
                    yield hand_on()
        yield hand_on()

    counted = texts.mapInArrow(run, "word string, n long")
    return counted.groupBy("word").agg(F.sum("n").alias("n")).filter(F.col("n") >= min_count)


def in_lists(words: DataFrame, parts: int) -> DataFrame:
    """Each word in the lists of every one of ``parts`` parts of its letters, as the shorter and as the longer of a pair.

    ``length`` is that of the shorter word. The part that an edit touches is ``middle``; what is before and after
    it is the same in both words.
    """
    size, length = F.char_length("word"), F.col("length")
    start = F.floor(length * F.col("part") / parts).cast("int")
    rest = length - F.floor(length * (F.col("part") + 1) / parts).cast("int")
    return (
        words.withColumn("length", F.explode(F.array(size, size - 1)))
        .withColumn("part", F.explode(F.sequence(F.lit(0), F.lit(parts - 1))))
        # A part without letters of its own is only of use for insertions there, which its neighbour covers.
        .withColumn("start", start).withColumn("rest", rest).filter(F.col("start") + F.col("rest") < length)
        .select(
            *_key(F.col("word"), F.col("start"), F.col("rest"), size), "word", "n",
            F.substring("word", F.col("start") + 1, size - F.col("start") - F.col("rest")).alias("middle"))
    )


def _key(word: Column, start: Column, rest: Column, size: Column) -> list[Column]:
    return [F.col("length"), F.col("part"), F.substring(word, F.lit(1), start).alias("before"),
            F.substring(word, size - rest + 1, rest).alias("after")]


def scan(words: list[str]) -> list[tuple[int, int]]:
    """Pairs ``i < j`` of one edit in a sorted list without copies.

    For each word, the list behind it is read once. ``rows[t]`` holds the cells (t, t-1), (t, t), (t, t+1) of its edit
    matrix, t letters of the word read against t-1, t and t+1 of its own; 2 and more is too many.
    """
    n, found = len(words), []
    shared = [0] * (n + 1)
    for j in range(1, n):
        x, y = words[j - 1], words[j]
        t, most = 0, min(len(x), len(y))
        while t < most and x[t] == y[t]:
            t += 1
        shared[j] = t
    for i, word in enumerate(words):
        size, j = len(word), i + 1
        rows = [(2, 0, 1 if size else 2)]
        while j < n:
            # Rows of the letters shared with the word read before, as far as they were made.
            t = min(len(rows) - 1, shared[j])
            del rows[t + 1:]
            left, here, right = rows[t]
            other = words[j]
            for c in other[t:]:
                # Cells beyond the word's end are out of reach.
                a = min(left + (word[t - 1] != c) if 0 < t <= size else 2, here + 1)
                b = min(here + (word[t] != c), right + 1, a + 1) if t < size else 2
                d = min(right + (word[t + 1] != c), b + 1) if t + 1 < size else 2
                left, here, right = a, b, d
                t += 1
                rows.append((a, b, d))
                if a > 1 and b > 1 and d > 1:
                    break
            j += 1
            if left > 1 and here > 1 and right > 1:
                # Every word that begins with these t letters is further than one edit away.
                while j < n and shared[j] >= t:
                    j += 1
            elif -1 <= size - len(other) <= 1 and (left, here, right)[size - len(other) + 1] == 1:
                found.append((i, j - 1))
    return found


def _near_in_lists(batches):
    """Rows sorted by list and middle: pairs of one edit, both ways."""
    key, middles, words, counts = None, [], [], []

    def solve():
        pairs = scan(middles)
        a, b = [i for i, _ in pairs], [j for _, j in pairs]
        one, two = a + b, b + a
        return pa.record_batch({
            "word": pa.array([words[i] for i in one], pa.string()), "n": pa.array([counts[i] for i in one], pa.int64()),
            "near": pa.array([words[i] for i in two], pa.string()), "near_n": pa.array([counts[i] for i in two], pa.int64())})

    for batch in batches:
        columns = [batch.column(c).to_pylist() for c in (*LISTS, "middle", "word", "n")]
        for *mine, middle, word, n in zip(*columns):
            if mine != key:
                if len(words) > 1:
                    yield solve()
                key, middles, words, counts = mine, [], [], []
            middles.append(middle)
            words.append(word)
            counts.append(n)
    if len(words) > 1:
        yield solve()


def near_pairs(words: DataFrame, limit: int = LIST_LIMIT) -> DataFrame:
    """``word, n, near, near_n``: all pairs of words that are exactly one edit apart, each both ways.

    ``words`` is stored. Lists that are too long come back with parts half as long, until none is.
    """
    found, parts, todo = None, 2, in_lists(words, 2)
    while True:
        lists = materialize(todo, "lists")
        hot = lists.groupBy(*LISTS).agg(F.count(F.lit(1)).alias("size")).filter(F.col("size") > limit).select(*LISTS)
        seen = Observation()
        hot = materialize(hot.observe(seen, F.count(F.lit(1)).alias("n"), F.max("length").alias("length")), "hot-lists")
        # Parts of one letter cannot be split.
        split = seen.get["n"] and parts < seen.get["length"]
        side = F.broadcast(hot) if seen.get["n"] <= BROADCAST_LISTS else hot
        now = lists.join(side, list(LISTS), "left_anti") if split else lists
        pairs = (now.repartition(partitions(words.sparkSession), *LISTS).sortWithinPartitions(*LISTS, "middle")
                 .mapInArrow(_near_in_lists, "word string, n long, near string, near_n long"))
        found = pairs if found is None else found.unionByName(pairs)
        if not split:
            # A pair whose edit is at the edge of two parts, or inside a run of one letter, is found in both.
            return found.distinct()
        hot_rows = lists.join(side, list(LISTS), "left_semi").select("word", "n", "length", "part")
        todo, parts = split_lists(hot_rows, parts), parts * 2


def split_lists(rows: DataFrame, parts: int) -> DataFrame:
    """Rows of lists with ``parts`` parts, in the lists of the two halves of their part."""
    size, length = F.char_length("word"), F.col("length")
    start = F.floor(length * F.col("part") / (2 * parts)).cast("int")
    rest = length - F.floor(length * (F.col("part") + 1) / (2 * parts)).cast("int")
    return (
        rows.withColumn("part", F.explode(F.array(F.col("part") * 2, F.col("part") * 2 + 1)))
        .withColumn("start", start).withColumn("rest", rest).filter(F.col("start") + F.col("rest") < length)
        .select(
            *_key(F.col("word"), F.col("start"), F.col("rest"), size), "word", "n",
            F.substring("word", F.col("start") + 1, size - F.col("start") - F.col("rest")).alias("middle"))
    )


def roots(forms: DataFrame) -> DataFrame:
    """``word, root`` for each row of ``forms`` (``word, form``): the last word along forms, by doubling pointers."""
    now = materialize(forms.select("word", F.col("form").alias("root")), "roots")
    while True:
        seen = Observation()
        onward = now.select(F.col("word").alias("root"), F.col("root").alias("next"))
        after = now.join(onward, "root", "left").select("word", F.coalesce("next", "root").alias("root"),
                                                        F.col("next").isNotNull().alias("moved"))
        now = materialize(after.observe(seen, F.count_if("moved").alias("moved")), "roots").drop("moved")
        if not seen.get["moved"]:
            return now


def variants(docs: DataFrame, min_chars: int = MIN_CHARS, min_count: int = MIN_COUNT, ratio: int = RATIO,
             every: int = DAMAGE, limit: int = LIST_LIMIT) -> DataFrame:
    """``word, form, root, n, n_near, form_n`` for every word of the vocabulary of ``docs``."""
    prepare(docs.sparkSession)
    words = materialize(vocabulary(docs, min_chars, min_count, every), "vocabulary")
    best = F.min(F.struct((-F.col("near_n")).alias("minus"), F.col("near").alias("near")))
    chosen = near_pairs(words, limit).groupBy("word", "n").agg(F.count(F.lit(1)).alias("n_near"), best.alias("best"))
    strong = -F.col("best.minus") >= ratio * F.col("n")
    chosen = materialize(chosen.select(
        "word", "n_near", F.when(strong, F.col("best.near")).alias("form"),
        F.when(strong, -F.col("best.minus")).alias("form_n")), "forms")
    ends = roots(chosen.filter(F.col("form").isNotNull()))
    return (
        words.join(chosen, "word", "left").join(ends, "word", "left")
        .select("word", "form", F.coalesce("root", "word").alias("root"), "n",
                F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"), "form_n")
    )
