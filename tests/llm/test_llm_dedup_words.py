"""Exact deduplication and spelling variants, against SQL and brute force."""

import collections
import hashlib
import random
import zlib

import compare
import fixtures_llm as fx
import pytest
from pyspark.sql import functions as F

from tidemark.llm import exact_dedup, spelling
from tidemark.llm.queries import ORACLES, QUERIES


@pytest.fixture(scope="module")
def con():
    return compare.connect(fx.SF_DIR)


@pytest.mark.parametrize("name", ["op11_exact_dedup", "op13_spelling_variants"])
def test_equal_to_sql(spark, con, name):
    found = compare.differences(QUERIES[name](spark, fx.SF_DIR), con, ORACLES[name])
    assert not found, "\n".join(found)


# 11

def brute_copies(rows):
    groups = collections.defaultdict(list)
    for i, text in rows:
        groups[fx.ascii_lower(text or "")].append(i)
    out = []
    for text, ids in groups.items():
        keep = max((i for i in ids if i is not None), default=None)
        ids.sort(key=lambda i: (i is not None, i), reverse=True)
        out += [(i, keep, len(ids), at == 0, hashlib.sha256(text.encode()).hexdigest()) for at, i in enumerate(ids)]
    return sorted(out, key=repr)


COPIES = [*fx.CASES, (20, "ABC é"), (21, "abc é"), (22, "abc É"), (23, "aBc é"), (22, "abc É"),
          *[(100 + i, "Hot TEXT" if i % 2 else "hot text") for i in range(400)], *[(1000 + i, f"text {i // 2}") for i in range(300)]]


@pytest.mark.parametrize("rows", [fx.CASES, COPIES, [(None, None), (None, "")]])
def test_copies(spark, rows):
    found = exact_dedup.find_copies(fx.cases(spark, rows))
    assert found.columns == ["doc_id", "keep_id", "group_size", "kept", "text_sha256"]
    assert sorted((tuple(r) for r in found.collect()), key=repr) == brute_copies(rows)


def test_frequent_digests_are_settled_without_a_shuffle(spark):
    rows = spark.range(40_000).select(
        F.col("id").alias("doc_id"),
        F.when(F.col("id") % 3 == 0, "hot").when(F.col("id") % 50 == 1, "warm").otherwise(F.col("id").cast("string")).alias("text"))
    digests = rows.select("doc_id", exact_dedup.digest(F.col("text")).alias("text_sha256"), F.lit(0).alias("row"))
    winners = {r["text_sha256"]: (r["group_size"], r["stays"]["doc_id"]) for r in exact_dedup.winners_of(digests).collect()}
    hot, warm = (hashlib.sha256(t).hexdigest() for t in (b"hot", b"warm"))
    assert winners[hot] == (13_334, 39_999) and winners[warm][0] == rows.filter("text = 'warm'").count()
    assert len(winners) <= exact_dedup.CANDIDATES
    plan = exact_dedup.find_copies(rows)._jdf.queryExecution().executedPlan().toString()
    assert not any(word in plan for word in ("Python", "Pandas", "Arrow"))


@pytest.mark.parametrize("rows", [fx.CASES, COPIES])
def test_drop_copies(spark, rows):
    kept = exact_dedup.drop_copies(fx.cases(spark, rows))
    assert kept.columns == fx.cases(spark, rows).columns
    expected = sorted((r[0], r[4]) for r in brute_copies(rows) if r[3] and r[0] is not None)
    found = [(r["doc_id"], hashlib.sha256(fx.ascii_lower(r["text"] or "").encode()).hexdigest()) for r in kept.collect()]
    assert sorted(x for x in found if x[0] is not None) == expected


def test_copies_with_clashing_names(spark):
    one = spark.createDataFrame([(1, "A", 5, "x", 1, "y"), (2, "a", 6, "x", 1, "z")], "doc_id long, text string, row int, text_sha256 string, rank int, TEXT string")
    assert [r["doc_id"] for r in exact_dedup.drop_copies(one).collect()] == [2]
    assert [r["doc_id"] for r in exact_dedup.find_copies(one).collect() if r["kept"]] == [2]
    twice = one.toDF("doc_id", "text", "doc_id", "text", "keep_id", "kept")
    assert exact_dedup.drop_copies(twice).columns == twice.columns and exact_dedup.drop_copies(twice).count() == 1


def test_copies_of_nothing(spark):
    assert exact_dedup.find_copies(fx.empty(spark)).count() == 0
    assert exact_dedup.drop_copies(fx.empty(spark)).count() == 0


# 13

def one_edit(x: str, y: str) -> bool:
    if x == y or abs(len(x) - len(y)) > 1:
        return False
    if len(x) == len(y):
        return sum(a != b for a, b in zip(x, y)) == 1
    short, long = sorted((x, y), key=len)
    return any(long[:i] + long[i + 1:] == short for i in range(len(long)))


def brute_variants(rows, min_chars=5, min_count=3, every=97):
    counts = collections.Counter()
    for i, text in rows:
        for run in spelling.RUN.findall(fx.ascii_lower(text or "")):
            h = zlib.crc32(f"{'' if i is None else i}:{run}".encode())
            counts[run if h % every else run[:h % len(run)] + run[h % len(run) + 1:]] += 1
    words = {w: n for w, n in counts.items() if len(w) >= min_chars and n >= min_count}
    near = {w: [v for v in words if one_edit(w, v)] for w in words}
    form = {}
    for w, n in words.items():
        best = min(near[w], key=lambda v: (-words[v], v), default=None)
        form[w] = best if best is not None and words[best] >= 2 * n else None
    out = []
    for w, n in words.items():
        root = w
        while form[root] is not None:
            root = form[root]
        out.append((w, form[w], root, n, len(near[w]), words[form[w]] if form[w] else None))
    return sorted(out, key=repr)


def rows_of(df):
    return sorted((tuple(r) for r in df.select("word", "form", "root", "n", "n_near", "form_n").collect()), key=repr)


@pytest.mark.parametrize("letters,size", [("ab", 4), ("abc", 6), ("aé", 9)])
def test_scan_finds_exactly_the_pairs_of_one_edit(letters, size):
    draw = random.Random(size)
    for _ in range(40):
        words = sorted({"".join(draw.choices(letters, k=draw.randint(0, size))) for _ in range(60)})
        expected = [(i, j) for i in range(len(words)) for j in range(i + 1, len(words)) if one_edit(words[i], words[j])]
        assert sorted(spelling.scan(words)) == expected


@pytest.mark.parametrize("limit", [3, 50, 100_000])
def test_lists_lose_no_pair(spark, limit):
    draw = random.Random(5)
    words = {"".join(draw.choices("abé", k=draw.randint(5, 8))) for _ in range(500)} | {"word" + "".join(draw.choices("xyz", k=7)) for _ in range(300)}
    table = spark.createDataFrame([(w, 3) for w in words], "word string, n long")
    found = {(r["word"], r["near"]) for r in spelling.near_pairs(table, limit).collect()}
    assert found == {(a, b) for a in words for b in words if one_edit(a, b)}


def chains():
    """Forms that lead on: each word is twice as frequent as the one before, one edit away."""
    steps = ["abcdefgh", "abcdefgx", "abcdefyx", "abcdezyx", "abcwezyx", "abvwezyx"]
    return [(i, " ".join([w.upper() if i % 2 else w] * 3 * 2 ** i)) for i, w in enumerate(steps)]


@pytest.mark.parametrize("rows", [
    fx.CASES, chains(),
    [(i, "Zebra zebra, Zebras Zebras Zebras; zébra ZÉBRA zÉbra" * (1 + i % 3)) for i in range(60)],
    [(i, f"über Straße {'x' * 40} {'a' * (4 + i % 4)} straßen naïve naive ÷×÷×÷ word{i}") for i in range(300)],
    [(1, "a" * 3000 + " " + "a" * 2999), (2, " ".join(["a" * 3000] * 9)), (3, " ".join(["a" * 2999] * 3))],
])
def test_variants(spark, rows):
    assert rows_of(spelling.variants(fx.cases(spark, rows), limit=5)) == brute_variants(rows)


def test_variants_of_nothing(spark):
    assert rows_of(spelling.variants(fx.empty(spark))) == []
    assert rows_of(spelling.variants(fx.cases(spark, [(1, None), (2, ""), (None, "words")]))) == []


def test_variants_with_clashing_names(spark):
    docs = spark.createDataFrame([(1, "words words words wordz", "x", "y", 3)], "doc_id long, text string, TEXT string, word string, n int")
    assert [r["word"] for r in spelling.variants(docs, every=10**9).collect()] == ["words"]
