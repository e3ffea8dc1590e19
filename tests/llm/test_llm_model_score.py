"""The language model's ``score`` against plainly counted unigrams and bigrams."""

import collections
import math

import duckdb
import fixtures_llm as fx
import pytest

from tidemark.llm import lm


def plain_scores(rows, level: bool):
    """By position: log10 probability of each text; ``level``: counts stand for the middle of their range, as stored."""
    texts = [fx.WORD.findall(fx.ascii_lower(t or "")) + [None] for _, t in rows]
    train = [ws for (i, _), ws in zip(rows, texts) if fx.fold(i, 7) != 2]
    uni = collections.Counter(w for ws in train for w in ws)
    pairs = collections.Counter(p for ws in train for p in zip(["begin of text"] + [("w", w) for w in ws[:-1]], ws))
    norm = sum(uni.values()) + len(uni) + 1

    def middle(n: int) -> float:
        if not level or not n:
            return float(n)
        q = 1 + math.floor(math.log(n) / math.log(1.5) + 1e-9)
        low, high = math.ceil(1.5 ** (q - 1) - 1e-9), math.ceil(1.5 ** q - 1e-9) - 1
        return (low + max(low, high)) / 2

    out = []
    for ws in texts:
        total = 0.0
        for v, w in zip(["begin of text"] + [("w", w) for w in ws[:-1]], ws):
            before = float(len(train)) if v == "begin of text" else middle(uni[v[1]])
            pair = min(middle(pairs[v, w]), before)
            total += math.log10((pair + lm.MU * (middle(uni[w]) + 1) / norm) / (before + lm.MU))
        out.append(total)
    return out


@pytest.mark.parametrize("table", ["documents", "cases"])
def test_score_is_the_model_of_exact_counts(spark, monkeypatch, table):
    """With a filter that hardly errs, scores are those of counted n-grams; what rounding counts does is small."""
    monkeypatch.setattr(lm, "ERROR_RATE", 1e-9)
    rows = fx.CASES if table == "cases" else duckdb.sql(f"SELECT doc_id, text FROM '{fx.SF_DIR}/documents.parquet' ORDER BY doc_id").fetchall()
    found = sorted(((r["doc_id"], r["score"]) for r in lm.score_documents(fx.cases(spark, rows)).collect()), key=repr)
    stored = sorted(((i, s) for (i, _), s in zip(rows, plain_scores(rows, True))), key=repr)
    assert [i for i, _ in found] == [i for i, _ in stored]
    assert all(abs(x - y) <= 1e-6 * max(1, abs(y)) for (_, x), (_, y) in zip(found, stored))
    exact = dict(zip([i for i, _ in rows], plain_scores(rows, False)))
    tokens = {i: len(fx.WORD.findall(t or "")) + 1 for i, t in rows}
    # Levels are steps of 1.5, so a count is off by a quarter at most, and a probability by the square of that.
    assert all(abs(s - exact[i]) <= 2 * math.log10(1.25) * tokens[i] for i, s in found if i is not None)


def test_the_filter_as_used_changes_scores_little(spark):
    """False hits raise a level now and then: the mean effect per token stays below a hundredth."""
    rows = duckdb.sql(f"SELECT doc_id, text FROM '{fx.SF_DIR}/documents.parquet' ORDER BY doc_id").fetchall()
    found = {r["doc_id"]: (r["score"], r["n_tokens"]) for r in lm.score_documents(fx.cases(spark, rows)).collect()}
    plain = {i: s for (i, _), s in zip(rows, plain_scores(rows, True))}
    off = sum(found[i][0] - plain[i] for i in plain)
    assert abs(off) / sum(n for _, n in found.values()) < 0.01


@pytest.mark.parametrize("filter_bits", [1 << 12, lm.FILTER_BITS])
def test_many_ranges_and_small_lots_change_no_score(spark, monkeypatch, filter_bits):
    """Ranges follow the text, and tallies are sent whenever they are full; scores are those of one range held whole."""
    docs = spark.read.parquet(f"{fx.SF_DIR}/documents.parquet")

    def scores():
        return {r["doc_id"]: tuple(r) for r in lm.score_documents(docs, head=200, filter_bits=filter_bits).collect()}

    monkeypatch.setattr(lm, "ERROR_RATE", 1e-9)
    whole = scores()
    monkeypatch.setattr(lm, "RANGE_BYTES", 1 << 14)
    monkeypatch.setattr(lm, "ENTRIES_AT_ONCE", 500)
    small = scores()
    assert whole.keys() == small.keys()
    assert all(small[i] == pytest.approx(whole[i], rel=1e-9) for i in whole)


def test_a_tally_adds_up_what_comes():
    import numpy as np

    rng, tally, plain = np.random.default_rng(1), lm.Tally(), collections.Counter()
    for _ in range(40):
        keys, counts = rng.integers(0, 300, 50).astype(np.uint64), rng.integers(1, 9, 50)
        tally.add(keys, counts)
        for k, n in zip(keys.tolist(), counts.tolist()):
            plain[k] += n
    keys, counts = tally.total()
    assert dict(zip(keys.tolist(), counts.tolist())) == plain and (np.diff(keys.astype(np.int64)) > 0).all()
    assert [len(x) for x in lm.Tally().total()] == [0, 0]
