"""Quality rules: verdicts against each rule's own definition, the order of the cascade, and texts of any length."""

import random

import duckdb
import fixtures_llm as fx
import numpy as np
import pyarrow as pa
import pytest

from tidemark.llm import quality
from tidemark.llm.queries import QUERIES

NAMES = [rule.name for rule in quality.RULES]


def plain(n: int, seed: int = 1) -> list[str]:
    draw = random.Random(seed)
    return ["".join(draw.choice("abcdefghij") for _ in range(draw.randrange(3, 9))) for _ in range(n)]


def few_words(n: int) -> str:
    """Words of a vocabulary of six whose windows of three hardly repeat."""
    draw = random.Random(5)
    triples = [(a, b, c) for a in "abcdef" for b in "abcdef" for c in "abcdef"]
    draw.shuffle(triples)
    return " ".join(w * 3 for t in triples for w in t)[:n]


# A text for each rule to reject, and one that none does.
PLANTED = [
    (1, " ".join(plain(200))),
    (2, " ".join(w[0] for w in plain(20)) + " " + " ".join(chr(0x3B1 + i) for i in range(80))),
    (3, " ".join(w + "#" * (i % 2) for i, w in enumerate(plain(200)))),
    (4, "\n".join(random.Random(4).choices(plain(20), k=100))),
    (5, " ".join(plain(200)).upper()),
    (6, " ".join(w + "!?" for w in plain(200))),
    (7, " ".join(str(10**5 + 7919 * i) for i in range(200))),
    (8, " ".join(w[:1] + "--::;;" + w[1:2] for w in plain(200))),
    (9, few_words(400)),
    (10, " ".join(w * 12 for w in plain(100))),
]


@pytest.mark.parametrize("rows", ["documents", "planted", "cases"])
def test_verdicts(spark, rows):
    if rows == "documents":
        texts = duckdb.sql(f"SELECT doc_id, text FROM '{fx.SF_DIR}/documents.parquet'").fetchall()
        found = QUERIES["op2_quality_rules"](spark, fx.SF_DIR)
    else:
        texts = PLANTED if rows == "planted" else fx.CASES
        found = quality.judge(fx.cases(spark, texts))
    expected = [(d, fx.quality_rejections(t)) for d, t in texts]
    got = [(r["doc_id"], r["base_failed"], r["kept"], r["rejected_by"]) for r in found.collect()]
    assert sorted(((d, b, k) for d, b, k, _ in got), key=repr) == sorted(
        ((d, r == {"base"}, not r) for d, r in expected), key=repr)
    if rows != "cases":
        rejections = dict(expected)
        assert all(by in rejections[d] if by else not rejections[d] for d, _, _, by in got)


def test_every_rule_has_a_planted_text():
    assert set().union(*(fx.quality_rejections(t) for _, t in PLANTED)) >= set(NAMES)


def test_order_takes_what_the_rules_before_leave():
    # Rule 1 rejects most per cost. What rule 0 rejects is then gone but for one text, so rule 2 comes before it.
    rejected = np.array([[1, 1, 1, 1, 0, 0, 0], [1, 1, 1, 0, 0, 0, 0], [0, 0, 0, 0, 1, 1, 0], [0] * 7, [0] * 7], bool)
    assert quality.cheapest_order(rejected, np.array([2.0, 1.0, 1.5, 5.0, 4.0])) == [1, 2, 0, 4, 3]


def test_order_without_texts_that_pass_the_base_test():
    assert quality.order_rules(pa.array(["too short", None, ""], pa.large_string())) == quality.RULES
    assert quality.order_rules(pa.array([], pa.large_string())) == quality.RULES


@pytest.mark.parametrize("block", [1, 7, 64, 1000])
def test_blocks_change_no_figure(block):
    texts = [t for _, t in fx.CASES if len(t or "") < 2000] + [t for _, t in PLANTED[:4]] + ["z" * 300 + " y " + "z" * 300, "z z z z"]
    column = pa.array(texts, pa.large_string())
    whole, parts = quality.Texts(column), quality.Texts(column, block)
    for name, figures in whole.base().items():
        assert figures.tolist() == parts.base()[name].tolist(), name
    assert [fx.base_figures(t) for t in texts] == list(zip(*(v.tolist() for v in parts.base().values())))


def test_very_long_texts(spark):
    """Texts of 9 MiB: words and repeated lines; one word; line ends only."""
    draw = random.Random(3)
    words = plain(5000)
    lines = [" ".join(draw.choices(words, k=draw.randrange(1, 12))) for _ in range(20_000)]
    rows = [(1, "\n".join(draw.choices(lines, k=280_000))), (2, "x" * (9 << 20)), (3, "\n" * (9 << 20)), (4, "short"),
            (5, ("q" * (3 << 20) + " ") * 3 + "end")]
    assert len(rows[0][1]) > 8 << 20
    names = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
    got = {r["doc_id"]: tuple(r[n] for n in names) for r in quality.judge(fx.cases(spark, rows)).collect()}
    assert got == {i: fx.base_figures(t) for i, t in rows}
