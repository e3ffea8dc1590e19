"""Texts above 8 MiB and a word of a million letters without white space: longer than any slice that tasks work on."""

import hashlib
import random
import struct

import fixtures_llm as fx
import pytest
import public_tokenizers
from test_llm_queries import plain_encoding

from tidemark.llm import bpe, decontamination, line_dedup, lm, near_dedup, token_counts, toxicity

DRAW = random.Random(11)
VOCABULARY = ["".join(DRAW.choice("abcdefghijklmnop") for _ in range(DRAW.randrange(3, 10))) for _ in range(20_000)]
ITEM = [f"planted{i}" for i in range(20)]
WORDS = DRAW.choices(VOCABULARY, k=1_350_000)
# Every fiftieth word replaced, so about a tenth of the runs of five words differ; and every fifth, so most do.
NEAR = [w if i % 50 else "other" for i, w in enumerate(WORDS)]
FAR = [w if i % 5 else "other" for i, w in enumerate(WORDS)]
BIG = "\n".join(" ".join(WORDS[i:i + 12]) for i in range(0, len(WORDS), 12))
ONE_WORD = "".join(DRAW.choices("abcdefgh", k=1_000_000))
ROWS = [
    (1, BIG + " " + " ".join(ITEM)), (2, " ".join(NEAR)), (3, " ".join(FAR)), (4, ONE_WORD), (5, ONE_WORD + " "),
    (6, "a short text"), (7, "x" * 1_000_000 + " " + " ".join(ITEM[:9] + ["changed"] + ITEM[10:])),
]


def test_the_texts_are_long():
    assert all(len(text) > 8 << 20 for _, text in ROWS[:3])


def test_decontamination(spark):
    benchmark = spark.createDataFrame([(1, " ".join(ITEM)), (2, " ".join(f"absent{i}" for i in range(20)))], "item_id long, text string")
    found = decontamination.find_items(fx.cases(spark, ROWS), benchmark).collect()
    assert sorted(tuple(r) for r in found) == [(1, 1, 0), (7, 1, 1)]


def test_near_dedup(spark):
    bags = {i: fx.bag(text) for i, text in ROWS[:3]}
    assert fx.jaccard(bags[1], bags[2]) >= 0.8 > max(fx.jaccard(bags[1], bags[3]), fx.jaccard(bags[2], bags[3]))
    found = {r["doc_id"]: r["class_id"] for r in near_dedup.classes(fx.cases(spark, ROWS)).collect()}
    assert found == {1: 1, 2: 1, 3: 3, 4: 4, 5: 4, 6: 6, 7: 7}


def test_lm_scoring(spark):
    expected = fx.base_scores(ROWS)
    found = lm.score_documents(fx.cases(spark, ROWS)).collect()
    assert len(found) == len(ROWS)
    for r in found:
        n_tokens, n_known, n, base = expected[r["doc_id"] - 1]
        assert (r["n_tokens"], r["n_known"], r["train_tokens"]) == (n_tokens, n_known, n)
        assert r["base_score"] == pytest.approx(base, rel=1e-9) and r["score"] < 0


def test_toxicity(spark):
    labels = spark.createDataFrame([(i, i % 2) for i in range(1, 8)], "doc_id long, toxic int")
    found = toxicity.score_texts(fx.cases(spark, ROWS), labels).collect()
    assert sorted(r["doc_id"] for r in found) == [i for i, _ in ROWS] and all(0 <= r["score"] <= 1 for r in found)


def test_token_counts(spark):
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    found = {r["doc_id"]: r["n_tokens"] for r in token_counts.count_tokens(fx.cases(spark, ROWS)).collect()}
    assert found == {i: len(model.encode(text, num_threads=1)) for i, text in ROWS}


def test_byte_bpe(spark):
    plain, expected = plain_encoding(), {}
    for i, text in ROWS:
        ids = plain.encode_ordinary(text)
        expected[i] = (len(ids), hashlib.sha256(struct.pack(f"<{len(ids)}I", *ids)).hexdigest(), hashlib.sha256(text.encode()).hexdigest())
    found = bpe.round_trip_digests(fx.cases(spark, ROWS)).collect()
    assert {r["doc_id"]: (r["n_tokens"], r["ids_sha256"], r["decoded_sha256"]) for r in found} == expected


def test_line_dedup(spark):
    line = "a line that three documents hold"
    rows = [(1, BIG + "\n" + line), (2, line + "\n" + ONE_WORD), (3, line), (4, ONE_WORD), (5, ONE_WORD)]
    found = {r["doc_id"]: r["text"] for r in line_dedup.drop_repeated_lines(fx.cases(spark, rows)).collect()}
    assert found == {1: BIG, 2: "", 3: line, 4: "", 5: ONE_WORD}
