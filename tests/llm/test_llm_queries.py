"""Every text query over the whole sf0.01 tables and over hard cases, against brute force or another library."""

import base64
import hashlib
import struct
import zlib

import duckdb
import fixtures_llm as fx
import pytest
import public_tokenizers
from pyspark.sql import functions as F

from tidemark.llm import (
    bpe, decontamination, language, line_dedup, lm, near_dedup, quality, token_counts, token_files, toxicity,
)
from tidemark.llm.queries import ORACLES, QUERIES


@pytest.fixture(scope="module")
def documents():
    return duckdb.sql(f"SELECT doc_id, text, lang FROM '{fx.SF_DIR}/documents.parquet' ORDER BY doc_id").fetchall()


@pytest.fixture(scope="module")
def toxic_labels(spark):
    return spark.createDataFrame([(4, 1), (5, 0), (None, 1), (99, 1), (6, None)], "doc_id long, toxic int")


def by_id(df) -> dict:
    return {r["doc_id"]: r for r in df.collect()}


def rows_of(df, *names):
    """Rows as sorted tuples, for tables whose ids repeat."""
    return sorted((tuple(r[n] for n in names) for r in df.collect()), key=repr)


def test_all_run_on_an_empty_table(spark, toxic_labels):
    none = fx.empty(spark)
    benchmark = spark.createDataFrame([], "item_id long, text string")
    for df in (decontamination.find_items(none, benchmark), quality.judge(none), token_counts.count_tokens(none),
               near_dedup.classes(none), bpe.round_trip_digests(none), lm.score_documents(none, filter_bits=1 << 16),
               toxicity.score_texts(none, toxic_labels), language.identify(none), token_files.token_file_digests(none),
               line_dedup.line_digests(none)):
        assert df.count() == 0


def test_columns_that_clash_in_case_or_name(spark):
    docs = spark.createDataFrame([(1, "Same words", "other", 5)], "doc_id long, text string, TEXT string, text_hash int")
    twice = docs.join(docs.select("doc_id").withColumnRenamed("doc_id", "n"), docs["doc_id"] == F.col("n")).toDF(
        "doc_id", "text", "TEXT", "doc_id", "text")
    for rows in (docs, twice):
        assert [tuple(r) for r in token_counts.count_tokens(rows).select("doc_id", "n_bytes").collect()] == [(1, 10)]
        assert line_dedup.line_digests(rows).first()["n_lines"] == 1


# 1

def test_decontamination_finds_whole_items(spark, documents):
    items = duckdb.sql(f"SELECT item_id, text FROM '{fx.SF_DIR}/benchmark.parquet'").fetchall()

    def words(text):
        return "".join(c if c.isalnum() else " " for c in text.lower()).split()

    found = {(r["doc_id"], r["item_id"]): r["distance"] for r in QUERIES["op1_decontamination"](spark, fx.SF_DIR).collect()}
    for doc_id, text, _ in documents:
        body = f" {' '.join(words(text))} "
        for item_id, item in items:
            if f" {' '.join(words(item))} " in body:
                assert found.pop((doc_id, item_id)) == 0
    texts, items = {d: t for d, t, _ in documents}, dict(items)
    for (doc_id, item_id), distance in found.items():
        item = words(items[item_id])
        assert fx.edit_distance_within(item, words(texts[doc_id])) == distance <= len(item) * 0.2


@pytest.mark.parametrize("share", [0.0, 0.1, 0.2])
def test_decontamination_recall_with_edits(spark, share):
    import random

    draw = random.Random(5)
    items = [(i, " ".join(f"w{draw.randrange(3000)}" for _ in range(n))) for i, n in enumerate([8, 12, 17, 25, 40, 60] * 10)]
    docs = []
    for i, text in items:
        words = text.split()
        for _ in range(int(len(words) * share + 1e-9)):
            at = draw.randrange(len(words))
            how = draw.choice("sid")
            words[at:at + (how != "i")] = [] if how == "d" else [f"new{draw.randrange(9999)}"]
        before, after = ([f"o{draw.randrange(3000)}" for _ in range(50)] for _ in range(2))
        docs.append((i, " ".join(before + words + after)))
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    for block_bytes in (decontamination.BLOCK_BYTES, 2000):
        found = {tuple(r)[:2] for r in decontamination.find_items(fx.cases(spark, docs), benchmark, block_bytes=block_bytes).collect()}
        assert found <= {(i, i) for i, _ in items}
        assert len(found) >= 0.95 * len(items)


@pytest.mark.parametrize("size", [5, 6, 7, 8, 9])
def test_decontamination_of_short_items_with_any_edit(spark, size):
    words = [[f"w{i}x{k}" for k in range(size)] for i in range(3 * size + 1)]
    # Items of 6 words make the class one that begins with 6.
    items = [(i, " ".join(w)) for i, w in enumerate(words)] + [(999, " ".join(f"v{k}" for k in range(6)))]
    docs = []
    for i, w in enumerate(words):
        at = i // 3
        edited = w[:at] + [[], ["new"], ["new", *w[at:at + 1]]][i % 3] + w[at + 1:]
        docs.append((i, " ".join([*(f"o{i}y{k}" for k in range(20)), *edited, "behind", "it"])))
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    found = {(r["doc_id"], r["item_id"]) for r in decontamination.find_items(fx.cases(spark, docs), benchmark).collect()}
    assert found == {(i, i) for i in range(len(words))}


def test_decontamination_cases(spark):
    benchmark = spark.createDataFrame(
        [(1, "a b c d"), (2, None), (3, ""), (4, "one two three"), (None, "a row without an id"), (6, "A, b; C d!")],
        "item_id long, text string")
    found = decontamination.find_items(fx.cases(spark), benchmark)
    assert rows_of(found, "doc_id", "item_id", "distance") == sorted([(5, 1, 0), (5, 6, 0), (None, None, 0)], key=repr)
    kept = decontamination.drop_contaminated(fx.cases(spark), benchmark)
    assert kept.count() == len(fx.CASES) - 3 and kept.columns == fx.cases(spark).columns


def test_decontamination_of_few_words_and_scripts_without_spaces(spark):
    han = "床前明月光疑是地上霜举头望明月"
    docs = [(1, "before, Rare-Name behind"), (2, "rare names"), (3, f"昨天{han}今天"), (4, f"昨天{han.replace('明月光', '明日光')}今天"),
            (5, "昨天今天"), (6, "x 東京都 y"), (7, "one, Two; three"), (8, "unique"), (9, "unique unique"), (10, "ฉันรักภาษาไทย")]
    items = [(1, "rare name"), (2, han), (3, "東京都"), (4, "one two three"), (5, "UNIQUE"), (6, "รักภาษา"), (7, "?!"), (8, "unique")]
    found = decontamination.find_items(fx.cases(spark, docs), spark.createDataFrame(items, "item_id long, text string"))
    assert rows_of(found, "doc_id", "item_id", "distance") == sorted(
        [(1, 1, 0), (3, 2, 0), (4, 2, 1), (6, 3, 0), (7, 4, 0), (8, 5, 0), (9, 5, 0), (8, 8, 0), (9, 8, 0), (10, 6, 0)], key=repr)


def test_nearest_is_the_edit_distance():
    import random

    draw = random.Random(1)
    for _ in range(200):
        item, text = ([draw.randrange(4) for _ in range(draw.randrange(1, n))] for n in (12, 30))
        assert decontamination.nearest(item, text, 99) == fx.edit_distance_within(item, text)


# 2

def test_quality(spark, documents):
    for rows, df in (([(d, t) for d, t, _ in documents], QUERIES["op2_quality_rules"](spark, fx.SF_DIR)),
                     (fx.CASES, quality.judge(fx.cases(spark)))):
        names = ("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed")
        expected = []
        for doc_id, text in rows:
            f = fx.base_figures(text)
            expected.append((doc_id, *f, f[0] < 50 or 100 * f[4] > 50 * f[0]))
        assert rows_of(df, *names) == sorted(expected, key=repr)
        assert not df.filter("base_failed AND kept").count()
        assert df.filter("kept = (rejected_by IS NULL)").count() == len(rows)


def test_quality_order_changes_no_verdict(spark):
    docs = spark.read.parquet(f"{fx.SF_DIR}/documents.parquet")
    there, back = (rows_of(quality.judge(docs, rules), "doc_id", "kept") for rules in (quality.RULES, quality.RULES[::-1]))
    assert there == back


# 3, 5, 9

def test_token_counts(spark, documents):
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    for rows, df in (([(d, t) for d, t, _ in documents], QUERIES["op3_token_counts"](spark, fx.SF_DIR)),
                     (fx.CASES, token_counts.count_tokens(fx.cases(spark)))):
        expected = []
        for doc_id, text in rows:
            n = len(model.encode(text or "", num_threads=1))
            expected.append((doc_id, len((text or "").encode()), n, n > 4096))
        assert rows_of(df, "doc_id", "n_bytes", "n_tokens", "over_limit") == sorted(expected, key=repr)


def plain_encoding():
    import tiktoken

    with open(public_tokenizers.path("byte_bpe_50k.tiktoken"), "rb") as file:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, file)}
    return tiktoken.Encoding("plain", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


@pytest.mark.parametrize("leaf", [1, 3, 50, bpe.LEAF_CHARS])
def test_byte_bpe(spark, documents, leaf):
    plain = plain_encoding()
    rows = [(d, t) for d, t, _ in documents][:300 if leaf < 100 else None]
    if leaf < 100:
        rows += [(i, t) for i, t in fx.CASES if len(t or "") < 1000]
        df = bpe.round_trip_digests(fx.cases(spark, rows), leaf_chars=leaf)
    else:
        rows += fx.CASES
        df = QUERIES["op5_byte_bpe"](spark, fx.SF_DIR).union(bpe.round_trip_digests(fx.cases(spark)))
    expected = []
    for doc_id, text in rows:
        ids = plain.encode_ordinary(text or "")
        expected.append((doc_id, len(ids), hashlib.sha256(struct.pack(f"<{len(ids)}I", *ids)).hexdigest(),
                         hashlib.sha256((text or "").encode()).hexdigest()))
    assert rows_of(df, "doc_id", "n_tokens", "ids_sha256", "decoded_sha256") == sorted(expected, key=repr)


def test_byte_bpe_columns(spark):
    docs = fx.cases(spark)
    coded = bpe.decode_ids(bpe.encode_texts(docs))
    assert coded.columns == [*docs.columns, "ids", "decoded"]
    assert all(bytes(r["decoded"]) == (r["text"] or "").encode() for r in coded.collect())


@pytest.mark.parametrize("shard", [500, token_files.SHARD_TOKENS])
def test_token_files(spark, documents, shard):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    for rows, df in (([(d, t) for d, t, _ in documents], QUERIES["op9_token_files"](spark, fx.SF_DIR)),
                     (fx.CASES, token_files.token_file_digests(fx.cases(spark), shard_tokens=shard))):
        start, expected = 0, []
        for doc_id, text in sorted(rows, key=lambda r: (r[0] is not None, r[0], r[1] is not None, (r[1] or "").encode())):
            ids = [*tokenizer.encode(text or "", add_special_tokens=False).ids, 0]
            expected.append((doc_id, start, len(ids), zlib.crc32(struct.pack(f"<{len(ids)}I", *ids))))
            start += len(ids)
        assert rows_of(df, "doc_id", "start", "n_tokens", "ids_crc32") == sorted(expected, key=repr)


def test_token_file_format():
    import numpy as np

    ids = np.concatenate([np.full(9, 70000), np.arange(300), np.arange(70000, 70600), [2 ** 32 - 1]]).astype(np.uint32)
    raw = token_files.pack([None, 5, -7], np.array([9, 0, len(ids) - 9], np.uint32), ids)
    doc_ids, counts, back = token_files.unpack(raw)
    assert doc_ids == [None, 5, -7] and counts.tolist() == [9, 0, len(ids) - 9] and (back == ids).all()
    with pytest.raises(ValueError):
        token_files.unpack(b"x" * 40)


# 4

def test_near_dedup(spark, documents):
    for rows, df in (([(d, t) for d, t, _ in documents], QUERIES["op4_near_dedup"](spark, fx.SF_DIR)),
                     (fx.CASES, near_dedup.classes(fx.cases(spark)))):
        expected = fx.near_classes(rows)
        assert rows_of(df, "doc_id", "class_id") == sorted(((i, expected.get(i)) for i, _ in rows), key=repr)


@pytest.mark.parametrize("rows_at_once, block", [(near_dedup.BROADCAST_ROWS, near_dedup.BLOCK), (0, 3)])
def test_near_dedup_joins_through_members_that_are_no_pivot(spark, monkeypatch, rows_at_once, block):
    """A chain of texts, each like the next only, and a large group around one text."""
    monkeypatch.setattr(near_dedup, "BROADCAST_ROWS", rows_at_once)
    monkeypatch.setattr(near_dedup.links, "__defaults__", (block,))
    words = [f"w{i}" for i in range(160)]
    chain = [(i, " ".join(words[6 * i:6 * i + 100])) for i in range(9)]
    group = [(100 + i, " ".join([*words[:50], f"own{i}", *words[60:150]])) for i in range(40)]
    expected = fx.near_classes(chain + group)
    found = near_dedup.classes(fx.cases(spark, chain + group))
    assert {r["doc_id"]: r["class_id"] for r in found.collect()} == expected
    kept = near_dedup.keep_one(fx.cases(spark, chain + group))
    assert {r["doc_id"] for r in kept.collect()} == set(expected.values())


def near_copy(words, at):
    return " ".join([*words[:at], "other", *words[at + 1:]])


@pytest.mark.parametrize("block", [near_dedup.BLOCK, 4])
def test_near_dedup_where_ids_repeat_with_different_texts(spark, monkeypatch, block):
    """Each text of a repeated id is compared, and the id joins the classes of its texts."""
    monkeypatch.setattr(near_dedup.links, "__defaults__", (block,))
    one, two, three, four = ([f"{c}{i}" for i in range(80)] for c in "pqrs")
    rows = [(1, " ".join(one)), (1, " ".join(two)), (2, near_copy(one, 3)), (3, near_copy(two, 70)), (3, None),
            (9, " ".join(three)), (9, " ".join(four)), (9, " ".join(four)), (8, near_copy(four, 5)), (7, near_copy(three, 70)), (6, " ".join(three)),
            *[(20 + i, " ".join(one)) for i in range(30)], (None, " ".join(two)), (50, None), (51, "alone")]
    expected = fx.near_classes(rows)
    assert expected[3] == 1 and expected[8] == 6
    assert rows_of(near_dedup.classes(fx.cases(spark, rows)), "doc_id", "class_id") == sorted(
        ((i, expected.get(i)) for i, _ in rows), key=repr)


def test_hot_keys_are_joined_like_others(spark):
    rows = spark.createDataFrame([(i, "hot" if i % 3 else f"k{i}") for i in range(3000)], "doc_id long, same string")
    side = rows.groupBy("same").agg(F.count(F.lit(1)).alias("n")).withColumn("class", F.length("same"))
    got = near_dedup.with_value(rows, side, "same", 3000).collect()
    assert sorted(r["doc_id"] for r in got) == list(range(3000)) and all(r["class"] == len(r["same"]) for r in got)


def test_bag_signatures_estimate_the_weighted_similarity():
    import numpy as np

    draw = np.random.default_rng(3)
    names = draw.integers(1, 1 << 62, 300).astype(np.uint64)
    x, y = draw.integers(0, 9, 300), draw.integers(0, 9, 300)
    signatures = [near_dedup.bag_signatures(names[w > 0], w[w > 0], np.zeros((w > 0).sum(), int), 1, 4000)[0] for w in (x, y)]
    true = np.minimum(x, y).sum() / np.maximum(x, y).sum()
    assert abs((signatures[0] == signatures[1]).mean() - true) < 0.03


# 6

def test_lm_scoring(spark, documents):
    for rows, df in (([(d, t) for d, t, _ in documents], QUERIES["op6_lm_scoring"](spark, fx.SF_DIR)),
                     (fx.CASES, lm.score_documents(fx.cases(spark), head=5, filter_bits=1 << 18))):
        expected = fx.base_scores(rows)
        found = sorted(df.collect(), key=lambda r: repr((r["doc_id"], r["n_tokens"], r["base_score"])))
        wanted = sorted(((i, fx.fold(i, 7) == 2, *expected[p]) for p, (i, _) in enumerate(rows)), key=lambda e: repr((e[0], e[2], e[5])))
        assert len(found) == len(wanted)
        found = sorted(found, key=lambda r: repr((r["doc_id"], r["n_tokens"])))
        wanted = sorted(wanted, key=lambda e: repr((e[0], e[2])))
        for r, (doc_id, held_out, n_tokens, n_known, n, base) in zip(found, wanted):
            assert (r["doc_id"], r["held_out"], r["n_tokens"], r["n_known"], r["train_tokens"]) == (doc_id, held_out, n_tokens, n_known, n)
            assert r["base_score"] == pytest.approx(base, rel=1e-9) and r["score"] < 0


def test_lm_beats_the_base_on_held_out_texts(spark):
    rows = QUERIES["op6_lm_scoring"](spark, fx.SF_DIR).filter("held_out").collect()
    assert sum(r["score"] for r in rows) > sum(r["base_score"] for r in rows)


def test_filter_reads_back_levels():
    import numpy as np

    keys = np.sort(lm.mix(np.arange(1, 2001, dtype=np.uint64)))
    counts = np.random.default_rng(0).integers(1, 5000, 2000)
    edge = lm.split_ranges(keys, 4)
    stretches = [lm.Filter.stretch(1 << 14, [(lm.top48(keys[a:b]), counts[a:b], 1)]) for a, b in zip(edge, edge[1:])]
    bloom = lm.Filter(np.stack([np.frombuffer(s, np.uint8) for s in stretches]), 4)
    levels = bloom.levels(lm.top48(keys), 1)
    assert (levels >= lm.quantise(counts)).all() and (levels == lm.quantise(counts)).mean() > 0.8


def stored_documents(spark):
    return spark.read.parquet(f"{fx.SF_DIR}/documents.parquet")


@pytest.mark.parametrize("head", [50, lm.HEAD])
def test_lm_filter_past_the_broadcast_size(spark, documents, head):
    """The filter grows with its entries; one too large to be broadcast is read in place, with the same levels."""
    def scores(**given):
        rows = lm.score_documents(stored_documents(spark), head=head, **given).collect()
        return sorted((r["doc_id"], r["n_tokens"], r["n_known"], round(r["base_score"], 6), round(r["score"], 6)) for r in rows)

    small = scores(filter_bits=1 << 12)
    assert small == scores() and all(s < 0 for *_, s in small)


def test_lm_counts_bigrams_seen_once(spark):
    train, held_out = next(i for i in range(99) if fx.fold(i, 7) != 2), [i for i in range(99) if fx.fold(i, 7) == 2][:2]
    words = [f"w{i}" for i in range(30)]
    rows = [(train, " ".join(words)), (held_out[0], " ".join(words)), (held_out[1], " ".join(reversed(words)))]
    found = {r["doc_id"]: r["score"] for r in lm.score_documents(fx.cases(spark, rows), mu=1.0).collect()}
    assert found[held_out[0]] > found[held_out[1]] + 1


def test_filter_keeps_its_error_rate_at_every_size():
    import numpy as np

    for n in (10, 3_000, 100_000):
        keys, counts = lm.mix(np.arange(1, n + 1, dtype=np.uint64)), np.random.default_rng(0).integers(1, 50, n)
        size = lm.Filter.size_for([counts])
        bloom = lm.Filter([np.frombuffer(lm.Filter.stretch(size, [(lm.top48(keys), counts, 1)]), np.uint8)], 0)
        others = lm.mix(np.arange(10 ** 9, 10 ** 9 + 20_000, dtype=np.uint64))
        assert (bloom.levels(lm.top48(others), 1) > 0).mean() < 1.5 * lm.ERROR_RATE
        assert (bloom.levels(lm.top48(keys), 1) == lm.quantise(counts)).mean() > 0.9


# 7, 8

def test_toxicity_on_held_out_rows(spark):
    labels = dict(duckdb.sql(f"SELECT doc_id, toxic FROM '{fx.SF_DIR}/labels.parquet'").fetchall())
    rows = QUERIES["op7_toxicity"](spark, fx.SF_DIR).collect()
    assert len(rows) == 1000 and all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.5) for r in rows)
    assert all(r["held_out"] == (fx.fold(r["doc_id"], 5) == 0) for r in rows)
    judged = [(r["predicted"], labels[r["doc_id"]]) for r in rows if r["held_out"] and r["doc_id"] in labels]
    assert sum(p == y for p, y in judged) >= 0.9 * len(judged)


def test_toxicity_cases(spark, toxic_labels):
    found = toxicity.score_texts(fx.cases(spark), toxic_labels).collect()
    assert len(found) == len(fx.CASES) and all(0 <= r["score"] <= 1 for r in found)
    kept = toxicity.keep_clean(fx.cases(spark), toxic_labels.filter("toxic = 0"))
    assert kept.count() == len(fx.CASES) and kept.columns == fx.cases(spark).columns


def test_disguised_words_are_seen():
    import numpy as np
    import pyarrow as pa

    x = toxicity.features(pa.array(["you 1d10t!", "calm words here", None]), {"calm": 1.0})
    at = {n: i for i, n in enumerate(toxicity.FEATURES)}
    assert x[0, at["unmasked"]] > 0 and x[0, at["insults"]] > 0 and x[0, at["addressed"]] > 0
    assert x[1, at["stems"]] > 0 and x[1, at["addressed"]] == 0 and np.isfinite(x).all()


def test_language_on_held_out_rows(spark, documents):
    lang = {d: (t, known) for d, t, known in documents}
    rows = QUERIES["op8_language_id"](spark, fx.SF_DIR).collect()
    assert len(rows) == 1000 and all(0 <= r["score"] <= 1 for r in rows)
    judged = [r["lang_pred"] == lang[r["doc_id"]][1] for r in rows if r["held_out"] and lang[r["doc_id"]][1]]
    assert sum(judged) >= 0.95 * len(judged)


def test_language_cases(spark):
    assert {r["lang_pred"] for r in language.identify(fx.cases(spark)).collect()} == {"und"}
    taught = fx.cases(spark, [(i, "ein kurzer deutscher satz") for i in range(20, 40)] + fx.CASES).selectExpr(
        "doc_id", "text", "CASE WHEN doc_id >= 20 THEN 'de' END AS lang")
    found = language.identify(taught).collect()
    assert {r["lang_pred"] for r in found} == {"und", "de"}
    assert all(r["score"] == 0 for r in found if r["lang_pred"] == "und")


def test_every_language_is_learned(spark):
    ids = [i for i in range(500) if fx.fold(i, 5) != 0][:230]
    rows = [(i, f"text number {i * i} of its own", f"x{n:03}") for n, i in enumerate(ids)]
    found = language.train(spark.createDataFrame(rows, "doc_id long, text string, lang string"))
    assert sum(len(m) for m in found.members.values()) == len(ids)


def test_languages_within_a_family(spark):
    texts = {"de": "der hund läuft schnell über die straße", "en": "the dog runs quickly over the street",
             "es": "el perro corre rápido por la calle", "fr": "le chien court vite dans la rue"}
    rows = [(i, t + f" {i}", c) for i, (c, t) in enumerate(list(texts.items()) * 20)]
    found = language.identify(spark.createDataFrame(rows, "doc_id long, text string, lang string"))
    assert {r["doc_id"]: r["lang_pred"] for r in found.collect()} == {i: c for i, _, c in rows}


# 10

def test_line_dedup_equals_sql(spark):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{fx.SF_DIR}/documents.parquet'")
    expected = sorted(con.execute(ORACLES["op10_line_dedup"]).fetchall())
    found = QUERIES["op10_line_dedup"](spark, fx.SF_DIR)
    assert rows_of(found, "doc_id", "n_lines", "n_dropped", "kept_sha256") == sorted(expected, key=repr)


@pytest.mark.parametrize("shards", ["1", "3", "40"])
def test_line_dedup_over_many_tasks(spark, shards):
    """One line in every document, so its run of equal hashes crosses the edges of tasks."""
    hot, twice = "  This line is in EVERY document \t", "this line is in two documents only"
    rows = [(i, f"{hot}\nown line number {i} of the table\n{hot}\n{twice if i < 2 else ''}") for i in range(300)]
    old = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", shards)
    try:
        found = by_id(line_dedup.drop_repeated_lines(fx.cases(spark, rows)))
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)
    for i, text in rows:
        kept = text if i == 299 else "\n".join(line for line in text.split("\n") if line != hot)
        assert found[i]["text"] == kept


def test_line_dedup_cases(spark):
    found = rows_of(line_dedup.line_digests(fx.cases(spark)), "doc_id", "n_lines", "n_dropped")
    # 6 and both rows of 7 share a line: two documents only, so nothing goes.
    assert found == sorted(((i, (t or "").count("\n") + 1, 0) for i, t in fx.CASES), key=repr)
    three = fx.CASES + [(20, "Same text twice, same text twice, same text twice.")]
    found = line_dedup.drop_repeated_lines(fx.cases(spark, three))
    assert rows_of(found.filter("doc_id IN (6, 7, 20)"), "doc_id", "text") == sorted(
        [(6, ""), (7, ""), (7, ""), (20, three[-1][1])], key=repr)
    assert found.filter("text IS NULL").count() == 2
