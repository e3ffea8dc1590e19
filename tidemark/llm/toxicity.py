"""Toxicity: gradient-boosted trees over dense features, with isotonic calibration.

Features of a text: densities of lexicon words (a fixed list, and stems learned from labelled
rows), how often a second-person word stands near them, capitals, punctuation, and how often
words are disguised by digits or signs. All are counted over the whole text.

Learning uses a bounded sample of labelled rows outside the held-out fold, chosen by hash. It is
cut by the rest of crc32(id) / 5: rests 1 and 2 teach the learned stems, rest 3 the trees, rest 4
the calibration, so the trees see how far stems can be trusted on other rows. Near copies teach once: of
sampled texts that share a min-hash of their three-word runs (three tries), the one with the least id.

Defined cases: NULL and empty texts get the features of a text without words and a score like
any other; rows without a label are scored only; labels without a document teach nothing; a label
repeated for an id counts as toxic if one of its rows does; if the sample holds one class only the
score is that class's share; repeated rows are scored each; extra columns are ignored; an empty
table gives an empty result.
"""

from __future__ import annotations

import math
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.regression import IsotonicRegression
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import (
    LETTERS_ASCII, Words, buffer_of, by_place, chunks, crc_of_id, materialize, mix, only, prepare, shingles, table_of,
)

FOLDS = 5
SAMPLE_ROWS = 12_000
STEM_LENGTHS = (4, 5, 6)
MAX_STEMS = 2_000
# A stem is learned if it is this often in toxic rows, this much likelier there, and this unlikely by chance.
MIN_ROWS, MIN_RATIO, MIN_EVIDENCE = 4, 6.0, 25.0
NEAR = 5
TREES, DEPTH, STEP = 15, 3, 0.3

# Common insults, and second-person words, in the languages at hand.
INSULTS = frozenset(
    "idiot idiots moron morons stupid dumb scum trash garbage loser losers pathetic worthless disgusting clown clowns fool "
    "fools imbecile jerk creep pig pigs scumbag dumbass bastard bitch asshole shit fuck fucking filth filthy ugly vermin "
    "idiota imbécil estúpido estúpida basura asqueroso payaso idiote imbécile débile ordure connard salaud crétin "
    "dummkopf trottel abschaum arschloch widerlich wertlos blöd".split())
SECOND_PERSON = frozenset(
    "you your yours yourself u ur du dich dir dein deine deinen ihr euch euer tu te toi ton ta tes vous votre vos "
    "tú ti tus usted ustedes vosotros vuestro".split())
DISGUISE = str.maketrans("013457@$!", "oieastasi")

FEATURES = ("insults", "insult_share", "stems", "stem_share", "stem_weight", "stem_top", "addressed", "addressed_share",
            "second_person", "capitals", "shouted", "exclaimed", "punctuated", "disguised", "unmasked", "length")
EDGE = "".join(chr(c) for c in range(33, 127) if not chr(c).isalnum())


def plain_word(word: str) -> str:
    return word.strip(EDGE).lower()


def stems_of(word: str) -> list[str]:
    return [word, *[word[:n] + "-" for n in STEM_LENGTHS if len(word) > n]]


def word_figures(raw: bytes, stems: dict[str, float]) -> tuple:
    """insult, weight of the best stem, second person, all capitals, disguised, insult only behind a disguise."""
    text = raw.decode("utf-8", "replace")
    word = plain_word(text)
    clear = word.translate(DISGUISE) if not word.isalpha() else word
    masked = clear != word and any(c.isalpha() for c in word)
    insult = word in INSULTS or masked and clear in INSULTS
    weight = 0.0
    if stems:
        weight = max([stems.get(s, 0.0) for s in stems_of(clear if masked else word)])
    return (insult, weight, word in SECOND_PERSON, len(word) > 1 and text.isupper(), masked,
            masked and (clear in INSULTS or weight > 0))


def features(column: pa.Array, stems: dict[str, float]) -> np.ndarray:
    """One row of FEATURES for each text."""
    data, offsets = buffer_of(column)
    words, n = Words(data, offsets), len(offsets) - 1
    out = np.zeros((n, len(FEATURES)))
    count = words.counts.astype(float)
    per_word, owner = 100 / np.maximum(count, 1), words.text_of()

    def total(x):
        return np.bincount(owner, weights=x, minlength=n)

    def of_bytes(members):
        sums = np.zeros(len(data) + 1)
        np.cumsum(members[data], out=sums[1:])
        return np.diff(sums[offsets])

    if len(owner):
        _, one, inverse = np.unique(words.hashes(), return_index=True, return_inverse=True)
        insult, weight, second, shouted, masked, unmasked = np.array(
            [word_figures(w, stems) for w in words.strings(one)], float)[inverse].T
        hit = (insult > 0) | (weight > 0)
        upto = np.concatenate([[0], np.cumsum(second)])
        at = np.flatnonzero(hit)
        low = np.maximum(at - NEAR, words.first[owner[at]])
        high = np.minimum(at + NEAR + 1, words.first[owner[at] + 1])
        addressed = np.bincount(owner[at], weights=(upto[high] - upto[low] > 0).astype(float), minlength=n)
        top = np.zeros(n)
        np.maximum.at(top, owner, weight)
        out[:, 0], out[:, 1] = np.log1p(total(insult)), total(insult) * per_word
        out[:, 2], out[:, 3] = np.log1p(total(weight > 0)), total(weight > 0) * per_word
        out[:, 4], out[:, 5] = np.log1p(total(weight)), top
        out[:, 6], out[:, 7], out[:, 8] = np.log1p(addressed), addressed * per_word, total(second) * per_word
        out[:, 10], out[:, 13], out[:, 14] = total(shouted) * per_word, total(masked) * per_word, np.log1p(total(unmasked))
    letters = np.maximum(of_bytes(table_of(LETTERS_ASCII)), 1)
    size = np.maximum(np.diff(offsets), 1)
    out[:, 9] = of_bytes(table_of(bytes(range(65, 91)))) / letters
    out[:, 11] = of_bytes(table_of(b"!?")) / size
    out[:, 12] = of_bytes(table_of(EDGE.encode())) / size
    out[:, 15] = np.log1p(count)
    return np.nan_to_num(out)


def feature_rows(texts: DataFrame, stems: dict[str, float], column: str = "text", keep: bool = False) -> DataFrame:
    """The columns of ``texts`` without its text ``column`` unless ``keep``, and ``features`` as an array."""
    rest = [c for c in texts.columns if keep or c != column]
    shared = texts.sparkSession.sparkContext.broadcast(stems)
    schema = texts.select(*rest).withColumn("features", F.lit(None).cast("array<double>")).schema

    def run(batches):
        for batch in batches:
            for part in chunks(batch, column):
                x = features(part.column(column), shared.value)
                yield pa.record_batch([*[part.column(c) for c in rest],
                                       pa.array(list(x), pa.list_(pa.float64()))], names=schema.names)

    return texts.mapInArrow(run, schema)


def unlike(rows: DataFrame, tries: int = 3) -> DataFrame:
    """``rows`` (``doc_id, text``, ...) without near copies of each other."""
    keys = [f"_key{i}" for i in range(tries)]
    schema = rows.select("*", *[F.lit(0).cast("long").alias(k) for k in keys]).schema

    def keyed(batches):
        for batch in batches:
            for part in chunks(batch):
                words = Words(*buffer_of(part.column("text")))
                found, owner = shingles(words.hashes(), words.first, 3)
                start = np.flatnonzero(np.concatenate([[True], owner[1:] != owner[:-1]])) if len(owner) else []
                columns = []
                for i in range(tries):
                    least = np.arange(part.num_rows)  # texts without words share nothing
                    if len(owner):
                        least[owner[start]] = np.minimum.reduceat(mix(found + np.uint64(i)), start).view(np.int64)
                    columns.append(pa.array(least))
                yield pa.record_batch([*part.columns, *columns], names=schema.names)

    left = rows.mapInArrow(keyed, schema)
    for key in keys:
        row = F.struct("doc_id", *[c for c in left.columns if c != "doc_id"])
        left = left.groupBy(key).agg(F.min(row).alias("_row")).select("_row.*")
    return left.select(*rows.columns)


def learn_stems(rows: DataFrame) -> dict[str, float]:
    """Words and stems with the log of how much likelier they are in toxic rows (``text, label``)."""
    def tally(batches):
        for batch in batches:
            for part in chunks(batch):
                found = {0: Counter(), 1: Counter()}
                for text, label in zip(part.column("text").to_pylist(), part.column("label").to_pylist()):
                    found[label].update({s for w in {plain_word(w) for w in (text or "").split()} if len(w) > 2
                                         for s in stems_of(w)})
                terms = [*found[0], *(t for t in found[1] if t not in found[0])]
                yield pa.record_batch({"term": pa.array(terms, pa.string()),
                                       "clean": pa.array([found[0][t] for t in terms], pa.int64()),
                                       "toxic": pa.array([found[1][t] for t in terms], pa.int64())})

    n = {r["label"]: r["count"] for r in rows.groupBy("label").count().collect()}
    clean, toxic = n.get(0, 0), n.get(1, 0)
    if not clean or not toxic:
        return {}
    terms = (rows.mapInArrow(tally, "term string, clean long, toxic long")
             .groupBy("term").agg(F.sum("clean").alias("clean"), F.sum("toxic").alias("toxic"))
             .filter((F.col("toxic") >= MIN_ROWS) & (F.col("toxic") * clean >= MIN_RATIO * toxic * F.col("clean")))
             .orderBy(F.desc(F.col("toxic") - F.col("clean") * toxic / clean), "term").limit(10 * MAX_STEMS).collect())
    base, best = toxic / (toxic + clean), []
    for r in terms:
        share = r["toxic"] / (r["toxic"] + r["clean"])
        evidence = 2 * (r["toxic"] * math.log(share / base) + (r["clean"] * math.log((1 - share) / (1 - base)) if r["clean"] else 0))
        if evidence >= MIN_EVIDENCE:
            best.append((evidence, r["term"], math.log((r["toxic"] / toxic) / ((r["clean"] + 0.5) / clean))))
    return {term: weight for _, term, weight in sorted(best, reverse=True)[:MAX_STEMS]}


class Model:
    """Learned stems, trees and calibration; or, without two classes to learn from, a constant."""

    def __init__(self, stems, trees=None, calibration=None, constant=0.0):
        self.stems, self.trees, self.calibration, self.constant = stems, trees, calibration, constant

    def score(self, texts: DataFrame, column: str = "text", keep: bool = False) -> DataFrame:
        """``texts`` without its text ``column`` unless ``keep``, with ``score``."""
        rest = [c for c in texts.columns if keep or c != column]
        if self.trees is None:
            return texts.select(*rest, F.lit(float(self.constant)).alias("score"))
        rows = feature_rows(texts, self.stems, column, keep).withColumn("features", array_to_vector("features"))
        raw = self.trees.transform(rows).withColumn("raw", vector_to_array("probability")[1])
        if self.calibration is None:
            return raw.select(*rest, F.col("raw").alias("score"))
        return self.calibration.transform(raw).select(
            *rest, F.least(F.lit(1.0), F.greatest(F.lit(0.0), F.col("calibrated"))).alias("score"))


def train(docs: DataFrame, labels: DataFrame, sample_rows: int = SAMPLE_ROWS) -> Model:
    """Learn from at most ``sample_rows`` labelled rows of ``docs`` outside the held-out fold."""
    prepare(docs.sparkSession)
    marked = only(labels, "doc_id", "toxic").filter(
        F.col("doc_id").isNotNull() & F.col("toxic").isin(0, 1) & (crc_of_id() % FOLDS != 0))
    ids = (marked.groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(F.max("toxic").cast("int").alias("label"))
           .orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample_rows))
    texts = only(docs, "doc_id", "text").withColumn("doc_id", F.col("doc_id").cast("long"))
    rows = materialize(unlike(texts.join(F.broadcast(ids), "doc_id").select(
        "doc_id", F.coalesce("text", F.lit("")).alias("text"), "label", (crc_of_id() % FOLDS).cast("int").alias("rest"))),
        "toxicity-sample")
    stems = learn_stems(rows.filter("rest in (1, 2)").select("text", "label"))
    vectors = materialize(feature_rows(rows.select("text", "label", "rest"), stems), "toxicity-features")
    counts = {(r["label"], r["rest"]): r["count"] for r in vectors.groupBy("label", "rest").count().collect()}

    def number(label, *rests):
        return sum(counts.get((label, r), 0) for r in rests)

    toxic, clean = number(1, 1, 2, 3, 4), number(0, 1, 2, 3, 4)
    if not toxic or not clean:
        return Model(stems, constant=toxic / max(1, toxic + clean))
    # With few toxic rows the folds of the trees or of the calibration can lack a class; then they use all rests.
    enough = min(number(1, 3), number(0, 3), number(1, 4), number(0, 4)) >= 5
    points = vectors.withColumn("features", array_to_vector("features")).cache()
    trees = GBTClassifier(featuresCol="features", labelCol="label", maxIter=TREES, maxDepth=DEPTH, stepSize=STEP,
                          minInstancesPerNode=3, seed=7).fit(points.filter("rest = 3") if enough else points)
    raw = trees.transform(points.filter("rest = 4") if enough else points).select(
        F.col("label").cast("double").alias("label"), vector_to_array("probability")[1].alias("raw"))
    calibration = IsotonicRegression(featuresCol="raw", labelCol="label", predictionCol="calibrated").fit(raw)
    points.unpersist()
    return Model(stems, trees, calibration)


def score_texts(docs: DataFrame, labels: DataFrame, sample_rows: int = SAMPLE_ROWS, model: Model | None = None) -> DataFrame:
    """``doc_id, held_out, score, predicted`` for every row of ``docs``."""
    model = model or train(docs, labels, sample_rows)
    texts = only(docs, "doc_id", "text").select(
        F.col("doc_id").cast("long"), "text", (crc_of_id() % FOLDS == 0).alias("held_out"))
    return model.score(texts).withColumn("predicted", (F.col("score") >= 0.5).cast("int"))


def keep_clean(docs: DataFrame, labels: DataFrame, sample_rows: int = SAMPLE_ROWS) -> DataFrame:
    """``docs`` (with all columns) without the texts scored 0.5 or more."""
    model = train(docs, labels, sample_rows)
    rows, text = by_place(docs, "text")
    # The text goes to Python and back once, as a column among the others.
    scored = model.score(rows, text, keep=True)
    return scored.filter(F.col("score") < 0.5).select(*rows.columns).toDF(*docs.columns)
