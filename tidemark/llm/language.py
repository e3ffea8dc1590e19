"""Language identification in two steps: the family first, then the languages within it.

Texts become counts of hashed byte n-grams (1 to 3 bytes, lower case, digits and punctuation as
one separator), scaled to unit length after a square root. A linear support vector machine for
each family (against the rest) picks the family; within it, one-versus-one machines between each
two languages vote, and sums of their margins break ties. Machines minimise the squared hinge
loss with a quadratic penalty by gradient steps on a bounded sample of labelled rows.

Families are a fixed table of the usual genealogical groups; a language that is not in it is a
family of its own.

Defined cases: a NULL text or one without a letter is ``und`` with score 0; without any labelled
row everything is ``und``; with a single learned language that one is given; rows with a NULL
language teach nothing; repeated rows are predicted each; whole texts of any length are read;
extra columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import buffer_of, chunks, crc_of_id, materialize, mix, only, prepare, share, table_of

DIMENSIONS = 1 << 12
# Rows that teach: for each language, and in all. Every language is learned; with many, each has fewer rows, one at least.
ROWS_PER_LANGUAGE = 600
MAX_ROWS = 6_000
# With four times the rows wanted, a threshold on the hash keeps too few of them once in 10**300 tables.
MARGIN = 4
FOLDS = 5
UNDETERMINED = "und"

# ISO 639-1 codes by family.
FAMILIES = {
    "germanic": "en de nl sv da no nb nn is af fy lb yi",
    "romance": "fr es it pt ro ca gl oc la",
    "slavic": "ru uk be pl cs sk sl hr sr bs bg mk",
    "uralic": "fi et hu",
    "turkic": "tr az kk uz ky tk tt",
    "semitic": "ar he mt am",
    "indic": "hi ur bn pa gu mr ne si",
    "dravidian": "ta te kn ml",
    "sinitic": "zh",
    "malayic": "id ms jv tl",
}
FAMILY_OF = {code: family for family, codes in FAMILIES.items() for code in codes.split()}


def features(column: pa.Array) -> np.ndarray:
    """One unit vector for each text (zeros for a text without n-grams)."""
    data, offsets = buffer_of(pc.utf8_lower(pc.fill_null(column.cast(pa.large_string()), "")))
    n = len(offsets) - 1
    plain = data.copy()
    plain[table_of(bytes(b for b in range(128) if not chr(b).isalpha()))[data]] = 32
    out = np.zeros((n, DIMENSIONS), np.float32)
    grid = np.arange(1 << 16, dtype=np.uint64)
    # Slots of one and two bytes by table; of three bytes by multiplying.
    slot2 = (mix(grid + np.uint64(7)) % np.uint64(DIMENSIONS)).astype(np.int64)
    x = plain.astype(np.int64)
    for i, (a, b) in enumerate(zip(offsets[:-1].tolist(), offsets[1:].tolist())):
        t = x[a:b]
        if not len(t):
            continue
        counts = np.bincount(slot2[t], minlength=DIMENSIONS)
        if len(t) > 1:
            pair = t[:-1] << 8 | t[1:]
            counts += np.bincount(slot2[pair], minlength=DIMENSIONS)
        if len(t) > 2:
            counts += np.bincount((pair[:-1] << 8 | t[2:]) * 2654435761 >> 9 & DIMENSIONS - 1, minlength=DIMENSIONS)
        out[i] = np.sqrt(counts)
    norms = np.linalg.norm(out, axis=1, keepdims=True)
    return out / np.maximum(norms, 1e-9)


def train_machine(x: np.ndarray, y: np.ndarray, penalty: float = 1e-4, steps: int = 200) -> np.ndarray:
    """Weights (the last is the offset) of a linear machine for y in {-1, 1}; classes weigh the same."""
    x = np.hstack([x, np.ones((len(x), 1), np.float32)])
    y = y.astype(np.float32)
    weight = np.where(y > 0, 0.5 / max(1, (y > 0).sum()), 0.5 / max(1, (y < 0).sum())).astype(np.float32)
    w = np.zeros(x.shape[1], np.float32)
    ahead, momentum = w, 1.0
    rate = 1 / (2 * 2.0 + penalty)  # squared norm of a row is at most 2
    for _ in range(steps):
        slack = np.maximum(0, 1 - y * (x @ ahead))
        grad = np.float32(penalty) * ahead - np.float32(2) * ((weight * y * slack) @ x)
        new = ahead - np.float32(rate) * grad
        following = (1 + (1 + 4 * momentum ** 2) ** 0.5) / 2
        ahead, w, momentum = new + np.float32((momentum - 1) / following) * (new - w), new, following
    return w


class Hierarchy:
    """Family machines and, inside each family, a machine for each two languages."""

    def __init__(self, x: np.ndarray, langs: list[str]):
        family = np.array([FAMILY_OF.get(lang, f"only {lang}") for lang in langs], object)
        langs = np.array(langs, object)
        self.families = sorted(set(family.tolist()))
        self.members = {f: sorted(set(langs[family == f].tolist())) for f in self.families}
        self.by_family = None
        if len(self.families) > 1:
            self.by_family = np.stack([train_machine(x, np.where(family == f, 1, -1)) for f in self.families])
        self.pairs = {}
        for f, members in self.members.items():
            for a, b in combinations(members, 2):
                rows = (langs == a) | (langs == b)
                self.pairs[a, b] = train_machine(x[rows], np.where(langs[rows] == a, 1, -1))

    def predict(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Language and score of each row; the score is a logistic of the narrowest margin that decided."""
        n = len(x)
        x1 = np.hstack([x, np.ones((n, 1), np.float32)])
        lang, margin = np.empty(n, object), np.full(n, 3.0)
        family = np.zeros(n, int)
        if self.by_family is not None:
            scores = x1 @ self.by_family.T
            family = scores.argmax(axis=1)
            top = np.sort(scores, axis=1)
            margin = top[:, -1] - top[:, -2]
        for i, f in enumerate(self.families):
            rows, members = np.flatnonzero(family == i), self.members[f]
            if len(members) == 1:
                lang[rows] = members[0]
                continue
            votes, sums = np.zeros((len(rows), len(members))), np.zeros((len(rows), len(members)))
            for (a, b), (ia, ib) in zip(combinations(members, 2), combinations(range(len(members)), 2)):
                d = x1[rows] @ self.pairs[a, b]
                votes[:, ia] += d > 0
                votes[:, ib] += d <= 0
                sums[:, ia] += d
                sums[:, ib] -= d
            best = np.argmax(votes + np.tanh(sums / len(members)) / 4, axis=1)
            lang[rows] = np.array(members, object)[best]
            margin[rows] = np.minimum(margin[rows], np.abs(sums[np.arange(len(rows)), best]) / (len(members) - 1))
        return lang, 1 / (1 + np.exp(-2 * margin))


def train(docs: DataFrame, rows_per_language: int = ROWS_PER_LANGUAGE) -> Hierarchy | None:
    """Learn from at most ``rows_per_language`` rows of each language outside the held-out fold, chosen by hash."""
    prepare(docs.sparkSession)
    known = only(docs, "doc_id", "text", "lang").filter(
        F.col("lang").isNotNull() & F.col("text").isNotNull() & (F.col("lang") != UNDETERMINED) & (crc_of_id() % FOLDS != 0))
    order = [F.xxhash64("doc_id"), F.col("doc_id")]
    # Choose by id first. Rows are counted, and only those with the least hashes, some MARGIN times as many as are needed, are
    # ranked: a language's ranking is as small in a large table as in a small one. The texts are read for chosen ids only.
    ids = known.select("doc_id", "lang")
    sizes = ids.groupBy("lang").agg(F.count(F.lit(1)).alias("_n"))
    share = F.least(F.lit(1.0), F.lit(float(MARGIN * rows_per_language)) / F.col("_n"))
    few = ids.join(F.broadcast(sizes), "lang").filter(order[0].cast("double") / 2.0 ** 63 <= 2 * share - 1).drop("_n")
    top = Window.partitionBy("lang").orderBy(*order)
    chosen = materialize(few.withColumn("_rank", F.row_number().over(top)).filter(F.col("_rank") <= rows_per_language), "teaching")
    n_langs = chosen.select("lang").distinct().count()
    if not n_langs:
        return None
    each = min(rows_per_language, max(1, MAX_ROWS // n_langs))
    # Bounded by MAX_ROWS ids, or one for each language.
    ids = chosen.filter(F.col("_rank") <= each).select("doc_id").distinct()
    rows = known.join(F.broadcast(ids), "doc_id").select("lang", "text")

    def vectors(batches):
        for batch in batches:
            for part in chunks(batch):
                x = features(part.column("text")).astype(np.float16)
                yield pa.record_batch({"lang": part.column("lang"), "x": pa.array([r.tobytes() for r in x], pa.binary())})

    found = rows.mapInArrow(vectors, "lang string, x binary").toArrow()
    x = np.stack([np.frombuffer(b, np.float16) for b in found.column("x").to_pylist()]).astype(np.float32)
    labels = found.column("lang").to_pylist()
    order = np.lexsort((x.sum(axis=1), np.array(labels)))
    return Hierarchy(x[order], [labels[i] for i in order.tolist()])


def identify(docs: DataFrame, model: Hierarchy | None = None, rows_per_language: int = ROWS_PER_LANGUAGE) -> DataFrame:
    """``doc_id, held_out, lang_pred, score`` for every row; trains on ``docs`` where no model is given."""
    spark = prepare(docs.sparkSession)
    shared = share(spark, model or train(docs, rows_per_language), "languages")
    texts = only(docs, "doc_id", "text").select(
        F.col("doc_id").cast("long"), "text", (crc_of_id() % FOLDS == 0).alias("held_out"),
        F.coalesce(F.col("text").rlike(r"\p{L}"), F.lit(False)).alias("_letters"))

    def run(batches):
        hierarchy = shared()
        for batch in batches:
            for part in chunks(batch):
                letters = part.column("_letters").to_numpy(zero_copy_only=False).astype(bool)
                lang, score = np.full(part.num_rows, UNDETERMINED, object), np.zeros(part.num_rows)
                if hierarchy is not None and letters.any():
                    rows = np.flatnonzero(letters)
                    for some in np.array_split(rows, -(-len(rows) // 500)):
                        lang[some], score[some] = hierarchy.predict(features(part.column("text").take(pa.array(some))))
                yield pa.record_batch({
                    "doc_id": part.column("doc_id"), "held_out": part.column("held_out"),
                    "lang_pred": pa.array(lang.tolist(), pa.string()), "score": score})

    return texts.mapInArrow(run, "doc_id long, held_out boolean, lang_pred string, score double")
