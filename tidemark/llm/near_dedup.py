"""Near-duplicates by BagMinHash: multisets of word shingles, banded signatures, exact verification.

A shingle that occurs w times covers [0, w) of a weight axis cut at 1, 2, 4, 8, ... For each
(shingle, stretch of the axis) a Poisson process of points, with rate the stretch's length, gives
times, places on the axis and one of the signature's slots; points beyond w do not count, so two
multisets share exactly the points on their common weights. A slot keeps the point of least time, and two
signatures agree in a slot with probability their weighted Jaccard similarity. Points are made in order
of time and only up to a horizon by which all slots are filled almost surely (if not, it doubles), so
the work is about the number of shingles plus m log m.

Texts with the same words in the same order are one text from the start. Signatures are banded;
texts that share a band are a bucket. No bucket is expanded into pairs. First each member is verified
against the bucket's pivot, and classes are the connected components of verified pairs. Buckets whose
other members then lie in different classes are cut into blocks: members outside the largest class meet all
others. A task holds two blocks against each
other by one byte of each slot, verifies pairs of different classes that agree in 64 % of the slots or more
(at similarity 0.8 fewer agree with probability below one in 100,000), in the bucket of their first shared
band, and returns only links that join two classes. So every pair in a bucket that could join two
classes is looked at, a task holds two blocks, and what it returns is less than its members.

Verification compares whole multisets: overlap / union of 5-word shingles, at least 0.8.

Defined cases: a NULL text is alone in its class; texts without words (empty, white space) are copies
of each other; texts of fewer than ``words`` words have one shingle, all their words; rows that share an id are one
document whose classes join; rows with a NULL id get a NULL class; whole texts of any length;
extra columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
import math

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from tidemark.llm.common import BASE, Words, buffer_of, by_place, chunks, materialize, mix, only, partitions, prepare, shingles

WORDS, THRESHOLD = 5, 0.8
# A pair of similarity 0.8 shares no band with probability (1 - 0.8**5)**25, about 5 in 100,000.
BANDS, ROWS = 25, 5
# Members of a bucket that one block holds, and the share of slots from which a pair is verified.
BLOCK, AGREE = 1_000, 0.64
# Sides of a join are broadcast up to so many rows of two ids, or so many bytes of bags; else both are shuffled.
BROADCAST_ROWS, BROADCAST_BYTES = 1_000_000, 32 << 20
BAG_BYTES = 6
# Keys of more than one in so many rows are joined without a shuffle.
HOT_KEYS = 1_000
STEP = 0xD1B54A32D192ED03


def multisets(hashes: np.ndarray, owner: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``hashes, weights, owner`` of distinct shingles, sorted by owner and hash."""
    order = np.lexsort((hashes, owner))
    h, o = hashes[order], owner[order]
    if not len(h):
        return h, np.zeros(0, np.int64), o
    start = np.flatnonzero(np.concatenate([[True], (h[1:] != h[:-1]) | (o[1:] != o[:-1])]))
    return h[start], np.diff(np.concatenate([start, [len(h)]])), o[start]


def bag_signatures(hashes: np.ndarray, weights: np.ndarray, owner: np.ndarray, n: int, slots: int) -> np.ndarray:
    """``n`` rows of ``slots`` point names; the multisets' total weights must not be 0."""
    names = np.zeros((n, slots), np.uint64)
    todo, reach = np.unique(owner), math.log(slots) + 4
    total = np.bincount(owner, weights=weights, minlength=n)
    while len(todo):
        mine = np.isin(owner, todo) if len(todo) < n else np.ones(len(owner), bool)
        h, w, o = hashes[mine], weights[mine], owner[mine]
        # Stretches [0,1), [1,2), [2,4), ...: as many as the weight reaches into.
        stretches = 1 + np.ceil(np.log2(w)).astype(np.int64)
        element = np.repeat(np.arange(len(h)), stretches)
        j = np.arange(len(element)) - np.repeat(np.cumsum(stretches) - stretches, stretches)
        low = np.where(j > 0, 2.0 ** (j - 1), 0.0)
        length = np.where(j > 0, low, 1.0)
        seed = mix(h[element] + j.astype(np.uint64) * np.uint64(BASE))
        time, limit = np.zeros(len(seed)), slots * reach / total[o[element]]
        own, weight = o[element], w[element]
        least = np.full(n * slots, np.inf)
        name = np.zeros(n * slots, np.uint64)
        k = 0
        while len(seed):
            k += 1
            draw = mix(seed + np.uint64(k * STEP & 0xFFFFFFFFFFFFFFFF))
            time = time - np.log(((draw >> np.uint64(11)).astype(np.float64) + 0.5) / 2.0 ** 53) / length
            go = time < limit
            seed, time, limit, own = seed[go], time[go], limit[go], own[go]
            weight, low, length, draw = weight[go], low[go], length[go], draw[go]
            point = mix(draw ^ np.uint64(STEP))
            slot = ((point >> np.uint64(32)) * np.uint64(slots) >> np.uint64(32)).astype(np.int64)
            place = low + length * ((point & np.uint64(0xFFFFFFFF)).astype(np.float64) / 2.0 ** 32)
            counts = np.flatnonzero(place < weight)
            at = own[counts] * slots + slot[counts]
            before = least[at]
            np.minimum.at(least, at, time[counts])
            won = counts[(time[counts] == least[at]) & (time[counts] < before)]
            name[own[won] * slots + slot[won]] = point[won]
        filled = np.isfinite(least.reshape(n, slots)).all(axis=1)
        done = todo[filled[todo]]
        names[done] = name.reshape(n, slots)[done]
        todo, reach = todo[~filled[todo]], reach * 2
    return names


def band_keys(names: np.ndarray, bands: int, rows: int) -> np.ndarray:
    blocks = names.reshape(len(names), bands, rows)
    key = np.zeros(blocks.shape[:2], np.uint64)
    for r in range(rows):
        key = key * np.uint64(BASE) + blocks[:, :, r]
    return mix(key).view(np.int64)


def _shingled(column: pa.Array, words: int):
    data, offsets = buffer_of(pc.utf8_lower(pc.fill_null(column.cast(pa.large_string()), "")))
    found = Words(data, offsets)
    hashes = found.hashes()
    return hashes, found.first, *shingles(hashes, found.first, words)


def sign(texts: DataFrame, words: int = WORDS, bands: int = BANDS, rows: int = ROWS) -> DataFrame:
    """``doc_id, same`` (a 128-bit hash of the words; NULL for a NULL text) ``, bands, sketch`` for each row.

    ``sketch`` is one byte of each slot of the signature.
    """
    def run(batches):
        for batch in batches:
            for part in chunks(batch):
                hashes, first, found, owner = _shingled(part.column("text"), words)
                known = part.column("text").is_valid().to_pylist()
                same = [same_words(hashes[a:b]) if there else None
                        for a, b, there in zip(first[:-1].tolist(), first[1:].tolist(), known)]
                # Copies inside a batch are signed once.
                leader = {}
                of = np.array([leader.setdefault(s, i) for i, s in enumerate(same)])
                lead = (of == np.arange(len(of)))[owner]
                h, w, o = multisets(found[lead], owner[lead])
                names = bag_signatures(h, w, o, len(same), bands * rows)[of]
                keys, sketches = band_keys(names, bands, rows), names.astype(np.uint8)
                yield pa.record_batch({
                    "doc_id": part.column("doc_id"), "same": pa.array(same, pa.binary()),
                    "bands": pa.array(list(keys), pa.list_(pa.int64())),
                    "sketch": pa.array([x.tobytes() for x in sketches], pa.binary())})

    return texts.mapInArrow(run, "doc_id long, same binary, bands array<long>, sketch binary")


def same_words(hashes: np.ndarray) -> bytes:
    return hashlib.blake2b(hashes.tobytes(), digest_size=16).digest()


def shingle_sets(texts: DataFrame, words: int = WORDS) -> DataFrame:
    """``doc_id, same, bag``: sorted 48-bit names of the text's shingles, the i-th copy of one with a name of its own."""
    def run(batches):
        for batch in batches:
            for part in chunks(batch):
                hashes, first, found, owner = _shingled(part.column("text"), words)
                same = [same_words(hashes[a:b]) for a, b in zip(first[:-1].tolist(), first[1:].tolist())]
                order = np.lexsort((found, owner))
                h, o = found[order], owner[order]
                new = np.concatenate([[True], (h[1:] != h[:-1]) | (o[1:] != o[:-1])]) if len(h) else np.zeros(0, bool)
                start = np.flatnonzero(new)
                copy = np.arange(len(h)) - start[np.cumsum(new) - 1] if len(h) else np.zeros(0, np.int64)
                names = np.where(copy > 0, mix(h + copy.astype(np.uint64) * np.uint64(STEP)), h)
                edge = np.searchsorted(o, np.arange(part.num_rows + 1))
                bags = [_short(np.sort(names[a:b])) for a, b in zip(edge[:-1].tolist(), edge[1:].tolist())]
                yield pa.record_batch({"doc_id": part.column("doc_id"), "same": pa.array(same, pa.binary()),
                                       "bag": pa.array(bags, pa.binary())})

    return texts.mapInArrow(run, "doc_id long, same binary, bag binary")


def _short(names: np.ndarray) -> bytes:
    return names.astype(">u8").view(np.uint8).reshape(-1, 8)[:, :BAG_BYTES].tobytes()


def _long(bag: pa.Scalar) -> np.ndarray:
    short = np.frombuffer(bag.as_buffer(), np.uint8).reshape(-1, BAG_BYTES)
    wide = np.zeros((len(short), 8), np.uint8)
    wide[:, :BAG_BYTES] = short
    return wide.reshape(-1).view(">u8").astype(np.uint64)


def similarity(x: np.ndarray, y: np.ndarray) -> float:
    """Overlap over union of two bags."""
    both = np.concatenate([x, y])
    both.sort()
    common = int(np.count_nonzero(both[1:] == both[:-1]))
    return common / (len(both) - common)


def _compare(batches, threshold: float):
    for batch in batches:
        keep = [similarity(_long(x), _long(y)) >= threshold - 1e-9 for x, y in zip(batch.column("bag_a"), batch.column("bag_b"))]
        yield pa.record_batch([batch.column("a"), batch.column("b")], names=["a", "b"]).filter(pa.array(keep, pa.bool_()))


def stored(df: DataFrame, label: str, *figures) -> tuple[DataFrame, dict]:
    """``df`` written and read back, with its row count ``n`` and ``figures`` gathered while it was written."""
    seen = Observation()
    back = materialize(df.observe(seen, F.count(F.lit(1)).alias("n"), *figures), label)
    return back, seen.get


def components(edges: DataFrame) -> DataFrame:
    """``node, label``: the least node of each connected component of ``edges`` (``a, b``).

    Alternates large-star and small-star steps: each joins a node's neighbours to the least of
    them, by one aggregation and one join, until nothing changes. No neighbourhood is gathered.
    """
    now = materialize(edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
                      .filter("a <> b").distinct(), "edges")
    mark, total = None, F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")).alias("s")
    while True:
        both = now.unionByName(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = both.filter("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        small = large.groupBy("a").agg(F.min("b").alias("m"))
        after = (large.join(small, "a").filter("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
                 .unionByName(small.select("a", F.col("m").alias("b"))).filter("a <> b").distinct())
        now, state = stored(after, "edges", total)
        if state == mark:
            # Stars by now: every node but the centre has one edge, to the centre.
            return now.select(F.col("a").alias("node"), F.col("b").alias("label")).unionByName(
                now.select(F.col("b").alias("node"), F.col("b").alias("label")).distinct())
        mark = state


def compare(pairs: DataFrame, n_pairs: int, bags: DataFrame, threshold: float) -> DataFrame:
    """Those of the stored ``pairs`` (``a`` a pivot, ``b``) whose whole bags are similar enough."""
    few = n_pairs <= BROADCAST_ROWS
    pivots = bags.join(F.broadcast(pairs.select("a").distinct()) if few else pairs.select("a").distinct(),
                       bags["doc"] == F.col("a"), "left_semi")
    light = few and (pivots.agg(F.sum(F.length("bag"))).first()[0] or 0) <= BROADCAST_BYTES
    side = pivots.select(F.col("doc").alias("a"), F.col("bag").alias("bag_a"))
    whole = (bags.select(F.col("doc").alias("b"), F.col("bag").alias("bag_b"))
             .join(F.broadcast(pairs) if few else pairs, "b").join(F.broadcast(side) if light else side, "a"))
    return whole.select("a", "b", "bag_a", "bag_b").mapInArrow(lambda it: _compare(it, threshold), "a long, b long")


def _join_classes(lot: pa.Table, threshold: float) -> pa.Table:
    """Links that join classes, from whole tiles: members of one or two blocks of a bucket (``band, key, i, j``)."""
    lot = lot.sort_by([(c, "ascending") for c in ("band", "key", "i", "j", "own", "doc")])
    doc, label, own, band, i, j = (lot.column(c).to_numpy() for c in ("doc", "label", "own", "band", "i", "j"))
    sketch = np.frombuffer(b"".join(lot.column("sketch").to_pylist()), np.uint8).reshape(len(doc), -1)
    keys = np.stack(lot.column("bands").to_pylist())
    bags = lot.column("bag").combine_chunks()
    changes = [np.flatnonzero(np.diff(lot.column(c).to_numpy())) + 1 for c in ("band", "key", "i", "j")]
    edges = np.unique(np.concatenate([[0], *changes, [len(doc)]])).tolist()
    least, left, right = math.ceil(AGREE * sketch.shape[1]), [], []
    for a, b in zip(edges[:-1], edges[1:]):
        root, opened = label[a:b].copy(), {}

        def bag(x: int) -> np.ndarray:
            if x not in opened:
                opened[x] = _long(bags[x])
            return opened[x]

        # Against the rest of its own block, or against the other block, which comes behind it.
        cut = a + int(np.searchsorted(own[a:b], i[a], side="right"))
        for x in range(a, cut):
            first = x + 1 if i[a] == j[a] else cut
            others = first + np.flatnonzero(root[first - a:] != root[x - a])
            agree = (sketch[others] == sketch[x]).sum(axis=1)
            others, agree = others[agree >= least], agree[agree >= least]
            # The likeliest first: once two classes are one, their other pairs need no look.
            for y in others[np.argsort(-agree, kind="stable")].tolist():
                if root[x - a] != root[y - a] and np.argmax(keys[x] == keys[y]) == band[a] and similarity(bag(x), bag(y)) >= threshold - 1e-9:
                    left.append(doc[x])
                    right.append(doc[y])
                    root[root == root[y - a]] = root[x - a]
    return pa.table({"a": pa.array(left, pa.int64()), "b": pa.array(right, pa.int64())})


def links(texts: DataFrame, distinct: DataFrame, members: DataFrame, threshold: float, words: int, block: int = BLOCK) -> DataFrame:
    """``node, label`` of the classes that the members of buckets (``band, key, doc``) form.

    ``doc`` names a text of ``distinct`` (``doc, same, lead, bands, sketch``), ``lead`` is the id of a row that has it.
    """
    ids, found = stored(members.select("doc").distinct(), "candidates")
    few = found["n"] <= BROADCAST_ROWS
    wanted = materialize(distinct.select("doc", "same", "lead").join(F.broadcast(ids) if few else ids, "doc"), "wanted")
    leads = wanted.select(F.col("lead").alias("doc_id")).distinct()
    read = texts.join(F.broadcast(leads) if few else leads, "doc_id", "left_semi").select("doc_id", "text")
    names = wanted.withColumnRenamed("lead", "doc_id")
    # Other texts of a lead's id go; of repeated rows one bag stays.
    bags = materialize(shingle_sets(read, words).join(F.broadcast(names) if few else names, ["doc_id", "same"])
                       .groupBy("doc").agg(F.min("bag").alias("bag")), "bags")
    lead = members.groupBy("band", "key").agg(F.min_by("doc", F.struct(F.xxhash64("doc"), "doc")).alias("a"))
    rest = materialize(members.join(lead, ["band", "key"]).filter("doc <> a"), "members")
    pairs, found = stored(rest.select("a", F.col("doc").alias("b")).distinct(), "pairs")
    labels = materialize(components(compare(pairs, found["n"], bags, threshold)), "labels")

    placed = materialize(rest.select("band", "key", "doc").join(
        labels.select(F.col("node").alias("doc"), "label"), "doc", "left").withColumn(
        "label", F.coalesce("label", "doc")), "placed")
    # Members of one class need no look at each other: those outside the largest class meet all, in blocks.
    mixed = placed.groupBy("band", "key", "label").agg(F.count(F.lit(1)).alias("n")).groupBy("band", "key").agg(
        F.sum("n").alias("n"), F.max(F.struct("n", "label")).alias("top")).filter(F.col("n") > F.col("top.n"))
    split, found = stored(
        placed.join(mixed.select(
            "band", "key", F.col("top.label").alias("main"), F.ceil(F.col("top.n") / block).cast("int").alias("mains"),
            F.ceil((F.col("n") - F.col("top.n")) / block).cast("int").alias("others")), ["band", "key"])
        .withColumn("is_main", F.col("label") == F.col("main"))
        .withColumn("own", F.when(F.col("is_main"), F.col("others") + F.pmod(F.xxhash64("doc"), F.col("mains")))
                    .otherwise(F.pmod(F.xxhash64("doc"), F.col("others"))).cast("int"))
        .withColumn("reach", F.col("others") + F.when(F.col("is_main"), 0).otherwise(F.col("mains"))), "open")
    if not found["n"]:
        return labels
    few = found["n"] <= BROADCAST_ROWS
    known = bags.join(distinct.select("doc", "bands", "sketch"), "doc")
    tiles = (
        known.join(F.broadcast(split) if few else split, "doc")
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("reach") - 1)))
        .select("band", "key", "doc", "label", "own", "sketch", "bands", "bag",
                F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"))
        # Small tiles share a call of the function; a lot holds about an eighth of a partition.
        .withColumn("lot", F.pmod(F.xxhash64("band", "key", "i", "j"), F.lit(8 * partitions(texts.sparkSession)))))
    joined = tiles.groupBy("lot").applyInArrow(lambda lot: _join_classes(lot, threshold), "a long, b long")
    return components(joined.unionByName(
        labels.filter("node <> label").select(F.col("node").alias("a"), F.col("label").alias("b"))))


def with_value(rows: DataFrame, side: DataFrame, key: str, total: int) -> DataFrame:
    """``rows`` joined with ``side`` (one row a key, with ``n``, how many of the ``total`` rows have it).

    Keys of more than a thousandth of the rows are fewer than a thousand: they are broadcast, the others shuffled.
    """
    hot = F.broadcast(side.filter(F.col("n") * HOT_KEYS > total).drop("n"))
    return rows.join(hot, key).unionByName(rows.join(hot, key, "left_anti").join(side.filter(F.col("n") * HOT_KEYS <= total).drop("n"), key))


def classes(docs: DataFrame, threshold: float = THRESHOLD, words: int = WORDS, bands: int = BANDS, rows: int = ROWS) -> DataFrame:
    """``doc_id, class_id`` for each row of ``docs``; the class is named by its least id."""
    prepare(docs.sparkSession)
    texts = only(docs, "doc_id", "text").select(F.col("doc_id").cast("long"), "text")
    signed, found = stored(sign(texts, words, bands, rows), "signatures")
    worded = signed.filter(F.col("same").isNotNull() & F.col("doc_id").isNotNull())
    # Copies have the same words and so the same signature: one row, with a number of its own, stands for each text.
    distinct = materialize(worded.groupBy("same").agg(
        F.count(F.lit(1)).alias("n"), F.min("doc_id").alias("lead"), F.first("bands").alias("bands"), F.first("sketch").alias("sketch"),
    ).withColumn("doc", F.monotonically_increasing_id()), "texts")
    banded = distinct.select("doc", F.posexplode("bands").alias("band", "key"))
    shared = banded.groupBy("band", "key").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("band", "key")
    members = materialize(banded.join(shared, ["band", "key"]).distinct(), "buckets")
    near = links(texts.filter(F.col("text").isNotNull()), distinct, members, threshold, words)
    # The least id of each class of texts, then of each row's text.
    labelled = materialize(distinct.select("doc", "same", "lead", "n").join(
        near.select(F.col("node").alias("doc"), "label"), "doc", "left").withColumn("label", F.coalesce("label", "doc")), "labelled")
    named = labelled.groupBy("label").agg(F.min("lead").alias("class"))
    of_text = labelled.join(named, "label").select("same", "n", "class")
    of_rows = materialize(with_value(worded.select("doc_id", "same"), of_text, "same", found["n"]).select("doc_id", "class"), "row-classes")
    return signed.select("doc_id").join(_classes_of_ids(of_rows), "doc_id", "left").select(
        "doc_id", F.coalesce("class", "doc_id").alias("class_id"))


def _classes_of_ids(of_rows: DataFrame) -> DataFrame:
    """``doc_id, class``: an id whose rows have texts of several classes joins them."""
    of_ids, found = stored(of_rows.groupBy("doc_id").agg(F.min("class").alias("class"), F.max("class").alias("last")), "id-classes",
                           F.count_if(F.col("class") != F.col("last")).alias("several"))
    if not found["several"]:
        return of_ids.drop("last")
    least = of_ids.filter(F.col("class") != F.col("last")).select("doc_id", F.col("class").alias("b"))
    merged = components(of_rows.join(least, "doc_id").select(F.col("class").alias("a"), "b"))
    return of_ids.drop("last").join(merged, F.col("class") == F.col("node"), "left").select(
        "doc_id", F.coalesce("label", "class").alias("class"))


def keep_one(docs: DataFrame, threshold: float = THRESHOLD, words: int = WORDS) -> DataFrame:
    """``docs`` with one document of each class, the one with the least id; rows with a NULL id stay."""
    found = classes(docs, threshold, words)
    rows, key = by_place(docs, "doc_id")
    gone = found.filter("doc_id <> class_id").select(F.col("doc_id").alias("gone")).distinct()
    kept = rows.join(gone, F.col(key) == F.col("gone"), "left_anti")
    return kept.toDF(*docs.columns)
