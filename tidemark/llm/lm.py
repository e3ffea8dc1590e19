"""Language-model scoring with a log-frequency Bloom filter.

Counts of unigrams and bigrams are quantised, q = 1 + floor(log(count) / log(BASE_OF_LOG)), and
an n-gram is stored as the q pairs (n-gram, 1) ... (n-gram, q). A count is read by probing level
after level until one is missing; it stands for the middle of its range. Each range of the hash
sizes its stretch of the filter by the pairs counted in it, so that a missing level is taken for present
with a chance of ERROR_RATE whatever the corpus. Bigrams enter it from ``bigram_cutoff`` occurrences on.
The model interpolates with a
Dirichlet prior: p(w|v) = (c(v,w) + MU p(w)) / (c(v) + MU), p(w) = (c(w) + 1) / (N + V + 1).

The corpus is counted in full. Tasks add up their n-grams, ENTRIES_AT_ONCE at a time, and send arrays of (hash, count)
to ranges of the hash, one at least for each RANGE_BYTES of text (and 16 in all). A range adds up the arrays as they
come, so it holds its distinct n-grams and never all that was sent to it, and makes its own stretch of the filter, so
no merging of filters is needed.

A filter of at most ``filter_bits`` is broadcast. A larger one stays where its ranges lie, and distinct word pairs
of each document go there: pairs with a word that is not broadcast first to that word's range, which adds its level, and
all of them at last to the range of the bigram, which adds up the scores of its pairs per document. Pairs with at least
N / HEAD of all tokens are broadcast with their levels and need no way. Either way the levels are the same.

The base score needs exact counts. Words with at least N / HEAD of all tokens are at most HEAD
words; they are broadcast. All others are looked up where their range of the hash holds
their counts, again in arrays of distinct words for each batch, and summed up per document. A range's counts are read once,
before the arrays that were sent to it, which follow batch by batch.

Defined cases: NULL is the empty text, which consists of the end token; repeated rows and ids count
and are scored each; a NULL id counts as the empty id text; without training rows N = V = 0 and
all base scores are 0; whole texts of any length; extra columns are ignored; an empty table
gives an empty result. Words are told apart by 64-bit hashes.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import Words, buffer_of, chunks, crc_of_id, materialize, mix, only, partitions, prepare, share

FOLDS, HELD_OUT = 7, 2
HEAD = 1_000_000
FILTER_BITS = 1 << 30  # that may be broadcast
ERROR_RATE = 0.02
PROBES = 3
BASE_OF_LOG = 1.5
BIGRAM_CUTOFF = 1
# Best of 30, 100, 300, 1,000 and 3,000 by the log-probability of held-out texts (README).
MU = 300.0
MAX_LEVEL = 110  # of any count in 64 bits
RANGE_BYTES = 16 << 20  # of text for each range of the hash
RANGES_A_TASK = 4
ENTRIES_AT_ONCE = 2_000_000
AT_BEGIN, OPEN = 254, 255  # in place of a level: no word but the begin of a text, and not known yet
END, BEGIN = 0x0E4D0E4D0E4D0E4D, 0x0B360B360B360B36

COUNTS = "part int, uni binary, uni_count binary, top binary, top_count binary, bits binary, tokens long, types long"
SCORES = ("uid long, doc_id long, held_out boolean, n_tokens long, n_known long, base_score double, score double")


def token_arrays(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``tokens, previous, first``: hashes with an end token behind each text, and those before them."""
    data, offsets = buffer_of(pc.ascii_lower(pc.fill_null(texts.cast(pa.large_string()), "")))
    words = Words(data, offsets)
    tokens = np.insert(words.hashes(), words.first[1:], np.uint64(END))
    first = words.first + np.arange(len(words.first))
    previous = np.empty_like(tokens)
    previous[1:] = tokens[:-1]
    previous[first[:-1]] = np.uint64(BEGIN)
    return tokens, previous, first


def bigram(previous: np.ndarray, tokens: np.ndarray) -> np.ndarray:
    return mix(previous * np.uint64(0x9DDFEA08EB382D69) + tokens)


def pack48(x: np.ndarray) -> bytes:
    """The high 48 bits of each number; the filter needs no more of a bigram."""
    return x.astype(">u8").view(np.uint8).reshape(-1, 8)[:, :6].tobytes()


def unpack48(raw: bytes) -> np.ndarray:
    short = np.frombuffer(raw, np.uint8).reshape(-1, 6)
    wide = np.zeros((len(short), 8), np.uint8)
    wide[:, :6] = short
    return wide.reshape(-1).view(">u8").astype(np.uint64)


def range_of(x: np.ndarray, bits: int) -> np.ndarray:
    return (x >> np.uint64(64 - bits)).astype(np.int64) if bits else np.zeros(len(x), np.int64)


def split_ranges(sorted_hashes: np.ndarray, bits: int, some: np.ndarray | None = None) -> np.ndarray:
    """Where each range begins in sorted hashes, and their end; ``some`` names all ranges that have hashes."""
    some = np.arange(1 << bits) if some is None else some
    return np.searchsorted(range_of(sorted_hashes, bits), np.append(some, 1 << bits))


def quantise(counts: np.ndarray) -> np.ndarray:
    return 1 + np.floor(np.log(counts) / math.log(BASE_OF_LOG) + 1e-9).astype(np.int64)


def levels_to_count(q: np.ndarray) -> np.ndarray:
    """Middle of the range of counts that share a level; 0 for 0."""
    low, high = np.ceil(BASE_OF_LOG ** np.maximum(q - 1, 0) - 1e-9), np.ceil(BASE_OF_LOG ** q - 1e-9) - 1
    return np.where(q > 0, (low + np.maximum(low, high)) / 2, 0.0)


class Filter:
    """Bits in 2**bits stretches, one for each range of the hash, each of its own size."""

    def __init__(self, stretches, bits: int):
        sizes = np.array([len(s) for s in stretches], np.int64)
        self.bytes, self.bits, self.sizes, self.base = np.concatenate(list(stretches)), bits, sizes * 8, np.cumsum(sizes) - sizes

    @staticmethod
    def size_for(counts: list[np.ndarray]) -> int:
        """Bits in which the pairs of these counts leave a missing level with ERROR_RATE."""
        settings = PROBES * sum(int(quantise(c).sum()) for c in counts)
        return max(64, math.ceil(settings / -math.log(1 - ERROR_RATE ** (1 / PROBES)) / 8) * 8)

    @staticmethod
    def places(keys: np.ndarray, level: int, kind: int, size) -> list[np.ndarray]:
        seed = mix(keys + np.uint64((level * 0x9E3779B97F4A7C15 + kind * 0xC2B2AE3D27D4EB4F) & 0xFFFFFFFFFFFFFFFF))
        step = (seed >> np.uint64(32)) | np.uint64(1)
        return [((seed + np.uint64(i) * step) & np.uint64(0xFFFFFFFF)) % np.asarray(size, np.uint64) for i in range(PROBES)]

    @classmethod
    def stretch(cls, size: int, entries: list[tuple[np.ndarray, np.ndarray, int]]) -> bytes:
        """One range's bits from ``(keys, counts, kind)``."""
        bits = np.zeros(size, bool)
        for keys, counts, kind in entries:
            q = quantise(counts)
            for level in range(1, int(q.max(initial=0)) + 1):
                for at in cls.places(keys[q >= level], level, kind, size):
                    bits[at.astype(np.int64)] = True
        return np.packbits(bits, bitorder="little").tobytes()

    def levels(self, keys: np.ndarray, kind: int) -> np.ndarray:
        """The level of each key: probes go on while all bits of a level are set."""
        q = np.zeros(len(keys), np.int64)
        alive = np.arange(len(keys))
        part = range_of(keys, self.bits)
        base, sizes = self.base[part], self.sizes[part]
        level = 1
        while len(alive) and level <= MAX_LEVEL:
            some, start, hit = keys[alive], base[alive], np.ones(len(alive), bool)
            for at in self.places(some, level, kind, sizes[alive]):
                at = at.astype(np.int64)
                hit &= (self.bytes[start + (at >> 3)] >> (at & 7).astype(np.uint8) & 1).astype(bool)
            alive = alive[hit]
            q[alive] = level
            level += 1
        return q


def levels_in(stretch, keys: np.ndarray, kind: int) -> np.ndarray:
    """Levels of keys of one range, from its stretch."""
    return Filter([np.frombuffer(stretch, np.uint8)], 0).levels(keys, kind)


def top48(x: np.ndarray) -> np.ndarray:
    return x & np.uint64(0xFFFFFFFFFFFF0000)


def _joined(column, unpack) -> np.ndarray:
    found = [unpack(x.as_buffer()) for x in column.combine_chunks()] if len(column) else []
    return np.concatenate(found) if found else np.zeros(0, np.uint64)


class Tally:
    """Adds up counts of hashes as they come; ``known`` distinct ones are held, and no more than as many others."""

    def __init__(self):
        self.parts, self.known, self.waiting = [(np.zeros(0, np.uint64), np.zeros(0, np.int64))], 0, 0

    def add(self, keys: np.ndarray, counts: np.ndarray) -> None:
        self.parts.append((keys, counts))
        self.waiting += len(keys)
        if self.waiting > max(self.known, ENTRIES_AT_ONCE):
            self.total()

    def total(self) -> tuple[np.ndarray, np.ndarray]:
        """Distinct hashes in order, and their counts."""
        if self.waiting:
            keys, counts = [np.concatenate(x) for x in zip(*self.parts)]
            order = np.argsort(keys, kind="stable")
            keys, counts = keys[order], counts[order].astype(np.int64)
            start = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
            self.parts = [(keys[start], np.add.reduceat(counts, start))]
            self.known, self.waiting = len(start), 0
        return self.parts[0]


def _count_batches(batches, bits: int):
    """Per range: distinct unigrams and bigrams of a stretch of the task's texts, with their counts."""
    uni, bi = Tally(), Tally()
    for batch in batches:
        for part in chunks(batch):
            tokens, previous, _ = token_arrays(part.column("text"))
            uni.add(*np.unique(tokens, return_counts=True))
            bi.add(*np.unique(bigram(previous, tokens), return_counts=True))
            if uni.known + bi.known > ENTRIES_AT_ONCE // 2:
                yield _by_range(uni, bi, bits)
                uni, bi = Tally(), Tally()
    yield _by_range(uni, bi, bits)


def _by_range(uni: Tally, bi: Tally, bits: int) -> pa.RecordBatch:
    (u, u_n), (b, b_n) = uni.total(), bi.total()
    some = np.union1d(range_of(u, bits), range_of(b, bits))
    columns = []
    for keys, counts, pack in ((u, u_n, lambda x: x.tobytes()), (b, b_n, pack48)):
        edge = split_ranges(keys, bits, some).tolist()
        columns += [pa.array([f(x[i:j]) for i, j in zip(edge, edge[1:])], pa.binary())
                    for x, f in ((keys, pack), (counts.astype("<u4"), lambda x: x.tobytes()))]
    return pa.record_batch([pa.array(some, pa.int32()), *columns], names=["part", "uni", "uni_n", "bi", "bi_n"])


def dealt(rows: DataFrame, bits: int, *order) -> DataFrame:
    """``rows`` where their ranges are, those of a range together: ranges go round the tasks, so none has many more than another."""
    tasks = max(partitions(rows.sparkSession), (1 << bits) // RANGES_A_TASK)
    return rows.repartitionById(tasks, "part").sortWithinPartitions("part", *order)


def slices(batches):
    """``part`` and its rows, batch by batch, of batches in the order of ``part``."""
    for batch in batches:
        table = pa.Table.from_batches([batch])
        parts = table.column("part").to_numpy()
        start = np.flatnonzero(np.diff(parts, prepend=-1)).tolist()
        for a, b in zip(start, [*start[1:], len(parts)]):
            yield int(parts[a]), table.slice(a, b - a)


def count_ngrams(train: DataFrame, bits: int, bigram_cutoff: int = BIGRAM_CUTOFF, head: int = HEAD) -> DataFrame:
    """Stored counts: one row for each range of the hash, with exact unigrams and its stretch of the filter.

    ``top`` holds its most frequent bigrams, four times as many as a range's part of ``head`` and a thousand more.
    """
    most = 4 * head // (1 << bits) + 1_000

    def merge(batches):
        words, pairs, part = Tally(), Tally(), None
        for p, table in slices(batches):
            if part not in (None, p):
                yield row_of(part, words, pairs)
                words, pairs = Tally(), Tally()
            part = p
            for tally, keys, counts, unpack in ((words, "uni", "uni_n", lambda x: np.frombuffer(x, np.uint64)), (pairs, "bi", "bi_n", unpack48)):
                tally.add(_joined(table.column(keys), unpack), _joined(table.column(counts), lambda x: np.frombuffer(x, "<u4")))
        if part is not None:
            yield row_of(part, words, pairs)

    def row_of(part: int, words: Tally, pairs: Tally) -> pa.RecordBatch:
        (uni, uni_n), (bi, bi_n) = words.total(), pairs.total()
        often = bi_n >= bigram_cutoff
        bi, bi_n = bi[often], bi_n[often]
        stretch = Filter.stretch(Filter.size_for([uni_n, bi_n]), [(top48(uni), uni_n, 1), (bi, bi_n, 2)])
        top = np.argpartition(-bi_n, most)[:most] if len(bi) > most else np.arange(len(bi))
        blobs = [uni, uni_n.astype("<i8"), bi[top], bi_n[top].astype("<i8")]
        return pa.record_batch([
            pa.array([part], pa.int32()), *[pa.array([x.tobytes()], pa.binary()) for x in blobs], pa.array([stretch], pa.binary()),
            pa.array([int(uni_n.sum())], pa.int64()), pa.array([len(uni)], pa.int64()),
        ], names=[f.split()[0] for f in COUNTS.split(", ")])

    blobs = train.select("text").mapInArrow(
        lambda it: _count_batches(it, bits), "part int, uni binary, uni_n binary, bi binary, bi_n binary")
    return materialize(dealt(blobs, bits).mapInArrow(merge, COUNTS), "ngrams")


def score_documents(docs: DataFrame, head: int = HEAD, filter_bits: int = FILTER_BITS, mu: float = MU,
                    bigram_cutoff: int = BIGRAM_CUTOFF) -> DataFrame:
    """``doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score`` for every row."""
    spark = prepare(docs.sparkSession)
    texts = only(docs, "doc_id", "text").select(
        F.col("doc_id").cast("long"), "text", (crc_of_id() % FOLDS == HELD_OUT).alias("held_out"))
    size, n_docs = texts.agg(F.coalesce(F.sum(F.octet_length("text").cast("long")), F.lit(0)), F.count_if(~F.col("held_out"))).first()
    bits = max(4, math.ceil(math.log2(max(1, size / RANGE_BYTES))))
    counts = count_ngrams(texts.filter(~F.col("held_out")), bits, bigram_cutoff, head)
    stats = counts.agg(*[F.coalesce(F.sum(c), F.lit(0)).alias(a) for c, a in (
        ("tokens", "n"), ("types", "v"), (F.length("bits").cast("long") * 8, "bits"))]).first()
    n_train, n_types, light = stats["n"], stats["v"], stats["bits"] <= filter_bits
    least = n_train / head

    def frequent(batches):
        # At most ``head`` words, and as many pairs, have so large a share of all tokens.
        for batch in batches:
            for uni, n, top, top_n, stretch in zip(*[[x.as_buffer() for x in batch.column(c)] for c in wanted]):
                found = []
                for keys, many, kind in ((uni, n, 1), (top, top_n, 2)):
                    keys, many = np.frombuffer(keys, np.uint64), np.frombuffer(many, "<i8")
                    often = many >= least
                    found += [keys[often], many[often], levels_in(stretch, top48(keys[often]), kind).astype(np.uint8)]
                yield pa.record_batch([pa.array([x.tobytes()], pa.binary()) for x in found], names=list("knqxyz"))

    wanted = ["uni", "uni_count", "top", "top_count", "bits"]
    found = counts.select(wanted).mapInArrow(frequent, ", ".join(f"{c} binary" for c in "knqxyz")).drop("y").collect()
    keys, many, known_q, pair_keys, pair_q = [np.frombuffer(b"".join(bytes(r[c]) for r in found), t) for c, t in (
        ("k", np.uint64), ("n", "<i8"), ("q", np.uint8), ("x", np.uint64), ("z", np.uint8))]
    order, pair_order = np.argsort(keys), np.argsort(pair_keys)
    bloom = None
    if light:
        stretches = [np.zeros(8, np.uint8)] * (1 << bits)
        for r in counts.select("part", "bits").toLocalIterator():
            stretches[r["part"]] = np.frombuffer(r["bits"], np.uint8)
        bloom = Filter(stretches, bits)
        del stretches
    shared = share(spark, (keys[order], many[order], known_q[order], pair_keys[pair_order], pair_q[pair_order], bloom), "ngrams")
    del bloom
    norm = n_train + n_types + 1

    def log_of(pair_q, before_q, word_q):
        before_c = np.where(before_q == AT_BEGIN, n_docs, levels_to_count(np.where(before_q == AT_BEGIN, 0, before_q)))
        pair_c = np.minimum(levels_to_count(pair_q), before_c)
        return np.log10((pair_c + mu * (levels_to_count(word_q) + 1) / norm) / (before_c + mu))

    def score(batches):
        frequent_keys, frequent_counts, frequent_levels, frequent_pairs, pair_levels, bloom = shared()
        uid = TaskContext.get().partitionId() << 40
        for batch in batches:
            for part in chunks(batch):
                tokens, previous, first = token_arrays(part.column("text"))
                n = part.num_rows
                owner = np.repeat(np.arange(n), np.diff(first))
                distinct, inverse = np.unique(tokens, return_inverse=True)
                # The base: words of the broadcast table here, the rest where their counts are.
                at = np.minimum(np.searchsorted(frequent_keys, distinct), max(0, len(frequent_keys) - 1))
                here = frequent_keys[at] == distinct if len(frequent_keys) else np.zeros(len(distinct), bool)
                c = np.where(here, frequent_counts[at], 0) if len(frequent_keys) else np.zeros(len(distinct))
                log_c = np.where(here, np.log10((c + 1) / norm), 0.0)
                base = np.bincount(owner, weights=log_c[inverse], minlength=n)
                known = np.bincount(owner, weights=here[inverse], minlength=n).astype(np.int64)
                # The model: levels of each distinct word once, of each bigram where it stands, or else where its counts are.
                if bloom is not None:
                    word_q = bloom.levels(top48(distinct), 1)
                    before_q = np.empty(len(tokens), np.int64)
                    before_q[1:] = word_q[inverse[:-1]]
                    before_q[first[:-1]] = AT_BEGIN
                    log_p = log_of(bloom.levels(top48(bigram(previous, tokens)), 2), before_q, word_q[inverse])
                    model = np.bincount(owner, weights=log_p, minlength=n)
                else:
                    q = np.where(here, frequent_levels[at], OPEN) if len(frequent_keys) else np.full(len(distinct), OPEN)
                    before = np.empty(len(tokens), np.int64)
                    before[1:] = inverse[:-1]
                    before[first[:-1]] = len(distinct)
                    pair, times = np.unique((owner * (len(distinct) + 1) + before) * len(distinct) + inverse, return_counts=True)
                    w, rest = pair % len(distinct), pair // len(distinct)
                    v, doc = rest % (len(distinct) + 1), rest // (len(distinct) + 1)
                    v, before_q, w, word_q = np.append(distinct, np.uint64(BEGIN))[v], np.append(q, AT_BEGIN)[v], distinct[w], q[w]
                    both = top48(bigram(v, w))
                    at = np.minimum(np.searchsorted(frequent_pairs, both), max(0, len(frequent_pairs) - 1))
                    # A pair is no more frequent than its words, so both of a broadcast pair's have their levels.
                    done = (frequent_pairs[at] == both) & (before_q != OPEN) & (word_q != OPEN) if len(frequent_pairs) else np.zeros(len(both), bool)
                    log_p = log_of(pair_levels[at[done]].astype(np.int64), before_q[done], word_q[done])
                    model = np.bincount(doc[done], weights=times[done] * log_p, minlength=n)
                    yield from pairs_of(uid, v[~done], w[~done], uid + doc[~done], times[~done], before_q[~done], word_q[~done])
                uids = uid + np.arange(n)
                yield rows_of(range_of(mix(uids.astype(np.uint64)), bits), uids, part, np.diff(first), known, base, model)
                rest = np.flatnonzero(~here[inverse])
                if len(rest):
                    # Sorted by word, as ``distinct`` is, so ranges are stretches.
                    pair = np.unique(inverse[rest].astype(np.int64) * n + owner[rest], return_counts=True)
                    word, doc = distinct[pair[0] // n], (pair[0] % n).astype("<u4")
                    some = np.unique(range_of(word, bits))
                    edge = split_ranges(word, bits, some).tolist()
                    yield blobs_of(some, uid, [(word[a:b].tobytes(), doc[a:b].tobytes(), pair[1][a:b].astype("<u4").tobytes())
                                               for a, b in zip(edge, edge[1:])])
                uid += n

    # ``hop`` is where pairs go: 1 to the first word, 2 to the second, 3 to the bigram.
    wide = f"part int, {SCORES}, word binary, doc binary, times binary, hop int, before binary, q binary"
    names = [f.split()[0] for f in wide.split(", ")]
    types = [pa.int32(), pa.int64(), pa.int64(), pa.bool_(), pa.int64(), pa.int64(), pa.float64(), pa.float64(),
             pa.binary(), pa.binary(), pa.binary(), pa.int32(), pa.binary(), pa.binary()]

    def rows_of(where, uids, part, n_tokens, known, base, model):
        given = [where, uids, part.column("doc_id"), part.column("held_out"), n_tokens, known, base, model]
        columns = [x if isinstance(x, pa.Array) else pa.array(x) for x in given] + [pa.nulls(len(uids))] * 6
        return pa.record_batch([x.cast(t) for x, t in zip(columns, types)], names=names)

    def blobs_of(where, uid, blobs):
        none = pa.nulls(len(where))
        columns = [pa.array(where), pa.array(np.full(len(where), uid)), *[none] * 6, *[pa.array(x, pa.binary()) for x in zip(*blobs)], *[none] * 3]
        return pa.record_batch([x.cast(t) for x, t in zip(columns, types)], names=names)

    def pairs_of(uid, v, w, doc, times, before_q, word_q):
        """Blobs of word pairs, each on its way to the next range that it needs."""
        hop = np.where(before_q == OPEN, 1, np.where(word_q == OPEN, 2, 3))
        for h in np.unique(hop).tolist():
            mine = np.flatnonzero(hop == h)
            both = bigram(v[mine], w[mine])
            where = range_of((v[mine], w[mine], both)[h - 1], bits)
            order = np.argsort(where, kind="stable")
            some, start = np.unique(where[order], return_index=True)
            mine, both, edge = mine[order], both[order], [*start.tolist(), len(order)]
            blobs = []
            for a, b in zip(edge, edge[1:]):
                m = mine[a:b]
                word, before = (pack48(both[a:b]), b"") if h == 3 else (w[m].tobytes(), v[m].tobytes())
                q = np.stack([before_q[m], word_q[m]]).astype(np.uint8)
                blobs.append((word, doc[m].astype("<i8").tobytes(), times[m].astype("<u4").tobytes(), before, q.tobytes()))
            word, doc_, times_, before, q = [pa.array(x, pa.binary()) for x in zip(*blobs)]
            none = pa.nulls(len(some))
            columns = [pa.array(some), pa.array(np.full(len(some), uid)), *[none] * 6, word, doc_, times_,
                       pa.array(np.full(len(some), h)), before, q]
            yield pa.record_batch([x.cast(t) for x, t in zip(columns, types)], names=names)

    def next_hop(rows: pa.Table, stored: pa.Table | None) -> list[pa.Table]:
        """Pairs with one more level, or scores of those that have all."""
        stretch = stored.column("bits")[0].as_buffer() if stored else bytes(8)
        out = []
        for h in np.unique(rows.column("hop").to_numpy()).tolist():
            some = rows.filter(pc.equal(rows.column("hop"), h))
            doc, times = [_joined(some.column(c), lambda x, t=t: np.frombuffer(x, t)) for c, t in (("doc", "<i8"), ("times", "<u4"))]
            before_q, word_q = np.concatenate([np.frombuffer(x.as_buffer(), np.uint8).reshape(2, -1) for x in some.column("q")], axis=1).astype(np.int64)
            if h == 3:
                log_p = log_of(levels_in(stretch, _joined(some.column("word"), unpack48), 2), before_q, word_q)
                uids, back = np.unique(doc, return_inverse=True)
                none = pa.nulls(len(uids))
                columns = [none, pa.array(uids), *[none] * 5, pa.array(np.bincount(back, weights=times * log_p)), *[none] * 6]
                out.append(pa.table([x.cast(t) for x, t in zip(columns, types)], names=names))
                continue
            v, w = [_joined(some.column(c), lambda x: np.frombuffer(x, np.uint64)) for c in ("before", "word")]
            # Each word is probed once.
            distinct, back = np.unique(v if h == 1 else w, return_inverse=True)
            q = levels_in(stretch, top48(distinct), 1)[back]
            before_q, word_q = (q, word_q) if h == 1 else (before_q, q)
            out.append(pa.Table.from_batches(list(pairs_of(int(some.column("part")[0].as_py()), v, w, doc, times, before_q, word_q))))
        return out

    def resolve(rows: pa.Table, stored: pa.Table | None) -> pa.Table:
        schema = pa.schema(list(zip(names, types)))
        rows = rows.select(names).cast(schema)
        pairs = rows.filter(pc.is_valid(rows.column("hop")))
        rows = rows.filter(pc.is_null(rows.column("hop")))
        whole = [rows.filter(pc.is_null(rows.column("word"))), *(next_hop(pairs, stored) if pairs.num_rows else [])]
        blobs = rows.filter(pc.is_valid(rows.column("word")))
        if not blobs.num_rows:
            return pa.concat_tables(whole)
        word = _joined(blobs.column("word"), lambda x: np.frombuffer(x, np.uint64))
        sizes = [len(x.as_buffer()) // 4 for x in blobs.column("doc").combine_chunks()]
        doc = np.repeat(blobs.column("uid").to_numpy(), sizes) + _joined(blobs.column("doc"), lambda x: np.frombuffer(x, "<u4")).astype(np.int64)
        times = _joined(blobs.column("times"), lambda x: np.frombuffer(x, "<u4")).astype(np.int64)
        c = np.zeros(len(word), np.int64)
        if stored:
            keys = np.frombuffer(stored.column("uni")[0].as_buffer(), np.uint64)
            counted = np.frombuffer(stored.column("uni_count")[0].as_buffer(), "<i8")
            if len(keys):
                at = np.minimum(np.searchsorted(keys, word), len(keys) - 1)
                c = np.where(keys[at] == word, counted[at], 0)
        uids, back = np.unique(doc, return_inverse=True)
        base = np.bincount(back, weights=times * np.log10((c + 1) / norm))
        known = np.bincount(back, weights=times * (c > 0)).astype(np.int64)
        none = pa.nulls(len(uids))
        extra = [none, pa.array(uids), none, none, none, pa.array(known), pa.array(base), none, *[none] * 6]
        return pa.concat_tables([*whole, pa.table([x.cast(t) for x, t in zip(extra, types)], names=names)])

    def in_order(batches):
        """Rows with what their range holds for them; its counts, where it has any, come before its rows."""
        part, stored = None, None
        for p, some in slices(batches):
            if p != part:
                part, stored = p, None
            if some.column("uni")[0].is_valid:
                stored, some = some.slice(0, 1), some.slice(1)
            if some.num_rows:
                yield from resolve(some, stored).combine_chunks().to_batches()

    def looked_up(rows: DataFrame) -> DataFrame:
        held = ["uni", "uni_count"] + ([] if light else ["bits"])
        both = rows.unionByName(counts.select("part", *held), allowMissingColumns=True)
        done = dealt(both, bits, F.col("uni").isNull()).mapInArrow(in_order, wide)
        return done if light else materialize(done, "scores")

    parts = looked_up(texts.mapInArrow(score, wide))
    if not light:
        second = looked_up(parts.filter("hop IS NOT NULL"))
        third = looked_up(second.filter("hop IS NOT NULL"))
        parts = parts.filter("hop IS NULL").unionByName(second.filter("hop IS NULL")).unionByName(third)
    return parts.groupBy("uid").agg(
        F.max("doc_id").alias("doc_id"), F.max("held_out").alias("held_out"), F.max("n_tokens").alias("n_tokens"),
        F.sum("n_known").alias("n_known"), F.sum("base_score").alias("base_score"), F.sum("score").alias("score"),
    ).select("doc_id", "held_out", "n_tokens", "n_known", F.lit(n_train).cast("long").alias("train_tokens"), "base_score", "score")
