"""Benchmark decontamination by edit distance over words.

An item of n words is found in a document if some stretch of it is within ``n * rate`` word
insertions, deletions and substitutions of the whole item. Words are runs of letters and digits in
lower case, so punctuation, white space and case do not count. In scripts written without spaces (Han, kana,
Thai, Lao, Khmer, Myanmar) each character is a word.

Windows of the items' sizes are embedded by random walks (CGK): a pointer steps through the
words, writing the word it stands on at each of 3n steps, and moves on or stays by a random bit that
depends on the step and the word. Two sequences at a small edit distance give walks that differ in
few steps. Each of REPEATS walks is sampled at a few random steps; windows that share a sample with an
item are candidates. They are verified by an exact edit distance (bit-parallel).

Few windows need a walk: k edits leave at least n - 2 - 3k of an item's three-word runs
as they are, so windows with fewer runs that occur in any item cannot match. That condition loses
nothing; it is tested by table lookups on all windows.

Items of fewer than WALK_WORDS words need none: a match keeps at least one of their three-word runs (of items of five
words, with one edit, one of two words), so every place that holds one is verified. Items of four words and
fewer are found exactly.

Items of one block are broadcast; a benchmark beyond BLOCK_BYTES is cut into blocks, each compared with
all documents.

Defined cases: NULL and texts without words match nothing; items of fewer than MIN_WORDS words are found
wherever their words stand, and that may be by chance; items with equal words are each reported; rows that
share a document id are reported once for an item, with the least distance; a NULL item id is
reported as NULL; texts of any length are searched whole; extra columns are ignored; empty tables give
an empty result.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import Words, buffer_of, by_place, chunks, mix, not_alphanumeric, only, prepare, share, table_of, windows

RATE = 0.2
MIN_WORDS = 4
RUN = 3
WALK_WORDS = 10
# One edit leaves no run of three words of such an item, but one of two.
PAIR_WORDS = 5
REPEATS = 24
BLOCK_BYTES = 4 << 20
TABLE_BITS = 22
SIZE_STEP = 1.25
WINDOWS_AT_ONCE = 5_000
SEPARATORS = not_alphanumeric()
UNSPACED = r"[\p{Han}\p{Hiragana}\p{Katakana}\p{Thai}\p{Lao}\p{Khmer}\p{Myanmar}]"
# First bytes of their characters in UTF-8 (E2 only has punctuation and a few radicals and numbers, E0 also Indic letters).
MAY_BE_UNSPACED = table_of(bytes([0xE0, 0xE1, *range(0xE2, 0xEB), 0xEF, 0xF0]))
PAST_END = np.uint64(0x5EED0FE0D0FE5EED)


def edits_allowed(n: int, rate: float = RATE) -> int:
    """Edits that an item of n words may be away; few enough that a run of RUN words stays whole, or of two words where
    the item has five."""
    return int(n * rate + 1e-9) if n >= 6 else min(1, int(n * rate + 1e-9)) if n == PAIR_WORDS else 0


def runs_kept(n: int, rate: float = RATE) -> int:
    """Runs of RUN words that any match of an item of n words shares with it, at least."""
    return max(1, n - RUN + 1 - RUN * edits_allowed(n, rate))


def word_hashes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    lower = pc.utf8_lower(pc.fill_null(column.cast(pa.large_string()), ""))
    data, offsets = buffer_of(lower)
    if MAY_BE_UNSPACED[data].any():
        data, offsets = buffer_of(pc.replace_substring_regex(lower, UNSPACED, r" \0 "))
    words = Words(data, offsets, SEPARATORS)
    return words.hashes(), words.first


def sampled_steps(size: int) -> np.ndarray:
    """The steps at which each of the REPEATS walks over a window of ``size`` words is sampled.

    A walk takes about two steps a word, so steps past 2 * size mostly read padding. The second step of
    a sample follows soon on the first: where walks agree once, they agree for a while.
    """
    draw = np.random.default_rng(size)
    begin = draw.integers(0, max(1, int(1.6 * size) - 8), REPEATS)
    return np.stack([begin, begin + draw.integers(4, 9, REPEATS)], axis=1)


def samples(hashes: np.ndarray, start: np.ndarray, stop: np.ndarray, group: np.ndarray, steps: list[np.ndarray]) -> np.ndarray:
    """A key for each walk (row) and window (column): the words at the steps that ``steps[group]`` samples.

    A window begins at ``start``; from ``stop`` on it reads as padding. All walks of all windows go on
    together, one step at a time. ``group`` is in ascending order.
    """
    cover = np.zeros(len(hashes) + 1, np.int64)
    np.add.at(cover, start, 1)
    np.add.at(cover, stop, -1)
    used = np.flatnonzero(np.cumsum(cover) > 0)
    words, padding = np.append(hashes[used], PAST_END), len(used)
    begin = np.searchsorted(used, start)
    end = begin + (stop - start)
    columns = {int(g): slice(*np.searchsorted(group, [g, g + 1])) for g in np.unique(group)}
    events: dict[int, list[tuple[int, int]]] = {}
    for g in columns:
        for walk, chosen in enumerate(steps[g].tolist()):
            for step in chosen:
                events.setdefault(step, []).append((walk, g))
    walks = np.arange(REPEATS, dtype=np.uint64)[:, None]
    position = np.broadcast_to(begin, (REPEATS, len(begin))).copy()
    key = np.broadcast_to(walks, position.shape).copy()
    for step in range(max(events) + 1):
        if step % 64 == 0:
            # The next 64 random bits of each word in each walk.
            bits = mix(words + mix(walks * np.uint64(0xC2B2AE3D27D4EB4F) + np.uint64(step)))
        at = np.where(position < end, position, padding)
        for walk, g in events.get(step, ()):
            mine = columns[g]
            key[walk, mine] = mix(key[walk, mine] + words[at[walk, mine]])
        position += (np.take_along_axis(bits, at, axis=1) >> np.uint64(step % 64) & np.uint64(1)).astype(np.int64)
    return key


def nearest(item: list[int], text: list[int], limit: int) -> int | None:
    """The least edit distance between ``item`` and any stretch of ``text``, if within ``limit``.

    One bit per word of the item, in a Python integer of any length.
    """
    n = len(item)
    where: dict[int, int] = {}
    for i, word in enumerate(item):
        where[word] = where.get(word, 0) | 1 << i
    full, top = (1 << n) - 1, 1 << (n - 1)
    up, down, distance = full, 0, n
    best = n
    for word in text:
        same = where.get(word, 0)
        diagonal = (((same & up) + up) ^ up) | same | down
        rises, falls = down | (full & ~(diagonal | up)), up & diagonal
        if rises & top:
            distance += 1
        elif falls & top:
            distance -= 1
        # A match may begin anywhere, so the first row stays 0 and nothing is carried in.
        rises, falls = rises << 1 & full, falls << 1 & full
        up, down = falls | (full & ~(diagonal | rises)), rises & diagonal
        best = min(best, distance)
    return best if best <= limit else None


class Items:
    """The index of a block of items: runs, and for each size class the samples of its items."""

    def __init__(self, ids: list, texts: pa.Array, rate: float = RATE):
        hashes, first = word_hashes(texts)
        self.ids, self.rate = ids, rate
        self.words = [hashes[a:b] for a, b in zip(first[:-1].tolist(), first[1:].tolist())]
        used = [i for i, w in enumerate(self.words) if len(w) >= WALK_WORDS]
        short = [i for i, w in enumerate(self.words) if MIN_WORDS <= len(w) < WALK_WORDS and len(w) != PAIR_WORDS]
        # Items of five words by their runs of two, with the run's place in the item.
        self.pairs: dict[int, list[tuple[int, int]]] = {}
        for i, w in enumerate(self.words):
            if len(w) == PAIR_WORDS:
                for offset, run in enumerate(windows(w, np.array([0, len(w)]), 2)[0].tolist()):
                    self.pairs.setdefault(run, []).append((i, offset))
        by_size: dict[int, list[int]] = {}
        for i in used:
            by_size.setdefault(int(math.log(len(self.words[i])) / math.log(SIZE_STEP)), []).append(i)
        self.classes, runs, owners = [], [], []
        for number, members in enumerate(by_size.values()):
            sizes = [len(self.words[i]) for i in members]
            low, steps = min(sizes), sampled_steps(min(sizes))
            begin = np.array([first[i] for i in members])
            order = np.argsort(begin)
            keys = samples(hashes, begin[order], begin[order] + low, np.zeros(len(members), np.int64), [steps])
            index: dict[int, list[int]] = {}
            for row in keys.tolist():
                for i, key in zip(np.array(members)[order].tolist(), row):
                    index.setdefault(key, []).append(i)
            slack = max(edits_allowed(n, rate) for n in sizes)
            self.classes.append((low, max(sizes) + slack, min(runs_kept(n, rate) for n in sizes), steps,
                                 np.array(sorted(index), np.uint64), index))
            for i in members:
                own = windows(self.words[i], np.array([0, len(self.words[i])]), RUN)[0]
                runs.append(own)
                owners.append(np.full(len(own), 1 << number, np.int64))
        # Short items by their runs, with the run's place in the item.
        places: dict[int, set[tuple[int, int]]] = {}
        for i in short:
            own = windows(self.words[i], np.array([0, len(self.words[i])]), RUN)[0]
            runs.append(own)
            owners.append(np.zeros(len(own), np.int64))
            for offset, run in enumerate(own.tolist()):
                places.setdefault(run, set()).add((i, offset))
        # Items too short for runs by all of their words, for each number of words.
        self.whole: dict[int, dict[int, list[int]]] = {}
        for i, w in enumerate(self.words):
            if 0 < len(w) < MIN_WORDS:
                key = int(windows(w, np.array([0, len(w)]), len(w))[0][0])
                self.whole.setdefault(len(w), {}).setdefault(key, []).append(i)
        # Each run with the size classes (bits) of the items that hold it.
        self.runs, inverse = np.unique(np.concatenate(runs) if runs else np.zeros(0, np.uint64), return_inverse=True)
        self.run_classes = np.zeros(len(self.runs), np.int64)
        if runs:
            np.bitwise_or.at(self.run_classes, inverse, np.concatenate(owners))
        self.places = [places.get(run, ()) for run in self.runs.tolist()]
        self.of_short = np.array([len(x) > 0 for x in self.places], bool)
        self.table = np.zeros(1 << TABLE_BITS, bool)
        self.table[(self.runs >> np.uint64(64 - TABLE_BITS)).astype(np.int64)] = True

    def find(self, hashes: np.ndarray, first: np.ndarray) -> list[tuple[int, int, int]]:
        """``(text, item, distance)`` for all texts of a batch."""
        return self._confirm(hashes, first, self._find_whole(hashes, first) | self._find_pairs(hashes, first)
                             | self._find_near(hashes, first))

    def _find_whole(self, hashes, first) -> set[tuple[int, int, int]]:
        candidates = set()
        for n, items in self.whole.items():
            found, at = windows(hashes, first, n)
            hit = np.flatnonzero(np.isin(found, np.array(list(items), np.uint64)))
            # Once for each text.
            text = np.searchsorted(first, at[hit], side="right") - 1
            once = np.unique(np.stack([text.astype(np.uint64), found[hit]]), axis=1, return_index=True)[1]
            for t, key, s in zip(text[once].tolist(), found[hit][once].tolist(), at[hit][once].tolist()):
                candidates.update((t, i, s) for i in items[key])
        return candidates

    def _find_pairs(self, hashes, first) -> set[tuple[int, int, int]]:
        if not self.pairs:
            return set()
        found, at = windows(hashes, first, 2)
        hit = np.flatnonzero(np.isin(found, np.array(list(self.pairs), np.uint64)))
        text = np.searchsorted(first, at[hit], side="right") - 1
        return {(t, i, s - offset) for t, s, run in zip(text.tolist(), at[hit].tolist(), found[hit].tolist())
                for i, offset in self.pairs[run]}

    def _find_near(self, hashes, first) -> set[tuple[int, int, int]]:
        found, at = windows(hashes, first, RUN)
        if not len(found) or not len(self.runs):
            return set()
        maybe = np.flatnonzero(self.table[(found >> np.uint64(64 - TABLE_BITS)).astype(np.int64)])
        place = np.minimum(np.searchsorted(self.runs, found[maybe]), len(self.runs) - 1)
        sure = self.runs[place] == found[maybe]
        marked, of_class = at[maybe[sure]], self.run_classes[place[sure]]
        candidates: set[tuple[int, int, int]] = set()
        held = np.flatnonzero(self.of_short[place[sure]])
        for s, run in zip(marked[held].tolist(), place[sure][held].tolist()):
            t = int(np.searchsorted(first, s, side="right")) - 1
            candidates.update((t, i, s - offset) for i, offset in self.places[run])
        begun = []
        for number, (_, reach, least, *_) in enumerate(self.classes):
            where = marked[of_class >> number & 1 == 1]
            if not len(where):
                continue
            upto = np.zeros(len(hashes) + 1, np.int64)
            upto[where + 1] = 1
            upto = np.cumsum(upto)
            # Starts from which a window of the class could reach a marked run.
            spread = np.zeros(len(hashes) + 1, np.int64)
            np.add.at(spread, np.maximum(where - reach, first[np.searchsorted(first, where, side="right") - 1]), 1)
            np.add.at(spread, where + 1, -1)
            start = np.flatnonzero(np.cumsum(spread)[:-1] > 0)
            text = np.searchsorted(first, start, side="right") - 1
            enough = upto[np.minimum(start + reach, first[text + 1])] - upto[start] >= least
            begun.append(np.stack([start[enough], text[enough], np.full(int(enough.sum()), number)]))
        begun = np.concatenate(begun, axis=1) if begun else np.zeros((3, 0), np.int64)
        sizes, steps = np.array([c[0] for c in self.classes]), [c[3] for c in self.classes]
        for lot in range(0, begun.shape[1], WINDOWS_AT_ONCE):
            start, text, number = begun[:, lot:lot + WINDOWS_AT_ONCE]
            keyed = samples(hashes, start, np.minimum(start + sizes[number], first[text + 1]), number, steps)
            for n in np.unique(number).tolist():
                *_, keys, index = self.classes[n]
                mine = np.flatnonzero(number == n)
                key = keyed[:, mine]
                walk, column = np.nonzero(keys[np.minimum(np.searchsorted(keys, key), len(keys) - 1)] == key)
                for k, s, t in zip(key[walk, column].tolist(), start[mine[column]].tolist(), text[mine[column]].tolist()):
                    candidates.update((t, i, s) for i in index[k])
        return candidates

    def _confirm(self, hashes, first, candidates) -> list[tuple[int, int, int]]:
        """Exact distances; starts that lie close together are one stretch of text."""
        stretches: dict[tuple[int, int], list[list[int]]] = {}
        for t, i, s in sorted(candidates):
            slack = edits_allowed(len(self.words[i]), self.rate)
            low, high = s - slack, s + len(self.words[i]) + 2 * slack
            last = stretches.setdefault((t, i), [])
            if last and low <= last[-1][1]:
                last[-1][1] = max(last[-1][1], high)
            else:
                last.append([low, high])
        results = []
        for (t, i), pieces in stretches.items():
            item = self.words[i].tolist()
            limit = edits_allowed(len(item), self.rate)
            found = [nearest(item, hashes[max(low, int(first[t])):min(high, int(first[t + 1]))].tolist(), limit)
                     for low, high in pieces]
            found = [d for d in found if d is not None]
            if found:
                results.append((t, i, min(found)))
        return results


def find_items(docs: DataFrame, benchmark: DataFrame, rate: float = RATE, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """``doc_id, item_id, distance`` for each document and each item found in it."""
    spark = prepare(docs.sparkSession)
    texts = only(docs, "doc_id", "text").select(F.col("doc_id").cast("long"), "text")
    items = only(benchmark, "item_id", "text").select(F.col("item_id").cast("long"), "text").filter(F.col("text").isNotNull())
    total = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    blocks = -(-total // block_bytes)
    parts = []
    for block in range(blocks):
        rows = items.filter(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == block).collect()
        shared = share(spark, Items([r["item_id"] for r in rows], pa.array([r["text"] for r in rows], pa.large_string()), rate),
                       "items")

        def run(batches, shared=shared):
            index = shared()
            for batch in batches:
                for part in chunks(batch):
                    found = index.find(*word_hashes(part.column("text")))
                    if found:
                        text, item, distance = zip(*found)
                        yield pa.record_batch({
                            "doc_id": part.column("doc_id").take(pa.array(text)),
                            "item_id": pa.array([index.ids[i] for i in item], pa.int64()),
                            "distance": pa.array(distance, pa.int32())})

        parts.append(texts.mapInArrow(run, "doc_id long, item_id long, distance int"))
    if not parts:
        return spark.createDataFrame([], "doc_id long, item_id long, distance int")
    every = parts[0]
    for part in parts[1:]:
        every = every.unionByName(part)
    return every.groupBy("doc_id", "item_id").agg(F.min("distance").alias("distance"))


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, rate: float = RATE) -> DataFrame:
    """``docs`` without those that hold an item. A row with a NULL id is judged with all rows that have none."""
    rows, key = by_place(docs, "doc_id")
    found = find_items(docs, benchmark, rate).select(F.col("doc_id").alias("found")).distinct()
    return rows.join(found, F.col(key).eqNullSafe(F.col("found")), "left_anti").toDF(*docs.columns)
