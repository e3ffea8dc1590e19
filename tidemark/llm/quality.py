"""Quality rules as a short-circuit cascade.

Each rule has a measure (whose cost varies) and a test. On a bounded sample all rules are timed
on the texts that pass the base test; the order then takes, step by step, the rule that rejects
most per second of those that the rules before it leave. In a batch a rule looks only at the texts
that all rules before it passed, so a measure is computed for survivors alone, and at most once.
The order changes the work, never the verdict: a text is kept if no rule rejects it.

Base figures are part of the answer and therefore computed for every text.

Defined cases: NULL and empty texts have no words and fail the base test; repeated rows are
judged each; a text of any length is read whole, hashed and counted in blocks of bytes (a text of
29 MB in words took 13 bytes for each of its bytes, one without white space 5); extra columns are
ignored; an empty table gives an empty result, and a sample of which nothing passes the base test
leaves the rules as they stand.
"""

from __future__ import annotations

import time
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import cached_property
from hashlib import blake2b

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import CHUNK_BYTES, WHITE, Words, buffer_of, chunks, only, prepare, table_of, windows

SAMPLE_DOCS = 1_000
SAMPLE_CHARS = 20_000
BASE = "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long"
SYMBOLS = table_of(b"#*$%&|<>")
UPPER, LETTERS = table_of(bytes(range(65, 91))), table_of(bytes([*range(65, 91), *range(97, 123), *range(128, 256)]))
MARKS, DIGITS = table_of(b"!?"), table_of(b"0123456789")


def word_hashes(words: Words, block: int) -> np.ndarray:
    """``words.hashes()``, computed over ``block`` bytes at a time where there are more than two blocks.

    A hash does not depend on where a word stands, so blocks agree. A word longer than a block is the last that begins in
    its own; it gets a digest, as do all words of that length.
    """
    size = len(words.data)
    if size <= 2 * block:
        return words.hashes()
    out = np.empty(len(words.start), np.uint64)
    edges = np.unique(np.searchsorted(words.start, np.arange(0, size + block, block))).tolist()
    for a, b in zip(edges[:-1], edges[1:]):
        start, end = int(words.start[b - 1]), int(words.end[b - 1])
        if end - start > block:
            b -= 1
            out[b] = int.from_bytes(blake2b(words.data[start:end], digest_size=8).digest(), "little")
        if a < b:
            low, high = words.start[a], words.end[b - 1]
            out[a:b] = Words(words.data[low:high], np.clip(words.offsets, low, high) - low).hashes()
    return out


def lines_between(raw: bytes, at: int, end: int) -> Iterator[bytes]:
    """The lines of ``raw[at:end]``, one at a time."""
    while at <= end:
        stop = raw.find(b"\n", at, end)
        stop = end if stop < 0 else stop
        yield raw[at:stop]
        at = stop + 1


class Texts:
    """A run of texts with the figures computed so far; ``pick`` arguments are arrays of text numbers."""

    def __init__(self, column: pa.Array, block: int = CHUNK_BYTES):
        self.data, self.offsets = buffer_of(column)
        self.words = Words(self.data, self.offsets)
        self.size, self.block = len(self.offsets) - 1, block

    @cached_property
    def hashes(self) -> np.ndarray:
        return word_hashes(self.words, self.block)

    def count_bytes(self, members: np.ndarray) -> np.ndarray:
        total = np.zeros(self.size, np.int64)
        for low in range(0, len(self.data), self.block):
            part = members[self.data[low:low + self.block]]
            sums = np.zeros(len(part) + 1, np.int64)
            np.cumsum(part, out=sums[1:])
            total += np.diff(sums[np.clip(self.offsets - low, 0, len(part))])
        return total

    def word_chars(self) -> np.ndarray:
        """Code points outside ASCII white space: bytes that begin one."""
        return self.count_bytes(~table_of(bytes([*WHITE, *range(128, 192)])))

    def dup_lines(self) -> np.ndarray:
        raw, out = self.data.tobytes(), []
        for a, b in zip(self.offsets[:-1].tolist(), self.offsets[1:].tolist()):
            count, distinct = 0, set()
            for line in lines_between(raw, a, b):
                if line.strip(WHITE):
                    count += 1
                    # A digest is longer than any line that is kept as it is, so the two never meet.
                    distinct.add(line if len(line) <= 32 else blake2b(line, digest_size=40).digest())
            out.append(count - len(distinct))
        return np.array(out, np.int64)

    def repeat_words(self) -> np.ndarray:
        """Words covered by a 3-word window that the text holds at least twice."""
        found, at = windows(self.hashes, self.words.first, 3)
        owner = np.searchsorted(self.words.first, at, side="right") - 1
        order = np.lexsort((found, owner))
        f, o = found[order], owner[order]
        same = (f[1:] == f[:-1]) & (o[1:] == o[:-1])
        twice = np.zeros(len(f), bool)
        twice[1:] |= same
        twice[:-1] |= same
        covered = np.zeros(len(self.words.start), bool)
        starts = at[order[twice]]
        for i in range(3):
            covered[starts + i] = True
        return np.bincount(self.words.text_of()[covered], minlength=self.size).astype(np.int64)

    def base(self) -> dict[str, np.ndarray]:
        return {"n_words": self.words.counts.astype(np.int64), "word_chars": self.word_chars(),
                "n_symbols": self.count_bytes(SYMBOLS), "n_dup_lines": self.dup_lines(),
                "n_repeat_words": self.repeat_words()}


@dataclass(frozen=True)
class Rule:
    """``reject(texts, base, pick)`` says for each picked text whether the rule turns it away."""

    name: str
    reject: Callable[[Texts, dict, np.ndarray], np.ndarray]


def _share(part: np.ndarray, whole: np.ndarray) -> np.ndarray:
    return part / np.maximum(whole, 1)


def _picked(texts: Texts, pick: np.ndarray, members: np.ndarray) -> np.ndarray:
    data, o = texts.data, texts.offsets
    return np.array([np.count_nonzero(members[data[a:b]]) for a, b in zip(o[pick].tolist(), o[pick + 1].tolist())], np.int64)


def _distinct_share(texts: Texts, pick: np.ndarray) -> np.ndarray:
    first, hashes = texts.words.first, texts.hashes
    return np.array([len(np.unique(hashes[a:b])) / max(1, b - a)
                     for a, b in zip(first[pick].tolist(), first[pick + 1].tolist())])


# Limits are wide: ordinary prose in any of the usual scripts stays well inside them.
RULES = (
    Rule("word_length", lambda t, b, p: (_share(b["word_chars"][p], b["n_words"][p]) < 2)
         | (_share(b["word_chars"][p], b["n_words"][p]) > 25)),
    Rule("symbols", lambda t, b, p: 10 * b["n_symbols"][p] > 3 * b["n_words"][p]),
    Rule("duplicate_lines", lambda t, b, p: 2 * b["n_dup_lines"][p] > np.maximum(
        6, _picked(t, p, table_of(b"\n")) + 1)),
    Rule("capitals", lambda t, b, p: 10 * _picked(t, p, UPPER) > 6 * np.maximum(1, _picked(t, p, LETTERS))),
    Rule("exclamation", lambda t, b, p: 10 * _picked(t, p, MARKS) > 5 * b["n_words"][p]),
    Rule("digits", lambda t, b, p: 10 * _picked(t, p, DIGITS) > 5 * np.maximum(1, b["word_chars"][p])),
    Rule("few_letters", lambda t, b, p: 10 * _picked(t, p, LETTERS) < 4 * b["word_chars"][p]),
    Rule("vocabulary", lambda t, b, p: (_distinct_share(t, p) < 0.1) & (b["n_words"][p] < 1000)),
)


def run_cascade(texts: Texts, base: dict, alive: np.ndarray, rules) -> tuple[np.ndarray, np.ndarray]:
    """``(kept, number of the rejecting rule or -1)``; ``alive`` marks the texts to judge."""
    by = np.full(texts.size, -1)
    alive = alive.copy()
    for i, rule in enumerate(rules):
        pick = np.flatnonzero(alive)
        if not len(pick):
            break
        bad = pick[rule.reject(texts, base, pick)]
        by[bad], alive[bad] = i, False
    return alive, by


def base_fails(base: dict) -> np.ndarray:
    return (base["n_words"] < 50) | (100 * base["n_repeat_words"] > 50 * base["n_words"])


def cheapest_order(rejected: np.ndarray, cost: np.ndarray) -> list[int]:
    """Rule numbers, each the one that rejects most per cost of the texts that those before it leave.

    ``rejected[i, j]`` says that rule i rejects text j. Rules that reject none of what is left go last, cheap first.
    """
    alive, order, left = np.ones(rejected.shape[1], bool), [], list(range(len(rejected)))
    while left:
        best = max(left, key=lambda i: (np.count_nonzero(rejected[i] & alive) / cost[i], -cost[i]))
        order.append(best)
        left.remove(best)
        alive &= ~rejected[best]
    return order


def order_rules(column: pa.Array, rules=RULES) -> tuple[Rule, ...]:
    """Rules by what they reject per second of the sample's texts that pass the base test and the rules before."""
    texts = Texts(column)
    base = texts.base()
    judged = np.flatnonzero(~base_fails(base))
    if not len(judged):
        return tuple(rules)
    rejected, cost = [], []
    for rule in rules:
        began = time.perf_counter()
        rejected.append(rule.reject(texts, base, judged))
        cost.append(time.perf_counter() - began + 1e-9)
    return tuple(rules[i] for i in cheapest_order(np.array(rejected), np.array(cost)))


def judge(docs: DataFrame, rules=RULES, sample_docs: int = SAMPLE_DOCS) -> DataFrame:
    """``doc_id``, the base figures, ``base_failed``, ``kept`` and ``rejected_by`` for every row.

    The order of the rules is estimated on at most ``sample_docs`` texts of SAMPLE_CHARS or fewer.
    ``rejected_by`` names the first rule of that order that turned the text away.
    """
    prepare(docs.sparkSession)
    texts = only(docs, "doc_id", "text").withColumn("doc_id", F.col("doc_id").cast("long"))
    sample = texts.filter(F.length("text") <= SAMPLE_CHARS).select("text").limit(sample_docs).collect()
    ordered = order_rules(pa.array([r["text"] for r in sample], pa.large_string()), rules)
    names = [r.name for r in ordered]

    def run(batches):
        for batch in batches:
            for part in chunks(batch):
                column = Texts(part.column("text"))
                base = column.base()
                failed = base_fails(base)
                kept, by = run_cascade(column, base, ~failed, ordered)
                yield pa.record_batch({
                    "doc_id": part.column("doc_id"), **{k: v.astype(np.int64) for k, v in base.items()},
                    "base_failed": failed, "kept": kept,
                    "rejected_by": pa.array(["base" if f else names[b] if b >= 0 else None for f, b in
                                             zip(failed.tolist(), by.tolist())], pa.string())})

    return texts.mapInArrow(run, f"doc_id long, {BASE}, base_failed boolean, kept boolean, rejected_by string")
