"""Token counts by lookup of pre-tokens, in two tiers on the map side.

White space starts a new pre-token, and no piece of the vocabulary reaches from another
character into a following space mark (checked when the model is loaded), so the count of a
text is the sum over its pre-tokens. The first tier is a broadcast table of the lengths of
frequent pre-tokens, found on a bounded sample; it only saves work and never changes a count.
What it misses is encoded once per Python worker and remembered there. Nothing is shuffled.

Defined cases: NULL is the empty text, with no tokens; special strings are ordinary text; no
truncation; texts of any length; repeated rows are counted each; extra columns are ignored;
an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
import re
from collections import Counter

import pyarrow as pa
import public_tokenizers
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import chunks, only, prepare, worker_store

MARK = "▁"
# Entries of the broadcast table, documents it is drawn from, their length, and that of a pre-token it may hold.
TABLE_SIZE = 50_000
SAMPLE_DOCS = 500
SAMPLE_CHARS = 20_000
KEY_CHARS = 48
# Lengths that one Python worker remembers.
CACHE_SIZE = 400_000
# A pre-token begins at white space that follows something else.
CUT = re.compile(r"(?<=[^ ]) ")


def pre_tokens(text: str) -> list[str]:
    """Parts of a non-empty text, each standing for itself behind one space mark."""
    return CUT.split(text.replace(MARK, " "))


class Counts:
    """Token counts of texts for one model."""

    def __init__(self, model: bytes, table: dict[str, int], cache_size: int = CACHE_SIZE):
        import sentencepiece

        self.model = sentencepiece.SentencePieceProcessor(model_proto=model)
        pieces = (self.model.id_to_piece(i) for i in range(self.model.get_piece_size()))
        self.splits = all(MARK not in p.lstrip(MARK) for p in pieces) and self.model.piece_to_id(MARK) != self.model.unk_id()
        self.table, self.cache, self.cache_size = table, {}, cache_size

    def encode(self, parts: list[str]) -> list[int]:
        """Lengths of pre-tokens; an empty one is a space mark alone."""
        lengths = [len(ids) for ids in self.model.encode(parts, num_threads=1)]
        return [n if p else 1 for n, p in zip(lengths, parts)]

    def of(self, text: str) -> int:
        if not text:
            return 0
        if not self.splits:
            return len(self.model.encode(text, num_threads=1))
        total, missed = 0, []
        table, cache = self.table, self.cache
        for part in pre_tokens(text):
            n = table.get(part)
            if n is None:
                n = cache.get(part)
                if n is None:
                    missed.append(part)
                    continue
            total += n
        if missed:
            lengths = self.encode(missed)
            total += sum(lengths)
            if len(cache) < self.cache_size:
                cache.update((p, n) for p, n in zip(missed, lengths) if len(p) <= KEY_CHARS)
        return total


def frequent_lengths(docs: DataFrame, model: bytes, sample_docs: int = SAMPLE_DOCS, size: int = TABLE_SIZE) -> dict[str, int]:
    """Lengths of the most frequent pre-tokens of at most ``sample_docs`` documents of SAMPLE_CHARS or fewer."""
    tally = Counter()
    for row in docs.filter(F.length("text") <= SAMPLE_CHARS).select("text").limit(sample_docs).collect():
        tally.update(p for p in pre_tokens(row["text"]) if len(p) <= KEY_CHARS)
    parts = [p for p, n in tally.most_common(size) if n > 1]
    return dict(zip(parts, Counts(model, {}).encode(parts))) if parts else {}


def count_tokens(docs: DataFrame, path: str | None = None, limit: int = 4096,
                 sample_docs: int = SAMPLE_DOCS, table_size: int = TABLE_SIZE) -> DataFrame:
    """``doc_id, n_bytes, n_tokens, over_limit`` for every row."""
    spark = prepare(docs.sparkSession)
    texts = only(docs, "doc_id", "text").withColumn("doc_id", F.col("doc_id").cast("long"))
    model = open(path or public_tokenizers.path("piece_bpe_32k.model"), "rb").read()
    shared = spark.sparkContext.broadcast((model, frequent_lengths(texts, model, sample_docs, table_size)))

    def run(batches):
        store, (proto, table) = worker_store(), shared.value
        key = ("counts", hashlib.sha256(proto).digest())
        if key not in store:
            store[key] = Counts(proto, table)
        counter = store[key]
        counter.table = table
        for batch in batches:
            for part in chunks(batch):
                n_bytes, n_tokens = [], []
                for text in part.column("text").to_pylist():
                    n_bytes.append(len((text or "").encode("utf-8", "surrogatepass")))
                    n_tokens.append(counter.of(text or ""))
                yield pa.record_batch({
                    "doc_id": part.column("doc_id"), "n_bytes": pa.array(n_bytes, pa.int64()),
                    "n_tokens": pa.array(n_tokens, pa.int64()), "over_limit": pa.array([n > limit for n in n_tokens])})

    return texts.mapInArrow(run, "doc_id long, n_bytes long, n_tokens long, over_limit boolean")
