"""Small tables of hard cases, and brute-force versions of the operators."""

from __future__ import annotations

import collections
import math
import re
import zlib

WORD = re.compile(r"[^\x20\x09-\x0D]+")
SF_DIR = "/root/testdata/sf0.01"


def ascii_lower(text: str) -> str:
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in text)


def fold(doc_id, n: int) -> int:
    return zlib.crc32(("" if doc_id is None else str(doc_id)).encode()) % n


LONG = " ".join(f"word{i % 977} Straße é中文 x{i}" for i in range(12000))
CASES = [
    (1, None), (2, ""), (3, " \t\n "), (4, "one"), (5, "a b c d"), (6, "Same text twice, same text twice, same text twice."),
    (7, "Same text twice, same text twice, same text twice."), (7, "Same text twice, same text twice, same text twice."),
    (8, LONG), (9, "x" * 30000), (10, "don't we'll they've I'd 's 're  double  spaces\n\n\n tabs\t\tand\r\nnewline "),
    (11, "<|endoftext|> a <|endoftext|>b </s> <unk> ▁▁ a▁b"), (12, "  wide ​ spaces　here \x1c odd"),
    (13, "日本語のテキスト 한국어 텍스트 العربية 🙂🙂 👨‍👩‍👧"), (None, "a row without an id"), (None, None),
    (14, "ends with space "), (15, " starts with space"), (16, "\n"), (17, "é combining ﬁ ligature Ａ fullwidth"),
]


def cases(spark, rows=CASES):
    """The rows as ``documents``, with extra columns whose names the operators use themselves."""
    schema = "doc_id long, text string, lang string, source string, n_chars long, text_hash string, label string, a int, b int, score string"
    return spark.createDataFrame([(i, t, None, "s", len(t or ""), "h", "l", 1, 2, "z") for i, t in rows], schema)


def empty(spark):
    return cases(spark, [])


def base_figures(text: str | None) -> tuple:
    words = WORD.findall(text or "")
    lines = [line for line in (text or "").split("\n") if WORD.search(line)]
    grams = collections.Counter(tuple(words[i:i + 3]) for i in range(len(words) - 2))
    covered = {i + k for i in range(len(words) - 2) if grams[tuple(words[i:i + 3])] > 1 for k in range(3)}
    return (len(words), sum(map(len, words)), sum((text or "").count(c) for c in "#*$%&|<>"),
            len(lines) - len(set(lines)), len(covered))


def quality_rejections(text: str | None) -> set[str]:
    """Names of the quality rules that turn the text away, each rule by its own definition; "base" for the base test."""
    text = text or ""
    n, chars, symbols, dup_lines, repeats = base_figures(text)
    if n < 50 or 100 * repeats > 50 * n:
        return {"base"}
    raw = text.encode()
    letters = len(re.findall(rb"[A-Za-z\x80-\xFF]", raw))
    found = {
        "word_length": not 2 <= chars / n <= 25,
        "symbols": symbols > 0.3 * n,
        "duplicate_lines": dup_lines > max(6, text.count("\n") + 1) / 2,
        "capitals": len(re.findall(rb"[A-Z]", raw)) > 0.6 * max(1, letters),
        "exclamation": len(re.findall(rb"[!?]", raw)) > 0.5 * n,
        "digits": len(re.findall(rb"[0-9]", raw)) > 0.5 * chars,
        "few_letters": letters < 0.4 * chars,
        "vocabulary": n < 1000 and len(set(WORD.findall(text))) < 0.1 * n,
    }
    return {name for name, bad in found.items() if bad}


def bag(text: str | None, k: int = 5) -> collections.Counter:
    words = WORD.findall((text or "").lower())
    if not words:
        return collections.Counter()
    return collections.Counter(tuple(words[i:i + k]) for i in range(max(1, len(words) - k + 1)))


def jaccard(x: collections.Counter, y: collections.Counter) -> float:
    both = sum((x & y).values())
    return both / (sum(x.values()) + sum(y.values()) - both) if both else 0.0


def near_classes(rows, threshold: float = 0.8) -> dict:
    """Least id of each document's class, over all pairs that share a shingle; texts without words are copies."""
    bags = [(i, bag(t)) for i, t in rows if i is not None]
    holders = collections.defaultdict(set)
    parent = {i: i for i, _ in bags}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    blank = [i for i, t in rows if i is not None and t is not None and not WORD.search(t)]
    for i in blank:
        parent[root(i)] = min(blank)
    for n, (_, b) in enumerate(bags):
        for gram in b:
            holders[gram].add(n)
    for n, (i, b) in enumerate(bags):
        shared = collections.Counter(m for gram in b for m in holders[gram] if m < n)
        for m in shared:
            if jaccard(b, bags[m][1]) >= threshold:
                x, y = root(i), root(bags[m][0])
                parent[max(x, y)] = min(x, y)
    return {i: root(i) for i, _ in bags}


def base_scores(rows) -> dict:
    """By position: ``(n_tokens, n_known, train tokens, base score)``."""
    tokens = [WORD.findall(ascii_lower(t or "")) + [None] for _, t in rows]
    counts = collections.Counter(w for (i, _), ws in zip(rows, tokens) if fold(i, 7) != 2 for w in ws)
    n, v = sum(counts.values()), len(counts)
    return {p: (len(ws), sum(counts[w] > 0 for w in ws), n, sum(math.log10((counts[w] + 1) / (n + 1 * (v + 1))) for w in ws))
            for p, ws in enumerate(tokens)}


def edit_distance_within(item: list[str], text: list[str]) -> int:
    """Least edits that turn ``item`` into a stretch of ``text``."""
    row = [0] * (len(text) + 1)
    for i, word in enumerate(item, 1):
        new = [i]
        for j, other in enumerate(text, 1):
            new.append(min(row[j - 1] + (word != other), row[j] + 1, new[j - 1] + 1))
        row = new
    return min(row)
