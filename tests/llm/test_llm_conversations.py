"""Conversation repair, against SQL and a brute-force search over all paths."""

import hashlib
import itertools
import random

import compare
import fixtures_llm as fx
import pytest

from tidemark.llm import conversations as conv
from tidemark.llm.queries import ORACLES, QUERIES

SCHEMA = "conv_id long, turn long, role string, text string"
COLUMNS = ["conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]


def test_equal_to_sql(spark):
    found = compare.differences(QUERIES["op12_conversation_repair"](spark, fx.SF_DIR), compare.connect(fx.SF_DIR),
                                ORACLES["op12_conversation_repair"])
    assert not found, "\n".join(found)


def faults_of(rows):
    seen, out = set(), []
    for _, role, text in rows:
        ink = text.strip("\x20\t\n\x0b\x0c\r")
        out.append("blank" if not ink else "duplicate" if (role, text) in seen else "" if ink[-1] in ".!?" else "truncated")
        seen.add((role, text))
    return out


def brute(rows):
    """All edits of a short conversation, by whole strings: ``cost, audit, repaired text``."""
    paths = {(0, "", (), ""): None}
    nexts = {"": "su", "s": "u", "u": "a", "a": "u"}
    names = {"u": "user", "a": "assistant"}
    paths = [(0, "", (), "")]

    def inserted(path):
        cost, audit, lines, last = path
        yield path
        for _ in range(2):
            step = "a" if last == "u" else "u"
            cost, audit, lines, last = cost + 3, audit + "I", (*lines, f"{names[step]}:"), step
            yield cost, audit, lines, last

    for (_, role, text), fault in zip(rows, faults_of(rows)):
        new = []
        for path in paths:
            for cost, audit, lines, last in inserted(path):
                new.append((cost + 4, audit + "D", lines, last))
                if fault not in ("blank", "duplicate"):
                    extra = 3 if fault == "truncated" else 0
                    if role[:1] and role[:1] in nexts[last]:
                        new.append((cost + extra, audit + "K", (*lines, f"{role}:{text}"), role[:1]))
                    step = "a" if last == "u" else "u"
                    new.append((cost + 3 + extra, audit + "R", (*lines, f"{names[step]}:{text}"), step))
        # Paths that no later edit can make cheapest.
        least = min(p[0] for p in new)
        paths = [p for p in new if p[0] <= least + 12]
    ends = [p for path in paths for p in inserted(path) if p[3] in ("", "a")]
    cost, audit, lines, _ = min(ends, key=lambda p: (p[0], p[1]))
    return cost, audit, "\n".join(lines)


def expected(conv_id, rows):
    rows = sorted(((t, " " if r is None else r, " " if x is None else x) for t, r, x in rows),
                  key=lambda r: (r[0] is not None, r[0] or 0, r[1], r[2]))
    faults = faults_of(rows)
    turns = [t for t, _, _ in rows if t is not None]
    cost, audit, text = brute(rows)
    illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in itertools.pairwise(rows))
    return (conv_id, max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0, *[faults.count(f) for f in ("blank", "duplicate", "truncated")],
            illegal, cost, audit, hashlib.sha256(text.encode()).hexdigest())


def random_conversations(seed, count, most):
    draw = random.Random(seed)
    roles = ["user", "assistant", "system", "tool", "", None, "User", "aide"]
    texts = ["Yes.", "No!", "what", "", None, " \n", "Same text.", "é?", "cut off ", "Well. "]
    out = {}
    for i in range(count):
        n = draw.randint(1, most)
        out[i if i else None] = [(draw.choice([None, *range(n)]), draw.choice(roles[:draw.choice([3, 8])]), draw.choice(texts) if draw.random() < .4 else f"Text {draw.random()}{draw.choice('.!? x')}")
                                 for _ in range(n)]
    return out


def frame(spark, table):
    return spark.createDataFrame([(i, *row) for i, rows in table.items() for row in rows], SCHEMA)


def found(df):
    return sorted((tuple(r[c] for c in COLUMNS) for r in df.collect()), key=repr)


@pytest.mark.parametrize("block,tasks", [(4096, 8), (1, 3), (2, 40), (3, 1)])
def test_digests_whatever_the_blocks(spark, block, tasks):
    table = random_conversations(block, 150, 7)
    old = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", tasks)
    try:
        got = found(conv.digests(frame(spark, table), block_rows=block))
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)
    assert got == sorted((expected(i, rows) for i, rows in table.items()), key=repr)


def test_blocks_agree_with_a_whole_solution_on_long_conversations(spark):
    """One conversation holds most rows; its blocks give what one run over it gives."""
    draw = random.Random(3)
    rows = [(t, draw.choice(["user", "assistant", "user", "system"]), draw.choice(["Ok.", "", "half", f"Text {t % 900}."])) for t in range(3000)]
    table = {7000: rows, **random_conversations(9, 40, 5)}
    got = {r["conv_id"]: r for r in conv.digests(frame(spark, table), block_rows=64).collect()}
    edits, cost, fold = conv.solve(rows)
    digest = conv.Digest()
    for edit in edits:
        digest.add(edit)
    assert (got[7000]["cost"], got[7000]["audit"], got[7000]["repaired_sha256"]) == (cost, *digest.end())
    assert (got[7000]["illegal"], got[7000]["duplicate"]) == (fold.illegal, fold.counts["duplicate"])


@pytest.mark.parametrize("block", [4096, 2])
def test_edits_rebuild_the_repaired_text(spark, block):
    table = random_conversations(21, 80, 6)
    rows = conv.edits(frame(spark, table), block_rows=block).collect()
    by_conv = {}
    for r in sorted(rows, key=lambda r: (r["part"], r["block"], r["step"])):
        by_conv.setdefault(r["conv_id"], []).append(r)
    assert by_conv.keys() == table.keys()
    for i, some in by_conv.items():
        text = "\n".join(f"{r['role']}:{r['text']}" for r in some if r["edit"] != "D")
        assert ("".join(r["edit"] for r in some), hashlib.sha256(text.encode()).hexdigest()) == expected(i, table[i])[-2:]


def test_survivors_give_out_what_all_agree_on():
    """Memory follows the stretch on which paths differ, not the conversation."""
    paths = conv.Survivors()
    for turn in range(10_000):
        paths.step(conv.STEPS["ua"[turn % 2], ""])
        assert len(paths.rest(next(iter(paths.alive.values()))[1])) <= 8
    assert len(paths.given) >= 9_990


def test_damage(spark):
    import zlib

    rows = [(i, t, "assistant", "One. Two! Three? four") for i in range(30) for t in (0, 1, None)] + [(None, 1, None, None)]
    got = {}
    for r in conv.damage(spark.createDataFrame(rows, SCHEMA)).collect():
        got.setdefault((r["conv_id"], r["turn"]), []).append((r["role"], r["text"]))
    for i, t, role, text in rows:
        kind = zlib.crc32(f"{' ' if i is None else i}:{' ' if t is None else t}".encode()) % 20
        row = ("user" if kind == 4 else role or " ", "" if kind == 1 else "One Two Three four" if kind == 2 and text else text or " ")
        assert got.get((i, t), []) == [row] * {0: 0, 3: 2}.get(kind, 1)


def test_nothing_clashing_names_and_conversations_without_rows(spark):
    assert conv.repaired_digests(spark.createDataFrame([], SCHEMA)).count() == 0
    assert conv.edits(spark.createDataFrame([], SCHEMA)).count() == 0
    clash = spark.createDataFrame([(1, 0, "user", "Hi.", 5, "x", "y")], SCHEMA + ", task int, audit string, TEXT string")
    assert found(conv.digests(clash)) == [expected(1, [(0, "user", "Hi.")])]
    # A row that the damage drops, alone in its conversation.
    import zlib

    gone = next(i for i in range(1000) if zlib.crc32(f"{i}:0".encode()) % 20 == 0)
    only = found(conv.repaired_digests(spark.createDataFrame([(gone, 0, "user", "Hi.")], SCHEMA)))
    assert only == [(gone, 0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())]


def test_long_texts(spark):
    long = "word " * 1_200_000 + "end."
    table = {1: [(0, "user", long), (1, "assistant", long), (2, "user", long[:-1])], 2: [(0, "user", "a.")]}
    assert found(conv.digests(frame(spark, table))) == sorted((expected(i, r) for i, r in table.items()), key=repr)
