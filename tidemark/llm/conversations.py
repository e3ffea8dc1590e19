"""Conversation repair: the cheapest edits that make a conversation's roles ``(s?(ua)+)?`` by initials.

Rows of a conversation are read by turn (NULL first), then role, then text. Each may have a fault, the first of:
blank (no character but white space), duplicate (role and text stood earlier), truncated (its last character that is no
white space is none of ``.!?``). Edits: Keep 0, Rerole to user or assistant 3, Delete 4 (a must for blank and duplicate
rows), Insert of an empty user or assistant row anywhere 3; a truncated row that stays adds 3. Of the cheapest
edits, those whose initials in order are least in ASCII are taken.

The edits are found by the Viterbi algorithm over four states (nothing yet, behind s, behind u, behind a). The best path
into each state is a leaf of a tree of back pointers whose nodes count their children: a node without leaves behind it is
freed, and as long as the root has one child only, all survivors agree there and the child's edits are given out.
A path that costs more than another one would, whatever follows, is no survivor. Where two paths reach a state at the same cost, their tokens since the last shared node are compared, all of them.
A row's token is its inserts and its own edit (``D``, ``IK``, ...). No token begins another one, so the
first token that differs decides the order of the whole strings, also of those not yet finished.

Conversations of any length: rows are range-partitioned by conversation and turn, so a long one lies in several
tasks. A conversation that begins and ends inside a task and is not longer than a block is solved there. The others
(two a task, and long ones) are cut into blocks. A block is solved from each of the four states it can begin in, by the
same algorithm; what it costs between each two states, and the order of its edits, is a row of a few numbers.
The best way through those rows, by the same algorithm again, gives each block the states it begins and ends in.

Defined cases: a NULL role or text is one space; a NULL conversation is one like any other; rows of one turn go by role and
text; a row that is repeated with the same turn counts as later; texts of any length; extra columns are
ignored; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
import re

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from tidemark.llm.common import materialize, only, partitions, prepare

WHITE = "\x20\t\n\x0b\x0c\r"
# States, and the role that an insert gives from each.
NOTHING, SYSTEM, USER, ASSISTANT = range(4)
INSERTED = {NOTHING: "user", SYSTEM: "user", USER: "assistant", ASSISTANT: "user"}
REACHED = {"user": USER, "assistant": ASSISTANT}
REROLE, DELETE, INSERT, CUT_OFF = 3, 4, 3, 3
OK, BLANK, DUPLICATE, TRUNCATED = "", "blank", "duplicate", "truncated"
# What it costs more, at most, to go on from the first state as one would from the second: insert the other role, delete a
# system row that only an empty beginning allows, or complete a lone system row at the end.
INSTEAD = {
    (ASSISTANT, NOTHING): 4, (SYSTEM, NOTHING): 6, (USER, NOTHING): 7, (NOTHING, SYSTEM): 0, (ASSISTANT, SYSTEM): 0,
    (USER, SYSTEM): 3, (NOTHING, USER): 3, (SYSTEM, USER): 3, (ASSISTANT, USER): 3, (NOTHING, ASSISTANT): 0,
    (SYSTEM, ASSISTANT): 6, (USER, ASSISTANT): 3,
}
# Rows and characters of a block; a longer conversation is solved in blocks.
BLOCK_ROWS, BLOCK_CHARS = 4_096, 4 << 20
# Characters of a text that range-partitioning compares.
SORT_CHARS = 64


def steps(initial: str, fault: str) -> list[tuple[int, int, int, str]]:
    """``(from, to, cost, token)``: the best token of a row between each two states."""
    best = {}
    for state in range(4):
        here, spent, token = state, 0, ""
        for _ in range(3):
            moves = [(here, DELETE, "D")]
            if fault not in (BLANK, DUPLICATE):
                extra = CUT_OFF if fault == TRUNCATED else 0
                moves.append((REACHED[INSERTED[here]], REROLE + extra, "R"))
                if initial == "s" and here == NOTHING:
                    moves.append((SYSTEM, extra, "K"))
                if initial == INSERTED[here][0]:
                    moves.append((REACHED[INSERTED[here]], extra, "K"))
            for to, cost, edit in moves:
                found = (spent + cost, token + edit)
                if (state, to) not in best or found < best[state, to]:
                    best[state, to] = found
            here, spent, token = REACHED[INSERTED[here]], spent + INSERT, token + "I"
    return [(a, b, cost, token) for (a, b), (cost, token) in best.items()]


STEPS = {(i, f): steps(i, f) for i in ("s", "u", "a", "") for f in (OK, BLANK, DUPLICATE, TRUNCATED)}


class Node:
    __slots__ = ("parent", "token", "children")

    def __init__(self, parent, token):
        self.parent, self.token, self.children = parent, token, 0


class Survivors:
    """The best path into each state, as leaves of a tree; ``given`` collects tokens on which all agree.

    ``order`` gives what two tokens of the same step are compared by.
    """

    def __init__(self, entry: int = NOTHING, order=lambda token: token):
        self.root = Node(None, None)
        self.alive = {entry: (0, self.root)}
        self.order, self.given = order, []

    def before(self, node: Node, token, other: Node, token2) -> bool:
        """Whether the path through ``node`` and ``token`` is less than the other one of the same length."""
        order = self.order
        less = 0 if token is token2 else order_of(order(token), order(token2))
        while node is not other:
            less = order_of(order(node.token), order(other.token)) or less
            node, other = node.parent, other.parent
        return less < 0

    def step(self, moves) -> None:
        """``moves``: ``(from, to, cost, token)``."""
        best = {}
        for a, b, cost, token in moves:
            if a in self.alive:
                spent, node = self.alive[a]
                now = best.get(b)
                if now is None or spent + cost < now[0] or (
                        spent + cost == now[0] and self.before(node, token, now[1], now[2])):
                    best[b] = (spent + cost, node, token)
        old, self.alive = self.alive, {}
        for state, (cost, node, token) in best.items():
            # A path that another one beats whatever follows would keep the survivors from coalescing.
            if any(best[a][0] + more < cost for (a, b), more in INSTEAD.items() if b == state and a in best):
                continue
            node.children += 1
            self.alive[state] = (cost, Node(node, token))
        for _, node in old.values():
            # Leaves that no path goes on from are freed, and the nodes that only they hung on.
            while node.children == 0 and node is not self.root:
                node = node.parent
                node.children -= 1
        if self.root.children == 1:
            # All survivors share what is in front of the first fork.
            for node in self._path(next(iter(self.alive.values()))[1]):
                self.given.append(node.token)
                node.parent, self.root = None, node
                if node.children != 1:
                    break

    def _path(self, node: Node) -> list[Node]:
        """Nodes behind the root, down to ``node``."""
        out = []
        while node is not self.root:
            out.append(node)
            node = node.parent
        return out[::-1]

    def rest(self, node: Node) -> list:
        """Tokens behind the root, down to ``node``, that are not given out."""
        return [n.token for n in self._path(node)]

    def end(self) -> tuple[int, int, list, str]:
        """``cost, state, tokens, inserts`` of the best path of a whole conversation."""
        best = None
        for state, inserts in ((NOTHING, ""), (ASSISTANT, ""), (USER, "I"), (SYSTEM, "II")):
            if state in self.alive:
                cost, node = self.alive[state]
                cost += INSERT * len(inserts)
                if best is None or cost < best[0] or (cost == best[0] and self.before(node, None, best[1], None)):
                    best = (cost, node, state, inserts)
        cost, node, state, inserts = best
        return cost, state, self.given + self.rest(node), inserts


def order_of(x, y) -> int:
    return (x > y) - (x < y)


class Fold:
    """Faults and figures of rows in order. ``seen`` holds digests of roles and texts, or is None where the rows say
    themselves whether they stood earlier."""

    def __init__(self, whole: bool = True):
        self.seen = set() if whole else None
        self.counts = {BLANK: 0, DUPLICATE: 0, TRUNCATED: 0}
        self.illegal, self.first, self.last, self.row = 0, None, None, None
        self.low, self.high, self.turns = None, None, 0

    def add(self, turn, role: str, text: str, earlier: bool = False) -> tuple[str, str]:
        """``initial, fault`` of the next row."""
        initial = role[:1]
        if self.last is None:
            self.first = initial
        elif self.last + initial not in ("su", "ua", "au"):
            self.illegal += 1
        self.last = initial
        if turn is not None and turn != self.high:
            self.low = turn if self.low is None else self.low
            self.high, self.turns = turn, self.turns + 1
        ink = text.rstrip(WHITE)
        if self.seen is not None:
            name = hashlib.blake2b(f"{len(role)}:{role}{text}".encode("utf-8", "surrogatepass"), digest_size=16).digest()
            earlier = name in self.seen
            self.seen.add(name)
        fault = BLANK if not ink else DUPLICATE if earlier else TRUNCATED if ink[-1] not in ".!?" else OK
        if fault:
            self.counts[fault] += 1
        return initial if initial in ("s", "u", "a") else "", fault


def edited(tokens, rows, state: int = NOTHING):
    """``edit, turn, role, text, fault`` for each edit of ``rows`` (``turn, role, text, fault``); inserted rows have no turn."""
    for token, (turn, role, text, fault) in zip(tokens, rows):
        for edit in token:
            if edit == "I":
                yield "I", None, INSERTED[state], "", OK
                state = REACHED[INSERTED[state]]
            elif edit == "D":
                yield "D", turn, role, text, fault
            elif edit == "R":
                yield "R", turn, INSERTED[state], text, fault
                state = REACHED[INSERTED[state]]
            else:
                yield "K", turn, role, text, fault
                state = SYSTEM if role[:1] == "s" else USER if role[:1] == "u" else ASSISTANT


def trailing(state: int, inserts: str):
    for _ in inserts:
        yield "I", None, INSERTED[state], "", OK
        state = REACHED[INSERTED[state]]


def solve(rows: list[tuple]) -> tuple[list[tuple], int, Fold]:
    """Edits, cost and figures of a whole conversation's rows (``turn, role, text``)."""
    fold, paths, marked = Fold(), Survivors(), []
    for turn, role, text in rows:
        initial, fault = fold.add(turn, role, text)
        marked.append((turn, role, text, fault))
        paths.step(STEPS[initial, fault])
    cost, state, tokens, inserts = paths.end()
    return [*edited(tokens, marked), *trailing(state, inserts)], cost, fold


# Spark side. Rows travel as (conv_id, turn, role, text).

EDIT = "edit string, turn long, role string, text string, fault string"
FIGURES = "gaps long, blank long, duplicate long, truncated long, illegal long, cost long"


def ordered(conversations: DataFrame) -> DataFrame:
    """Rows in order, in tasks of about equal size whatever the conversations' lengths are."""
    spark = prepare(conversations.sparkSession)
    space = F.lit(" ")
    rows = only(conversations, "conv_id", "turn", "role", "text").select(
        "conv_id", F.col("turn").cast("long"), F.coalesce("role", space).alias("role"), F.coalesce("text", space).alias("text"))
    return (rows.repartitionByRange(partitions(spark), "conv_id", "turn", "role", F.substring("text", 1, SORT_CHARS))
            .sortWithinPartitions("conv_id", "turn", "role", "text"))


def _runs(batches, names=("conv_id",)):
    """``key, row`` of sorted rows: all columns, in order."""
    for batch in batches:
        columns = batch.to_pydict()
        yield from zip(zip(*[columns[n] for n in names]), zip(*columns.values()))


def _first_pass(batches, block_rows: int, block_chars: int, closed):
    """``closed(conv_id, rows)`` for conversations that lie inside the task; rows of the others as they are."""
    task, key, rows, chars, is_open, at, started = TaskContext.get().partitionId(), None, [], 0, True, 0, False

    def opened(held):
        nonlocal at
        for turn, role, text in held:
            yield "open", key[0], (task, at, turn, role, text)
            at += 1

    for row_key, (_, turn, role, text) in _runs(batches):
        if not started or row_key != key:
            if started:
                if is_open:
                    yield from opened(rows)
                else:
                    yield "closed", key[0], closed(rows)
            # The first conversation may have begun in another task.
            key, rows, chars, is_open, started = row_key, [], 0, not started, True
        rows.append((turn, role, text))
        chars += len(text)
        if is_open or len(rows) > block_rows or chars > block_chars:
            yield from opened(rows)
            rows, chars, is_open = [], 0, True
    if started:
        # The last one may go on in another task.
        yield from opened(rows)


OPEN = "task int, at long, turn long, role string, text string"


def _field(conversations: DataFrame) -> T.StructField:
    return T.StructField("conv_id", conversations.schema["conv_id"].dataType)


def _schema(conversations: DataFrame, columns: str) -> T.StructType:
    return T.StructType([_field(conversations), *T.StructType.fromDDL(columns).fields])


def _batches_of(rows, schema: pa.Schema, size: int = 2_000):
    """Record batches of tuples."""
    held, chars = [], 0
    for row in rows:
        held.append(row)
        chars += sum(len(x) for x in row if isinstance(x, str))
        if len(held) >= size or chars > BLOCK_CHARS:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*held), schema.types)], schema=schema)
            held, chars = [], 0
    if held:
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*held), schema.types)], schema=schema)


def _arrow(schema: T.StructType) -> pa.Schema:
    return to_arrow_schema(schema)


def _with_earlier(rows: DataFrame) -> DataFrame:
    """Open rows with ``earlier``: whether role and text stood before in the conversation."""
    name = F.md5(F.concat(F.char_length("role").cast("string"), F.lit(":"), "role", "text"))
    named = rows.withColumn("name", name)
    here = F.struct("task", "at")
    repeated = named.groupBy("conv_id", "name").agg(F.min(here).alias("first"), F.count(F.lit(1)).alias("n")).filter("n > 1")
    side = repeated.select(F.col("conv_id").alias("of"), F.col("name").alias("named"), "first")
    match = F.col("conv_id").eqNullSafe(F.col("of")) & (F.col("name") == F.col("named"))
    return named.join(side, match, "left").select(
        *rows.columns, F.coalesce(here > F.col("first"), F.lit(False)).alias("earlier"))


BLOCKS = ("task int, block long, costs array<int>, ranks array<int>, audits array<string>, first string, last string, "
          "low long, high long, turns long, blank long, duplicate long, truncated long, illegal long")
CHOSEN = "task int, block long, entry int, leave int, inserts string, done boolean, " + FIGURES


def _solve_block(rows: list[tuple]) -> tuple:
    """What a block costs between each two states, the edits, and their order among the block's edits."""
    fold = Fold(whole=False)
    marks = [fold.add(turn, role, text, earlier) for turn, role, text, earlier in rows]
    costs, audits = [None] * 16, [None] * 16
    for entry in range(4):
        paths = Survivors(entry)
        for mark in marks:
            paths.step(STEPS[mark])
        for state, (cost, node) in paths.alive.items():
            costs[4 * entry + state] = cost
            # Tokens apart, so that a row's edits can be found again.
            audits[4 * entry + state] = "".join(paths.given + paths.rest(node))
    places = {a: i for i, a in enumerate(sorted({a for a in audits if a is not None}))}
    ranks = [places.get(a) for a in audits]
    c = fold.counts
    return (costs, ranks, audits, fold.first, fold.last, fold.low, fold.high, fold.turns,
            c[BLANK], c[DUPLICATE], c[TRUNCATED], fold.illegal)


def _through(batches):
    """The best way through a conversation's blocks, from rows of numbers sorted by conversation and block."""
    def chosen():
        paths = Survivors(order=lambda move: move[0])
        last = high = None
        illegal, gaps_turns, low, sums = 0, 0, None, [0, 0, 0]
        for _, _, _, costs, ranks, first, end, b_low, b_high, turns, blank, duplicate, truncated, inside in blocks:
            paths.step([(i // 4, i % 4, c, (r, i // 4, i % 4)) for i, (c, r) in enumerate(zip(costs, ranks)) if c is not None])
            illegal += inside + (last is not None and last + first not in ("su", "ua", "au"))
            last = end
            if b_low is not None:
                gaps_turns += turns - (b_low == high)
                low, high = b_low if low is None else low, b_high
            sums = [x + y for x, y in zip(sums, (blank, duplicate, truncated))]
        cost, _, moves, inserts = paths.end()
        gaps = 0 if low is None else high - low + 1 - gaps_turns
        for n, (block, (_, entry, leave)) in enumerate(zip(blocks, moves), 1):
            done = n == len(blocks)
            yield (*block[:3], entry, leave, inserts if done else "", done, gaps, *sums, illegal, cost)

    key, blocks = None, []
    for row_key, row in _runs(batches):
        if blocks and row_key != key:
            yield from chosen()
            blocks = []
        key = row_key
        blocks.append(row)
    if blocks:
        yield from chosen()


def _tokens(audit: str) -> list[str]:
    return re.findall("I*[KRD]", audit)


def _solve_open(rows: DataFrame, block_rows: int) -> DataFrame:
    """Blocks of the stored open rows with the states they begin and end in, their edits, and the conversation's figures."""
    spark = rows.sparkSession
    n = partitions(spark)
    placed = _with_earlier(rows).withColumn("block", F.floor(F.col("at") / block_rows).cast("long"))
    dealt = placed.repartition(n, "conv_id", "task", "block").sortWithinPartitions("conv_id", "task", "block", "at").select(
        "conv_id", "task", "block", "turn", "role", "text", "earlier")
    schema = _schema(rows, BLOCKS)
    arrow = _arrow(schema)

    def summaries(batches):
        def solved():
            key, held = None, []
            for row_key, row in _runs(batches, ("conv_id", "task", "block")):
                if held and row_key != key:
                    yield (*key, *_solve_block(held))
                    held = []
                key = row_key
                held.append(row[3:])
            if held:
                yield (*key, *_solve_block(held))

        return _batches_of(solved(), arrow, 64)

    blocks = materialize(dealt.mapInArrow(summaries, schema), "conversation-blocks")
    numbers = blocks.drop("audits").repartition(n, "conv_id").sortWithinPartitions("conv_id", "task", "block")
    chosen_schema = _schema(rows, CHOSEN)
    chosen_arrow = _arrow(chosen_schema)
    chosen = materialize(numbers.mapInArrow(lambda it: _batches_of(_through(it), chosen_arrow), chosen_schema), "conversation-ways")
    side = blocks.select(F.col("conv_id").alias("of"), F.col("task").alias("t"), F.col("block").alias("b"), "audits")
    match = F.col("conv_id").eqNullSafe(F.col("of")) & (F.col("task") == F.col("t")) & (F.col("block") == F.col("b"))
    return chosen.join(side, match).withColumn("audit", F.get("audits", 4 * F.col("entry") + F.col("leave"))).drop(
        "audits", "of", "t", "b")


def _open_edits(rows: DataFrame, ways: DataFrame, block_rows: int, whole: bool, make, schema: T.StructType) -> DataFrame:
    """``make(rows, ways)`` for each block, or each conversation in order (``whole``), from its sorted rows.

    A block's way stands before its rows.
    """
    keys = ("conv_id",) if whole else ("conv_id", "task", "block")
    place = F.floor(F.col("at") / block_rows).cast("long").alias("block")
    way_columns = [f.name for f in ways.schema.fields if f.name not in ("conv_id", "task", "block")]
    both = _with_earlier(rows).select("conv_id", "task", place, "at", "turn", "role", "text", "earlier").unionByName(
        ways.withColumn("at", F.lit(-1).cast("long")), allowMissingColumns=True)
    dealt = both.repartition(partitions(rows.sparkSession), *keys).sortWithinPartitions("conv_id", "task", "block", "at").select(
        "conv_id", "task", "block", "at", "turn", "role", "text", "earlier", *way_columns)
    arrow = _arrow(schema)

    def run(batches):
        return _batches_of(make(_placed(_runs(batches, ("conv_id",)), way_columns)), arrow)

    return dealt.mapInArrow(run, schema)


def _placed(stream, way_columns):
    """``conv_id, task, block, way or None, row or None`` in order."""
    for _, (conv_id, task, block, at, turn, role, text, earlier, *way) in stream:
        if at < 0:
            yield conv_id, task, block, dict(zip(way_columns, way)), None
        else:
            yield conv_id, task, block, None, (turn, role, text, earlier)


def _edits_of(placed):
    """``conv_id, task, block, way, edit row`` for each edit; ``way`` is that of the block."""
    fold = way = tokens = None
    state = NOTHING
    for conv_id, task, block, new, row in placed:
        if new is not None:
            way, fold, state = new, Fold(whole=False), new["entry"]
            tokens = iter(_tokens(way["audit"]))
            left = len(_tokens(way["audit"]))
            continue
        turn, role, text, earlier = row
        _, fault = fold.add(turn, role, text, earlier)
        for edit in edited([next(tokens)], [(turn, role, text, fault)], state):
            yield conv_id, task, block, way, edit
            if edit[0] != "D":
                state = SYSTEM if edit[2][:1] == "s" else USER if edit[2][:1] == "u" else ASSISTANT
        left -= 1
        if not left:
            for edit in trailing(state, way["inserts"]):
                yield conv_id, task, block, way, edit


def edits(conversations: DataFrame, block_rows: int = BLOCK_ROWS, block_chars: int = BLOCK_CHARS) -> DataFrame:
    """``conv_id, part, block, step, edit, turn, role, text, fault``: one row for each edit.

    The repaired conversation is its rows but those of edit ``D``, by part, block and step.
    """
    rows = ordered(conversations)
    schema = _schema(conversations, f"part int, block long, step long, {EDIT}, at long")
    arrow = _arrow(schema)

    def first(batches):
        def out():
            done = 0
            for kind, conv_id, found in _first_pass(batches, block_rows, block_chars, lambda held: solve(held)[0]):
                if kind == "open":
                    task, at, turn, role, text = found
                    yield (conv_id, task, None, None, None, turn, role, text, None, at)
                else:
                    for edit in found:
                        done += 1
                        yield (conv_id, 0, 0, done, *edit, None)

        return _batches_of(out(), arrow)

    passed = materialize(rows.mapInArrow(first, schema), "conversations")
    rest = passed.filter("edit IS NULL").select("conv_id", F.col("part").alias("task"), "at", "turn", "role", "text")
    ways = _solve_open(rest, block_rows)
    out_schema = _schema(conversations, f"part int, block long, step long, {EDIT}")

    def of_blocks(placed):
        key, step = None, 0
        for conv_id, task, block, _, edit in _edits_of(placed):
            step = step + 1 if key == (conv_id, task, block) else 1
            key = (conv_id, task, block)
            yield (conv_id, task, block, step, *edit)

    others = _open_edits(rest, ways, block_rows, False, of_blocks, out_schema)
    return passed.filter("edit IS NOT NULL").drop("at").unionByName(others)


def digests(conversations: DataFrame, block_rows: int = BLOCK_ROWS, block_chars: int = BLOCK_CHARS) -> DataFrame:
    """One row a conversation: the figures, ``audit`` (initials of its edits) and ``repaired_sha256``.

    The digest of a conversation's whole repaired text has to be taken in order: only that last step reads a long
    conversation in one task, as a stream.
    """
    rows = ordered(conversations)
    final = f"{FIGURES}, audit string, repaired_sha256 string"
    schema = _schema(conversations, f"task int, at long, turn long, role string, text string, {final}")
    arrow = _arrow(schema)

    def solved(held):
        found, cost, fold = solve(held)
        digest = Digest()
        for edit in found:
            digest.add(edit)
        gaps = 0 if fold.low is None else fold.high - fold.low + 1 - fold.turns
        return (gaps, *fold.counts.values(), fold.illegal, cost, *digest.end())

    def first(batches):
        def out():
            for kind, conv_id, found in _first_pass(batches, block_rows, block_chars, solved):
                yield (conv_id, *found, *[None] * 8) if kind == "open" else (conv_id, *[None] * 5, *found)

        return _batches_of(out(), arrow)

    passed = materialize(rows.mapInArrow(first, schema), "conversations")
    rest = passed.filter("task IS NOT NULL").select("conv_id", "task", "at", "turn", "role", "text")
    ways = _solve_open(rest, block_rows)
    out_schema = _schema(conversations, final)
    names = [f.name for f in T.StructType.fromDDL(FIGURES).fields]

    def of_conversations(placed):
        key = digest = way = None
        for conv_id, _, _, way_now, edit in _edits_of(placed):
            if digest is not None and key != conv_id:
                yield (key, *[way[n] for n in names], *digest.end())
                digest = None
            if digest is None:
                key, digest = conv_id, Digest()
            way = way_now
            digest.add(edit)
        if digest is not None:
            yield (key, *[way[n] for n in names], *digest.end())

    others = _open_edits(rest, ways, block_rows, True, of_conversations, out_schema)
    return passed.filter("task IS NULL").select("conv_id", *names, "audit", "repaired_sha256").unionByName(others)


class Digest:
    """Initials of edits, and the SHA-256 of ``role:text`` lines of what stays."""

    def __init__(self):
        self.sha, self.initials, self.any = hashlib.sha256(), [], False

    def add(self, edit: tuple) -> None:
        self.initials.append(edit[0])
        if edit[0] != "D":
            line = f"{edit[2]}:{edit[3]}".encode("utf-8", "surrogatepass")
            self.sha.update(b"\n" + line if self.any else line)
            self.any = True

    def end(self) -> tuple[str, str]:
        return "".join(self.initials), self.sha.hexdigest()


def damage(conversations: DataFrame) -> DataFrame:
    """The rows as the damage rule leaves them: crc32 of ``conv_id:turn`` modulo 20 drops a row (0), empties its text (1),
    takes its ``.!?`` (2), repeats it (3) or makes its role user (4). NULLs are one space."""
    space = F.lit(" ")

    def text_of(name: str) -> Column:
        return F.coalesce(F.col(name).cast("string"), space)

    kind = F.crc32(F.concat(text_of("conv_id"), F.lit(":"), text_of("turn")).cast("binary")) % 20
    text = F.coalesce("text", space)
    rows = only(conversations, "conv_id", "turn", "role", "text").withColumn("kind", kind).filter("kind <> 0")
    return rows.select(
        "conv_id", "turn", F.when(F.col("kind") == 4, "user").otherwise(F.coalesce("role", space)).alias("role"),
        F.when(F.col("kind") == 1, "").when(F.col("kind") == 2, F.translate(text, ".!?", "")).otherwise(text).alias("text"),
        F.explode(F.when(F.col("kind") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))).alias("copy"),
    ).drop("copy")


def repaired_digests(conversations: DataFrame) -> DataFrame:
    """The damaged conversations' figures, edits and digests, for every conversation there was before the damage."""
    found = digests(damage(conversations))
    figures = [f.name for f in T.StructType.fromDDL(FIGURES).fields]
    ids = only(conversations, "conv_id").distinct()
    side = found.withColumnRenamed("conv_id", "of")
    return ids.join(side, F.col("conv_id").eqNullSafe(F.col("of")), "left").select(
        "conv_id", *[F.coalesce(n, F.lit(0).cast("long")).alias(n) for n in figures], F.coalesce("audit", F.lit("")).alias("audit"),
        F.coalesce("repaired_sha256", F.lit(hashlib.sha256(b"").hexdigest())).alias("repaired_sha256"))
