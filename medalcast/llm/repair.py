"""Conversation structure repair by iterative-deepening A*.

A conversation is its rows in order of turn (nulls first), then role and text.
Its first faults are counted (blank, duplicate, truncated), and the cheapest
edits are found that give the roles' initials the form ``(s?(ua)+)?``: keep,
rerole to user or assistant, delete, insert an empty user or assistant turn.
Blank and duplicate rows must go.

The search is depth first in ASCII order of the edits' initials (D, I, K, R)
under a cost bound that grows by one. States (row, last role) that failed stay
in a transposition table with the largest budget they failed under; the first
path that is accepted is the cheapest, and of these the ASCII-least. The
estimate of what is left is three for each row that must go, one for each
truncated row, and two for every two neighbouring illegal role pairs among the
rest (an edit touches two pairs at most), so it never exceeds the true cost.

Equal rows of a turn are first summed into one with a count. Rows are then dealt
by ranges of (conversation, turn, role, text's beginning), so a conversation of
any size is spread over tasks. A conversation that lies inside one task and has
up to ``LONG`` rows is searched whole. Any other is cut into blocks of ``BLOCK``
rows; each block is searched for every role before and behind it, and the blocks
are chained by their costs. No insertion stands at the end of a block but the
last, so all texts of a block's edits consume the same rows, none is a prefix of
another, and taking the least block by block gives the least whole. Its digest
is a running hash, so one task streams the rows of one conversation.

Cases: null roles and texts are one space; null turns come first and count for
no gap; null conversation ids form one conversation. A role without an initial
(an empty text) can't be kept. Repeated rows are duplicates. Other columns are
ignored. An empty table gives an empty one.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import textvec as tv
from .stage import Scratch

LONG = 512              # rows of a conversation searched whole
LONG_BYTES = 8 << 20    # and bytes of its texts
BLOCK = 128             # rows of a block of a longer one
BLOCK_BYTES = 4 << 20
WHITE = " \t\n\x0b\x0c\r"
START, S, U, A, OTHER = range(5)          # last role so far; OTHER: a row that can't be kept
SYMBOL = {"s": S, "u": U, "a": A}
FOLLOWS = ((S, U), (U,), (A,), (U,), ())  # roles that may follow each
ADDED = (U, U, A, U)                      # the role an insertion or a rerole gives after each
NAME = {U: "user", A: "assistant"}
DONE = 4                                  # the goal of a last block: START or A
NEVER = 1 << 30


# ---- the search ----

def _estimate(forced, cut, sym, goal):
    """Least cost that may be left, as four lists (by last role) over row positions."""
    n = len(sym)
    ok_end = (lambda p: p in (START, A)) if goal == DONE else (lambda p: p == goal)
    real = [i for i in range(n) if not forced[i]]
    m = len(real)
    # pair k stands before the k-th row that may stay; pair m before the end
    bad = [False] * (m + 2)
    for k in range(1, m):
        bad[k] = sym[real[k]] not in FOLLOWS[sym[real[k - 1]]]
    if m:
        bad[m] = not ok_end(sym[real[-1]])
    run, rest = [0] * (m + 2), [0] * (m + 2)
    for k in range(m, 0, -1):
        run[k] = run[k + 1] + 1 if bad[k] else 0
        rest[k] = 2 * ((run[k] + 1) // 2) + rest[k + run[k]] if bad[k] else rest[k + 1]
    out = [[0] * (n + 1) for _ in range(4)]
    fixed, k = 0, m
    for i in range(n, -1, -1):
        if i < n:
            fixed += 3 * forced[i] + (cut[i] and not forced[i])
            k -= not forced[i]
        for p in range(4):
            legal = sym[real[k]] in FOLLOWS[p] if k < m else ok_end(p)
            out[p][i] = fixed + (rest[k + 1] if legal else 2 * ((run[k + 1] + 2) // 2) + rest[k + 1 + run[k + 1]])
    return out


def search(forced, cut, sym, entry: int = START, goal: int = DONE, tail: bool = True):
    """(cost, edits) of the cheapest, then ASCII-least repair; None if there is none.

    ``forced``: how many rows that must go stand here (0: a row that may stay);
    ``cut``: whether it is truncated; ``sym``: its role; ``tail``: whether
    insertions may stand behind the last row.
    """
    n = len(sym)
    if goal in (START, S):                 # only by deleting all, or all but one system row
        gone = 3 * sum(f or 1 for f in forced)
        letters = ["D" * (f or 1) for f in forced]
        if entry == goal:
            return gone, "".join(letters)
        if entry == START and goal == S:
            ways = []
            for i in range(n):
                if sym[i] == S and not forced[i]:
                    ways.append((gone - 3 + bool(cut[i]), "".join([*letters[:i], "K", *letters[i + 1:]])))
            return min(ways) if ways else None
        return None
    left = _estimate(forced, cut, sym, goal)
    failed: dict[int, int] = {}
    bound, most = left[entry][0], 4 * sum(f or 1 for f in forced) + 8
    while bound <= most:
        path: list[str] = []
        stack = [[0, entry, bound, 0]]
        while stack:
            top = stack[-1]
            i, last, budget, nxt = top
            if nxt == 0 and i == n and (last in (START, A) if goal == DONE else last == goal):
                return bound - budget, "".join(path)
            child = None
            while nxt < 4:
                if nxt == 0:               # delete
                    if i < n:
                        child = i + 1, last, 3 * (forced[i] or 1), "D" * (forced[i] or 1)
                elif nxt == 1:             # insert
                    if i < n or tail:
                        child = i, ADDED[last], 2, "I"
                elif i < n and not forced[i]:
                    if nxt == 2:           # keep
                        if sym[i] in FOLLOWS[last]:
                            child = i + 1, sym[i], int(cut[i]), "K"
                    else:                  # rerole
                        child = i + 1, ADDED[last], 2 + cut[i], "R"
                nxt += 1
                if child is not None:
                    j, then, cost, letter = child
                    rest = budget - cost
                    if rest >= left[then][j] and failed.get(4 * j + then, -1) < rest:
                        break
                    child = None
            top[3] = nxt
            if child is None:
                key = 4 * i + last
                if failed.get(key, -1) < budget:
                    failed[key] = budget
                stack.pop()
                if stack:
                    path.pop()
            else:
                path.append(letter)
                stack.append([j, then, rest, 0])
        bound += 1
    return None


def repaired(edits: str, units: list, entry: int = START):
    """``role:text`` lines of the repaired rows, in order; ``units``: (role, text, symbol, forced, cut)."""
    last, at, skip = entry, 0, 0
    for e in edits:
        if e == "I":
            last = ADDED[last]
            yield f"{NAME[last]}:"
            continue
        role, text, sym, forced, _ = units[at]
        if e == "K":
            last = sym
            yield f"{role}:{text}"
        elif e == "R":
            last = ADDED[last]
            yield f"{NAME[last]}:{text}"
        else:
            skip += 1
            if skip < forced:              # more rows of this unit to go
                continue
        at, skip = at + 1, 0


# ---- rows and their faults ----

def _units(role: str, text: str, copies: int, again: bool):
    """Units of ``copies`` equal rows as (role, text, symbol, forced, cut), and their (blank, duplicate, truncated)."""
    sym = SYMBOL.get(role[:1], OTHER)
    end = text.rstrip(WHITE)
    if not end:
        return [(role, "", sym, copies, 0)], (copies, 0, 0)
    if again:
        return [(role, "", sym, copies, 0)], (0, copies, 0)
    cut = int(end[-1] not in ".!?")
    out = [(role, text, sym, 0, cut)]
    if copies > 1:
        out.append((role, "", sym, copies - 1, 0))
    return out, (0, copies - 1, cut)


class _Stats:
    """Counts over rows in order; blocks of a conversation are added up."""

    def __init__(self):
        self.blank = self.dup = self.cut = self.illegal = self.turns = 0
        self.first_role = self.last_role = None      # initials, '' for an empty role
        self.first_turn = self.last_turn = None

    def row(self, turn, role, copies):
        x = role[:1]
        if self.last_role is not None:
            self.illegal += self.last_role + x not in ("su", "ua", "au")
        else:
            self.first_role = x
        self.illegal += copies - 1                   # a role never follows itself
        self.last_role = x
        if turn is not None and turn != self.last_turn:
            self.turns += 1
            self.first_turn = turn if self.first_turn is None else self.first_turn
            self.last_turn = turn

    def add(self, blank, dup, cut, illegal, turns, first_role, last_role, first_turn, last_turn):
        """A block behind this one."""
        self.blank, self.dup, self.cut = self.blank + blank, self.dup + dup, self.cut + cut
        self.illegal, self.turns = self.illegal + illegal, self.turns + turns
        if first_role is not None:
            if self.last_role is not None:
                self.illegal += self.last_role + first_role not in ("su", "ua", "au")
            self.last_role = last_role
        if first_turn is not None:
            self.turns -= first_turn == self.last_turn
            self.first_turn = first_turn if self.first_turn is None else self.first_turn
            self.last_turn = last_turn

    def gaps(self) -> int:
        return 0 if self.first_turn is None else self.last_turn - self.first_turn + 1 - self.turns


_RESULT = "conv long, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, repaired_sha256 string"
_OPEN = "pos long, gone boolean, turn long, role string, text string, copies long"


def _types(schema: str):
    kinds = {"long": pa.int64(), "string": pa.string(), "boolean": pa.bool_(), "int": pa.int32(), "array<long>": pa.list_(pa.int64()),
             "array<string>": pa.list_(pa.string())}
    fields = [f.strip().split(" ") for f in schema.split(",")]
    return [f[0] for f in fields], [kinds[f[1]] for f in fields]


def _batch(rows: list, schema: str) -> pa.RecordBatch:
    names, kinds = _types(schema)
    cols = zip(*rows, strict=True) if rows else [[] for _ in names]
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds, strict=True)], names=names)


def _whole(conv, rows: list):
    """Result of a whole conversation; rows: (gone, turn, role, text, copies)."""
    stats, seen, units = _Stats(), set(), []
    for gone, turn, role, text, copies in rows:
        if gone:
            continue
        stats.row(turn, role, copies)
        got, (blank, dup, cut) = _units(role, text, copies, (role, text) in seen)
        stats.blank, stats.dup, stats.cut = stats.blank + blank, stats.dup + dup, stats.cut + cut
        seen.add((role, text))
        units += got
    cost, audit = search([u[3] for u in units], [u[4] for u in units], [u[2] for u in units])
    sha = hashlib.sha256("\n".join(repaired(audit, units)).encode("utf-8", "surrogatepass")).hexdigest()
    return conv, stats.gaps(), stats.blank, stats.dup, stats.cut, stats.illegal, cost, audit, sha


def _first_pass(batches):
    """Results of conversations that lie inside the task; rows of the others, with their place."""
    schema = f"{_RESULT}, {_OPEN}"
    none = (None,) * 8
    pos = TaskContext.get().partitionId() << 40
    run, size, weight, key, is_open, out = [], 0, 0, None, True, []

    def opened(rows):
        nonlocal pos
        for r in rows:
            out.append((key, *none, pos, *r))
            pos += 1
    for b in batches:
        cols = [c.to_pylist() for c in b.columns]
        for conv, gone, turn, role, text, copies in zip(*cols, strict=True):
            if (run or size) and conv != key:
                if is_open:
                    opened(run)
                else:
                    out.append((*_whole(key, run), *(None,) * 6))
                run, size, weight, is_open = [], 0, 0, False
            key = conv
            run.append((gone, turn, role, text, copies))
            size += copies
            weight += len(text or "")
            if size > LONG or weight > LONG_BYTES:
                is_open = True
            if is_open and len(run) >= BLOCK:
                opened(run)
                run = []
            if len(out) >= 2000:
                yield _batch(out, schema)
                out = []
    opened(run)                           # the last run may go on in the next task
    if out:
        yield _batch(out, schema)


_BLOCKS = ("conv long, pos long, costs array<long>, ranks array<long>, audits array<string>, roles array<string>, texts array<string>, "
           "syms array<long>, forced array<long>, cuts array<long>, blank long, dup long, cut long, illegal long, turns long, "
           "first_role string, last_role string, first_turn long, last_turn long")


def _block(conv, pos, units, stats):
    """A block with the cost, the order and the text of its edits for each role before it and each goal."""
    forced, cut, sym = [u[3] for u in units], [u[4] for u in units], [u[2] for u in units]
    costs, ranks, audits = [], [], []
    for entry in range(4):
        got = [search(forced, cut, sym, entry, goal, tail=False) if len(sym) or goal == entry else None for goal in range(4)]
        order = {a: r for r, a in enumerate(sorted(g[1] for g in got if g))}
        got.append(search(forced, cut, sym, entry, DONE))
        costs += [g[0] if g else NEVER for g in got]
        ranks += [order.get(g[1], 0) if g else 0 for g in got]
        audits += [g[1] if g else "" for g in got]
    roles, texts = [u[0] for u in units], [u[1] for u in units]
    return (conv, pos, costs, ranks, audits, roles, texts, sym, forced, cut, stats.blank, stats.dup, stats.cut, stats.illegal, stats.turns,
            stats.first_role, stats.last_role, stats.first_turn, stats.last_turn)


def _second_pass(batches):
    """Blocks of the open conversations; a block ends with its task, conversation or size."""
    key, at, units, stats, weight, any_row = None, 0, [], _Stats(), 0, False
    for b in batches:
        out = []
        for conv, pos, gone, turn, role, text, copies, first in zip(*(c.to_pylist() for c in b.columns), strict=True):
            if any_row and (conv != key or len(units) >= BLOCK or weight >= BLOCK_BYTES):
                out.append(_block(key, at, units, stats))
                units, stats, weight, any_row = [], _Stats(), 0, False
            if not any_row:
                key, at, any_row = conv, pos, True
            if gone:
                continue
            stats.row(turn, role, copies)
            got, (blank, dup, cut) = _units(role, text, copies, first is not None and first < pos)
            stats.blank, stats.dup, stats.cut = stats.blank + blank, stats.dup + dup, stats.cut + cut
            units += got
            weight += len(text or "")
        if out:
            yield _batch(out, _BLOCKS)
    if any_row:
        yield _batch([_block(key, at, units, stats)], _BLOCKS)


_CHOICE = "conv long, pos long, way long"


def chain(costs: list, ranks: list) -> list[int]:
    """The way (role before * 5 + goal) through each block: cheapest in all, then the least text block by block."""
    n = len(costs)
    togo = [None] * n
    togo[-1] = [costs[-1][5 * e + DONE] for e in range(4)]
    for k in range(n - 2, -1, -1):
        togo[k] = [min(costs[k][5 * e + x] + togo[k + 1][x] for x in range(4)) for e in range(4)]
    entry, ways = START, []
    for k in range(n):
        if k == n - 1:
            goal = DONE
        else:
            goal = min(range(4), key=lambda x: (costs[k][5 * entry + x] + togo[k + 1][x], ranks[k][5 * entry + x]))
        ways.append(5 * entry + goal)
        entry = goal
    return ways


def _choose(batches):
    """A way through the blocks of each conversation; only costs are held, one byte a row or less."""
    key, held = None, []

    def closed():
        ways = chain([h[1] for h in held], [h[2] for h in held])
        return [(key, h[0], w) for h, w in zip(held, ways, strict=True)]
    for b in batches:
        out = []
        for conv, pos, costs, ranks in zip(*(c.to_pylist() for c in b.columns), strict=True):
            if held and conv != key:
                out += closed()
                held = []
            key = conv
            held.append((pos, np.array(costs, np.int32).tolist(), np.array(ranks, np.int8).tolist()))
        if out:
            yield _batch(out, _CHOICE)
    if held:
        yield _batch(closed(), _CHOICE)


def _last_pass(batches):
    """Results of the blocks of each conversation, in order; its texts go through a running hash."""
    key, state = None, None

    def closed():
        stats, cost, audit, sha, _ = state
        return (key, stats.gaps(), stats.blank, stats.dup, stats.cut, stats.illegal, cost, "".join(audit), sha.hexdigest())
    for b in batches:
        out = []
        for row in b.to_pylist():
            if state is not None and row["conv"] != key:
                out.append(closed())
                state = None
            key = row["conv"]
            if state is None:
                state = [_Stats(), 0, [], hashlib.sha256(), False]
            state[0].add(*(row[c] for c in ("blank", "dup", "cut", "illegal", "turns", "first_role", "last_role", "first_turn", "last_turn")))
            state[1] += row["costs"][row["way"]]
            edits = row["audits"][row["way"]]
            state[2].append(edits)
            units = list(zip(row["roles"], row["texts"], row["syms"], row["forced"], row["cuts"], strict=True))
            for line in repaired(edits, units, row["way"] // 5):
                state[3].update((("\n" if state[4] else "") + line).encode("utf-8", "surrogatepass"))
                state[4] = True
        if out:
            yield _batch(out, _RESULT)
    if state is not None:
        yield _batch([closed()], _RESULT)


# ---- damage and repair ----

def damage(turns: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """(conv, turn, role, text, copies, gone): rows damaged by crc32(``conv:turn``) mod 20.

    0 drops a row (it stays as ``gone``, so that its conversation is known), 1 empties its text,
    2 takes its ``.!?`` out, 3 repeats it, 4 makes its role user.
    """
    def text(c):
        return F.coalesce(F.col(f"`{c}`").cast("string"), F.lit(" "))
    kind = F.crc32(F.concat(text(conv_col), F.lit(":"), text(turn_col)).cast("binary")) % 20
    src = turns.select(F.col(f"`{conv_col}`").cast("long").alias("conv"), F.col(f"`{turn_col}`").cast("long").alias("turn"),
                       text(role_col).alias("role"), text(text_col).alias("text"), kind.alias("kind"))
    k = F.col("kind")
    return src.select("conv", F.when(k != 0, F.col("turn")).alias("turn"),
                      F.when(k == 0, F.lit(None)).when(k == 4, F.lit("user")).otherwise(F.col("role")).alias("role"),
                      F.when(k == 0, F.lit(None)).when(k == 1, F.lit("")).when(k == 2, F.translate("text", ".!?", "")).otherwise(F.col("text")).alias("text"),
                      F.when(k == 3, 2).otherwise(1).cast("long").alias("copies"), (k == 0).alias("gone"))


def intact(turns: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """The rows of ``damage`` without any damage, for conversations that are to be repaired as they are."""
    def text(c):
        return F.coalesce(F.col(f"`{c}`").cast("string"), F.lit(" "))
    return turns.select(F.col(f"`{conv_col}`").cast("long").alias("conv"), F.col(f"`{turn_col}`").cast("long").alias("turn"),
                        text(role_col).alias("role"), text(text_col).alias("text"), F.lit(1).cast("long").alias("copies"), F.lit(False).alias("gone"))


def repair(rows: DataFrame) -> DataFrame:
    """One row per conversation of (conv, turn, role, text, copies, gone) rows.

    (conv, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256).
    """
    scratch = Scratch(rows.sparkSession, "repair")
    src = rows.groupBy("conv", "turn", "role", "text", "gone").agg(F.sum("copies").alias("copies"))
    src = (src.repartitionByRange("conv", "turn", "role", F.substring("text", 1, 64)).sortWithinPartitions("conv", "turn", "role", "text")
           .select("conv", "gone", "turn", "role", "text", "copies"))
    first = scratch.write(src.mapInArrow(tv.lean(_first_pass), f"{_RESULT}, {_OPEN}"), "first")
    names = _types(_RESULT)[0]
    whole = first.filter("audit is not null").select(*names)
    # the others: rows that equal an earlier one, by digest
    rest = first.filter("audit is null").select("conv", *_types(_OPEN)[0], F.sha2("text", 256).alias("sha"))
    same = [F.coalesce("conv", F.lit(0)).alias("c"), F.col("conv").isNull().alias("no_c"), "role", "sha"]
    firsts = scratch.write(rest.filter("not gone").groupBy(*same).agg(F.min("pos").alias("first"), F.count(F.lit(1)).alias("n"))
                           .filter("n > 1").drop("n"), "firsts")
    marked = (rest.withColumns({"c": F.coalesce("conv", F.lit(0)), "no_c": F.col("conv").isNull()}).join(firsts, ["c", "no_c", "role", "sha"], "left")
              .repartitionByRange("conv", "pos").sortWithinPartitions("conv", "pos")
              .select("conv", "pos", "gone", "turn", "role", "text", "copies", "first"))
    blocks = scratch.write(marked.mapInArrow(tv.lean(_second_pass), _BLOCKS), "blocks")
    ways = (blocks.select("conv", "pos", "costs", "ranks").repartition("conv").sortWithinPartitions("conv", "pos")
            .mapInArrow(_choose, _CHOICE).select("pos", "way"))
    # a place is a place of one row, so it alone is the key
    chosen = (blocks.drop("ranks").join(ways, "pos").repartition("conv").sortWithinPartitions("conv", "pos")
              .mapInArrow(tv.lean(_last_pass), _RESULT))
    return whole.unionByName(chosen)
