"""Conversation repair: the cheapest edits after which roles alternate, by depth-first branch and bound.

A conversation is cut into units of 2^``SPAN`` turns and these into pieces of ``PIECE`` rows.  A piece is a row of symbols, one a
message (its role's initial and its fault), and the roles before and after it are one of four states.  For every pair
of states a search with an explicit stack takes the edits one by one.  It gives up a branch if its
cost and the lower bound of the rows that are left exceed the incumbent (cost, audit), or tie with it and the audit
is already greater; or if the table of its node (row, state) has a better prefix.  It ends when the stack is empty, which proves the
incumbent.  Pieces with the same symbols are searched once a task.

The best edits of adjoining pieces are joined over the state between them, so a conversation of any length is searched
in many tasks.  Only the units' costs and the order of their audits (sixteen small numbers each) meet in one place, where the states
between units are chosen.  The digest of the repaired text reads a conversation's rows in order, as a digest must, but holds none of them.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from plyframe.llm.shared import prepare, written

SPAN = 6  # a unit has 64 turns
PIECE = 16  # rows of a piece
KEEP, REROLE, DELETE, INSERT = 0, 2, 3, 2  # costs
TRUNCATED = 1  # cost of a truncated row that stays
# States: nothing yet, after the system's message, after the user's, after the assistant's.
NEXT = ({"s": 1, "u": 2}, {"u": 2}, {"a": 3}, {"u": 2})
SPOKEN = (("u", 2), ("u", 2), ("a", 3), ("u", 2))  # whom an edit may let speak next
FINAL = (0, 3)
SPACE = "\t\n\x0b\x0c\r "
Best = tuple[tuple[tuple[int, str] | None, ...], ...]  # [state before][state after] -> (cost, audit)


INFINITE = 1 << 60


def _choices(symbol: str, state: int) -> list[tuple[int, str, int, bool]]:
    """(cost, edit, state after, the row is done) of a message."""
    role, fault = symbol
    out = [(INSERT, "I", SPOKEN[state][1], False), (DELETE, "D", state, True)]
    if fault not in "bd":
        more = TRUNCATED if fault == "t" else 0
        out.append((REROLE + more, "R", SPOKEN[state][1], True))
        if role in NEXT[state]:
            out.append((KEEP + more, "K", NEXT[state][role], True))
    return out


def suffix_bounds(symbols: tuple[str, ...], after: int) -> list[list[int]]:
    """[row][state]: no edits of the rows from there on to the state ``after`` cost less; audits are left aside."""
    least = [[0 if state == after else INFINITE for state in range(4)]]
    for symbol in reversed(symbols):
        rest = least[-1]
        here = [min(cost + rest[to] for cost, _, to, done in _choices(symbol, state) if done) for state in range(4)]
        for _ in range(3):  # a longer run of inserted messages only comes back to a state
            here = [min(here[state], INSERT + here[SPOKEN[state][1]]) for state in range(4)]
        least.append(here)
    return least[::-1]


def search(symbols: tuple[str, ...], before: int, after: int, least: list[list[int]] | None = None) -> tuple[int, str] | None:
    """(cost, audit) of the cheapest, then ASCII-least edits of all rows that lead from one state to another."""
    least = least or suffix_bounds(symbols, after)
    incumbent: tuple[int, str] | None = None
    tables: dict[tuple[int, int], tuple[int, str]] = {}
    stack = [(0, before, 0, "")]
    while stack:
        at, state, cost, audit = stack.pop()
        bound = cost + least[at][state]
        if bound >= INFINITE:
            continue
        if incumbent is not None and (bound > incumbent[0] or (bound == incumbent[0] and audit > incumbent[1][: len(audit)])):
            continue
        known = tables.get((at, state))
        if known is not None and known <= (cost, audit):
            continue
        tables[at, state] = (cost, audit)
        if at == len(symbols):
            if incumbent is None or (cost, audit) < incumbent:
                incumbent = (cost, audit)
            continue
        ahead = [(more + least[at + done][to], edit, to, cost + more, done) for more, edit, to, done in _choices(symbols[at], state)]
        for _, edit, to, total, done in sorted(ahead, reverse=True):  # the most promising branch is taken next
            stack.append((at + done, to, total, audit + edit))
    return incumbent


def joined(x: Best, y: Best) -> Best:
    """Best edits of two adjoining stretches."""
    return tuple(
        tuple(
            min(((x[a][b][0] + y[b][c][0], x[a][b][1] + y[b][c][1]) for b in range(4) if x[a][b] and y[b][c]), default=None)
            for c in range(4)
        )
        for a in range(4)
    )


@lru_cache(maxsize=1 << 14)
def piece(symbols: tuple[str, ...]) -> Best:
    bounds = [suffix_bounds(symbols, b) for b in range(4)]
    return tuple(tuple(search(symbols, a, b, bounds[b]) for b in range(4)) for a in range(4))


def best_edits(symbols: list[str]) -> Best:
    """Best edits of any number of rows, joined pairwise along a tree."""
    level = [piece(tuple(symbols[i : i + PIECE])) for i in range(0, max(1, len(symbols)), PIECE)]
    while len(level) > 1:
        pairs = [joined(level[i], level[i + 1]) for i in range(0, len(level) - 1, 2)]
        level = pairs + level[len(pairs) * 2 :]
    return level[0]


# At the end of a conversation nothing or inserted messages follow; every final state is among them.
END: Best = tuple(
    tuple((0, "") if a == b else {(1, 3): (2 * INSERT, "II"), (2, 3): (INSERT, "I"), (0, 3): (2 * INSERT, "II")}.get((a, b)) for b in range(4)) for a in range(4)
)


def damaged(rows: DataFrame) -> DataFrame:
    """(conv_id, turn, role, text) after the damage that crc32(``conv_id:turn``) modulo 20 stands for; nulls count as one space."""
    text_of = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    kind = F.crc32(F.concat(text_of("conv_id"), F.lit(":"), text_of("turn"))) % 20
    own = rows.select("conv_id", "turn", text_of("role").alias("role"), text_of("text").alias("text"), kind.alias("kind")).where("kind <> 0")
    text = F.when(F.col("kind") == 1, "").when(F.col("kind") == 2, F.translate("text", ".!?", "")).otherwise(F.col("text"))
    role = F.when(F.col("kind") == 4, "user").otherwise(F.col("role"))
    copies = F.explode(F.when(F.col("kind") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0))))
    return own.select("conv_id", "turn", role.alias("role"), text.alias("text"), copies.alias("copy"))


def numbered(rows: DataFrame, span: int = SPAN) -> DataFrame:
    """Adds the row's unit (span of turns), its place in it and its fault: b, d, t or blank.

    Rows of a turn are in the order of role and text.  Whether a row repeats an earlier one is decided on digests, grouped before they are shuffled,
    so a row repeated millions of times is no hot task.
    """
    told = rows.withColumns(
        {
            "unit": F.coalesce(F.shiftright("turn", span), F.lit(-(1 << 62)).cast("long")),
            "digest": F.sha2(F.encode(F.concat(F.length("role").cast("string"), F.lit(":"), F.col("role"), F.col("text")), "UTF-8"), 256),
        }
    )
    known = F.col("turn").isNotNull()
    firsts = told.groupBy("conv_id", "digest").agg(F.count("*").alias("copies"), F.min(F.struct(known.alias("known"), F.col("turn").alias("turn"))).alias("first"))
    repeated = firsts.where("copies > 1").select(F.col("conv_id").alias("c"), F.col("digest").alias("d"), "first")
    met = told.join(repeated, F.col("conv_id").eqNullSafe(F.col("c")) & (F.col("digest") == F.col("d")), "left")
    order = [F.asc_nulls_first("turn"), "role", "text", "copy"]
    place = F.row_number().over(Window.partitionBy("conv_id", "unit").orderBy(*order))
    # Rows alike in one turn adjoin, so the first of them is the one whose predecessor is another row.
    before = F.lag("digest").over(Window.partitionBy("conv_id", "unit").orderBy(*order))
    last_turn = F.lag("turn").over(Window.partitionBy("conv_id", "unit").orderBy(*order))
    same = F.coalesce((before == F.col("digest")) & last_turn.eqNullSafe(F.col("turn")), F.lit(False))
    later = F.col("first").isNotNull() & (~F.col("first.turn").eqNullSafe(F.col("turn")) | same)
    plain = F.rtrim(F.col("text"), F.lit(SPACE))
    fault = F.when(plain == "", "b").when(later, "d").when(~F.substring(plain, -1, 1).isin(".", "!", "?"), "t").otherwise(" ")
    return met.withColumns({"place": place, "fault": fault}).select("conv_id", "unit", "place", "turn", "role", "text", "fault")


PLAN = "conv_id long, unit long, n int, first string, last string, illegal long, costs array<long>, ranks array<int>, audits array<string>"


PLAN_SCHEMA = pa.schema(
    [("conv_id", pa.int64()), ("unit", pa.int64()), ("n", pa.int32()), ("first", pa.string()), ("last", pa.string()), ("illegal", pa.int64()),
     ("costs", pa.list_(pa.int64())), ("ranks", pa.list_(pa.int32())), ("audits", pa.list_(pa.string()))]
)
ROUTES = "conv_id long, unit long, chosen int, ending string, cost long, illegal long"
ROUTE_SCHEMA = pa.schema([("conv_id", pa.int64()), ("unit", pa.int64()), ("chosen", pa.int32()), ("ending", pa.string()), ("cost", pa.int64()), ("illegal", pa.int64())])


def _grouped(batches: Iterator[pa.RecordBatch], keys: list[str], columns: list[str], schema: pa.Schema, of_group: Callable) -> Iterator[pa.RecordBatch]:
    """Rows in the order of their keys, handed on group by group; what the groups of a batch give is one batch."""
    own, held, out = None, [], []
    for batch in batches:
        for key, row in zip(zip(*(batch.column(k).to_pylist() for k in keys), strict=True), zip(*(batch.column(c).to_pylist() for c in columns), strict=True), strict=True):
            if key != own:
                if own is not None:
                    out += of_group(own, held)
                own, held = key, []
            held.append(row)
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out, strict=True), schema, strict=True)], schema=schema)
            out = []
    if own is not None:
        out = of_group(own, held)
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out, strict=True), schema, strict=True)], schema=schema)


def _unit(key: tuple, rows: list[tuple[str, str]]) -> list[tuple]:
    """The plan of one unit from its rows' initials and faults."""
    roles = [r for r, _ in rows]
    illegal = sum(a + b not in ("su", "ua", "au") for a, b in zip(roles, roles[1:], strict=False))
    flat = [e for line in best_edits([r + f for r, f in rows]) for e in line]
    order = sorted({e[1] for e in flat if e})
    ranks = [order.index(e[1]) if e else -1 for e in flat]
    return [(*key, len(roles), roles[0], roles[-1], illegal, [e and e[0] for e in flat], ranks, [e and e[1] for e in flat])]


def _route(key: tuple, units: list[tuple]) -> list[tuple]:
    """The cell of every unit's table that the best repair of a conversation takes.

    From the last unit back, a state's best rest is a cost and a place in the order of the audits among the four states.
    """
    ends = [min(((END[a][b][0], END[a][b][1], b) for b in FINAL if END[a][b]), default=None) for a in range(4)]
    rest = [None if e is None else (e[0], sorted({x[1] for x in ends if x}).index(e[1])) for e in ends]
    ways: list[list[int]] = []
    for _, _, _, _, c, r in reversed(units):
        found = [
            min(((c[4 * a + b] + rest[b][0], r[4 * a + b], rest[b][1], b) for b in range(4) if c[4 * a + b] is not None and rest[b] is not None), default=None)
            for a in range(4)
        ]
        ways.append([-1 if f is None else f[3] for f in found])
        # No audit of a unit begins another of it, so unequal ones decide and equal ones leave it to what follows.
        order = sorted({f[1:3] for f in found if f})
        rest = [None if f is None else (f[0], order.index(f[1:3])) for f in found]
    ways.reverse()
    state, chosen = 0, []
    for way in ways:
        chosen.append(4 * state + way[state])
        state = way[state]
    illegal = sum(u[3] for u in units) + sum(a[2] + b[1] not in ("su", "ua", "au") for a, b in zip(units, units[1:], strict=False))
    ending = [""] * (len(units) - 1) + [ends[state][1]]
    total = sum(u[4][at] for u, at in zip(units, chosen, strict=True)) + ends[state][0]
    return [(*key, u[0], at, end, total, illegal) for u, at, end in zip(units, chosen, ending, strict=True)]


def _plans(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    return _grouped(batches, ["conv_id", "unit"], ["initial", "fault"], PLAN_SCHEMA, _unit)


def _routes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    return _grouped(batches, ["conv_id"], ["unit", "first", "last", "illegal", "costs", "ranks"], ROUTE_SCHEMA, _route)


class _Repaired:
    """One conversation as its rows come by: the roles so far, the audit and the digest of the repaired text."""

    def __init__(self) -> None:
        self.digest, self.audit, self.kept, self.state = hashlib.sha256(), [], 0, 0

    def _say(self, role: str, text: str, initial: str) -> None:
        self.digest.update((("\n" if self.kept else "") + f"{role}:{text}").encode("utf-8", "surrogatepass"))
        self.kept += 1
        self.state = NEXT[self.state][initial]

    def _spoken(self, text: str) -> None:
        initial = SPOKEN[self.state][0]
        self._say("user" if initial == "u" else "assistant", text, initial)

    def edit(self, edits: str, role: str, text: str) -> None:
        """Inserted messages and then the edit of this row."""
        for e in edits:
            if e == "I":
                self._spoken("")
            elif e == "R":
                self._spoken(text)
            elif e == "K":
                self._say(role, text, role[:1])

    def end(self, edits: str) -> None:
        for _ in edits:
            self._spoken("")


DONE = "conv_id long, audit string, repaired_sha256 string"


def _replay(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows in the order of conversations; a row of place 0 has the edits of the unit that follows."""
    own, now = None, None
    todo, at, ending = "", 0, ""

    def result() -> pa.RecordBatch:
        now.end(ending)
        audit = "".join([*now.audit, ending])
        return pa.RecordBatch.from_arrays([pa.array([own[0]], pa.int64()), pa.array([audit]), pa.array([now.digest.hexdigest()])], names=["conv_id", "audit", "repaired_sha256"])

    for batch in batches:
        for row in zip(*(batch.column(c).to_pylist() for c in ("conv_id", "place", "role", "text", "edits", "ending")), strict=True):
            conv, place, role, text, edits, close = row
            if own != (conv,):
                if own is not None:
                    yield result()
                own, now = (conv,), _Repaired()
            if place == 0:
                todo, at, ending = edits, 0, close
                now.audit.append(edits)
                continue
            end = at
            while todo[end] == "I":
                end += 1
            now.edit(todo[at : end + 1], role, text)
            at = end + 1
    if own is not None:
        yield result()


def repair(conversations: DataFrame, span: int = SPAN) -> DataFrame:
    """(conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256) of every conversation after its damage.

    Defined cases: null role and text are one space, a null turn comes first and takes no part in the gaps, rows
    of a null conv_id are one conversation; rows of one turn are in the order of role and text, so results do not depend on the
    layout; a conversation without rows after the damage has zeros, an empty audit and the digest of the empty text; a role
    of no known initial, an empty one too, can only be rerolled or deleted; an empty table gives no rows; other columns are ignored.
    """
    prepare(conversations.sparkSession)
    own = conversations.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), "role", "text")
    rows = written(numbered(damaged(own), span), "repair-rows")
    initial = F.substring("role", 1, 1)
    initial = F.when(initial.isin("s", "u", "a"), initial).otherwise("-")  # no other initial is ever legal
    small = rows.select("conv_id", "unit", "place", initial.alias("initial"), "fault")
    # Rows are small and the search is work: the number of tasks is that of the session, not one by their bytes.
    tasks = int(conversations.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = small.repartition(tasks, "conv_id", "unit").sortWithinPartitions("conv_id", "unit", "place")
    units = written(dealt.mapInArrow(_plans, PLAN), "repair-units")
    plain = units.select("conv_id", "unit", "first", "last", "illegal", "costs", "ranks")
    routed = written(plain.repartition(tasks, "conv_id").sortWithinPartitions("conv_id", "unit").mapInArrow(_routes, ROUTES), "repair-routes")
    edits = units.alias("u").join(routed.alias("r"), F.col("u.conv_id").eqNullSafe(F.col("r.conv_id")) & (F.col("u.unit") == F.col("r.unit")))
    heads = edits.select(F.col("u.conv_id").alias("conv_id"), F.col("u.unit").alias("unit"), F.lit(0).alias("place"), F.element_at("audits", F.col("chosen") + 1).alias("edits"), "ending")
    told = rows.select("conv_id", "unit", "place", "role", "text").unionByName(heads, allowMissingColumns=True)
    in_order = told.repartition("conv_id").sortWithinPartitions("conv_id", "unit", "place")
    replayed = in_order.select("conv_id", "place", "role", "text", "edits", "ending").mapInArrow(_replay, DONE)
    counted = rows.groupBy("conv_id").agg(
        *[F.count_if(F.col("fault") == f).alias(name) for f, name in (("b", "blank"), ("d", "duplicate"), ("t", "truncated"))],
        F.coalesce(F.max("turn") - F.min("turn") + 1 - F.count_distinct("turn"), F.lit(0).cast("long")).alias("gaps"),
    )
    sums = routed.groupBy("conv_id").agg(F.max("cost").alias("cost"), F.max("illegal").alias("illegal"))
    out = own.select("conv_id").distinct()
    for i, part in enumerate((counted, sums, replayed)):
        part = part.withColumnRenamed("conv_id", f"c{i}")
        out = out.join(part, F.col("conv_id").eqNullSafe(F.col(f"c{i}")), "left").drop(f"c{i}")
    numbers = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost"]
    return out.select(
        "conv_id", *[F.coalesce(F.col(c), F.lit(0).cast("long")).alias(c) for c in numbers], F.coalesce("audit", F.lit("")).alias("audit"),
        F.coalesce("repaired_sha256", F.sha2(F.lit("").cast("binary"), 256)).alias("repaired_sha256"),
    )
