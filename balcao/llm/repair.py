"""Repair of conversations by the cheapest edits that give user and assistant turns in alternation.

The rows of a conversation, in order, span an edit lattice: a node is (rows read,
state), the state being what the repaired conversation ends with so far (nothing, a
system turn, a user turn, an assistant turn). Edges are Keep, Rerole, Delete and
Insert with their costs; a path from (0, nothing) to the last row with nothing or an
assistant turn is a repair. ``cheapest`` finds the least cost by two Dijkstra searches
that start at both ends and meet. They go on until the two smallest open distances
add up to more than the best crossing, so that every node of every cheapest path has been
settled by one of them; the least audit text among those paths is then read off from
the start, edge by edge, as the edges that leave a node all have different initials.

Spark brings the rows of a conversation of at most ``BLOCK`` rows together, sorted, and
each conversation is repaired as it passes. A longer one is never in one place: its rows
are numbered in blocks of the whole ordering (``operators/ordered``), earlier equal rows
are found by grouping, and it is repaired block by block: the costs from each state to each
state of a block are 16 searches in its own task, a row per block then chains them, and each
block writes its edits for the states it may be entered in. Only the SHA-256 of a long
conversation, which has to read its texts in order, streams them through one task, in
sorted rows and bounded memory.

Defined cases. Null role or text counts as one space, a null turn comes first, and all
rows with null conv_id are one conversation. Rows of equal turn are ordered by role, then by the
text's first 64 characters, then by a hash of the whole. Repeated rows are duplicates. No rows
give no rows; ``every_conversation`` adds those that lost all rows. Other columns are not read.
"""

from __future__ import annotations

import hashlib
import heapq
from collections.abc import Iterable, Iterator, Mapping, Sequence
from functools import cache, lru_cache
from itertools import pairwise

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from balcao.operators.ordered import position, previous, with_prefix
from balcao.sources.scratch import stage

#: Rows of a conversation that one group takes at once.
BLOCK = 4096

#: States of the lattice: what the repaired conversation ends with.
START, SYSTEM, USER, ASSISTANT = range(4)
DELETE, INSERT, KEEP, REROLE = "DIKR"
NAMES = {USER: "user", ASSISTANT: "assistant"}
#: Faults of a row, by the first that holds.
SOUND, BLANK, DUPLICATE, TRUNCATED = range(4)
COST = {DELETE: 2, INSERT: 5, KEEP: 0, REROLE: 1}
LEFT_TRUNCATED = 5

#: State after a turn that may follow: user or assistant.
_NEXT = {START: USER, SYSTEM: USER, USER: ASSISTANT, ASSISTANT: USER}
_LAST = {START: 0, ASSISTANT: 0}
_FAR = 1 << 60
_LEGAL = ("su", "ua", "au")
FIGURES = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]

SPACE = " \t\n\v\f\r"
#: Order of rows within a conversation.
ORDER = ["turn", "role", "opening", "same"]


# --- the lattice ---------------------------------------------------------------------


def _kept(initial: str, state: int) -> int | None:
    """State after keeping a row of this initial; None where it cannot stand."""
    if initial == "s":
        return SYSTEM if state == START else None
    return _NEXT[state] if initial == ("a" if state == USER else "u") else None


@cache
def _edges(row: str | None, state: int, insert: bool) -> list[tuple[str, int, int, int]]:
    """(initial, cost, rows read, next state) of the edits that may follow a state before a row, by initial."""
    found = [(INSERT, COST[INSERT], 0, _NEXT[state])] if insert else []
    if row is not None:
        initial, fault = row[0], int(row[1])
        found.append((DELETE, COST[DELETE], 1, state))
        if fault not in (BLANK, DUPLICATE):
            extra = LEFT_TRUNCATED * (fault == TRUNCATED)
            found.append((REROLE, COST[REROLE] + extra, 1, _NEXT[state]))
            kept = _kept(initial, state)
            if kept is not None:
                found.append((KEEP, COST[KEEP] + extra, 1, kept))
    return sorted(found)


@cache
def _edges_back(row: str | None, state: int, insert: bool) -> list[tuple[int, int, int]]:
    """(cost, rows read, state before) of the edits that lead to a state behind a row."""
    by_insert = [(COST[INSERT], 0, before) for before in range(4) if insert and _NEXT[before] == state]
    by_row = [
        (cost, 1, before)
        for before in range(4)
        for _, cost, _, reached in (_edges(row, before, False) if row is not None else [])
        if reached == state
    ]
    return by_insert + by_row


def row_kind(role: str, fault: int) -> str:
    """What the lattice knows of a row: the initial of its role (? if none of s, u and a) and its fault."""
    initial = role[:1]
    return (initial if initial and initial in "sua" else "?") + str(fault)


class _Search:
    """One Dijkstra search over nodes (rows read, state), settled in order of distance."""

    def __init__(self, starts: Mapping[tuple[int, int], int], sign: int):
        self.sign, self.known, self.settled = sign, dict(starts), {}
        self.heap = [(cost, sign * at, at, state) for (at, state), cost in starts.items()]
        heapq.heapify(self.heap)

    def top(self) -> int:
        while self.heap and (self.heap[0][2], self.heap[0][3]) in self.settled:
            heapq.heappop(self.heap)
        return self.heap[0][0] if self.heap else _FAR

    def settle(self) -> tuple[int, int, int]:
        cost, _, at, state = heapq.heappop(self.heap)
        self.settled[at, state] = cost
        return cost, at, state

    def reach(self, at: int, state: int, cost: int) -> None:
        if cost < self.known.get((at, state), _FAR):
            self.known[at, state] = cost
            heapq.heappush(self.heap, (cost, self.sign * at, at, state))


def cheapest(
    rows: Sequence[str],
    begin: int = START,
    ends: Mapping[int, int] = _LAST,
    last: bool = True,
) -> tuple[int, str, int] | None:
    """Least cost, least audit and end state of the repairs of rows, each given by its ``row_kind``.

    ``begin`` is the state before the first row, ``ends`` the cost of going on from each
    state after the last. Where other rows follow (not ``last``), inserts after the last row are left to
    them. None where no repair exists.
    """
    n = len(rows)

    def after(at: int, state: int):
        return _edges(rows[at] if at < n else None, state, last or at < n)

    ahead = _Search({(0, begin): 0}, 1)
    back = _Search({(n, state): cost for state, cost in ends.items() if cost < _FAR}, -1)
    best = _FAR
    while ahead.top() + back.top() <= best and max(ahead.top(), back.top()) < _FAR:
        this, other = (ahead, back) if ahead.top() <= back.top() else (back, ahead)
        cost, at, state = this.settle()
        best = min(best, cost + other.known.get((at, state), _FAR))
        if this is ahead:
            for _, step, read, reached in after(at, state):
                this.reach(at + read, reached, cost + step)
        else:
            for step, read, before in _edges_back(rows[at - 1] if at else None, state, last or at < n):
                this.reach(at - read, before, cost + step)
    if best >= _FAR:
        return None
    # What is left to pay at nodes of cheapest paths: settled from behind, or from ahead with an edge that loses nothing.
    left = {node: cost for node, cost in back.settled.items() if ahead.known.get(node, _FAR) + cost == best}

    def rest(at: int, state: int) -> int:
        return min(left.get((at, state), _FAR), back.settled.get((at, state), _FAR))

    for (at, state), cost in reversed(ahead.settled.items()):
        tight = any(cost + step + rest(at + read, to) == best for _, step, read, to in after(at, state))
        if tight or (at == n and cost + ends.get(state, _FAR) == best):
            left[at, state] = best - cost
    audit, at, state, spent = [], 0, begin, 0
    while at < n or ends.get(state, _FAR) != best - spent:
        label, step, read, state = next(e for e in after(at, state) if spent + e[1] + rest(at + e[2], e[3]) == best)
        audit.append(label)
        at, spent = at + read, spent + step
    return best, "".join(audit), state


@lru_cache(maxsize=1 << 14)
def _known_cheapest(rows: str) -> tuple[int, str]:
    """Cost and audit of a short conversation, given by its row kinds in one text."""
    cost, audit, _ = cheapest([rows[i : i + 2] for i in range(0, len(rows), 2)])
    return cost, audit


def repaired(rows: Sequence[tuple[str, str]], audit: str, begin: int = START) -> Iterator[tuple[str, str]]:
    """Role and text of the turns that the edits of an audit leave."""
    state, at = begin, 0
    for label in audit:
        if label == INSERT:
            state = _NEXT[state]
            yield NAMES[state], ""
            continue
        role, text = rows[at]
        at += 1
        if label == KEEP:
            state = SYSTEM if role[:1] == "s" else _NEXT[state]
            yield role, text
        elif label == REROLE:
            state = _NEXT[state]
            yield NAMES[state], text


# --- faults --------------------------------------------------------------------------


def _keyed(turns: DataFrame) -> DataFrame:
    """Turns without nulls in role and text, a digest of what each says, and its fault but for duplicates."""
    space = lambda c: F.coalesce(F.col(c), F.lit(" ")).alias(c)
    said = F.concat_ws("\x00", F.length("role").cast("string"), "role", "text")
    whose = F.coalesce(F.concat(F.lit("#"), F.col("conv_id").cast("string")), F.lit(""))
    bare = F.rtrim("text", F.lit(SPACE))
    fault = F.when(bare == "", BLANK).when(F.right(bare, F.lit(1)).isin(".", "!", "?"), SOUND).otherwise(TRUNCATED)
    return turns.select("conv_id", "turn", space("role"), space("text")).select(
        "*", F.substring("text", 1, 64).alias("opening"),
        F.sha2(F.concat_ws("\x00", whose, said), 256).alias("same"), fault.alias("fault"),
    )


def ordered(keyed: DataFrame) -> DataFrame:
    """Turns with their place in the conversation, first fault and the initial before, stored."""
    # Equal rows are counted, then numbered, so that the order of rows is total.
    counted = keyed.groupBy(*keyed.columns).agg(F.count(F.lit(1)).alias("times"))
    copy = F.explode(F.sequence(F.lit(1).cast("bigint"), "times")).alias("copy")
    single = counted.select(*keyed.columns, F.substring("role", 1, 1).alias("initial"), copy)
    placed = with_prefix(single, ["conv_id"], [*ORDER, "copy"], pos=position(), before=previous("initial"))
    # Earlier equal rows: only digests that repeat are joined.
    firsts = placed.groupBy("same").agg(F.min("pos").alias("first"), F.count(F.lit(1)).alias("times"))
    joined = placed.join(firsts.filter("times > 1").select("same", "first"), "same", "left")
    again = (F.col("pos") > F.col("first")) & (F.col("fault") != BLANK)
    fault = F.when(again, DUPLICATE).otherwise(F.col("fault")).alias("fault")
    return stage(joined.select("conv_id", "turn", "pos", "role", "text", fault, "initial", "before"), "turnos")


# --- repair --------------------------------------------------------------------------

_SQUARE = "array<bigint>"


def _sorted_kinds(table: pa.Table) -> list[str]:
    """Kinds of a block's rows, in order."""
    table = table.sort_by("pos")
    return [row_kind(*row) for row in zip(table.column("role").to_pylist(), table.column("fault").to_pylist(), strict=True)]


def _digest(turns: Iterable[tuple[str, str]], seen=None):
    """SHA-256 of turns as lines; ``seen`` is (hash, whether it holds a line) to go on with."""
    digest, begun = seen or (hashlib.sha256(), False)
    for role, text in turns:
        digest.update((("\n" if begun else "") + f"{role}:{text}").encode("utf-8", "surrogatepass"))
        begun = True
    return digest, begun


def _whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Faults and repairs of conversations of one block, whose rows follow each other in order."""
    held, kept, schema = [], None, None

    def closed() -> tuple:
        seen, kinds, pairs = set(), [], []
        for _, role, _, same, fault in held:
            kinds.append(row_kind(role, DUPLICATE if same in seen and fault != BLANK else fault))
            seen.add(same)
            pairs.append(role[:1])
        turns = {row[0] for row in held if row[0] is not None}
        gaps = max(turns) - min(turns) + 1 - len(turns) if turns else 0
        illegal = sum(one + two not in _LEGAL for one, two in pairwise(pairs))
        cost, audit = _known_cheapest("".join(kinds))
        digest, _ = _digest(repaired([row[1:3] for row in held], audit))
        counts = [sum(int(kind[1]) == code for kind in kinds) for code in (BLANK, DUPLICATE, TRUNCATED)]
        return kept, gaps, *counts, illegal, cost, audit, digest.hexdigest()

    def sent(rows: list[tuple]) -> pa.RecordBatch:
        types = [schema.field("conv_id").type, *[pa.int64()] * 6, pa.string(), pa.string()]
        columns = [pa.array([row[i] for row in rows], kind) for i, kind in enumerate(types)]
        return pa.RecordBatch.from_arrays(columns, ["conv_id", *FIGURES])

    for batch in batches:
        done, schema = [], batch.schema
        columns = [batch.column(c).to_pylist() for c in ("conv_id", "turn", "role", "text", "same", "fault")]
        for conv_id, *row in zip(*columns, strict=True):
            if held and conv_id != kept:
                done.append(closed())
                held = []
            kept = conv_id
            held.append(row)
        if done:
            yield sent(done)
    if held:
        yield sent([closed()])


def _block_costs(table: pa.Table) -> pa.Table:
    """Costs between all states before and after a block, by 16 searches."""
    rows = _sorted_kinds(table)
    last = table.column("last")[0].as_py()
    found = [cheapest(rows, begin, {end: 0}, last) for begin in range(4) for end in range(4)]
    costs = pa.array([[f[0] if f else _FAR for f in found]], pa.list_(pa.int64()))
    return table.slice(0, 1).select(["conv_id", "block", "last"]).append_column("costs", costs)


def _ends_of_blocks(table: pa.Table) -> pa.Table:
    """What it costs to go on after each block of a conversation, from its last block to its first."""
    table = table.sort_by("block")
    after = [_LAST.get(state, _FAR) for state in range(4)]
    ends = []
    for costs in reversed(table.column("costs").to_pylist()):
        ends.append(after)
        after = [min(min(costs[4 * a + b] + after[b] for b in range(4)), _FAR) for a in range(4)]
    return table.select(["conv_id", "block"]).append_column("ends", pa.array(ends[::-1], pa.list_(pa.int64())))


def _block_edits(table: pa.Table) -> pa.Table:
    """A block's edits for each state that it may be entered in."""
    rows = _sorted_kinds(table)
    ends = dict(enumerate(table.column("ends")[0].as_py()))
    last = table.column("last")[0].as_py()
    found = [cheapest(rows, begin, ends, last) or (_FAR, "", START) for begin in range(4)]
    out = table.slice(0, 1).select(["conv_id", "block"])
    for name, values, kind in (
        ("costs", [f[0] for f in found], pa.int64()),
        ("audits", [f[1] for f in found], pa.string()),
        ("leads", [f[2] for f in found], pa.int32()),
    ):
        out = out.append_column(name, pa.array([values], pa.list_(kind)))
    return out


def _chained(table: pa.Table) -> pa.Table:
    """The state in which each block of a conversation is entered, and its edits."""
    table = table.sort_by("block")
    state, begins, audits, costs = START, [], [], []
    for cost, audit, lead in zip(*(table.column(c).to_pylist() for c in ("costs", "audits", "leads")), strict=True):
        begins.append(state)
        audits.append(audit[state])
        costs.append(cost[state])
        state = lead[state]
    out = table.select(["conv_id", "block"]).append_column("entered", pa.array(begins, pa.int32()))
    whole = pa.array([costs[0]] * len(costs), pa.int64())
    return out.append_column("audit", pa.array(audits)).append_column("cost", whole)


def _streamed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Hashes of conversations whose blocks follow each other, row by row.

    A row that ends a block carries the block's edits; the block's rows are held until then.
    """
    kept, seen, held = None, None, []
    for batch in batches:
        rows = batch.to_pylist()
        for row in rows:
            if seen is not None and row["conv_id"] != kept:
                yield _hashed(batch.schema, kept, seen)
                seen, held = None, []
            kept = row["conv_id"]
            held.append((row["role"], row["text"]))
            if row["audit"] is not None:
                seen = _digest(repaired(held, row["audit"], row["entered"]), seen)
                held = []
            elif seen is None:
                seen = _digest(iter(()))
    if seen is not None:
        yield _hashed(batch.schema, kept, seen)


def _hashed(schema: pa.Schema, conv_id: object, seen: tuple) -> pa.RecordBatch:
    ids = pa.array([conv_id], schema.field("conv_id").type)
    return pa.RecordBatch.from_arrays([ids, pa.array([seen[0].hexdigest()])], ["conv_id", "repaired_sha256"])


def _repaired_by_block(rows: DataFrame, kind: str) -> DataFrame:
    """cost, audit and hash of conversations of more than one block."""
    by = ["conv_id", "block"]
    top = rows.groupBy("conv_id").agg(F.max("block").alias("top"))
    known = rows.join(top, rows["conv_id"].eqNullSafe(top["conv_id"])).drop(top["conv_id"])
    known = stage(known.withColumn("last", F.col("block") == F.col("top")), "longas")
    grouped = known.select(*by, "pos", "role", "text", "fault", "last")
    slim = grouped.withColumn("text", F.lit(""))
    costs = slim.groupBy(*by).applyInArrow(
        _block_costs, f"conv_id {kind}, block bigint, last boolean, costs {_SQUARE}"
    )
    ends = costs.groupBy("conv_id").applyInArrow(_ends_of_blocks, f"conv_id {kind}, block bigint, ends {_SQUARE}")
    ends = stage(ends, "finais").withColumnsRenamed({"conv_id": "of", "block": "nr"})
    there = F.col("conv_id").eqNullSafe(F.col("of")) & (F.col("block") == F.col("nr"))
    edits = slim.join(ends, there).drop("of", "nr").groupBy(*by).applyInArrow(
        _block_edits, f"conv_id {kind}, block bigint, costs {_SQUARE}, audits array<string>, leads array<int>"
    )
    chained = stage(
        edits.groupBy("conv_id").applyInArrow(
            _chained, f"conv_id {kind}, block bigint, entered int, audit string, cost bigint"
        ),
        "emendas",
    )
    # The last row of a block, or of the conversation, brings the block's edits.
    size = known.groupBy(*by).agg(F.max("pos").alias("ends_at"))
    closing = chained.join(size, chained["conv_id"].eqNullSafe(size["conv_id"]) & (chained["block"] == size["block"]))
    closing = closing.select(chained["conv_id"].alias("of"), "ends_at", "entered", "audit")
    closes = known["conv_id"].eqNullSafe(closing["of"]) & (known["pos"] == closing["ends_at"])
    in_order = (
        known.join(closing, closes, "left")
        .select("conv_id", "pos", "role", "text", "entered", "audit")
        .repartition("conv_id")
        .sortWithinPartitions("conv_id", "pos")
    )
    hashes = in_order.mapInArrow(_streamed, f"conv_id {kind}, repaired_sha256 string")
    parts = F.array_sort(F.collect_list(F.struct("block", "audit")))
    audits = chained.groupBy("conv_id").agg(
        F.max("cost").alias("cost"), F.array_join(F.transform(parts, lambda p: p["audit"]), "").alias("audit")
    )
    return audits.join(hashes.withColumnRenamed("conv_id", "of"), F.col("conv_id").eqNullSafe(F.col("of"))).drop("of")


def repair(turns: DataFrame, block: int = BLOCK) -> DataFrame:
    """One row per conversation that has rows: its faults and its cheapest repair.

    conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256.
    """
    kind = turns.schema["conv_id"].dataType.simpleString()
    rows = _keyed(turns)
    long = turns.groupBy("conv_id").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > block)
    long = stage(long.select(F.col("conv_id").alias("of")), "compridas")
    mine = F.col("conv_id").eqNullSafe(F.col("of"))
    some_long = not long.isEmpty()
    short = rows.join(long, mine, "left_anti") if some_long else rows
    together = short.repartition("conv_id").sortWithinPartitions("conv_id", *ORDER)
    numbers = ", ".join(f"{name} bigint" for name in FIGURES[:-2])
    found = together.select("conv_id", "turn", "role", "text", "same", "fault").mapInArrow(
        _whole, f"conv_id {kind}, {numbers}, audit string, repaired_sha256 string"
    )
    if not some_long:
        return found
    known = ordered(rows.join(long, mine, "left_semi"))
    blocked = known.withColumn("block", F.expr(f"(pos - 1) div {block}"))
    repairs = _repaired_by_block(blocked.select("conv_id", "pos", "block", "role", "text", "fault"), kind)
    both = _figures(known).join(repairs.withColumnRenamed("conv_id", "of"), mine)
    return found.unionByName(both.select(*found.columns))


def _figures(known: DataFrame) -> DataFrame:
    """Counts of faults, gaps in turns and illegal neighbours of each conversation."""
    wrong = ~F.concat("before", "initial").isin(*_LEGAL)
    of_turn = known.groupBy("conv_id", "turn").agg(
        F.count_if(wrong).alias("illegal"),
        *[
            F.count_if(F.col("fault") == code).alias(name)
            for code, name in ((BLANK, "blank"), (DUPLICATE, "duplicate"), (TRUNCATED, "truncated"))
        ],
    )
    gaps = F.max("turn") - F.min("turn") + 1 - F.count("turn")
    return of_turn.groupBy("conv_id").agg(
        F.coalesce(gaps, F.lit(0)).cast("bigint").alias("gaps"),
        *[F.sum(name).alias(name) for name in ("blank", "duplicate", "truncated", "illegal")],
    )


# --- damage --------------------------------------------------------------------------


def damaged(turns: DataFrame) -> DataFrame:
    """The rows of the check, damaged by a hash of conversation and turn: lost, emptied, cut, repeated or reroled."""
    space = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    key = F.concat(space("conv_id"), F.lit(":"), space("turn"))
    fate = F.pmod(F.crc32(key.cast("binary")), F.lit(20))
    text = F.when(fate == 1, "").when(fate == 2, F.regexp_replace(space("text"), "[.!?]", "")).otherwise(space("text"))
    role = F.when(fate == 4, "user").otherwise(space("role"))
    times = F.when(fate == 3, 2).otherwise(1)
    rows = turns.filter(fate != 0).select("conv_id", "turn", role.alias("role"), text.alias("text"), times.alias("times"))
    return rows.select("conv_id", "turn", "role", "text", F.explode(F.sequence(F.lit(1), "times"))).drop("col")


def every_conversation(turns: DataFrame, repairs: DataFrame) -> DataFrame:
    """The repairs, and a row of zeros for each conversation that has no rows left."""
    ids = turns.select(F.col("conv_id").alias("of")).distinct()
    joined = ids.join(repairs, F.col("conv_id").eqNullSafe(F.col("of")), "left")
    number = [F.coalesce(F.col(c), F.lit(0)).cast("bigint").alias(c) for c in FIGURES[:-2]]
    empty = hashlib.sha256().hexdigest()
    return joined.select(
        F.col("of").alias("conv_id"), *number,
        F.coalesce("audit", F.lit("")).alias("audit"), F.coalesce("repaired_sha256", F.lit(empty)).alias("repaired_sha256"),
    )
