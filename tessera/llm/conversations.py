"""Conversation structure repair by a time-major tensor program (operator 12).

Edits turn the roles of a conversation into ``(s?(ua)+)?`` at least cost: Keep 0, Rerole to user or
assistant 3, Delete 4, Insert of an empty user or assistant turn 3.  Blank and duplicate turns must
go; a truncated turn that stays costs 3.  Four states say what may come next (START, SYSTEM said,
USER said, ASSISTANT said), so in each state an insert or a rerole has one role only, and a string of
edits says all there is to know.

Conversations of a task are put in buckets of like length.  A bucket is a tensor with time first and
conversations second, aligned at their ends: one pass backwards updates the cost to go of all
conversations in all states for each turn and stores it; one pass forwards traces all conversations
at once, and takes of the edits that keep the cost the least letter (D, I, K, R).

A conversation of more than ``BLOCK`` turns is cut into blocks by ranges of its order.  Each block
gives its least costs from state to state; these are combined over the blocks, back to front, to the
cost to go at each cut; the blocks are traced from every state, and the states met are chained front
to back.  So no task holds a long conversation, and only its text's digest runs over it in one stream.

Turns stand by turn number (nulls first), equal numbers by role and text.  Defined results: a null
role or text is one space; a null conversation key is a conversation; roles other than system, user
and assistant count by their first letter; rows that repeat another are duplicates of it; a
conversation none of whose rows is present gives zeros, an empty audit and the digest of nothing;
other columns, whatever their names, are ignored; an empty table gives no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.llm import common

START, SYSTEM, USER, ASSISTANT = range(4)
#: The state after an insert or a rerole, and after keeping a turn of role s, u, a or another; -1: not allowed.
ADVANCE = np.array([USER, USER, ASSISTANT, USER])
KEEP = np.array([[SYSTEM, USER, -1, -1], [-1, USER, -1, -1], [-1, -1, ASSISTANT, -1], [-1, USER, -1, -1]])
REROLE_COST, DELETE_COST, INSERT_COST, TRUNCATED_COST = 3, 4, 3, 3
NEVER = 1 << 60
#: Costs to go, and inserts, at the end of a conversation, by state.
AT_END = np.array([0, 2 * INSERT_COST, INSERT_COST, 0])
INSERTS_AT_END = (0, 2, 1, 0)
#: Conversations of more turns are worked on in blocks.
BLOCK = 4096
#: A task repairs about that many turns, or bytes of text, at a time.
TURNS, TEXT_BYTES = 1 << 15, 1 << 25
ROLES = {"s": 0, "u": 1, "a": 2}
RESULT = "gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, repaired_sha256 string"
LEFT = "block int, at long, role string, text string"


def closed(costs: np.ndarray) -> np.ndarray:
    """Costs to go by state (last axis), when turns may be inserted first."""
    out = costs
    for _ in range(3):
        out = np.minimum(costs, INSERT_COST + out[..., ADVANCE])
    return out


class Tensor:
    """A bucket of conversations: turns by time and conversation, aligned at their ends.

    ``role`` is 0 to 3 (s, u, a, another), ``gone`` marks turns that must be deleted, ``cut`` those
    truncated, ``more`` the number of further deletions that follow a turn (its repeats).
    """

    def __init__(self, length: np.ndarray, start: np.ndarray, role: np.ndarray, gone: np.ndarray, cut: np.ndarray, more: np.ndarray):
        self.length, self.time, n = length, int(length.max(initial=0)), len(length)
        at = np.arange(self.time)[:, None] - (self.time - length)[None, :]
        self.inside = at >= 0
        at = np.where(self.inside, at + start[None, :], 0)
        take = (lambda x: x[at]) if len(role) else (lambda x: np.zeros((self.time, n), x.dtype))
        self.role, self.gone, self.cut, self.more = take(role), take(gone), take(cut), take(more)
        self.costs = None

    def backward(self, end: np.ndarray) -> np.ndarray:
        """Costs to go before the first turn, by conversation and state, from those at the end."""
        self.costs = np.empty((self.time + 1, *end.shape), np.int64)
        self.costs[self.time] = end
        extra, delete = TRUNCATED_COST * self.cut.astype(np.int64), DELETE_COST * (1 + self.more.astype(np.int64))
        target = KEEP.T[self.role]  # time, conversation, state
        for t in range(self.time - 1, -1, -1):
            after = self.costs[t + 1]
            stay = (extra[t] + delete[t] - DELETE_COST)[:, None]
            keep = np.where(target[t] < 0, NEVER, np.take_along_axis(after, np.maximum(target[t], 0), 1) + stay)
            stays = np.minimum(keep, after[:, ADVANCE] + stay + REROLE_COST)
            best = np.minimum(after + delete[t][:, None], np.where(self.gone[t][:, None], NEVER, stays))
            self.costs[t] = np.where(self.inside[t][:, None], closed(np.minimum(best, NEVER)), after)
        return self.costs[0]

    def trace(self, state: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(edits by step and conversation, states at the end); 0 stands for no edit."""
        state, t, steps = state.copy(), self.time - self.length, []
        live = np.flatnonzero(t < self.time)
        while len(live):
            at, s = t[live], state[live]
            now, after = self.costs[at, live], self.costs[at + 1, live]
            own = np.arange(len(live))
            cost = now[own, s]
            more = DELETE_COST * self.more[at, live].astype(np.int64)
            delete = after[own, s] + DELETE_COST + more == cost
            insert = ~delete & (now[own, ADVANCE[s]] + INSERT_COST == cost)
            target = KEEP[s, self.role[at, live]]
            stay = TRUNCATED_COST * self.cut[at, live] + more
            keep = ~delete & ~insert & (target >= 0) & ~self.gone[at, live] & (after[own, np.maximum(target, 0)] + stay == cost)
            edit = np.select([delete, insert, keep], [ord("D"), ord("I"), ord("K")], ord("R")).astype(np.uint8)
            state[live] = np.where(delete, s, np.where(keep, target, ADVANCE[s]))
            step = np.zeros(len(t), np.uint8)
            step[live] = edit
            steps.append(step)
            t[live] += ~insert
            live = live[t[live] < self.time]
        return (np.stack(steps) if steps else np.zeros((0, len(t)), np.uint8)), state


def audit_of(column: np.ndarray, more: np.ndarray) -> str:
    """The letters of one conversation's edits, further deletions behind the turn that they repeat."""
    edits = column[column > 0]
    if more.any():
        count = np.ones(len(edits), np.int64)
        turn = edits != ord("I")
        count[turn] += more
        ends = np.cumsum(count)
        out = np.full(int(ends[-1]), ord("D"), np.uint8)
        out[ends - count] = edits
        edits = out
    return edits.tobytes().decode("ascii")


def apply(audit: str, turns: list[tuple[str, str]], state: int = START) -> tuple[list[tuple[str, str]], int]:
    """The (role, text) that edits leave of turns, and the state at the end."""
    out, rest = [], iter(turns)
    for edit in audit:
        role, text = ("", "") if edit == "I" else next(rest)
        if edit == "D":
            continue
        if edit != "K":
            role = "assistant" if state == USER else "user"
        state = ADVANCE[state] if edit != "K" else KEEP[state, ROLES.get(role[:1], 3)]
        out.append((role, text))
    return out, int(state)


class Turns:
    """Columns of a sorted table of turns as arrays; ``length`` by conversation."""

    def __init__(self, table: pa.Table, length: np.ndarray):
        self.length, self.start, n = length, np.cumsum(length) - length, table.num_rows
        self.owner = np.repeat(np.arange(len(length)), length)
        self.role = np.zeros(n, np.int8)
        initial = pc.utf8_slice_codeunits(table["role"], 0, 1)
        for letter, code in (("s", 0), ("u", 1), ("a", 2)):
            self.role[pc.equal(initial, letter).to_numpy(zero_copy_only=False)] = code + 1
        self.role = np.where(self.role == 0, 3, self.role - 1).astype(np.int8)
        flag = lambda c: table[c].to_numpy(zero_copy_only=False).astype(bool)
        self.blank, self.cut = flag("blank"), flag("cut")
        if "seen" in table.column_names:
            self.seen = flag("seen")
        else:
            self.seen = np.ones(n, bool)
            keys = np.stack([self.owner, *(table[c].to_numpy() for c in ("h1", "h2"))])
            self.seen[np.unique(keys, axis=1, return_index=True)[1] if n else []] = False
        self.more = table["copies"].to_numpy() - 1 if "copies" in table.column_names else np.zeros(n, np.int64)
        self.turn_null = table["turn"].is_null().to_numpy(zero_copy_only=False)
        self.turn = table["turn"].fill_null(0).to_numpy()
        self.seen &= ~self.blank
        self.gone = self.blank | self.seen
        self.cut &= ~self.gone

    def sums(self, x: np.ndarray) -> np.ndarray:
        return np.bincount(self.owner, weights=x, minlength=len(self.length)).astype(np.int64)

    def figures(self) -> dict[str, np.ndarray]:
        n = len(self.role)
        same = self.owner[1:] == self.owner[:-1]
        a, b = self.role[:-1], self.role[1:]
        legal = ((a == 0) & (b == 1)) | ((a == 1) & (b == 2)) | ((a == 2) & (b == 1))
        illegal = np.zeros(n, np.int64)
        illegal[1:] = same & ~legal
        new = ~self.turn_null
        new[1:] &= ~same | self.turn_null[:-1] | (self.turn[1:] != self.turn[:-1])
        found = {
            "blank": self.sums(self.blank * (1 + self.more)),
            "duplicate": self.sums(self.seen * (1 + self.more) + ~self.gone * self.more),
            "truncated": self.sums(self.cut),
            "illegal": self.sums(illegal + self.more),
            "turns": self.sums(new),
        }
        numbered, last = np.flatnonzero(~self.turn_null), np.zeros(len(self.length), np.int64)
        first = last.copy()
        last[self.owner[numbered]] = self.turn[numbered]
        first[self.owner[numbered[::-1]]] = self.turn[numbered[::-1]]
        return found | {"first": first, "last": last}

    def tensor(self, which: np.ndarray) -> Tensor:
        return Tensor(self.length[which], self.start[which], self.role, self.gone, self.cut, self.more)


def repaired(turns: Turns) -> tuple[np.ndarray, list[str]]:
    """Costs and audits of whole conversations, a bucket of like lengths at a time."""
    n = len(turns.length)
    costs, audits = np.zeros(n, np.int64), [""] * n
    size = np.ceil(np.log2(np.maximum(turns.length, 1))).astype(int)
    for k in np.unique(size[turns.length > 0]):
        which = np.flatnonzero((size == k) & (turns.length > 0))
        tensor = turns.tensor(which)
        costs[which] = tensor.backward(np.broadcast_to(AT_END, (len(which), 4)))[:, START]
        edits, state = tensor.trace(np.full(len(which), START))
        for j, c in enumerate(which.tolist()):
            a = turns.start[c]
            audits[c] = audit_of(edits[:, j], turns.more[a : a + turns.length[c]]) + "I" * INSERTS_AT_END[state[j]]
    return costs, audits


def _groups(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.Table, np.ndarray]]:
    """Whole conversations of a partition in which they stand together: (rows, length of each)."""
    held: list[pa.Table] = []

    def give(table: pa.Table, everything: bool):
        code = table["conv"].combine_chunks().dictionary_encode().indices.fill_null(-1).to_numpy()
        start = np.flatnonzero(np.concatenate([[True], code[1:] != code[:-1]]))
        end = len(code) if everything else int(start[-1])
        start = start[start < end]
        return table.slice(0, end), np.diff(np.append(start, end)), table.slice(end)

    for batch in batches:
        if batch.num_rows:
            held.append(pa.Table.from_batches([batch]))
            if sum(t.num_rows for t in held) >= TURNS or sum(t.nbytes for t in held) >= TEXT_BYTES:
                whole, length, rest = give(pa.concat_tables(held), False)
                held = [rest]
                if len(length):
                    yield whole, length
    if held:
        whole, length, _ = give(pa.concat_tables(held), True)
        yield whole, length


def _prepared(convs: DataFrame, conv: str, turn: str, role: str, text: str, present: str | None) -> DataFrame:
    space, one = F.lit(" "), F.col
    said = one("text")
    base = convs.select(
        one(conv).alias("conv"), one(turn).cast("long").alias("turn"), F.coalesce(one(role), space).alias("role"), F.coalesce(one(text), space).alias("text"),
        (one(present) if present else F.lit(True)).alias("present"),
    )
    return base.select(
        "*", (~said.rlike(r"[^\x20\x09-\x0D]")).alias("blank"), (~said.rlike(r"[.!?][\x20\x09-\x0D]*\z")).alias("cut"),
        F.xxhash64("role", "text").alias("h1"), F.xxhash64(F.lit(7), "text", "role").alias("h2"),
    )


def _order():
    return [F.col("turn").asc_nulls_first(), F.col("role"), F.col("text")]


def _short(rows: DataFrame, key: str, turns_too: bool) -> DataFrame:
    """Conversations that a task can hold: one exchange, then tensors."""
    kind = rows.schema["conv"].dataType.simpleString()
    together = rows.repartition("conv").sortWithinPartitions("conv", *_order())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table, length in _groups(batches):
            here = table["present"].to_numpy(zero_copy_only=False).astype(bool)
            owner = np.repeat(np.arange(len(length)), length)
            keys = table["conv"].take(pa.array(np.cumsum(length) - length))
            table = table.filter(pa.array(here))
            turns = Turns(table, np.bincount(owner[here], minlength=len(length)))
            costs, audits = repaired(turns)
            f = turns.figures()
            role, text = table["role"].to_pylist(), table["text"].to_pylist()
            digests = []
            if turns_too:
                for c, audit in enumerate(audits):
                    a, b = turns.start[c], turns.start[c] + turns.length[c]
                    left, _ = apply(audit, list(zip(role[a:b], text[a:b], strict=True)))
                    said = [pa.array(x, pa.string()) for x in zip(*left, strict=True)] or [pa.array([], pa.string())] * 2
                    places = [pa.array(np.zeros(len(left), np.int32)), pa.array(np.arange(len(left)))]
                    yield pa.RecordBatch.from_arrays([keys.combine_chunks().take(pa.array(np.full(len(left), c))), *places, *said], names=[key, "block", "at", "role", "text"])
                continue
            for c, audit in enumerate(audits):
                a, b = turns.start[c], turns.start[c] + turns.length[c]
                left, _ = apply(audit, list(zip(role[a:b], text[a:b], strict=True)))
                digests.append(hashlib.sha256("\n".join([f"{r}:{t}" for r, t in left]).encode()).hexdigest())
            gaps = np.where(f["turns"] > 0, f["last"] - f["first"] + 1 - f["turns"], 0)
            columns = [keys.combine_chunks(), *map(pa.array, (gaps, f["blank"], f["duplicate"], f["truncated"], f["illegal"], costs, audits, digests))]
            yield pa.RecordBatch.from_arrays(columns, names=[key, *[x.split()[0] for x in RESULT.split(", ")]])

    return together.mapInArrow(run, f"`{key}` {kind}, {LEFT if turns_too else RESULT}")


MATRIX = "cid long, block int, costs array<long>, blank long, duplicate long, truncated long, illegal long, turns long, first long, last long, first_role int, last_role int"
ENDS = "cid long, block int, last_block boolean, ends array<long>"
EXITS = "cid long, block int, last_block boolean, ends array<long>, exits array<int>"
ENTRY = "cid long, block int, last_block boolean, ends array<long>, entry int"
PIECE = "cid long, block int, audit string, said binary, any boolean"
SAID = "cid long, block int, at long, role string, text string"


def _table(schema: str, rows: list[tuple]) -> pa.Table:
    kinds = {"long": pa.int64(), "int": pa.int32(), "boolean": pa.bool_(), "string": pa.string(), "binary": pa.binary(), "array<long>": pa.list_(pa.int64()), "array<int>": pa.list_(pa.int32())}
    names, types = zip(*(f.split() for f in schema.split(", ")), strict=True)
    columns = list(zip(*rows, strict=True)) if rows else [()] * len(names)
    return pa.table([pa.array(list(c), kinds[t]) for c, t in zip(columns, types, strict=True)], names=list(names))


def _in_order(table: pa.Table) -> pa.Table:
    return table.sort_by("block") if "turn" not in table.column_names else table.sort_by("place")


def _block_turns(table: pa.Table) -> Turns:
    table = _in_order(table).combine_chunks()
    return Turns(pa.table({c: table[c].combine_chunks() for c in table.column_names}), np.array([table.num_rows]))


def _matrix(table: pa.Table) -> pa.Table:
    """Least costs of a block from each state to each state, and what it adds to the figures."""
    turns = _block_turns(table)
    f = {k: int(v[0]) for k, v in turns.figures().items()}
    tensor = turns.tensor(np.zeros(4, np.int64))
    costs = tensor.backward(np.where(np.eye(4, dtype=bool), 0, NEVER)).T  # from, to
    numbered = f["turns"] > 0
    row = (table["cid"][0].as_py(), table["block"][0].as_py(), costs.ravel().tolist(), f["blank"], f["duplicate"], f["truncated"], f["illegal"], f["turns"], f["first"] if numbered else None, f["last"] if numbered else None)
    return _table(MATRIX, [(*row, int(turns.role[0]), int(turns.role[-1]))])


def _chain(table: pa.Table) -> pa.Table:
    """Costs to go at the end of each block of a conversation, back to front."""
    rows, end, out = _in_order(table).to_pylist(), AT_END.astype(np.int64), []
    for k, r in enumerate(reversed(rows)):
        out.append((r["cid"], r["block"], k == 0, end.tolist()))
        end = np.minimum((np.array(r["costs"]).reshape(4, 4) + end[None, :]).min(1), NEVER)
    return _table(ENDS, out)


def _totals(table: pa.Table) -> pa.Table:
    """One row of figures for each conversation, from its blocks."""
    rows = _in_order(table).to_pylist()
    end = AT_END.astype(np.int64)
    for r in reversed(rows):
        end = np.minimum((np.array(r["costs"]).reshape(4, 4) + end[None, :]).min(1), NEVER)
    illegal, turns, first, last = 0, 0, None, None
    for k, r in enumerate(rows):
        if k:
            illegal += (rows[k - 1]["last_role"], r["first_role"]) not in ((0, 1), (1, 2), (2, 1))
        illegal += r["illegal"]
        if r["turns"]:
            turns += r["turns"] - (last is not None and last == r["first"])
            first, last = (r["first"] if first is None else first), r["last"]
    total = lambda c: sum(r[c] for r in rows)
    gaps = 0 if first is None else last - first + 1 - turns
    return _table("cid long, gaps long, blank long, duplicate long, truncated long, illegal long, cost long", [(rows[0]["cid"], gaps, total("blank"), total("duplicate"), total("truncated"), illegal, int(end[START]))])


def _exits(block: pa.Table, ends: pa.Table) -> pa.Table:
    """The state in which a block ends, for each in which it may begin."""
    turns, e = _block_turns(block), ends.to_pylist()[0]
    tensor = turns.tensor(np.zeros(4, np.int64))
    tensor.backward(np.broadcast_to(np.array(e["ends"]), (4, 4)))
    return _table(EXITS, [(e["cid"], e["block"], e["last_block"], e["ends"], tensor.trace(np.arange(4))[1].tolist())])


def _entries(table: pa.Table) -> pa.Table:
    state, out = START, []
    for r in _in_order(table).to_pylist():
        out.append((r["cid"], r["block"], r["last_block"], r["ends"], state))
        state = r["exits"][state]
    return _table(ENTRY, out)


def _traced(block: pa.Table, entry: pa.Table) -> tuple[dict, str, list[tuple[str, str]]]:
    """What a block's entry says, its audit, and the turns that are left of it."""
    turns, e = _block_turns(block), entry.to_pylist()[0]
    tensor = turns.tensor(np.zeros(1, np.int64))
    tensor.backward(np.array([e["ends"]]))
    edits, state = tensor.trace(np.array([e["entry"]]))
    shown = edits[:, 0][edits[:, 0] > 0].tobytes().decode("ascii")
    after = "I" * (INSERTS_AT_END[state[0]] if e["last_block"] else 0)
    rows = _in_order(block)
    left, _ = apply(shown + after, list(zip(rows["role"].to_pylist(), rows["text"].to_pylist(), strict=True)), e["entry"])
    return e, audit_of(edits[:, 0], turns.more) + after, left


def _pieces(block: pa.Table, entry: pa.Table) -> pa.Table:
    e, audit, left = _traced(block, entry)
    return _table(PIECE, [(e["cid"], e["block"], audit, "\n".join([f"{r}:{t}" for r, t in left]).encode(), bool(left))])


def _said(block: pa.Table, entry: pa.Table) -> pa.Table:
    e, _, left = _traced(block, entry)
    return _table(SAID, [(e["cid"], e["block"], k, *turn) for k, turn in enumerate(left)])


def _long(rows: DataFrame, long: DataFrame, n_rows: int, key: str, turns_too: bool) -> DataFrame:
    """Conversations in blocks: ``rows`` with a ``cid`` that ``long`` (conv, cid) numbers."""
    n = max(2, min(n_rows // BLOCK + 1, 8 * common.partitions(rows.sparkSession)))
    once = rows.groupBy("cid", "turn", "role", "text", "blank", "cut", "h1", "h2").agg(F.count("*").alias("copies"))
    once = common.stored(once, "turns")
    place = F.struct(F.col("turn").isNotNull().alias("a"), F.col("turn").alias("b"))
    earliest = common.stored(once.groupBy("cid", "h1", "h2").agg(F.min(place).alias("earliest")), "earliest")
    marked = once.join(earliest, ["cid", "h1", "h2"]).withColumn("seen", ~place.eqNullSafe(F.col("earliest"))).drop("earliest", "h1", "h2")
    ranged = marked.repartitionByRange(n, "cid", *_order()).sortWithinPartitions("cid", *_order())
    blocks = common.stored(ranged.withColumn("block", F.spark_partition_id()).withColumn("place", F.monotonically_increasing_id()), "blocks")
    by_block = blocks.groupBy("cid", "block")
    matrices = common.stored(by_block.applyInArrow(_matrix, MATRIX), "matrices")
    ends = matrices.groupBy("cid").applyInArrow(_chain, ENDS)
    exits = by_block.cogroup(ends.groupBy("cid", "block")).applyInArrow(_exits, EXITS)
    entries = exits.groupBy("cid").applyInArrow(_entries, ENTRY)
    if turns_too:
        left = by_block.cogroup(entries.groupBy("cid", "block")).applyInArrow(_said, SAID)
        return left.join(long, "cid").select(F.col("conv").alias(key), "block", "at", "role", "text")
    pieces = common.stored(by_block.cogroup(entries.groupBy("cid", "block")).applyInArrow(_pieces, PIECE), "pieces")
    made = pa.schema([("cid", pa.int64()), ("audit", pa.string()), ("repaired_sha256", pa.string())])

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cid, audit, h, some = None, [], None, False
        for batch in batches:
            for r in batch.to_pylist():
                if r["cid"] != cid:
                    if cid is not None:
                        yield common.rows(made, [cid], ["".join(audit)], [h.hexdigest()])
                    cid, audit, h, some = r["cid"], [], hashlib.sha256(), False
                audit.append(r["audit"])
                if r["any"]:
                    h.update((b"\n" if some else b"") + r["said"])
                    some = True
        if cid is not None:
            yield common.rows(made, [cid], ["".join(audit)], [h.hexdigest()])

    audits = pieces.repartition("cid").sortWithinPartitions("cid", "block").mapInArrow(digest, "cid long, audit string, repaired_sha256 string")
    totals = matrices.groupBy("cid").applyInArrow(_totals, "cid long, gaps long, blank long, duplicate long, truncated long, illegal long, cost long")
    return long.join(totals, "cid").join(audits, "cid").select(F.col("conv").alias(key), *[x.split()[0] for x in RESULT.split(", ")])


def _repaired(convs: DataFrame, conv: str, turn: str, role: str, text: str, present: str | None, turns_too: bool) -> DataFrame:
    rows = _prepared(convs, conv, turn, role, text, present)
    long = rows.groupBy("conv").agg(F.sum(F.col("present").cast("long")).alias("n")).where(F.col("n") > BLOCK)
    long = common.stored(long.withColumn("cid", F.monotonically_increasing_id()), "long")
    many, n_rows = long.agg(F.count("*"), F.sum("n")).first()
    if not many:
        return _short(rows, conv, turns_too)
    small = F.broadcast(long) if many <= 100_000 else long  # 24 bytes each
    same = rows["conv"].eqNullSafe(long["conv"])
    in_blocks = rows.where("present").join(small, same).drop(long["conv"])
    return _short(rows.join(small, same, "left_anti"), conv, turns_too).unionByName(_long(in_blocks, long, n_rows, conv, turns_too))


def repair(convs: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text", present: str | None = None) -> DataFrame:
    """One row for each conversation: its faults, the least cost, the edits, and the digest of what they leave.

    ``present`` names a boolean column; rows where it is false only name their conversation.
    """
    return _repaired(convs, conv, turn, role, text, present, False)


def repaired_turns(convs: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text", present: str | None = None) -> DataFrame:
    """The repaired conversations themselves, a row for each turn, in the order of (block, at)."""
    return _repaired(convs, conv, turn, role, text, present, True)


def damaged(convs: DataFrame) -> DataFrame:
    """Rows of ``conversations`` with faults dealt by a hash of their key; dropped ones are not ``present``."""
    space = F.lit(" ")
    role, text = F.coalesce("role", space), F.coalesce("text", space)
    name = F.concat_ws(":", *[F.coalesce(F.col(c).cast("string"), space) for c in ("conv_id", "turn")])
    told = convs.select("conv_id", "turn", role.alias("role"), text.alias("text"), (F.crc32(name.cast("binary")) % 20).alias("fate"))
    text = F.when(F.col("fate") == 1, "").when(F.col("fate") == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text"))
    times = F.when(F.col("fate") == 3, 2).otherwise(1)
    return told.select("conv_id", "turn", F.when(F.col("fate") == 4, "user").otherwise(F.col("role")).alias("role"), text.alias("text"), (F.col("fate") != 0).alias("present"), F.explode(F.array_repeat(F.lit(1), times))).drop("col")


def op12_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repair(damaged(common.table(spark, sf_dir, "conversations")), present="present")


#: A forward pass by recursion, a turn at a time: of equal costs the least string, as of two strings with
#: equal cost, state and turns neither begins the other.
OP12_SQL = r"""
WITH RECURSIVE crc AS (
  SELECT list(v ORDER BY i) AS steps
  FROM (SELECT i, list_reduce(range(8), lambda x, k: CASE WHEN x % 2 = 1 THEN xor(x >> 1, 3988292384) ELSE x >> 1 END, i) AS v FROM (SELECT unnest(range(256)) AS i))
), named AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text, hex(encode(coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' '))) AS bytes FROM conversations
), fates AS (
  SELECT conv_id, turn, role, text, xor(list_reduce(
    list_transform(range(1, length(bytes), 2), lambda i: CAST('0x' || substr(bytes, CAST(i AS INT), 2) AS BIGINT)),
    lambda x, b: xor(x >> 8, steps[CAST(xor(x, b) & 255 AS INT) + 1]), CAST(4294967295 AS BIGINT)), 4294967295) % 20 AS fate
  FROM named, crc
), damaged AS (
  SELECT conv_id, turn, CASE WHEN fate = 4 THEN 'user' ELSE role END AS role, CASE fate WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
         unnest(range(CASE fate WHEN 0 THEN 0 WHEN 3 THEN 2 ELSE 1 END)) AS copy
  FROM fates
), placed AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text, copy) AS k FROM damaged
), faults AS (
  SELECT conv_id, turn, role, text, k, left(role, 1) AS r, lag(left(role, 1)) OVER (PARTITION BY conv_id ORDER BY k) AS before,
         CASE WHEN NOT regexp_matches(text, '[^\x20\x09-\x0D]') THEN 'b' WHEN row_number() OVER (PARTITION BY conv_id, role, text ORDER BY k) > 1 THEN 'd'
              WHEN NOT regexp_matches(text, '[.!?][\x20\x09-\x0D]*$') THEN 't' ELSE '' END AS fault
  FROM placed
), steps AS (
  SELECT conv_id, k, r, CASE WHEN fault IN ('b', 'd') THEN 1000000000 WHEN fault = 't' THEN 3 ELSE 0 END AS stay FROM faults
), walk AS (
  SELECT conv_id, CAST(0 AS BIGINT) AS k, {'c': CAST(0 AS BIGINT), 'a': ''} AS m0, {'c': CAST(1000000000 AS BIGINT), 'a': ''} AS m1, {'c': CAST(3 AS BIGINT), 'a': 'I'} AS m2, {'c': CAST(6 AS BIGINT), 'a': 'II'} AS m3
  FROM (SELECT DISTINCT conv_id FROM faults)
  UNION ALL
  SELECT conv_id, k, n0, n1, n2, list_min([n3, {'c': n2.c + 3, 'a': n2.a || 'I'}]) FROM (
    SELECT conv_id, k, n0, n1, n3, list_min([u, {'c': n0.c + 3, 'a': n0.a || 'I'}, {'c': n1.c + 3, 'a': n1.a || 'I'}, {'c': n3.c + 3, 'a': n3.a || 'I'}]) AS n2 FROM (
      SELECT s.conv_id, s.k, {'c': m0.c + 4, 'a': m0.a || 'D'} AS n0,
             list_min([{'c': m1.c + 4, 'a': m1.a || 'D'}, {'c': CASE WHEN r = 's' THEN m0.c + stay ELSE 1000000000 END, 'a': m0.a || 'K'}]) AS n1,
             list_min([{'c': m2.c + 4, 'a': m2.a || 'D'}, {'c': m0.c + stay + CASE WHEN r = 'u' THEN 0 ELSE 3 END, 'a': m0.a || CASE WHEN r = 'u' THEN 'K' ELSE 'R' END},
                       {'c': m1.c + stay + CASE WHEN r = 'u' THEN 0 ELSE 3 END, 'a': m1.a || CASE WHEN r = 'u' THEN 'K' ELSE 'R' END},
                       {'c': m3.c + stay + CASE WHEN r = 'u' THEN 0 ELSE 3 END, 'a': m3.a || CASE WHEN r = 'u' THEN 'K' ELSE 'R' END}]) AS u,
             list_min([{'c': m3.c + 4, 'a': m3.a || 'D'}, {'c': m2.c + stay + CASE WHEN r = 'a' THEN 0 ELSE 3 END, 'a': m2.a || CASE WHEN r = 'a' THEN 'K' ELSE 'R' END}]) AS n3
      FROM walk JOIN steps s ON s.conv_id IS NOT DISTINCT FROM walk.conv_id AND s.k = walk.k + 1))
), ends AS (
  SELECT conv_id, arg_max(list_min([m0, m3]), k) AS e FROM walk GROUP BY conv_id
), letters AS (
  SELECT conv_id, i, substr(e.a, CAST(i AS INT), 1) AS edit, length(replace(substr(e.a, 1, CAST(i AS INT)), 'I', '')) AS k FROM (SELECT conv_id, e, unnest(range(1, length(e.a) + 1)) AS i FROM ends)
), kept AS (
  SELECT l.conv_id, l.i, l.edit, f.role, CASE WHEN l.edit = 'I' THEN '' ELSE f.text END AS text, row_number() OVER (PARTITION BY l.conv_id ORDER BY l.i) AS j
  FROM letters l LEFT JOIN faults f ON l.edit <> 'I' AND f.conv_id IS NOT DISTINCT FROM l.conv_id AND f.k = l.k WHERE l.edit <> 'D'
), system AS (
  SELECT conv_id, max(CASE WHEN j = 1 AND edit = 'K' AND left(role, 1) = 's' THEN 1 ELSE 0 END) AS has FROM kept GROUP BY conv_id
), said AS (
  SELECT k.conv_id, string_agg(CASE WHEN edit = 'K' THEN role WHEN (j - has) % 2 = 1 THEN 'user' ELSE 'assistant' END || ':' || text, chr(10) ORDER BY i) AS said
  FROM kept k JOIN system s ON s.conv_id IS NOT DISTINCT FROM k.conv_id GROUP BY k.conv_id
), figures AS (
  SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (fault = 'b') AS blank, count(*) FILTER (fault = 'd') AS duplicate, count(*) FILTER (fault = 't') AS truncated,
         count(*) FILTER (k > 1 AND before || r NOT IN ('su', 'ua', 'au')) AS illegal FROM faults GROUP BY conv_id
)
SELECT c.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate, coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal,
       coalesce(e.c, 0) AS cost, coalesce(e.a, '') AS audit, sha256(coalesce(said, '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) c
LEFT JOIN figures f ON f.conv_id IS NOT DISTINCT FROM c.conv_id LEFT JOIN ends ON ends.conv_id IS NOT DISTINCT FROM c.conv_id LEFT JOIN said ON said.conv_id IS NOT DISTINCT FROM c.conv_id
"""
