"""Conversation repair against a search over all strings of edits."""

import hashlib
import heapq
import random
import re
import zlib

import pytest

from tessera.llm import conversations

SCHEMA = "conv_id long, turn long, role string, text string, block string, cid string, n int, blank string, copies string"


def convs(spark, rows):
    return spark.createDataFrame([(*r, "b", "c", 1, "x", "y") for r in rows], SCHEMA).repartition(3)


def cheapest(turns, gone, cut):
    """(cost, audit, turns left) by a search of all edits in the order of (cost, audit)."""
    heap, done = [(0, "", 0, "", ())], {}
    while heap:
        cost, audit, k, initials, left = heapq.heappop(heap)
        said = initials[-1:] if initials else ""
        if k == len(turns) and re.fullmatch("(s?(ua)+)?", initials):
            return cost, audit, list(left)
        state = (k, len(initials) > 0, said)
        if state in done:
            continue
        done[state] = True
        want = {"": "u", "s": "u", "u": "a", "a": "u"}[said]
        full = {"u": "user", "a": "assistant"}[want]
        # only roles that may follow are tried; one insert or role may always follow
        heapq.heappush(heap, (cost + 3, audit + "I", k, initials + want, (*left, (full, ""))))
        if k < len(turns):
            role, text = turns[k]
            heapq.heappush(heap, (cost + 4, audit + "D", k + 1, initials, left))
            if not gone[k]:
                extra = 3 * cut[k]
                if role[:1] == want or (not initials and role[:1] == "s"):
                    heapq.heappush(heap, (cost + extra, audit + "K", k + 1, initials + role[:1], (*left, (role, text))))
                heapq.heappush(heap, (cost + 3 + extra, audit + "R", k + 1, initials + want, (*left, (full, text))))
    raise AssertionError


def brute(rows):
    """What the contract says, from rows (conv, turn, role, text, present)."""
    by = {}
    for c, turn, role, text, present in rows:
        mine = by.setdefault(c, [])
        if present:
            mine.append((turn is not None, turn or 0, " " if role is None else role, " " if text is None else text))
    out = {}
    for c, mine in by.items():
        mine.sort()
        seen, fault = set(), []
        for _, _, role, text in mine:
            bare = re.findall(r"[^\x20\x09-\x0D]", text)
            fault.append("b" if not bare else "d" if (role, text) in seen else "t" if bare[-1] not in ".!?" else "")
            seen.add((role, text))
        turns = [m[2:] for m in mine]
        cost, audit, left = cheapest(turns, [f in ("b", "d") and f != "" for f in fault], [f == "t" for f in fault])
        numbers = [m[1] for m in mine if m[0]]
        gaps = max(numbers) - min(numbers) + 1 - len(set(numbers)) if numbers else 0
        illegal = sum(a[0][:1] + b[0][:1] not in ("su", "ua", "au") for a, b in zip(turns, turns[1:]))
        sha = hashlib.sha256("\n".join(f"{r}:{t}" for r, t in left).encode()).hexdigest()
        out[c] = (gaps, fault.count("b"), fault.count("d"), fault.count("t"), illegal, cost, audit, sha), left
    return out


COLUMNS = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]


def found(df):
    got = df.collect()
    assert len({r.conv_id for r in got}) == len(got)
    return {r.conv_id: tuple(r[c] for c in COLUMNS) for r in got}


def damaged(rows):
    for c, turn, role, text in rows:
        role, text = " " if role is None else role, " " if text is None else text
        fate = zlib.crc32(f"{' ' if c is None else c}:{' ' if turn is None else turn}".encode()) % 20
        role = "user" if fate == 4 else role
        text = "" if fate == 1 else re.sub("[.!?]", "", text) if fate == 2 else text
        yield from [(c, turn, role, text, fate != 0)] * (2 if fate == 3 else 1)


def some(seed, n=250):
    rng = random.Random(seed)
    roles = ["system", "user", "assistant", "user", "assistant", "tool", "", None, "unknown", "System"]
    said = ["Yes.", "No!", "Why?", "cut off", "", " \t\n", None, "Same. ", "x\x0b.", "é", "日本語。", "a" * 5000 + ".", "line\n", "no-break "]
    rows = []
    for c in [*range(n), None]:
        for t in range(rng.choice([1, 1, 2, 3, 5, 9])):
            turn = rng.choice([t, t, t, t + 3, None, 1])
            rows.append((c, turn, rng.choice(roles), rng.choice(said) if rng.random() < 0.6 else f"Turn {rng.random()}."))
    return rows + rows[:20]


@pytest.mark.parametrize("block", [conversations.BLOCK, 3])
def test_repair(spark, monkeypatch, block):
    """Whole conversations, and the same in blocks."""
    monkeypatch.setattr(conversations, "BLOCK", block)
    rows = some(block)
    want = brute([(*r, True) for r in rows])
    df = convs(spark, rows)
    assert found(conversations.repair(df)) == {c: w for c, (w, _) in want.items()}
    turns = {}
    for r in sorted(conversations.repaired_turns(df).collect(), key=lambda r: (r.block, r["at"])):
        turns.setdefault(r.conv_id, []).append((r.role, r.text))
    assert turns == {c: left for c, (_, left) in want.items() if left}


def test_damage(spark):
    rows = some(5, 400)
    want = brute(damaged(rows))
    got = found(conversations.repair(conversations.damaged(convs(spark, rows)), present="present"))
    assert got == {c: w for c, (w, _) in want.items()}
    nothing = hashlib.sha256(b"").hexdigest()
    assert (0, 0, 0, 0, 0, 0, "", nothing) in got.values()


def test_one_long_conversation(spark, monkeypatch):
    """A third of all rows are one conversation, among them many equal ones."""
    monkeypatch.setattr(conversations, "BLOCK", 50)
    rng = random.Random(1)
    rows = [(7, t if t % 9 else None, rng.choice(["user", "assistant", "system"]), rng.choice(["Hello.", f"Number {t}.", "cut"])) for t in range(3000)] + [(7, 40, "user", "Same.")] * 500
    rows += [r for r in some(2, 60) if r[0] != 7]
    assert found(conversations.repair(convs(spark, rows))) == {c: w for c, (w, _) in brute([(*r, True) for r in rows]).items()}


def test_empty_table(spark):
    got = conversations.repair(convs(spark, []))
    assert got.columns == ["conv_id", *COLUMNS] and got.count() == 0


def test_query(spark):
    rows = [tuple(r) for r in spark.read.parquet("/root/testdata/sf0.01/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    got = found(conversations.op12_conversation_repair(spark, "/root/testdata/sf0.01"))
    assert got == {c: w for c, (w, _) in brute(damaged(rows)).items()}


def test_query_against_sql(spark):
    import duckdb

    con = duckdb.connect()
    con.sql("CREATE VIEW conversations AS SELECT * FROM '/root/testdata/sf0.1/conversations.parquet'")
    want = {r[0]: r[1:] for r in con.sql(f"SELECT conv_id, {', '.join(COLUMNS)} FROM ({conversations.OP12_SQL})").fetchall()}
    assert found(conversations.op12_conversation_repair(spark, "/root/testdata/sf0.1")) == want
