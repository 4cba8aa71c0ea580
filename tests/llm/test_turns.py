"""Repair of conversations against every sequence of edits, tried in turn."""

from __future__ import annotations

import hashlib
import itertools
import random
import re
import zlib
from functools import cache

import pytest
from compare import differences, duck

from tallyroom.llm import turns

COLUMNS = "conv_id long, turn long, role string, text string"
BLANK = re.compile(r"[^\x20\x09-\x0D]")


def damage(rows):
    out = []
    for conv, turn, role, text, *_ in rows:
        role, text = " " if role is None else role, " " if text is None else text
        name = f"{' ' if conv is None else conv}:{' ' if turn is None else turn}"
        kind = zlib.crc32(name.encode()) % 20
        if kind != 0:
            text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
            out += [(conv, turn, "user" if kind == 4 else role, text)] * (2 if kind == 3 else 1)
    return out


def repair(rows):
    """Totals, edits and repaired rows of one conversation: all edits are tried, insertions one by one."""
    rows = sorted(rows, key=lambda r: (r[1] is not None, r[1] or 0, r[2].encode(), hashlib.sha256(r[3].encode()).digest()))
    faults, seen = [], set()
    for _, _, role, text in rows:
        found = BLANK.findall(text)
        fault = "blank" if not found else "duplicate" if (role, text) in seen else "truncated" if found[-1] not in ".!?" else ""
        faults.append(fault)
        seen.add((role, text))

    @cache
    def best(i, state, inserts):  # (cost, audit, roles kept) of the best way from here on
        ways = []
        if i == len(rows) and state in ("", "a"):
            ways.append((0, "", ()))
        nexts = {"": "su", "s": "u", "u": "a", "a": "u"}[state]
        for c in nexts:
            if c in "ua" and inserts < 3:
                cost, audit, rest = best(i + 1 - 1, c, inserts + 1)
                ways.append((cost + 3, "I" + audit, ((c, None), *rest)))
        if i < len(rows):
            cost, audit, rest = best(i + 1, state, 0)
            ways.append((cost + 4, "D" + audit, rest))
            if faults[i] not in ("blank", "duplicate"):
                more = 3 * (faults[i] == "truncated")
                for c in nexts:
                    if rows[i][2][:1] == c:
                        cost, audit, rest = best(i + 1, c, 0)
                        ways.append((cost + more, "K" + audit, (("", i), *rest)))
                    if c in "ua":
                        cost, audit, rest = best(i + 1, c, 0)
                        ways.append((cost + 3 + more, "R" + audit, ((c, i), *rest)))
        return min(ways, key=lambda w: w[:2], default=(10**9, "", ()))

    cost, audit, kept = best(0, "", 0)
    names = {"u": "user", "a": "assistant"}
    lines = [(names.get(c) or rows[i][2], "" if i is None else rows[i][3]) for c, i in kept]
    found = [t for _, t, _, _ in rows if t is not None]
    gaps = min(max(found) - min(found) + 1 - len(set(found)), 2**63 - 1) if found else 0
    initials = [r[2][:1] for r in rows]
    illegal = sum(a + b not in ("su", "ua", "au") for a, b in itertools.pairwise(initials))
    counts = [faults.count(f) for f in ("blank", "duplicate", "truncated")]
    digest = hashlib.sha256("\n".join(f"{r}:{t}" for r, t in lines).encode()).hexdigest()
    return (gaps, *counts, illegal, cost, audit, digest), lines


def expected(original, rows):
    by = {r[0]: [] for r in original}
    for r in rows:
        by[r[0]].append(r)
    return sorted(((c, *repair(own)[0]) for c, own in by.items()), key=str)


def check(spark, rows, damages=False, extra=False):
    data = spark.createDataFrame(rows, COLUMNS).repartition(3)
    if extra:
        data = data.selectExpr("*", "1 as audit", "'x' as part", "2 as conv")
    made = damage(rows) if damages else [(a, b, c or " ", d if d is not None else " ") for a, b, c, d in rows]
    found = turns.Repair(turns.damaged(data) if damages else data)
    got = found.conversations(everyone=data)
    assert got.columns == [
        "conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256",
    ]
    assert sorted(map(tuple, got.collect()), key=str) == expected(rows, made)
    return found, made


def made_up(seed, conversations=60, longest=7):
    rng = random.Random(seed)
    texts = ["Hi.", "Well?", "no end", "", " \t", "Yes! ", "é…", "One.", "Two.", "Three."]
    rows = []
    for c in range(conversations):
        roles = ["user", "assistant"] if rng.random() < 0.5 else ["user", "assistant", "system", "tool", "u", "", "Assistant"]
        for t in range(rng.randrange(1, longest)):
            turn = None if rng.random() < 0.05 else t + rng.randrange(2) * (rng.random() < 0.2)
            rows.append((c, turn, rng.choice(roles), rng.choice(texts)))
    return rows


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_made_up_conversations(spark, seed):
    check(spark, made_up(seed))


def test_segments_of_any_length_give_the_same(spark, monkeypatch):
    """Runs are cut into segments of three rows, and partitions by range cut them anywhere."""
    rows = made_up(5, 12, 14)
    found, _ = check(spark, rows)
    whole = sorted(found.pieces.selectExpr("conv", "audit").collect())
    monkeypatch.setattr(turns, "SEGMENT", 3)
    monkeypatch.setattr(turns, "EMIT", 2)
    found, _ = check(spark, rows)
    assert found.pieces.count() > len(whole)


def test_ways_through_segments_in_tiny_steps():
    """The tree against a plain search, for long conversations with many ties, and with little memory."""
    rng = random.Random(4)
    for n in (1, 2, 31, 32, 33, 64, 150):
        for initials in ("u", "ua", "uasx", "a", "s"):
            texts = [rng.choice(["Same.", f"{i}.", f"{i}"]) for i in range(n)]
            rows = [(0, i, rng.choice(initials), t) for i, t in enumerate(texts)]
            totals, _ = repair(rows)
            seen, ways = set(), []
            for _, _, role, text in rows:
                ways.append((role, (role, text) in seen, text[-1] != "." and (role, text) not in seen, 1))
                seen.add((role, text))
            alive = turns.Survivors(turns.START)
            for w in ways:
                alive.step(turns.row_ways(alive.states, *w))
            state, cost, tail = turns.best_end(alive.states)
            alive.emit()
            assert (cost, "".join(alive.emitted + alive.edits(state)) + tail) == (totals[5], totals[6])


def test_edits_are_emitted_early():
    """Survivors of a regular conversation share all but its last rows."""
    alive = turns.Survivors(turns.START)
    for i in range(10_000):
        alive.step(turns.row_ways(alive.states, "ua"[i % 2], i % 50 == 49, i % 7 == 0, 1))
        assert max(len(alive.path(n)) for _, _, n in alive.states.values()) <= turns.EMIT + 60
    assert len(alive.emitted) > 9_900


def test_equal_rows_have_no_limit(spark):
    """A row repeated thousands of times is one narrow row; its copies are deleted one by one."""
    rows = [(1, 0, "user", "Hi.")] * 2000 + [(1, 1, "assistant", "Yes.")] * 3 + [(2, None, "user", " ")] * 500
    found = turns.Repair(spark.createDataFrame(rows, COLUMNS))
    got = {r.conv_id: r for r in found.conversations().collect()}
    assert got[1].audit == "K" + "D" * 1999 + "K" + "DD" and got[1].duplicate == 2001 and got[1].illegal == 1999 + 2
    assert got[2].audit == "D" * 500 and got[2].blank == 500 and got[2].cost == 2000
    assert [(r.role, r.text) for r in found.repaired().collect()] == [("user", "Hi."), ("assistant", "Yes.")]


def test_damage(spark):
    rng = random.Random(9)
    rows = [(c, t, rng.choice(["user", "assistant", "system", None]), rng.choice(["A.", "b", None, ". . x?"]))
            for c in [None, *range(80)] for t in [None, *range(5)]]
    check(spark, rows, damages=True, extra=True)


def test_odd_tables(spark):
    check(spark, [], damages=True)
    check(spark, [(None, None, None, None)])
    check(spark, [(None, None, None, None)], damages=True)
    long = " ".join(f"word{i}" for i in range(50_000))
    check(spark, [(1, 2**63 - 1, "user", long + "."), (1, -(2**62), "assistant", long), (1, 0, "user", "é\n.")])


def test_repaired_rows(spark):
    rows = made_up(8, 30)
    data = spark.createDataFrame(rows, COLUMNS)
    got = turns.Repair(data).repaired().orderBy("conv_id", "position").collect()
    by = {}
    for r in got:
        assert r.position == len(by.setdefault(r.conv_id, []))
        by[r.conv_id].append((r.role, r.text))
    for conv in {r[0] for r in rows}:
        assert by.get(conv, []) == repair([(a, b, c or " ", d) for a, b, c, d in rows if a == conv])[1]


def test_driver_table(spark):
    from tallyroom.llm.queries import op11_turns

    folder = "/root/testdata/sf0.01"
    rows = [tuple(r) for r in spark.read.parquet(f"{folder}/conversations.parquet").collect()]
    got = sorted(map(tuple, op11_turns(spark, folder).collect()), key=str)
    assert got == expected(rows, damage(rows))
    assert {len(r[7]) for r in got} != {0}
    con = duck({"conversations": f"{folder}/conversations.parquet"})
    assert not differences(op11_turns(spark, folder), con, turns.SQL)
