"""Operator 13 against plain recursion over whole edit strings, and against all edit strings of short conversations."""

import hashlib
import itertools
import random
import re
import zlib
from functools import lru_cache

import pytest

from featlab.llm import queries, turn_repair

SF = "/root/testdata/sf0.001"
NEXT = {"": "user", "s": "user", "u": "assistant", "a": "user"}
COST = {"K": 0, "R": 3, "D": 4, "I": 3}


def damage(rows):
    """(conv, turn, role, text) after damage, in order; rows of equal turns by role and text."""
    out = []
    for conv, turn, role, text in rows:
        role, text = " " if role is None else role, " " if text is None else text
        kind = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        if kind == 0:
            continue
        text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
        out += [(turn, "user" if kind == 4 else role, text)] * (2 if kind == 3 else 1)
    return sorted(out, key=lambda r: (r[0] is not None, r[0] or 0, r[1], r[2]))


def faults_of(rows):
    seen, out = set(), []
    for _, role, text in rows:
        core = text.strip(" \t\n\x0b\x0c\r")
        out.append("blank" if not core else "duplicate" if (role, text) in seen else "truncated" if core[-1] not in ".!?" else "")
        seen.add((role, text))
    return out


def step(state, initial):
    """The grammar: an s only first, then u and a in turn."""
    return initial if (state, initial) in {("", "s"), ("", "u"), ("s", "u"), ("u", "a"), ("a", "u")} else None


def best(rows, faults):
    @lru_cache(None)
    def go(i, state, inserts):
        found = []
        if inserts < 3:
            cost, edits = go(i, NEXT[state][0], inserts + 1)
            found.append((cost + 3, "I" + edits))
        if i == len(rows):
            return min(found + ([(0, "")] if state in ("", "a") else []), default=(10 ** 9, ""))
        extra = 3 if faults[i] == "truncated" else 0
        cost, edits = go(i + 1, state, 0)
        found.append((cost + 4, "D" + edits))
        if faults[i] not in ("blank", "duplicate"):
            for edit, initial in (("K", rows[i][1][:1]), ("R", NEXT[state][0])):
                after = step(state, initial)
                if after:
                    cost, edits = go(i + 1, after, 0)
                    found.append((cost + COST[edit] + extra, edit + edits))
        return min(found)
    for i in range(len(rows), 0, -50):  # from the end, so that no call goes deep
        for state in NEXT:
            go(i, state, 0)
    return go(0, "", 0)


def expected(conv, original):
    rows = damage([(conv, *r) for r in original])
    faults = faults_of(rows)
    cost, audit = best(rows, faults)
    lines, state, at = [], "", 0
    for edit in audit:
        if edit == "D":
            at += 1
            continue
        role = rows[at][1] if edit == "K" else NEXT[state]
        lines.append(f"{role}:{rows[at][2] if edit != 'I' else ''}")
        at += edit != "I"
        state = role[0]
    turns = {t for t, _, _ in rows if t is not None}
    initials = [r[1][:1] for r in rows]
    return (conv, max(turns) - min(turns) + 1 - len(turns) if turns else 0, *(faults.count(f) for f in ("blank", "duplicate", "truncated")),
            sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:])), cost, audit,
            hashlib.sha256("\n".join(lines).encode()).hexdigest())


def make(seed, n, longest, roles=("system", "user", "assistant", "user", "assistant", "tool", "", None)):
    rng = random.Random(seed)
    texts = ["Yes.", "No!", "why", "long text\nwith lines?  ", "", " \t", None, "A.", "B.", "é.", "c", "end. \x0b"]
    out = {}
    for conv in range(n):
        out[conv if conv else None] = [(None if rng.random() < .1 else rng.randrange(-3, 3 * longest), rng.choice(roles), rng.choice(texts) if rng.random() < .5 else f"t{rng.random()}.")
                                       for _ in range(rng.randint(1, longest))]
    return out


COLUMNS = "conv_id long, turn long, role string, text string, fault int, present string, conv string"


def check(spark, convs, **options):
    rows = [(c, *r, 1, "no", "x") for c, rs in convs.items() for r in rs]
    random.Random(1).shuffle(rows)
    df = spark.createDataFrame(rows, COLUMNS).repartition(3)
    got = turn_repair.repair(turn_repair.damaged(df), present="present", **options).collect()
    want = {c: expected(c, rs) for c, rs in convs.items()}
    assert len(got) == len(want)
    for g in got:
        assert tuple(g) == want[g.conv_id]


def test_random_conversations(spark):
    check(spark, make(1, 300, 9))


def test_short_ones_with_few_roles(spark):
    check(spark, make(2, 300, 4, ("user", "assistant", "system")))


def test_a_giant_conversation_goes_through_chunks(spark):
    convs = make(3, 4, 3)
    convs[99] = make(4, 2, 400)[1] + [(900, "user", "same."), (901, "user", "same.")] * 20
    check(spark, convs, spill_bytes=500)


def test_all_edit_strings_of_short_conversations():
    """No string of at most rows + 4 edits is cheaper, or as cheap and smaller."""
    def walk(rows, faults, audit):
        state, at, cost = "", 0, 0
        for e in audit:
            if e == "I":
                state, cost = NEXT[state][0], cost + 3
                continue
            if at == len(rows):
                return None
            if e == "D":
                cost += 4
            else:
                if faults[at] in ("blank", "duplicate"):
                    return None
                state = step(state, rows[at][1][:1] if e == "K" else NEXT[state][0])
                if state is None:
                    return None
                cost += COST[e] + (3 if faults[at] == "truncated" else 0)
            at += 1
        return (cost, audit) if at == len(rows) and state in ("", "a") else None

    rng = random.Random(5)
    for _ in range(60):
        rows = [(k, rng.choice(("system", "user", "assistant", "x")), rng.choice(("a.", "b", "", "c."))) for k in range(rng.randint(0, 3))]
        faults = faults_of(rows)
        found = [walk(rows, faults, "".join(s)) for n in range(len(rows) + 5) for s in itertools.product("DIKR", repeat=n)]
        want = min(f for f in found if f)
        assert best(rows, faults) == want
        costs, bytes_ = turn_repair.END, []
        for (_, role, _), fault in zip(reversed(rows), reversed(faults)):
            costs, byte = turn_repair.best_step(costs, role[:1], {"blank": "b", "duplicate": "d", "truncated": "t"}.get(fault, "-"))
            bytes_.append((byte, role, ""))
        one = turn_repair.Conversation(0, None, {})
        one.rows = bytes_
        assert (costs[0], "".join(e for e, _, _ in one.turns())) == want


def test_turn_rows_and_empty_tables(spark):
    df = spark.createDataFrame([(1, 0, "user", "Hi."), (1, 1, "user", "Again."), (2, 0, "assistant", "A.")], "conv_id long, turn long, role string, text string")
    got = [tuple(r) for r in turn_repair.repaired_turns(df).orderBy("conv_id", "position").collect()]
    # deleting the only row of 2 would cost 4, inserting a user costs 3
    assert got == [(1, 0, "K", "user", "Hi."), (1, 1, "R", "assistant", "Again."), (2, 0, "I", "user", ""), (2, 1, "K", "assistant", "A.")]
    empty = df.limit(0)
    assert turn_repair.repair(empty).count() == 0 and turn_repair.repaired_turns(empty).count() == 0


@pytest.mark.parametrize("sf", [SF])
def test_query_is_the_brute_force(spark, sf):
    convs = {}
    for r in spark.read.parquet(f"{sf}/conversations.parquet").collect():
        convs.setdefault(r.conv_id, []).append((r.turn, r.role, r.text))
    got = {r.conv_id: tuple(r) for r in queries.QUERIES["op13_turn_repair"](spark, sf).collect()}
    assert got == {c: expected(c, rs) for c, rs in convs.items()}
