"""Conversation repair against a plain dynamic programme over whole conversations."""

import hashlib
import random
import zlib

import pytest

from playpulse.llm import turn_repair

STATES = {"": {"s": "s", "u": "u"}, "s": {"u": "u"}, "a": {"u": "u"}, "u": {"a": "a"}}
ROLES = {"u": "user", "a": "assistant"}
NAMES = "conv_id long, turn long, role string, text string"
SPACE = " \t\n\x0b\x0c\r"


def plain(rows):
    """(figures, repaired lines) of rows (turn, role, text) in order."""
    seen, faults = set(), []
    for _, role, text in rows:
        bare = text.strip(SPACE)
        fault = ""
        if not bare:
            fault = "blank"
        elif (role, text) in seen:
            fault = "duplicate"
        elif bare[-1] not in ".!?":
            fault = "truncated"
        seen.add((role, text))
        faults.append(fault)
    pairs = zip([r[1][:1] for r in rows], [r[1][:1] for r in rows[1:]])
    turns = [r[0] for r in rows if r[0] is not None]

    best = {"": (0, "", ())}

    def offer(found, state, way):
        if state not in found or way < found[state]:
            found[state] = way

    def insertions(found):
        for _ in range(3):
            for state, (cost, audit, lines) in list(found.items()):
                for new in STATES[state]:
                    if new in ROLES:
                        offer(found, new, (cost + 3, audit + "I", (*lines, ROLES[new] + ":")))
        return found

    best = insertions(best)
    for (_, role, text), fault in zip(rows, faults):
        found = {}
        for state, (cost, audit, lines) in best.items():
            offer(found, state, (cost + 4, audit + "D", lines))
            if fault in ("blank", "duplicate"):
                continue
            more = 3 if fault == "truncated" else 0
            for new in STATES[state]:
                if role[:1] == new:
                    offer(found, new, (cost + more, audit + "K", (*lines, f"{role}:{text}")))
                if new in ROLES:
                    line = f"{ROLES[new]}:{text}"
                    offer(found, new, (cost + more + 3, audit + "R", (*lines, line)))
        best = insertions(found)
    cost, audit, lines = min(v for k, v in best.items() if k in ("", "a"))
    return {
        "gaps": max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0,
        **{name: faults.count(name) for name in ("blank", "duplicate", "truncated")},
        "illegal": sum(p not in {("s", "u"), ("u", "a"), ("a", "u")} for p in pairs),
        "cost": cost,
        "audit": audit,
        "repaired_sha256": hashlib.sha256("\n".join(lines).encode()).hexdigest(),
    }, list(lines)


def key(row):
    """The operator's order: turns, nulls first, then a digest (as the operator makes it)."""
    conv_id, turn, role, text = row

    def part(value):
        return f"{-1 if value is None else len(str(value))}:{'' if value is None else value}"

    said = hashlib.sha256(
        f"{part(conv_id)}:{hashlib.sha256(text.encode()).hexdigest()}{role}".encode()
    )
    whole = hashlib.sha256((said.hexdigest().upper() + part(turn)).encode()).digest()
    return (turn is not None, turn or 0, whole)


def by_conversation(rows):
    rows = [(c, t, " " if r is None else r, " " if x is None else x) for c, t, r, x in rows]
    return {
        c: [row[1:] for row in sorted((r for r in rows if r[0] == c), key=key)]
        for c in {r[0] for r in rows}
    }


def damaged(rows):
    out = []
    for conv_id, turn, role, text in rows:
        role, text = (" " if v is None else v for v in (role, text))
        fault = zlib.crc32(":".join(" " if v is None else str(v) for v in (conv_id, turn)).encode()) % 20
        if fault == 1:
            text = ""
        elif fault == 2:
            text = text.translate({ord(c): None for c in ".!?"})
        elif fault == 4:
            role = "user"
        out += [(conv_id, turn, role, text)] * {0: 0, 3: 2}.get(fault, 1)
    return out


def check(df, rows):
    got = {r.conv_id: r.asDict() for r in df.collect()}
    want = {c: plain(r)[0] for c, r in by_conversation(rows).items()}
    assert set(got) == set(want)
    for conv_id, figures in want.items():
        assert {k: got[conv_id][k] for k in figures} == figures, conv_id


def some_rows(seed, n=150):
    rng = random.Random(seed)
    texts = ["One.", "Two!", "three", "", " \n", "One.", "What?", "so", "x. "]
    roles = ["user", "assistant", "user", "assistant", "system", "tool", None, "", "ursula"]
    rows = []
    for conv_id in [None, *range(n // 8)]:
        for turn in range(rng.randint(1, 16)):
            turn = rng.choice([turn, turn, turn, turn, None, turn * 3])
            text = rng.choice([*texts, f"unlike {rng.random()}."] + [None] * (rng.random() < 0.1))
            rows.append((conv_id, turn, rng.choice(roles), text))
    return rows + rows[:5]


@pytest.mark.parametrize("seed", range(3))
def test_repairs_are_the_cheapest_and_least(spark, seed):
    rows = some_rows(seed)
    df = spark.createDataFrame(rows, NAMES)
    check(turn_repair.report(df), rows)
    lines = {}
    for r in turn_repair.repaired(df).orderBy("place", "step").collect():
        lines.setdefault(r.conv_id, []).append(f"{r.role}:{r.text}")
    for conv_id, turns in by_conversation(rows).items():
        assert lines.get(conv_id, []) == plain(turns)[1]


def test_damaged_test_table(spark):
    table = spark.read.parquet("/root/testdata/sf0.001/conversations.parquet")
    rows = [tuple(r) for r in table.select("conv_id", "turn", "role", "text").collect()]
    got = {r.conv_id: r.asDict() for r in turn_repair.damaged_report(table).collect()}
    want = by_conversation(damaged(rows))
    assert set(got) == {r[0] for r in rows}
    for conv_id, figures in got.items():
        expected = plain(want.get(conv_id, []))[0]
        assert {k: figures[k] for k in expected} == expected, conv_id


@pytest.mark.parametrize(
    "pattern",
    [
        ["user", "assistant"],  # vectors converge at once
        ["user"],  # two phases that never meet: the chunk is tabulated
        [None],  # every row goes
        ["assistant", "tool", "user", "user", "assistant"],
    ],
)
def test_a_conversation_over_many_chunks(spark, monkeypatch, pattern):
    """One conversation fills most chunks, and every fix-up pass is needed."""
    rows = [(0, 0, "user", "a."), (0, 1, "assistant", "b.")]
    for turn in range(901):
        role = pattern[turn % len(pattern)]
        rows.append((1, turn, role or "user", f"{turn}." if role else ""))
    rows += [(2, 0, "user", "a."), (2, 1, "assistant", "b"), (2, 2, "user", "c.")]
    df = spark.createDataFrame(rows, NAMES)
    monkeypatch.setattr(turn_repair, "END", turn_repair.END)
    order = ["conv_id", "turn", "row_key"]
    narrow = turn_repair._narrow(turn_repair._keyed(df))
    parts = turn_repair.cut(narrow.repartitionByRange(12, *order).sortWithinPartitions(*order))
    seams = turn_repair.Seams(parts)
    assert sum(e.single for e in seams.ends) >= 8
    assert seams.passes <= 3
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    spark.conf.set("spark.sql.shuffle.partitions", "12")
    try:
        check(turn_repair.report(df), rows)
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
        spark.conf.set("spark.sql.shuffle.partitions", "4")


def test_vectors_are_few_and_reruns_are_whole():
    rng = random.Random(7)
    assert len(turn_repair.vectors()) < 100
    for _ in range(200):
        codes = rng.choices(list(turn_repair.CODES), k=rng.randint(0, 30))
        old, new = rng.choices(turn_repair.vectors(), k=2)
        made = turn_repair.rerun(codes, old, new)
        assert made[new] == turn_repair.through(codes, new)
        assert all(turn_repair.through(codes, v) == w for v, w in made.items())


def test_awkward_rows(spark):
    empty = spark.createDataFrame([], NAMES)
    assert turn_repair.damaged_report(empty).collect() == []
    assert turn_repair.repaired(empty).collect() == []
    long = "Long, " * 600_000  # 3.6 MB, cut off
    rows = [(1, 0, "user", long), (1, 1, "assistant", long + "."), (1, 1, "assistant", long + ".")]
    check(turn_repair.report(spark.createDataFrame(rows, NAMES)), rows)
    names = "said string, n long, place long, lines string, piece string, found_id long, copy long"
    clash = [(*r, "x", 1, 2, "y", "z", 3, 4) for r in some_rows(9, 40)]
    df = spark.createDataFrame(clash, f"{NAMES}, {names}, row_key string, fault string".replace(", row_key string, fault string", ""))
    check(turn_repair.report(df), [r[:4] for r in clash])
