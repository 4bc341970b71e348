"""The prefix trie against all prefixes of all conversations."""

import hashlib
import random
import re
import zlib

import pytest

from playpulse.llm import prefix_trie

NAMES = "conv_id long, turn long, role string, text string"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def order(row):
    """The operator's order of turns: nulls first, then the digest of role and text."""
    turn, role, text = row
    said = hashlib.sha256(f"{len(role)}:{role}{text}".encode()).digest()
    return (turn is not None, turn or 0, said)


def rebuilt(rows):
    own = {}
    for conv_id, turn, role, text in rows:
        if conv_id is not None:
            own.setdefault(conv_id, []).append((turn, role or "", text or ""))
    own = {c: [t[1:] for t in sorted(turns, key=order)] for c, turns in own.items()}
    out = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 4
        out[c] = tuple(own.get(c - c % 20, [])[:h] + turns[h:])
    return out


def plain(sequences):
    """Rows of the operator, from every prefix of every sequence."""
    members, ends = {}, {}
    for c, turns in sequences.items():
        for d in range(len(turns) + 1):
            members.setdefault(turns[:d], []).append(c)
        ends.setdefault(turns, []).append(c)
    children, leaves, saved = {}, {}, {}
    for node in members:
        if node:
            children[node[:-1]] = children.get(node[:-1], 0) + 1
    for node in sorted(members, key=len, reverse=True):
        own = (len(members[node]) - 1) * len(WORD.findall(node[-1][1])) if node else 0
        leaves[node] = leaves.get(node, 0) or 1
        saved[node] = saved.get(node, 0) + own
        if node:
            leaves[node[:-1]] = leaves.get(node[:-1], 0) + leaves[node]
            saved[node[:-1]] = saved.get(node[:-1], 0) + saved[node]
    return sorted(
        (
            (
                min(members[node]),
                len(node),
                min(members[node[:-1]]) if node else None,
                len(members[node]),
                children.get(node, 0),
                leaves[node],
                saved[node],
                hashlib.sha256(",".join(map(str, sorted(ends.get(node, [])))).encode()).hexdigest(),
            )
            for node in members
        ),
        key=str,
    )


def found(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def some_rows(seed, n=120):
    rng = random.Random(seed)
    texts = ["", "one", "two words", "a b  c", None]
    rows = []
    for c in rng.sample(range(-30, 200), n):
        for turn in range(rng.randint(1, 6)):
            rows.append((c, rng.choice([turn, turn, turn, None]), rng.choice(["u", "a", None]), rng.choice(texts)))
    return rows + [(None, 1, "u", "lost")] + rows[:4]


def remainder(rows):
    """c - c % 20 with the remainder's sign of the dividend, as SQL has it."""
    return [r for r in rows if r[0] is None or r[0] >= 0]


@pytest.mark.parametrize(("seed", "shard_turns", "packed"), [(0, 1 << 20, 1 << 20), (1, 5, 4), (2, 40, 1)])
def test_nodes_are_those_of_all_prefixes(spark, seed, shard_turns, packed):
    rows = remainder(some_rows(seed))
    df = spark.createDataFrame(rows, NAMES).repartition(5)
    sequences = prefix_trie.rebuilt(df)
    assert found(prefix_trie.trie(sequences, shard_turns, packed)) == plain(rebuilt(rows))


def test_test_table(spark):
    table = spark.read.parquet("/root/testdata/sf0.001/conversations.parquet")
    rows = [tuple(r) for r in table.select("conv_id", "turn", "role", "text").collect()]
    got = prefix_trie.trie(prefix_trie.rebuilt(table), shard_turns=50)
    assert found(got) == plain(rebuilt(rows))


def test_trees_are_balanced_and_whole():
    rows = [{"ids": [i], "words": [1], "n": 1, "first": i, "ends": "x"} for i in range(1023)]
    tree = prefix_trie.Tree()
    order = list(prefix_trie.median_first(len(rows)))
    assert sorted(order) == list(range(1023))
    for i in order:
        tree.insert(rows[i]["ids"], rows[i]["words"], (1, i, "x"))

    def height(node):
        return 1 + max(height(tree.low[node]), height(tree.high[node])) if node else 0

    assert height(tree.equal[0]) == 10
    nodes, edges = prefix_trie.shard_nodes(0, 0, rows)
    assert len(nodes) == 1021 and len(edges) == 2


def test_a_group_of_copies_over_all_shards(spark):
    """One conversation in hundreds of copies, and a first turn that all share."""
    rows = [(c * 20 + 1, 0, "user", "Hello there") for c in range(400)]
    rows += [(c * 20 + 1, 1, "assistant", "Same" if c % 3 else f"Own {c}") for c in range(400)]
    df = spark.createDataFrame(rows, NAMES).repartition(7)
    got = prefix_trie.trie(prefix_trie.rebuilt(df), 30, 50)
    assert found(got) == plain(rebuilt(rows))


def test_awkward_rows(spark):
    empty = spark.createDataFrame([], NAMES)
    assert prefix_trie.trie(prefix_trie.rebuilt(empty)).collect() == []
    long = "word " * 700_000  # 3.5 MB
    rows = [(20, 0, "user", long), (21, 0, "user", long), (22, 0, None, None), (24, None, "", "")]
    df = spark.createDataFrame(rows, NAMES)
    assert found(prefix_trie.trie(prefix_trie.rebuilt(df))) == plain(rebuilt(rows))
    names = "id long, said string, entry string, base long, head string, turns string, n long, words long"
    clash = [(*r, 1, "x", "y", 2, "z", "t", 3, 4) for r in remainder(some_rows(5, 40))]
    df = spark.createDataFrame(clash, f"{NAMES}, {names}")
    assert found(prefix_trie.trie(prefix_trie.rebuilt(df))) == plain(rebuilt([r[:4] for r in clash]))
