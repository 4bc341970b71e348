"""Prefix trie of conversations, by ternary search trees over range shards.

A node is a distinct sequence of first turns (role and text) of rebuilt conversations, the
root that of none. For each the operator tells its members, children, leaves, the tokens
that sharing saves in its subtree, and which conversations end there.

Method: turns are dictionary-encoded, so a conversation is a list of ids. Conversations with
equal lists are folded. The lists are dealt by ranges into shards, sorted; a shard inserts
its lists into a ternary search tree, the median first, then the medians of both halves and
so on, which balances it. A traversal without recursion accumulates members, leaves and
savings bottom-up. Only the nodes along a shard's first and last list can be nodes of a
neighbour too: their sums leave the shard as two rows, and a last pass over these rows, in
order, merges equal nodes and completes them.

Plan: texts are hashed where they are and stay there. Turns meet the dictionary in a join
that AQE can split (one turn may open a third of all conversations). Members of equal lists
are packed into strings of at most PACKED bytes by ranges of (list, conv_id) before their
digest is taken, so no group is collected; SHA-256 is defined from left to right, so the
strings of one list stream through one task. A shard holds at most SHARD_TURNS turns and
one list more. The merge holds one path; it reads two rows for each shard.

Defined cases: null roles and texts are empty, null turns come first, rows of one turn are
ordered by a digest of role and text, and repeated rows are turns each. Rows without a
conv_id belong to no conversation and are left out; conv_ids are integers. A conversation's
list of ids is one row (8 bytes a turn); texts may be of any length. Without conversations
there is no node, the root included. Other columns are not read, whatever their names.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from playpulse.llm.scratch import cut

#: Conversations share the first turns of the one whose number is next below a multiple of this.
FAMILY = 20
#: A conversation takes crc32 of its number modulo this many turns from there.
HEADS = 4
SHARD_TURNS = 1 << 20
PACKED = 1 << 20
NOBODY = hashlib.sha256(b"").hexdigest()

FIGURES = (
    "conv_id long, depth long, n_convs long, n_children long, n_leaves long, "
    "saved_tokens long, ends_sha256 string"
)
LISTS = "ids array<long>, words array<long>, n long, first long, ends string"


def _text(column: str):
    return F.coalesce(F.col(column).cast("string"), F.lit(""))


def sequences(conversations: DataFrame) -> DataFrame:
    """(conv_id, turns): of each conversation its turns in order, as (id, words)."""
    said = F.concat(F.length("role").cast("string"), F.lit(":"), "role", "text")
    turns = (
        conversations.where(F.col("conv_id").isNotNull())
        .select(
            F.col("conv_id").cast("long"),
            "turn",
            _text("role").alias("role"),
            _text("text").alias("text"),
        )
        .select(
            "conv_id",
            "turn",
            F.unhex(F.sha2(said, 256)).alias("said"),
            F.regexp_count("text", F.lit(r"[^\x20\x09-\x0D]+")).cast("long").alias("words"),
        )
    )
    dictionary = cut(
        turns.groupBy(F.col("said").alias("entry"))
        .agg(F.max("words").alias("words"))
        .withColumn("id", F.monotonically_increasing_id())
    )
    encoded = turns.drop("words").join(dictionary, F.col("said") == F.col("entry"))
    ordered = F.sort_array(F.collect_list(F.struct("turn", "said", "id", "words")))
    return encoded.groupBy("conv_id").agg(
        F.transform(ordered, lambda t: F.struct(t["id"], t["words"])).alias("turns")
    )


def rebuilt(conversations: DataFrame) -> DataFrame:
    """(conv_id, turns) after each conversation took its first turns from its family's head."""
    own = cut(sequences(conversations))
    base = F.col("conv_id") - F.col("conv_id") % FAMILY
    n = (F.crc32(F.col("conv_id").cast("string").cast("binary")) % HEADS).cast("int")
    heads = own.where(F.col("conv_id") % FAMILY == 0).select(
        F.col("conv_id").alias("base"), F.slice("turns", 1, HEADS - 1).alias("head")
    )
    rows = own.withColumn("n", n).join(heads, base == F.col("base"), "left")
    head = F.coalesce(F.slice("head", F.lit(1), F.col("n")), F.slice("turns", 1, 0))
    rest = F.slice("turns", F.col("n") + 1, F.greatest(F.size("turns") - F.col("n"), F.lit(0)))
    return rows.select("conv_id", F.concat(head, rest).alias("turns"))


def _packer(schema: pa.Schema, packed_bytes: int) -> Callable:
    """Members of equal lists, from rows sorted by (list, conv_id), as strings of bounded size."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        open_row: dict | None = None
        parts: list[str] = []
        size, out = 0, []

        def close() -> None:
            if open_row is not None:
                out.append(open_row | {"n": len(parts), "members": ",".join(parts)})

        for batch in batches:
            key, conv = batch.column("key").to_pylist(), batch.column("conv_id").to_pylist()
            for i, (k, c) in enumerate(zip(key, conv)):
                if open_row is None or k != open_row["key"] or size > packed_bytes:
                    close()
                    one = {name: batch.column(name)[i].as_py() for name in ("ids", "words")}
                    open_row, parts, size = {"key": k, "first": c, **one}, [], 0
                parts.append(str(c))
                size += len(parts[-1]) + 1
            if len(out) >= 1000:
                yield pa.RecordBatch.from_pylist(out, schema=schema)
                out.clear()
        close()
        if out:
            yield pa.RecordBatch.from_pylist(out, schema=schema)

    return run


def _joiner(schema: pa.Schema) -> Callable:
    """One row for each list, with the digest of its members, from their strings in order."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        open_row, digest, out = None, None, []

        def close() -> None:
            if open_row is not None:
                out.append({**open_row, "ends": digest.hexdigest()})

        for batch in batches:
            for row in batch.to_pylist():
                if open_row is not None and row["key"] == open_row["key"]:
                    digest.update(b"," + row["members"].encode())
                    open_row["n"] += row["n"]
                    continue
                close()
                open_row, digest = row, hashlib.sha256(row["members"].encode())
            if len(out) >= 1000:
                yield pa.RecordBatch.from_pylist(out, schema=schema)
                out.clear()
        close()
        if out:
            yield pa.RecordBatch.from_pylist(out, schema=schema)

    return run


def _arrow(schema: str) -> pa.Schema:
    return to_arrow_schema(T.StructType.fromDDL(schema))


def lists(sequences: DataFrame, packed_bytes: int = PACKED) -> DataFrame:
    """The distinct lists: ids, words, n conversations, the first of them and their digest."""
    rows = sequences.select(
        "conv_id", F.col("turns.id").alias("ids"), F.col("turns.words").alias("words")
    )
    text = F.array_join(F.transform("ids", lambda i: i.cast("string")), ",")
    rows = rows.withColumn("key", F.unhex(F.sha2(text, 256)))
    packed = "key binary, ids array<long>, words array<long>, n long, first long, members string"
    return (
        rows.repartitionByRange("key", "conv_id")
        .sortWithinPartitions("key", "conv_id")
        .mapInArrow(_packer(_arrow(packed), packed_bytes), packed)
        .repartition("key")
        .sortWithinPartitions("key", "first")
        .mapInArrow(_joiner(_arrow(LISTS)), LISTS)
    )


def median_first(n: int) -> Iterator[int]:
    """0 to n - 1, the median first, then those of both halves and so on."""
    spans = [(0, n)]
    for a, b in spans:  # grows while it is read
        if a < b:
            middle = (a + b) // 2
            yield middle
            spans += [(a, middle), (middle + 1, b)]


class Tree:
    """A ternary search tree of lists of ids. Node 0 is the root, the empty list."""

    def __init__(self) -> None:
        self.key: list[int] = [-1]
        self.low, self.high, self.equal = [0], [0], [0]  # 0: none
        self.words = [0]
        self.own: list[tuple[int, int, str] | None] = [None]  # members that end here

    def _new(self, key: int, words: int) -> int:
        self.key.append(key)
        for links in (self.low, self.high, self.equal):
            links.append(0)
        self.words.append(words)
        self.own.append(None)
        return len(self.key) - 1

    def insert(self, ids: list[int], words: list[int], members: tuple[int, int, str]) -> None:
        at = 0
        for key, n in zip(ids, words):
            below, links, place = self.equal[at], self.equal, at
            while below and self.key[below] != key:
                links, place = (self.low if key < self.key[below] else self.high), below
                below = links[place]
            if not below:
                below = links[place] = self._new(key, n)
            at = below
        self.own[at] = members

    def path(self, ids: list[int]) -> list[int]:
        """The nodes of a list that is in the tree, from the root."""
        nodes, at = [0], 0
        for key in ids:
            at = self.equal[at]
            while self.key[at] != key:
                at = self.low[at] if key < self.key[at] else self.high[at]
            nodes.append(at)
        return nodes

    def top_down(self) -> list[tuple[int, int, int]]:
        """(node, parent, depth), parents before their children; the root is its own."""
        order, waiting = [(0, 0, 0)], [(self.equal[0], 0, 1)]
        while waiting:
            node, parent, depth = waiting.pop()
            if not node:
                continue
            order.append((node, parent, depth))
            waiting += [
                (self.low[node], parent, depth),
                (self.high[node], parent, depth),
                (self.equal[node], node, depth + 1),
            ]
        return order


def _ref(part: int, shard: int, last: bool, depth: int) -> str:
    return f"{part}/{shard}/{int(last)}/{depth}"


EDGES = (
    "part int, shard int, last boolean, skip int, ids array<long>, words array<long>, "
    "n_convs array<long>, first array<long>, n_children array<long>, n_leaves array<long>, "
    "saved array<long>, ends array<string>"
)


def shard_nodes(part: int, shard: int, rows: list[dict]) -> tuple[list[dict], list[dict]]:
    """(complete nodes, sums along the first and the last list) of sorted distinct lists."""
    tree = Tree()
    for i in median_first(len(rows)):
        row = rows[i]
        tree.insert(row["ids"], row["words"], (row["n"], row["first"], row["ends"]))
    order = tree.top_down()
    n = len(order)
    members, first = [0] * n, [0] * n
    for i, own in enumerate(tree.own):
        members[i], first[i] = own[:2] if own else (0, 1 << 63)
    children, leaves, saved = [0] * n, [0] * n, [0] * n
    paths = [tree.path(rows[0]["ids"]), tree.path(rows[-1]["ids"])]
    shared = sum(a == b for a, b in zip(*paths))
    edge = {node: _ref(part, shard, False, depth) for depth, node in enumerate(paths[0])}
    for depth, node in enumerate(paths[1]):
        edge.setdefault(node, _ref(part, shard, True, depth))
    for node, parent, _ in reversed(order):
        inner = node not in edge
        if inner:
            leaves[node] = leaves[node] if children[node] else 1
            saved[node] += (members[node] - 1) * tree.words[node]
        if node:
            members[parent] += members[node]
            first[parent] = min(first[parent], first[node])
            # What an edge node adds is known only when it is complete.
            children[parent] += inner
            leaves[parent] += leaves[node] if inner else 0
            saved[parent] += saved[node] if inner else 0

    def ends(node: int) -> str | None:
        own = tree.own[node]
        return own[2] if own else None

    nodes = [
        {
            "conv_id": first[node],
            "depth": depth,
            "n_convs": members[node],
            "n_children": children[node],
            "n_leaves": leaves[node],
            "saved_tokens": saved[node],
            "ends_sha256": ends(node) or NOBODY,
            "parent_conv_id": None if parent in edge else first[parent],
            "parent_ref": edge.get(parent),
        }
        for node, parent, depth in order
        if node not in edge
    ]
    edges = []
    for last, path in enumerate(paths):
        skip = shared if last else 0
        along = path[skip:]
        edges.append(
            {
                "part": part,
                "shard": shard,
                "last": bool(last),
                "skip": skip,
                "ids": rows[-last]["ids"],
                "words": [tree.words[x] for x in along],
                "n_convs": [members[x] for x in along],
                "first": [first[x] for x in along],
                "n_children": [children[x] for x in along],
                "n_leaves": [leaves[x] for x in along],
                "saved": [saved[x] for x in along],
                "ends": [ends(x) for x in along],
            }
        )
    return nodes, edges


def _sharder(schema: pa.Schema, shard_turns: int) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, shard, rows, turns = TaskContext.get().partitionId(), 0, [], 0

        def close() -> Iterator[pa.RecordBatch]:
            nodes, edges = shard_nodes(part, shard, rows)
            for a in range(0, len(nodes), 10_000):
                out = [{"node": x} for x in nodes[a : a + 10_000]]
                yield pa.RecordBatch.from_pylist(out, schema=schema)
            yield pa.RecordBatch.from_pylist([{"edge": x} for x in edges], schema=schema)

        for batch in batches:
            for row in batch.to_pylist():
                rows.append(row)
                turns += len(row["ids"])
                if turns > shard_turns:
                    yield from close()
                    shard, rows, turns = shard + 1, [], 0
        if rows:
            yield from close()

    return run


def merge_edges(edges: Iterator[dict]) -> Iterator[dict]:
    """Complete nodes from the sums along shards' edges, in the order of the lists.

    Each has its refs (one for each shard that holds part of it) and that of its parent.
    """
    ids: list[int] = []
    path: list[dict] = []  # open nodes, from the root

    def leave(depth: int) -> Iterator[dict]:
        """Completes the open nodes below `depth`."""
        while len(path) > depth + 1:
            node = path.pop()
            if not node["n_children"]:
                node["n_leaves"] = 1
            node["saved_tokens"] += (node["n_convs"] - 1) * node.pop("words")
            node["ends_sha256"] = node["ends_sha256"] or NOBODY
            if path:
                above = path[-1]
                above["n_children"] += 1
                above["n_leaves"] += node["n_leaves"]
                above["saved_tokens"] += node["saved_tokens"]
                node["parent_ref"] = above["refs"][0]
            yield node

    for edge in edges:
        common = 0
        while common < min(len(ids), len(edge["ids"])) and ids[common] == edge["ids"][common]:
            common += 1
        yield from leave(common)
        ids = edge["ids"]
        for i, depth in enumerate(range(edge["skip"], len(ids) + 1)):
            if depth == len(path):
                path.append(
                    {
                        "conv_id": edge["first"][i],
                        "depth": depth,
                        "n_convs": 0,
                        "n_children": 0,
                        "n_leaves": 0,
                        "saved_tokens": 0,
                        "ends_sha256": None,
                        "words": edge["words"][i],
                        "parent_ref": None,
                        "refs": [],
                    }
                )
            node = path[depth]
            node["conv_id"] = min(node["conv_id"], edge["first"][i])
            node["n_convs"] += edge["n_convs"][i]
            node["n_children"] += edge["n_children"][i]
            node["n_leaves"] += edge["n_leaves"][i]
            node["saved_tokens"] += edge["saved"][i]
            node["ends_sha256"] = node["ends_sha256"] or edge["ends"][i]
            node["refs"].append(_ref(edge["part"], edge["shard"], edge["last"], depth))
    yield from leave(-1)


def _merger(schema: pa.Schema) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = (row for batch in batches for row in batch.to_pylist())
        out = []
        for node in merge_edges(rows):
            out.append(node)
            if len(out) >= 1000:
                yield pa.RecordBatch.from_pylist(out, schema=schema)
                out = []
        if out:
            yield pa.RecordBatch.from_pylist(out, schema=schema)

    return run


def trie(
    sequences: DataFrame, shard_turns: int = SHARD_TURNS, packed_bytes: int = PACKED
) -> DataFrame:
    """All nodes of the trie of (conv_id, turns) rows, turns as (id, words)."""
    node = f"{FIGURES}, parent_conv_id long, parent_ref string"
    made = ", ".join(f"{f.name}: {f.dataType.simpleString()}" for f in T.StructType.fromDDL(node))
    along = ", ".join(f"{f.name}: {f.dataType.simpleString()}" for f in T.StructType.fromDDL(EDGES))
    shards = f"node struct<{made}>, edge struct<{along}>"
    found = cut(
        lists(sequences, packed_bytes)
        .repartitionByRange("ids")
        .sortWithinPartitions("ids")
        .mapInArrow(_sharder(_arrow(shards), shard_turns), shards)
    )
    merged = f"{FIGURES}, parent_ref string, refs array<string>"
    edges = cut(
        found.where(F.col("edge").isNotNull())
        .select("edge.*")
        .coalesce(1)
        .sortWithinPartitions("part", "shard", "last")
        .mapInArrow(_merger(_arrow(merged)), merged)
    )
    parents = edges.select(F.explode("refs").alias("ref"), F.col("conv_id").alias("of_ref"))
    inner = found.where(F.col("node").isNotNull()).select("node.*")
    known = inner.where(F.col("parent_ref").isNull()).drop("parent_ref")
    open_ = inner.where(F.col("parent_ref").isNotNull()).drop("parent_conv_id")
    open_ = open_.unionByName(edges.drop("refs"))
    closed = (
        open_.join(parents, F.col("parent_ref") == F.col("ref"), "left")
        .withColumnRenamed("of_ref", "parent_conv_id")
        .drop("ref", "parent_ref")
    )
    return known.unionByName(closed).select(
        "conv_id",
        "depth",
        "parent_conv_id",
        "n_convs",
        "n_children",
        "n_leaves",
        "saved_tokens",
        "ends_sha256",
    )
