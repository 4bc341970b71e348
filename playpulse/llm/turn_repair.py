"""Repair of conversation structure by a rank-convergence parallel Viterbi.

A conversation should read `(s?(ua)+)?` by the initials of its roles. Its rows, in the order
of their turns, may be kept (0), given another role (3) or deleted (4; always for blank rows
and repeats of an earlier role and text), and empty user or assistant turns may be inserted
anywhere (3). A row that stays though it ends in none of `.!?` costs 3 more. The cheapest
edits are found, of several the least by the ASCII order of their initials D, I, K, R.

Method: four states (start, after system, after user, after assistant) and the costs from
each to the end make a vector, which a row maps to another (a min-plus product). The rows of
all conversations are dealt by ranges of (conversation, turn), so a long conversation is
cut into chunks, one for each task. Chunks start from a speculative vector at their right
end; fix-up passes rerun those whose neighbour came to another one, only until the old and
the new vector differ by a constant, for from there on everything is as before. A chunk
whose vectors do not converge in all its rows is tabulated for every vector there can be
(there are a few dozen, up to constants), so it is never rerun. The settled costs are
stitched together, and edits are traced from the left: chunks tell to which state each of
the four entry states leads, and the real ones follow from chunk to chunk.

Plan: rows travel narrow (ids and digests; texts stay behind), equal rows folded; one
shuffle to fold, one to find repeats, one by range. The sorted rows are kept in the shared
folder, which fixes the chunks. The driver holds one short row for each chunk that a
conversation fills or crosses, never rows of the table. Texts are joined to the edits by
row. Only the digest of a whole conversation, which SHA-256 defines from left to right,
streams its lines through one task; nothing is collected there but the audit string.

Defined cases: null roles and texts count as one space; null conv_ids make one conversation,
null turns come first. Rows of one turn are ordered by a digest of role and text; rows equal
in all four columns stand side by side. Only an initial counts: roles beginning with s, u or
a are system, user and assistant; others must be changed or go. Texts may be of any length.
Without rows there are no conversations. Other columns are not read, whatever their names.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from functools import cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from playpulse.llm.scratch import cut

DELETE, RETITLE, INSERT, CUT_OFF = 4, 3, 3, 3

START, SYSTEM, USER, ASSISTANT = range(4)
#: The state after an inserted or renamed turn, and that turn's role.
NEXT = (USER, USER, ASSISTANT, USER)
ROLE = {USER: "user", ASSISTANT: "assistant"}
#: (state, initial) -> state, for rows that are kept.
KEEP = {
    (START, "s"): SYSTEM,
    (START, "u"): USER,
    (SYSTEM, "u"): USER,
    (ASSISTANT, "u"): USER,
    (USER, "a"): ASSISTANT,
}
LEGAL_PAIRS = {("s", "u"), ("u", "a"), ("a", "u")}

Vector = tuple[int, int, int, int]
#: Costs to the end where there are no more rows.
END: Vector = (0, 2 * INSERT, INSERT, 0)

INITIALS = "sua-"
#: A row's code: 2 * place of its initial + cut off, or that it must go.
MUST_GO = 2 * len(INITIALS)
CODES = range(MUST_GO + 1)


def _ways(after: Vector, code: int, state: int) -> dict[str, tuple[int, int]]:
    """(cost from here, next state) of each edit of a row, given the costs after it."""
    ways = {"D": (DELETE + after[state], state)}
    if code != MUST_GO:
        extra = CUT_OFF * (code % 2)
        kept = KEEP.get((state, INITIALS[code // 2]))
        if kept is not None:
            ways["K"] = (extra + after[kept], kept)
        ways["R"] = (RETITLE + extra + after[NEXT[state]], NEXT[state])
    return ways


@cache
def step(after: Vector, code: int) -> tuple[Vector, int]:
    """Costs before a row from those after it: (vector less its least, that least)."""
    costs = [min(cost for cost, _ in _ways(after, code, q).values()) for q in range(4)]
    for _ in range(2):  # more than two insertions in a row never pay
        costs = [min(costs[q], INSERT + costs[NEXT[q]]) for q in range(4)]
    least = min(costs)
    return tuple(c - least for c in costs), least


@cache
def vectors() -> tuple[Vector, ...]:
    """All vectors that can occur, up to constants."""
    found, new = {END}, [END]
    while new:
        after = new.pop()
        for code in CODES:
            before = step(after, code)[0]
            if before not in found:
                found.add(before)
                new.append(before)
    return tuple(sorted(found))


@cache
def trace(after: Vector, code: int, state: int) -> tuple[tuple[str, ...], str, int]:
    """(roles inserted first, edit, next state) that a cheapest path takes at a row.

    Of equal ones the least initial is taken at every step, which makes the audit least.
    """
    before, least = step(after, code)
    inserted: list[str] = []
    while True:
        goal = least + before[state]
        ways = {edit: way for edit, way in _ways(after, code, state).items() if way[0] == goal}
        if INSERT + least + before[NEXT[state]] == goal:
            ways["I"] = (goal, NEXT[state])
        edit = min(ways)
        state = ways[edit][1]
        if edit != "I":
            return tuple(inserted), edit, state
        inserted.append(ROLE[state])


def at_end(state: int) -> list[str]:
    """Roles inserted after the last row."""
    return {START: [], SYSTEM: ["user", "assistant"], USER: ["assistant"], ASSISTANT: []}[state]


def costs_before(codes: list[int], right: Vector) -> list[Vector]:
    """Vectors before each row and, last, after the last one."""
    out = [right]
    for code in reversed(codes):
        right = step(right, code)[0]
        out.append(right)
    return out[::-1]


def through(codes: list[int], right: Vector) -> Vector:
    for code in reversed(codes):
        right = step(right, code)[0]
    return right


def rerun(codes: list[int], old: Vector, new: Vector) -> dict[Vector, Vector]:
    """What the chunk makes of `new`, given that `old` was run before.

    Both go on side by side until they are parallel. If they never are, all vectors are
    tabulated, so that the chunk need not be run again.
    """
    left, right = new, old
    for code in reversed(codes):
        if left == right:
            break
        left, right = step(left, code)[0], step(right, code)[0]
    if left != right:
        return {v: through(codes, v) for v in vectors()}
    return {new: through(codes, old)}


def _text(column: str) -> Column:
    return F.coalesce(F.col(column).cast("string"), F.lit(" "))


def damage(conversations: DataFrame) -> DataFrame:
    """Conversations with one fault in every fourth row, by crc32 of `conv_id:turn`."""
    fault = F.crc32(F.concat(_text("conv_id"), F.lit(":"), _text("turn")).cast("binary")) % 20
    rows = conversations.select(
        "conv_id",
        "turn",
        _text("role").alias("role"),
        _text("text").alias("text"),
        fault.alias("fault"),
    )
    changed = rows.where(F.col("fault") != 0).select(
        "conv_id",
        "turn",
        F.when(F.col("fault") == 4, "user").otherwise(F.col("role")).alias("role"),
        F.when(F.col("fault") == 1, "")
        .when(F.col("fault") == 2, F.translate("text", ".!?", ""))
        .otherwise(F.col("text"))
        .alias("text"),
        F.when(F.col("fault") == 3, 2).otherwise(1).alias("times"),
    )
    return changed.select(
        "conv_id", "turn", "role", "text", F.explode(F.array_repeat(F.lit(0), F.col("times"))).alias("copy")
    ).drop("copy")


def _keyed(conversations: DataFrame) -> DataFrame:
    """Rows with `row_key`, equal for equal rows, and `said`, equal for equal role and text."""
    rows = conversations.select(
        "conv_id", "turn", _text("role").alias("role"), _text("text").alias("text")
    )

    def part(column: str) -> list[Column]:
        value = F.col(column).cast("string")
        return [F.coalesce(F.length(value), F.lit(-1)).cast("string"), F.lit(":"), F.coalesce(value, F.lit(""))]

    said = F.concat(*part("conv_id"), F.lit(":"), F.sha2("text", 256), F.col("role"))
    rows = rows.withColumn("said", F.unhex(F.sha2(said, 256)))
    key = F.concat(F.hex("said"), *part("turn"))
    return rows.withColumn("row_key", F.unhex(F.sha2(key, 256)))


def _narrow(keyed: DataFrame) -> DataFrame:
    """One row for equal rows, with their number, the initial's place and the faults."""
    bare = F.rtrim(F.col("text"), F.lit(" \t\n\x0b\x0c\r"))
    initial = F.substring("role", 1, 1)
    of = F.when(initial == "s", 0).when(initial == "u", 1).when(initial == "a", 2).otherwise(3)
    rows = keyed.select(
        "conv_id",
        "turn",
        "row_key",
        "said",
        of.alias("initial"),
        (bare == "").alias("blank"),
        (~F.substring(bare, -1, 1).isin(".", "!", "?")).alias("cut_off"),
    )
    folded = rows.groupBy(rows.columns).agg(F.count("*").alias("n"))
    firsts = (
        folded.groupBy("said")
        .agg(
            F.count("*").alias("places"),
            F.bool_or(F.col("turn").isNull()).alias("at_null"),
            F.min("turn").alias("first_turn"),
        )
        .where(F.col("places") > 1)
        .withColumnRenamed("said", "said_before")
    )
    later = F.col("turn").isNotNull() & (F.col("at_null") | (F.col("turn") > F.col("first_turn")))
    return folded.join(firsts, F.col("said") == F.col("said_before"), "left").select(
        "conv_id",
        "turn",
        "row_key",
        "initial",
        "blank",
        F.coalesce(later, F.lit(False)).alias("again"),
        "cut_off",
        "n",
    )


class Chunk:
    """The rows of one task, sorted; a run is those of one conversation."""

    def __init__(self, batches: Iterator[pa.RecordBatch]) -> None:
        held = list(batches)
        self.table = pa.Table.from_batches(held).combine_chunks() if held else None
        self.n = len(self.table) if self.table is not None else 0
        if not self.n:
            return

        def flags(name: str) -> np.ndarray:
            return self.table.column(name).to_numpy().astype(bool)

        self.initial = self.table.column("initial").to_numpy()
        self.blank, self.again, self.cut_off = (flags(c) for c in ("blank", "again", "cut_off"))
        must_go = self.blank | self.again
        self.codes = np.where(must_go, MUST_GO, 2 * self.initial + self.cut_off).tolist()
        starts = np.flatnonzero(self.changes("conv_id"))
        self.runs = list(zip(starts.tolist(), [*starts[1:].tolist(), self.n]))

    def changes(self, name: str) -> np.ndarray:
        """Whether a value differs from that of the row before."""
        column = self.table.column(name)
        if isinstance(column, pa.ChunkedArray):
            column = column.combine_chunks()
        here, before = column.slice(1), column.slice(0, self.n - 1)
        same = pc.or_(
            pc.fill_null(pc.equal(here, before), False),
            pc.and_(pc.is_null(here), pc.is_null(before)),
        )
        return np.concatenate([[True], ~same.to_numpy(zero_copy_only=False)])

    def of(self, run: tuple[int, int]) -> list[int]:
        return self.codes[run[0] : run[1]]


def _over_chunks(rows: DataFrame, work: Callable[[int, Chunk], list[dict]], schema: str) -> list:
    """Rows that `work` says of each chunk, on the driver."""
    made = to_arrow_schema(T.StructType.fromDDL(schema))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        chunk = Chunk(batches)
        if chunk.n:
            said = work(TaskContext.get().partitionId(), chunk)
            if said:
                yield pa.RecordBatch.from_pylist(said, schema=made)

    return rows.mapInArrow(run, schema).collect()


class Seams:
    """How the chunks of long conversations fit together, one entry for each chunk."""

    def __init__(self, rows: DataFrame) -> None:
        self.rows = rows
        kinds = dict(rows.dtypes)

        def ends(part: int, chunk: Chunk) -> list[dict]:
            column = chunk.table.column
            # The first run's costs; if it fills the chunk, from a speculative vector.
            return [
                {
                    "part": part,
                    "single": len(chunk.runs) == 1,
                    "first_id": column("conv_id")[0].as_py(),
                    "last_id": column("conv_id")[-1].as_py(),
                    "last_turn": column("turn")[-1].as_py(),
                    "last_initial": int(chunk.initial[-1]),
                    "left": list(through(chunk.of(chunk.runs[0]), END)),
                }
            ]

        schema = (
            f"part int, single boolean, first_id {kinds['conv_id']}, last_id {kinds['conv_id']}, "
            f"last_turn {kinds['turn']}, last_initial int, left array<int>"
        )
        self.ends = sorted(_over_chunks(rows, ends, schema), key=lambda e: e.part)
        after = dict(zip((e.part for e in self.ends), self.ends[1:]))
        #: chunk -> the next one, where the same conversation goes on in it
        self.goes_on = {
            e.part: after[e.part].part
            for e in self.ends[:-1]
            if after[e.part].first_id == e.last_id
        }
        self.passes = 0
        self.right = self._settle()
        self.entry = self._enter()

    def _settle(self) -> dict[int, Vector]:
        """The costs at the right end of each chunk whose conversation goes on."""
        known = {e.part: {END: tuple(e.left)} for e in self.ends}
        left = {e.part: tuple(e.left) for e in self.ends}
        single = {e.part for e in self.ends if e.single}
        while True:
            right, stale = {}, {}
            for part in sorted(self.goes_on, reverse=True):
                right[part] = wanted = left[self.goes_on[part]]
                if part in single and wanted in known[part]:
                    left[part] = known[part][wanted]
                elif part in single:
                    stale[part] = wanted
            if not stale:
                return right
            self.passes += 1

            def fix(part: int, chunk: Chunk) -> list[dict]:
                if part not in stale:
                    return []
                made = rerun(chunk.codes, END, stale[part])
                return [{"part": part, "at": list(a), "left": list(b)} for a, b in made.items()]

            for x in _over_chunks(self.rows, fix, "part int, at array<int>, left array<int>"):
                known[x.part][tuple(x.at)] = tuple(x.left)

    def _enter(self) -> dict[int, int]:
        """The state in which each chunk is entered whose conversation began before."""
        right, entry = self.right, {}
        if not right:
            return entry

        def exits(part: int, chunk: Chunk) -> list[dict]:
            if part not in right:
                return []
            codes = chunk.of(chunk.runs[-1])
            costs = costs_before(codes, right[part])
            out = []
            for state in range(4) if len(chunk.runs) == 1 else [START]:
                for code, after in zip(codes, costs[1:]):
                    state = trace(after, code, state)[2]
                out.append(state)
            return [{"part": part, "states": out}]

        said = _over_chunks(self.rows, exits, "part int, states array<int>")
        states = {x.part: x.states for x in said}
        for part, following in sorted(self.goes_on.items()):
            known = states[part]
            entry[following] = known[entry.get(part, START)] if len(known) > 1 else known[0]
        return entry

    def before(self) -> dict[int, tuple]:
        """(turn, initial) of the row before each chunk whose conversation began before."""
        last = {e.part: (e.last_turn, e.last_initial) for e in self.ends}
        return {following: last[part] for part, following in self.goes_on.items()}


def _traced(chunk: Chunk, part: int, seams: tuple[dict, dict, dict, set]) -> dict[str, list]:
    right, entry, before, ends_later = seams
    inserted, edits, after, roles = [], [], [], []
    for k, run in enumerate(chunk.runs):
        last = k == len(chunk.runs) - 1
        codes = chunk.of(run)
        costs = costs_before(codes, right.get(part, END) if last else END)
        state = entry.get(part, START) if k == 0 else START
        for code, following in zip(codes, costs[1:]):
            first, edit, state = trace(following, code, state)
            inserted.append(list(first))
            edits.append(edit)
            roles.append(ROLE[state] if edit == "R" else None)
            after.append([])
        if not (last and part in ends_later):
            after[-1] = at_end(state)
    initials = chunk.initial
    changed = chunk.changes("conv_id")
    new_turn = chunk.changes("turn") | changed
    legal = np.zeros((4, 4), dtype=bool)
    for a, b in LEGAL_PAIRS:
        legal[INITIALS.index(a), INITIALS.index(b)] = True
    illegal = np.zeros(chunk.n, dtype=np.int64)
    illegal[1:] = ~legal[initials[:-1], initials[1:]]
    illegal[changed] = 0
    if part in before:
        turn, initial = before[part]
        new_turn[0] = chunk.table.column("turn")[0].as_py() != turn
        illegal[0] = not legal[initial, initials[0]]
    n = chunk.table.column("n").to_numpy()
    return {
        "place": (np.arange(chunk.n, dtype=np.int64) + (part << 40)),
        "new_turn": new_turn,
        "illegal": illegal + (n - 1),
        "inserted": inserted,
        "edit": edits,
        "new_role": roles,
        "inserted_after": after,
    }


def edits(conversations: DataFrame) -> DataFrame:
    """The cheapest edits: one row for rows equal in all columns (n of them, of which all but
    the first are deleted), in the order of `place` within a conversation.

    blank, again (an earlier row says the same) and cut_off are a row's faults; illegal counts
    pairs with the row before; inserted and inserted_after are the roles of new empty turns.
    """
    narrow = _narrow(_keyed(conversations))
    order = ["conv_id", "turn", "row_key"]
    rows = cut(narrow.repartitionByRange(*order).sortWithinPartitions(*order))
    seams = Seams(rows)
    closed = (seams.right, seams.entry, seams.before(), set(seams.goes_on))
    kept = ["conv_id", "turn", "row_key", "blank", "again", "cut_off", "n"]
    kinds = dict(rows.dtypes)
    schema = ", ".join(f"{c} {kinds[c]}" for c in kept) + (
        ", place long, new_turn boolean, illegal long, inserted array<string>, edit string, "
        "new_role string, inserted_after array<string>"
    )

    arrow = to_arrow_schema(T.StructType.fromDDL(schema))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        chunk = Chunk(batches)
        if not chunk.n:
            return
        made = _traced(chunk, TaskContext.get().partitionId(), closed)
        table = chunk.table.select(kept)
        for name, values in made.items():
            table = table.append_column(name, pa.array(values, arrow.field(name).type))
        yield from table.to_batches(max_chunksize=50_000)

    return rows.mapInArrow(run, schema)


def _with_lines(conversations: DataFrame) -> DataFrame:
    """Edits with the role and text that stay (null if the row goes)."""
    said = (
        _keyed(conversations)
        .groupBy("row_key")
        .agg(F.first("role").alias("role"), F.first("text").alias("text"))
    )
    stays = F.col("edit") != "D"
    return (
        edits(conversations)
        .join(said, "row_key")
        .withColumn("role", F.when(stays, F.coalesce("new_role", "role")))
        .withColumn("text", F.when(stays, F.col("text")))
    )


def repaired(conversations: DataFrame) -> DataFrame:
    """The rows of the repaired conversations: conv_id, place, step, turn, role, text.

    Ordered by place and step; the turn is that of the row beside which a new one was put.
    """

    def new(roles: str) -> Column:
        return F.transform(roles, lambda r: F.struct(r.alias("role"), F.lit("").alias("text")))

    own = F.filter(F.array(F.struct("role", "text")), lambda r: r["role"].isNotNull())
    lines = F.concat(new("inserted"), own, new("inserted_after"))
    return (
        _with_lines(conversations)
        .select("conv_id", "place", "turn", F.posexplode(lines).alias("step", "line"))
        .select("conv_id", "place", "step", "turn", "line.role", "line.text")
    )


_FIGURES = ("blank", "duplicate", "truncated", "illegal", "cost")


def _digester(schema: pa.Schema) -> Callable:
    """One row for each conversation, from its rows in order; lines are hashed as they pass."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        done: list[dict] = []
        conv, figures, audit, digest, any_line = None, None, [], None, False
        turns: list = []
        n_turns = 0

        def close() -> None:
            span = int(turns[1] - turns[0]) + 1 - n_turns if turns else 0
            done.append(
                {"conv_id": conv, "gaps": span, **dict(zip(_FIGURES, figures)), "audit": "".join(audit), "repaired_sha256": digest.hexdigest()}
            )

        for batch in batches:
            columns = [batch.column(c).to_pylist() for c in ("conv_id", "turn", "new_turn", "piece", "lines", *_FIGURES)]
            for conv_id, turn, new_turn, piece, lines, *more in zip(*columns):
                if digest is None or conv_id != conv:
                    if digest is not None:
                        close()
                    conv, figures, audit, digest, any_line = conv_id, [0] * len(_FIGURES), [], hashlib.sha256(), False
                    turns, n_turns = [], 0
                if turn is not None:
                    n_turns += new_turn
                    turns = [turns[0] if turns else turn, turn]
                audit.append(piece)
                if lines is not None:
                    digest.update(("\n" * any_line + lines).encode())
                    any_line = True
                figures = [a + b for a, b in zip(figures, more)]
            if len(done) >= 10_000:
                yield pa.RecordBatch.from_pylist(done, schema=schema)
                done = []
        if digest is not None:
            close()
        if done:
            yield pa.RecordBatch.from_pylist(done, schema=schema)

    return run


def report(conversations: DataFrame) -> DataFrame:
    """For each conversation its faults, the cost, the audit (initials of the edits) and the
    SHA-256 of the repaired lines `role:text`."""
    first_gone = F.when(F.col("edit") == "D", DELETE).when(F.col("edit") == "R", RETITLE).otherwise(0)
    fault = F.col("cut_off") & ~F.col("blank") & ~F.col("again")
    new_turns = F.size("inserted") + F.size("inserted_after")
    named = lambda roles: F.transform(roles, lambda r: F.concat(r, F.lit(":")))
    lines = F.concat_ws(
        "\n",
        named("inserted"),
        F.concat("role", F.lit(":"), "text"),
        named("inserted_after"),
    )
    more = (F.col("n") - 1).cast("int")
    rows = _with_lines(conversations).select(
        "conv_id",
        "place",
        "turn",
        "new_turn",
        F.concat(
            F.repeat(F.lit("I"), F.size("inserted")),
            "edit",
            F.repeat(F.lit("D"), more),
            F.repeat(F.lit("I"), F.size("inserted_after")),
        ).alias("piece"),
        F.when(lines != "", lines).alias("lines"),
        F.when(F.col("blank"), F.col("n")).otherwise(0).alias("blank"),
        F.when(F.col("blank"), 0)
        .when(F.col("again"), F.col("n"))
        .otherwise(F.col("n") - 1)
        .alias("duplicate"),
        fault.cast("long").alias("truncated"),
        "illegal",
        (
            first_gone
            + DELETE * (F.col("n") - 1)
            + INSERT * new_turns
            + F.when((F.col("edit") != "D") & F.col("cut_off"), CUT_OFF).otherwise(0)
        ).alias("cost"),
    )
    kind = dict(rows.dtypes)["conv_id"]
    longs = [f"{c} long" for c in ("gaps", *_FIGURES)]
    schema = f"conv_id {kind}, {', '.join(longs)}, audit string, repaired_sha256 string"
    return (
        rows.repartition("conv_id")
        .sortWithinPartitions("conv_id", "place")
        .mapInArrow(_digester(to_arrow_schema(T.StructType.fromDDL(schema))), schema)
    )


def damaged_report(conversations: DataFrame) -> DataFrame:
    """report() of the damaged conversations, with those of which no row is left."""
    found = report(damage(conversations)).withColumnRenamed("conv_id", "found_id")
    ids = conversations.select("conv_id").distinct()
    counts = [F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in ("gaps", *_FIGURES)]
    return ids.join(found, F.col("conv_id").eqNullSafe(F.col("found_id")), "left").select(
        "conv_id",
        *counts,
        F.coalesce("audit", F.lit("")).alias("audit"),
        F.coalesce("repaired_sha256", F.lit(hashlib.sha256(b"").hexdigest())).alias("repaired_sha256"),
    )
