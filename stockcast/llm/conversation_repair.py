"""Conversation structure repair: the cheapest audited edits, by a persistent DP.

A conversation's rows, in turn order, are edited until their role initials read
``(s?(ua)+)?``: Keep (0), Rerole to user or assistant (3), Delete (4), Insert an empty
user or assistant row (3). Blank and repeated rows must go; a truncated row that
stays adds 3. Of the cheapest edits those whose initials (the *audit*, one of K, R, D, I
an edit) are least in ASCII order are taken. The audit settles the result, as each
state of the expression allows but one role to rerole to or insert.

The DP runs over rows and the states start, after s, after u, after a. A cell holds
its cheapest audit as a linked node (parent, piece, rolling hash, binary-lifting
ancestors), so all audits share their prefixes and a step costs a node. A tie is
settled by the longest common prefix, found by lifting both nodes over ancestors
whose hashes differ; nodes with equal hashes are compared piece by piece before
they count as equal.

How it runs: one range exchange of the rows in (conversation, turn, role) order cuts a
long conversation into slices. Per slice, from two short code strings (no texts),
a task computes the cheapest audit from every entry to every exit state; per
conversation the slices' audits are joined by the same DP (nodes that hold whole
slice audits), and the chosen pieces go back to the slices. The repaired text is
hashed as a stream in order. A task so holds a slice's codes, or a conversation's
audits (a few bytes a row), never a conversation's texts.

Edge cases: null role and text count as one space. Rows of one turn are taken by role, then
text; null turns first. Roles count by their first character; an empty role has none, so it
can't be kept. Null conv_id is a conversation. Repeated rows are duplicates of
one another. A conversation without rows has no edits. An empty table gives an empty result.
Extra columns are ignored.
"""

from __future__ import annotations

import hashlib
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from stockcast.llm.common import stored

KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 3, 4, 3, 3  # costs

# States: what has been written so far.
START, S, U, A = range(4)
STATES, DONE = range(4), (START, A)
#: (state, initial of the row written) -> state; what is not here is not allowed
STEP = {(START, "s"): S, (START, "u"): U, (S, "u"): U, (U, "a"): A, (A, "u"): U}
#: state -> (state, role) of the one row that may be put in or reroled to
NEXT = {START: (U, "user"), S: (U, "user"), U: (A, "assistant"), A: (U, "user")}

# Fault codes of a row, in the order they are looked for.
BLANK, DUPLICATE, CUT, FINE = "b", "d", "t", "-"

REMEMBERED = 32  # rows of a slice whose audits are remembered by a task


# ------------------------------------------------------------ audits as linked nodes


class Node:
    """An audit: its parent's, then ``piece``. Shares everything with its parent."""

    __slots__ = ("parent", "piece", "depth", "length", "hash", "up")
    BASE, MODULUS = 0x2545F4914F6CDD1D, (1 << 61) - 1

    def __init__(self, parent: Node | None, piece: str):
        self.parent, self.piece = parent, piece
        self.depth = parent.depth + 1 if parent else 0
        self.length = (parent.length if parent else 0) + len(piece)
        value = parent.hash if parent else 0
        for c in piece:
            value = (value * self.BASE + ord(c)) % self.MODULUS
        self.hash = value
        self.up = []  # ancestors 1, 2, 4, ... above
        above = parent
        while above is not None:
            self.up.append(above)
            k = len(self.up) - 1
            above = above.up[k] if k < len(above.up) else None

    def ancestor(self, depth: int) -> Node:
        node, left = self, self.depth - depth
        while left:
            k = left.bit_length() - 1
            node, left = node.up[k], left - (1 << k)
        return node

    def text(self, depth: int = 0) -> str:
        """The audit from ``depth`` pieces on."""
        pieces, node = [], self
        while node.depth > depth:
            pieces.append(node.piece)
            node = node.parent
        return "".join(reversed(pieces))


def same(a: Node, b: Node) -> bool:
    """Equal audits of one depth; equal hashes are verified."""
    if a is b:
        return True
    if a.hash != b.hash or a.length != b.length:
        return False
    while a is not b:  # shared prefixes end the walk
        if a.piece != b.piece:
            return False
        a, b = a.parent, b.parent
    return True


def common(a: Node, b: Node) -> int:
    """Number of leading pieces two audits share (longest-common-prefix search)."""
    depth = min(a.depth, b.depth)
    a, b = a.ancestor(depth), b.ancestor(depth)
    if same(a, b):
        return depth
    for k in reversed(range(len(a.up))):
        if k < len(a.up) and not same(a.up[k], b.up[k]):
            a, b = a.up[k], b.up[k]
    return a.depth - 1


def before(a: Node, b: Node) -> bool:
    """Is audit a less than audit b in ASCII order?"""
    depth = common(a, b)
    if depth == min(a.depth, b.depth):  # one begins with the other, or pieces are whole audits
        return a.text(depth) < b.text(depth)
    x, y = a.ancestor(depth + 1).piece, b.ancestor(depth + 1).piece
    if x.startswith(y) or y.startswith(x):
        return a.text(depth) < b.text(depth)
    return x < y


def better(cells: dict, state: int, cost: int, parent: Node, piece: str) -> None:
    """Puts (cost, parent + piece) in ``cells`` if it is cheaper, or as cheap and less."""
    held = cells.get(state)
    if held is None or cost < held[0]:
        cells[state] = cost, Node(parent, piece)
    elif cost == held[0]:
        node = Node(parent, piece)
        if before(node, held[1]):
            cells[state] = cost, node


def inserted(cells: dict) -> dict:
    """Cells after any inserts: two at most, as three end where one does."""
    cells, edge = dict(cells), cells
    for _ in range(2):
        more: dict = {}
        for state, (cost, node) in edge.items():
            better(more, NEXT[state][0], cost + INSERT, node, "I")
        edge = {}
        for state, (cost, node) in more.items():
            held = cells.get(state)
            if held is None or cost < held[0] or (cost == held[0] and before(node, held[1])):
                cells[state] = edge[state] = cost, node
    return cells


def slice_audits(initials: str, faults: str, entry: int, closing: bool) -> dict[int, tuple[int, str]]:
    """exit state -> (cost, audit) of the cheapest edits of a slice entered in a state;
    inserts after its last row only when it is ``closing`` its conversation."""
    return (_short_audits if len(initials) <= REMEMBERED else _audits)(initials, faults, entry, closing)


def _audits(initials: str, faults: str, entry: int, closing: bool) -> dict[int, tuple[int, str]]:
    cells = {entry: (0, Node(None, ""))}
    for initial, fault in zip(initials, faults):
        new: dict = {}
        extra = TRUNCATED if fault == CUT else 0
        for state, (cost, node) in inserted(cells).items():
            better(new, state, cost + DELETE, node, "D")
            if fault in (BLANK, DUPLICATE):
                continue
            if (state, initial) in STEP:
                better(new, STEP[state, initial], cost + KEEP + extra, node, "K")
            if NEXT[state][1][0] != initial:
                better(new, NEXT[state][0], cost + REROLE + extra, node, "R")
        cells = new
    if closing:
        cells = inserted(cells)
    return {state: (cost, node.text()) for state, (cost, node) in cells.items()}


_short_audits = lru_cache(1 << 14)(_audits)  # most conversations are short and alike


def conversation_audit(slices: list[tuple[str, str]]) -> tuple[int, list[tuple[int, str]]]:
    """(cost, [(entry state, audit) a slice]) of the cheapest edits of a conversation,
    given (initials, faults) of its slices in order."""
    cells, entries = {START: (0, Node(None, ""))}, {}
    for k, (initials, faults) in enumerate(slices):
        new: dict = {}
        for entry, (cost, node) in cells.items():
            for state, (more, audit) in slice_audits(initials, faults, entry, k == len(slices) - 1).items():
                better(new, state, cost + more, node, audit)
                if new[state][1].parent is node:
                    entries[k, state] = entry
        cells = new
    state = None
    for done in DONE:
        if done in cells and (state is None or cells[done][0] < cells[state][0] or (cells[done][0] == cells[state][0] and before(cells[done][1], cells[state][1]))):
            state = done
    cost, node = cells[state]
    chosen = []
    for k in reversed(range(len(slices))):
        entry = entries[k, state]
        chosen.append((entry, node.piece))
        node, state = node.parent, entry
    return cost, chosen[::-1]


def applied(initials: str, entry: int, audit: str) -> tuple[list[tuple[str, str, str]], str]:
    """([(rows put in before, edit, new role or '') a row], rows put in after the last
    one) for a slice's audit; rows put in are written ``role:`` and a line end each."""
    state, lead, rows = entry, "", []
    at = iter(initials)
    for edit in audit:
        if edit == "I":
            state, role = NEXT[state]
            lead += f"{role}:\n"
            continue
        initial, role = next(at), ""
        if edit == "R":
            state, role = NEXT[state]
        elif edit == "K":
            state = STEP[state, initial]
        rows.append((lead, edit, role))
        lead = ""
    return rows, lead


# ------------------------------------------------------------ the rows


def damaged(turns: DataFrame) -> DataFrame:
    """The registered query's damage: by the checksum of ``conv_id:turn`` a row is
    dropped, emptied, loses its sentence ends, is repeated or gets role user."""
    text = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    kind = F.crc32(F.concat(text("conv_id"), F.lit(":"), text("turn"))) % 20
    rows = turns.select("conv_id", "turn", text("role").alias("role"), text("text").alias("text")).withColumn("kind", kind).where("kind <> 0")
    rows = rows.withColumn("text", F.when(F.col("kind") == 1, "").when(F.col("kind") == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text")))
    rows = rows.withColumn("role", F.when(F.col("kind") == 4, "user").otherwise(F.col("role")))
    return rows.withColumn("copy", F.explode(F.when(F.col("kind") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0))))).drop("kind", "copy")


def sliced(turns: DataFrame) -> DataFrame:
    """(conv_id, turn, role, text, digest, seq, slice, initial, plain fault): rows in
    order of ``seq`` (turn, role, text), cut into slices by ranges."""
    blank = ~F.col("text").rlike(r"[^\x20\x09-\x0D]")
    last = F.regexp_extract("text", r"([^\x20\x09-\x0D])[\x20\x09-\x0D]*\z", 1)
    rows = turns.select("conv_id", "turn", F.coalesce("role", F.lit(" ")).alias("role"), F.coalesce("text", F.lit(" ")).alias("text"))
    dealt = rows.repartitionByRange("conv_id", "turn", "role").sortWithinPartitions("conv_id", "turn", "role", "text")
    return stored(
        dealt.withColumn("seq", F.monotonically_increasing_id())
        .withColumn("slice", F.shiftright("seq", 33).cast("int"))
        .withColumn("digest", F.unhex(F.sha2("text", 256)))
        # an empty role still takes a place in the code string
        .withColumn("initial", F.when(F.col("role") == "", F.lit("\u0000")).otherwise(F.substring("role", 1, 1)))
        .withColumn("fault", F.when(blank, BLANK).when(last.isin(".", "!", "?"), FINE).otherwise(CUT)),
        "conversation-rows",
    )


def coded(rows: DataFrame) -> DataFrame:
    """One row a (conversation, slice): its codes and the rows they stand for."""
    one = ["conv_id", "slice", "role", "digest"]
    in_slice = F.row_number().over(Window.partitionBy(*one).orderBy("seq")) == 1
    facts = rows.select("conv_id", "slice", "role", "digest", "seq", "initial", "fault").withColumn("new", in_slice)
    # of rows that are first in their slice, the first of all; the others stay apart
    overall = F.row_number().over(Window.partitionBy("conv_id", "role", "digest", F.when(~F.col("new"), F.col("seq"))).orderBy("seq")) == 1
    fault = F.when(F.col("fault") == BLANK, BLANK).when(~(F.col("new") & overall), DUPLICATE).otherwise(F.col("fault"))
    listed = F.sort_array(F.collect_list(F.struct("seq", "initial", "fault")))  # a slice is at most a partition
    of = lambda c: F.transform("rows", lambda r: r[c])
    return (
        facts.withColumn("fault", fault)
        .groupBy("conv_id", "slice")
        .agg(listed.alias("rows"))
        .select("conv_id", "slice", of("seq").alias("seqs"), F.array_join(of("initial"), "").alias("initials"), F.array_join(of("fault"), "").alias("faults"))
    )


def audits(codes: DataFrame) -> DataFrame:
    """One row a conversation: counts, cost, audit, and the slices' entries and pieces."""
    kind = codes.schema["conv_id"].dataType.simpleString()
    gathered = codes.groupBy("conv_id").agg(F.sort_array(F.collect_list(F.struct("slice", "initials", "faults"))).alias("slices"))

    def run(batches):
        for batch in batches:
            out = []
            for slices in batch.column("slices").to_pylist():
                pieces = [(s["initials"], s["faults"]) for s in slices]
                cost, chosen = conversation_audit(pieces)
                initials, faults = "".join(p[0] for p in pieces), "".join(p[1] for p in pieces)
                legal = sum(initials.count(p) for p in ("su", "ua", "au"))  # no two of these overlap with themselves
                pieces = [{"slice": s["slice"], "entry": e, "audit": a} for s, (e, a) in zip(slices, chosen)]
                out.append((*(faults.count(c) for c in (BLANK, DUPLICATE, CUT)), len(initials) - 1 - legal, cost, "".join(a for _, a in chosen), pieces))
            columns = [pa.array([r[k] for r in out], pa.int64()) for k in range(5)] + [pa.array([r[5] for r in out], pa.string())]
            piece = pa.struct([("slice", pa.int32()), ("entry", pa.int32()), ("audit", pa.string())])
            yield pa.RecordBatch.from_arrays([batch.column("conv_id"), *columns, pa.array([r[6] for r in out], pa.list_(piece))], _AUDIT_NAMES)

    return gathered.mapInArrow(run, f"conv_id {kind}, blank long, duplicate long, truncated long, illegal long, cost long, audit string, pieces array<struct<slice: int, entry: int, audit: string>>")


_AUDIT_NAMES = ["conv_id", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "pieces"]


def edits(codes: DataFrame, found: DataFrame) -> DataFrame:
    """(conv_id, seq, lead, edit, role, tail): what becomes of every row."""
    kind = codes.schema["conv_id"].dataType.simpleString()
    piece = found.select(F.col("conv_id").alias("c"), F.explode("pieces").alias("p")).select("c", F.col("p.slice").alias("s"), "p.entry", F.col("p.audit").alias("own"))
    joined = codes.join(piece, codes.conv_id.eqNullSafe(F.col("c")) & (F.col("slice") == F.col("s"))).select("conv_id", "seqs", "initials", "entry", "own")

    def run(batches):
        for batch in batches:
            ids, seqs, out = [], [], []
            for r, conv in zip(batch.to_pylist(), batch.column("conv_id")):
                rows, tail = applied(r["initials"], r["entry"], r["own"])
                out += [(*row, "") for row in rows[:-1]] + [(*rows[-1], tail)]
                ids += [conv] * len(rows)
                seqs += r["seqs"]
                if len(out) > 1 << 16:
                    yield _edit_rows(batch, ids, seqs, out)
                    ids, seqs, out = [], [], []
            yield _edit_rows(batch, ids, seqs, out)

    return joined.mapInArrow(run, f"conv_id {kind}, seq long, lead string, edit string, role string, tail string")


def _edit_rows(batch, ids, seqs, out):
    conv = pa.array([i.as_py() for i in ids], batch.schema.field("conv_id").type)
    return pa.RecordBatch.from_arrays([conv, pa.array(seqs, pa.int64()), *(pa.array([r[k] for r in out], pa.string()) for k in range(4))], ["conv_id", "seq", "lead", "edit", "role", "tail"])


def repaired_rows(rows: DataFrame, done: DataFrame) -> DataFrame:
    """Rows and their edits side by side, dealt by conversation and in order: an edit
    stands before its row."""
    none = lambda t: F.lit(None).cast(t)
    marks = done.select("conv_id", "seq", F.lit(0).alias("side"), "lead", "edit", "role", "tail", none("string").alias("text"))
    texts = rows.select("conv_id", "seq", F.lit(1).alias("side"), none("string").alias("lead"), none("string").alias("edit"), "role", none("string").alias("tail"), "text")
    return marks.unionByName(texts).repartition("conv_id").sortWithinPartitions("conv_id", "seq", "side")


def repaired_text(rows: DataFrame, done: DataFrame) -> DataFrame:
    """(conv_id, place, text): the repaired conversations, a piece a row that stays or was
    put in, ``role:text`` lines in order of ``place``."""
    marks = done.select("seq", "lead", "edit", F.col("role").alias("new_role"), "tail")
    line = F.when(F.col("edit") != "D", F.concat(F.when(F.col("new_role") != "", F.col("new_role")).otherwise(F.col("role")), F.lit(":"), F.col("text"), F.lit("\n"))).otherwise("")
    return rows.join(marks, "seq").select("conv_id", F.col("seq").alias("place"), F.concat("lead", line, "tail").alias("text")).where("text <> ''")


def repaired_digests(rows: DataFrame, done: DataFrame) -> DataFrame:
    """(conv_id, repaired_sha256): SHA-256 of the repaired lines, newline-joined; a
    conversation streams through one task, whose memory one batch bounds."""
    kind = rows.schema["conv_id"].dataType.simpleString()

    def run(batches):
        key, state, waiting, mark = None, None, False, None

        def write(piece: str) -> None:  # lines end in "\n"; the last end is left out
            nonlocal waiting
            if piece:
                state.update((("\n" if waiting else "") + piece[:-1]).encode())
                waiting = True

        for batch in batches:
            ids, sums = [], []
            for r in batch.to_pylist():
                if state is None or r["conv_id"] != key:
                    if state is not None:
                        ids.append(key)
                        sums.append(state.hexdigest())
                    key, state, waiting = r["conv_id"], hashlib.sha256(), False
                if r["side"] == 0:
                    mark = r
                else:
                    write(mark["lead"])
                    if mark["edit"] != "D":
                        write(f"{mark['role'] or r['role']}:{r['text']}\n")
                    write(mark["tail"])
            if ids:
                yield pa.RecordBatch.from_arrays([pa.array(ids, batch.schema.field("conv_id").type), pa.array(sums, pa.string())], ["conv_id", "repaired_sha256"])
            kept = batch.schema.field("conv_id").type
        if state is not None:
            yield pa.RecordBatch.from_arrays([pa.array([key], kept), pa.array([state.hexdigest()], pa.string())], ["conv_id", "repaired_sha256"])

    return repaired_rows(rows, done).mapInArrow(run, f"conv_id {kind}, repaired_sha256 string")


def repair(turns: DataFrame, originals: DataFrame | None = None) -> DataFrame:
    """(conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit,
    repaired_sha256) for every conversation of ``originals`` (by default of
    ``turns``: conv_id, turn, role, text)."""
    rows = sliced(turns)
    codes = stored(coded(rows), "conversation-codes")
    found = stored(audits(codes), "conversation-audits")
    sums = repaired_digests(rows, edits(codes, found))
    gaps = rows.groupBy("conv_id").agg((F.max("turn") - F.min("turn") + 1 - F.countDistinct("turn")).alias("gaps"))
    every = (originals if originals is not None else turns).select("conv_id").distinct()
    for other in (gaps, found.drop("pieces"), sums):
        other = other.withColumnRenamed("conv_id", "c")
        every = every.join(other, every.conv_id.eqNullSafe(other.c), "left").drop("c")
    count = lambda c: F.coalesce(F.col(c), F.lit(0)).cast("long").alias(c)
    return every.select(
        "conv_id",
        *(count(c) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")),
        F.coalesce("audit", F.lit("")).alias("audit"),
        F.coalesce("repaired_sha256", F.lit(hashlib.sha256(b"").hexdigest())).alias("repaired_sha256"),
    )
