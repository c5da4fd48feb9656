"""Repair of the turn structure of conversations at least cost.

A conversation should be nothing, or an optional system turn and then user and
assistant turns in turn. A row is kept, given another role, or deleted; empty
user or assistant turns can be put in anywhere. Blank rows and repeated ones
have to go. Of all cheapest ways, the one whose letters (``K`` keep, ``R`` role,
``D`` delete, ``I`` insert, in order) come first in the alphabet is taken.

Both aims are one integer: the high digits hold the cost, the low digits the
letters. Every row owns a field of three digits at a fixed place: up to two
insertions before it and its own letter, closed by zeros; the insertions after
the last row come last of all, so a shorter audit sorts first. Weights of
edges are plain sums of such integers, and the least path through the states
(nothing yet, after system, user or assistant) decides cost and audit at once.

A conversation may hold a third of all rows, so it is cut into blocks of at
most ``BLOCK`` entries. The same search gives each block its least way from
every state to every state. The chain of blocks is then settled by two passes
over one small row a block, last block first and then first block first, that
keep one state of numbers: of a block only costs and the order of its audits
matter. Only the digest of a conversation, which has to read all its text in
order, streams through one task.

Order and copies: rows are ordered by turn, NULL first; rows of one turn by
role, then by a digest of role and text. Equal rows are counted before they
move, and only the first of each role and text carries its text on.

Defined results: NULL role or text is one space, so such a text is blank. NULL
keys are one conversation. A conversation without rows, or of which nothing is
kept, is empty. An empty table gives no conversations.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import cache

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import _parse_datatype_string

from spanledger.llm.batches import map_batches
from spanledger.session import stored

BLOCK, BLOCK_BYTES = 256, 4_000_000
KEEP, RETURN_ROLE, DELETE, INSERT, UNTRUNCATED = 0, 3, 4, 3, 3

NOTHING, SYSTEM, USER, ASSISTANT = range(4)
_INITIALS = "sua"
_LETTERS = "DIKR"  # 1 to 4, in the order of the alphabet
_DIGITS, _FIELD = 3, 9  # digits of three bits a row
_INSERTED = {NOTHING: USER, SYSTEM: USER, USER: ASSISTANT, ASSISTANT: USER}
_AT_END = {NOTHING: "", SYSTEM: "II", USER: "I", ASSISTANT: ""}
_ROLE = {USER: "user", ASSISTANT: "assistant"}


def _digits(letters: str) -> int:
    out = 0
    for c in letters.ljust(_DIGITS, "0"):
        out = out * 8 + (0 if c == "0" else _LETTERS.index(c) + 1)
    return out


@cache
def _edges(initial: str, truncated: bool, forced: bool, copies_cost: int) -> tuple[tuple[int, int, int, int], ...]:
    """From, to, cost and field of the least way of one row between two states; ``copies_cost`` is that of its deletion."""
    least: dict[tuple[int, int], tuple[int, int]] = {}

    def offer(a: int, b: int, cost: int, letters: str) -> None:
        least[a, b] = min(least.get((a, b), (cost, _digits(letters))), (cost, _digits(letters)))

    for a in range(4):
        state, put_in = a, ""
        for _ in range(3):
            paid = INSERT * len(put_in)
            offer(a, state, paid + copies_cost, put_in + "D")
            if not forced:
                kept = UNTRUNCATED if truncated else 0
                after = {"s": SYSTEM, "u": USER, "a": ASSISTANT}.get(initial)
                if after == _INSERTED[state] or (after == SYSTEM and state == NOTHING):
                    offer(a, after, paid + KEEP + kept, put_in + "K")
                offer(a, _INSERTED[state], paid + RETURN_ROLE + kept, put_in + "R")
            state, put_in = _INSERTED[state], put_in + "I"
    return tuple((a, b, cost, field) for (a, b), (cost, field) in least.items())


def least_ways(entries: list[tuple[str, bool, int]]) -> tuple[list[int], list[str | None]]:
    """Cost and audit from every state to every state (place 4 a + b; cost -1 where there is no way).

    An entry is the initial of a role, whether the text is cut short, and 0, or the number of rows that must be deleted:
    these give one letter.
    """
    n = len(entries)
    shift = _FIELD * n
    ways: list[list[int | None]] = [[0 if a == b else None for b in range(4)] for a in range(4)]
    for i, (initial, truncated, forced) in enumerate(entries):
        place = _FIELD * (n - 1 - i)
        edges = [(a, b, (cost << shift) + (field << place)) for a, b, cost, field in _edges(initial, truncated, forced > 0, DELETE * max(forced, 1))]
        after = []
        for way in ways:
            new: list[int | None] = [None] * 4
            for a, b, weight in edges:
                before = way[a]
                if before is not None and (new[b] is None or before + weight < new[b]):
                    new[b] = before + weight
            after.append(new)
        ways = after
    flat = [w for way in ways for w in way]
    mask = (1 << shift) - 1
    letters = str.maketrans("1234", _LETTERS)
    audits = [None if w is None else (format(w & mask, "o") if n else "").replace("0", "").translate(letters) for w in flat]
    return [-1 if w is None else w >> shift for w in flat], audits


def follow(audit: str, state: int, entries: list[tuple[str, str | None, int]]) -> tuple[str, list[tuple[str, str]]]:
    """The audit with a letter for every row, and the repaired rows, of entries (role, text, rows to delete or 0)."""
    letters, rows, at = [], [], 0
    for letter in audit:
        if letter == "I":
            state = _INSERTED[state]
            rows.append((_ROLE[state], ""))
            letters.append("I")
            continue
        role, text, forced = entries[at]
        at += 1
        letters.append(letter * max(forced, 1))
        if letter == "K":
            state = {"s": SYSTEM, "u": USER, "a": ASSISTANT}[role[:1]]
            rows.append((role, text))
        elif letter == "R":
            state = _INSERTED[state]
            rows.append((_ROLE[state], text))
    return "".join(letters), rows


def _blocks(rows: Iterator[pa.RecordBatch], schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    """Blocks of sorted records: one row each, with entries, counts at its edges and the least ways through it."""
    part = TaskContext.get().partitionId()
    made: list[dict] = []
    block: dict | None = None
    sizes = [0, 0]  # of the open block, of those made

    def begin(conv) -> dict:
        return {"conv": conv, "part": part, "roles": [], "texts": [], "forced": [], "kinds": [], "blank": 0, "duplicate": 0, "truncated": 0,
                "illegal": 0, "turns": 0, "first_turn": None, "last_turn": None, "first_role": None, "last_role": None}

    def close() -> None:
        kinds = block.pop("kinds")
        block["costs"], audits = least_ways(kinds)
        order = sorted({a for a in audits if a is not None})
        block["ranks"] = [-1 if a is None else order.index(a) for a in audits]
        block["audits"] = audits
        block["seq"] = close.seq
        close.seq += 1
        made.append(block)

    close.seq = 0

    def count(b: dict, initial: str, turn: int | None, copies: int) -> None:
        if b["last_role"] is None:
            b["first_role"] = initial
        else:
            b["illegal"] += legal_after(b["last_role"], initial)
        b["illegal"] += copies - 1
        b["last_role"] = initial
        if turn is not None and turn != b["last_turn"]:
            b["turns"] += 1
            b["first_turn"] = turn if b["first_turn"] is None else b["first_turn"]
            b["last_turn"] = turn

    last_first: tuple | None = None
    for batch in rows:
        columns = [c.to_pylist() for c in batch.columns]
        for conv, turn, role, digest, first, blank, truncated, copies, text in zip(*columns, strict=True):
            if block is not None and (conv != block["conv"] or len(block["kinds"]) >= BLOCK or sizes[0] >= BLOCK_BYTES):
                close()
                sizes[1] += sizes[0]
                block, sizes[0] = None, 0
                if sizes[1] >= BLOCK_BYTES or len(made) >= 500:
                    yield pa.RecordBatch.from_pylist(made, schema)
                    made, sizes[1] = [], 0
            initial = role[:1]
            if first:
                last_first = (conv, turn, digest)
                rest = 1
            else:
                rest = copies - (last_first == (conv, turn, digest))
                if not rest:
                    continue
            block = block or begin(conv)
            count(block, initial, turn, rest)
            block["roles"].append(role)
            block["texts"].append(text if first else None)
            block["forced"].append(0 if first else rest)
            block["kinds"].append((initial, bool(truncated), 0 if first else rest))
            block["truncated"] += bool(first and truncated)
            block["blank"] += rest if blank else 0
            block["duplicate"] += 0 if first or blank else rest
            sizes[0] += 4 * len(text or "")
    if block is not None:
        close()
    if made:
        yield pa.RecordBatch.from_pylist(made, schema)


def legal_after(a: str, b: str) -> int:
    """0 where a role of initial b may follow one of initial a, else 1."""
    return 0 if a + b in ("su", "ua", "au") else 1


def _choices(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Last block first: the state in which the cheapest way leaves each block, for every state it can be entered in."""
    conv, started, ahead = None, False, []
    for batch in rows:
        out = []
        for key, costs, ranks in zip(*(batch.column(i).to_pylist() for i in (0, 3, 4)), strict=True):
            if not started or key != conv:
                conv, started = key, True
                # Cost and order of the audit of what comes after: nothing, or the insertions at the end.
                ahead = [(INSERT * len(_AT_END[s]), len(_AT_END[s])) for s in range(4)]
            best = []
            for a in range(4):
                ways = [(costs[4 * a + b] + ahead[b][0], ranks[4 * a + b], ahead[b][1], b) for b in range(4) if costs[4 * a + b] >= 0]
                best.append(min(ways))
            order = sorted({(r, then) for _, r, then, _ in best})
            ahead = [(cost, order.index((r, then))) for cost, r, then, _ in best]
            out.append([b for *_, b in best])
        yield pa.RecordBatch.from_arrays([*batch.columns[:3], pa.array(out, pa.list_(pa.int32()))], ["conv", "part", "seq", "leave"])


def _entered(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """First block first: the state each block is entered and left in, and what its edge adds to the counts."""
    conv, started, state, role, turn = None, False, NOTHING, None, None
    for batch in rows:
        out = []
        columns = [c.to_pylist() for c in batch.columns]
        for key, _, _, leave, first_role, last_role, first_turn, last_turn in zip(*columns, strict=True):
            new = not started or key != conv
            if new:
                conv, started, state, role, turn = key, True, NOTHING, None, None
            illegal = 0 if new else legal_after(role, first_role)
            again = int(turn is not None and first_turn == turn)
            out.append((state, leave[state], new, illegal, again))
            state, role, turn = leave[state], last_role, last_turn if last_turn is not None else turn
        columns = [pa.array(list(x), t) for x, t in zip(zip(*out, strict=True), (pa.int32(), pa.int32(), pa.bool_(), pa.int64(), pa.int64()), strict=True)]
        names = ["conv", "part", "seq", "entered", "left", "first", "edge_illegal", "edge_turns"]
        yield pa.RecordBatch.from_arrays([*batch.columns[:3], *columns], names)


_REPAIRED = pa.list_(pa.struct([("role", pa.string()), ("text", pa.string())]))


def _followed(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The audit and the repaired rows of every block."""
    for batch in rows:
        audits, repaired = [], []
        columns = [batch.column(i).to_pylist() for i in range(4, 10)]
        for last, entered, left, audit, entries, forced in zip(*columns, strict=True):
            listed = [(e["role"], e["text"], n) for e, n in zip(entries, forced, strict=True)]
            letters, kept = follow(audit, entered, listed)
            if last:
                more, end = follow(_AT_END[left], left, [])
                letters, kept = letters + more, kept + end
            audits.append(letters)
            repaired.append([{"role": r, "text": t} for r, t in kept])
        names = ["conv", "part", "seq", "first", "last", "audit", "repaired"]
        yield pa.RecordBatch.from_arrays([*batch.columns[:5], pa.array(audits, pa.string()), pa.array(repaired, _REPAIRED)], names)


def repair(df: DataFrame, key: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> tuple[DataFrame, DataFrame]:
    """Counts of every conversation with rows, and the repaired conversations block by block.

    Counts: ``conv``, ``gaps``, ``blank``, ``duplicate``, ``truncated``, ``illegal``, ``cost``. Blocks: ``conv``, ``part`` and ``seq``
    (their order in a conversation), ``first`` and ``last`` (of it), ``audit``, ``repaired`` (role and text of each row).
    """
    base = df.select(
        F.col(f"`{key}`").alias("conv"),
        F.col(f"`{turn}`").cast("bigint").alias("turn"),
        F.coalesce(F.col(f"`{role}`"), F.lit(" ")).alias("role"),
        F.coalesce(F.col(f"`{text}`"), F.lit(" ")).alias("text"),
    )
    kind = base.schema["conv"].dataType.simpleString()
    blank = ~F.col("text").rlike(r"[^\x20\x09-\x0D]")
    truncated = ~F.col("text").rlike(r"[.!?][\x20\x09-\x0D]*\z")
    digest = F.sha2(F.concat(F.length("role").cast("string"), F.lit(":"), "role", "text").cast("binary"), 256)
    counted = base.groupBy("conv", "turn", "role", digest.alias("digest"), blank.alias("blank")).agg(F.count(F.lit(1)).alias("copies"))
    firsts = (
        base.where(~blank)
        .groupBy("conv", "role", "text")
        .agg(F.min("turn").alias("least"), F.max(F.col("turn").isNull()).alias("none"))
        .select("conv", F.when(~F.col("none"), F.col("least")).alias("turn"), "role", digest.alias("digest"), F.lit(False).alias("blank"),
                F.lit(1).cast("bigint").alias("copies"), F.lit(True).alias("first"), truncated.alias("truncated"), "text")
    )
    rest = counted.select("*", F.lit(False).alias("first"), F.lit(False).alias("truncated"), F.lit(None).cast("string").alias("text"))
    order = ["conv", "turn", "role", "digest"]
    records = rest.unionByName(firsts).select(*order, "first", "blank", "truncated", "copies", "text")
    records = records.repartitionByRange(*order).sortWithinPartitions(*order, F.desc("first"))
    shape = (
        f"conv {kind}, part int, seq bigint, roles array<string>, texts array<string>, forced array<bigint>, blank bigint, duplicate bigint, "
        "truncated bigint, illegal bigint, turns bigint, first_turn bigint, last_turn bigint, first_role string, last_role string, "
        "costs array<bigint>, ranks array<int>, audits array<string>"
    )
    arrow = to_arrow_schema(_parse_datatype_string(shape))
    blocks = stored(map_batches(records, lambda rows: _blocks(rows, arrow), shape))
    backward = blocks.select("conv", "part", "seq", "costs", "ranks").repartition("conv").sortWithinPartitions("conv", F.desc("part"), F.desc("seq"))
    leaves = map_batches(backward, _choices, f"conv {kind}, part int, seq bigint, leave array<int>")
    edges = blocks.select("part", "seq", "first_role", "last_role", "first_turn", "last_turn")
    forward = leaves.join(edges, ["part", "seq"]).select("conv", "part", "seq", "leave", "first_role", "last_role", "first_turn", "last_turn")
    forward = forward.repartition("conv").sortWithinPartitions("conv", "part", "seq")
    states = "entered int, left int, first boolean, edge_illegal bigint, edge_turns bigint"
    entered = map_batches(forward, _entered, f"conv {kind}, part int, seq bigint, {states}")
    final = entered.groupBy("conv").agg(F.max(F.struct("part", "seq")).alias("end"))
    entered = stored(entered.join(final.withColumnRenamed("conv", "whose"), F.col("conv").eqNullSafe(F.col("whose"))).select(
        "part", "seq", "entered", "left", "first", "edge_illegal", "edge_turns", (F.struct("part", "seq") == F.col("end")).alias("last")))
    way = F.col("entered") * 4 + F.col("left") + 1
    settled = blocks.join(entered, ["part", "seq"])
    end_cost = F.when(F.col("last"), F.when(F.col("left") == SYSTEM, 2 * INSERT).when(F.col("left") == USER, INSERT).otherwise(0)).otherwise(0)
    counts = settled.groupBy("conv").agg(
        F.coalesce(F.max("last_turn") - F.min("first_turn") + 1 - (F.sum("turns") - F.sum("edge_turns")), F.lit(0)).alias("gaps"),
        *(F.sum(c).alias(c) for c in ("blank", "duplicate", "truncated")),
        F.sum(F.col("illegal") + F.col("edge_illegal")).alias("illegal"),
        F.sum(F.element_at("costs", way) + end_cost).alias("cost"),
    )
    entries = F.arrays_zip(F.col("roles").alias("role"), F.col("texts").alias("text"))
    chosen = settled.select("conv", "part", "seq", "first", "last", "entered", "left", F.element_at("audits", way).alias("audit"), entries.alias("entries"), "forced")
    shape = f"conv {kind}, part int, seq bigint, first boolean, last boolean, audit string, repaired array<struct<role:string,text:string>>"
    return counts, map_batches(chosen, _followed, shape)


def digests(blocks: DataFrame) -> DataFrame:
    """``conv``, its whole ``audit``, and the SHA-256 of its repaired rows as ``role:text`` lines.

    A conversation of one block is read in place; the blocks of longer ones stream through a task in their order.
    """
    kind = blocks.schema["conv"].dataType.simpleString()
    lines = F.array_join(F.transform("repaired", lambda r: F.concat(r["role"], F.lit(":"), r["text"])), "\n")
    listed = blocks.select("conv", "part", "seq", "first", "last", "audit", F.size("repaired").alias("n"), lines.alias("lines"))
    short = listed.where("first and last").select("conv", "audit", F.sha2(F.col("lines").cast("binary"), 256).alias("repaired_sha256"))
    long = listed.where("not (first and last)").repartition("conv").sortWithinPartitions("conv", "part", "seq")

    def hashed(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, audit, empty = hashlib.sha256(), [], True
        for batch in rows:
            for conv, first, last, letters, n, text in zip(*(batch.column(i).to_pylist() for i in (0, 3, 4, 5, 6, 7)), strict=True):
                if first:
                    held, audit, empty = hashlib.sha256(), [], True
                if n:
                    held.update(text.encode() if empty else b"\n" + text.encode())
                    empty = False
                audit.append(letters)
                if last:
                    found = [pa.array([conv], batch.column(0).type), pa.array(["".join(audit)], pa.string()), pa.array([held.hexdigest()], pa.string())]
                    yield pa.RecordBatch.from_arrays(found, ["conv", "audit", "repaired_sha256"])

    return short.unionByName(map_batches(long, hashed, f"conv {kind}, audit string, repaired_sha256 string"))


def with_every_key(df: DataFrame, counts: DataFrame, found: DataFrame, key: str = "conv_id") -> DataFrame:
    """Counts, audits and digests of every key of ``df``; a key without rows left has zeros and empty results."""
    numbers = [c for c in counts.columns if c != "conv"]
    keys = df.select(F.col(f"`{key}`").alias("conv")).distinct()
    none: list[Column] = [F.lit(0).cast("bigint").alias(c) for c in numbers]
    every = keys.select("conv", *none).unionByName(counts).groupBy("conv").agg(*(F.sum(c).alias(c) for c in numbers))
    joined = every.join(found.withColumnRenamed("conv", "whose"), F.col("conv").eqNullSafe(F.col("whose")), "left").drop("whose")
    empty = {"audit": "", "repaired_sha256": hashlib.sha256(b"").hexdigest()}
    return joined.fillna(empty, list(empty)).withColumnRenamed("conv", key)
