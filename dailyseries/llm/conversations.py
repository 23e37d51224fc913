"""Conversation structure repair by a square-root checkpointed DP.

Faults of a row (blank, duplicate, truncated) and the class of its role are one
byte of code, so a conversation is a string of codes.  The cheapest edits
bring the roles into the form ``(s?(ua)+)?``: optionally system, then user and
assistant in turn, or nothing.

The automaton of that form has four states.  A backward pass gives each state
its cost to the end, and keeps the cost vectors only at every
``sqrt(n)``-th row; the forward walk recomputes one block of vectors at a time
and emits, of the edits that keep the cost tight, the ASCII-least one.  Memory
is one byte a row and a multiple of ``sqrt(n)`` vectors.

Rows are ordered by a range partitioning of narrow rows (no texts), which may
cut a conversation anywhere; every task turns its run of rows into pieces of
codes, and only these bytes meet per conversation.  Texts are shuffled
once, beside the audit string, to be written in their repaired form.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from itertools import chain, groupby
from math import isqrt

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from dailyseries.llm.common import materialize, rows_of

# fixed values: the contract's edit costs
KEEP, INSERT, REROLE, DELETE, TRUNCATED = 0, 3, 3, 4, 3
SYSTEM, USER, ASSISTANT, OTHER = range(4)             # class of a role, by its initial
FINE, BLANK, DUPLICATE, CUT = range(4)                # first fault of a row
START, AFTER_S, AFTER_U, AFTER_A = range(4)           # states; the text may end in START and AFTER_A
INF = 1 << 62
NEXT_ROLE = (AFTER_U, AFTER_U, AFTER_A, AFTER_U)      # state after the user or assistant that a state asks for
ROLE_NAME = {AFTER_U: "user", AFTER_A: "assistant"}
KEPT = {(START, SYSTEM): AFTER_S, (START, USER): AFTER_U, (AFTER_S, USER): AFTER_U, (AFTER_A, USER): AFTER_U,
        (AFTER_U, ASSISTANT): AFTER_A}
LEGAL = {(SYSTEM, USER), (USER, ASSISTANT), (ASSISTANT, USER)}
PIECE = 1 << 16       # codes in a piece
SPACE = "\x20\x09\x0A\x0B\x0C\x0D"


def code(role: int, fault: int) -> int:
    return 4 * role + fault


def _edits(role: int, fault: int, state: int) -> list[tuple[str, int, int]]:
    """(letter, cost, next state) of the edits of a row, in ASCII order."""
    out = [("D", DELETE, state)]
    if fault in (FINE, CUT):
        more = TRUNCATED if fault == CUT else 0
        if (state, role) in KEPT:
            out.append(("K", KEEP + more, KEPT[state, role]))
        out.append(("R", REROLE + more, NEXT_ROLE[state]))
    return out


EDITS = [[_edits(c // 4, c % 4, s) for s in range(4)] for c in range(16)]


def _with_inserts(base: list[int]) -> tuple[int, ...]:
    """Costs to go when user and assistant may be inserted first."""
    u, a = min(base[AFTER_U], INSERT + base[AFTER_A]), min(base[AFTER_A], INSERT + base[AFTER_U])
    return min(base[START], INSERT + u), min(base[AFTER_S], INSERT + u), u, a


END = _with_inserts([0, INF, INF, 0])


def _back(after: tuple[int, ...], c: int) -> tuple[int, ...]:
    """Cost vector before a row of code ``c`` from that behind it."""
    return _with_inserts([min(cost + after[to] for _, cost, to in edits) for edits in EDITS[c]])


def cheapest_edits(codes: bytes) -> tuple[int, str]:
    """(cost, ASCII-least letters) of the cheapest edits of a conversation."""
    n = len(codes)
    step = isqrt(n) + 1
    checkpoints, after = {}, END
    for i in range(n - 1, -1, -1):
        if (i + 1) % step == 0:
            checkpoints[i + 1] = after
        after = _back(after, codes[i])
    state, total, out = START, after[START], []
    for at in range(0, n, step):
        end = min(n, at + step)
        block = [checkpoints.get(end, END)]  # vectors at end, end - 1, ..., at
        for i in range(end - 1, at - 1, -1):
            block.append(_back(block[-1], codes[i]))
        for i in range(at, end):
            here, behind = block[end - i], block[end - i - 1]
            while True:
                tight = [(letter, to) for letter, cost, to in EDITS[codes[i]][state] if cost + behind[to] == here[state]]
                to = NEXT_ROLE[state]
                if tight and not (tight[0][0] > "I" and INSERT + here[to] == here[state]):
                    letter, state = tight[0]
                    out.append(letter)
                    break
                out.append("I")
                state = to
    while END[state]:
        out.append("I")
        state = NEXT_ROLE[state]
    return total, "".join(out)


# ------------------------------------------------------------------ rows to codes
def prepared(rows: DataFrame, copies=None) -> DataFrame:
    """(conv_id, turn, role, digest, text, code, copies) of conversation rows; a
    row counts ``copies`` times (default once; 0 keeps the conversation only)."""
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("role", "text"))
    initial, bare = F.substring("role", 1, 1), F.rtrim("text", F.lit(SPACE))
    cls = F.when(initial == "s", SYSTEM).when(initial == "u", USER).when(initial == "a", ASSISTANT).otherwise(OTHER)
    fault = F.when(bare == "", BLANK).when(F.substring(bare, -1, 1).isin(".", "!", "?"), FINE).otherwise(CUT)
    return (rows.select("conv_id", F.col("turn").cast("long").alias("turn"), role.alias("role"), text.alias("text"),
                        (F.lit(1) if copies is None else copies).cast("int").alias("copies"))
            .select("conv_id", "turn", "role", F.unhex(F.sha2("text", 256)).alias("digest"), "text",
                    (4 * cls + fault).alias("code"), "copies"))


def _schema(rows: DataFrame, columns: str) -> T.StructType:
    return T.StructType([rows.schema["conv_id"], *T.StructType.fromDDL(columns).fields])


def _batches(rows: Iterator[tuple], types: list[pa.DataType], size: int = 1000) -> Iterator[pa.RecordBatch]:
    """Arrow batches of ``rows``; as many as ``size`` are held at a time."""
    held: list[tuple] = []

    def batch() -> pa.RecordBatch:
        out = pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*held), types, strict=True)],
                                         names=[str(k) for k in range(len(types))])
        held.clear()
        return out

    for row in rows:
        held.append(row)
        if len(held) >= size:
            yield batch()
    if held:
        yield batch()


def mapped(step: Callable[[Iterator[tuple]], Iterator[tuple]], columns: str):
    """An Arrow map from a function over the rows of a partition; its output has
    conv_id, of the type that comes in, and ``columns``."""
    kinds = {"long": pa.int64(), "string": pa.string(), "binary": pa.binary()}
    names, types = zip(*((name, kinds[kind]) for name, kind in map(str.split, columns.split(","))), strict=True)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        head = next(batches, None)
        if head is not None:
            rows = (row for batch in chain((head,), batches) for row in rows_of(batch))
            for out in _batches(step(rows), [head.schema.field(0).type, *types]):
                yield out.rename_columns(["conv_id", *names])

    return run


PIECES = "turn long, role string, digest binary, codes binary, low long, high long, turns long"


def pieces(rows: Iterator[tuple]) -> Iterator[tuple]:
    """Sorted rows (conv_id, turn, role, digest, code, first, count) as pieces of
    up to ``PIECE`` codes each (or those of one row), led by the key of their
    first row, with the least, the largest and the number of turns."""
    lead, codes, turns = None, bytearray(), (None, None, 0)
    for conv, turn, role, digest, one, first, count in rows:
        if lead is not None and (conv != lead[0] or len(codes) >= PIECE):
            yield (*lead, bytes(codes), *turns)
            lead = None
        if lead is None:
            lead, codes, turns = (conv, turn, role, digest), bytearray(), (None, None, 0)
        if count and turn is not None and turn != turns[1]:
            turns = (turn if turns[0] is None else turns[0], turn, turns[2] + 1)
        again = one if one % 4 == BLANK else one - one % 4 + DUPLICATE
        codes.extend(bytes([one if first else again] * (count > 0)) + bytes([again]) * (count - 1))
    if lead is not None:
        yield (*lead, bytes(codes), *turns)


def coded_pieces(rows: DataFrame) -> DataFrame:
    """The pieces of all conversations of :func:`prepared` rows.

    Equal rows of a turn are one row with a count.  A role and text were seen
    earlier if the pair has an earlier turn in the conversation, so the first
    turns come from an aggregation, and no group is sorted to find them."""
    key = ["conv_id", "turn", "role", "digest"]
    there = F.col("copies") > 0
    rows = (rows.select("conv_id", *[F.when(there, F.col(c)).alias(c) for c in [*key[1:], "code"]], "copies")
            .groupBy(*key, "code").agg(F.sum("copies").alias("c")))
    rows = materialize(rows, "cv-rows")
    place = F.struct(F.col("turn").isNotNull().alias("h"), F.col("turn").alias("t"))  # nulls first
    firsts = (rows.where("c > 0").groupBy("conv_id", "role", "digest").agg(F.min(place).alias("f"), F.count("*").alias("m"))
              .where("m > 1").select(F.col("conv_id").alias("f_id"), F.col("role").alias("f_role"),
                                     F.col("digest").alias("f_digest"), "f"))
    same = (rows["conv_id"].eqNullSafe(firsts["f_id"]) & (rows["role"] == firsts["f_role"])
            & (rows["digest"] == firsts["f_digest"]))
    first = F.col("f").isNull() | (place == F.col("f"))
    order = [F.col(c).asc_nulls_first() for c in key]
    ordered = (rows.join(firsts, same, "left")
               .select(*key, F.coalesce("code", F.lit(0)).alias("code"), first.alias("first"), "c")
               .repartitionByRange(*order).sortWithinPartitions(*order))
    return materialize(ordered.mapInArrow(mapped(pieces, PIECES), _schema(ordered, PIECES)), "cv-pieces")


# ---------------------------------------------------------------- codes to audits
AUDIT = "gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string"


def counts_of(codes: bytes) -> tuple[int, int, int, int]:
    """(blank, duplicate, truncated, illegal) of a conversation."""
    c = np.frombuffer(codes, np.uint8)
    role, faults = c >> 2, np.bincount(c & 3, minlength=4)
    legal = np.zeros(16, bool)
    legal[[4 * a + b for a, b in LEGAL]] = True
    return int(faults[BLANK]), int(faults[DUPLICATE]), int(faults[CUT]), int((~legal[4 * role[:-1] + role[1:]]).sum())


def audits(rows: Iterator[tuple]) -> Iterator[tuple]:
    """Sorted pieces (conv_id, codes, low, high, turns) as one audit row a
    conversation."""
    for conv, own in groupby(rows, lambda r: r[0]):
        codes, low, high, n = bytearray(), None, None, 0
        for _, part, first, last, turns in own:
            codes.extend(part)
            if turns:
                n += turns - (first == high)  # a turn on both sides of a cut counts once
                low, high = first if low is None else low, last
        gaps = high - low + 1 - n if n else 0
        yield (conv, gaps, *counts_of(bytes(codes)), *cheapest_edits(bytes(codes)))


def audited(rows: DataFrame) -> DataFrame:
    """(conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit) of
    :func:`prepared` rows, one row a conversation."""
    order = [F.col(c).asc_nulls_first() for c in ("conv_id", "turn", "role", "digest")]
    runs = (coded_pieces(rows).repartition("conv_id").sortWithinPartitions(*order)
            .select("conv_id", "codes", "low", "high", "turns"))
    return runs.mapInArrow(mapped(audits, AUDIT), _schema(runs, AUDIT))


# ---------------------------------------------------------------- audits to texts
def repaired_lines(audit: str, rows: Iterator[tuple[str, str, int]]) -> Iterator[tuple[str, str, str]]:
    """(edit, role, text) of the lines that stay or come in, from the rows (role,
    text, copies) of a conversation in order."""
    edits, state = iter(audit), START
    for role, text, copies in rows:
        for _ in range(copies):
            for edit in edits:  # inserts come before the row's own edit
                if edit == "K":
                    state = KEPT[state, "sua".find(role[:1])]
                    yield edit, role, text
                elif edit != "D":
                    state = NEXT_ROLE[state]
                    yield edit, ROLE_NAME[state], "" if edit == "I" else text
                if edit != "I":
                    break
    for edit in edits:
        state = NEXT_ROLE[state]
        yield edit, ROLE_NAME[state], ""


def _conversations(rows: Iterator[tuple]) -> Iterator[tuple[tuple, Iterator[tuple]]]:
    """(conv_id, audit columns) and the repaired lines of each conversation; the
    rows (conv_id, role, text, copies, audit columns) begin with the audit's."""
    number = 0

    def which(row: tuple) -> int:
        nonlocal number
        number += row[-1] is not None
        return number

    for _, own in groupby(rows, which):
        head = next(own)
        yield (head[0], *head[4:]), repaired_lines(head[-1], (row[1:4] for row in own))


def digests(rows: Iterator[tuple]) -> Iterator[tuple]:
    """The audit columns and the SHA-256 of the repaired ``role:text`` lines."""
    for head, lines in _conversations(rows):
        sha, glue = hashlib.sha256(), ""
        for _, role, text in lines:
            sha.update(f"{glue}{role}:{text}".encode())
            glue = "\n"
        yield (*head, sha.hexdigest())


def numbered(rows: Iterator[tuple]) -> Iterator[tuple]:
    """Every repaired line with its place in the conversation."""
    for head, lines in _conversations(rows):
        yield from ((head[0], place, *line) for place, line in enumerate(lines))


def _beside_audit(rows: DataFrame, step, columns: str) -> DataFrame:
    rows = materialize(rows, "cv-prepared")
    found = audited(rows.drop("text"))
    fields = found.columns[1:]
    none = [F.lit(None).cast(found.schema[c].dataType).alias(c) for c in fields]
    order = [F.col(c).asc_nulls_first() for c in ("conv_id", "is_row", "turn", "role", "digest")]
    lines = rows.where("copies > 0").select("conv_id", F.lit(True).alias("is_row"), "turn", "role", "digest", "text",
                                            "copies", *none)
    heads = found.select("conv_id", F.lit(False).alias("is_row"), F.lit(None).cast("long").alias("turn"),
                         F.lit("").alias("role"), F.lit(None).cast("binary").alias("digest"), F.lit("").alias("text"),
                         F.lit(0).alias("copies"), *fields)
    both = (lines.unionByName(heads).repartition("conv_id").sortWithinPartitions(*order)
            .select("conv_id", "role", "text", "copies", *fields))
    return both.mapInArrow(mapped(step, columns), _schema(both, columns))


def repair(rows: DataFrame, copies=None) -> DataFrame:
    """(conv_id, place, edit, role, text): the lines of every conversation after
    the cheapest edits (K, R or I), numbered from 0.

    Null roles and texts are one space.  Rows go by turn, nulls first; rows of
    one turn by role, then by the SHA-256 of the text, and equal ones stay
    together.  A row's first fault counts: blank (only white space),
    duplicate (role and text seen earlier), truncated (the last character that
    is not white space is none of ``.!?``).  Keep costs 0, Rerole 3, Delete 4
    (required for blank and duplicate rows), Insert 3, and truncated rows that
    stay add 3.  A role counts by its first character; one other than s, u
    and a, or an empty one, can't be kept.  A null conv_id is a conversation
    like any other.  A conversation may be of any length: it takes one byte
    a row where it comes together, and long texts are passed on one at a time.
    Rows count ``copies`` times, once if None.  Other columns are not read,
    whatever their names; an empty table gives no rows.
    """
    return _beside_audit(prepared(rows, copies), numbered, "place long, edit string, role string, text string")


def report(rows: DataFrame, copies=None) -> DataFrame:
    """(conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit,
    repaired_sha256): one row a conversation, under the rules of
    :func:`repair`.

    ``gaps`` counts the turns missing between the least and the largest, nulls
    aside; ``illegal`` the neighbours whose initials are not su, ua or au;
    ``audit`` has the initials of the cheapest edits, the ASCII-least of equal
    cost.  A conversation whose rows all count 0 times has zeros, an empty
    audit and the digest of nothing.
    """
    return _beside_audit(prepared(rows, copies), digests, f"{AUDIT}, repaired_sha256 string")


# --------------------------------------------------------------- the query's damage
def damage(rows: DataFrame) -> tuple[DataFrame, Column]:
    """``rows`` damaged by crc32 of ``conv_id:turn`` (nulls: one space) modulo 20,
    and how often each row counts: 0 drops it, 1 empties the text, 2 removes
    its ``[.!?]``, 3 repeats it, 4 makes the role user."""
    conv, turn, role, text = (F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("conv_id", "turn", "role", "text"))
    hit = F.crc32(F.concat(conv, F.lit(":"), turn).cast("binary")) % 20
    return rows.select(
        "conv_id", "turn", F.when(hit == 4, F.lit("user")).otherwise(role).alias("role"),
        F.when(hit == 1, F.lit("")).when(hit == 2, F.translate(text, ".!?", "")).otherwise(text).alias("text"),
        F.when(hit == 0, 0).when(hit == 3, 2).otherwise(1).alias("copies")), F.col("copies")
