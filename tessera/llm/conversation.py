"""Conversation structure repair: Hirschberg's divide and conquer over four states.

The roles that stay must read ``(s?(ua)+)?`` by their initials. After a row a
conversation is in one of four states: nothing yet, after system, after user,
after assistant. From a state each edit leads to one state only, so the edits'
initials (the audit) tell the whole repair, and the audits of a run of rows
that ends with a row's own edit are prefix-free. A forward vector holds, for
each state, the least cost of reaching it and the order of its least audit
among the four; a backward vector holds the least cost from it to the end.
Both meet mid-conversation, the audit-least of the optimal crossings is taken,
and the halves are solved in turn, which needs space for the rows' kinds and
two vectors.

All rows are range-partitioned by conversation and turn and written once, so
that a conversation with a large share of the rows covers many partitions.
Conversations that lie inside one partition are solved where they are. One that
crosses a boundary (at most one per boundary, a list that is broadcast) is cut
into one segment per partition: segments exchange which texts were seen before,
each gives a 4 x 4 table of costs and orders, one short fold per conversation
picks the crossings at the boundaries, and each segment solves its own part.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import cache, lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessera.llm.common import SPACES, ddl, map_batches, pin

DELETE, RESET, INSERT, TRUNCATED = 3, 2, 2, 1
#: The state after each role, by the state before it.
AFTER = {"s": {0: 1}, "u": {0: 2, 1: 2, 3: 2}, "a": {2: 3}}
#: The state after the one role that may be written from each state, and its name.
WRITTEN = {0: 2, 1: 2, 2: 3, 3: 2}
NAMES = {2: "user", 3: "assistant"}
#: Inserts that end a conversation from each state.
TAIL = ("", "II", "I", "")
EXITS = tuple(INSERT * len(t) for t in TAIL)
START = ((0, 0), None, None, None)
#: Kinds of rows: 0 must go; 1 to 4 and, truncated, 5 to 8 by initial.
INITIALS = "suax"
#: Edits of one piece, and bytes of text after which it ends.
PIECE_EDITS, PIECE_BYTES = 1024, 1 << 22

EDITS = "array<struct<edit:string,turn:bigint,role:string,text:string>>"
COUNTS = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")
PIECES = "place bigint, whole boolean, " + "".join(f"{c} bigint, " for c in COUNTS) + f"edits {EDITS}"


# --- one conversation -------------------------------------------------------

@cache
def moves(kind: int) -> tuple:
    """From each state to each state over a row: the least ``(cost, audit)``, inserts before it included."""
    out = []
    for state in range(4):
        best, at, cost, audit = [None] * 4, state, 0, ""
        for _ in range(3):  # more inserts lead back to a state already left
            offers = [(at, cost + DELETE, audit + "D")]
            if kind:
                late = TRUNCATED if kind > 4 else 0
                kept = AFTER.get(INITIALS[(kind - 1) % 4], {}).get(at)
                if kept is not None:
                    offers.append((kept, cost + late, audit + "K"))
                offers.append((WRITTEN[at], cost + RESET + late, audit + "R"))
            for to, c, a in offers:
                if best[to] is None or (c, a) < best[to]:
                    best[to] = (c, a)
            at, cost, audit = WRITTEN[at], cost + INSERT, audit + "I"
        out.append(tuple(best))
    return tuple(out)


def _ranked(best: list) -> tuple[int, tuple]:
    """``(cost, order...)`` of each state as a front: costs above the least one, orders as ranks."""
    least = min(b[0] for b in best if b is not None)
    order = sorted(b[1:] for b in best if b is not None)
    return least, tuple(None if b is None else (b[0] - least, order.index(b[1:])) for b in best)


@lru_cache(1 << 14)
def _ahead(front: tuple, kind: int) -> tuple[int, tuple]:
    best = [None] * 4
    for f, row in zip(front, moves(kind)):
        if f is not None:
            for to, m in enumerate(row):
                if m is not None and (best[to] is None or (f[0] + m[0], f[1], m[1]) < best[to]):
                    best[to] = (f[0] + m[0], f[1], m[1])
    return _ranked(best)


@lru_cache(1 << 14)
def _back(costs: tuple, kind: int) -> tuple:
    out = [min((m[0] + c for m, c in zip(row, costs) if m is not None and c is not None), default=None) for row in moves(kind)]
    least = min(c for c in out if c is not None)
    return tuple(None if c is None else c - least for c in out)


def forward(kinds: bytes, front: tuple, lo: int, hi: int) -> tuple[int, tuple]:
    total = 0
    for k in range(lo, hi):
        more, front = _ahead(front, kinds[k])
        total += more
    return total, front


def backward(kinds: bytes, costs: tuple, lo: int, hi: int) -> tuple:
    for k in range(hi - 1, lo - 1, -1):
        costs = _back(costs, kinds[k])
    return costs


def _only(state: int, value) -> tuple:
    return tuple(value if s == state else None for s in range(4))


def solve(kinds: bytes, entry: int, exits: tuple, out: list[str], lo: int, hi: int) -> int:
    """Write the audit of each row into ``out``; return the state behind the last one."""
    if lo == hi:
        return entry
    if hi - lo == 1:
        to = min((s for s in range(4) if exits[s] is not None and moves(kinds[lo])[entry][s] is not None),
                 key=lambda s: (moves(kinds[lo])[entry][s][0] + exits[s], moves(kinds[lo])[entry][s][1]))
        out[lo] = moves(kinds[lo])[entry][to][1]
        return to
    mid = (lo + hi) // 2
    front = forward(kinds, _only(entry, (0, 0)), lo, mid)[1]
    behind = backward(kinds, exits, mid, hi)
    cross = min((s for s in range(4) if front[s] is not None and behind[s] is not None),
                key=lambda s: (front[s][0] + behind[s], front[s][1]))
    solve(kinds, entry, _only(cross, 0), out, lo, mid)
    return solve(kinds, cross, exits, out, mid, hi)


def audits(kinds: bytes, entry: int = 0, exits: tuple = EXITS) -> tuple[tuple[str, ...], int]:
    """The audit of each row, and the state behind the last row."""
    return _short(kinds, entry, exits) if len(kinds) <= 64 else _solved(kinds, entry, exits)


def _solved(kinds: bytes, entry: int, exits: tuple) -> tuple[tuple[str, ...], int]:
    out = [""] * len(kinds)
    last = solve(kinds, entry, exits, out, 0, len(kinds))
    return tuple(out), last


_short = lru_cache(1 << 16)(_solved)


def cost_of(kinds: bytes, rows: tuple[str, ...], tail: str) -> int:
    price = {"K": 0, "R": RESET, "D": DELETE}
    return sum(INSERT * (len(a) - 1) + price[a[-1]] + (TRUNCATED if k > 4 and a[-1] != "D" else 0)
               for k, a in zip(kinds, rows)) + INSERT * len(tail)


# --- rows -------------------------------------------------------------------

def _text(col: Column) -> Column:
    return F.coalesce(col.cast("string"), F.lit(" "))


def damage(rows: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
           text_col: str = "text") -> DataFrame:
    """``conv, turn, role, text, gone``: the rows with the faults that
    ``crc32(conv:turn) % 20`` names: 0 drops a row, 1 empties its text, 2
    removes its ``.!?``, 3 repeats it, 4 sets role user. Nulls count as one
    space, but a null conversation or turn stays null. Dropped rows are kept
    with ``gone`` true, so that their conversation is known. No rows give none.
    """
    conv, turn, role, text = (rows[c] for c in (conv_col, turn_col, role_col, text_col))
    fault = F.crc32(F.concat(_text(conv), F.lit(":"), _text(turn))) % 20
    return rows.select(
        conv.alias("conv"), turn.cast("bigint").alias("turn"), F.when(fault == 4, "user").otherwise(_text(role)).alias("role"),
        F.when(fault <= 1, "").when(fault == 2, F.translate(_text(text), ".!?", "")).otherwise(_text(text)).alias("text"),
        (fault == 0).alias("gone"), F.explode(F.array_repeat(F.lit(1), F.when(fault == 3, 2).otherwise(1))).alias("copy")).drop("copy")


def _marked(rows: DataFrame) -> DataFrame:
    """Add the kind of each row (duplicates aside) and a 128-bit key of role and text."""
    end = F.substring(F.rtrim(F.col("text"), F.lit("".join(SPACES))), -1, 1)
    at = F.coalesce(F.nullif(F.instr(F.lit(INITIALS[:3]), F.substring("role", 1, 1)), F.lit(0)), F.lit(4))
    at = F.when(F.col("role") == "", 4).otherwise(at)
    kind = (F.when(F.col("gone"), -1).when(end == "", 0).when(end.isin(".", "!", "?"), at).otherwise(at + 4)).cast("int")
    key = F.unhex(F.md5(F.concat(F.length("role").cast("string"), F.lit(":"), "role", "text")))
    return rows.select("conv", "turn", kind.alias("kind"), at.cast("int").alias("initial"), key.alias("key"), "role", "text")


class _Read:
    """Kinds and counts of consecutive rows of a conversation, without the dropped ones."""

    def __init__(self, turns: list, kinds: list, initials: list, keys: list, seen: set) -> None:
        self.at = [k for k, kind in enumerate(kinds) if kind >= 0]
        final, self.blank, self.duplicate, self.truncated = bytearray(), 0, 0, 0
        for k in self.at:
            kind = kinds[k]
            if not kind:
                self.blank += 1
            elif keys[k] in seen:
                self.duplicate += 1
                kind = 0
            elif kind > 4:
                self.truncated += 1
            seen.add(keys[k])
            final.append(kind)
        self.kinds = bytes(final)
        self.initials = "".join(INITIALS[initials[k] - 1] for k in self.at)
        self.illegal = sum(self.initials[k:k + 2] not in ("su", "ua", "au") for k in range(len(self.initials) - 1))
        known = [t for k in self.at if (t := turns[k]) is not None]
        self.turns = (known[0], known[-1], len(set(known))) if known else None


class _Pieces:
    """Output rows, gathered as positions of the input's rows and turned into Arrow arrays at once."""

    def __init__(self) -> None:
        self.at, self.edit, self.role, self.place, self.conv, self.whole = [], [], [], [], [], []
        self.counts, self.offsets = [], [0]

    def add(self, conv_at: int, rows: list[int], roles: list, sizes: list, kinds_audit: tuple[str, ...], state: int, tail: str,
            counts: tuple, place: int, closed: bool) -> None:
        """One conversation, or a segment of it: ``closed`` if it is the whole conversation."""
        begin, held, first = len(self.edit), 0, True

        def end(last: bool) -> None:
            nonlocal begin, held, first, place
            self.conv.append(conv_at)
            self.place.append(place)
            self.whole.append(closed and first and last)
            self.counts.append(counts if first else (0,) * len(COUNTS))
            self.offsets.append(len(self.edit))
            begin, held, first, place = len(self.edit), 0, False, place + 1

        def write(letter: str, at: int | None, role: str) -> None:
            self.edit.append(letter)
            self.at.append(at)
            self.role.append(role)

        for k, audit in zip(rows, kinds_audit):
            if len(self.edit) - begin >= PIECE_EDITS or held >= PIECE_BYTES:
                end(False)
            for _ in audit[:-1]:
                state = WRITTEN[state]
                write("I", None, NAMES[state])
            role = roles[k]
            if audit[-1] == "K":
                state = AFTER[role[0]][state]
            elif audit[-1] == "R":
                state = WRITTEN[state]
                role = NAMES[state]
            write(audit[-1], k, role)
            held += sizes[k] or 0
        for _ in tail:
            state = WRITTEN[state]
            write("I", None, NAMES[state])
        end(True)

    def rows(self, conv: pa.Array, turns: pa.Array, texts: pa.Array) -> dict:
        at = pa.array(self.at, pa.int32())
        edits = pa.StructArray.from_arrays(
            [pa.array(self.edit, pa.string()), turns.take(at), pa.array(self.role, pa.string()),
             texts.take(at).fill_null("")], names=["edit", "turn", "role", "text"])
        named = dict(zip(COUNTS, ([c[k] for c in self.counts] for k in range(len(COUNTS)))))
        return named | {"conv": conv.take(pa.array(self.conv, pa.int32())), "place": self.place, "whole": self.whole,
                        "edits": pa.ListArray.from_arrays(pa.array(self.offsets, pa.int32()), edits)}


def _gaps(spans: list[tuple]) -> int:
    """``spans``: first, last and distinct turns of consecutive segments in order."""
    if not spans:
        return 0
    same = sum(a[1] == b[0] for a, b in zip(spans, spans[1:]))
    return spans[-1][1] - spans[0][0] + 1 - (sum(s[2] for s in spans) - same)


def _arrays(batch: pa.RecordBatch | pa.Table, names: tuple[str, ...]) -> list:
    cols = [batch.column(n) for n in names]
    return [c.combine_chunks() if isinstance(c, pa.ChunkedArray) else c for c in cols]


def _solve_whole(table: pa.Table) -> dict:
    """Every conversation of sorted rows; rows of a conversation are adjacent."""
    conv, turn, text = _arrays(table, ("conv", "turn", "text"))
    turns, kinds, initials, keys, roles = (table.column(n).to_pylist() for n in ("turn", "kind", "initial", "key", "role"))
    sizes = pa.compute.binary_length(text).to_pylist()
    out = _Pieces()
    for lo, hi in _runs(conv):
        read = _Read(turns[lo:hi], kinds[lo:hi], initials[lo:hi], keys[lo:hi], set())
        rows, last = audits(read.kinds)
        tail = TAIL[last]
        counts = (_gaps([read.turns] if read.turns else []), read.blank, read.duplicate, read.truncated, read.illegal,
                  cost_of(read.kinds, rows, tail))
        out.add(lo, [lo + k for k in read.at], roles, sizes, rows, 0, tail, counts, 0, True)
    return out.rows(conv, turn, text)


def _runs(conv: pa.Array) -> list[tuple[int, int]]:
    """Start and end of each run of equal values."""
    n = len(conv)
    if not n:
        return []
    a, b = conv.slice(0, n - 1), conv.slice(1)
    differs = pa.compute.not_equal(a, b).fill_null(False).to_numpy(zero_copy_only=False)
    differs |= a.is_null().to_numpy(zero_copy_only=False) != b.is_null().to_numpy(zero_copy_only=False)
    cuts = [0, *(np.flatnonzero(differs) + 1).tolist(), n]
    return list(zip(cuts, cuts[1:]))


def _whole(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
    """The last conversation of a batch waits for the next one."""
    held: list[pa.Table] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        table = pa.Table.from_batches([batch])
        runs = _runs(_arrays(table, ("conv",))[0])
        same = bool(held) and held[-1].column("conv")[-1].as_py() == table.column("conv")[0].as_py()
        cut = runs[-1][0]
        if same and not cut:  # still the same conversation
            held.append(table)
            continue
        yield _solve_whole(pa.concat_tables([*held, table.slice(0, cut)]))
        held = [table.slice(cut)]
    if held:
        yield _solve_whole(pa.concat_tables(held))


# --- conversations that cross partitions ------------------------------------

SEGMENT = ("kinds binary, blank bigint, duplicate bigint, truncated bigint, illegal bigint, first string, last string, "
           "spans array<bigint>, costs array<bigint>, ranks array<int>")


def _segment(pdf: pd.DataFrame) -> pd.DataFrame:
    """Kinds, counts and the 4 x 4 table of one segment; rows of kind -2 name keys seen before."""
    seen = set(pdf.loc[pdf["kind"] == -2, "key"])
    own = pdf[pdf["kind"] != -2].sort_values("at")
    turns = [None if pd.isna(t) else int(t) for t in own["turn"]]
    read = _Read(turns, own["kind"].tolist(), own["initial"].tolist(), own["key"].tolist(), seen)
    costs, ranks = [], []
    for state in range(4):
        base, front = forward(read.kinds, _only(state, (0, 0)), 0, len(read.kinds))
        costs += [-1 if f is None else base + f[0] for f in front]
        ranks += [-1 if f is None else f[1] for f in front]
    return pd.DataFrame({
        "conv": pdf["conv"].iloc[:1].tolist(), "pid": [int(pdf["pid"].iloc[0])], "kinds": [read.kinds], "blank": [read.blank],
        "duplicate": [read.duplicate], "truncated": [read.truncated], "illegal": [read.illegal], "first": [read.initials[:1]],
        "last": [read.initials[-1:]], "spans": [list(read.turns) if read.turns else None], "costs": [costs], "ranks": [ranks]})


def _fold(pdf: pd.DataFrame) -> pd.DataFrame:
    """Entry and exit of each segment of a conversation (one short row each), and what its counts gain."""
    pdf = pdf.sort_values("pid", ignore_index=True)
    tables = [(np.reshape(c, (4, 4)), np.reshape(r, (4, 4))) for c, r in zip(pdf["costs"], pdf["ranks"])]
    behind = [list(EXITS)]
    for costs, _ in reversed(tables):
        behind.append([min(int(costs[s, t]) + behind[-1][t] for t in range(4) if costs[s, t] >= 0) for s in range(4)])
    behind.reverse()
    entry, at = [], 0
    for k, (costs, ranks) in enumerate(tables):
        entry.append(at)
        at = min((t for t in range(4) if costs[entry[-1], t] >= 0),
                 key=lambda t: (int(costs[entry[-1], t]) + behind[k + 1][t], int(ranks[entry[-1], t])))
    spans = [tuple(int(v) for v in s) for s in pdf["spans"] if s is not None]
    extra, before = [], ""
    for first, last in zip(pdf["first"], pdf["last"]):
        extra.append(int(bool(before and first) and before + first not in ("su", "ua", "au")))
        before = last or before
    n = len(pdf)
    return pdf.assign(entry=entry, exit=[*entry[1:], at], closing=[k == n - 1 for k in range(n)], illegal=pdf["illegal"] + extra,
                      gaps=[_gaps(spans)] + [0] * (n - 1))[[
                          "conv", "pid", "kinds", "entry", "exit", "closing", "gaps", "blank", "duplicate", "truncated", "illegal"]]


def _finish(rows: pa.Table, plan: pa.Table) -> pa.Table:
    """The pieces of one segment."""
    rows = rows.sort_by("at")
    p = plan.to_pylist()[0]
    conv, turn, text = _arrays(rows, ("conv", "turn", "text"))
    kinds, roles, sizes = rows.column("kind").to_pylist(), rows.column("role").to_pylist(), pa.compute.binary_length(text).to_pylist()
    made, last = audits(p["kinds"], p["entry"], _only(p["exit"], 0))
    tail = TAIL[last] if p["closing"] else ""
    counts = (p["gaps"], p["blank"], p["duplicate"], p["truncated"], p["illegal"], cost_of(p["kinds"], made, tail))
    out = _Pieces()
    out.add(0, [k for k, kind in enumerate(kinds) if kind >= 0], roles, sizes, made, p["entry"], tail, counts, p["pid"] << 32, False)
    made = out.rows(conv, turn, text)
    names = ["conv", "place", "whole", *COUNTS, "edits"]
    return pa.table({n: made[n] if isinstance(made[n], pa.Array) else pa.array(made[n], pa.bool_() if n == "whole" else pa.int64())
                     for n in names})


def repair(rows: DataFrame, partitions: int | None = None) -> DataFrame:
    """Repair conversations given as ``conv, turn, role, text, gone`` (see ``damage``).

    Returns pieces: ``conv``, ``place`` (order of the pieces of a conversation),
    ``whole`` (the only piece), the counts ``gaps, blank, duplicate, truncated,
    illegal, cost`` (to be added up over the pieces), and ``edits`` in order:
    the edit's initial (Keep, Rerole, Delete, Insert), the turn, the role and
    the text that stay or, of a Delete, that go.

    Rows are taken by turn, nulls first; rows of one turn by role and then by
    a hash of role and text. Equal rows are adjacent, and all but the first are
    duplicates. Texts count as seen when role and 128-bit hash are equal. Null
    roles and texts count as one space; null ``gone`` as false; a null
    conversation is one conversation; an empty role has no initial and cannot
    be kept. A conversation whose rows are all gone has one piece without
    edits. Very long texts are moved as they are; other columns are not read;
    no rows give no rows.
    """
    given = rows.select("conv", F.col("turn").cast("bigint").alias("turn"), _text(F.col("role")).alias("role"),
                        _text(F.col("text")).alias("text"), F.coalesce("gone", F.lit(False)).alias("gone"))
    # The last key only tells identical rows apart, which may then be in any order.
    dealt = _marked(given).withColumn("salt", F.monotonically_increasing_id())
    order = ["conv", "turn", "role", "key", "salt"]
    dealt = dealt.repartitionByRange(partitions, *order) if partitions else dealt.repartitionByRange(*order)
    placed = (pin(dealt.sortWithinPartitions(*order).drop("salt"))
              .withColumn("pid", F.spark_partition_id()).withColumn("at", F.monotonically_increasing_id()))
    ends = placed.groupBy("pid").agg(F.min(F.struct("conv")).alias("a"), F.max(F.struct("conv")).alias("b"))
    # At most one conversation per partition boundary.
    crossing = pin(ends.select("pid", F.explode(F.array("a.conv", "b.conv")).alias("c")).distinct()
                   .groupBy("c").count().where("count > 1").select("c"))
    crosses, own = placed["conv"].eqNullSafe(crossing["c"]), ["conv", "turn", "kind", "initial", "key", "role", "text"]
    schema = ddl(rows, ("conv",)) + PIECES
    inside = map_batches(placed.join(F.broadcast(crossing), crosses, "left_anti").select(*own), _whole, schema)

    part = placed.join(F.broadcast(crossing), crosses, "left_semi")
    heads = part.where("kind >= 0").select("conv", "pid", "key").distinct()  # a key has one row a partition at most
    first = F.min("pid").over(Window.partitionBy("conv", "key"))
    seen = heads.withColumn("first", first).where("pid > first").select("conv", "pid", "key")
    none = F.lit(None)
    read = (part.select("conv", "pid", "at", "turn", "kind", "initial", "key")
            .unionByName(seen.select("conv", "pid", none.cast("bigint").alias("at"), none.cast("bigint").alias("turn"),
                                     F.lit(-2).alias("kind"), F.lit(0).alias("initial"), "key")))
    named = ddl(rows, ("conv",)) + "pid int, "
    segments = read.groupBy("conv", "pid").applyInPandas(_segment, named + SEGMENT)
    plan = pin(segments.groupBy("conv").applyInPandas(
        _fold, named + "kinds binary, entry int, exit int, closing boolean, gaps bigint, blank bigint, duplicate bigint, "
                       "truncated bigint, illegal bigint"))
    cut = (part.select("conv", "pid", "at", "turn", "kind", "role", "text").groupBy("conv", "pid")
           .cogroup(plan.groupBy("conv", "pid")).applyInArrow(_finish, schema))
    return inside.unionByName(cut)


def edits(pieces: DataFrame) -> DataFrame:
    """One row per edit: ``conv, place, number, edit, turn, role, text``; ``(place, number)`` orders a conversation."""
    return pieces.select("conv", "place", F.posexplode("edits").alias("number", "e")).select("conv", "place", "number", "e.*")


def _digest(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
    """Sums, audit and hash of each conversation; pieces come in order, one at a time is in memory."""
    conv = sums = audit = sha = None

    def made() -> dict:
        return dict(zip(COUNTS, ([s] for s in sums))) | {
            "conv": conv, "audit": ["".join(audit)], "repaired_sha256": [sha.hexdigest()]}

    for batch in batches:
        for k in range(batch.num_rows):
            row = batch.slice(k, 1)
            p = row.select(["place", *COUNTS, "edits"]).to_pylist()[0]
            if conv is None or conv[0].as_py() != row.column("conv")[0].as_py():
                if conv is not None:
                    yield made()
                conv, sums, audit, sha, begun = row.column("conv"), [0] * len(COUNTS), [], hashlib.sha256(), False
            sums = [s + p[c] for s, c in zip(sums, COUNTS)]
            audit.append("".join(e["edit"] for e in p["edits"]))
            for e in p["edits"]:
                if e["edit"] != "D":
                    sha.update(((chr(10) if begun else "") + e["role"] + ":" + e["text"]).encode("utf-8", "surrogatepass"))
                    begun = True
    if conv is not None:
        yield made()


def digests(pieces: DataFrame) -> DataFrame:
    """One row per conversation: ``conv``, the counts, ``audit`` and
    ``repaired_sha256`` of its ``role:text`` lines. A conversation of one piece
    is hashed where it is. The hash of one that has several pieces is
    sequential by nature: its pieces pass through one task, in order, one at a
    time."""
    columns = [F.col(c) for c in COUNTS]
    lines = F.transform(F.filter("edits", lambda e: e["edit"] != "D"), lambda e: F.concat(e["role"], F.lit(":"), e["text"]))
    one = pieces.where("whole").select(
        "conv", *columns, F.array_join(F.transform("edits", lambda e: e["edit"]), "").alias("audit"),
        F.sha2(F.array_join(lines, "\n"), 256).alias("repaired_sha256"))
    many = pieces.where("not whole").drop("whole").repartition("conv").sortWithinPartitions("conv", "place")
    schema = ddl(pieces, ("conv",)) + "".join(f"{c} bigint, " for c in COUNTS) + "audit string, repaired_sha256 string"
    return one.unionByName(map_batches(many, _digest, schema))
