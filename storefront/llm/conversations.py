"""Conversation structure repair: the cheapest edits that make a conversation well formed.

Rows of a conversation may be kept, given another role, deleted, or have empty ones inserted
before them, so that the roles read: at most one system row first, then pairs of user and
assistant, or nothing at all. Of all cheapest edit lists the ASCII-least one counts.

A list is a walk over four states (nothing yet, after system, after user, after assistant).
Each state's vector entry is the least cost to reach it and the rank of its least list among
the four, so ties are decided without keeping a list: lists over the same rows never are
prefixes of each other, as each ends in the edit of the last row. Hirschberg's method meets a
forward and a backward vector in the middle, takes the crossing state that is optimal and
audit-least, and goes on with both halves, in space for two vectors.

Conversations of any length are split: rows are sorted by range, and a run of one
conversation within a partition (at most ``FRAGMENT`` rows) is a fragment of one byte a row.
A fragment is summed up by a 4 x 4 matrix of (cost, rank). The matrices of a conversation
give the vectors at all borders of fragments, which are crossed in the same way, and then
every fragment is solved by itself. Vectors change by a table of few entries, filled as met.
Texts are shuffled once, to be hashed in order; SHA-256 and one audit text per conversation
leave no choice but one task that streams over a conversation's rows and holds its audit.

Cases: NULL roles and texts are one space, so they are blank or have no known role; NULL
turns come first; rows of one turn are in the order of role and then the MD5 of the text;
a NULL conv_id is a conversation of its own; rows repeated whole are duplicates; very long
texts are hashed as a stream of rows; conversations without rows have empty results; other
columns, whatever they are called, are left out; an empty table gives no rows.
"""

from __future__ import annotations

from functools import cache, lru_cache
from hashlib import sha256

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from storefront.llm.common import SPACES, land, ship
from storefront.llm.streams import Output, rows

FRAGMENT = 65_536
DELETE, REROLE, INSERT, CUT = 2, 1, 5, 5
START, SYSTEM, USER, ASSISTANT = range(4)
STATES = range(4)
NO_WAY = 1 << 60

# Where each role's initial leads; anything else has no way.
_AFTER = {
    "s": {START: SYSTEM},
    "u": {START: USER, SYSTEM: USER, ASSISTANT: USER},
    "a": {USER: ASSISTANT},
}
_ENDS = (START, ASSISTANT)

GONE = ord("D")  # rows that must go; other rows: their initial, as a capital if truncated


def row_code(initial: str, truncated: bool) -> int:
    code = initial if initial in _AFTER else "x"
    return ord(code.upper() if truncated else code)


@cache
def _inserted(state: int) -> dict[int, str]:
    """States that insertions reach from a state, with the shortest list."""
    found, at = {state: ""}, [state]
    for s in at:
        for role in "ua":
            t = _AFTER[role].get(s)
            if t is not None and t not in found:
                found[t] = found[s] + "I"
                at.append(t)
    return found


@cache
def _step(code: int) -> tuple:
    """(from, to, cost, edits) of insertions and one row; the best for each from and to."""
    best: dict[tuple[int, int], tuple[int, str]] = {}

    def offer(s, t, cost, edits):
        best[s, t] = min(best.get((s, t), (NO_WAY, "")), (cost, edits))

    kind, cut = chr(code), CUT if chr(code).isupper() else 0
    for s in STATES:
        for m, inserts in _inserted(s).items():
            paid = INSERT * len(inserts)
            offer(s, m, paid + DELETE, inserts + "D")
            if code == GONE:
                continue
            kept = _AFTER.get(kind.lower(), {}).get(m)
            if kept is not None:
                offer(s, kept, paid + cut, inserts + "K")
            for role in "ua":
                t = _AFTER[role].get(m)
                if t is not None:
                    offer(s, t, paid + REROLE + cut, inserts + "R")
    return tuple((s, t, cost, edits) for (s, t), (cost, edits) in sorted(best.items()))


@cache
def _tails() -> dict[int, str]:
    """What has to be inserted at the end, by state."""
    ways = {s: [(len(x), x) for t, x in _inserted(s).items() if t in _ENDS] for s in STATES}
    return {s: min(x)[1] for s, x in ways.items()}


def _ranked(entries: list[tuple | None]) -> tuple[tuple, int]:
    """Entries (cost, key) as (cost above the least, dense rank of the key), and the least cost."""
    base = min(e[0] for e in entries if e)
    order = {k: i for i, k in enumerate(sorted({e[1] for e in entries if e}))}
    return tuple((e[0] - base, order[e[1]]) if e else None for e in entries), base


@lru_cache(20_000)
def _forward(vector: tuple, code: int) -> tuple[tuple, int]:
    """A forward vector after one more row, and by how much all costs rose."""
    best: list = [None] * 4
    for s, t, cost, edits in _step(code):
        if vector[s]:
            offer = (vector[s][0] + cost, (vector[s][1], edits))
            best[t] = min(best[t], offer) if best[t] else offer
    return _ranked(best)


@lru_cache(20_000)
def _backward(code: int, vector: tuple) -> tuple[tuple, int]:
    """A backward vector before one more row."""
    best: list = [None] * 4
    for s, t, cost, edits in _step(code):
        if vector[t]:
            offer = (vector[t][0] + cost, (edits, vector[t][1]))
            best[s] = min(best[s], offer) if best[s] else offer
    return _ranked(best)


@lru_cache(20_000)
def _widened(matrix: tuple, code: int) -> tuple[tuple, int]:
    """A matrix after one more row; entry 4 * s + t is the way from s to t."""
    best: list = [None] * 16
    for s in STATES:
        for m, t, cost, edits in _step(code):
            held = matrix[4 * s + m]
            if held:
                offer = (held[0] + cost, (held[1], edits))
                k = 4 * s + t
                best[k] = min(best[k], offer) if best[k] else offer
    return _ranked(best)


def _only(state: int) -> tuple:
    return tuple((0, 0) if s == state else None for s in STATES)


def crossing(forward: tuple, backward: tuple) -> int:
    """The state where the best walk crosses; ties by the least list before, then after it."""
    ways = [(f[0] + b[0], f[1], b[1], m) for m, (f, b) in enumerate(zip(forward, backward)) if f and b]
    return min(ways)[3]


def _solve(codes: bytes, start: int, end: int) -> str:
    if len(codes) == 1:
        return next(edits for s, t, _, edits in _step(codes[0]) if (s, t) == (start, end))
    mid = len(codes) // 2
    forward, backward = _only(start), _only(end)
    for code in codes[:mid]:
        forward, _ = _forward(forward, code)
    for code in reversed(codes[mid:]):
        backward, _ = _backward(code, backward)
    m = crossing(forward, backward)
    return solve(codes[:mid], start, m) + solve(codes[mid:], m, end)


_solve_short = lru_cache(50_000)(_solve)


def solve(codes: bytes, start: int, end: int) -> str:
    """The audit-least cheapest edits that lead from one state to another over some rows."""
    return (_solve_short if len(codes) <= 16 else _solve)(codes, start, end)


def matrix_of(codes: bytes) -> tuple[list[int], list[int]]:
    """Costs and ranks of the ways over some rows between all states (cost -1: no way)."""
    matrix = tuple((0, 0) if s == t else None for s in STATES for t in STATES)
    total = 0
    for code in codes:
        matrix, base = _widened(matrix, code)
        total += base
    return [total + e[0] if e else -1 for e in matrix], [e[1] if e else 0 for e in matrix]


def borders(matrices: list[tuple[list[int], list[int]]]) -> tuple[list[int], int]:
    """The states at the borders of fragments, first to last, and the cost with the tail."""

    def joined(vector, matrix, back):
        best: list = [None] * 4
        for s in STATES:
            for t in STATES:
                cost, rank = matrix[0][4 * s + t], matrix[1][4 * s + t]
                near, to = (t, s) if back else (s, t)
                if cost >= 0 and vector[near]:
                    key = (rank, vector[near][1]) if back else (vector[near][1], rank)
                    offer = (vector[near][0] + cost, key)
                    best[to] = min(best[to], offer) if best[to] else offer
        return best

    ends = [(INSERT * len(x), x) for _, x in sorted(_tails().items())]
    vector, base = _ranked(ends)
    backward, total = [vector], base
    for matrix in reversed(matrices):
        vector, base = _ranked(joined(vector, matrix, True))
        backward.append(vector)
        total += base
    backward.reverse()
    cost = total + backward[0][START][0]
    # from the left, crossing by crossing, each from the state that was chosen
    states = [START]
    for matrix, after in zip(matrices, backward[1:]):
        forward, _ = _ranked(joined(_only(states[-1]), matrix, False))
        states.append(crossing(forward, after))
    return states, cost


def repair(codes: bytes) -> tuple[str, int]:
    """The edits of a whole conversation and their cost."""
    if not codes:
        return "", 0
    (start, end), cost = borders([matrix_of(codes)])
    return solve(codes, start, end) + _tails()[end], cost


# -- Spark ---------------------------------------------------------------------------------

def damaged(conversations: DataFrame) -> DataFrame:
    """The rows after the damage that the CRC-32 of ``conv_id:turn`` does to them."""
    part = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    kind = F.crc32(F.concat(part("conv_id"), F.lit(":"), part("turn"))) % 20
    held = conversations.select(
        F.col("conv_id").cast("long"), F.col("turn").cast("long"), part("role").alias("role"), part("text").alias("text"), kind.alias("_kind")
    ).where("_kind <> 0")
    text = F.when(F.col("_kind") == 1, "").when(F.col("_kind") == 2, F.translate("text", ".!?", "")).otherwise(F.col("text"))
    role = F.when(F.col("_kind") == 4, "user").otherwise(F.col("role"))
    copies = F.explode(F.when(F.col("_kind") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0))))
    return held.select("conv_id", "turn", role.alias("role"), text.alias("text"), copies.alias("_copy")).drop("_copy")


def _ordered() -> list[Column]:
    return [F.col("conv_id").asc_nulls_first(), F.col("turn").asc_nulls_first(), F.col("role"), F.col("mark")]


_FRAGMENTS = pa.schema(
    [("conv_id", pa.int64()), ("part", pa.int32()), ("seq", pa.int64()), ("codes", pa.binary()), ("costs", pa.list_(pa.int64())),
     ("ranks", pa.list_(pa.int32())), ("blank", pa.int64()), ("duplicate", pa.int64()), ("truncated", pa.int64()), ("illegal", pa.int64()),
     ("first_role", pa.string()), ("last_role", pa.string()), ("first_turn", pa.int64()), ("last_turn", pa.int64()), ("n_turns", pa.int64())]
)
_FRAGMENTS_SQL = (
    "conv_id long, part int, seq long, codes binary, costs array<long>, ranks array<int>, blank long, duplicate long, truncated long, "
    "illegal long, first_role string, last_role string, first_turn long, last_turn long, n_turns long"
)
_LEGAL = {"su", "ua", "au"}


def _fragments(marked: DataFrame, most: int) -> DataFrame:
    """A row per run of a conversation's rows; ``marked``: rows with their faults and counts."""

    def run(batches):
        out, seq, now = Output(_FRAGMENTS), 0, None

        def fresh():
            return {"codes": bytearray(), "blank": 0, "duplicate": 0, "truncated": 0, "illegal": 0, "turns": 0,
                    "first": None, "last": None, "low": None, "high": None}

        def row():
            costs, ranks = matrix_of(bytes(held["codes"]))
            return (
                now[0], now[1], seq, bytes(held["codes"]), costs, ranks, held["blank"], held["duplicate"], held["truncated"],
                held["illegal"], held["first"], held["last"], held["low"], held["high"], held["turns"],
            ), len(held["codes"]) + 300

        held = fresh()
        names = ["conv_id", "part", "turn", "initial", "n", "blank", "cut", "earlier"]
        for conv, part, turn, initial, n, blank, cut, earlier in rows(batches, names):
            if now != (conv, part):
                if held["codes"]:
                    yield from out.add(*row())
                    seq += 1
                now, held = (conv, part), fresh()
            left, first = n, True
            while left:
                if len(held["codes"]) >= most:
                    yield from out.add(*row())
                    seq += 1
                    held = fresh()
                took = min(left, most - len(held["codes"]))
                fresh_row = first and not blank and not earlier
                gone = took - fresh_row
                if fresh_row:
                    held["codes"].append(row_code(initial, cut))
                    held["truncated"] += cut
                held["codes"] += bytes([GONE]) * gone
                held["blank" if blank else "duplicate"] += gone
                if held["last"] is not None and held["last"] + initial not in _LEGAL:
                    held["illegal"] += 1
                held["illegal"] += (took - 1) * (initial + initial not in _LEGAL)
                held["first"] = initial if held["first"] is None else held["first"]
                held["last"] = initial
                if turn is not None:
                    held["turns"] += turn != held["high"]
                    held["low"] = turn if held["low"] is None else held["low"]
                    held["high"] = turn
                left, first = left - took, False
        if held["codes"]:
            yield from out.add(*row())
        yield from out.rest()

    return marked.mapInArrow(run, _FRAGMENTS_SQL)


_CROSSED = pa.schema(
    [("part", pa.int32()), ("seq", pa.int64()), ("start", pa.int32()), ("finish", pa.int32()), ("tail", pa.string()), ("gaps", pa.int64()),
     ("blank", pa.int64()), ("duplicate", pa.int64()), ("truncated", pa.int64()), ("illegal", pa.int64()), ("cost", pa.int64())]
)
_CROSSED_SQL = (
    "part int, seq long, start int, finish int, tail string, gaps long, blank long, duplicate long, truncated long, illegal long, cost long"
)


def _crossed(fragments: DataFrame) -> DataFrame:
    """Where the best walk crosses the borders of fragments; figures stand with the first one."""

    def run(batches):
        out, held, now = Output(_CROSSED), [], ()

        def conversation():
            states, cost = borders([(x[2], x[3]) for x in held])
            lows, highs = [x[10] for x in held if x[10] is not None], [x[11] for x in held if x[11] is not None]
            turns = sum(x[12] for x in held) - sum(a[11] is not None and a[11] == b[10] for a, b in zip(held, held[1:]))
            illegal = sum(x[7] for x in held) + sum(a[9] + b[8] not in _LEGAL for a, b in zip(held, held[1:]))
            gaps = max(highs) - min(lows) + 1 - turns if lows else 0
            figures = (gaps, *(sum(x[k] for x in held) for k in (4, 5, 6)), illegal, cost)
            for i, x in enumerate(held):
                tail = _tails()[states[-1]] if i == len(held) - 1 else ""
                yield from out.add((x[0], x[1], states[i], states[i + 1], tail, *(figures if i == 0 else (None,) * 6)))

        names = [f.name for f in _FRAGMENTS if f.name not in ("conv_id", "codes")]
        for conv, *rest in rows(batches, ["conv_id", *names]):
            if now != (conv,):
                if held:
                    yield from conversation()
                now, held = (conv,), []
            held.append(rest)
        if held:
            yield from conversation()
        yield from out.rest()

    small = fragments.drop("codes").repartition("conv_id").sortWithinPartitions("conv_id", "part", "seq")
    return small.mapInArrow(run, _CROSSED_SQL)


def _audits(fragments: DataFrame) -> DataFrame:
    """``edits`` of each fragment in place of its codes."""

    def run(batches):
        for batch in batches:
            names = ["codes", "start", "finish", "tail"]
            found = [solve(codes, start, end) + tail for codes, start, end, tail in rows([batch], names)]
            rest = [n for n in batch.schema.names if n not in names]
            yield pa.RecordBatch.from_arrays([*[batch.column(n) for n in rest], pa.array(found, pa.string())], [*rest, "edits"])

    rest = [f"{n} {t}" for n, t in fragments.dtypes if n not in ("codes", "start", "finish", "tail")]
    return fragments.mapInArrow(run, ", ".join([*rest, "edits string"]))


_REPAIRED = pa.schema(
    [("conv_id", pa.int64()), *[(n, pa.int64()) for n in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")],
     ("audit", pa.string()), ("repaired_sha256", pa.string())]
)
_REPAIRED_SQL = (
    "conv_id long, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, repaired_sha256 string"
)


def _told(stream: DataFrame) -> DataFrame:
    """A row per conversation; the stream has its edits, then its rows, in order."""
    figures = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost"]

    def run(batches):
        out, now, told = Output(_REPAIRED), (), None

        class Told:
            """Applies the edits to the rows as they come."""

            def __init__(self):
                self.figures, self.pieces, self.audit = (0,) * 6, [], None
                self.at = self.kept = 0
                self.hash = sha256()

            def line(self, role: str, text: str) -> None:
                self.hash.update((("\n" if self.kept else "") + f"{role}:{text}").encode())
                self.kept += 1

            def begin(self):
                self.audit = "".join(self.pieces)
                n = len(self.audit) - self.audit.count("D")
                self.odd = n % 2

            def role(self) -> str:
                return "assistant" if (self.kept - self.odd) % 2 else "user"

            def inserts(self) -> None:
                while self.at < len(self.audit) and self.audit[self.at] == "I":
                    self.line(self.role(), "")
                    self.at += 1

            def row(self, role: str, text: str) -> None:
                if self.audit is None:
                    self.begin()
                self.inserts()
                edit = self.audit[self.at]
                self.at += 1
                if edit == "K":
                    self.line(role, text)
                elif edit == "R":
                    self.line(self.role(), text)

            def result(self):
                if self.audit is None:
                    self.begin()
                self.inserts()
                return (now[0], *self.figures, self.audit, self.hash.hexdigest()), len(self.audit) + 100

        for conv, kind, edits, role, text, *found in rows(batches, ["conv_id", "kind", "edits", "role", "text", *figures]):
            if now != (conv,):
                if told:
                    yield from out.add(*told.result())
                now, told = (conv,), Told()
            if kind == 1:
                told.pieces.append(edits)
                if found[0] is not None:
                    told.figures = tuple(found)
            elif kind == 2:
                told.row(role, text)
        if told:
            yield from out.add(*told.result())
        yield from out.rest()

    return stream.mapInArrow(run, _REPAIRED_SQL)


def repair_conversations(conversations: DataFrame, rows_after: DataFrame | None = None, fragment: int = FRAGMENT) -> DataFrame:
    """One row per conv_id of ``conversations``: faults, the cost and audit of the cheapest edits,
    and SHA-256 of the repaired rows.

    ``rows_after`` (conv_id, turn, role, text, no NULL text or role) are the rows to repair, by
    default those of ``conversations`` after the damage.
    """
    ship(conversations.sparkSession)
    found = damaged(conversations) if rows_after is None else rows_after
    found = found.withColumn("mark", F.unhex(F.md5("text")))
    said = F.rtrim("text", F.lit(SPACES))
    light = found.groupBy("conv_id", "turn", "role", "mark").agg(
        F.count("*").alias("n"), F.any_value(said == "").alias("blank"), F.any_value(~said.rlike(r"[.!?]\z")).alias("cut")
    )
    light = land(light, "conversation-rows")
    # rows that stand at several turns: all but those of the first turn are duplicates
    again = light.groupBy("conv_id", "role", "mark").agg(
        F.count("*").alias("_c"), F.min_by(F.struct("turn"), F.struct(F.col("turn").isNotNull(), "turn")).alias("_first")
    ).where("_c > 1").withColumnsRenamed({"conv_id": "_conv", "role": "_role", "mark": "_mark"})
    met = light.conv_id.eqNullSafe(again._conv) & (light.role == again._role) & (light.mark == again._mark)
    earlier = F.col("_first").isNotNull() & ~F.col("turn").eqNullSafe(F.col("_first.turn"))
    marked = light.join(again, met, "left").select(
        "conv_id", "turn", "role", "mark", F.substring("role", 1, 1).alias("initial"), "n", "blank", "cut", earlier.alias("earlier")
    )
    sorted_ = marked.repartitionByRange(*_ordered()).sortWithinPartitions(*_ordered()).withColumn("part", F.spark_partition_id())
    fragments = land(_fragments(sorted_.drop("role", "mark"), fragment), "conversation-fragments")
    solved = _audits(fragments.select("conv_id", "part", "seq", "codes").join(_crossed(fragments), ["part", "seq"]))

    figures = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost"]
    ids = conversations.select(F.col("conv_id").cast("long")).distinct()
    parts = [
        ids.select("conv_id", F.lit(0).alias("kind")),
        solved.withColumn("kind", F.lit(1)),
        found.withColumn("kind", F.lit(2)),
    ]
    stream = parts[0].unionByName(parts[1], allowMissingColumns=True).unionByName(parts[2], allowMissingColumns=True)
    order = ["conv_id", "kind", "part", "seq", "turn", "role", "mark"]
    stream = stream.repartition("conv_id").sortWithinPartitions(*order)
    return _told(stream.select("conv_id", "kind", "edits", "role", "text", *figures))
