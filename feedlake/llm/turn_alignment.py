"""Conversation structure repair by Wagner-Fischer alignment with a regular target.

A conversation's roles should read `(s?(ua)+)?`: nothing, or an opening system turn or none, then user and assistant in turn.
For each length there is one such string, and all of them end alike, so one Wagner-Fischer table over suffixes
(turns left x target symbols left) serves every length. The table is filled inside an Ukkonen band: with the cost of some
repair known (the incumbent, from one greedy walk), a cell whose left-over turns and symbols already cost more is never
reached, and neither is a length whose difference from the number of turns does. Every feasible length of least cost is
traced back to its audit (the edits' initials) by the ASCII-least edit that keeps the cost, and the least audit wins.

A table of more than `CELLS` cells (conversations of thousands of turns) is folded: the target repeats itself every two
symbols, so columns of one parity share a value, and one walk takes all lengths together. Both give the same audit (tested).

Two passes over the conversations in order, each streaming through one sorted shuffle, so a conversation of any size needs
about a hundred bytes a turn and never its texts: the first finds faults and audits, the second writes the repaired turns.
One task reads a conversation from end to end (its hash is one chain), but none holds it.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from itertools import groupby

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from feedlake.llm.rows import BoundedCache, map_arrow, quoted

#: Costs of the edits, and what an undeleted truncated turn adds.
REROLE, DELETE, INSERT, CUT = 2, 3, 2, 1
#: White space and sentence ends.
SPACE, ENDS = " \t\n\v\f\r", ".!?"
NAMES = {"u": "user", "a": "assistant"}
#: Cells of a banded table before it is folded.
CELLS = 1 << 21
NEVER = 1 << 40


# ---- one conversation -----------------------------------------------------------------------------------
# A conversation is a string of codes, one a turn: the role's initial if it is s, u or a, else o; in upper case if the
# turn is truncated; x if it must go.


def keep_cost(code: str, symbol: str) -> int:
    """Cost of a turn in the place of a target symbol, kept or with another role; NEVER if it cannot stand there."""
    if code == "x":
        return NEVER
    role = code.lower()
    if role == symbol:
        return CUT * (code != role)
    return NEVER if symbol == "s" else REROLE + CUT * (code != role)


def incumbent(codes: str) -> int:
    """The cost of one repair, found in one walk: kept where the role fits, given the wanted role where not."""
    cost, want = 0, "u"
    turns = [c for c in codes if c != "x"]
    for k, code in enumerate(turns):
        if k == 0 and code in "sS":
            cost += keep_cost(code, "s")
        else:
            cost += keep_cost(code, want)
            want = "a" if want == "u" else "u"
    cost += DELETE * (len(codes) - len(turns)) + INSERT * (want == "a")
    if len(turns) == 1 and turns[0] in "sS":
        cost += 2 * INSERT
    return min(cost, DELETE * len(codes))


def banded(codes: str) -> tuple[int, str]:
    """(cost, audit) by the banded table, every feasible length traced back."""
    n, known = len(codes), incumbent(codes)
    low, high = known // DELETE, known // INSERT  # symbols left may fall short of, or exceed, the turns left by so many
    width = low + high + 1
    # cost[i][d]: least cost of turns i.. against the last r = n - i - low + d target symbols (…uaua)
    cost = np.full((n + 1, width + 1), NEVER, dtype=np.int64)
    shifts = INSERT * np.arange(width, dtype=np.int64)
    place = np.empty(width, dtype=np.int64)
    r = np.arange(width) - low
    cost[n, :width] = np.where(r >= 0, INSERT * np.maximum(r, 0), NEVER)
    for i in range(n - 1, -1, -1):
        left = n - i - low + np.arange(width)
        code, below = codes[i], cost[i + 1]
        # delete: the same r is one place higher in the row below; keep or rerole: r - 1 is at the same place
        even = left % 2 == 0
        place[even], place[~even] = keep_cost(code, "u"), keep_cost(code, "a")
        best = np.minimum(DELETE + below[1:], np.where(left > 0, place + below[:width], NEVER))
        best[left < 0] = NEVER
        best = np.minimum.accumulate(best - shifts) + shifts  # insert: from the place before in this row
        best[left < 0] = NEVER
        cost[i, :width] = np.minimum(best, NEVER)

    def at(i: int, r: int) -> int:
        d = r - (n - i - low)
        return int(cost[i, d]) if 0 <= d < width and r >= 0 else NEVER

    def trace(i: int, r: int) -> str:
        """The ASCII-least audit of turns i.. against r symbols at least cost: D, I, K, R are tried in this order."""
        out = []
        while i < n or r:
            here, symbol = at(i, r), "u" if r % 2 == 0 else "a"
            if i < n and DELETE + at(i + 1, r) == here:
                out.append("D")
                i += 1
            elif r and INSERT + at(i, r - 1) == here:
                out.append("I")
                r -= 1
            else:
                out.append("K" if codes[i].lower() == symbol else "R")
                i, r = i + 1, r - 1
        return "".join(out)

    found: tuple[int, str] | None = None
    shortest = max(n - low, 0)
    for m in range(shortest + shortest % 2, n + high + 1, 2):  # no system turn: lengths 0, 2, 4, ...
        value = at(0, m)
        if value < NEVER and (found is None or value <= found[0]):
            candidate = (value, trace(0, m))
            found = candidate if found is None else min(found, candidate)
    for m in range(max(shortest + 1 - shortest % 2, 3), n + high + 1, 2):  # a system turn kept, all before it deleted
        opened = [DELETE * i + keep_cost(codes[i], "s") + at(i + 1, m - 1) for i in range(min(n, low + 1))]
        value = min(opened, default=NEVER)
        if value < NEVER and (found is None or value <= found[0]):
            i = max(k for k, v in enumerate(opened) if v == value)  # D before K: as late as the cost allows
            found = min(found or (NEVER, ""), (value, "D" * i + "K" + trace(i + 1, m - 1)))
    assert found is not None
    return found


def folded(codes: str) -> tuple[int, str]:
    """(cost, audit) by the table folded to what is still wanted: anything, a pair or nothing, an assistant, a pair."""
    n = len(codes)
    # states: 0 = start, 1 = an even number of symbols, 2 = an odd number (an assistant first), 3 = even and not none
    cost = np.full((n + 1, 4), NEVER, dtype=np.int64)
    even, odd = 0, INSERT
    cost[n] = (0, 0, INSERT, 2 * INSERT)
    start, some = 0, 2 * INSERT
    for i in range(n - 1, -1, -1):
        u, a, s = (keep_cost(codes[i], c) for c in "uas")
        even1, odd1, some1, start1 = even, odd, some, start
        even, odd = min(DELETE + even1, u + odd1), min(DELETE + odd1, a + even1)
        even, odd = min(even, INSERT + odd), min(odd, INSERT + even)
        some = min(DELETE + some1, u + odd1, INSERT + odd)
        start = min(DELETE + start1, s + some1, even)
        cost[i] = (start, even, odd, some)
    out, i, state = [], 0, 0
    while True:
        here = int(cost[i, state])
        if state == 0 and i == n:
            break
        if state == 1 and i == n:
            break
        moves = []
        if i < n:
            u, a, s = (keep_cost(codes[i], c) for c in "uas")
            down = cost[i + 1]
            moves.append(("D", DELETE + down[state], i + 1, state))
            role = codes[i].lower()
            if state == 0:
                moves.append(("K", s + down[3], i + 1, 3))
            if state in (0, 1, 3):
                moves.append(("K" if role == "u" else "R", u + down[2], i + 1, 2))
            else:
                moves.append(("K" if role == "a" else "R", a + down[1], i + 1, 1))
        moves.append(("I", INSERT + cost[i, 1 if state == 2 else 2], i, 1 if state == 2 else 2))
        letter, _, i, state = min((m for m in moves if m[1] == here), key=lambda m: m[0])
        out.append(letter)
    return int(cost[0, 0]), "".join(out)


def align(codes: str) -> tuple[int, str]:
    """(least cost, ASCII-least audit of that cost): D, I, K or R an edit, in order."""
    known = incumbent(codes)
    if (len(codes) + 1) * (known // DELETE + known // INSERT + 1) > CELLS:
        return folded(codes)
    return banded(codes)


# ---- a table of conversations ---------------------------------------------------------------------------


class Faults:
    """Reads the turns of one conversation in order; then its counts and its codes."""

    def __init__(self):
        self.codes = bytearray()
        self.seen: set[bytes] = set()
        self.count = {"blank": 0, "duplicate": 0, "truncated": 0}
        self.illegal, self.before, self.turns, self.low, self.high = 0, None, 0, None, None

    def add(self, turn: int | None, role: str, text: str) -> None:
        if turn is not None and turn != self.high:  # in order, so turns of one number stand together
            self.turns += 1
            self.low, self.high = turn if self.low is None else self.low, turn
        initial = role[:1]
        if self.before is not None and self.before + initial not in ("su", "ua", "au"):
            self.illegal += 1
        self.before = initial
        code = initial if initial and initial in "sua" else "o"
        body = text.strip(SPACE)
        known = hashlib.blake2b(f"{len(role)}:{role}{text}".encode("utf-8", "surrogatepass"), digest_size=16).digest()
        if not body:
            self.count["blank"] += 1
            code = "x"
        elif known in self.seen:
            self.count["duplicate"] += 1
            code = "x"
        elif body[-1] not in ENDS:
            self.count["truncated"] += 1
            code = code.upper()
        self.seen.add(known)
        self.codes += code.encode()

    def row(self, aligned: Callable[[str], tuple[int, str]]) -> tuple:
        gaps = 0 if self.low is None else self.high - self.low + 1 - self.turns
        cost, audit = aligned(self.codes.decode())
        return min(gaps, (1 << 63) - 1), *self.count.values(), self.illegal, cost, audit


_ID, _KIND, _TURN, _ROLE, _TEXT = "id", "kind", "turn", "role", "text"
COUNTS = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost"]


def _turns(rows: DataFrame, id_col: str, turn: str, role: str, text: str) -> DataFrame:
    """(id, kind, turn, role, text): kind 1 is a turn; nulls of role and text become one space."""
    picked = [F.col(quoted(id_col)).alias(_ID), F.lit(1).alias(_KIND), F.col(quoted(turn)).cast("bigint").alias(_TURN)]
    picked += [F.coalesce(F.col(quoted(c)).cast("string"), F.lit(" ")).alias(a) for c, a in ((role, _ROLE), (text, _TEXT))]
    return rows.select(*picked)


def _in_order(rows: DataFrame) -> DataFrame:
    """Each conversation's rows together and in order: kind, turn (nulls first), role, text."""
    return rows.repartition(_ID).sortWithinPartitions(_ID, _KIND, _TURN, _ROLE, _TEXT)


def _grouped(batches, columns: list[str]):
    """(id, rows) of each conversation of a sorted partition; rows stream, and a conversation may span batches."""

    def stream():
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                yield from zip(*(part.column(c).to_pylist() for c in columns))

    return groupby(stream(), key=lambda r: r[0])


def _writer(schema: StructType):
    from pyspark.sql.pandas.types import to_arrow_schema

    arrow = to_arrow_schema(schema)
    return lambda rows: pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), arrow.types)], schema=arrow)


def _batched(rows: Iterator[tuple], schema: StructType):
    """Rows as record batches of at most 512 rows or 8 million characters."""
    write, held, size = _writer(schema), [], 0
    for row in rows:
        held.append(row)
        size += sum(len(v) for v in row if type(v) is str)
        if len(held) >= 512 or size >= 8_000_000:
            yield write(held)
            held, size = [], 0
    if held:
        yield write(held)


def audits(turns: DataFrame, ids: DataFrame) -> DataFrame:
    """id, gaps, blank, duplicate, truncated, illegal, cost, audit of each conversation of `turns` and each of `ids`."""
    schema = StructType([turns.schema[_ID]] + [StructField(c, LongType()) for c in COUNTS] + [StructField("audit", StringType())])
    named = ids.select(_ID).distinct()
    for f in turns.schema.fields[1:]:
        named = named.withColumn(f.name, (F.lit(0) if f.name == _KIND else F.lit(None)).cast(f.dataType))

    def run(batches):
        aligned = BoundedCache(align, limit=50_000, longest=64)

        def rows():
            for conv, group in _grouped(batches, [_ID, _KIND, _TURN, _ROLE, _TEXT]):
                faults = Faults()
                for _, kind, turn, role, text in group:
                    if kind:
                        faults.add(turn, role, text)
                yield conv, *faults.row(aligned.__getitem__)

        yield from _batched(rows(), schema)

    return map_arrow(_in_order(turns.unionByName(named)), run, schema)


def _with_audits(turns: DataFrame, audited: DataFrame) -> DataFrame:
    """Each conversation's audit row (kind 0, the audit as its text, the counts as columns) before its turns."""
    head = audited.select(_ID, F.lit(0).alias(_KIND), F.lit(None).cast("bigint").alias(_TURN), F.lit(None).cast("string").alias(_ROLE), F.col("audit").alias(_TEXT), *COUNTS)
    return _in_order(head.unionByName(turns, allowMissingColumns=True))


def _edits(group: Iterator[tuple]) -> Iterator[tuple]:
    """(edit, turn, role, text) of the edits of one conversation; its audit row has been read."""
    audit, want = next(group)[4], "u"
    for edit in audit:
        if edit == "I":
            yield edit, None, NAMES[want], ""
        else:
            _, _, turn, role, text, *_ = next(group)
            yield edit, turn, NAMES[want] if edit == "R" else role, text
            if edit == "D" or edit == "K" and role[:1] == "s":
                continue
        want = "a" if want == "u" else "u"


def repaired_turns(
    rows: DataFrame, id_col: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text"
) -> DataFrame:
    """id_col, step (edits from 0), edit (D, I, K or R), turn, role, text: each conversation's edits in order.

    Rows with edit D are what the repair deletes, the others in order of step are the repaired conversation; an inserted turn
    has no number and an empty text. Nulls of role and text are one space, turns without a number come first, turns of
    one number by role and text. A null id is a conversation of its own; an empty table gives no rows; other columns are
    ignored. Conversations are read in order from one shuffle, so their size costs time and about a hundred bytes a turn.
    """
    turns = _turns(rows, id_col, turn, role, text)
    schema = StructType([turns.schema[_ID], StructField("step", LongType()), StructField("edit", StringType()), StructField(_TURN, LongType()), StructField(_ROLE, StringType()), StructField(_TEXT, StringType())])

    def run(batches):
        def out():
            for conv, group in _grouped(batches, [_ID, _KIND, _TURN, _ROLE, _TEXT]):
                for step, edit in enumerate(_edits(group)):
                    yield conv, step, *edit

        yield from _batched(out(), schema)

    return map_arrow(_with_audits(turns, audits(turns, turns)), run, schema).withColumnRenamed(_ID, id_col)


def repair_summary(
    rows: DataFrame,
    ids: DataFrame | None = None,
    id_col: str = "conv_id",
    turn: str = "turn",
    role: str = "role",
    text: str = "text",
) -> DataFrame:
    """id_col, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256 of every conversation.

    repaired_sha256 is of the repaired turns as `role:text`, joined by newlines. With `ids` (a frame with id_col) also its
    conversations are reported: one without rows has zeros, no audit and the hash of the empty text. Otherwise as
    `repaired_turns`.
    """
    turns = _turns(rows, id_col, turn, role, text)
    named = turns if ids is None else ids.select(F.col(quoted(id_col)).alias(_ID))
    fields = [turns.schema[_ID]] + [StructField(c, LongType()) for c in COUNTS]
    schema = StructType(fields + [StructField("audit", StringType()), StructField("repaired_sha256", StringType())])

    def run(batches):
        def out():
            for conv, group in _grouped(batches, [_ID, _KIND, _TURN, _ROLE, _TEXT, *COUNTS]):
                head = next(group)
                digest, first = hashlib.sha256(), True

                def with_head(head=head, group=group):
                    yield head
                    yield from group

                for edit, _, role, text in _edits(with_head()):
                    if edit != "D":
                        digest.update(f"{'' if first else chr(10)}{role}:{text}".encode())
                        first = False
                yield conv, *head[5:], head[4], digest.hexdigest()

        yield from _batched(out(), schema)

    return map_arrow(_with_audits(turns, audits(turns, named)), run, schema).withColumnRenamed(_ID, id_col)


def damaged(rows: DataFrame, id_col: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """The conversations with one row in four damaged, by crc32 of `id:turn` modulo 20: 0 drops a row, 1 empties its text,
    2 takes out its sentence ends, 3 repeats it, 4 makes it the user's. Nulls of role and text, and in the key, are one space."""
    key = F.concat_ws(":", *[F.coalesce(F.col(quoted(c)).cast("string"), F.lit(" ")) for c in (id_col, turn)])
    role_, text_ = (F.coalesce(F.col(quoted(c)).cast("string"), F.lit(" ")) for c in (role, text))
    kind = F.crc32(key) % 20
    said = F.when(kind == 1, F.lit("")).when(kind == 2, F.translate(text_, ENDS, "")).otherwise(text_)
    picked = rows.select(
        F.col(quoted(id_col)).alias(id_col), F.col(quoted(turn)).alias(turn),
        F.when(kind == 4, F.lit("user")).otherwise(role_).alias(role), said.alias(text),
        F.explode(F.array_repeat(F.lit(0), F.when(kind == 0, 0).when(kind == 3, 2).otherwise(1))).alias("copy"),
    )
    return picked.drop("copy")
