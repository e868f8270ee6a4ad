"""Conversation structure repair by Viterbi over chunks, in parallel, with rank convergence.

The cheapest edits that give a conversation's role initials the form ``(s?(ua)+)?`` are a shortest path through four
states (nothing yet, after s, after u, after a). Its costs are worked out backwards: for every place the cost to the
end from each state. A conversation is cut into chunks of at most ``CHUNK`` rows; all chunks run at once, each from
four speculative cost vectors at its end (0 for one state and ``BOUND`` for the others; true vectors never spread
wider, so every one is a minimum of these). Where the four results differ only by constants, the chunk's result no
longer depends on what follows it. Fix-up passes run on for the other chunks, over what follows them and twice as far
each time, until all agree up to a constant or reach the end. Then each chunk knows its true costs and traces, from
every state it may be entered in, the least audit (D before I before K before R) among the cheapest; the end states
are stitched forward the same way, and the traces of the true states put together.

Rows are sorted by (conversation, turn, ...) in ranges, so a conversation of any length lies over as many tasks as it
needs. Whole conversations in one chunk, nearly all, are finished where they are. Only the SHA-256 of the repaired
conversation is a chain: for conversations of several chunks the ready pieces pass through one task as a sorted
stream, one piece in memory at a time, and the audit itself is one row's text.

Damage (``damaged``): by ``crc32(conv_id:turn) % 20``, nulls read as one blank: 0 drops a row, 1 empties its text, 2
takes out ``.!?``, 3 repeats it, 4 makes it the user's. Null roles and texts are one blank; such a role cannot be kept.
Rows of one turn come in order of role, then of the SHA-256 of both; null turns first. Repeated rows are duplicates.
Conversations without rows left have zeros, an empty audit and the hash of nothing. A null ``conv_id`` is a
conversation of its own. An empty table gives no rows. Other columns never matter.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from typing import NamedTuple

import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from citelake.llm.common import column_batches
from citelake.session import stage

CHUNK = 256
CHUNK_BYTES = 4 << 20
BOUND = 16
DELETE, INSERT, REROLE, CUT = 2, 5, 1, 5

#: States: nothing yet, after s, after u, after a. Where each goes by an initial, by an insert or rerole; None: nowhere.
_BY_INITIAL = {"s": (1, None, None, None), "u": (2, 2, None, 2), "a": (None, None, 3, None)}
_NEXT = (2, 2, 3, 2)
_ROLES = {2: b"user", 3: b"assistant"}
#: Costs to the end where no rows follow: an answer is still due after u, a question and an answer after s.
END = (0, 10, 5, 0)

_INITIALS = "sua?"
_SOUND, _CUT, _DUPLICATE, _BLANK = range(4)
_LEGAL = {("s", "u"), ("u", "a"), ("a", "u")}


# ------------------------------------------------------------------ the machine

def _options(state: int, symbol: int) -> list[tuple[str, int, int]]:
    """(edit, cost, next state) for one row, least letter first."""
    initial, fault = _INITIALS[symbol >> 2], symbol & 3
    found = [("D", DELETE, state)]
    if fault < _DUPLICATE:
        more = CUT if fault == _CUT else 0
        to = _BY_INITIAL.get(initial, (None,) * 4)[state]
        if to is not None:
            found.append(("K", more, to))
        found.append(("R", more + REROLE, _NEXT[state]))
    return found


def _with_inserts(costs: list[int]) -> tuple[int, ...]:
    after_u, after_a = min(costs[2], INSERT + costs[3]), min(costs[3], INSERT + costs[2])
    return min(costs[0], INSERT + after_u), min(costs[1], INSERT + after_u), after_u, after_a


#: Steps worked out before: costs less their least take few values. A plain dict, as it travels with the functions.
_STEPS: dict[tuple[tuple[int, ...], int], tuple[int, ...]] = {}


def _back(costs: tuple[int, ...], symbol: int) -> tuple[int, ...]:
    """Costs before a row from the costs after it."""
    found = _STEPS.get((costs, symbol))
    if found is None:
        if len(_STEPS) >= 1 << 16:
            _STEPS.clear()
        found = _with_inserts([min(c + costs[to] for _, c, to in _options(s, symbol)) for s in range(4)])
        _STEPS[costs, symbol] = found
    return found


def normal(costs: tuple[int, ...]) -> tuple[int, ...]:
    least = min(costs)
    return tuple(c - least for c in costs)


def backward(symbols: bytes, end: tuple[int, ...]) -> list[tuple[int, ...]]:
    """Costs at every place of a chunk, the last for ``end``; each less its least, which no choice depends on."""
    found = [normal(end)]
    for symbol in reversed(symbols):
        found.append(normal(_back(found[-1], symbol)))
    return found[::-1]


def speculate(symbols: bytes) -> list[list[int]]:
    """The costs at a chunk's beginning for each speculative vector at its end."""
    found = []
    for state in range(4):
        costs = tuple(0 if s == state else BOUND for s in range(4))
        spent = 0
        for symbol in reversed(symbols):
            costs = _back(costs, symbol)
            least = min(costs)
            costs, spent = tuple(c - least for c in costs), spent + least
        found.append([c + spent for c in costs])
    return found


class Trace(NamedTuple):
    edits: bytes
    states: list[int]  # after each edit
    cost: int


def trace(symbols: bytes, costs: list[tuple[int, ...]], state: int, final: bool) -> Trace:
    """The least edits among the cheapest from ``state``; the last chunk ends with the inserts still due."""
    edits, states, spent, place = bytearray(), [], 0, 0

    def take(edit: str, cost: int, to: int) -> None:
        nonlocal spent
        edits.append(ord(edit))
        states.append(to)
        spent += cost

    while place < len(symbols):
        ahead = _back(costs[place + 1], symbols[place])
        choice = next(((e, c, to) for e, c, to in _options(state, symbols[place]) if c + costs[place + 1][to] == ahead[state]), None)
        insert = ahead[state] == INSERT + ahead[_NEXT[state]]
        if insert and (choice is None or choice[0] > "I"):
            choice = ("I", INSERT, _NEXT[state])
        else:
            place += 1
        take(*choice)
        state = choice[2]
    while final and END[state]:
        state = _NEXT[state]
        take("I", INSERT, state)
    return Trace(bytes(edits), states, spent)


def repaired(roles: list[bytes], texts: list[bytes], found: Trace) -> list[bytes]:
    """``role:text`` of the rows that the edits leave or make."""
    lines, place = [], 0
    for edit, state in zip(found.edits, found.states):
        if edit == ord("I"):
            lines.append(_ROLES[state] + b":")
            continue
        if edit != ord("D"):
            role = roles[place] if edit == ord("K") else _ROLES[state]
            lines.append(role + b":" + texts[place])
        place += 1
    return lines


# ----------------------------------------------------------------------- damage

def damaged(conversations: DataFrame) -> DataFrame:
    """``conv_id, turn, role, text, gone``: rows after damage, copies one by one; a dropped row stays as a ``gone`` one."""
    key = F.concat_ws(":", *[F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("conv_id", "turn")])
    text, role = (F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("text", "role"))
    kind = F.col("_kind")
    return conversations.select(
        "conv_id", F.col("turn").cast("long").alias("turn"), role.alias("_role"), text.alias("_text"),
        (F.crc32(key.cast("binary")) % 20).alias("_kind"),
    ).select(
        "conv_id",
        F.when(kind != 0, F.col("turn")).alias("turn"),
        F.when(kind == 4, "user").when(kind == 0, "").otherwise(F.col("_role")).alias("role"),
        F.when(kind.isin(0, 1), "").when(kind == 2, F.regexp_replace("_text", "[.!?]", "")).otherwise(F.col("_text")).alias("text"),
        (kind == 0).alias("gone"),
        F.explode(F.array_repeat(F.lit(0), F.when(kind == 3, 2).otherwise(1))).alias("_copy"),
    ).drop("_copy")


def ordered(rows: DataFrame) -> DataFrame:
    """Rows in ranges of (conversation, turn, role, digest), sorted; equal rows may lie in several ranges."""
    same = F.concat(F.length("role").cast("string"), F.lit(":"), "role", "text")
    order = ["conv_id", "turn", "role", "digest", "at"]
    return (
        rows.select(
            "conv_id", "turn", F.col("role").cast("binary").alias("role"), F.col("text").cast("binary").alias("text"), "gone",
            F.unhex(F.sha2(same.cast("binary"), 256)).alias("digest"),
            F.monotonically_increasing_id().alias("at"),
        )
        .repartitionByRange(*order)
        .sortWithinPartitions(*order)
        .drop("at")
    )


# ----------------------------------------------------------------------- chunks

_TAKEN = "digests array<binary>, symbols binary, roles array<binary>, texts array<binary>, low long, high long, turns long"
_CHUNK_TYPES = f"part int, sub int, last boolean, edge boolean, {_TAKEN}"


def _symbol(role: bytes, text: bytes, seen: set[bytes], digest: bytes) -> int:
    initial = _INITIALS.find(role[:1].decode("latin-1") or "?")
    end = text.rstrip()[-1:]
    fault = _BLANK if not end else _DUPLICATE if digest in seen else _SOUND if end in b".!?" else _CUT
    return (initial if initial >= 0 else _INITIALS.index("?")) << 2 | fault


class _Open:
    """The chunk being filled, and what its conversation has shown in this range."""

    def __init__(self, conv, first: bool, most: int):
        self.conv, self.first, self.most, self.sub, self.seen = conv, first, most, 0, set()
        self.clear()

    def clear(self) -> None:
        self.symbols, self.roles, self.texts, self.digests, self.bytes = bytearray(), [], [], [], 0
        self.low = self.high = None
        self.turns = 0

    def add(self, turn, role: bytes, text: bytes, digest: bytes) -> None:
        symbol = _symbol(role, text, self.seen, digest)
        self.symbols.append(symbol)
        self.digests.append(None if symbol & 3 >= _DUPLICATE else digest)
        self.seen.add(digest)
        self.roles.append(role)
        self.texts.append(text)
        self.bytes += len(role) + len(text)
        if turn is not None:
            self.low = turn if self.low is None else self.low
            self.turns += turn != self.high
            self.high = turn

    def full(self) -> bool:
        return len(self.symbols) >= self.most or self.bytes >= CHUNK_BYTES

    def row(self, part: int, last: bool, edge: bool) -> dict:
        # Digests serve conversations that go on in another range; only first and last ones may.
        wanted = self.digests if self.first or edge or self.sub or not last else []
        found = {
            "conv_id": self.conv, "part": part, "sub": self.sub, "last": last, "edge": self.first or edge, "digests": wanted,
            "symbols": bytes(self.symbols), "roles": self.roles, "texts": self.texts,
            "low": self.low, "high": self.high, "turns": self.turns,
        }
        self.sub += 1
        self.clear()
        return found


def chunks(rows: DataFrame, most: int = CHUNK) -> DataFrame:
    """Consecutive rows of a conversation in one range, cut at ``most`` rows; ``edge``: it may go on in another range."""
    source = rows.select("conv_id", "turn", "role", "text", "gone", "digest")
    id_field = source.schema["conv_id"]
    blobs = pa.list_(pa.binary())

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, run, schema, ready, held = TaskContext.get().partitionId(), None, None, [], 0

        def out() -> pa.RecordBatch:
            return pa.RecordBatch.from_pylist(ready, schema)

        for batch in column_batches(batches, 1024):
            schema = schema or pa.schema([
                pa.field("conv_id", batch.schema.field(0).type), ("part", pa.int32()), ("sub", pa.int32()), ("last", pa.bool_()),
                ("edge", pa.bool_()), ("digests", blobs), ("symbols", pa.binary()), ("roles", blobs), ("texts", blobs),
                ("low", pa.int64()), ("high", pa.int64()), ("turns", pa.int64()),
            ])
            for conv, turn, role, text, gone, digest in zip(*(c.to_pylist() for c in batch.columns)):
                if run is None or run.conv != conv:
                    if run is not None:
                        ready.append(run.row(part, True, False))
                    run = _Open(conv, run is None, most)
                elif run.full() and not gone:
                    ready.append(run.row(part, False, False))
                if not gone:
                    run.add(turn, role, text, digest)
                    held += len(text)
                if len(ready) >= 1024 or held >= CHUNK_BYTES and ready:
                    yield out()
                    ready, held = [], 0
        if run is not None:
            ready.append(run.row(part, True, True))
            yield out()

    return source.mapInArrow(cut, f"conv_id {id_field.dataType.simpleString()}, {_CHUNK_TYPES}")


# ----------------------------------------------------------------------- pieces

_PIECE_TYPES = (
    "part int, sub int, low long, high long, turns long, blank long, duplicate long, truncated long, illegal long, "
    "head string, tail string, cost long, audit binary, lines binary"
)
_RESULT_TYPES = (
    "gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, repaired_sha256 string"
)


def _piece(row: dict, end: tuple[int, ...], state: int, final: bool) -> dict:
    """What a chunk adds to its conversation, entered in ``state`` with costs ``end`` behind it."""
    symbols = row["symbols"]
    found = trace(symbols, backward(symbols, end), state, final)
    faults = [s & 3 for s in symbols]
    initials = [_INITIALS[s >> 2] for s in symbols]
    return {
        **{k: row[k] for k in ("conv_id", "part", "sub", "low", "high", "turns")},
        "blank": faults.count(_BLANK), "duplicate": faults.count(_DUPLICATE), "truncated": faults.count(_CUT),
        "illegal": sum(p not in _LEGAL for p in zip(initials, initials[1:])),
        "head": initials[0] if initials else None, "tail": initials[-1] if initials else None,
        "cost": found.cost, "audit": found.edits, "lines": b"\n".join(repaired(row["roles"], row["texts"], found)),
    }


class _Whole:
    """Pieces of one conversation put together in order."""

    def __init__(self, conv):
        self.conv, self.hash, self.audit, self.empty = conv, hashlib.sha256(), [], True
        self.low = self.high = self.tail = None
        self.sums = dict.fromkeys(("turns", "blank", "duplicate", "truncated", "illegal", "cost"), 0)

    def add(self, piece: dict) -> None:
        for name in self.sums:
            self.sums[name] += piece[name]
        if piece["head"] is not None:
            self.sums["illegal"] += self.tail is not None and (self.tail, piece["head"]) not in _LEGAL
            self.tail = piece["tail"]
        if piece["low"] is not None:
            self.sums["turns"] -= piece["low"] == self.high
            self.low = piece["low"] if self.low is None else self.low
            self.high = piece["high"]
        self.audit.append(piece["audit"])
        if piece["lines"]:
            self.hash.update(piece["lines"] if self.empty else b"\n" + piece["lines"])
            self.empty = False

    def row(self) -> dict:
        sums = dict(self.sums)
        turns = sums.pop("turns")
        return {
            "conv_id": self.conv, "gaps": 0 if self.low is None else self.high - self.low + 1 - turns, **sums,
            "audit": b"".join(self.audit).decode(), "repaired_sha256": self.hash.hexdigest(),
        }


def _schema(types: str, conv: pa.DataType) -> pa.Schema:
    kinds = {"int": pa.int32(), "long": pa.int64(), "string": pa.string(), "binary": pa.binary()}
    return pa.schema([("conv_id", conv), *[(n, kinds[t]) for n, t in (c.split() for c in types.split(", "))]])


def _each(rows: DataFrame, work, types: str) -> DataFrame:
    """``work(rows) -> rows`` over the rows of a partition, batches of a few rows at a time."""
    id_type = rows.schema["conv_id"].dataType.simpleString()

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind: list[pa.DataType] = []

        def given() -> Iterator[dict]:
            for batch in batches:
                kind[:] = [batch.schema.field("conv_id").type]
                for at in range(0, batch.num_rows, 64):
                    yield from batch.slice(at, 64).to_pylist()

        held, size = [], 0
        for row in work(given()):
            held.append(row)
            size += len(row.get("lines") or b"") + len(row.get("audit") or b"") + 64
            if size > CHUNK_BYTES:
                yield pa.RecordBatch.from_pylist(held, _schema(types, kind[0]))
                held, size = [], 0
        if held:
            yield pa.RecordBatch.from_pylist(held, _schema(types, kind[0]))

    return rows.mapInArrow(apply, f"conv_id {id_type}, {types}")


def _alone(rows: Iterator[dict]) -> Iterator[dict]:
    for row in rows:
        whole = _Whole(row["conv_id"])
        whole.add(_piece(row, END, 0, True))
        yield whole.row()


def _joined(rows: Iterator[dict]) -> Iterator[dict]:
    whole, key = None, None
    for row in rows:
        if whole is None or row["conv_id"] != whole.conv:
            if whole is not None:
                yield whole.row()
            whole = _Whole(row["conv_id"])
        whole.add(row)
    if whole is not None:
        yield whole.row()


# ------------------------------------------------------- conversations of many chunks

def _place(prefix: str = "") -> list[Column]:
    return [F.col(f"{prefix}{c}") for c in ("key", "part", "sub")]


def with_neighbours(long: DataFrame) -> DataFrame:
    """Add ``key`` and the places ``(to_part, to_sub)`` and ``(from_part, from_sub)`` of the chunks after and before; null at the ends.

    Inside a range they follow from the numbering. Over ranges, one row a conversation and range is looked at.
    """
    keyed = long.withColumn("key", F.when(F.col("conv_id").isNull(), "-").otherwise(F.concat(F.lit("+"), F.col("conv_id").cast("string"))))
    order = Window.partitionBy("key").orderBy("part")
    ranges = keyed.where("last").select(
        "key", "part", F.lead("part").over(order).alias("_next"), F.lag("part").over(order).alias("_prev"),
        F.lag("sub").over(order).alias("_prev_sub"),
    )
    inside = F.col("sub") > 0
    return keyed.join(ranges, ["key", "part"]).select(
        *keyed.columns,
        F.when(~F.col("last"), F.col("part")).otherwise(F.col("_next")).alias("to_part"),
        F.when(~F.col("last"), F.col("sub") + 1).when(F.col("_next").isNotNull(), 0).alias("to_sub"),
        F.when(inside, F.col("part")).otherwise(F.col("_prev")).alias("from_part"),
        F.when(inside, F.col("sub") - 1).otherwise(F.col("_prev_sub")).alias("from_sub"),
    )


def with_duplicates(long: DataFrame) -> DataFrame:
    """Mark rows seen in an earlier range: symbols of later ones become duplicates."""
    seen = long.select(*_place(), F.posexplode("digests").alias("row", "digest")).where("digest IS NOT NULL")
    first = seen.groupBy("key", "digest").agg(F.min("part").alias("first"))
    later = (
        seen.join(first.where("first IS NOT NULL"), ["key", "digest"]).where("part > first")
        .groupBy("key", "part", "sub").agg(F.collect_set("row").alias("again"))  # CHUNK at most
    )
    return long.drop("digests").join(later, ["key", "part", "sub"], "left")


@F.pandas_udf(T.BinaryType())
def _marked(symbols: pd.Series, again: pd.Series) -> pd.Series:
    def mark(held: bytes, rows) -> bytes:
        found = bytearray(held)
        for row in () if rows is None else rows:
            found[row] = found[row] & ~3 | _DUPLICATE
        return bytes(found)

    return pd.Series([mark(*pair) for pair in zip(symbols, again)], dtype=object)


@F.pandas_udf(T.ArrayType(T.ArrayType(T.LongType())))
def _starts(symbols: pd.Series, more: pd.Series) -> pd.Series:
    """Costs at the beginning from each speculative vector; the last chunk of a conversation knows its end."""
    return pd.Series([
        speculate(bytes(held)) if goes_on else [list(backward(bytes(held), END)[0])] * 4 for held, goes_on in zip(symbols, more)
    ], dtype=object)


@F.pandas_udf(T.ArrayType(T.IntegerType()))
def _ends(symbols: pd.Series, ends: pd.Series) -> pd.Series:
    """The state a chunk is left in, for each it may be entered in."""

    def left_in(held: bytes, end) -> list[int]:
        costs = backward(held, END if end is None else tuple(int(c) for c in end))
        return [([s] + trace(held, costs, s, end is None).states)[-1] for s in range(4)]

    return pd.Series([left_in(bytes(held), end) for held, end in zip(symbols, ends)], dtype=object)


def _agree(starts: Column) -> Column:
    """The four vectors differ only by constants."""
    found = F.lit(True)
    for t in range(1, 4):
        for s in range(1, 4):
            found = found & (starts[t][s] - starts[t][0] == starts[0][s] - starts[0][0])
    return found


def _through(starts: Column, following: Column) -> Column:
    """Speculative results of a chunk and of the one after it as those of both."""
    return F.array(*[
        F.array(*[F.least(*[following[t][j] + starts[j][s] for j in range(4)]) for s in range(4)]) for t in range(4)
    ])


def _settle(state: DataFrame, settled: Column, value: str, to: tuple[str, str], merge, name: str) -> DataFrame:
    """Fix-up passes: every chunk not settled takes in what its neighbour has, and goes on from there.

    The reach doubles with each pass, so there are at most as many as the chunks of a conversation have binary digits.
    """
    state = stage(state, name)
    while not state.where(~settled).isEmpty():
        other = state.select(
            F.col("key").alias("_key"), F.col("part").alias("_part"), F.col("sub").alias("_sub"),
            F.col(to[0]).alias("_to_part"), F.col(to[1]).alias("_to_sub"), F.col(value).alias("_value"),
        )
        found = state.where(~settled).join(
            other, (F.col("key") == F.col("_key")) & (F.col(to[0]) == F.col("_part")) & (F.col(to[1]) == F.col("_sub"))
        ).select(
            "key", "part", "sub", F.col("_to_part").alias(to[0]), F.col("_to_sub").alias(to[1]),
            merge(F.col(value), F.col("_value")).alias(value),
        )
        state = stage(state.where(settled).unionByName(found), name)
    return state


def _long(long: DataFrame) -> DataFrame:
    """Results of conversations that lie over several chunks."""
    placed = stage(with_neighbours(long), "repair-long")
    marked = with_duplicates(placed).withColumn("symbols", _marked("symbols", "again")).drop("again")
    marked = stage(marked, "repair-marked")

    starts = _settle(
        marked.select(*_place(), "to_part", "to_sub", _starts("symbols", F.col("to_part").isNotNull()).alias("starts")),
        _agree(F.col("starts")), "starts", ("to_part", "to_sub"), _through, "repair-starts",
    )
    least = F.array_min(F.col("starts")[0])
    behind = starts.select(
        "key", F.col("part").alias("to_part"), F.col("sub").alias("to_sub"),
        F.transform(F.col("starts")[0], lambda c: c - least).alias("end"),
    )
    known = marked.join(behind, ["key", "to_part", "to_sub"], "left")

    ends = F.col("ends")
    left_in = known.select(*_place(), "from_part", "from_sub", _ends("symbols", "end").alias("ends")).withColumn(
        "ends", F.when(F.col("from_part").isNull(), F.array_repeat(ends[0], 4)).otherwise(ends)
    )
    left_in = _settle(
        left_in, (ends[0] == ends[1]) & (ends[0] == ends[2]) & (ends[0] == ends[3]), "ends", ("from_part", "from_sub"),
        lambda own, before: F.transform(before, lambda s: F.get(own, s)), "repair-ends",
    )
    before = left_in.select("key", F.col("part").alias("from_part"), F.col("sub").alias("from_sub"), ends[0].alias("state"))
    whole = known.join(before, ["key", "from_part", "from_sub"], "left")

    def pieces(rows: Iterator[dict]) -> Iterator[dict]:
        for row in rows:
            end = row["end"]
            yield _piece(row, tuple(end) if end else END, row["state"] or 0, end is None)

    ready = _each(whole, pieces, _PIECE_TYPES)
    return _each(ready.repartition("conv_id").sortWithinPartitions("conv_id", "part", "sub"), _joined, _RESULT_TYPES)


def repair(rows: DataFrame, most: int = CHUNK) -> DataFrame:
    """``conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256`` of every conversation.

    ``rows`` has ``conv_id, turn, role, text`` and ``gone`` (a row that is no longer there, so that its conversation is known).
    """
    cut = stage(chunks(ordered(rows), most), "repair-chunks")
    # At most one conversation goes over each border of two ranges.
    over = cut.where("last AND edge").groupBy("conv_id").agg(F.count("*").alias("n")).where("n > 1")
    over = F.broadcast(over.select(F.col("conv_id").alias("_over"), F.lit(True).alias("_is_over")))
    flagged = cut.join(over, F.col("conv_id").eqNullSafe(F.col("_over")), "left").withColumn(
        "_alone", F.col("last") & (F.col("sub") == 0) & F.col("_is_over").isNull()
    )
    columns = cut.columns
    needed = ["conv_id", "part", "sub", "symbols", "roles", "texts", "low", "high", "turns"]
    alone = _each(flagged.where("_alone").select(*needed), _alone, _RESULT_TYPES)
    long = flagged.where("NOT _alone").select(*columns)
    if long.isEmpty():
        return alone
    return alone.unionByName(_long(long))


def repair_conversations(conversations: DataFrame, most: int = CHUNK) -> DataFrame:
    """Damage the rows, then repair what is left."""
    return repair(damaged(conversations), most)
