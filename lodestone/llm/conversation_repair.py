"""Conversation structure repair: Wagner-Fischer alignment of turns to the alternating grammar, of every feasible length."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache, reduce
from itertools import groupby

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lodestone.llm.scratch import Scratch, ship

# Legal conversations: initials of their roles match (s?(ua)+)?. What one edit costs; a cut turn that stays costs TRUNCATED more.
REROLE, DELETE, INSERT, TRUNCATED = 3, 4, 3, 3
ROLES = {"u": "user", "a": "assistant"}
# States: nothing yet, or the initial of the last turn so far. From each, the letter that comes next.
START, SYSTEM, USER, ASSISTANT = range(4)
FOLLOWS = "uuau"
# Empty turns that end a conversation from each state.
CLOSING = ("", "ua", "a", "")
LEGAL = ("su", "ua", "au")
BLOCK = 512  # turns aligned together
NEVER = 1 << 40
BLANK, DUPLICATE, CUT = "blank", "duplicate", "truncated"


def _other(letter: str) -> str:
    return "a" if letter == "u" else "u"


class Alignment:
    """Costs of aligning turns to the alternating string of each length that ends in `last`, inserting nothing after the last turn.

    A turn is a pair: its role's initial where it may be kept (' ' for others), and '.' sound, '-' cut, or 'x' to be deleted.
    `cost[i]` holds, for each number m of letters, the least cost of making the string's last m letters from the turns i and later.
    All lengths share one table, as their strings are ends of one another. Cells that no path as cheap as the incumbent
    reaches are left out (Ukkonen): it would need more deletions or insertions than the incumbent's cost pays for.
    """

    def __init__(self, turns: list[tuple[str, str]], last: str, incumbent: int) -> None:
        self.turns, self.last, count = turns, last, len(turns)
        letters = count + incumbent // INSERT + 2
        is_last = np.arange(1, letters + 1) % 2 == 1  # whether the m-th letter from the end is `last`
        steps = np.arange(letters + 1) * INSERT
        row = np.full(letters + 1, NEVER)
        row[0] = 0
        self.cost = [row]
        for i in range(count - 1, -1, -1):
            below, left = self.cost[-1], count - i
            low, high = max(0, left - incumbent // DELETE), min(letters, left + incumbent // INSERT)
            row = np.full(letters + 1, NEVER)
            row[low : high + 1] = below[low : high + 1] + DELETE
            role, state = turns[i]
            if state != "x":
                stay = TRUNCATED if state == "-" else 0
                same = is_last if role == last else ~is_last if role == _other(last) else np.zeros(letters, bool)
                at = slice(max(1, low), high + 1)
                turned = below[at.start - 1 : high] + np.where(same[at.start - 1 : high], 0, REROLE) + stay
                row[at] = np.minimum(row[at], turned)
            row[low : high + 1] = np.minimum.accumulate(row[low : high + 1] - steps[low : high + 1]) + steps[low : high + 1]
            self.cost.append(np.minimum(row, NEVER))
        self.cost.reverse()

    def letter(self, m: int) -> str:
        return self.last if m % 2 else _other(self.last)

    def audit(self, i: int, m: int) -> str:
        """The edits' initials, least in ASCII of the cheapest ways from turn `i` on with m letters to make."""
        edits = []
        while i < len(self.turns):
            now, (role, state) = self.cost[i][m], self.turns[i]
            stay = TRUNCATED if state == "-" else 0
            if self.cost[i + 1][m] + DELETE == now:
                edits.append("D")
                i += 1
            elif m and self.cost[i][m - 1] + INSERT == now:
                edits.append("I")
                m -= 1
            else:
                edits.append("K" if role == self.letter(m) and self.cost[i + 1][m - 1] + stay == now else "R")
                i, m = i + 1, m - 1
        return "".join(edits)


def _plain_cost(turns: list[tuple[str, str]], first: str, lengths: tuple[int, int]) -> int:
    """What it costs to delete what must go, to put 0 to 2 turns first and to give the others the roles in order, for a length of
    `lengths` (least, remainder of 2); or to delete all."""
    least, parity = lengths
    sound = [t for t in turns if t[1] != "x"]
    costs = [DELETE * len(turns) + INSERT * least]
    for more in range(3):
        length = len(sound) + more
        if length >= least and length % 2 == parity:
            wanted = [first if (more + k) % 2 == 0 else _other(first) for k in range(len(sound))]
            kept = sum((REROLE if role != want else 0) + (TRUNCATED if state == "-" else 0) for (role, state), want in zip(sound, wanted, strict=True))
            costs.append(kept + INSERT * more + DELETE * (len(turns) - len(sound)))
    return min(costs)


def _lengths(entry: int, last: str) -> tuple[int, int]:
    """Least length of strings that lead from `entry` to the state of `last`, and its remainder of 2."""
    if entry in (USER, ASSISTANT) and "ua"[entry - USER] == last:
        return 0, 0
    odd = FOLLOWS[entry] == last
    return (1, 1) if odd else (2, 0)


@lru_cache(1 << 14)
def aligned(codes: str, entries: tuple[int, ...] = (START,)) -> dict[tuple[int, int], tuple[int, str]]:
    """For turns (two letters each), from each entry state to each state: the least cost and its least audit.

    Audits end with an edit of a turn, so of two different ones neither begins the other, and what follows can't change their order."""
    turns = [(codes[i], codes[i + 1]) for i in range(0, len(codes), 2)]
    found: dict[tuple[int, int], tuple[int, str]] = {}
    for last, state in (("u", USER), ("a", ASSISTANT)):
        incumbents = {e: _plain_cost(turns, FOLLOWS[e], _lengths(e, last)) for e in entries}
        table = Alignment(turns, last, max(incumbents.values()))
        for entry in entries:
            least, parity = _lengths(entry, last)
            ways = [(int(c), 0, m) for m, c in enumerate(table.cost[0]) if m >= least and m % 2 == parity]
            if entry == START:
                # A system turn kept first; what comes before it goes.
                least, parity = _lengths(SYSTEM, last)
                for p, (role, kind) in enumerate(turns):
                    if role == "s" and kind != "x":
                        before = DELETE * p + (TRUNCATED if kind == "-" else 0)
                        ways += [(before + int(c), p + 1, m) for m, c in enumerate(table.cost[p + 1]) if m >= least and m % 2 == parity]
            cost = min(c for c, _, _ in ways)
            if cost < NEVER:
                audits = ["D" * (after - 1) + "K" + table.audit(after, m) if after else table.audit(0, m) for c, after, m in ways if c == cost]
                found[entry, state] = cost, min(audits)
    for entry in entries:
        if entry in (START, SYSTEM):
            found[entry, entry] = DELETE * len(turns), "D" * len(turns)
    if START in entries:
        alone = [
            (DELETE * (len(turns) - 1) + (TRUNCATED if kind == "-" else 0), "D" * p + "K" + "D" * (len(turns) - 1 - p))
            for p, (role, kind) in enumerate(turns)
            if role == "s" and kind != "x"
        ]
        if alone:
            found[START, SYSTEM] = min(alone)
    return found


# Ways through a block or several: cost, and place of the audit among those from the same entry, of each entry and exit.
Ways = dict[tuple[int, int], tuple[int, int]]


def ranked(found: dict[tuple[int, int], tuple[int, str]]) -> Ways:
    out = {}
    for entry in range(4):
        audits = sorted(audit for (e, _), (_, audit) in found.items() if e == entry)
        out.update({(e, x): (cost, audits.index(audit)) for (e, x), (cost, audit) in found.items() if e == entry})
    return out


def middle(first: Ways, second: Ways, entry: int, leave: int) -> tuple[int, int, int] | None:
    """Cheapest cost from `entry` to `leave`, the first's place and the state between; the first audit in order of those."""
    ways = [(c + second[m, leave][0], place, m) for (e, m), (c, place) in first.items() if e == entry and (m, leave) in second]
    return min(ways, default=None)


def joined(first: Ways, second: Ways) -> Ways:
    """The ways through both. Audits of the same entry differ within the first block or, after the same state, in the second."""
    out = {}
    for entry in range(4):
        best = {x: w for x in range(4) if (w := middle(first, second, entry, x))}
        order = sorted((place, second[m, x][1], x) for x, (_, place, m) in best.items())
        out.update({(entry, x): (best[x][0], i) for i, (_, _, x) in enumerate(order)})
    return out


def chosen(blocks: list[Ways], entry: int, leave: int) -> list[tuple[int, int]]:
    """Entry and exit state of each block on the cheapest way, of those the one with the first audit."""
    rest = [blocks[-1]]
    for block in reversed(blocks[:-1]):
        rest.append(joined(block, rest[-1]))
    rest.reverse()
    out = []
    for i, block in enumerate(blocks[:-1]):
        to = middle(block, rest[i + 1], entry, leave)[2]
        out.append((entry, to))
        entry = to
    return [*out, (entry, leave)]


def closed(ways: Ways) -> int:
    """The state in which a conversation from START ends at least cost, before the empty turns that close it; ties by audit."""
    return min((cost + INSERT * len(CLOSING[x]), place, x) for (e, x), (cost, place) in ways.items() if e == START)[2]


# ---- rows ---------------------------------------------------------------------------------------------------

PLACE = ("conv_key", "part", "block")
# How the states of a turn are written in its code.
SOUND, CUT_CODE, GONE = ".", "-", "x"
WAYS = "array<long>"


def _packed(ways: Ways) -> list[int]:
    return [v for e in range(4) for x in range(4) for v in ways.get((e, x), (-1, -1))]


def _unpacked(values: list[int]) -> Ways:
    return {divmod(i // 2, 4): (values[i], values[i + 1]) for i in range(0, 32, 2) if values[i] >= 0}


def conversation_key(conv_id: str = "conv_id") -> Column:
    return F.coalesce(F.concat(F.lit("c"), F.col(conv_id).cast("string")), F.lit(""))


def _located(rows: DataFrame, block: int) -> DataFrame:
    """(conv_key, conv_id, turn, role, text, same, part, place, block): all rows, sorted over all tasks by conversation, turn (nulls
    first), role and text, so a conversation spreads over as many tasks as it needs. part is the task, place counts a
    conversation's rows in it, block cuts them into pieces."""
    texts = rows.select(
        conversation_key().alias("conv_key"),
        "conv_id",
        F.col("turn").cast("long").alias("turn"),
        F.coalesce(F.col("role").cast("string"), F.lit(" ")).alias("role"),
        F.coalesce(F.col("text").cast("string"), F.lit(" ")).alias("text"),
    )
    texts = texts.withColumn("same", F.sha2(F.concat(F.length("role").cast("string"), F.lit(":"), "role", "text"), 256))
    order = ["conv_key", F.asc_nulls_first("turn"), "role", "same", "copy"]
    dealt = texts.withColumn("copy", F.monotonically_increasing_id()).repartitionByRange(*order).sortWithinPartitions(*order)
    dealt = dealt.drop("copy").withColumn("part", F.spark_partition_id())

    def numbered(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, n = None, 0
        for part in parts:
            places = []
            for name in part.column("conv_key").to_pylist():
                key, n = name, n + 1 if name == key else 0
                places.append(n)
            yield part.append_column("place", pa.array(places, pa.int64())).append_column("block", pa.array([n // block for n in places], pa.int64()))

    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in dealt.schema)
    return dealt.mapInArrow(numbered, f"{schema}, place long, block long")


def _coded(placed: DataFrame) -> DataFrame:
    """(conv_key, part, block, place, code, fault) of each row: the first fault that holds, and what the alignment reads of it."""
    solid = r"[^\x20\x09-\x0D]"
    last = F.regexp_extract("text", rf"({solid})[\x20\x09-\x0D]*\z", 1)
    initial = F.substring("role", 1, 1)
    narrow = placed.select(
        *PLACE, "place", "same",
        F.when(initial.isin("s", "u", "a"), initial).otherwise(" ").alias("initial"),
        (last == "").alias("is_blank"),
        (~last.rlike("[.!?]")).alias("is_cut"),
    )
    first = narrow.groupBy("conv_key", "same").agg(F.min(F.struct("part", "place")).alias("first"))
    seen = F.struct("part", "place") > F.col("first")
    fault = F.when(F.col("is_blank"), BLANK).when(seen, DUPLICATE).when(F.col("is_cut"), CUT)
    state = F.when(fault == CUT, CUT_CODE).when(fault.isNotNull(), GONE).otherwise(SOUND)
    joined_back = narrow.join(first, ["conv_key", "same"])
    return joined_back.select(*PLACE, "place", F.concat("initial", state).alias("code"), fault.alias("fault"))


def _each(rows: DataFrame, key: tuple[str, ...], order: tuple[str, ...], made, schema: str) -> DataFrame:
    """What `made` gives for the rows (dicts, in order) of each key; a task holds one key's rows at a time."""
    names = [part.split()[0] for part in schema.split(", ")]

    def found(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        each = (row for part in parts for row in part.to_pylist())
        out: list[tuple] = []
        for _, group in groupby(each, key=lambda row: tuple(row[k] for k in key)):
            out += made(list(group))
            if len(out) >= 5_000:
                yield from record(out)
                out = []
        yield from record(out)

    def record(rows: list[tuple]) -> Iterator[pa.RecordBatch]:
        if rows:
            columns = zip(*rows, strict=True)
            yield pa.record_batch([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names)

    kinds = {"string": pa.string(), "long": pa.int64(), "int": pa.int32(), "boolean": pa.bool_(), "array<long>": pa.list_(pa.int64())}
    types = [kinds[part.split()[1]] for part in schema.split(", ")]
    return rows.repartition(*key).sortWithinPartitions(*key, *order).mapInArrow(found, schema)


EDITS = "conv_key string, part int, place long, fault string, edits string, made string"


def _written(group: list[dict], entry: int, audit: str, closing: str) -> list[tuple]:
    """A row for each turn of a block: its edits, insertions before it first (and, after the last, those that close), and the
    initials of the roles they make."""
    out, state, at = [], entry, 0
    for row in group:
        edits, made = "", ""
        while True:
            edit = audit[at]
            at, edits = at + 1, edits + edit
            if edit == "D":
                break
            letter = "s" if edit == "K" and row["code"][0] == "s" else FOLLOWS[state]
            made, state = made + letter, {"s": SYSTEM, "u": USER, "a": ASSISTANT}[letter]
            if edit != "I":
                break
        out.append([row["conv_key"], row["part"], row["place"], row["fault"], edits, made])
    out[-1][4] += "I" * len(closing)
    out[-1][5] += closing
    return [tuple(row) for row in out]


def _of(group: list[dict]) -> str:
    return "".join(row["code"] for row in group)


def _whole(group: list[dict]) -> list[tuple]:
    found = aligned(_of(group))
    state = closed(ranked(found))
    return _written(group, START, found[START, state][1], CLOSING[state])


def _edited(coded: DataFrame, scratch: Scratch) -> DataFrame:
    """(conv_key, part, place, fault, edits, made): the edits of each row on the cheapest way, ties to the first audit in ASCII."""
    ends = coded.groupBy("conv_key").agg(F.min(F.struct("part", "block")).alias("low"), F.max(F.struct("part", "block")).alias("high"))
    several = scratch.save(ends.where(F.col("low") != F.col("high")).select("conv_key", "high"), "several")
    short = coded.join(several, "conv_key", "left_anti")
    edits = _each(short, ("conv_key",), ("place",), _whole, EDITS)
    if several.isEmpty():
        return edits
    # Conversations of several blocks: the ways through each, then through each part, then the states between, and back.
    long = scratch.save(coded.join(several.select("conv_key"), "conv_key", "left_semi"), "long")

    def through(group: list[dict]) -> list[tuple]:
        return [(*(group[0][c] for c in PLACE), _packed(ranked(aligned(_of(group), (START, SYSTEM, USER, ASSISTANT)))))]

    blocks = scratch.save(_each(long, PLACE, ("place",), through, f"conv_key string, part int, block long, ways {WAYS}"), "blocks")

    def together(group: list[dict]) -> list[tuple]:
        return [(group[0]["conv_key"], group[0]["part"], _packed(reduce(joined, [_unpacked(row["ways"]) for row in group])))]

    parts = scratch.save(_each(blocks, ("conv_key", "part"), ("block",), together, f"conv_key string, part int, ways {WAYS}"), "parts")

    def outer(group: list[dict]) -> list[tuple]:
        ways = [_unpacked(row["ways"]) for row in group]
        leave = closed(reduce(joined, ways))
        return [(row["conv_key"], row["part"], *pair) for row, pair in zip(group, chosen(ways, START, leave), strict=True)]

    known = "conv_key string, part int, entry long, leave long"
    outside = scratch.save(_each(parts, ("conv_key",), ("part",), outer, known), "outside")

    def inner(group: list[dict]) -> list[tuple]:
        pairs = chosen([_unpacked(row["ways"]) for row in group], group[0]["entry"], group[0]["leave"])
        return [(*(row[c] for c in PLACE), *pair) for row, pair in zip(group, pairs, strict=True)]

    known = "conv_key string, part int, block long, entry long, leave long"
    inside = _each(blocks.join(outside, ["conv_key", "part"]), ("conv_key", "part"), ("block",), inner, known)
    is_last = F.struct("part", "block") == F.col("high")
    inside = scratch.save(inside.join(several, "conv_key").withColumn("closes", is_last).drop("high"), "inside")

    def back(group: list[dict]) -> list[tuple]:
        entry, leave = group[0]["entry"], group[0]["leave"]
        _, audit = aligned(_of(group), (entry,))[entry, leave]
        return _written(group, entry, audit, CLOSING[leave] if group[0]["closes"] else "")

    return edits.unionByName(_each(long.join(inside, list(PLACE)), PLACE, ("place",), back, EDITS))


def repaired(rows: DataFrame, scratch: Scratch, block: int = BLOCK) -> DataFrame:
    """(conv_key, conv_id, turn, role, text, fault, edits, made), a row for each row of `rows` (conv_id, turn, role, text), a
    conversation's rows in order within one task.

    A conversation's rows by turn (nulls first), role and text are edited at least cost until the initials of their roles match
    `(s?(ua)+)?`: a row is kept (K), gets the role user or assistant (R) or is deleted (D), and empty turns are inserted (I).
    Blank rows and repeats of an earlier role and text must go; a row cut off before its end costs more if it stays. `edits` are
    the initials in order, insertions before the row, and after the last row those that close; `made` has an initial of the
    resulting role for each edit but D. Ties go to the edits first in ASCII, over the whole conversation. fault is the first of
    blank, duplicate and truncated that holds, or null. Null roles and texts are one space, a null conv_id is a conversation, and
    repeated rows are rows. No rows give none. Other columns are not read.

    Up to `block` rows are aligned at a time with the alternating string of every feasible length. Longer conversations are cut
    into blocks, each aligned from and to every state, and the cheapest way through the blocks is found from their costs, so a conversation
    of any length spreads over many tasks; only its texts, in the end, pass through one task in order, one row at a time.
    """
    ship(rows.sparkSession)
    placed = scratch.save(_located(rows, block), "placed")
    coded = scratch.save(_coded(placed), "coded")
    edits = scratch.save(_edited(coded, scratch), "edits")
    # Each row meets its edits by sorting, which moves the texts once.
    own = [f for f in placed.schema if f.name not in ("same", "block")]
    texts = placed.select(*(f.name for f in own), *(F.lit(None).cast("string").alias(c) for c in ("fault", "edits", "made")))
    marks = edits.select(*(F.col(f.name) if f.name in edits.columns else F.lit(None).cast(f.dataType).alias(f.name) for f in own), "fault", "edits", "made")
    order = ("conv_key", "part", "place", F.asc_nulls_first("role"))
    met = marks.unionByName(texts).repartition("conv_key").sortWithinPartitions(*order)
    names = ["conv_key", "conv_id", "turn", "role", "text", "fault", "edits", "made"]
    own_names = [n for n in names if n not in ("fault", "edits", "made")]

    def paired(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        left = None
        for part in parts:
            whole = pa.Table.from_batches([part]) if left is None else pa.concat_tables([left, pa.Table.from_batches([part])])
            # Marks and texts take turns; an odd last row waits for its text.
            pairs = whole.num_rows // 2
            at = np.arange(pairs) * 2
            left = whole.slice(2 * pairs)
            marked, said = whole.take(pa.array(at)), whole.take(pa.array(at + 1))
            columns = [said.column(n) if n in own_names else marked.column(n) for n in names]
            yield from pa.table(columns, names).combine_chunks().to_batches()

    kind = rows.schema["conv_id"].dataType.simpleString()
    return met.mapInArrow(paired, f"conv_key string, conv_id {kind}, turn long, role string, text string, fault string, edits string, made string")


SUMMARY = "gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, repaired_sha256 string"
EDIT_COST = {"K": 0, "R": REROLE, "D": DELETE, "I": INSERT}


class _Summary:
    """One conversation, added row by row; texts go into the digest and are not kept."""

    def __init__(self) -> None:
        self.turns = self.illegal = self.cost = self.lines = 0
        self.low = self.high = self.before = None
        self.faults = {BLANK: 0, DUPLICATE: 0, CUT: 0}
        self.edits: list[str] = []
        self.digest = hashlib.sha256()

    def add(self, turn: int | None, role: str, text: str, fault: str | None, edits: str, made: str) -> None:
        if turn is not None and turn != self.high:
            self.low, self.high = turn if self.low is None else self.low, turn
            self.turns += 1
        if self.before is not None and self.before + role[:1] not in LEGAL:
            self.illegal += 1
        self.before = role[:1]
        if fault:
            self.faults[fault] += 1
        letters = iter(made)
        for edit in edits:
            self.cost += EDIT_COST[edit]
            if edit == "D":
                continue
            letter = next(letters)
            if edit != "I" and fault == CUT:
                self.cost += TRUNCATED
            line = f"{role if edit == 'K' else ROLES[letter]}:{'' if edit == 'I' else text}"
            self.digest.update(("\n" if self.lines else "").encode() + line.encode())
            self.lines += 1
        self.edits.append(edits)

    def row(self) -> tuple:
        gaps = 0 if self.low is None else self.high - self.low + 1 - self.turns
        return (gaps, *self.faults.values(), self.illegal, self.cost, "".join(self.edits), self.digest.hexdigest())


def summaries(turns: DataFrame) -> DataFrame:
    """One row for each conversation of `repaired`: conv_key, gaps in its turns, faults, illegal neighbours, cost, audit and digest."""
    names = ["conv_key", *(part.split()[0] for part in SUMMARY.split(", "))]
    wanted = turns.select("conv_key", "turn", "role", "text", "fault", "edits", "made")

    def summed(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        each = (row for part in parts for row in zip(*(c.to_pylist() for c in part.columns), strict=True))
        out = []
        for key, group in groupby(each, key=lambda row: row[0]):
            one = _Summary()
            for row in group:
                one.add(*row[1:])
            out.append((key, *one.row()))
            if len(out) >= 5_000:
                yield record(out)
                out = []
        if out:
            yield record(out)

    def record(rows: list[tuple]) -> pa.RecordBatch:
        return pa.record_batch([pa.array(c) for c in zip(*rows, strict=True)], names)

    return wanted.mapInArrow(summed, f"conv_key string, {SUMMARY}")


# ---- the query ----------------------------------------------------------------------------------------------


def damaged(rows: DataFrame) -> DataFrame:
    """Conversations with defects put in, told by a checksum of conversation and turn: rows dropped, emptied, without sentence
    ends, repeated, or with the role user. Nulls are one space."""
    space = F.lit(" ")
    name = F.concat_ws(":", F.coalesce(F.col("conv_id").cast("string"), space), F.coalesce(F.col("turn").cast("string"), space))
    dealt = rows.select(
        "conv_id", "turn",
        F.coalesce(F.col("role").cast("string"), space).alias("role"),
        F.coalesce(F.col("text").cast("string"), space).alias("text"),
        (F.crc32(name) % 20).alias("defect"),
    ).where("defect <> 0")
    text = F.when(F.col("defect") == 1, "").when(F.col("defect") == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text"))
    role = F.when(F.col("defect") == 4, "user").otherwise(F.col("role"))
    times = F.explode(F.array_repeat(F.lit(0), F.when(F.col("defect") == 3, 2).otherwise(1)))
    return dealt.select("conv_id", "turn", role.alias("role"), text.alias("text"), times.alias("_")).drop("_")


def op13_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = spark.read.parquet(f"{sf_dir}/conversations.parquet").select("conv_id", "turn", "role", "text")
    found = summaries(repaired(damaged(rows), Scratch(spark, "repair")))
    all_ids = rows.select("conv_id").distinct().withColumn("own_key", conversation_key())
    zeros = {name: F.coalesce(name, F.lit(0).cast("long")) for name in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")}
    nothing = hashlib.sha256(b"").hexdigest()
    return all_ids.join(found, F.col("own_key") == F.col("conv_key"), "left").select(
        "conv_id",
        *(value.alias(name) for name, value in zeros.items()),
        F.coalesce("audit", F.lit("")).alias("audit"),
        F.coalesce("repaired_sha256", F.lit(nothing)).alias("repaired_sha256"),
    )


# The oracle takes another way: the automaton of the grammar, one state's least (cost, audit) at a time, row by row.
OP13_SQL = r"""
with recursive raw as (
    select row_number() over () as r, conv_id, turn, coalesce(role, ' ') as role, coalesce(text, ' ') as text,
        coalesce(conv_id::varchar, ' ') || ':' || coalesce(turn::varchar, ' ') as name
    from conversations
),
marked as (
    select *, xor(4294967295, list_reduce(
        [4294967295::bigint] || list_transform(string_split(name, ''), lambda c: ascii(c)::bigint),
        lambda crc, byte: list_reduce(
            [xor(crc, byte), 0, 0, 0, 0, 0, 0, 0, 0], lambda v, nothing: xor(v >> 1, 3988292384 * (v & 1))
        )
    )) % 20 as defect
    from raw
),
rows as (
    select conv_id, turn, r, copy,
        case when defect = 4 then 'user' else role end as role,
        case when defect = 1 then '' when defect = 2 then regexp_replace(text, '[.!?]', '', 'g') else text end as text
    from marked, (values (0), (1)) as c(copy) where defect <> 0 and (copy = 0 or defect = 3)
),
placed as (
    select *, row_number() over (partition by conv_id order by turn nulls first, role, text, r, copy) as i,
        regexp_extract(text, '([^\x20\x09-\x0D])[\x20\x09-\x0D]*$', 1) as final, substr(role, 1, 1) as initial
    from rows
),
faults as (
    select *, case when final = '' then 'blank'
        when row_number() over (partition by conv_id, role, text order by i) > 1 then 'duplicate'
        when not regexp_matches(final, '[.!?]') then 'truncated' end as fault,
        lag(initial) over (partition by conv_id order by i) as before
    from placed
),
sizes as (
    select conv_id, count(*) as n, coalesce(max(turn) - min(turn) + 1 - count(distinct turn), 0) as gaps,
        count(*) filter (fault = 'blank') as blank, count(*) filter (fault = 'duplicate') as duplicate,
        count(*) filter (fault = 'truncated') as truncated,
        count(*) filter (before is not null and before || initial not in ('su', 'ua', 'au')) as illegal
    from faults group by conv_id
),
inserts(state, upto, edits, made) as (
    values ('', '', '', ''), ('', 'u', 'I', 'u'), ('', 'a', 'II', 'ua'), ('s', 's', '', ''), ('s', 'u', 'I', 'u'), ('s', 'a', 'II', 'ua'),
        ('u', 'u', '', ''), ('u', 'a', 'I', 'a'), ('u', 'u', 'II', 'au'), ('a', 'a', '', ''), ('a', 'u', 'I', 'u'), ('a', 'a', 'II', 'ua')
),
moves as (
    select state, upto, edits, made, m.next, m.role from inserts,
        (values ('', 's', 's'), ('', 'u', 'u'), ('s', 'u', 'u'), ('u', 'a', 'a'), ('a', 'u', 'u')) as m(last, next, role) where m.last = upto
),
steps as (
    select f.conv_id, f.i, v.state, v.state_after, v.edits, v.made, v.cost
    from faults f, lateral (
        select state, upto as state_after, edits || 'D' as edits, made, 3 * len(edits) + 4 as cost from inserts
        union all
        select state, next, edits || case when f.initial = next then 'K' else 'R' end, made || next,
            3 * len(edits) + case when f.initial = next then 0 else 3 end + case when f.fault = 'truncated' then 3 else 0 end
        from moves where (next <> 's' or f.initial = 's') and coalesce(f.fault, 'truncated') = 'truncated'
    ) as v
),
ways as (
    select conv_id, 0::bigint as i, '' as state, 0::bigint as cost, '' as audit, '' as made from (select distinct conv_id from faults)
    union all
    select conv_id, i, state, cost, audit, made from (
        select w.conv_id, s.i, s.state_after as state, w.cost + s.cost as cost, w.audit || s.edits as audit, w.made || s.made as made,
            row_number() over (partition by w.conv_id, s.state_after order by w.cost + s.cost, w.audit || s.edits) as best
        from ways w join steps s on s.conv_id is not distinct from w.conv_id and s.i = w.i + 1 and s.state = w.state
    ) where best = 1
),
ended as (
    select w.conv_id, w.cost + 3 * len(c.edits) as cost, w.audit || c.edits as audit, w.made || c.made as made
    from ways w join sizes z on z.conv_id is not distinct from w.conv_id and z.n = w.i
    join (values ('', '', ''), ('s', 'II', 'ua'), ('u', 'I', 'a'), ('a', '', '')) as c(state, edits, made) on c.state = w.state
    qualify row_number() over (partition by w.conv_id order by w.cost + 3 * len(c.edits), w.audit || c.edits) = 1
),
letters as (
    select conv_id, k, made, audit[k] as edit,
        count(*) filter (audit[k] <> 'I') over w as i, count(*) filter (audit[k] <> 'D') over w as m
    from (select *, unnest(range(1, len(audit) + 1)) as k from ended)
    window w as (partition by conv_id order by k)
),
texts as (
    select l.conv_id, string_agg(
        case when edit = 'K' then f.role when made[m] = 'u' then 'user' else 'assistant' end || ':' || case when edit = 'I' then '' else f.text end,
        chr(10) order by k) as whole
    from letters l left join faults f on f.conv_id is not distinct from l.conv_id and f.i = l.i
    where edit <> 'D' group by l.conv_id
)
select ids.conv_id, coalesce(gaps, 0)::bigint as gaps, coalesce(blank, 0) as blank, coalesce(duplicate, 0) as duplicate,
    coalesce(truncated, 0) as truncated, coalesce(illegal, 0) as illegal, coalesce(cost, 0)::bigint as cost,
    coalesce(audit, '') as audit, sha256(coalesce(whole, '')) as repaired_sha256
from (select distinct conv_id from conversations) ids
left join sizes z on z.conv_id is not distinct from ids.conv_id
left join ended e on e.conv_id is not distinct from ids.conv_id
left join texts t on t.conv_id is not distinct from ids.conv_id
"""
