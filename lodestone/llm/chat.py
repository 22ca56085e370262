"""Chat formatting: repair of role sequences at minimum cost over an automaton of legal turns, then rendering."""

from __future__ import annotations

from collections.abc import Iterator
from itertools import groupby, islice

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lodestone.llm.scratch import Scratch, ship

ROLES = ("system", "user", "assistant")
# States of the automaton: nothing yet, or the role of the turn that is open. A conversation ends after an assistant.
START, SYSTEM, USER, ASSISTANT = range(4)
NEXT = {START: (SYSTEM, USER), SYSTEM: (USER,), USER: (ASSISTANT,), ASSISTANT: (USER,)}
FINAL = (START, ASSISTANT)
# Costs: joining a turn to the one before, another role for a turn (or one for a turn without a known role), an empty turn.
MERGE, RELABEL, INSERT = 1.0, 2.0, 1.5
SEGMENT = 64  # turns, and then segments, that one step of the dynamic programme takes together
INFINITE = float("inf")


def _inserts() -> tuple[list[list[float]], list[list[tuple[int, ...]]]]:
    """Cheapest empty turns that lead from one state to another: their cost, and their roles. At most two are of use."""
    cost = [[0.0 if a == b else INFINITE for b in range(4)] for a in range(4)]
    path: list[list[tuple[int, ...]]] = [[() for _ in range(4)] for _ in range(4)]
    for _ in range(3):
        for a in range(4):
            for b in range(4):
                for c in NEXT[b]:
                    if cost[a][b] + INSERT < cost[a][c]:
                        cost[a][c], path[a][c] = cost[a][b] + INSERT, (*path[a][b], c)
    return cost, path


INSERT_COST, INSERT_PATH = _inserts()


def moves(role: int) -> list[list[tuple[float, str, tuple[int, ...]] | None]]:
    """For a turn of `role` (0: unknown), the cheapest way from each state to each: cost, action and empty turns before it.
    A turn of known role is kept or relabelled, and stands alone or joins the open turn of that role. Ties go to the first of
    keep, merge, relabel and merge with another role."""
    out: list[list[tuple[float, str, tuple[int, ...]] | None]] = [[None] * 4 for _ in range(4)]
    for a in range(4):
        for to in (SYSTEM, USER, ASSISTANT):
            change = 0.0 if to == role else RELABEL
            names = ("keep", "merge") if to == role else ("relabel", "relabel+merge")
            ways = [(change + INSERT_COST[a][b], names[0], INSERT_PATH[a][b]) for b in range(4) if to in NEXT[b]]
            if a == to:
                ways.append((change + MERGE, names[1], ()))
            best = min(ways, key=lambda w: w[0])
            if best[0] < INFINITE:
                out[a][to] = best
    return out


MOVES = [moves(role) for role in range(4)]
STEP = np.array([[[INFINITE if way is None else way[0] for way in row] for row in table] for table in MOVES])
# After the last turn, empty turns up to a final state.
CLOSE = [min((INSERT_COST[a][b], b) for b in FINAL if a == b or b != START) for a in range(4)]


def product(matrices: list[np.ndarray]) -> np.ndarray:
    """Cheapest ways through all steps from each state to each."""
    total = np.where(np.eye(4, dtype=bool), 0.0, INFINITE)
    for step in matrices:
        total = (total[:, :, None] + step[None]).min(axis=1)
    return total


def states(matrices: list[np.ndarray], entry: int, leave: int) -> list[int]:
    """The states before, between and after the steps on a cheapest way from `entry` to `leave`; ties to lower states."""
    costs = [np.where(np.arange(4) == entry, 0.0, INFINITE)]
    for step in matrices:
        costs.append((costs[-1][:, None] + step).min(axis=0))
    way = [leave]
    for cost, step in zip(reversed(costs[:-1]), reversed(matrices), strict=True):
        way.append(int(np.argmin(cost + step[:, way[-1]])))
    return way[::-1]


MATRIX = "array<double>"
GROUP = ("conv_key", "segment")


def _groups(parts: Iterator[pa.RecordBatch]) -> Iterator[list[dict]]:
    """The rows of each conversation and segment, from sorted rows; one group is held at a time."""
    rows = (row for part in parts for row in part.to_pylist())
    for _, group in groupby(rows, key=lambda row: (row["conv_key"], row["segment"])):
        yield list(group)


def _together(rows: DataFrame, order: list[str]) -> DataFrame:
    return rows.repartition(*GROUP).sortWithinPartitions(*GROUP, *order)


def _steps(group: list[dict]) -> list[np.ndarray]:
    return [STEP[row["role_no"]] if "role_no" in row else np.reshape(row["matrix"], (4, 4)) for row in group]


def _batches(rows: Iterator[list], names: list[str], most: int = 10_000) -> Iterator[pa.RecordBatch]:
    while some := list(islice(rows, most)):
        yield pa.record_batch([pa.array(c) for c in zip(*some, strict=True)], names)


def _summaries(rows: DataFrame, order: list[str]) -> DataFrame:
    """One matrix for each conversation and segment of `rows`, from their matrices or roles in order."""

    def summed(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = ([g[0]["conv_key"], g[0]["segment"], product(_steps(g)).ravel().tolist()] for g in _groups(parts))
        yield from _batches(found, [*GROUP, "matrix"])

    return _together(rows, order).mapInArrow(summed, f"conv_key string, segment long, matrix {MATRIX}")


def _placed(rows: DataFrame, known: DataFrame, order: list[str], name: str) -> DataFrame:
    """(conv_key, `name`, entry, leave): the states before and after each row, from those of its conversation and segment."""

    def placed(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def found() -> Iterator[list]:
            for g in _groups(parts):
                way = states(_steps(g), g[0]["entry"], g[0]["leave"])
                yield from ([row["conv_key"], row[name], *way[i : i + 2]] for i, row in enumerate(g))

        yield from _batches(found(), ["conv_key", name, "entry", "leave"])

    schema = f"conv_key string, {name} long, entry long, leave long"
    return _together(rows.join(known, list(GROUP)), order).mapInArrow(placed, schema)


def repaired_turns(turns: DataFrame, scratch: Scratch) -> DataFrame:
    """(conv_key, conv_id, turn, place, role, text, new_role, action, inserted, entry, leave, last): a row for each row of `turns`.

    A conversation's rows, by turn (null last), role and text, become a legal sequence: at most one system turn, first, then
    user and assistant in turn, an assistant last. The cheapest way is found by dynamic programming: `MERGE` joins a
    turn to the one before, `RELABEL` gives it another role, `INSERT` puts an empty turn before it. A role is known whatever
    its case and spaces; null and other roles are relabelled. Costs add up, so `SEGMENT` turns are summed up in a
    matrix of costs from state to state, as many matrices in one again, and so on up to one a conversation; the way down then
    fixes the states at each border. Thus a conversation of any length spreads over many tasks, of which none holds more
    than `SEGMENT` rows of a group; only rows that agree in conversation, turn and role stay together in a segment. A null
    conv_id is a conversation, as are repeated rows turns, and a null text is empty. No rows give none. Other columns are not read.
    """
    ship(turns.sparkSession)
    name = F.lower(F.trim("role"))
    role = F.coalesce(F.array_position(F.array(*[F.lit(r) for r in ROLES]), name).cast("int"), F.lit(0))
    rows = turns.select(
        F.coalesce(F.concat(F.lit("c"), F.col("conv_id").cast("string")), F.lit("")).alias("conv_key"),
        "conv_id",
        F.col("turn").cast("long").alias("turn"),
        F.col("role").cast("string").alias("role"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
        role.alias("role_no"),
    )
    # Turn numbers place rows without sorting a conversation anywhere; equal rows need no order among them.
    low, high = rows.agg(F.min("turn"), F.max("turn")).first()
    low, high = (low or 0) // SEGMENT, (high or 0) // SEGMENT
    segment = F.coalesce(F.floor(F.col("turn") / SEGMENT), F.lit(high + 1)).cast("long") - low
    rows = rows.withColumn("segment", segment).withColumn("null_turn", F.col("turn").isNull())
    rows = rows.withColumn("text_hash", F.xxhash64("text")).withColumn("id", F.monotonically_increasing_id())
    rows = scratch.save(rows, "rows")
    order = ["turn", "role_no", "text_hash", "id"]
    steps = rows.select(*GROUP, *order)
    level = scratch.save(_summaries(steps, order), "level0")
    levels = [level]
    up = F.floor(F.col("segment") / SEGMENT).cast("long").alias("segment")
    while not level.groupBy("conv_key").agg(F.count("*").alias("n")).where("n > 1").isEmpty():
        below = level.select("conv_key", F.col("segment").alias("child"), up, "matrix")
        level = scratch.save(_summaries(below, ["child"]), f"level{len(levels)}")
        levels.append(level)
    from_start = F.array(*[F.col("matrix")[a] + F.lit(float(CLOSE[a][0])) for a in range(4)])
    leave = F.array_position(from_start, F.array_min(from_start)) - 1
    known = level.select(*GROUP, F.lit(START).cast("long").alias("entry"), leave.cast("long").alias("leave"))
    for depth in range(len(levels) - 1, 0, -1):
        below = levels[depth - 1].select("conv_key", F.col("segment").alias("child"), up, "matrix")
        placed = _placed(below, known, ["child"], "child")
        known = scratch.save(placed.select("conv_key", F.col("child").alias("segment"), "entry", "leave"), f"states{depth}")
    placed = _placed(steps, known, order, "id")
    placed = scratch.save(placed.select("id", F.col("entry").cast("int").alias("entry"), F.col("leave").cast("int").alias("leave")), "states0")
    ways = {(r, a, b): MOVES[r][a][b] for r in range(4) for a in range(4) for b in range(4) if MOVES[r][a][b]}
    key = F.col("role_no") * 16 + F.col("entry") * 4 + F.col("leave")

    def chosen(values: dict) -> Column:
        return F.create_map(*[F.lit(v) for (r, a, b), value in values.items() for v in (r * 16 + a * 4 + b, value)])[key]

    found = rows.join(placed, "id")
    return found.select(
        "conv_key",
        "conv_id",
        "turn",
        F.struct("null_turn", "turn", "role_no", "text_hash", "id").alias("place"),
        "role",
        "text",
        F.element_at(F.array(*[F.lit(r) for r in ROLES]), F.col("leave")).alias("new_role"),
        chosen({k: w[1] for k, w in ways.items()}).alias("action"),
        chosen({k: ",".join(ROLES[s - 1] for s in w[2]) for k, w in ways.items()}).alias("inserted"),
        chosen({k: w[0] for k, w in ways.items()}).alias("cost"),
        "entry",
        "leave",
    )


HEAD, TAIL = "<|{}|>\n", "<|end|>\n"


def _plain(text: Column) -> Column:
    """The text without anything that reads as a mark: a space after each '<|'."""
    return F.replace(text, F.lit("<|"), F.lit("< |"))


def rendered(turns: DataFrame, scratch: Scratch) -> DataFrame:
    """The rows of `repaired_turns` with fragment, and closing: a conversation's fragments in the order of place, and the last
    row's closing after them, are its text. A merged turn goes on after a blank line; others close the turn before, add the
    empty turns and open their own. closing is null on all rows but the last. Text can't forge marks."""
    found = scratch.save(repaired_turns(turns, scratch), "repaired")
    last = found.groupBy("conv_key").agg(F.max("place").alias("last"))
    rows = found.join(last.withColumnRenamed("conv_key", "of"), F.col("conv_key") == F.col("of"))
    empties = F.transform(
        F.filter(F.split("inserted", ","), lambda r: r != ""), lambda r: F.concat(F.lit("<|"), r, F.lit("|>\n" + TAIL))
    )
    opened = F.concat(
        F.when(F.col("entry") == START, "").otherwise("\n" + TAIL),
        F.array_join(empties, ""),
        F.concat(F.lit("<|"), "new_role", F.lit("|>\n")),
        _plain(F.col("text")),
    )
    fragment = F.when(F.col("action").endswith("merge"), F.concat(F.lit("\n\n"), _plain(F.col("text")))).otherwise(opened)
    ends = {a: "\n" + TAIL + "".join(HEAD.format(ROLES[s - 1]) + TAIL for s in INSERT_PATH[a][CLOSE[a][1]]) for a in (1, 2, 3)}
    closing = F.create_map(*[F.lit(v) for item in ends.items() for v in item])[F.col("leave")]
    end_cost = F.element_at(F.array(*[F.lit(float(c)) for c, _ in CLOSE]), F.col("leave") + 1)
    is_last = F.col("place") == F.col("last")
    return rows.select(
        *found.columns,
        fragment.alias("fragment"),
        F.when(is_last, closing).alias("closing"),
        F.when(is_last, end_cost).alias("end_cost"),
    )


def op6_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = rendered(spark.read.parquet(f"{sf_dir}/conversations.parquet"), Scratch(spark, "chat"))
    return rows.select(
        "conv_id",
        "turn",
        "role",
        "new_role",
        "action",
        "inserted",
        (F.col("cost") + F.coalesce("end_cost", F.lit(0.0))).alias("cost"),
        F.col("closing").isNotNull().alias("is_last"),
        F.sha2(F.concat("fragment", F.coalesce("closing", F.lit(""))), 256).alias("fragment_sha256"),
    )
