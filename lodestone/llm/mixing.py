"""Mixing sources to target weights: Sainte-Laguë apportionment of equal blocks of words to sources and shards."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lodestone.llm.scratch import Scratch, documents

WORD = r"[^\x20\x09-\x0D]+"
WEIGHTS = (3, 1, 2)
SHARE = (3, 2)  # the mix has 3/2 of all words
MOST = 2  # no document, and so no source, counts more often
BLOCK_WORDS = 64
SHARDS = 1024
SHARD_BLOCKS = 1024
# So many sources (a name and a few numbers each) are sent to every task; more are joined by a shuffle.
BROADCAST_SOURCES = 10_000
SEED = 7


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def _small(df: DataFrame, rows: int) -> DataFrame:
    return F.broadcast(df) if rows <= BROADCAST_SOURCES else df


def source_targets(sizes: DataFrame) -> DataFrame:
    """A row per source of `sizes` (source, size): its words, weight and target, by code point with null last.

    Weights repeat in that order. All sources share `SHARE` of all words by weight; a target stops at `MOST` times its
    source's words and the excess goes to the others by weight. In the order of words per weight, the sources that stop
    are a prefix, so the level of the others follows from running sums. The window runs over one row per source.
    """
    total = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    number = F.row_number().over(by_name) - 1
    weight = F.element_at(F.array(*[F.lit(w) for w in WEIGHTS]), (number % len(WEIGHTS) + 1).cast("int")).cast("long")
    rows = total.select("source", "source_size", number.alias("source_no")).withColumn("weight", weight)
    filled = Window.orderBy(F.col("source_size") / F.col("weight"), "source_no")
    before = filled.rowsBetween(Window.unboundedPreceding, -1)
    every = filled.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    capped = F.coalesce(F.sum("source_size").over(before), F.lit(0)) * MOST
    open_weight = F.sum("weight").over(every) - F.coalesce(F.sum("weight").over(before), F.lit(0))
    # Twice the words left for this source and those after it, so that all is whole numbers up to one division.
    left = F.sum("source_size").over(every) * SHARE[0] - capped * SHARE[1]
    rows = rows.withColumn("left", left).withColumn("open_weight", open_weight)
    stops = F.col("source_size") * MOST * SHARE[1] * F.col("open_weight") <= F.col("left") * F.col("weight")
    rows = rows.withColumn("stops", stops)
    level = F.first(F.when(~F.col("stops"), F.struct("left", "open_weight")), ignorenulls=True).over(every)
    rows = rows.withColumn("level", level)
    target = F.when(F.col("stops"), (F.col("source_size") * MOST).cast("double")).otherwise(
        (F.col("weight") * F.col("level.left")).cast("double") / (F.col("level.open_weight") * SHARE[1]).cast("double")
    )
    return rows.select("source", "source_no", "source_size", "weight", target.alias("target"))


def apportion(parties: DataFrame, group: list[str], party: list[str], weight: str, seats: str, most: str) -> DataFrame:
    """Sainte-Laguë: `parties` with `quota`, of which each group's sum is its `seats`, by the highest of weight / (2k + 1).

    No party gets more than `most`. Shares rounded to the nearest are the seats of all quotients above one bound, so they
    are right but for a few seats a group; these few are given by the highest open quotients, or taken back by the lowest
    given ones, ties by the numbers in `party`. Listed are a group's parties times its few open seats, not all its seats.
    """
    of_group = Window.partitionBy(*group) if group else Window.partitionBy(F.lit(0))
    share = F.col(weight) / F.sum(weight).over(of_group) * F.col(seats)
    near = F.least(F.round(F.coalesce(share, F.lit(0.0))).cast("long"), F.col(most))
    rows = parties.withColumn("near", near)
    rows = rows.withColumn("open", F.col(seats) - F.sum("near").over(of_group))
    room = F.least(F.col("open"), F.col(most) - F.col("near"))
    more = F.when(room > 0, F.transform(F.sequence(F.lit(0).cast("long"), room - 1), lambda j: F.col("near") + j))
    back = F.least(-F.col("open"), F.col("near"))
    less = F.when(back > 0, F.transform(F.sequence(F.lit(1).cast("long"), back), lambda j: F.col("near") - j))
    # k: a party's seats before this one.
    listed = rows.select(*group, *party, weight, "open", F.explode(F.coalesce(more, less)).alias("k"))
    quotient = F.col(weight) / (2 * F.col("k") + 1)
    signed = F.when(F.col("open") > 0, -quotient).otherwise(quotient)
    # Of equal quotients the first party's counts more: it is given first and taken back last.
    ties = [F.when(F.col("open") > 0, F.col(c)).otherwise(-F.col(c)) for c in party]
    order = of_group.orderBy(signed, *ties)
    chosen = listed.withColumn("place", F.row_number().over(order)).where(F.col("place") <= F.abs("open"))
    changed = chosen.groupBy(*group, *party).agg(F.sum(F.signum("open")).cast("long").alias("change"))
    same = [F.col(f"p.{c}").eqNullSafe(F.col(f"c.{c}")) for c in (*group, *party)]
    joined = rows.alias("p").join(changed.alias("c"), same, "left")
    return joined.select("p.*", (F.col("near") + F.coalesce("change", F.lit(0))).alias("quota")).drop("near", "open")


def mix(docs: DataFrame, scratch: Scratch, seed: int = SEED) -> DataFrame:
    """(doc_id, source, size, source_size, target, shard, quota, position, taken), a row for each row of `docs`.

    Sources get blocks of `BLOCK_WORDS` words by Sainte-Laguë on their targets, and their shards by Sainte-Laguë on the
    shards' words. A source's shards are dealt by a hash of id and text, about 1/`SHARDS` of all words each and never so
    few that rounding to blocks counts, so a hot source spreads over many. A shard's documents stand in a seeded random
    order as one run of words; its quota is taken as whole rounds of the run and then its first blocks, so that most
    documents are taken whole and at most one a shard is cut. The order follows from seed, id and text: reruns agree.
    Null texts and texts without words have size 0 and take 0; a null source is a source, the last. Repeated rows
    are rows like any other. No rows give none. Other columns are not read.
    """
    size = word_count(F.col("text")).alias("size")
    rows = scratch.save(docs.select("doc_id", "source", size, _key(seed).alias("key")), "sizes")
    sources = scratch.save(source_targets(rows.select("source", "size")), "targets")
    count, words = sources.agg(F.count("*"), F.sum("source_size")).first()
    words = max(words or 0, 1)
    by_share = F.ceil(F.col("source_size") * SHARDS / words)
    by_blocks = F.floor(F.col("source_size") / (BLOCK_WORDS * SHARD_BLOCKS))
    sources = sources.withColumn("shards", F.greatest(F.least(by_share, by_blocks), F.lit(1)).cast("long"))
    same = F.col("d.source").eqNullSafe(F.col("s.source"))
    dealt = rows.alias("d").join(_small(sources, count).alias("s"), same).select(
        "d.doc_id", "d.source", "d.size", "d.key", "s.source_no", "s.source_size", "s.target", "s.shards"
    )
    shard = F.conv(F.substring("key", 1, 12), 16, 10).cast("long") % F.col("shards")
    dealt = dealt.withColumn("shard", shard)
    shards = dealt.groupBy("source_no", "shard").agg(F.sum("size").alias("shard_size"))
    sources = _source_quotas(sources)
    shards = shards.join(_small(sources.select("source_no", "quota"), count), "source_no").withColumnRenamed("quota", "seats")
    most = F.ceil(F.col("shard_size") * MOST / BLOCK_WORDS).cast("long")
    shards = scratch.save(
        apportion(shards.withColumn("most", most), ["source_no"], ["shard"], "shard_size", "seats", "most").select(
            "source_no", "shard", "shard_size", "quota"
        ),
        "shards",
    )
    run = Window.partitionBy("source_no", "shard").orderBy("key", "doc_id", "size").rowsBetween(Window.unboundedPreceding, -1)
    placed = dealt.withColumn("position", F.coalesce(F.sum("size").over(run), F.lit(0)))
    placed = placed.join(shards, ["source_no", "shard"])
    asked = F.col("quota") * BLOCK_WORDS
    rounds = F.floor(asked / F.greatest(F.col("shard_size"), F.lit(1))).cast("long")
    first = asked - rounds * F.col("shard_size")
    part = F.greatest(F.least(F.col("size"), first - F.col("position")), F.lit(0))
    taken = F.least(rounds * F.col("size") + part, F.col("size") * MOST).cast("long")
    return placed.select(
        "doc_id", "source", "size", "source_size", "target", "shard", "quota", "position", taken.alias("taken"), "key"
    )


def _source_quotas(sources: DataFrame) -> DataFrame:
    """Blocks of each source; all sources compete for the blocks of the whole mix."""
    most = F.ceil(F.col("source_size") * MOST / BLOCK_WORDS).cast("long")
    seats = F.round(F.sum("target").over(Window.partitionBy(F.lit(0))) / BLOCK_WORDS).cast("long")
    wanted = sources.withColumn("seats", seats).withColumn("most", most)
    return apportion(wanted, [], ["source_no"], "target", "seats", "most")


def _key(seed: int) -> Column:
    """A row's place in the seeded order: by its id, or its text if it has none."""
    name = F.coalesce(F.col("doc_id").cast("string"), F.sha2(F.coalesce(F.col("text"), F.lit("")), 256))
    return F.md5(F.concat_ws("|", F.lit(str(seed)), name))


def keep_mix(docs: DataFrame, scratch: Scratch, seed: int = SEED) -> DataFrame:
    """The mix as rows of `docs`: a document stands as often as it is taken whole, and once more with its first words if
    it is cut; `n_chars`, if there, is then that of these words. Rows of one id get the decision of the first of them."""
    decided = mix(docs, scratch, seed).groupBy("key").agg(F.min_by("taken", "position").alias("taken"))
    rows = docs.select(F.struct(*docs.columns).alias("row"), _key(seed).alias("key"))
    rows = rows.join(decided.where("taken > 0"), "key")
    size = F.greatest(word_count(F.col("row.text")), F.lit(1))
    rest = (F.col("taken") % size).cast("int")
    words = F.regexp_extract_all(F.col("row.text"), F.lit(f"{WORD}[\\x20\\x09-\\x0D]*"), F.lit(0))
    cut = F.rtrim(F.array_join(F.slice(words, 1, rest), ""))
    whole = F.array_repeat(F.lit(None).cast("string"), F.floor(F.col("taken") / size).cast("int"))
    texts = F.when(rest > 0, F.concat(whole, F.array(cut))).otherwise(whole)
    out = rows.select("row", F.explode(texts).alias("cut"))
    row, is_cut = F.col("row"), F.col("cut").isNotNull()
    columns = []
    for field in docs.schema.fields:
        value = row[field.name]
        if field.name == "text":
            value = F.coalesce("cut", value)
        elif field.name == "n_chars":
            value = F.when(is_cut, F.length("cut").cast(field.dataType)).otherwise(value)
        columns.append(value.alias(field.name))
    return out.select(*columns)


def op7_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix(documents(spark, sf_dir), Scratch(spark, "mixing")).select(
        "doc_id", "size", "source_size", "target", "taken", "source", "shard", "position"
    )


OP7_SQL = f"""
WITH RECURSIVE d AS (
  SELECT doc_id, source, md5('{SEED}|' || doc_id) AS key,
         len(regexp_extract_all(coalesce(text, ''), '{WORD}'))::BIGINT AS size
  FROM documents),
t AS (
  SELECT source, sum(size)::BIGINT AS source_size,
         (row_number() OVER (ORDER BY source NULLS LAST) - 1)::BIGINT AS source_no FROM d GROUP BY source),
w AS (SELECT *, [3, 1, 2][source_no % 3 + 1]::BIGINT AS weight FROM t),
f AS (
  SELECT *, sum(source_size) OVER () AS words,
         coalesce(sum(source_size) OVER before, 0) * 2 AS capped,
         sum(weight) OVER () - coalesce(sum(weight) OVER before, 0) AS open_weight
  FROM w WINDOW before AS (
    ORDER BY source_size / weight, source_no ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
c AS (SELECT *, 3 * words - 2 * capped AS rest, 4 * source_size * open_weight <= (3 * words - 2 * capped) * weight AS stops FROM f),
l AS (SELECT rest, open_weight FROM c WHERE NOT stops ORDER BY source_size / weight, source_no LIMIT 1),
g AS (
  SELECT c.*, CASE WHEN stops THEN (2 * source_size)::DOUBLE
    ELSE (weight * (SELECT rest FROM l))::DOUBLE / (2 * (SELECT open_weight FROM l))::DOUBLE END AS target,
    greatest(least(ceil(source_size * {SHARDS} / words), floor(source_size / {BLOCK_WORDS * SHARD_BLOCKS})), 1)::BIGINT AS shards
  FROM c),
seats AS (
  SELECT source_no, count(*) AS quota FROM (
    SELECT source_no, row_number() OVER (ORDER BY target / (2 * k + 1) DESC, source_no) AS place
    FROM (SELECT source_no, target, unnest(range(ceil(source_size * 2 / {BLOCK_WORDS})::BIGINT)) AS k FROM g))
  WHERE place <= (SELECT round(sum(target) / {BLOCK_WORDS}) FROM g) GROUP BY source_no),
dealt AS (
  SELECT d.doc_id, d.source, d.size, d.key, g.source_no, g.source_size, g.target,
         ('0x' || substr(d.key, 1, 12))::BIGINT % g.shards AS shard
  FROM d JOIN g ON d.source IS NOT DISTINCT FROM g.source),
parts AS (SELECT source_no, shard, sum(size)::BIGINT AS shard_size FROM dealt GROUP BY ALL),
quotas AS (
  SELECT source_no, shard, count(*) FILTER (place <= quota) AS quota FROM (
    SELECT p.source_no, p.shard, s.quota,
           row_number() OVER (PARTITION BY p.source_no ORDER BY p.shard_size / (2 * k + 1) DESC, p.shard) AS place
    FROM (SELECT *, unnest(range(ceil(shard_size * 2 / {BLOCK_WORDS})::BIGINT)) AS k FROM parts) p
    JOIN seats s USING (source_no)) GROUP BY ALL),
placed AS (
  SELECT *, coalesce(sum(size) OVER (PARTITION BY source_no, shard ORDER BY key, doc_id
    ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS position FROM dealt),
asked AS (
  SELECT p.*, parts.shard_size, coalesce(q.quota, 0) * {BLOCK_WORDS} AS want
  FROM placed p JOIN parts USING (source_no, shard) LEFT JOIN quotas q USING (source_no, shard))
SELECT doc_id, size, source_size, target, source, shard, position,
       least((want // greatest(shard_size, 1)) * size
         + greatest(least(size, want % greatest(shard_size, 1) - position), 0), 2 * size)::BIGINT AS taken
FROM asked
"""
