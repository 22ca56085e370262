"""Fuzzy line deduplication: SimHash of normalised lines, pigeonhole blocks, edit similarity, one line of each group."""

from __future__ import annotations

from collections.abc import Callable
from itertools import combinations
from math import comb

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lodestone.llm.components import connected_components
from lodestone.llm.scratch import Scratch, documents

DISTANCE, SIMILARITY = 3, 0.8
# Blocks of the fingerprint; DISTANCE of them are left out of a join key. More blocks make longer keys and more rows.
BLOCKS = 5
BITS = 64
# A table of at most so many short rows is sent to every task.
BROADCAST_ROWS = 250_000
# Rows of two numbers that a task may hash, some 60 MB.
HASHED_ROWS = 1_000_000
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
DIGITS = "123456789"
SPACES, MARKS = "\t\r\x0b\x0c", ".,;:!?\"'()[]{}<>|*_#"
# A line of so many characters has fewer words than a lane of 16 bits can count.
LANE = 16
LONG_CHARS = 1 << LANE


def _signed(number: int) -> int:
    return number - (1 << BITS) if number >= 1 << (BITS - 1) else number


def _repeated(pattern: int, every: int) -> int:
    return sum(pattern << at for at in range(0, BITS, every))


def plain(text: Column) -> Column:
    """Lines as they are compared, but for spaces at their ends: A-Z in lower case, digits all alike, white space as spaces, common
    marks left out."""
    zeros, gaps = "0" * len(DIGITS), " " * len(SPACES)
    return F.translate(text, UPPER + DIGITS + SPACES + MARKS, LOWER + zeros + gaps)


def normal(line: Column) -> Column:
    return F.trim(plain(line))


def majority(total: Callable[[int], Column], count: Column, width: int) -> Column:
    """A bit for each place where more than half of `count` 64-bit hashes have one.

    Sums are kept side by side in lanes of `width` bits: `total(k)` counts the bits k, k + width, k + 2 width and so on. The
    lanes of a sum are compared at once: with room for a carry, adding 2 ** width - (half + 1) carries where more than
    half have the bit. Counts stay below half a lane's range, so no sum touches the sign.
    """
    wide = _repeated(1, 2 * width)
    lane = _repeated((1 << width) - 1, 2 * width)
    lift = (F.lit(1 << width) - (F.floor(count / 2) + 1)) * F.lit(wide)
    out = F.lit(0).cast("long")
    for k in range(width):
        for odd in (0, 1):
            part = F.shiftrightunsigned(total(k), width * odd).bitwiseAND(F.lit(lane)) + lift
            set_bits = F.shiftrightunsigned(part, width).bitwiseAND(F.lit(wide))
            out = out.bitwiseOR(F.shiftleft(set_bits, k + width * odd))
    return out


def lanes(h: Column, bit: int, width: int) -> Column:
    return F.shiftright(h, bit).bitwiseAND(F.lit(_signed(_repeated(1, width))))


def array_simhash(hashes: Column) -> Column:
    """SimHash of an array of hashes, of any length; slower than the sums of `line_rows`."""

    def total(bit: int) -> Column:
        return F.aggregate(hashes, F.lit(0).cast("long"), lambda sum_, h: sum_ + lanes(h, bit, 32))

    return majority(total, F.size(hashes), 32)


def line_rows(docs: DataFrame) -> DataFrame:
    """(doc_id, text_hash, line_no, key, key2, chars, print): the lines of all rows that have words, from 0, with a 128-bit
    hash, the characters and the SimHash of their normal text. Each different word counts once, so that frequent words don't
    make all long lines alike.

    The words are rows of their own while they are counted, which keeps all in compiled code: a line's words meet in
    sixteen sums before the shuffle. Very long lines, whose counts could overflow these, are summed as arrays.
    """
    about = ("row", "doc_id", "text_hash", "line_no", "key", "key2", "chars")

    def lines_of(some: DataFrame) -> DataFrame:
        rows = some.select("doc_id", F.xxhash64("text").alias("text_hash"), F.posexplode(F.split(plain(F.col("text")), "\n")).alias("line_no", "line"))
        rows = rows.select("doc_id", "text_hash", "line_no", F.trim("line").alias("line")).where(F.col("line") != "")
        return rows.select(
            F.monotonically_increasing_id().alias("row"),
            "doc_id",
            "text_hash",
            "line_no",
            F.xxhash64("line").alias("key"),
            F.xxhash64(F.lit(1), "line").alias("key2"),
            F.length("line").alias("chars"),
            F.array_distinct(F.split("line", " ")).alias("words"),
        )

    words = lines_of(docs).where(F.col("chars") < LONG_CHARS).select(*about, F.explode("words").alias("word"))
    words = words.where(F.col("word") != "").select(*about, F.xxhash64("word").alias("h"))
    sums = [F.sum(lanes(F.col("h"), k, LANE)).alias(f"s{k}") for k in range(LANE)]
    # The other columns are the same on all rows of a line; as sums' neighbours they keep the key one number.
    same = [F.max(c).alias(c) for c in about[1:]]
    counted = words.groupBy("row").agg(F.count("*").alias("n"), *same, *sums)
    short = counted.select(*about[1:], majority(lambda k: F.col(f"s{k}"), F.col("n"), LANE).alias("print"))
    lines = lines_of(docs.where(F.length("text") >= LONG_CHARS))
    hashes = F.transform(F.filter("words", lambda w: w != ""), lambda w: F.xxhash64(w))
    long = lines.where(F.col("chars") >= LONG_CHARS).select(*about[1:], hashes.alias("hashes"))
    return short.unionByName(long.select(*about[1:], array_simhash(F.col("hashes")).alias("print")))


def _small(df: DataFrame, rows: int) -> DataFrame:
    """Sent to every task if it has at most BROADCAST_ROWS rows, of some 100 bytes; else joined by a shuffle."""
    return F.broadcast(df) if rows <= BROADCAST_ROWS else df


def close_prints(prints: DataFrame) -> DataFrame:
    """(a, b): all pairs a < b of the distinct `print`s that differ in at most DISTANCE bits, perhaps repeated. Such a pair
    agrees in BLOCKS - DISTANCE blocks at least; it meets under the masks that keep only such blocks."""
    cuts = [round(i * BITS / BLOCKS) for i in range(BLOCKS + 1)]
    blocks = [(1 << b) - (1 << a) for a, b in zip(cuts, cuts[1:], strict=False)]
    masks = F.array(*[F.lit(_signed(sum(kept))) for kept in combinations(blocks, BLOCKS - DISTANCE)])
    rows = prints.select("print", F.explode(F.sequence(F.lit(1), F.size(masks))).alias("mask"))
    left = rows.select(F.col("print").alias("a"), F.col("mask").alias("a_mask"))
    right = rows.select(F.col("print").alias("b"), F.col("mask").alias("b_mask"))
    # The block is part of the join's keys only, so that it is not shuffled beside the fingerprint it comes from.
    block = F.col("a").bitwiseAND(F.element_at(masks, F.col("a_mask"))) == F.col("b").bitwiseAND(F.element_at(masks, F.col("b_mask")))
    near = (F.col("a") < F.col("b")) & (F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= DISTANCE)
    # Few enough rows in a partition are hashed; more are sorted, which needs no memory for them.
    partitions = int(prints.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    if prints.count() * comb(BLOCKS, DISTANCE) <= HASHED_ROWS * partitions:
        right = right.hint("shuffle_hash")
    return left.join(right, (F.col("a_mask") == F.col("b_mask")) & block & near).select("a", "b")


def _fits(a: str, b: str) -> Column:
    """Whether lengths allow the similarity."""
    return F.least(a, b) >= F.floor(F.greatest(a, b) * SIMILARITY)


def first_pairs(classes: DataFrame, near: DataFrame) -> DataFrame:
    """(a, b): each class with the first one of its fingerprint, and that with the first one of the least near fingerprint."""
    heads = classes.groupBy("print").agg(F.min(F.struct("class_no", "chars")).alias("head"))
    own = classes.join(heads.withColumnRenamed("print", "of"), F.col("print") == F.col("of"))
    within = own.select(F.col("head.class_no").alias("a"), F.col("class_no").alias("b"), F.col("head.chars").alias("a_chars"), "chars")
    least = near.groupBy("b").agg(F.min("a").alias("a"))
    for side in ("a", "b"):
        least = least.join(heads.select(F.col("print").alias(side), F.col("head").alias(f"{side}_head")), side)
    across = least.select(
        F.col("a_head.class_no").alias("a"), F.col("b_head.class_no").alias("b"), F.col("a_head.chars").alias("a_chars"), F.col("b_head.chars").alias("chars")
    )
    return within.where("a <> b").unionByName(across).where(_fits("a_chars", "chars")).select("a", "b")


def other_pairs(classes: DataFrame, near: DataFrame, groups: DataFrame, one_each: bool) -> DataFrame:
    """(a, b): the pairs of classes with one or near fingerprints that are not in one group yet, a < b. With `one_each`, of
    the classes of one fingerprint and group only the first takes part."""
    known = classes.join(groups, classes["class_no"] == groups["node"], "left")
    known = known.select("print", "class_no", "chars", F.coalesce("root", "class_no").alias("root"))
    if one_each:
        known = known.groupBy("print", "root").agg(F.min(F.struct("class_no", "chars")).alias("head"))
        known = known.select("print", "head.class_no", "head.chars", "root")
    # Fingerprints of which all classes are in one group are left out as a whole.
    spans = known.groupBy("print").agg(F.min("root").alias("low"), F.max("root").alias("high"))
    mixed = spans.where("low <> high").select(F.col("print").alias("a"), F.col("print").alias("b"))
    low, high = spans.select(F.col("print").alias("a"), F.col("low").alias("a_low"), F.col("high").alias("a_high")), spans.select(
        F.col("print").alias("b"), F.col("low").alias("b_low"), F.col("high").alias("b_high")
    )
    open_near = near.join(low, "a").join(high, "b").where("least(a_low, b_low) <> greatest(a_high, b_high)").select("a", "b")
    left = known.select(F.col("print").alias("a"), F.col("class_no").alias("a_no"), F.col("chars").alias("a_chars"), F.col("root").alias("a_root"))
    right = known.select(F.col("print").alias("b"), F.col("class_no").alias("b_no"), F.col("chars").alias("b_chars"), F.col("root").alias("b_root"))
    pairs = open_near.unionByName(mixed).join(left, "a")
    meet = (pairs["b"] == right["b"]) & (F.col("a_root") != F.col("b_root")) & _fits("a_chars", "b_chars")
    pairs = pairs.join(right, meet)
    return pairs.select(F.least("a_no", "b_no").alias("a"), F.greatest("a_no", "b_no").alias("b")).distinct()


def texts_of(docs: DataFrame, classes: DataFrame, pairs: DataFrame) -> DataFrame:
    """(class_no, line): the normal texts of the lines in some pair, read again, each from its first document."""
    wanted = pairs.select(F.explode(F.array("a", "b")).alias("class_no")).distinct().join(classes, "class_no")
    wanted = wanted.select("class_no", F.col("first.doc_id").alias("at_id"), F.col("first.text_hash").alias("at_hash"), F.col("first.line_no").alias("at_line"))
    rows = docs.select("doc_id", "text", F.xxhash64("text").alias("text_hash"))
    same = F.col("doc_id").eqNullSafe(F.col("at_id")) & (F.col("text_hash") == F.col("at_hash"))
    line = F.element_at(F.split("text", "\n"), F.col("at_line") + 1)
    found = rows.join(_small(wanted, wanted.count()), same).select("class_no", normal(line).alias("line"))
    # Repeated rows of a document give the same line again.
    return found.dropDuplicates(["class_no"])


def similar(pairs: DataFrame, texts: DataFrame) -> DataFrame:
    """(a, b, similar): whether the texts of a pair of class_no have an edit similarity of SIMILARITY or more. A column, not a
    filter, which Spark would work out again for every use of what it is made of."""
    for side in ("a", "b"):
        pairs = pairs.join(texts.select(F.col("class_no").alias(side), F.col("line").alias(f"{side}_line")), side)
    edits = F.floor(F.greatest(F.length("a_line"), F.length("b_line")) * (1 - SIMILARITY) + 1e-9).cast("int")
    words = pairs.select("a", "b", "a_line", "b_line", edits.alias("edits"), F.split("a_line", " ").alias("x"), F.split("b_line", " ").alias("y"))
    # Ways to edit that are often good enough: the other line's words in place of those that differ, or all between the words
    # both lines begin and end with. What these leave open is measured.
    differ = F.zip_with("x", "y", lambda p, q: F.when(p == q, 0).otherwise(F.greatest(F.length(p), F.length(q))))
    by_words = F.when(F.size("x") == F.size("y"), F.aggregate(differ, F.lit(0), lambda total, n: total + n))
    words = words.withColumn("head", _agreeing("x", "y"))
    words = words.withColumn("tail", F.least(_agreeing(F.reverse("x"), F.reverse("y")), F.least(F.size("x"), F.size("y")) - F.col("head")))
    # What both begin and end with doesn't change the distance.
    measured = words.select("a", "b", "edits", by_words.alias("by_words"), _middle("x").alias("a_rest"), _middle("y").alias("b_rest"))
    bound = F.least("by_words", F.greatest(F.length("a_rest"), F.length("b_rest")))
    near = (bound <= F.col("edits")) | F.expr("levenshtein(a_rest, b_rest, edits) >= 0")
    return measured.select("a", "b", near.alias("similar"))


def _agreeing(x: Column | str, y: Column | str) -> Column:
    """How many words two arrays have in common from their start."""
    first = F.array_position(F.zip_with(x, y, lambda p, q: F.coalesce(p == q, F.lit(False))), False)
    return F.when(first > 0, first - 1).otherwise(F.size(x)).cast("int")


def _middle(words: str) -> Column:
    """The words between the first `head` and the last `tail`, each with a space after it."""
    middle = F.slice(words, F.col("head") + 1, F.size(words) - F.col("head") - F.col("tail"))
    return F.array_join(F.transform(middle, lambda w: F.concat(w, F.lit(" "))), "")


def line_groups(docs: DataFrame, classes: DataFrame, scratch: Scratch) -> DataFrame:
    """(node, root): connected groups of class_no by links between lines of near fingerprints.

    First each class is compared with one other of its fingerprint, or of a near one; then groups that came out of this by
    one line each; then all pairs that are not in one group yet. A pair that is in one group can't change the groups, so of
    many much alike lines most pairs are never made.
    """
    prints = scratch.save(classes.groupBy("print").agg(F.count("*").alias("n")), "prints")
    near = scratch.save(close_prints(prints.select("print")).distinct(), "near")
    # Most lines are like no other; the rest goes on.
    met = near.select(F.explode(F.array("a", "b")).alias("print")).unionByName(prints.where("n > 1").select("print"))
    classes = scratch.save(classes.join(met.distinct(), "print", "left_semi"), "met")
    groups, links = None, None
    for step in ("first", "groups", "all"):
        pairs = first_pairs(classes, near) if groups is None else other_pairs(classes, near, groups, step == "groups")
        pairs = scratch.save(pairs, f"{step}_pairs")
        if groups is not None and pairs.isEmpty():
            break
        texts = scratch.save(texts_of(docs, classes, pairs), f"{step}_texts")
        found = scratch.save(similar(pairs, texts), f"{step}_links").where("similar").select("a", "b")
        if groups is None or not found.isEmpty():
            links = found if links is None else links.unionByName(found)
            groups = connected_components(links, Scratch(docs.sparkSession, "line-groups"))
    return groups


def dropped_lines(docs: DataFrame, scratch: Scratch) -> DataFrame:
    """(doc_id, text_hash, dropped): for documents that lose lines, their numbers, ascending from 0.

    Lines are equal if their normal texts are, and link if their SimHashes differ in at most `DISTANCE` bits and these
    texts have an edit similarity (1 - edits / longer length) of `SIMILARITY` or more. Of each connected group the first
    occurrence stays, by doc_id (null first), hash of the text and line. Lines without words, so empty ones, always
    stay. Rows with one id and text are one document and lose the same lines.
    """
    lines = scratch.save(line_rows(docs), "lines")
    at = F.struct("doc_id", "text_hash", "line_no")
    classes = lines.groupBy("key", "key2").agg(
        F.min(at).alias("first"), F.count("*").alias("n"), F.min("print").alias("print"), F.min("chars").alias("chars")
    )
    classes = scratch.save(classes.withColumn("class_no", F.monotonically_increasing_id()), "classes")
    parts = line_groups(docs, classes, scratch)
    members = classes.join(parts, classes["class_no"] == parts["node"]).select("class_no", "first", "root")
    firsts = members.groupBy("root").agg(F.min("first").alias("stays"))
    members = members.join(firsts, "root").select(F.col("class_no").alias("member"), "stays")
    kept = classes.join(members, classes["class_no"] == members["member"], "left")
    kept = kept.select(F.col("key").alias("of"), F.col("key2").alias("of2"), "n", "first", F.coalesce("stays", "first").alias("stays"))
    # Lines that stand once and stay are left out before the others are looked up.
    losing = kept.where((F.col("n") > 1) | (F.col("first") != F.col("stays"))).select("of", "of2", "stays")
    gone = lines.join(losing, (F.col("key") == F.col("of")) & (F.col("key2") == F.col("of2"))).where(at != F.col("stays"))
    return scratch.save(gone.groupBy("doc_id", "text_hash").agg(F.array_sort(F.collect_set("line_no")).alias("dropped")), "dropped")


def without_repeated_lines(docs: DataFrame, scratch: Scratch) -> DataFrame:
    """All rows and columns of `docs`, with the dropped lines taken out of text, and dropped: their numbers in it before.
    Null texts stay null; a text of which all lines go is empty. A column named dropped is replaced. No rows give none."""
    dropped = dropped_lines(docs, scratch)
    rows, numbers = dropped.agg(F.count("*"), F.coalesce(F.sum(F.size("dropped")), F.lit(0))).first()
    gone = dropped.select(F.col("doc_id").alias("of_id"), F.col("text_hash").alias("of_hash"), F.col("dropped").alias("gone"))
    gone = _small(gone, rows + numbers // 16)
    rows = docs.select(F.struct(*docs.columns).alias("row"), F.xxhash64("text").alias("own_hash"))
    same = F.col("row.doc_id").eqNullSafe(F.col("of_id")) & (F.col("own_hash") == F.col("of_hash"))
    rows = rows.join(gone, same, "left")
    kept = F.filter(F.split("row.text", "\n"), lambda line, i: ~F.array_contains("gone", i))
    text = F.when(F.col("gone").isNull(), F.col("row.text")).otherwise(F.array_join(kept, "\n"))
    columns = [(text if c == "text" else F.col("row")[c]).alias(c) for c in docs.columns if c != "dropped"]
    return rows.select(*columns, F.coalesce("gone", F.array().cast("array<int>")).alias("dropped"))


def op5_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = without_repeated_lines(documents(spark, sf_dir), Scratch(spark, "line-dedup"))
    text = F.coalesce("text", F.lit(""))
    return rows.select(
        "doc_id",
        F.size("dropped").cast("long").alias("n_dropped"),
        F.array_join(F.transform("dropped", lambda n: n.cast("string")), ",").alias("dropped"),
        F.length(text).cast("long").alias("n_chars_kept"),
        F.sha2(text, 256).alias("text_sha256"),
    )
