"""Errors that wrap other errors: the server's number inside, and whether a new try is worth it."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lodestone.functions.source import error_class
from lodestone.session import shared_folder

# A check that outran its time: the source has said nothing yet, so it is asked again.
TIMEOUT, DEFINITIVE = "timeout", "definitive"


def root_numbers(errors: DataFrame) -> DataFrame:
    """(error_id, number): for each error with an id, the first server number on its chain, or null.

    `errors` has error_id, orig_id and cause_id (the driver's error it holds, and the one it was raised from; the first goes
    before) and number. Chains may be of any depth, share their ends, end at an id that is not there, or run in circles. Each
    round every open error takes over what the error it points at has found, and then points where that one points, so depth
    doubles; an error still open when that exceeds the number of errors is on a way into a circle without a number. Of several
    rows of one id that with the largest number counts. Rounds are written, so a lost executor repeats one at most.
    """
    spark = errors.sparkSession
    folder = shared_folder(spark, "failures")

    def saved(df: DataFrame, name: str) -> DataFrame:
        df.write.parquet(f"{folder}/{name}")
        return spark.read.schema(df.schema).parquet(f"{folder}/{name}")

    one = errors.where("error_id is not null").groupBy("error_id").agg(
        F.max(F.struct("number", F.coalesce("orig_id", "cause_id").alias("next"))).alias("best")
    )
    number = F.col("best.number")
    start = one.select("error_id", number.alias("number"), F.when(number.isNull(), F.col("best.next")).alias("at"))
    state = saved(start, "0")
    rounds = math.ceil(math.log2(state.count() + 1)) + 1
    for k in range(rounds):
        is_open = F.col("number").isNull() & F.col("at").isNotNull()
        waiting = state.where(is_open)
        if waiting.isEmpty():
            break
        found = state.select(F.col("error_id").alias("at"), F.col("number").alias("theirs"), F.col("at").alias("onward"))
        # Many errors may wrap one: the join's other side has one row of each id, so Spark can split that key.
        jumped = waiting.select("error_id", "at").join(found, "at", "left").select(
            "error_id", F.col("theirs").alias("number"), F.when(F.col("theirs").isNull(), F.col("onward")).alias("at")
        )
        state = saved(state.where(~is_open).unionByName(jumped), str(k + 1))
    return state.select("error_id", "number")


def classified(errors: DataFrame) -> DataFrame:
    """`errors` (as for `root_numbers`, with is_timeout) with errno, the number found on the chain, error_class and retryable.

    Only an error that is itself a timeout is one; one that wraps a timeout is judged by its chain. A null is_timeout is false; an
    error without an id has its own number only.
    """
    found = root_numbers(errors).withColumnRenamed("number", "inner_number")
    own = errors.join(found, "error_id", "left").withColumn("errno", F.coalesce("number", "inner_number"))
    kind = F.when(F.col("is_timeout"), TIMEOUT).otherwise(error_class(F.col("errno")))
    return own.drop("inner_number").withColumn("error_class", kind).withColumn("retryable", kind != DEFINITIVE)
