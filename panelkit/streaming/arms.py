"""Running statistics of choices (arms), in batch and as a stream."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Weight of the exploration term (fixed value).
EXPLORE = 1.5


def arm_stats(events: DataFrame, arm: str, reward: Column) -> DataFrame:
    """Trials, rewards, mean and Beta parameters per arm; works on a stream as well."""
    r = reward.cast("long")
    return (events.groupBy(F.col(arm).alias("arm"))
            .agg(F.count(F.lit(1)).alias("trials"), F.sum(r).alias("rewards"))
            .withColumn("mean", F.col("rewards") / F.col("trials"))
            .withColumn("alpha", F.col("rewards") + 1)
            .withColumn("beta", F.col("trials") - F.col("rewards") + 1))


def upper_bounds(stats: DataFrame, arms: list[str] = ()) -> DataFrame:
    """Upper confidence bounds from totals by arm, the next arm to try first; an arm never tried leads."""
    if arms:
        known = stats.sparkSession.createDataFrame([(a,) for a in arms], "arm string")
        stats = known.join(stats, "arm", "left").fillna(0, ["trials", "rewards"])
    n = stats.agg(F.sum("trials")).scalar()
    bound = F.col("mean") + F.sqrt(F.try_divide(EXPLORE * F.log(n + 1), F.col("trials")))
    return (stats.select("arm", "trials", "rewards", "mean",
                         F.when(F.col("trials") > 0, bound).otherwise(F.lit(1e400)).alias("upper_bound"))
            .orderBy(F.desc("upper_bound"), "arm"))


def arm_ucb(events: DataFrame, arm: str, reward: Column, arms: list[str] = ()) -> DataFrame:
    """Upper confidence bound per arm of all events."""
    return upper_bounds(arm_stats(events, arm, reward), arms)


def arm_ucb_stream(spark: SparkSession, path: str, schema: T.StructType, arm: str, reward: Column, out: str,
                   state: str, arms: list[str] = (), files_per_batch: int | None = None) -> DataFrame:
    """Upper bounds after all files of ``path`` that have come so far, from totals that the stream keeps.

    The state store holds the totals of every arm; each batch gives all of them, whose sum is the number of
    trials so far, and the bounds of that moment are written to ``out/batch=N``. A batch that runs again after a failure
    replaces its own folder only, and a restart goes on from the state folder, so events count once. Both folders must be
    shared by all executors. The bounds of the last batch are returned.
    """
    reader = spark.readStream.schema(schema)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)

    def put(batch: DataFrame, number: int) -> None:
        upper_bounds(batch, arms).write.mode("overwrite").parquet(f"{out}/batch={number}")

    query = (arm_stats(reader.parquet(path), arm, reward).writeStream.outputMode("complete").option("checkpointLocation", state)
             .foreachBatch(put).trigger(availableNow=True).start())
    query.awaitTermination()
    every = spark.read.parquet(out)
    last = every.agg(F.max("batch")).first()[0]
    return every.where(F.col("batch") == last).drop("batch").orderBy(F.desc("upper_bound"), "arm")


def arm_stats_stream(spark: SparkSession, path: str, schema: T.StructType, arm: str, reward: Column, out: str,
                     state: str) -> DataFrame:
    """Feed all files of ``path`` through a running aggregation and read its last result.

    ``out`` and ``state`` are folders all executors share; the state folder lets a restart go on.
    """
    events = spark.readStream.schema(schema).parquet(path)
    query = (arm_stats(events, arm, reward).writeStream.outputMode("complete").option("checkpointLocation", state)
             .foreachBatch(lambda batch, _: batch.write.mode("overwrite").parquet(out))
             .trigger(availableNow=True).start())
    query.awaitTermination()
    return spark.read.parquet(out)
