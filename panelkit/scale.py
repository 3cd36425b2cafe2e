"""Helpers that keep joins, ranks and lineage safe when keys are skewed and data is large."""

from __future__ import annotations

import atexit
import re
import tempfile
import uuid
import weakref

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Most bytes, as JSON text, of a table that is sent to every executor.
BROADCAST_BYTES = 4 << 20
#: Rows of one key that a task can take; a key with more is split.
ROWS_PER_PART = 200_000

_written: list[tuple[weakref.ref, str]] = []


def ensure_checkpoint_dir(spark: SparkSession) -> None:
    """Use the folder the cluster names; only a local session without one gets its own."""
    sc = spark.sparkContext
    if sc.getCheckpointDir():
        return
    named = sc.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None)
    if not named:
        if not sc.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
        named = tempfile.mkdtemp(prefix="panelkit-checkpoint-")
    sc.setCheckpointDir(named)


def checkpoint(df: DataFrame) -> DataFrame:
    """Write ``df`` as a table in the shared checkpoint folder and read it from there.

    The plan starts afresh at the written table, so a lost executor costs a re-read only, later steps
    read just the columns they need, and the known size lets small tables be broadcast.
    """
    spark = df.sparkSession
    path = scratch(spark, "table")
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def scratch(spark: SparkSession, name: str) -> str:
    """A new folder name in the shared checkpoint folder; ``release`` deletes what is written there."""
    ensure_checkpoint_dir(spark)
    path = f"{spark.sparkContext.getCheckpointDir()}/{name}-{uuid.uuid4().hex}"
    _written.append((weakref.ref(spark), path))
    return path


def release(spark: SparkSession) -> int:
    """Delete the tables that ``checkpoint`` wrote for this session; results still to be read must be gone or kept.

    It also runs when the driver ends, so a finished job leaves nothing in the shared folder.
    """
    gone = 0
    for entry in [e for e in _written if e[0]() is spark]:
        path = spark._jvm.org.apache.hadoop.fs.Path(entry[1])
        gone += path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
        _written.remove(entry)
    return gone


@atexit.register
def _release_all() -> None:
    for ref, _ in list(_written):
        spark = ref()
        try:
            if spark is not None and not spark.sparkContext._jsc.sc().isStopped():
                release(spark)
        except Exception:  # the driver is ending: there may be no session left to ask
            return


def cut(df: DataFrame) -> DataFrame:
    """Cut the lineage of a small table that a loop keeps extending."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def small(table: DataFrame, max_bytes: int = BROADCAST_BYTES) -> bool:
    """Whether a written table is small enough to be sent to every executor, by the bytes of its rows."""
    return (table.agg(F.sum(F.octet_length(F.to_json(F.struct("*"))))).first()[0] or 0) <= max_bytes


def is_scan(df: DataFrame) -> bool:
    """Whether ``df`` only selects from one set of files, so that its rows come in the same order in every run."""
    nodes = re.findall(r"^[\s:+-]*(\w+)", df._jdf.queryExecution().optimizedPlan().toString(), re.M)
    return bool(nodes) and {*nodes} <= {"Project", "Filter", "Relation", "RelationV2"}


def parts_for(rows: int, per_part: int = ROWS_PER_PART) -> int:
    """Parts to deal ``rows`` rows into so that the memory of one task does not grow with the table."""
    return max(1, -(-rows // per_part), min(16, rows // 25_000))


def hot_keys(df: DataFrame, on: list[str], rows_per_part: int = ROWS_PER_PART) -> DataFrame:
    """Keys with more than ``rows_per_part`` rows and the number of parts to split each into.

    NULL keys match nothing in an equi join and are never listed.
    """
    known = df.select(*on)
    for c in on:
        known = known.where(F.col(c).isNotNull())
    return (known.groupBy(*on).agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") > rows_per_part)
            .select(*on, F.ceil(F.col("_n") / rows_per_part).cast("int").alias("_parts")))


def skew_join(left: DataFrame, right: DataFrame, on: list[str], how: str = "inner",
              rows_per_part: int = ROWS_PER_PART) -> DataFrame:
    """Equi join whose hot keys on the left are split into parts; the right side repeats per part.

    ``right`` should be small per key. ``how`` is ``inner``, ``left``, ``left_semi`` or ``left_anti``. The hot
    keys stay a table, however many there are. Rows of a hot key are dealt to parts by their place, so equal rows
    part too; places must not change when a lost task runs again, so a left side that is more than a scan is
    written first. Rows with a NULL key, which match nothing, are dealt over all tasks by their values.
    """
    if how not in ("inner", "left", "left_semi", "left_anti"):
        raise ValueError(f"skew_join cannot do a {how} join")
    marks = checkpoint(hot_keys(left, on, rows_per_part))
    no_key = F.lit(False)
    for c in on:
        no_key = no_key | F.col(c).isNull()
    values = F.xxhash64(*[f.name for f in left.schema.fields if not isinstance(f.dataType, (T.MapType, T.VariantType))])
    dealt = (-1 - F.pmod(values, F.lit(4096))).cast("int")
    if marks.isEmpty():
        salted = left.withColumn("_salt", F.when(no_key, dealt).otherwise(F.lit(0)))
        return salted.join(right.withColumn("_salt", F.lit(0)), [*on, "_salt"], how).drop("_salt")
    left = left if is_scan(left) else checkpoint(left)
    place = F.monotonically_increasing_id()
    salted = (left.withColumn("_place", place).withColumn("_null", F.when(no_key, dealt)).join(marks, on, "left")
              .withColumn("_salt", F.coalesce("_null", F.pmod("_place", "_parts").cast("int"), F.lit(0)))
              .drop("_place", "_null", "_parts"))
    copies = (right.join(marks, on, "left")
              .withColumn("_salt", F.explode(F.sequence(F.lit(0), F.coalesce(F.col("_parts"), F.lit(1)) - 1)))
              .drop("_parts"))
    return salted.join(copies, [*on, "_salt"], how).drop("_salt")


def lookup_join(left: DataFrame, table: DataFrame, on: list[str], how: str = "left",
                max_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """Join a lookup table: it is written once; its written size decides between a broadcast and a skew join."""
    table = checkpoint(table)
    if small(table, max_bytes):
        return left.join(F.broadcast(table), on, how)
    return skew_join(left, table, on, how)


def global_rank(df: DataFrame, order: list[Column | str], name: str = "rank") -> DataFrame:
    """Number all rows 1..n in ``order`` without sending them through one task.

    Range partitions are sorted apart; the position inside a partition plus the row counts of the
    partitions before it is the rank. The sorted rows are checkpointed so that both uses of them
    agree. ``order`` must identify a row.
    """
    spark = df.sparkSession
    sorted_rows = checkpoint(
        df.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("_id", F.monotonically_increasing_id()))
    part = F.shiftright(F.col("_id"), 33).cast("int")
    position = F.col("_id").bitwiseAND(F.lit((1 << 33) - 1))
    sizes = sorted_rows.groupBy(part.alias("_part")).count().orderBy("_part").collect()
    offsets, before = [], 0
    for row in sizes:  # one row per range partition
        offsets.append((row["_part"], before))
        before += row["count"]
    table = spark.createDataFrame(offsets, "_part int, _before long")
    return (sorted_rows.withColumn("_part", part).join(F.broadcast(table), "_part")
            .withColumn(name, F.col("_before") + position + 1).drop("_part", "_before", "_id"))


def rank_within(df: DataFrame, groups: list[str], order: list[str], name: str = "rank") -> DataFrame:
    """``row_number`` per group for groups of any size, with the group's row count as ``<name>_of``."""
    ranked = global_rank(df, [*groups, *order], "_global")
    starts = ranked.groupBy(*groups).agg(F.min("_global").alias("_start"), F.count(F.lit(1)).alias(f"{name}_of"))
    return (lookup_join(ranked, starts, groups, "inner")
            .withColumn(name, F.col("_global") - F.col("_start") + 1).drop("_global", "_start"))


def tile(rank: Column, of: Column, k: int) -> Column:
    """The ``ntile(k)`` bucket of 1-based ``rank`` among ``of`` rows."""
    small = F.floor(of / k)
    larger = F.pmod(of, F.lit(k))
    edge = larger * (small + 1)
    return F.when(rank <= edge, F.floor((rank - 1) / (small + 1)) + 1).otherwise(
        larger + F.floor((rank - 1 - edge) / F.greatest(small, F.lit(1))) + 1).cast("int")
