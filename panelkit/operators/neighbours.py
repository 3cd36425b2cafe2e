"""Nearest neighbours at size: random-projection hash buckets with several probes, exact distances inside them."""

from __future__ import annotations

import math
import sys

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from panelkit.operators.models import KNN_BLOCK, _neighbours_of_blocks
from panelkit.scale import checkpoint, lookup_join

cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: Hash tables, buckets asked in each, rows wanted in a bucket.
TABLES, PROBES, BUCKET_ROWS = 8, 6, 256


def _codes(vectors: np.ndarray, centre: np.ndarray, planes: np.ndarray, probes: int) -> list[list[int]]:
    """Bucket codes of every vector in one table, the likeliest bucket first.

    A code has a bit for each plane. The other probes flip the planes that lie nearest to the vector: one alone
    or two together, in the order of the squared distances they cross.
    """
    side = (vectors - centre) @ planes.T
    bits = planes.shape[0]
    own = (side > 0) @ (1 << np.arange(bits, dtype=np.int64))
    near = np.argsort(np.abs(side), axis=1, kind="stable")[:, :probes]
    cost = np.take_along_axis(side ** 2, near, axis=1)
    out = []
    for row in range(len(vectors)):
        flips = [(0.0, 0)]
        for i, a in enumerate(near[row]):
            flips.append((cost[row, i], 1 << int(a)))
            flips += [(cost[row, i] + cost[row, j], (1 << int(a)) | (1 << int(near[row, j]))) for j in range(i)]
        out.append([int(own[row]) ^ f for _, f in sorted(flips)[:probes]])
    return out


def knn_hashed(train: DataFrame, test: DataFrame, key: str, features: str, label: str, k: int = 5, tables: int = TABLES,
               probes: int = PROBES, bucket_rows: int = BUCKET_ROWS, block: int = KNN_BLOCK, skip_self: bool = True,
               seed: int = 7) -> DataFrame:
    """The nearest of the training rows that share a bucket with a test row: (key, neighbour, distance, label).

    Distances are exact, the choice of rows compared is not: a true neighbour is missed if none of the ``tables`` x
    ``probes`` buckets asked holds it. A training row is kept in ``tables`` buckets and a test row asks at most
    ``tables`` x ``probes``, whatever the size; a bucket with more than ``block`` rows is cut into blocks, so
    no task holds more than a block. Rows without a vector take no part.
    """
    train, test = train.where(F.col(features).isNotNull()), test.where(F.col(features).isNotNull())
    shape = train.agg(F.count(F.lit(1)).alias("n"), F.max(F.size(features)).alias("width")).first()
    kinds = dict(train.dtypes)
    kind = f"{key} {kinds[key]}, neighbour {kinds[key]}, distance double, neighbour_label {kinds[label]}"
    if not shape["n"]:
        return train.sparkSession.createDataFrame([], kind)
    mean = train.select(F.posexplode(features).alias("i", "x")).groupBy("i").agg(F.avg("x").alias("m")).orderBy("i").collect()
    centre = np.array([r["m"] for r in mean])
    bits = min(40, max(1, math.ceil(math.log2(max(2, shape["n"] / bucket_rows)))))
    planes = np.random.default_rng(seed).normal(size=(tables, bits, len(centre)))

    def bucket(n: int):
        @F.pandas_udf("array<long>")
        def codes(v: pd.Series) -> pd.Series:
            x = np.array(v.tolist(), dtype=float).reshape(len(v), -1)
            per = [_codes(x, centre, planes[t], n) for t in range(len(planes))]
            return pd.Series([[t + len(planes) * c for t in range(len(planes)) for c in per[t][i]] for i in range(len(x))])
        return codes

    given = checkpoint(train.select(F.col(key).alias("id"), F.col(features).alias("v"), F.col(label).alias("label"),
                                    F.explode(bucket(1)(F.col(features))).alias("cell")))
    # only buckets above one block are listed
    large = (given.groupBy("cell").agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") > block)
             .select("cell", F.ceil(F.col("_n") / block).cast("int").alias("_blocks")))
    blocks = F.coalesce("_blocks", F.lit(1))
    given = lookup_join(given, large, ["cell"]).withColumn("block", F.pmod(F.xxhash64("id"), blocks).cast("int")).drop("_blocks")
    asked = (test.select(F.col(key).alias("id"), F.col(features).alias("v"), F.lit(None).cast(kinds[label]).alias("label"),
                         F.explode(bucket(probes)(F.col(features))).alias("cell")))
    asked = lookup_join(asked, large, ["cell"]).withColumn("block", F.explode(F.sequence(F.lit(0), blocks - 1))).drop("_blocks")
    lined = given.withColumn("role", F.lit(0)).unionByName(asked.withColumn("role", F.lit(1)))
    found = (lined.repartition("cell", "block").sortWithinPartitions("cell", "block", "role")
             .mapInPandas(_neighbours_of_blocks(k, skip_self, [key, "neighbour", "distance", "neighbour_label"]), kind))
    # a neighbour may be met in several tables
    once = found.groupBy(key, "neighbour").agg(F.min("distance").alias("distance"), F.min("neighbour_label").alias("neighbour_label"))
    rank = W.partitionBy(key).orderBy("distance", "neighbour")
    return once.withColumn("_r", F.row_number().over(rank)).where(F.col("_r") <= k).drop("_r")
