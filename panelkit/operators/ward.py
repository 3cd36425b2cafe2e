"""Ward clustering of any number of rows through mergeable cluster features."""

from __future__ import annotations

import sys
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelkit.scale import checkpoint

cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: Cluster features kept by a task and for the whole; tables of features merged by one task.
SUMMARIES, FAN_IN = 512, 16


def _distances(n: np.ndarray, mean: np.ndarray, rows: slice) -> np.ndarray:
    """Growth of the squared error if the clusters of ``rows`` were merged with each other one."""
    a, b = mean[rows], mean
    square = np.maximum(0.0, (a ** 2).sum(1)[:, None] + (b ** 2).sum(1)[None, :] - 2 * a @ b.T)
    return n[rows][:, None] * n[None, :] / (n[rows][:, None] + n[None, :]) * square


def condense(n: np.ndarray, total: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray]:
    """Cluster features (count, sum) merged until at most ``most`` are left.

    Each round joins pairs that are each other's nearest by Ward's distance, the closest first; such pairs can be
    merged independently of one another.
    """
    while len(n) > most:
        mean = total / n[:, None]
        nearest, gap = np.empty(len(n), int), np.empty(len(n))
        for at in range(0, len(n), 256):
            d = _distances(n, mean, slice(at, at + 256))
            d[np.arange(len(d)), np.arange(at, at + len(d))] = np.inf
            nearest[at:at + 256] = d.argmin(1)
            gap[at:at + 256] = d[np.arange(len(d)), nearest[at:at + 256]]
        i = np.flatnonzero((nearest[nearest] == np.arange(len(n))) & (np.arange(len(n)) < nearest))
        if not len(i):  # equal distances in a ring: the closest pair is merged
            i = np.array([gap.argmin()])
        i = i[np.argsort(gap[i], kind="stable")][:len(n) - most]
        j = nearest[i]
        n, total = n.copy(), total.copy()
        n[i] += n[j]
        total[i] += total[j]
        left = np.ones(len(n), bool)
        left[j] = False
        n, total = n[left], total[left]
    return n, total


def linkage(n: np.ndarray, total: np.ndarray, k: int) -> np.ndarray:
    """Group 0..k-1 of each cluster feature by plain Ward linkage, groups numbered by their size, then their centre."""
    group, sizes, sums = np.arange(len(n)), n.astype(float).copy(), total.astype(float).copy()
    live = list(range(len(n)))
    if len(live) > k:
        d = _distances(sizes, sums / sizes[:, None], slice(0, len(n)))
        np.fill_diagonal(d, np.inf)
    while len(live) > k:
        sub = d[np.ix_(live, live)]
        a, b = divmod(int(sub.argmin()), len(live))
        i, j = sorted((live[a], live[b]))
        group[group == j] = i
        sizes[i] += sizes[j]
        sums[i] += sums[j]
        live.remove(j)
        mean = sums[live] / sizes[live][:, None]
        at = live.index(i)
        row = _distances(sizes[live], mean, slice(at, at + 1))[0]
        row[at] = np.inf
        d[i, live] = d[live, i] = row
    order = sorted(live, key=lambda g: (-sizes[g], *(sums[g] / sizes[g])))
    names = {g: x for x, g in enumerate(order)}
    return np.array([names[g] for g in group], dtype=int)


def features(df: DataFrame, vector: str, most: int = SUMMARIES, fan_in: int = FAN_IN) -> DataFrame:
    """At most ``most`` cluster features (n, total) of all rows: each task condenses its rows, then tasks merge in a tree.

    Up to ``most`` rows, a feature is a row.
    """
    kind = "part int, n long, total array<double>"

    def table(n: np.ndarray, total: np.ndarray, part: int) -> pd.DataFrame:
        return pd.DataFrame({"part": np.full(len(n), part, dtype="int32"), "n": n.astype("int64"), "total": list(total)})

    def own(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        from pyspark import TaskContext

        n, total = np.zeros(0), None
        for batch in batches:
            x = np.array(batch["v"].tolist(), dtype=float)
            for at in range(0, len(x), 4 * most):
                part = x[at:at + 4 * most]
                n = np.concatenate([n, np.ones(len(part))])
                total = part if total is None else np.concatenate([total, part])
                n, total = condense(n, total, most)
        if total is not None:
            yield table(n, total, TaskContext.get().partitionId())

    def merge(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values(["part", "n"], kind="stable")
        return table(*condense(rows["n"].to_numpy(dtype=float), np.array(rows["total"].tolist(), dtype=float), most), key[0])

    rows = df.where(F.col(vector).isNotNull()).select(F.col(vector).alias("v"))
    now = checkpoint(rows.mapInPandas(own, kind))
    parts = now.agg(F.max("part")).first()[0]
    while parts:
        now = checkpoint(now.groupBy(F.floor(F.col("part") / fan_in).cast("int").alias("_p")).applyInPandas(merge, kind))
        parts = parts // fan_in
    return now.drop("part")


def ward(df: DataFrame, vector: str, k: int = 5, most: int = SUMMARIES, name: str = "group") -> DataFrame:
    """Rows with their Ward group 0..k-1 (the largest is 0); a row belongs to the group of its nearest cluster feature.

    Up to ``most`` rows this is plain Ward linkage; beyond, features that agree closely are merged first, in tasks.
    Only the ``most`` features reach the driver. Rows without a vector have no group.
    """
    found = features(df, vector, most).collect()
    if not found:
        return df.withColumn(name, F.lit(None).cast("int"))
    found = sorted(((r["n"], tuple(r["total"])) for r in found), key=lambda r: (r[1], r[0]))
    n, total = np.array([r[0] for r in found], dtype=float), np.array([r[1] for r in found], dtype=float)
    centre, group = total / n[:, None], linkage(n, total, k)

    @F.pandas_udf("int")
    def of(v: pd.Series) -> pd.Series:
        out = pd.Series([None] * len(v), dtype="Int32")
        known = v.notna().to_numpy()
        if known.any():
            x = np.array(v[known].tolist(), dtype=float)
            near = np.concatenate([((x[a:a + 1024, None, :] - centre[None, :, :]) ** 2).sum(2).argmin(1) if centre.shape[1] * len(centre) < 200_000
                                   else ((centre ** 2).sum(1)[None, :] - 2 * x[a:a + 1024] @ centre.T).argmin(1) for a in range(0, len(x), 1024)])
            out[known] = group[near].astype("int32")
        return out

    return df.withColumn(name, of(F.col(vector)))
