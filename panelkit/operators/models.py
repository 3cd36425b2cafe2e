"""Models: thin pipelines around Spark ML."""

from __future__ import annotations

import math
import sys
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.ml import Estimator, Pipeline, PipelineModel
from pyspark.ml import classification as C
from pyspark.ml import clustering as K
from pyspark.ml import regression as R
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.ml.feature import (PCA, PolynomialExpansion, SQLTransformer, StandardScaler, StandardScalerModel,
                                StringIndexer, VectorAssembler)
from pyspark.ml.stat import Correlation, Summarizer
from pyspark.ml.tuning import CrossValidator, ParamGridBuilder
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from panelkit.functions.vectors import vector_at
from panelkit.operators import trees
from panelkit.operators.rows import cap_sample, split_train_test
from panelkit.operators.select import correlated_columns
from panelkit.scale import checkpoint, rank_within


def mean_fill(df: DataFrame, cols: list[str]) -> tuple[SQLTransformer | None, list[str]]:
    """A pipeline step that fills missing numbers with the column's mean, and the names of the filled columns.

    The means are those of ``df``, 0 for a column without a value. Vector columns must be complete. Rows are never
    dropped, neither in fitting nor in scoring.
    """
    kinds = dict(df.dtypes)
    plain = [c for c in cols if not kinds[c].startswith(("vector", "struct", "array"))]
    if not plain:
        return None, list(cols)
    known = lambda c: F.nullif(F.col(c).cast("double"), F.lit(float("nan")))
    means = df.agg(*[F.coalesce(F.avg(known(c)), F.lit(0.0)).alias(c) for c in plain]).first()
    filled = [f"coalesce(nullif(cast(`{c}` as double), double('NaN')), double('{means[c]!r}')) as `_filled_{c}`" for c in plain]
    step = SQLTransformer(statement=f"SELECT *, {', '.join(filled)} FROM __THIS__")
    return step, [f"_filled_{c}" if c in plain else c for c in cols]


def _inputs(df: DataFrame, cols: list[str]) -> list:
    """Pipeline steps from columns to ``features``."""
    step, names = mean_fill(df, cols)
    return [*([step] if step else []), VectorAssembler(inputCols=names, outputCol="features", handleInvalid="error")]


def _features(df: DataFrame, cols: list[str]) -> DataFrame:
    for step in _inputs(df, cols):
        df = step.transform(df)
    return df


def fit(df: DataFrame, cols: list[str], estimator: Estimator, scale: bool = False, degree: int = 1) -> PipelineModel:
    """Fill, assemble (expand, scale) and fit; rows without a label do not train."""
    if estimator.hasParam("labelCol") and estimator.getOrDefault("labelCol") in df.columns:
        df = df.where(F.col(estimator.getOrDefault("labelCol")).isNotNull())
    stages: list = _inputs(df, cols)
    source = "features"
    if degree > 1:
        stages.append(PolynomialExpansion(degree=degree, inputCol=source, outputCol="expanded"))
        source = "expanded"
    if scale:
        stages.append(StandardScaler(inputCol=source, outputCol="scaled", withMean=True, withStd=True))
        source = "scaled"
    return Pipeline(stages=[*stages, estimator.copy({estimator.featuresCol: source})]).fit(df)


def logistic_fit(df: DataFrame, label: str, cols: list[str], reg: float = 0.0) -> PipelineModel:
    return fit(df, cols, C.LogisticRegression(labelCol=label, regParam=reg), scale=True)


def coefficient_table(model: PipelineModel, cols: list[str]) -> DataFrame:
    """Intercept and weights of a linear model, in the units of the columns."""
    last = model.stages[-1]
    weights, intercept = last.coefficients.toArray(), float(last.intercept)
    for step in model.stages:
        if isinstance(step, StandardScalerModel):
            sd = step.std.toArray()
            weights = np.divide(weights, sd, out=np.zeros_like(weights), where=sd > 0)
            intercept -= float((weights * step.mean.toArray()).sum())
    rows = [("intercept", intercept)] + list(zip(cols, map(float, weights)))
    return SparkSession.active().createDataFrame(rows, "term string, coefficient double")


def score_table(model: PipelineModel, df: DataFrame, keys: list[str], label: str) -> DataFrame:
    """Keys, label, probability of class 1 and prediction."""
    return model.transform(df).select(*keys, label, vector_at("probability", 1).alias("score"), "prediction")


def tree_fit(df: DataFrame, label: str, cols: list[str], kind: str, seed: int = 7, trees: int = 10,
             rounds: int = 100) -> PipelineModel:
    """``kind``: tree, forest, boosted, tree_regression, forest_regression or boosted_regression."""
    made = {
        "tree": lambda: C.DecisionTreeClassifier(labelCol=label, seed=seed),
        "forest": lambda: C.RandomForestClassifier(labelCol=label, numTrees=trees, seed=seed),
        "boosted": lambda: C.GBTClassifier(labelCol=label, maxIter=rounds, seed=seed),
        "tree_regression": lambda: R.DecisionTreeRegressor(labelCol=label, seed=seed),
        "forest_regression": lambda: R.RandomForestRegressor(labelCol=label, numTrees=trees, seed=seed),
        "boosted_regression": lambda: R.GBTRegressor(labelCol=label, maxIter=rounds, seed=seed),
    }[kind]()
    return fit(df, cols, made)


def svm_fit(df: DataFrame, label: str, cols: list[str], rounds: int = 100) -> PipelineModel:
    return fit(df, cols, C.LinearSVC(labelCol=label, maxIter=rounds), scale=True)


def bayes_fit(df: DataFrame, label: str, cols: list[str]) -> PipelineModel:
    return fit(df, cols, C.NaiveBayes(labelCol=label, modelType="gaussian"))


def mlp_fit(df: DataFrame, label: str, cols: list[str], hidden=(6, 6), classes: int = 2, seed: int = 7,
            width: int | None = None, rounds: int = 100) -> PipelineModel:
    """Two-layer perceptron; ``width`` is the number of inputs when a column is a vector."""
    net = C.MultilayerPerceptronClassifier(labelCol=label, layers=[width or len(cols), *hidden, classes], seed=seed,
                                           maxIter=rounds)
    return fit(df, cols, net, scale=True)


def train_test(rows: DataFrame, label: str, cols: list[str], key: str, reg: float = 0.0, test_share: float = 0.25,
               max_corr: float = 0.7) -> tuple[PipelineModel, list[str], DataFrame]:
    """The usual model flow: split by key, drop correlated columns, fit on the training part, score both parts.

    Returns the model, the columns it uses, and key, label, score, prediction and ``part`` (train or test) of every row.
    """
    parted = checkpoint(split_train_test(rows, key, test_share))
    train = parted.where("is_test = 0")
    gone = set(correlated_columns(train, cols, max_corr))
    kept = [c for c in cols if c not in gone]
    model = logistic_fit(train, label, kept, reg)
    part = F.when(F.col("is_test") == 1, "test").otherwise("train").alias("part")
    scored = model.transform(parted).select(key, label, vector_at("probability", 1).alias("score"), "prediction", part)
    return model, kept, scored


def linear_fit(df: DataFrame, y: str, cols: list[str], degree: int = 1) -> PipelineModel:
    """Linear, multiple or polynomial regression."""
    return fit(df, cols, R.LinearRegression(labelCol=y, solver="auto"), degree=degree)


def ols(df: DataFrame, y: str, x: str, by: list[str] = ()) -> DataFrame:
    """Simple regression per group from running sums: slope, intercept and r2."""
    yy, xx = F.col(y).cast("double"), F.col(x).cast("double")
    return df.groupBy(*by).agg(F.regr_slope(yy, xx).alias("slope"), F.regr_intercept(yy, xx).alias("intercept"),
                               F.regr_r2(yy, xx).alias("r2"), F.regr_count(yy, xx).alias("n"))


def kmeans_curve(df: DataFrame, cols: list[str], ks=range(1, 11), seed: int = 7) -> DataFrame:
    """Within-cluster cost per number of clusters."""
    rows = _features(df.select(*cols), cols).select("features").persist()
    try:
        cost = [(k, float(K.KMeans(k=k, seed=seed).fit(rows).summary.trainingCost) if k > 1 else _single_cost(rows))
                for k in ks]
    finally:
        rows.unpersist()
    return df.sparkSession.createDataFrame(cost, "k int, cost double")


def _single_cost(rows: DataFrame) -> float:
    """Cost of one cluster: the summed squared distance to the mean."""
    r = rows.agg(Summarizer.variance(F.col("features")).alias("v"), F.count(F.lit(1)).alias("n")).first()
    return float(r["v"].toArray().sum() * (r["n"] - 1))


def kmeans_fit(df: DataFrame, cols: list[str], k: int = 5, seed: int = 7) -> PipelineModel:
    return fit(df, cols, K.KMeans(k=k, seed=seed))


def bisecting_fit(df: DataFrame, cols: list[str], k: int = 5, seed: int = 7) -> PipelineModel:
    return fit(df, cols, K.BisectingKMeans(k=k, seed=seed))


def pca_fit(df: DataFrame, cols: list[str], k: int = 2) -> PipelineModel:
    """Scaled principal components; ``explained_variance`` tells the share of each."""
    stages = [*_inputs(df, cols), StandardScaler(inputCol="features", outputCol="scaled", withMean=True),
              PCA(k=k, inputCol="scaled", outputCol="components")]
    return Pipeline(stages=stages).fit(df)


def explained_variance(model: PipelineModel) -> list[float]:
    """Share of the variance of all scaled columns that each principal component holds, the largest first."""
    return [float(x) for x in model.stages[-1].explainedVariance.toArray()]


def lda_axes(df: DataFrame, label: str, cols: list[str], k: int = 2) -> np.ndarray:
    """Discriminant directions: only class means and the feature covariance reach the driver."""
    rows = _features(df, cols)
    per = rows.groupBy(label).agg(Summarizer.mean(F.col("features")).alias("m"), F.count(F.lit(1)).alias("n")).collect()
    sd = np.sqrt(rows.agg(Summarizer.variance(F.col("features"))).first()[0].toArray())
    n = sum(r["n"] for r in per)
    corr = np.nan_to_num(Correlation.corr(rows, "features").first()[0].toArray())
    total = corr * np.outer(sd, sd) * (n - 1)
    means = np.array([r["m"].toArray() for r in per])
    sizes = np.array([r["n"] for r in per], dtype=float)
    centre = (means * sizes[:, None]).sum(axis=0) / n
    between = ((means - centre).T * sizes) @ (means - centre)
    values, axes = np.linalg.eig(np.linalg.pinv(total - between) @ between)
    order = np.argsort(-values.real)[:k]
    return axes.real[:, order]


def lda_fit(df: DataFrame, label: str, cols: list[str], k: int = 2) -> DataFrame:
    """Rows projected on the discriminant directions ``ld1``..``ldk``."""
    axes = lda_axes(df.where(F.col(label).isNotNull()), label, cols, k)
    step, names = mean_fill(df, cols)

    def direction(j: int) -> Column:
        parts = [F.col(c) * float(axes[i, j]) for i, c in enumerate(names)]
        return sum(parts[1:], parts[0])

    out = step.transform(df).withColumns({f"ld{j + 1}": direction(j) for j in range(axes.shape[1])})
    return out.drop(*names)


def stratified_folds(df: DataFrame, label: str, key: str, folds: int = 10, name: str = "fold", seed: int = 7) -> DataFrame:
    """Adds a fold number 0..folds-1: every class is dealt out evenly, its folds differ by one row at most.

    Rows are ranked inside their class by a hash of ``key``, which must identify a row; the rank is distributed
    and does not depend on how the rows are stored.
    """
    hashed = df.withColumn("_h", F.xxhash64(F.col(key), F.lit(seed)))
    return (rank_within(hashed, [label], ["_h", key], "_r").withColumn(name, F.pmod(F.col("_r") - 1, F.lit(folds)).cast("int"))
            .drop("_h", "_r", "_r_of"))


def cross_validate(pipeline: Estimator, df: DataFrame, label: str, folds: int = 10, grid: dict | None = None,
                   seed: int = 7, key: str | None = None) -> DataFrame:
    """Mean and deviation of the area under the curve per grid point; with ``key``, over stratified folds."""
    builder = ParamGridBuilder()
    for param, values in (grid or {}).items():
        builder = builder.addGrid(param, values)
    if key is not None:
        df = checkpoint(stratified_folds(df, label, key, folds, "_fold", seed))
    cross = CrossValidator(estimator=pipeline, estimatorParamMaps=builder.build(), numFolds=folds, seed=seed,
                           evaluator=BinaryClassificationEvaluator(labelCol=label), parallelism=4)
    model = (cross if key is None else cross.setFoldCol("_fold")).fit(df)
    rows = [(i, float(m), float(s)) for i, (m, s) in enumerate(zip(model.avgMetrics, model.stdMetrics))]
    return df.sparkSession.createDataFrame(rows, "grid_point int, mean double, sd double")


def classify(df: DataFrame, label: str, cols: list[str], estimator: Estimator, is_test: Column) -> DataFrame:
    """Split, scale, fit on the training part, predict the test part."""
    model = fit(df.where(~is_test), cols, estimator, scale=True)
    return model.transform(df.where(is_test))


def evaluate(predicted: DataFrame, label: str) -> DataFrame:
    """Counts of each (label, prediction) pair with the share of right predictions over all rows."""
    cells = predicted.groupBy(F.col(label).cast("int").alias("label"), F.col("prediction").cast("int").alias("prediction")).agg(
        F.count(F.lit(1)).alias("n"))
    right = predicted.agg(F.avg((F.col(label) == F.col("prediction")).cast("double"))).scalar()
    return cells.withColumn("accuracy", right)


def segment_trees(df: DataFrame, segment: str, target: str, cols: list[str], depth: int = 4, min_rows: int = 1000,
                  max_bins: int = 32) -> trees.GroupTrees:
    """One small tree per segment, NULL a segment of its own, all of them grown in one run."""
    return trees.fit(df, [segment], target, cols, depth=depth, min_rows=min_rows, max_bins=max_bins)


def fit_micro_segments(df: DataFrame, segment: str, target: str, numbers: list[str], categories: list[str], path: str,
                       keep: int = 20, max_values: int = 4, depth: int = 4, min_rows: int = 1000, max_bins: int = 32) -> None:
    """Per segment: its small categories, its best features, a small tree; all of them are saved under ``path``.

    A category with more than ``max_values`` values in the segment is left out; a missing value is a value of its
    own. NULL is a segment too. The number of jobs does not depend on the number of segments.
    """
    trees.fit(df, [segment], target, numbers, categories, depth, min_rows, max_bins, max_values, keep).save(path)


def label_micro_segments(df: DataFrame, segment: str, model: trees.GroupTrees) -> DataFrame:
    """Adds ``micro_segment``, ``Segment_Leaf``, stable between months; rows of a segment without a tree keep NULL."""
    name = F.concat_ws("_", F.coalesce(F.col(segment).cast("string"), F.lit("none")), F.col("leaf").cast("string"))
    return model.transform(df.drop("leaf", "prediction")).withColumn("micro_segment", F.when(F.col("leaf").isNotNull(), name)).drop(
        "leaf", "prediction")


def leaf_id(model: PipelineModel, df: DataFrame, segment: Column) -> DataFrame:
    """``Segment_Leaf`` from the leaf the saved tree puts a row in, stable between months."""
    tree = model.stages[-1].copy()
    tree.setLeafCol("_leaf")
    scored = tree.transform(PipelineModel(model.stages[:-1]).transform(df))
    leaf = scored.withColumn("micro_segment", F.concat_ws("_", segment, F.col("_leaf").cast("int").cast("string")))
    return leaf.select(*df.columns, "micro_segment")


# k nearest neighbours --------------------------------------------------------------------------

# executors get the functions below by value and need not have this package installed
cloudpickle.register_pickle_by_value(sys.modules[__name__])

KNN_BLOCK = 2048
#: Blocks a task holds, rows of a slice that asks it, rows of a tile of products.
KNN_HELD, KNN_SLICE, KNN_TILE = 16, 1 << 16, 256


def _distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    out = np.empty((len(a), len(b)))
    for at in range(0, len(a), 64):
        out[at:at + 64] = np.sqrt(((a[at:at + 64, None, :] - b[None, :, :]) ** 2).sum(axis=2))
    return out


def _neighbours_of_blocks(k: int, skip_self: bool, columns: list[str]):
    """Batches sorted by cell, block and role (0 training, 1 asking) to the ``k`` best rows of the block per asker."""

    def best_of(have: pd.DataFrame, want: pd.DataFrame) -> list[tuple]:
        d = np.round(_distances(np.array(want["v"].tolist(), dtype=float), np.array(have["v"].tolist(), dtype=float)), 9)
        if skip_self:
            d[want["id"].to_numpy()[:, None] == have["id"].to_numpy()[None, :]] = np.inf
        best = np.argsort(d, axis=1, kind="stable")[:, :k]
        ids, labels = have["id"].to_numpy(), have["label"].to_numpy()
        return [(a, ids[j], x, labels[j]) for a, row, near in zip(want["id"], d, best) for j in near if np.isfinite(x := row[j])]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        at, held, have = None, [], None
        for batch in batches:
            out = []
            for place, part in batch.groupby(["cell", "block"], sort=False):
                if place != at:
                    at, held, have = place, [], None
                if (part["role"] == 0).any():
                    held.append(part[part["role"] == 0])
                    have = None
                want = part[part["role"] == 1]
                if len(want) and held:
                    have = pd.concat(held).sort_values("id") if have is None else have
                    out += best_of(have, want)
            if out:
                yield pd.DataFrame(out, columns=columns)

    return run


def _matrix(vectors: pd.Series) -> np.ndarray:
    return np.array(vectors.tolist(), dtype=float).reshape(len(vectors), -1)


def _closest(asking: np.ndarray, own: np.ndarray, bound: np.ndarray, held: np.ndarray, ids: np.ndarray, columns: np.ndarray,
             k: int, skip_self: bool, have: np.ndarray | None = None) -> np.ndarray:
    """The ``k`` nearest of the held rows ``columns`` (and of those found before) for each asking row, none beyond ``bound``.

    Returns rows (asking row, held row, distance) in the order of asking row, distance and held row. Tiles of products
    tell which pairs may be near enough, within a margin for their rounding; only those get exact distances.
    """
    found = [np.zeros((0, 3)) if have is None else have]
    held_x, width = held[columns], held.shape[1]
    squares, norms = (asking ** 2).sum(axis=1), (held_x ** 2).sum(axis=1)
    # short numbers are enough to leave pairs out, unless their squares would not fit
    kind = np.float32 if max(squares.max(initial=0), norms.max(initial=0)) < 1e30 else np.float64
    margin = 4 * (width + 8) * np.finfo(kind).eps
    left = np.concatenate([asking, np.ones((len(asking), 1))], axis=1).astype(kind)
    right = np.concatenate([-2 * held_x, norms[:, None]], axis=1).astype(kind).T
    for a in range(0, len(asking), KNN_TILE):
        rows = np.arange(a, min(a + KNN_TILE, len(asking)))
        mine, limit = [], bound[rows]
        for b in range(0, len(columns), 8 * KNN_TILE):
            cols = columns[b:b + 8 * KNN_TILE]
            product = left[rows] @ right[:, b:b + 8 * KNN_TILE]  # the squared distance but for the asking row's own square
            off = margin * (squares[rows] + np.fmax.reduce(norms[b:b + 8 * KNN_TILE])) + 1e-30
            if k <= product.shape[1] - skip_self and np.isinf(limit).any():  # no bound yet: the tile's own k-th distance is one
                seen = np.where(own[rows][:, None] == ids[cols], np.inf, product) if skip_self else product
                kth = np.partition(seen, k - 1, axis=1)[:, k - 1] + squares[rows] + off
                limit = np.fmin(limit, np.sqrt(np.maximum(kth, 0)) + 1e-9)
            reach = np.minimum((limit + 1e-9) ** 2 - squares[rows] + off, np.finfo(kind).max).astype(kind)
            at, near = np.divmod(np.flatnonzero(product <= np.nextafter(reach, kind(np.inf))[:, None]), len(cols))
            for c in range(0, len(at), 1 << 16):
                i, j = rows[at[c:c + (1 << 16)]], cols[near[c:c + (1 << 16)]]
                d = np.round(np.sqrt(((asking[i] - held[j]) ** 2).sum(axis=1)), 9)
                good = np.isfinite(d) & (d <= bound[i] + 1e-9)
                if skip_self:
                    good &= own[i] != ids[j]
                mine.append(np.stack([i[good], j[good], d[good]], axis=1))
                if len(mine) > 1 and sum(map(len, mine)) > 1 << 18:
                    mine = [_first_of(np.concatenate(mine), k)]
        if mine:
            found.append(_first_of(np.concatenate(mine), k))
    return _first_of(np.concatenate(found), k)


def _first_of(found: np.ndarray, k: int) -> np.ndarray:
    """The first ``k`` rows of each asking row by distance and held row."""
    found = found[np.lexsort((found[:, 1], found[:, 2], found[:, 0]))]
    first = np.append(True, found[1:, 0] != found[:-1, 0])[:len(found)]
    start = np.maximum.accumulate(np.where(first, np.arange(len(found)), 0)) if len(found) else np.zeros(0, int)
    return found[np.arange(len(found)) - start < k]


def _places(batches: Iterator[pd.DataFrame]) -> Iterator[tuple[pd.DataFrame, pd.DataFrame]]:
    """Batches sorted by place and role (0 training, 1 asking): the training rows of a place by id, with the rows that ask."""
    at, held, have = None, [], None
    for batch in batches:
        for place, part in batch.groupby("place", sort=False):
            if place != at:
                at, held, have = place, [], None
            if (part["role"] == 0).any():
                held.append(part[part["role"] == 0])
                have = None
            want = part[part["role"] == 1]
            if len(want):
                if have is None:
                    have = pd.concat(held).sort_values("id", ignore_index=True) if held else part[:0]
                yield have, want


def _bounds(k: int, skip_self: bool):
    """Each asking row of a place with the distance of its ``k``-th nearest there, infinite where there are fewer."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for have, want in _places(batches):
            bound = np.full(len(want), np.inf)
            if len(have):
                best = _closest(_matrix(want["v"]), want["id"].to_numpy(), bound, _matrix(have["v"]), have["id"].to_numpy(),
                                np.arange(len(have)), k, skip_self)
                rows, count = np.unique(best[:, 0].astype(int), return_counts=True)
                full = rows[count >= k]
                bound[full] = best[np.append(best[1:, 0] != best[:-1, 0], True)[:len(best)], 2][count >= k]
            yield pd.DataFrame({"id": want["id"], "v": want["v"], "bound": bound})

    return run


def _within(k: int, skip_self: bool, centres: np.ndarray, radius: np.ndarray, columns: list[str]):
    """The ``k`` best training rows of a place for each asking row, cell by cell, none beyond the row's bound."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for have, want in _places(batches):
            if not len(have):
                continue
            x, held, ids, own = _matrix(want["v"]), _matrix(have["v"]), have["id"].to_numpy(), want["id"].to_numpy()
            bound, cells = want["bound"].to_numpy().copy(), have["cell"].to_numpy().astype(int)
            best = np.zeros((0, 3))
            for c in np.unique(cells):
                rows = np.flatnonzero(_distances(x, centres[c:c + 1])[:, 0] - radius[c] <= bound + 1e-9)
                part = _closest(x[rows], own[rows], bound[rows], held, ids, np.flatnonzero(cells == c), k, skip_self)
                part[:, 0] = rows[part[:, 0].astype(int)]
                best = _first_of(np.concatenate([best, part]), k)
                asked, count = np.unique(best[:, 0].astype(int), return_counts=True)
                last = best[np.append(best[1:, 0] != best[:-1, 0], True)[:len(best)], 2]
                bound[asked[count >= k]] = np.fmin(bound[asked[count >= k]], last[count >= k])
            i, j = best[:, 0].astype(int), best[:, 1].astype(int)
            yield pd.DataFrame(dict(zip(columns, (own[i], ids[j], best[:, 2], have["label"].to_numpy()[j]))))

    return run


def knn(train: DataFrame, test: DataFrame, key: str, features: str, label: str, k: int = 5,
        block: int = KNN_BLOCK, skip_self: bool = True, held: int = KNN_HELD) -> DataFrame:
    """The exact ``k`` nearest training rows of every test row as (key, neighbour, distance, label).

    Training rows are assigned to the nearest of a few pivots; the pivots grow with the root of the rows. Cells are cut
    into blocks of about ``block`` rows, and a task holds ``held`` blocks while a slice of the rows that ask passes by in
    batches. A row first asks one place of its nearest cell; that k-th distance then bounds which cells it still asks
    and which rows it gets back. Exact search stays quadratic in many dimensions, where cells exclude little: the copies
    of a row that asks are one for each ``held`` blocks, and a pair costs one product of vectors.
    """
    spark, kinds = train.sparkSession, dict(train.dtypes)
    n_train, n_test = train.count(), test.count()
    pivots = max(1, math.isqrt(n_train // max(1, block // 16)))
    centres = np.array([r[features] for r in cap_sample(train, pivots, key).orderBy(key).collect()], dtype=float)
    if not len(centres):
        return spark.createDataFrame([], f"{key} {kinds[key]}, neighbour {kinds[key]}, distance double, neighbour_label {kinds[label]}")
    finite = np.isfinite(centres).all(axis=1)  # rows with other components are nobody's neighbours, and no pivots
    centres = centres[finite] if finite.any() else np.zeros((1, centres.shape[1]))

    @F.pandas_udf("struct<cell:int,gap:double>")
    def nearest(v: pd.Series) -> pd.DataFrame:
        d = _distances(_matrix(v), centres)
        cell = d.argmin(axis=1)
        return pd.DataFrame({"cell": cell.astype("int32"), "gap": d[np.arange(len(d)), cell]})

    def celled(df: DataFrame, *cols: Column) -> DataFrame:
        rows = df.select(F.col(key).alias("id"), F.col(features).alias("v"), *cols).withColumn("_n", nearest(F.col("v")))
        return rows.select("*", F.col("_n.cell").alias("cell"), F.col("_n.gap").alias("gap")).drop("_n")

    given = checkpoint(celled(train, F.col(label).alias("label")))
    shape = {r["cell"]: r for r in given.groupBy("cell").agg(F.max(F.nanvl("gap", F.lit(None))).alias("radius"), F.count(F.lit(1)).alias("n")).collect()}
    radius = np.full(len(centres), -np.inf)  # one row per pivot
    blocks, first, total = {}, {}, 0
    for c in sorted(shape):
        radius[c] = -np.inf if shape[c]["radius"] is None else shape[c]["radius"]
        blocks[c], first[c] = max(1, -(-shape[c]["n"] // block)), total
        total += blocks[c]
    parts = {c: list(range(first[c] // held, (first[c] + blocks[c] - 1) // held + 1)) for c in shape}
    table = lambda d: F.create_map(*[F.lit(x) for kv in d.items() for x in kv])
    part = F.floor((table(first)[F.col("cell")] + F.pmod(F.xxhash64("id", "v"), table(blocks)[F.col("cell")])) / held).cast("int")
    given = given.withColumn("part", part)
    nothing = F.lit(None).cast(kinds[label])

    def lined(have: DataFrame, want: DataFrame, count: int) -> DataFrame:
        # the rows of a place come first and are held, its askers then pass by in batches: nothing is copied for them
        both = have.withColumn("role", F.lit(0)).unionByName(want.withColumn("role", F.lit(1)), allowMissingColumns=True)
        return both.repartition(count, "place").sortWithinPartitions("place", "role")

    places = max(c[-1] for c in parts.values()) + 1
    # first a place of the own cell: it may hold other cells too, which only makes the bound tighter
    asked = celled(test).withColumn("place", part).drop("cell", "gap")
    start = given.select("id", "v", F.col("part").alias("place"))
    bounds = checkpoint(lined(start, asked, places).mapInPandas(
        _bounds(k, skip_self), f"id {kinds[key]}, v {dict(test.dtypes)[features]}, bound double"))

    @F.pandas_udf("array<int>")
    def reachable(v: pd.Series, bound: pd.Series) -> pd.Series:
        near = _distances(_matrix(v), centres) - radius <= bound.to_numpy()[:, None] + 1e-9
        return pd.Series([sorted({p for c in np.flatnonzero(row) for p in parts.get(int(c), ())}) for row in near])

    slices = max(1, -(-n_test // KNN_SLICE))
    asked = (bounds.withColumn("_part", F.explode(reachable("v", "bound")))
             .select("id", "v", "bound", (F.col("_part") * slices + F.pmod(F.xxhash64("id", "v"), F.lit(slices))).cast("int").alias("place")))
    dealt = given.select("id", "v", "label", "cell", F.explode(F.sequence(F.col("part") * slices, F.col("part") * slices + slices - 1)).alias("place"))
    near_rows = lined(dealt, asked.withColumn("label", nothing), places * slices).mapInPandas(
        _within(k, skip_self, centres, radius, [key, "neighbour", "distance", "neighbour_label"]),
        f"{key} {kinds[key]}, neighbour {kinds[key]}, distance double, neighbour_label {kinds[label]}")
    rank = W.partitionBy(key).orderBy("distance", "neighbour")
    return near_rows.withColumn("_r", F.row_number().over(rank)).where(F.col("_r") <= k).drop("_r")


def knn_vote(train: DataFrame, test: DataFrame, key: str, features: str, label: str, k: int = 5,
             **options) -> DataFrame:
    """Majority label of the ``k`` nearest neighbours; ties go to the smaller label."""
    votes = knn(train, test, key, features, label, k, **options).groupBy(key, "neighbour_label").agg(
        F.count(F.lit(1)).alias("votes"))
    return votes.groupBy(key).agg(
        F.min_by("neighbour_label", F.struct(-F.col("votes"), F.col("neighbour_label"))).alias("vote"),
        F.max("votes").alias("votes"))
