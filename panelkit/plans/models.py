"""Fitted models on the given tables; results depend on the solver, so these queries have no SQL."""

from __future__ import annotations

from pyspark.ml import Pipeline
from pyspark.ml import classification as C
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelkit.functions.vectors import to_array, to_vector
from panelkit.operators import encode, models, neighbours, select, trees, ward
from panelkit.operators.rows import split_train_test
from panelkit.operators.scores import gini
from panelkit.plans.registry import query
from panelkit.scale import checkpoint, scratch
from panelkit.tables import Tables

CLIENT_FEATURES = ["c_acctbal", "c_nationkey", "orders", "spend", "urgent"]


def clients(t: Tables) -> DataFrame:
    """Customers with their order totals; a customer above the usual spend per order is the target."""
    per = t.orders.groupBy(F.col("o_custkey").alias("c_custkey")).agg(
        F.count(F.lit(1)).cast("double").alias("orders"), F.sum("o_totalprice").alias("spend"),
        F.sum(F.when(F.col("o_orderpriority") == "1-URGENT", 1.0).otherwise(0.0)).alias("urgent"),
        F.max("o_totalprice").alias("top"))
    rows = t.customer.join(per, "c_custkey", "left").fillna(0.0, ["orders", "spend", "urgent", "top"])
    return rows.withColumn("label", (F.col("top") > 450000).cast("int"))


def vectors(t: Tables) -> DataFrame:
    return t.embeddings.select("vec_id", (F.col("label") < 5).cast("int").alias("label"), F.col("label").alias("class"),
                               to_vector("embedding").alias("v"))


def predictions(fit, rows: DataFrame, key: str, label: str = "label") -> DataFrame:
    """Predictions for the training and the test part by the model that ``fit`` makes of the training part."""
    parted = checkpoint(split_train_test(rows, key, 0.25))
    part = F.when(F.col("is_test") == 1, "test").otherwise("train").alias("part")
    return fit(parted.where("is_test = 0")).transform(parted).select(key, label, "prediction", part)


@query("logistic")
def logistic(t: Tables) -> DataFrame:
    """Scores of the training and the test part by a model of the training part."""
    return models.train_test(clients(t), "label", CLIENT_FEATURES, "c_custkey", 0.01)[2]


@query("logistic_coefficients")
def logistic_coefficients(t: Tables) -> DataFrame:
    return models.coefficient_table(models.logistic_fit(clients(t), "label", CLIENT_FEATURES, 0.01), CLIENT_FEATURES)


@query("logistic_gini")
def logistic_gini(t: Tables) -> DataFrame:
    scored = checkpoint(models.train_test(clients(t), "label", CLIENT_FEATURES, "c_custkey", 0.01)[2])
    parts = [gini(scored.where(F.col("part") == p), "label", "score").withColumn("part", F.lit(p)) for p in ("train", "test")]
    return parts[0].unionByName(parts[1])


@query("nonzero_coefficients")
def nonzero_coefficients(t: Tables) -> DataFrame:
    rows = checkpoint(clients(t))
    kept = select.nonzero_coefficients(rows, "label", CLIENT_FEATURES)
    return rows.groupBy("label").agg(F.count(F.lit(1)).alias("n"), *[F.avg(c).alias(c) for c in kept])


for _kind in ("tree", "forest", "boosted"):
    @query({"tree": "trees", "forest": "forests", "boosted": "boosted"}[_kind])
    def _classifier(t: Tables, kind: str = _kind) -> DataFrame:
        rows = clients(t)
        return predictions(lambda train: models.tree_fit(train, "label", CLIENT_FEATURES, kind), rows, "c_custkey")

    @query(f"{_kind}_regression")
    def _regression(t: Tables, kind: str = _kind) -> DataFrame:
        rows = clients(t)
        cols = ["c_acctbal", "c_nationkey", "orders", "urgent"]
        return predictions(lambda train: models.tree_fit(train, "spend", cols, f"{kind}_regression"), rows, "c_custkey", "spend")


@query("linear_regression", """WITH m AS (SELECT AVG(p_size) AS mx, AVG(p_partkey) AS mz, AVG(p_retailprice) AS my,
  var_pop(p_size) AS xx, var_pop(p_partkey) AS zz, covar_pop(p_size, p_partkey) AS xz, covar_pop(p_size, p_retailprice) AS xy,
  covar_pop(p_partkey, p_retailprice) AS zy FROM part),
b AS (SELECT *, (xy * zz - zy * xz) / (xx * zz - xz * xz) AS bx, (zy * xx - xy * xz) / (xx * zz - xz * xz) AS bz FROM m)
SELECT 'intercept' AS term, round(my - bx * mx - bz * mz, 4) AS coefficient FROM b UNION ALL SELECT 'p_size', round(bx, 4) FROM b
UNION ALL SELECT 'p_partkey', round(bz, 4) FROM b""")
def linear_regression(t: Tables) -> DataFrame:
    """Least squares, checked against the normal equations."""
    rows = t.part.withColumn("price", F.col("p_retailprice"))
    cols = ["p_size", "p_partkey"]
    return models.coefficient_table(models.linear_fit(rows, "price", cols), cols).withColumn("coefficient", F.round("coefficient", 4))


@query("polynomial_regression")
def polynomial_regression(t: Tables) -> DataFrame:
    model = models.linear_fit(t.part, "p_retailprice", ["p_size"], degree=4)
    return model.transform(t.part).select("p_partkey", "p_retailprice", "prediction")


@query("svm")
def svm(t: Tables) -> DataFrame:
    return predictions(lambda train: models.svm_fit(train, "label", ["v"]), vectors(t), "vec_id")


@query("bayes")
def bayes(t: Tables) -> DataFrame:
    return predictions(lambda train: models.bayes_fit(train, "label", ["v"]), vectors(t), "vec_id")


@query("mlp")
def mlp(t: Tables) -> DataFrame:
    width = t.embeddings.select(F.size("embedding")).first()[0]
    return predictions(lambda train: models.mlp_fit(train, "label", ["v"], width=width), vectors(t), "vec_id")


@query("text_bayes")
def text_bayes(t: Tables) -> DataFrame:
    """Quality of documents from word counts."""
    rows = t.labels.join(t.documents.select("doc_id", "text"), "doc_id").withColumn("label", F.col("quality"))
    pipeline = Pipeline(stages=[encode.text_vectorizer("text"), C.NaiveBayes(labelCol="label", modelType="gaussian")])
    return predictions(pipeline.fit, rows, "doc_id")


@query("kmeans_curve")
def kmeans_curve(t: Tables) -> DataFrame:
    return models.kmeans_curve(vectors(t), ["v"])


@query("kmeans")
def kmeans(t: Tables) -> DataFrame:
    return models.kmeans_fit(vectors(t), ["v"], 5).transform(vectors(t)).select("vec_id", "prediction")


@query("bisecting")
def bisecting(t: Tables) -> DataFrame:
    return models.bisecting_fit(vectors(t), ["v"], 5).transform(vectors(t)).select("vec_id", "prediction")


@query("pca")
def pca(t: Tables) -> DataFrame:
    model = models.pca_fit(vectors(t), ["v"], 2)
    share = F.array(*map(F.lit, models.explained_variance(model)))
    return model.transform(vectors(t)).select("vec_id", to_array("components").alias("components"), share.alias("explained"))


@query("ward")
def ward_groups(t: Tables) -> DataFrame:
    """Five groups of customers by balance, spend and orders, scaled, by Ward's distance."""
    cols = ["c_acctbal", "spend", "orders"]
    scaled = encode.standard_scale(clients(t), cols)
    return ward.ward(scaled.select("c_custkey", F.array(*[f"{c}_scaled" for c in cols]).alias("v")), "v", 5).select("c_custkey", "group")


@query("knn_hashed")
def knn_hashed(t: Tables) -> DataFrame:
    """The five nearest vectors of every vector, among those that share a hash bucket with it."""
    rows = t.embeddings.select("vec_id", "embedding", "label")
    return neighbours.knn_hashed(rows, rows, "vec_id", "embedding", "label").select(
        "vec_id", "neighbour", F.round("distance", 6).alias("distance"))


@query("fold_sizes", """WITH c AS (SELECT COALESCE(COUNT(*), 0) AS n, label FROM (SELECT CAST(COALESCE(MAX(o_totalprice), 0) > 450000 AS INT) AS label
  FROM customer LEFT JOIN orders ON o_custkey = c_custkey GROUP BY c_custkey) GROUP BY label)
SELECT label, CAST(f AS INT) AS fold, n // 10 + CAST(f < n % 10 AS BIGINT) AS n FROM c, range(10) k(f) WHERE n // 10 + CAST(f < n % 10 AS BIGINT) > 0""")
def fold_sizes(t: Tables) -> DataFrame:
    """Rows of each class in each of ten stratified folds."""
    return models.stratified_folds(clients(t), "label", "c_custkey").groupBy("label", "fold").agg(F.count(F.lit(1)).alias("n"))


@query("lda")
def lda(t: Tables) -> DataFrame:
    rows = clients(t).withColumn("segment", F.col("c_mktsegment"))
    return models.lda_fit(rows, "segment", CLIENT_FEATURES, 2).select("c_custkey", "segment", "ld1", "ld2")


@query("cross_validate")
def cross_validate(t: Tables) -> DataFrame:
    rows = encode.assemble(clients(t).select("c_custkey", "label", *CLIENT_FEATURES), CLIENT_FEATURES).select("c_custkey", "label", "features")
    estimator = C.LogisticRegression(labelCol="label")
    return models.cross_validate(estimator, rows, "label", 10, {estimator.regParam: [0.01, 0.1]}, key="c_custkey")


@query("classify")
def classify(t: Tables) -> DataFrame:
    rows = split_train_test(clients(t), "c_custkey", 0.25)
    out = models.classify(rows, "label", CLIENT_FEATURES, C.LogisticRegression(labelCol="label"), F.col("is_test") == 1)
    return out.select("c_custkey", "label", "prediction")


@query("classify_evaluate")
def classify_evaluate(t: Tables) -> DataFrame:
    """How often each label of the test part was predicted as each label."""
    return models.evaluate(classify(t), "label")


@query("tree_power")
def tree_power(t: Tables) -> DataFrame:
    ranked = select.tree_power(clients(t), "label", CLIENT_FEATURES)
    return t.spark.createDataFrame([(f, float(p), int(n)) for f, p, n in ranked], "feature string, power double, leaves int")


@query("segment_trees")
def segment_trees(t: Tables) -> DataFrame:
    """Micro-segments: a tree per market segment predicts the cell of spend and order count."""
    rows = clients(t).withColumn("one", F.lit(1))
    cells = encode.quantile_bins(rows, "spend", "orders", ["c_custkey"], 3, 2)
    cols = ["c_acctbal", "c_nationkey", "urgent"]
    model = models.segment_trees(cells, "c_mktsegment", "cell", cols, min_rows=10)
    return models.label_micro_segments(cells, "c_mktsegment", model).select("c_custkey", "cell", "micro_segment")


@query("micro_segments")
def micro_segments(t: Tables) -> DataFrame:
    """The whole flow: quantile cells, per segment selection, categories, tree, save, load and labelled clients."""
    orders = t.orders.groupBy(F.col("o_custkey").alias("c_custkey")).agg(
        F.max_by("o_orderstatus", F.struct("o_orderdate", "o_orderkey")).alias("last_status"),
        F.max_by("o_orderpriority", F.struct("o_orderdate", "o_orderkey")).alias("last_priority"))
    rows = checkpoint(clients(t).join(orders, "c_custkey", "left"))
    cells = checkpoint(encode.quantile_bins(rows, "spend", "orders", ["c_custkey"], 3, 2))
    path = scratch(t.spark, "segments")
    models.fit_micro_segments(cells, "c_mktsegment", "cell", ["c_acctbal", "c_nationkey", "urgent"],
                              ["last_status", "last_priority"], path, min_rows=10)
    return models.label_micro_segments(cells, "c_mktsegment", trees.load(t.spark, path)).select(
        "c_custkey", "c_mktsegment", "cell", "micro_segment")


#: Part types by frequency, ties by name, and the dummy vector of a type; the last type has none.
TYPES = "types AS (SELECT p_type, row_number() OVER (ORDER BY COUNT(*) DESC, p_type) - 1 AS i, COUNT(*) OVER () AS k FROM part GROUP BY 1)"
DUMMY = "list_transform(range(k - 1), lambda j: CASE WHEN j = i THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END)"


@query("formula", f"""WITH {TYPES} SELECT p_partkey, p_retailprice AS label, list_concat([p_size::DOUBLE], {DUMMY}) AS features
FROM part JOIN types USING (p_type)""")
def formula(t: Tables) -> DataFrame:
    out = encode.formula(t.part, "p_retailprice", ["p_size", "p_type"])
    return out.select("p_partkey", "label", to_array("features").alias("features"))


@query("dummy_vectors", f"WITH {TYPES} SELECT p_partkey, {DUMMY} AS dummy FROM part JOIN types USING (p_type)")
def dummy_vectors(t: Tables) -> DataFrame:
    return encode.one_hot(t.part.select("p_partkey", "p_type"), ["p_type"]).select("p_partkey", to_array("p_type_dummy").alias("dummy"))


@query("slice_vector", "SELECT vec_id, [embedding[1]::DOUBLE, embedding[4]::DOUBLE, embedding[6]::DOUBLE] AS selected FROM embeddings")
def slice_vector(t: Tables) -> DataFrame:
    return encode.slice_vector(vectors(t), [0, 3, 5], "v").select("vec_id", to_array("selected").alias("selected"))
