"""Projections, samples, clean-up, set operations and scalar functions."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelkit.functions import scalars as S
from panelkit.operators import rows, sets
from panelkit.plans.registry import query
from panelkit.plans.views import ORDER_LOG, months_between, order_log, shift, whole_months
from panelkit.scale import ensure_checkpoint_dir
from panelkit.sources import readers, writers
from panelkit.sources.writers import to_triples
from panelkit.tables import Tables


@query("bands", """SELECT p_partkey, CAST(floor(p_size / 3) * 3 AS INT) AS size_band,
  CAST(CASE WHEN p_size <= 11 THEN floor(p_size / 6) * 6 ELSE floor(p_size / 12) * 12 END AS INT) AS tenor_band FROM part""")
def bands(t: Tables) -> DataFrame:
    return t.part.select("p_partkey", S.band("p_size", 3).alias("size_band"), S.tenor_band("p_size").alias("tenor_band"))


@query("period_labels", f"""WITH {ORDER_LOG} SELECT contract, year(day) || '_' || quarter(day) AS label, CAST(last_day(day) AS VARCHAR) AS month_end,
  CAST(trunc({months_between("DATE '2002-01-01'", 'day')} / 12) AS INT) AS age FROM order_log""")
def period_labels(t: Tables) -> DataFrame:
    return order_log(t).select("contract", S.period_label("day").alias("label"), F.last_day("day").alias("month_end"),
                               S.age_years("day", F.lit("2002-01-01").cast("date")).alias("age"))


@query("regexp_text", r"""SELECT p_partkey, trim(p_brand) || '-' || trim(CAST(p_size AS VARCHAR)) AS label, regexp_replace(trim(p_name), '\s+', '_', 'g') AS clean,
  regexp_extract(p_brand, '#(\d+)', 1) AS brand_no, substr(p_type, 1, 3) AS short_type FROM part""")
def regexp_text(t: Tables) -> DataFrame:
    return t.part.select("p_partkey", S.join_text("p_brand", "p_size", sep="-").alias("label"), S.clean_name("p_name").alias("clean"),
                         S.extract("p_brand", r"#(\d+)").alias("brand_no"), F.substring("p_type", 1, 3).alias("short_type"))


@query("scalar_functions", f"""WITH {ORDER_LOG} SELECT contract, CASE WHEN status = 'F' THEN 'done' WHEN status = 'O' THEN 'open' ELSE 'other' END AS state,
  COALESCE(NULLIF(priority, '5-LOW'), 'none') AS priority, TRY_CAST(left(priority, 1) AS INT) AS rank, TRY_CAST(priority AS INT) AS not_a_number,
  CAST({shift('day', 3)} AS VARCHAR) AS plus_3m, CAST(day - 30 AS VARCHAR) AS minus_30d, CAST(DATE '2002-01-01' - day AS INT) AS days_left,
  {whole_months("DATE '2002-01-01'", 'day')} AS months_left, round(ln(CAST(price AS DOUBLE)), 6) AS log_price, round(sqrt(CAST(price AS DOUBLE)), 6) AS root_price
FROM order_log""")
def scalar_functions(t: Tables) -> DataFrame:
    end = F.lit("2002-01-01").cast("date")
    price = F.col("price").cast("double")
    return order_log(t).select(
        "contract", S.case_of("status", {"done": ["F"], "open": ["O"]}, "other").alias("state"),
        S.first_non_null(S.null_if("priority", "5-LOW"), F.lit("none")).alias("priority"),
        S.cast_to(F.left("priority", F.lit(1)), "int").alias("rank"), S.cast_to("priority", "int").alias("not_a_number"),
        S.shift_months("day", 3).alias("plus_3m"), S.shift_days("day", -30).alias("minus_30d"),
        S.days_between(end, "day").alias("days_left"), S.months_diff(end, "day").alias("months_left"),
        F.round(F.log(price), 6).alias("log_price"), F.round(F.sqrt(price), 6).alias("root_price"))


@query("window_start", f"""WITH {ORDER_LOG} SELECT contract, CAST(CAST((last_day(day) + 1) - INTERVAL 3 MONTH AS DATE) - 1 AS VARCHAR) AS start_3m,
  CAST(CAST((last_day(day) + 1) - INTERVAL 1 MONTH AS DATE) - 1 AS VARCHAR) AS start_1m FROM order_log""")
def window_start(t: Tables) -> DataFrame:
    rd = F.last_day("day")
    return order_log(t).select("contract", S.month_window_start(rd, 3).alias("start_3m"), S.month_window_start(rd, 1).alias("start_1m"))


@query("margin_columns", """SELECT l_tax, l_discount, l_quantity, COUNT(*) AS n, round(l_tax + l_discount / 0.6::DOUBLE / l_quantity * 12, 9) AS margin,
  round((l_tax + l_discount + l_quantity) / 3, 9) AS mean_of_three FROM lineitem GROUP BY 1, 2, 3""")
def margin_columns(t: Tables) -> DataFrame:
    per = t.lineitem.groupBy("l_tax", "l_discount", "l_quantity").agg(F.count(F.lit(1)).alias("n"))
    return per.select("*", F.round(S.margin("l_tax", "l_discount", "l_quantity"), 9).alias("margin"),
                      F.round(S.list_mean("l_tax", "l_discount", "l_quantity"), 9).alias("mean_of_three"))


@query("union_modes", """SELECT 'all' AS mode, n, COUNT(*) AS rows FROM (SELECT n_regionkey AS n FROM nation UNION ALL SELECT r_regionkey FROM region UNION ALL SELECT 99) GROUP BY 2
UNION ALL SELECT 'distinct', n, COUNT(*) FROM (SELECT n_regionkey AS n FROM nation UNION SELECT r_regionkey FROM region) GROUP BY 2""")
def union_modes(t: Tables) -> DataFrame:
    a, b = t.nation.select(F.col("n_regionkey").alias("n")), t.region.select(F.col("r_regionkey").alias("n"))

    def counted(df: DataFrame, mode: str) -> DataFrame:
        return df.groupBy("n").agg(F.count(F.lit(1)).alias("rows")).select(F.lit(mode).alias("mode"), "n", "rows")

    return sets.union_all(counted(sets.add_rows(sets.union_all(a, b), [(99,)]), "all"),
                          counted(sets.union_distinct(a, b), "distinct"))


@query("except_rows", """SELECT o_custkey AS client FROM orders EXCEPT SELECT user_id FROM events""")
def except_rows(t: Tables) -> DataFrame:
    return sets.except_rows(t.orders.select(F.col("o_custkey").alias("client")), t.events.select(F.col("user_id").alias("client")))


@query("profile", """SELECT 'p_size' AS "column", COUNT(p_size) AS count, round(AVG(p_size), 6) AS mean, round(stddev_samp(p_size), 6) AS stddev,
  MIN(p_size)::DOUBLE AS min, MAX(p_size)::DOUBLE AS max FROM part
UNION ALL SELECT 'p_retailprice', COUNT(p_retailprice), round(AVG(p_retailprice), 6), round(stddev_samp(p_retailprice), 6), MIN(p_retailprice), MAX(p_retailprice) FROM part""")
def profile(t: Tables) -> DataFrame:
    out = rows.column_summary(t.part, ["p_size", "p_retailprice"])
    return out.withColumns({c: F.round(c, 6) for c in ("mean", "stddev")})


@query("constant_columns", """SELECT 'c_custkey' AS "column", 1.0 AS fill, 0 AS is_constant UNION ALL SELECT 'c_mktsegment', 1.0, 0
UNION ALL SELECT 'fixed', 1.0, 1 UNION ALL SELECT 'rare', round(COUNT(CASE WHEN c_acctbal > 9000 THEN 1 END) / COUNT(*), 9),
  CAST(COALESCE(MIN(CASE WHEN c_acctbal > 9000 THEN 1 END) = MAX(CASE WHEN c_acctbal > 9000 THEN 1 END), TRUE) AS INT) FROM customer""")
def constant_columns(t: Tables) -> DataFrame:
    table = t.customer.select("c_custkey", "c_mktsegment", F.lit("x").alias("fixed"), F.when(F.col("c_acctbal") > 9000, 1).alias("rare"))
    return rows.column_fill(table).withColumn("fill", F.round("fill", 9))


@query("wide_strings", """SELECT "column", distinct_values FROM (SELECT 'p_name' AS "column", COUNT(DISTINCT p_name) AS distinct_values FROM part
UNION ALL SELECT 'p_brand', COUNT(DISTINCT p_brand) FROM part UNION ALL SELECT 'p_type', COUNT(DISTINCT p_type) FROM part) WHERE distinct_values <= 31""")
def wide_strings(t: Tables) -> DataFrame:
    from panelkit.operators.aggregates import distinct_counts

    kept = rows.drop_wide_strings(t.part.select("p_name", "p_brand", "p_type"), 31)
    return distinct_counts(t.part.select(*kept.columns), kept.columns)


@query("fill_and_replace", """SELECT d.doc_id, COALESCE(l.quality, -10000) AS quality, CASE COALESCE(d.lang, 'unknown') WHEN 'en' THEN 'english' WHEN 'de' THEN 'german' ELSE d.lang END AS lang,
  round(COALESCE(l.toxic, (SELECT AVG(toxic) FROM documents JOIN labels USING (doc_id))), 9) AS toxic FROM documents d LEFT JOIN labels l ON l.doc_id = d.doc_id""")
def fill_and_replace(t: Tables) -> DataFrame:
    joined = t.documents.select("doc_id", "lang").join(t.labels, "doc_id", "left")
    filled = rows.fill_nulls(joined, {"quality": -10000, "lang": "unknown"}, mean_of=["toxic"])
    return rows.replace_values(filled, "lang", {"en": "english", "de": "german"}).withColumn("toxic", F.round("toxic", 9))


@query("separate_special", """SELECT d.doc_id, CASE WHEN l.toxic = 1 THEN 'Churn' WHEN l.quality = 1 THEN 'NewJoiner' ELSE d.lang END AS segment,
  CAST(COALESCE(l.toxic = 1 OR l.quality = 1, FALSE) AS INT) AS special FROM documents d LEFT JOIN labels l ON l.doc_id = d.doc_id""")
def separate_special(t: Tables) -> DataFrame:
    joined = t.documents.select("doc_id", F.col("lang").alias("segment")).join(t.labels, "doc_id", "left")
    plain, special = rows.separate_special(joined, F.col("toxic") == 1, F.col("quality") == 1, "segment")
    return sets.union_all(plain.withColumn("special", F.lit(0)), special.withColumn("special", F.lit(1))).select(
        "doc_id", "segment", "special")


@query("dates_to_epoch", "SELECT o_orderkey, CAST(epoch(o_orderdate) AS BIGINT) AS o_orderdate FROM orders")
def dates_to_epoch(t: Tables) -> DataFrame:
    return rows.dates_to_epoch(t.orders.select("o_orderkey", "o_orderdate"))


HASH = "(({0} % 2147483648) * 2654435761) % 4294967296"


@query("stratified_sample", f"""WITH r AS (SELECT c_custkey, c_mktsegment, row_number() OVER (PARTITION BY c_mktsegment ORDER BY {HASH.format('c_custkey')}, c_custkey) AS rn,
  COUNT(*) OVER (PARTITION BY c_mktsegment) AS n FROM customer)
SELECT c_custkey, c_mktsegment FROM r WHERE rn <= floor(CASE c_mktsegment WHEN 'BUILDING' THEN 0.5::DOUBLE WHEN 'MACHINERY' THEN 0.25::DOUBLE ELSE 0 END * n)""")
def stratified_sample(t: Tables) -> DataFrame:
    return rows.stratified_sample(t.customer.select("c_custkey", "c_mktsegment"), "c_mktsegment",
                                  {"BUILDING": 0.5, "MACHINERY": 0.25}, "c_custkey")


@query("split_by_key", f"""SELECT c_custkey, CAST(row_number() OVER (ORDER BY {HASH.format('c_custkey')}, c_custkey) <= floor(0.2::DOUBLE * (SELECT COUNT(*) FROM customer)) AS INT) AS is_test FROM customer""")
def split_by_key(t: Tables) -> DataFrame:
    return rows.split_train_test(t.customer.select("c_custkey"), "c_custkey", 0.2)


@query("cap_sample", f"""SELECT o_orderkey, o_totalprice FROM orders ORDER BY {HASH.format('o_orderkey')}, o_orderkey LIMIT 5000""")
def cap_sample(t: Tables) -> DataFrame:
    return rows.cap_sample(t.orders.select("o_orderkey", "o_totalprice"), 5000, "o_orderkey")


BASE = "https://example.org/part/"


@query("to_triples", f"""WITH c AS (SELECT p_partkey, 'name' AS predicate, p_name AS object, 'xsd:string' AS datatype FROM part
UNION ALL SELECT p_partkey, 'brand', p_brand, 'xsd:string' FROM part UNION ALL SELECT p_partkey, 'size', CAST(p_size AS VARCHAR), 'xsd:integer' FROM part)
SELECT '{BASE}' || p_partkey AS subject, predicate, object, datatype FROM c WHERE object IS NOT NULL AND p_partkey IS NOT NULL""")
def to_triples_query(t: Tables) -> DataFrame:
    return to_triples(t.part, "p_partkey", {"p_name": ("name", "xsd:string"), "p_brand": ("brand", "xsd:string"),
                                            "p_size": ("size", "xsd:integer")}, BASE)


def folder(t: Tables, name: str) -> str:
    """A new folder beside the written intermediates, shared by all executors."""
    ensure_checkpoint_dir(t.spark)
    return f"{t.spark.sparkContext.getCheckpointDir()}/{name}-{uuid.uuid4().hex}"


@query("csv_round_trip", "SELECT n_nationkey, n_name, n_regionkey FROM nation")
def csv_round_trip(t: Tables) -> DataFrame:
    """One CSV file; the columns come back by their header names, here in another order."""
    path = folder(t, "csv")
    writers.write_csv_single(t.nation, path)
    out = readers.read_csv(t.spark, path, "n_name string, n_regionkey int, n_nationkey int")
    return out.select("n_nationkey", "n_name", "n_regionkey")


@query("csv_files_round_trip", """SELECT s_suppkey, NULLIF(trim(s_name), '') AS s_name, s_nationkey, s_acctbal FROM supplier""")
def csv_files_round_trip(t: Tables) -> DataFrame:
    path = folder(t, "csv")
    writers.write_csv(t.supplier, path, ";")
    return readers.read_csv(t.spark, path, "s_suppkey long, s_name string, s_nationkey int, s_acctbal double", sep=";")


@query("json_round_trip", "SELECT conv_id, turn, role, text FROM conversations")
def json_round_trip(t: Tables) -> DataFrame:
    path = folder(t, "json")
    writers.write_json(t.conversations, path)
    return readers.read_json(t.spark, path, "conv_id long, turn long, role string, text string", multi_line=False)


@query("sql_scan", "SELECT n_nationkey, n_name, n_regionkey FROM nation")
def sql_scan(t: Tables) -> DataFrame:
    return readers.sql_scan(t.spark, f"{t.directory}/nation.parquet").select("n_nationkey", "n_name", "n_regionkey")


@query("tsv_round_trip", """SELECT c_custkey, replace(c_name, '"', '') AS c_name, c_acctbal FROM customer""")
def tsv_round_trip(t: Tables) -> DataFrame:
    """Tab separated lines without quoting, written as text and read by their declared schema."""
    path = folder(t, "tsv")
    lines = t.customer.select(F.concat_ws("\t", "c_custkey", F.replace("c_name", F.lit('"'), F.lit("")), "c_acctbal").alias("value"))
    head = t.spark.createDataFrame([("c_custkey\tc_name\tc_acctbal",)], "value string")
    # the first row of each file is its header: a file for each part, the header ahead of its lines
    parted = lines.withColumn("_p", F.pmod(F.xxhash64("value"), F.lit(4)))
    every = parted.withColumn("_n", F.lit(1)).unionByName(
        head.withColumn("_p", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(3).cast("long")))).withColumn("_n", F.lit(0)))
    every.repartition(4, "_p").sortWithinPartitions("_p", "_n").drop("_n").write.partitionBy("_p").text(path)
    out = readers.read_tsv(t.spark, f"{path}/_p=*", "c_custkey long, c_name string, c_acctbal double")
    return out.select("c_custkey", "c_name", "c_acctbal")


@query("json_array", "SELECT p_partkey, p_name, p_size FROM part")
def json_array(t: Tables) -> DataFrame:
    """Files that hold one JSON array each, read whole."""
    path = folder(t, "arrays")
    arrays = t.part.select("p_partkey", "p_name", "p_size").groupBy(F.floor(F.col("p_partkey") / 500).alias("g")).agg(
        F.collect_list(F.struct("p_partkey", "p_name", "p_size")).alias("rows"))
    arrays.select("g", F.to_json("rows").alias("value")).repartition("g").write.partitionBy("g").text(path)
    return readers.read_json(t.spark, f"{path}/g=*", "p_partkey long, p_name string, p_size int", multi_line=True)


@query("parquet_files", "SELECT r_regionkey, r_name FROM region")
def parquet_files(t: Tables) -> DataFrame:
    """A dictionary table copied whole, then written again as two files."""
    path = folder(t, "copy")
    writers.copy_table(t.spark, f"{t.directory}/region.parquet", path)
    writers.write_parquet(t.spark.read.parquet(path), f"{path}-two", files=2)
    return t.spark.read.parquet(f"{path}-two").select("r_regionkey", "r_name")


@query("transactions_round_trip", """SELECT item, COUNT(*) AS n FROM (SELECT DISTINCT o_custkey, o_orderpriority AS item FROM orders) GROUP BY 1""")
def transactions_round_trip(t: Tables) -> DataFrame:
    """Baskets as lines of text, read back and counted by item."""
    path = folder(t, "lines")
    (t.orders.groupBy("o_custkey").agg(F.array_sort(F.collect_set("o_orderpriority")).alias("items"))
     .select(F.concat_ws("\t", "items").alias("value")).write.text(path))
    return (readers.read_transactions(t.spark, path).select(F.explode("items").alias("item")).groupBy("item")
            .agg(F.count(F.lit(1)).alias("n")))


@query("triples_file", """SELECT COUNT(*) AS lines, COUNT(DISTINCT c_custkey) AS subjects FROM
  (SELECT c_custkey, c_name AS v FROM customer WHERE c_name IS NOT NULL UNION ALL
   SELECT c_custkey, c_mktsegment FROM customer WHERE c_mktsegment IS NOT NULL)""")
def triples_file(t: Tables) -> DataFrame:
    """N-Triples lines of two customer columns, written and read as text."""
    path = folder(t, "triples")
    kinds = {"c_name": ("http://example.org/name", "http://example.org/string"),
             "c_mktsegment": ("http://example.org/segment", "http://example.org/string")}
    writers.write_triples(writers.to_triples(t.customer, "c_custkey", kinds, "http://example.org/customer/"), path)
    subject = F.regexp_extract("value", r"^<([^>]*)>", 1)
    return t.spark.read.text(path).agg(F.count(F.lit(1)).alias("lines"), F.count_distinct(subject).alias("subjects"))
