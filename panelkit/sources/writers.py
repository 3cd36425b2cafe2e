"""Table writers, exports and model storage."""

from __future__ import annotations

import json

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from panelkit.scale import checkpoint, small


def write_parquet(df: DataFrame, path: str, mode: str = "overwrite", files: int | None = None) -> None:
    """Parquet sink; ``files`` fixes the number of files of a small result."""
    (df.repartition(files) if files else df).write.mode(mode).parquet(path)


def write_csv(df: DataFrame, path: str, sep: str = ",") -> None:
    """CSV with a header in as many files as there are partitions."""
    df.write.mode("overwrite").option("header", True).option("sep", sep).csv(path)


def write_csv_single(df: DataFrame, path: str, sep: str = ",", max_bytes: int = 256 << 20) -> None:
    """One CSV file with a header, for hand-over of small tables; a table beyond ``max_bytes`` is refused."""
    df = checkpoint(df)
    if not small(df, max_bytes):
        raise ValueError("the table is too large for one file; write_csv takes any size")
    df.repartition(1).write.mode("overwrite").option("header", True).option("sep", sep).csv(path)


def write_json(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").json(path)


def jdbc_options(url: str, table: str, **options: str) -> dict[str, str]:
    """Options of a JDBC sink; user and password come from the caller, never from code."""
    if not url.startswith("jdbc:"):
        raise ValueError("url must start with jdbc:")
    return {"url": url, "dbtable": table, **options}


def write_jdbc_replace(df: DataFrame, url: str, table: str, **options: str) -> None:
    """Replace a database table by ``df``."""
    df.write.format("jdbc").options(**jdbc_options(url, table, **options)).mode("overwrite").save()


def copy_table(spark: SparkSession, source: str, target: str) -> None:
    """Copy a dictionary table unfiltered."""
    write_parquet(spark.read.parquet(source), target)


def to_triples(df: DataFrame, key: str, mapping: dict[str, tuple[str, str]], base: str) -> DataFrame:
    """One (subject, predicate, object, datatype) row per filled mapped column.

    ``mapping`` is column -> (predicate, datatype). Rows without a key give no triple.
    """
    cells = F.array(*[F.struct(F.lit(p).alias("predicate"), F.col(c).cast("string").alias("object"),
                               F.lit(t).alias("datatype")) for c, (p, t) in mapping.items()])
    return (df.where(F.col(key).isNotNull())
            .select(F.concat(F.lit(base), F.col(key).cast("string")).alias("subject"), F.inline(cells))
            .where(F.col("object").isNotNull()))


def count_keyless(df: DataFrame, key: str) -> DataFrame:
    """How many rows have no key."""
    return df.agg(F.count_if(F.col(key).isNull()).alias("rows_without_key"))


def write_triples(triples: DataFrame, path: str) -> None:
    """Triples as N-Triples lines."""
    text = F.regexp_replace(F.regexp_replace("object", r"\\", r"\\\\"), '"', r'\\"')
    text = F.regexp_replace(F.regexp_replace(text, "\n", r"\\n"), "\r", r"\\r")
    triples.select(F.format_string('<%s> <%s> "%s"^^<%s> .', "subject", "predicate", text, "datatype")
                   .alias("value")).write.mode("overwrite").text(path)


def export_rules(rules: DataFrame, path: str, kind: str = "json") -> None:
    """Rules as JSON lines, or two-item rules as tab separated text with 8 decimals."""
    if kind == "json":
        rules.write.mode("overwrite").json(path)
        return
    if kind != "tsv":
        raise ValueError("kind must be json or tsv")
    pairs = rules.where((F.size("items_base") == 1) & (F.size("items_add") == 1))
    pairs.select(F.format_string("%s\t%s\t%.8f\t%.8f\t%.8f", F.get("items_base", F.lit(0)), F.get("items_add", F.lit(0)),
                                 "support", "confidence", "lift").alias("value")).write.mode("overwrite").text(path)


def save_model(model: PipelineModel, columns: list[str], path: str) -> None:
    """Store a fitted pipeline with the columns it was fitted on."""
    model.write().overwrite().save(f"{path}/model")
    spark = SparkSession.active()
    spark.createDataFrame([(json.dumps(columns),)], "value string").coalesce(1).write.mode("overwrite").text(
        f"{path}/columns")


def load_model(spark: SparkSession, path: str) -> tuple[PipelineModel, list[str]]:
    columns = json.loads(spark.read.text(f"{path}/columns").first()["value"])
    return PipelineModel.load(f"{path}/model"), columns
