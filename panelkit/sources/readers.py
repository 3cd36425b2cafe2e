"""Table readers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

CORRUPT = "_corrupt_record"


def read_table(spark: SparkSession, directory: str, name: str) -> DataFrame:
    """Scan of ``directory/name.parquet``."""
    return spark.read.parquet(f"{directory.rstrip('/')}/{name}.parquet")


def sql_scan(spark: SparkSession, path: str) -> DataFrame:
    """Scan by path, as ``select * from parquet.`path``` does."""
    return spark.read.parquet(path)


def read_csv(spark: SparkSession, path: str, schema: T.StructType | str, sep: str = ",", quote: str = '"',
             null_text: str = "NULL", sentinels: tuple = (), bits: tuple[str, ...] = (),
             keep_corrupt: bool = False) -> DataFrame:
    """Header CSV with a declared schema; columns are found by their header name, and a missing one is an error.

    Text equal to ``null_text`` or blank, and numbers in ``sentinels``, become NULL; slash dates are
    accepted; a value that does not fit its type becomes NULL. Columns in ``bits`` hold ``\\0``/``\\1``.
    Ragged rows are kept, and shown in ``_corrupt_record`` when ``keep_corrupt`` is set.
    """
    wanted = T.StructType.fromDDL(schema) if isinstance(schema, str) else schema
    header = spark.read.option("header", True).option("sep", sep).option("quote", quote).csv(path).columns
    missing = [f.name for f in wanted.fields if f.name not in header]
    if missing:
        raise ValueError(f"the file has no column {', '.join(missing)}; its header is {', '.join(header)}")
    raw_schema = T.StructType([T.StructField(name, T.StringType()) for name in header] + [T.StructField(CORRUPT, T.StringType())])
    raw = (spark.read.schema(raw_schema).option("header", True).option("sep", sep).option("quote", quote)
           .option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", CORRUPT)
           .option("enforceSchema", True).option("columnPruning", not keep_corrupt).csv(path))
    cols = []
    for field in wanted.fields:
        text = F.trim(F.col(field.name))
        text = F.when((text == "") | (text == null_text), None).otherwise(text)
        if field.name in bits:
            value = F.when(text.isin("\\1", "\x01"), True).when(text.isin("\\0", "\x00", "0"), False)
        elif isinstance(field.dataType, T.DateType):
            value = F.coalesce(text.try_cast("date"), F.regexp_replace(text, "/", "-").try_cast("date"))
        elif isinstance(field.dataType, T.StringType):
            value = text
        else:
            value = text.try_cast(field.dataType)
            if sentinels:
                value = F.when(~value.isin(list(sentinels)), value)
        cols.append(value.alias(field.name))
    if keep_corrupt:
        cols.append(F.col(CORRUPT))
    return raw.select(*cols)


def compact_date(col) -> Column:
    """``yyyymmdd`` number to a date; an impossible day such as 00 gives NULL."""
    return F.try_to_date(F.col(col).cast("string") if isinstance(col, str) else col, "yyyyMMdd")


def starred_number(col) -> Column:
    """``0.448***`` and ``?0.025`` (a lost minus sign) to numbers."""
    text = F.regexp_replace(F.col(col) if isinstance(col, str) else col, r"\*", "")
    return F.regexp_replace(text, r"^\?", "-").try_cast("double")


def star_level(col) -> Column:
    """Number of stars after a value."""
    return F.length(F.regexp_extract(F.col(col) if isinstance(col, str) else col, r"(\**)$", 1))


def read_tsv(spark: SparkSession, path: str, schema: T.StructType | str) -> DataFrame:
    """Tab separated text with quoting off."""
    return spark.read.schema(schema).option("header", True).option("sep", "\t").option("quote", "").csv(path)


def read_json(spark: SparkSession, path: str, schema: T.StructType | str | None = None,
              multi_line: bool = True) -> DataFrame:
    """JSON records; ``multi_line`` reads one array per file."""
    reader = spark.read.option("multiLine", multi_line)
    return (reader.schema(schema) if schema is not None else reader).json(path)


def read_transactions(spark: SparkSession, path: str, sep: str = "\t") -> DataFrame:
    """One basket per line as ``items``; an empty line is a basket with one empty item."""
    import re
    return spark.read.text(path).select(F.split("value", re.escape(sep)).alias("items"))
