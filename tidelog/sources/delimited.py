"""Event text: one row per line, fields and map entries delimited.

Interchange only.  Map text does not escape its separators, so maps that hold
them do not survive; Parquet keeps native types.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidelog.functions import text
from tidelog.operators.mapping import cast_sql

# fixed values: separators of the text form
FIELD, ROW = "\x01", "\n"


def to_lines(df: DataFrame) -> DataFrame:
    """One column ``value``: the row as a line; NULL becomes empty text."""

    def cell(f: T.StructField):
        c = text.map_to_string(f.name) if isinstance(f.dataType, T.MapType) else F.col(f.name).cast("string")
        return F.coalesce(text.sanitize(c), F.lit(""))

    return df.select(F.concat_ws(FIELD, *(cell(f) for f in df.schema)).alias("value"))


def write_delimited(df: DataFrame, path: str, mode: str = "errorifexists") -> None:
    to_lines(df).write.mode(mode).option("lineSep", ROW).text(path)


def scan_delimited(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """Read event text by position; numbers that do not parse are NULL.

    Every line is a row, an empty one too.  A line with too few fields has empty
    ones at its end; more than the schema has are left out.
    """
    fields = F.split("value", FIELD, -1)
    lines = spark.read.option("lineSep", ROW).text(path)
    filled = lines.select(*(F.coalesce(F.get(fields, F.lit(i)), F.lit("")).alias(f.name) for i, f in enumerate(schema)))
    return filled.selectExpr(*(f"{cast_sql(f.name, T.StringType(), f.dataType)} as `{f.name}`" for f in schema))
