"""Semicolon-separated files with decimal commas and ``NA`` for null."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

TIMESTAMP_FORMAT = "yyyy/MM/dd HH:mm:ss"
DATE_FORMAT = "yyyy-MM-dd"
MONTH_FORMAT = "MMM yyyy"
ROW_NUMBER = "_row"

# Portuguese month abbreviations, January to December.
MONTH_NAMES_PT = (
    "jan", "fev", "mar", "abr", "mai", "jun",
    "jul", "ago", "set", "out", "nov", "dez",
)


def month_from_name(text: Column) -> Column:
    """'mai 2018' to 2018-05-01, independent of the JVM locale."""
    names = F.array(*[F.lit(name) for name in MONTH_NAMES_PT])
    name = F.lower(F.substring(F.trim(text), 1, 3))
    number = F.array_position(names, name).cast("int")
    year = F.element_at(F.split(F.trim(text), r"\s+"), -1).cast("int")
    return F.when(text.isNotNull(), F.make_date(year, number, F.lit(1)))


def month_to_name(day: Column) -> Column:
    names = F.array(*[F.lit(name) for name in MONTH_NAMES_PT])
    return F.concat_ws(" ", F.element_at(names, F.month(day)), F.year(day).cast("string"))


def _parse(field: T.StructField, date_format: str, timestamp_format: str) -> Column:
    text = F.col(field.name)
    if isinstance(field.dataType, T.DoubleType):
        parsed = F.replace(text, F.lit(","), F.lit(".")).cast("double")
    elif isinstance(field.dataType, T.TimestampType):
        parsed = F.to_timestamp(text, timestamp_format)
    elif isinstance(field.dataType, T.DateType) and date_format == MONTH_FORMAT:
        parsed = month_from_name(text)
    elif isinstance(field.dataType, T.DateType):
        parsed = F.to_date(text, date_format)
    else:
        parsed = text.cast(field.dataType)
    return parsed.alias(field.name)


def _render(field: T.StructField, date_format: str, timestamp_format: str) -> Column:
    value = F.col(field.name)
    if isinstance(field.dataType, (T.DoubleType, T.FloatType, T.DecimalType)):
        text = F.replace(value.cast("string"), F.lit("."), F.lit(","))
    elif isinstance(field.dataType, (T.TimestampType, T.TimestampNTZType)):
        text = F.date_format(value, timestamp_format)
    elif isinstance(field.dataType, T.DateType) and date_format == MONTH_FORMAT:
        text = month_to_name(value)
    elif isinstance(field.dataType, T.DateType):
        text = F.date_format(value, date_format)
    elif isinstance(field.dataType, T.BooleanType):
        text = F.upper(value.cast("string"))
    else:
        text = value.cast("string")
    return text.alias(field.name)


def read_csv2(
    spark: SparkSession,
    path: str,
    schema: T.StructType,
    *,
    row_number: bool = False,
    date_format: str = DATE_FORMAT,
    timestamp_format: str = TIMESTAMP_FORMAT,
    partition_by: tuple[str, ...] = (),
) -> DataFrame:
    """Read with a declared schema; a header or value that does not fit fails.

    With ``row_number`` the first column is a nameless row counter and is
    skipped; the header check is then positional.  ``partition_by`` names the
    text columns that stand in the folder names below ``path``.
    """
    names = ([ROW_NUMBER] if row_number else []) + schema.names + list(partition_by)
    raw = T.StructType([T.StructField(name, T.StringType()) for name in names])
    text = (
        spark.read.schema(raw)
        .option("sep", ";")
        .option("header", True)
        .option("nullValue", "NA")
        .option("mode", "FAILFAST")
        .option("enforceSchema", row_number)
        .csv(path)
    )
    columns = [_parse(f, date_format, timestamp_format) for f in schema.fields]
    return text.select(*columns, *partition_by)


def write_csv2(
    df: DataFrame,
    path: str,
    *,
    row_number: str | None = None,
    date_format: str = DATE_FORMAT,
    timestamp_format: str = TIMESTAMP_FORMAT,
    partition_by: tuple[str, ...] = (),
) -> None:
    """Overwrite ``path``; ``row_number`` names a column written first, unlabelled."""
    fields = [f for f in df.schema.fields if f.name not in partition_by and f.name != row_number]
    columns = [_render(f, date_format, timestamp_format) for f in fields]
    if row_number:
        columns.insert(0, F.col(row_number).cast("string").alias(ROW_NUMBER))
    text = df.select(*columns, *partition_by)
    if partition_by:
        text = text.repartition(*partition_by)
    writer = (
        text.write.mode("overwrite")
        .option("sep", ";")
        .option("header", True)
        .option("nullValue", "NA")
    )
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.csv(path)


def write_series(series: DataFrame, path: str) -> None:
    """Daily and monthly series of every cluster as one partitioned table.

    Each folder is written by one task, so that it holds one file.
    """
    series.repartition("grain", "cluster").write.mode("overwrite").partitionBy("grain", "cluster").parquet(path)
