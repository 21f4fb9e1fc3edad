"""Bookings as CSV files with a header row."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from ..session import SPLIT_BYTES, splits_of
from .booking_schema import NULL_TOKENS, RAW_COLUMNS

WHOLE_NUMBER = r"^\s*([+-]?\d+)(?:\.0*)?\s*$"  # also written with a decimal point, as columns with gaps are


def _text_columns(spark: SparkSession, path: str, wanted: list[str]) -> DataFrame:
    """The wanted columns as text, found by their names in the header.

    The order of the columns is taken from the first file. A file with another order fails when it is read, and so does a
    missing column; columns that are not wanted are ignored.
    """
    header = spark.read.csv(path, header=True, inferSchema=False).columns
    missing = [name for name in wanted if name not in header]
    if missing:
        raise ValueError(f"columns not in the header: {missing}")
    schema = T.StructType([T.StructField(name, T.StringType()) for name in header])
    return spark.read.schema(schema).csv(path, header=True, enforceSchema=False, mode="FAILFAST").select(*wanted)


def _value(name: str, kind: str, date_format: str) -> Column:
    """A cell's value: null for a null token, and for text that is no value of the column's kind."""
    text = F.when(~F.col(name).isin(NULL_TOKENS), F.col(name))
    if kind == "string":
        return text
    if kind == "double":
        number = F.trim(text).try_cast("double")
        return F.when(~F.isnan(number), number)
    if kind == "date":
        return F.try_to_date(text, date_format)
    return F.nullif(F.regexp_extract(text, WHOLE_NUMBER, 1), F.lit("")).try_cast("int" if kind == "int" else "bigint")


def _kinds(extra: tuple[str, ...]) -> dict[str, str]:
    return {**RAW_COLUMNS, **dict.fromkeys(extra, "long")}


def read_booking_csv(
    spark: SparkSession, path: str, extra: tuple[str, ...] = (), date_format: str = "yyyy-MM-dd"
) -> DataFrame:
    """Read raw bookings from CSV by the names in the header; ``extra`` names whole-number columns besides the 32 raw ones.

    Whole numbers are read digit by digit, so identifiers of any size keep their value; ``9.0`` is 9. A cell that holds
    no value of its column's kind, such as ``3.7`` among whole numbers, becomes null and leaves its row as it is;
    :func:`damaged_cells` counts those. Only the columns a query asks for are parsed.
    """
    kinds = _kinds(extra)
    cells = _text_columns(spark, path, list(kinds))
    return cells.select([_value(name, kind, date_format).alias(name) for name, kind in kinds.items()])


def damaged_cells(
    spark: SparkSession, path: str, extra: tuple[str, ...] = (), date_format: str = "yyyy-MM-dd"
) -> DataFrame:
    """Per column: cells with text that is neither a null token nor a value of the column's kind."""
    kinds = _kinds(extra)
    cells = _text_columns(spark, path, list(kinds))
    lost = [F.count_if(~F.col(name).isin(NULL_TOKENS) & _value(name, kind, date_format).isNull()).alias(name) for name, kind in kinds.items()]
    lines = F.array(*[F.struct(F.lit(name).alias("column_name"), F.col(name).alias("damaged")) for name in kinds])
    return cells.agg(*lost).select(F.inline(lines))


def write_booking_csv(df: DataFrame, path: str) -> None:
    """Write bookings as compressed CSV with a header; a missing value is written as ``NULL``. A file is as large as the
    split it is made of, and read by one task."""
    with splits_of(df.sparkSession, SPLIT_BYTES):
        df.write.mode("overwrite").csv(path, header=True, nullValue="NULL", compression="gzip")
