"""Mapping file: which source database goes to which destination catalog."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def clean_mapping(
    df: DataFrame, source_col: str = "source_database", dest_col: str = "destination_catalog"
) -> DataFrame:
    """Trim and lower-case the header, check it, and drop pairs with a blank side.

    Values keep their blanks. Only empty and blank texts are missing: a database
    named ``NA`` or ``null`` stays.
    """
    df = df.toDF(*[c.strip().lower() for c in df.columns])
    missing = {source_col, dest_col} - set(df.columns)
    if missing:
        raise ValueError(f"mapping lacks columns: {sorted(missing)}")
    filled = F.col(source_col).rlike(r"(?U)\S") & F.col(dest_col).rlike(r"(?U)\S")
    return df.select(source_col, dest_col).filter(filled)


def read_mapping(
    spark: SparkSession, path: str, source_col: str = "source_database", dest_col: str = "destination_catalog"
) -> DataFrame:
    """Mapping from a CSV file with a header; every column is text."""
    return clean_mapping(spark.read.csv(path, header=True, inferSchema=False), source_col, dest_col)
