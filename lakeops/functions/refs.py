"""Three-part table references in SQL text."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# What counts as a name part, and the words that rule a match out.
QUOTED, BARE = r'"[^"]+"', r"[A-Z_][A-Z0-9_]*"
SQL_KEYWORDS = (
    "SELECT", "FROM", "WHERE", "JOIN", "ON", "AND", "OR", "NOT", "AS", "WITH", "UNION",
    "GROUP", "ORDER", "BY", "HAVING", "LIMIT", "DISTINCT", "CASE", "WHEN", "THEN", "ELSE", "END",
    "LEFT", "RIGHT", "INNER", "OUTER", "FULL", "CROSS", "INTO", "INSERT", "UPDATE", "DELETE",
)

# A bare part holds no dot, so it is matched whole or not at all (possessive),
# and a name is only looked for where a word begins.
THREE_PART_NAME = rf"(?i)(?:{QUOTED}|(?<![A-Z_]){BARE}+)" + rf"\.(?:{QUOTED}|{BARE}+)" * 2
# A dot with an even number of quotes after it stands between parts.
DOT_OUTSIDE_QUOTES = r'\.(?=(?:[^"]*"[^"]*")*[^"]*$)'


def references(text: Column) -> Column:
    """Distinct references of one text, as an array of (ref_db, ref_schema, ref_table)."""

    def bare(part: Column) -> Column:
        return F.upper(F.replace(part, F.lit('"'), F.lit("")))

    def as_struct(parts: Column) -> Column:
        names = ("ref_db", "ref_schema", "ref_table")
        return F.struct(*[bare(parts[i]).alias(name) for i, name in enumerate(names)])

    matches = F.regexp_extract_all(text, F.lit(THREE_PART_NAME), F.lit(0))
    split = F.transform(F.array_distinct(matches), lambda m: F.split(m, DOT_OUTSIDE_QUOTES))
    return F.array_distinct(F.transform(split, as_struct))


def extract_refs(df: DataFrame, id_cols: Sequence[str], text_col: str) -> DataFrame:
    """One row per reference of each input row.

    A row's references come from its own text alone, so duplicates are removed
    inside the row and nothing is shuffled.
    """
    exploded = df.select(*id_cols, F.explode(references(F.col(text_col))).alias("_ref"))
    parts = exploded.select(*id_cols, "_ref.ref_db", "_ref.ref_schema", "_ref.ref_table")
    is_syntax = F.lit(False)
    for part in ("ref_db", "ref_schema", "ref_table"):
        is_syntax = is_syntax | F.col(part).isin(*SQL_KEYWORDS)
    return parts.filter(~is_syntax)
