"""Rewriting of SQL definition text, as column expressions.

Source and destination names may be columns or plain strings, so one plan
rewrites the definitions of every database at once.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakeops.functions.calls import translate_functions

# (?U): word characters of every script, not only ASCII.
_BLANK = r"(?U)^\s+|\s+$"
_PART = r'(?:"[^"]*"|`[^`]*`|[\w$]+)'
# Runs, not single characters: the regex engine goes one call deeper per repetition.
_COLUMN_LIST = r"\((?:[^()']++|'[^']*+'|\([^()]*+\))*+\)"
VIEW_PREFIX = (
    r"(?isU)^\s*CREATE\s+(?:OR\s+REPLACE\s+)?(?:SECURE\s+)?(?:RECURSIVE\s+)?VIEW\s+"
    rf"{_PART}(?:\.{_PART})*\s*({_COLUMN_LIST})?\s*(?:WITH\s+SCHEMA(?:\s+TYPE)?\s+\w+\s+)?(?<=[\s)])AS\b\s*"
)


def _as_col(value: Column | str) -> Column:
    return F.lit(value) if isinstance(value, str) else value


def _literal(name: Column) -> Column:
    """Regex matching exactly this text."""
    return F.concat(F.lit(r"\Q"), F.replace(name, F.lit(r"\E"), F.lit(r"\E\\E\Q")), F.lit(r"\E"))


def _replacement(name: Column) -> Column:
    """Replacement text with the regex engine's own marks escaped."""
    return F.replace(F.replace(name, F.lit("\\"), F.lit("\\\\")), F.lit("$"), F.lit("\\$"))


def rewrite_backtick(text: Column, src: Column | str, dst: Column | str) -> Column:
    """Repoint a catalog in back-quote dialect and make CREATE VIEW repeatable."""
    src, dst = _as_col(src), _as_col(dst)
    tick = F.lit("`")
    quoted = F.replace(text, F.concat(tick, src, tick), F.concat(tick, dst, tick))
    bare = F.regexp_replace(
        quoted,
        F.concat(F.lit(r"(?U)(?<![\w`])"), _literal(src), F.lit(r"\.")),
        F.concat(_replacement(dst), F.lit(".")),
    )
    return F.regexp_replace(bare, r"(?iU)^\s*CREATE\s+VIEW", "CREATE OR REPLACE VIEW")


def rewrite_dquote(text: Column, src: Column | str, dst: Column | str) -> Column:
    """Repoint a database in double-quote dialect: as given, lower and upper case.

    One alternation instead of a pass per spelling, so a destination that holds
    the source name is never rewritten twice.
    """
    src, dst = _as_col(src), F.lower(_as_col(dst))
    spellings = F.concat(
        F.lit("(?:"), F.concat_ws("|", _literal(src), _literal(F.lower(src)), _literal(F.upper(src))), F.lit(")")
    )
    bare = F.regexp_replace(
        text,
        F.concat(F.lit(r'(?U)(?<![\w"])'), spellings, F.lit(r"\.")),
        F.concat(_replacement(dst), F.lit(".")),
    )
    return F.regexp_replace(
        bare,
        F.concat(F.lit('"'), spellings, F.lit(r'"\.')),
        F.concat(F.lit('"'), _replacement(dst), F.lit('".')),
    )


def with_rewritten(df: DataFrame, out: str, text: Column, src: Column | str, dst: Column | str) -> DataFrame:
    """Add ``out``: the text repointed, and with the calls translated that Spark spells differently.

    In two steps, so the repointed text is computed once and not at each of the
    places where the translation reads it.
    """
    return df.withColumn(out, rewrite_dquote(text, src, dst)).withColumn(out, translate_functions(F.col(out)))


def with_procedure_body(df: DataFrame, out: str, text: Column, src: Column | str, dst: Column | str) -> DataFrame:
    """Add ``out``: procedure text for the destination; null and empty text stay as they are."""
    rewritten = with_rewritten(df, out, text, src, dst)
    return rewritten.withColumn(out, F.regexp_replace(out, r"(?i)\bEXECUTE\s+AS\s+(CALLER|OWNER)\b", ""))


def select_body(text: Column) -> Column:
    """The query of a view definition; text without a CREATE VIEW prefix stays whole."""
    return F.regexp_replace(F.regexp_replace(text, VIEW_PREFIX, ""), _BLANK, "")


def view_columns(text: Column) -> Column:
    """Column list of a view definition with its parentheses, null when it names none."""
    found = F.regexp_extract(text, VIEW_PREFIX, 1)
    return F.when(found != "", found)


def sql_text(text: Column) -> Column:
    """Escape text for a single-quoted SQL literal."""
    return F.replace(text, F.lit("'"), F.lit("''"))
