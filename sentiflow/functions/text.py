"""Column expressions over review text. All are built-in JVM expressions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .fixed_values import ENGLISH_STOPWORDS


def as_column(col: Column | str) -> Column:
    return F.col(col) if isinstance(col, str) else col


def with_computed(df: DataFrame, name: str, col: Column) -> DataFrame:
    """Add a costly column so that it is computed once per row.

    The expression goes through a one-element explode. Filters on the new column then stay above it;
    below a plain projection the optimizer would move them, and compute the expression once more for
    the filter, or for every element when it is used inside a lambda.
    """
    others = [F.col(f"`{c}`") for c in df.columns if c != name]
    return df.select(*others, F.explode(F.array(col)).alias(name))


def clean_text(col: Column | str, mode: str = "trimmed") -> Column:
    """Lower-case ASCII words separated by single spaces.

    ``trimmed`` (default): NULL becomes ``""``, text is lower-cased first and the ends are trimmed.
    ``spark``: letters are selected before lower-casing, the ends keep their space, NULL stays NULL.

    Replacing each run of non-letters by one space is the same as blanking every character that is
    neither letter nor whitespace and then collapsing whitespace, in one regex pass instead of two.
    """
    text = as_column(col)
    if mode == "trimmed":
        return F.trim(F.regexp_replace(F.lower(F.coalesce(text, F.lit(""))), "[^a-z]+", " "))
    if mode == "spark":
        return F.lower(F.regexp_replace(text, "[^a-zA-Z]+", " "))
    raise ValueError(f"unknown cleaning mode: {mode!r}")


def tokens(col: Column | str) -> Column:
    """Tokens of a cleaned text."""
    return F.split(as_column(col), " ")


def remove_stopwords(col: Column | str, words: list[str] | None = None) -> Column:
    """Tokens of an array that are not in ``words`` (default: English stop words), in order."""
    words = ENGLISH_STOPWORDS if words is None else words
    return F.filter(as_column(col), lambda token: ~token.isin(*words))
