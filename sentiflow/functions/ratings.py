"""Star ratings and sentiment classes as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .fixed_values import RATINGS_BY_CLASS, SENTIMENTS, UNKNOWN_SENTIMENT
from .text import as_column


def rating_value(col: Column | str = "Rating") -> Column:
    """Rating as a double; anything that is not a number is NULL, also under ANSI mode."""
    return as_column(col).try_cast("double")


def is_valid_rating(col: Column | str = "Rating") -> Column:
    """True for 1..5, false for any other number, NULL when there is no number."""
    return rating_value(col).isin(*(r for stars in RATINGS_BY_CLASS.values() for r in stars))


def label_from_rating(col: Column | str = "Rating") -> Column:
    """Class id of a rating; NULL when the rating belongs to no class."""
    rating = rating_value(col)
    label = F.lit(None).cast("double")
    for class_id, stars in RATINGS_BY_CLASS.items():
        label = F.when(rating.isin(*stars), F.lit(class_id)).otherwise(label)
    return label


def sentiment_name(col: Column | str = "label") -> Column:
    """Class name of a class id, ``Unknown`` for any other id."""
    pairs = [F.lit(x) for pair in SENTIMENTS.items() for x in pair]
    return F.coalesce(F.try_element_at(F.create_map(*pairs), as_column(col)), F.lit(UNKNOWN_SENTIMENT))
