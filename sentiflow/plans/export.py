"""Export only: clean the reviews and replace a document collection."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame

from ..operators.prepare import clean_reviews
from ..sinks.documents import write_documents


def export_reviews(
    reviews: DataFrame,
    fmt: str = "json",
    options: Mapping[str, str] | None = None,
) -> None:
    """All cleaned, labelled reviews to a document sink, in one narrow stage."""
    write_documents(clean_reviews(reviews), fmt, options)
