"""Reviews as documents, written by any Spark data source."""

from __future__ import annotations

import re
from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def to_documents(df: DataFrame) -> DataFrame:
    """One JSON record per row in column ``document``; NULL fields are kept."""
    row = F.struct(*(F.col(f"`{c}`") for c in df.columns))
    return df.select(F.to_json(row, {"ignoreNullFields": "false"}).alias("document"))


def write_documents(
    df: DataFrame,
    fmt: str = "json",
    options: Mapping[str, str] | None = None,
) -> None:
    """Replace a document collection with the rows of ``df``, written in parallel.

    ``fmt`` and ``options`` are those of the caller's connector (``json`` needs ``path``).
    """
    options = {"ignoreNullFields": "false", **(options or {})} if fmt == "json" else dict(options or {})
    df.write.format(fmt).options(**options).mode("overwrite").save()


def to_variant_documents(df: DataFrame) -> DataFrame:
    """One typed document per row in column ``document``, a ``VARIANT``. NULL fields are kept.

    Numbers, dates and nested values keep their types, which JSON text does not. Columns of one name
    cannot be told apart in a document and are refused.
    """
    repeated = {c for c in df.columns if df.columns.count(c) > 1}
    if repeated:
        raise ValueError(f"repeated columns {sorted(repeated)}")
    columns = {f.name: F.col("`" + f.name.replace("`", "``") + "`") for f in df.schema}
    # A column without a type holds NULL only, and has no variant.
    untyped = {f.name for f in df.schema if isinstance(f.dataType, T.NullType)}
    row = F.struct(*((c.cast("string") if name in untyped else c).alias(name) for name, c in columns.items()))
    return df.select(F.to_variant_object(row).alias("document"))


def from_variant_documents(documents: DataFrame, schema: T.StructType | None = None) -> DataFrame:
    """Documents as rows, without a declared schema: the fields are those that occur in any document.

    They are found by one aggregation, whose result is as large as the list of different fields. A
    field that is of several types stays ``VARIANT``, one that is NULL throughout is text; absent ones
    are NULL. With ``schema`` fields are taken as declared, and values that do not fit are NULL. No
    documents, or only NULL ones, have no fields.
    """
    if schema is None:
        found = documents.agg(F.schema_of_variant_agg("document")).first()[0]
        schema = _struct(found)
    if not schema.fields:
        return documents.select()
    return documents.select(F.try_variant_get("document", "$", _ddl(schema)).alias("row")).select("row.*")


# A quoted name, or a word of the description that types have another word for.
_WORDS = re.compile(r"`(?:[^`]|``)*`|\bOBJECT<|\bVOID\b")


def _struct(description: str) -> T.StructType:
    words = {"OBJECT<": "STRUCT<", "VOID": "STRING"}
    kind = T.DataType.fromDDL(_WORDS.sub(lambda m: words.get(m[0], m[0]), description))
    return kind if isinstance(kind, T.StructType) else T.StructType()


def _ddl(kind: T.DataType) -> str:
    if isinstance(kind, T.StructType):
        return "STRUCT<" + ", ".join("`" + f.name.replace("`", "``") + "`: " + _ddl(f.dataType) for f in kind) + ">"
    if isinstance(kind, T.ArrayType):
        return f"ARRAY<{_ddl(kind.elementType)}>"
    return kind.simpleString()
