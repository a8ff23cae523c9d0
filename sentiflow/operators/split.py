"""Reproducible train/test splits."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions.fixed_values import SEED, TRAIN_SHARE
from ..functions.hashing import key_hash, leading_bits

_STEPS = 10_000
_BUCKET_DIGITS = 4  # 65,536 buckets


def with_hash_split(
    df: DataFrame, key: str = "review_id", train: float = TRAIN_SHARE, seed: int = SEED
) -> DataFrame:
    """Add ``split`` (train/test). A narrow projection of the key: no shuffle, any partitioning."""
    bucket = leading_bits(key_hash(key, seed), 8) % _STEPS
    return df.withColumn("split", F.when(bucket < round(train * _STEPS), "train").otherwise("test"))


def hash_split(
    df: DataFrame, key: str = "review_id", train: float = TRAIN_SHARE, seed: int = SEED
) -> tuple[DataFrame, DataFrame]:
    """``(train, test)``."""
    return train_and_test(with_hash_split(df, key, train, seed))


def with_stratified_split(
    df: DataFrame,
    label: str = "label",
    key: str = "review_id",
    train: float = TRAIN_SHARE,
    seed: int = SEED,
) -> DataFrame:
    """Add ``split`` so that exactly ``ceil((1 - train) * n)`` rows of each class are test rows.

    Classes are the labels that occur, whatever they are; rows without a label are one class. Keys
    that occur repeatedly go to one side together.
    """
    last = split_thresholds(df, label, key, train, seed)
    return with_fitted_split(df, last, label, key, train, seed)


def split_thresholds(
    df: DataFrame,
    label: str = "label",
    key: str = "review_id",
    train: float = TRAIN_SHARE,
    seed: int = SEED,
) -> DataFrame:
    """Where the test rows of each class of ``df`` end: ``class`` and ``last``, the hash and key of the
    last one. One row for each class.

    Stored, they split later rows as well (``with_fitted_split``): a row's side depends on its own
    class and key alone, so nothing that is added moves a row that is there.
    """
    share = round(1 - train, 10)
    return _last_by_hash(df, label, key, seed, lambda n: F.ceil(F.round(n * F.lit(share), 6)))


def with_fitted_split(
    df: DataFrame,
    thresholds: DataFrame,
    label: str = "label",
    key: str = "review_id",
    train: float = TRAIN_SHARE,
    seed: int = SEED,
) -> DataFrame:
    """Add ``split`` by the ``split_thresholds`` of a first batch, with its ``key`` and ``seed``.

    The first batch gets exactly its quotas, and later rows of its classes close to that share. Rows
    of classes it did not have go by the hash alone, as in ``with_hash_split``. ``df`` is not shuffled.
    """
    here = F.struct(key_hash(key, seed).alias("_hash"), F.col(key).alias("_key"))
    known = F.broadcast(thresholds.select(F.col("class").alias("_of"), F.col("last").alias("_last"), F.lit(True).alias("_known")))
    by_hash = leading_bits(key_hash(key, seed), 8) % _STEPS >= round(train * _STEPS)
    test = F.when(F.col("_known"), here <= F.col("_last")).otherwise(by_hash)
    joined = df.join(known, F.col(label).eqNullSafe(F.col("_of")), "left")
    return joined.withColumn("split", F.when(test, "test").otherwise("train")).select(*(F.col(f"`{c}`") for c in df.columns), "split")


def stratified_split(
    df: DataFrame,
    label: str = "label",
    key: str = "review_id",
    train: float = TRAIN_SHARE,
    seed: int = SEED,
) -> tuple[DataFrame, DataFrame]:
    """``(train, test)``."""
    return train_and_test(with_stratified_split(df, label, key, train, seed))


def train_and_test(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The two parts of a table with a ``split`` column."""
    return (
        df.filter(F.col("split") == "train").drop("split"),
        df.filter(F.col("split") == "test").drop("split"),
    )


def _last_by_hash(
    df: DataFrame, label: str, key: str, seed: int, quota: Callable[[Column], Column]
) -> DataFrame:
    """The last of the ``quota(n)`` rows of each class with the lowest hash: ``class`` and ``last``.

    Ranking a whole class would put it in one task. Instead a histogram of the leading hash digits
    finds the bucket in which each class reaches its quota, and only the rows of that bucket, one
    65,536th of the class, are ranked. The table joined back has one row per class id, and ``df``
    itself is never shuffled.
    """
    keyed = df.select(
        F.col(label).alias("_class"), F.col(key).alias("_key"), key_hash(key, seed).alias("_hash")
    ).withColumn("_bucket", leading_bits(F.col("_hash"), _BUCKET_DIGITS))

    whole = W.partitionBy("_class")
    sizes = keyed.groupBy("_class", "_bucket").agg(F.count(F.lit(1)).alias("_n"))
    running = sizes.select(
        "_class",
        "_bucket",
        quota(F.sum("_n").over(whole)).cast("bigint").alias("_quota"),
        F.sum("_n").over(whole.orderBy("_bucket")).alias("_upto"),
        "_n",
    )
    edge = running.filter(
        (F.col("_upto") >= F.col("_quota")) & (F.col("_upto") - F.col("_n") < F.col("_quota"))
    ).select(
        F.col("_class").alias("_of"),
        F.col("_bucket").alias("_in"),
        (F.col("_quota") - F.col("_upto") + F.col("_n")).alias("_left"),
    )

    rank = F.row_number().over(whole.orderBy("_hash", "_key"))
    return (
        keyed.join(F.broadcast(edge), F.col("_class").eqNullSafe(F.col("_of")) & (F.col("_bucket") == F.col("_in")))
        .withColumn("_rank", rank)
        .filter(F.col("_rank") == F.col("_left"))
        .select(F.col("_of").alias("class"), F.struct("_hash", "_key").alias("last"))
    )
