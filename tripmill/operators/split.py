"""Train/test splits and fold numbers.

The hash forms decide each row from its key alone: the sides stay the same whatever the
partitioning is, and a lost task recomputes the same rows. random_split is Spark's own sampler;
it sorts every partition first and its sides depend on the partitioning.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripmill.functions.scalars import hash_bucket

TRAIN_PERCENT = 66


def hash_split(
    df: DataFrame, key: str = "id", train_percent: int = TRAIN_PERCENT, salt: str = ""
) -> tuple[DataFrame, DataFrame]:
    """(train, test) by key hash. Another salt gives an independent split (inner validation)."""
    bucket = hash_bucket(key, 100, salt)
    return df.filter(bucket < train_percent), df.filter(bucket >= train_percent)


def with_side(df: DataFrame, key: str = "id", salt: str = "inner", name: str = "inner") -> DataFrame:
    """Add whether a row is on the fitting side of the inner split, to be kept with the rows."""
    return df.withColumn(name, hash_bucket(key, 100, salt) < TRAIN_PERCENT)


def random_split(
    df: DataFrame, train_share: float = TRAIN_PERCENT / 100, seed: int = 0
) -> tuple[DataFrame, DataFrame]:
    """(train, test) by Spark's seeded sampler."""
    train, test = df.randomSplit([train_share, 1 - train_share], seed=seed)
    return train, test


def with_fold(
    df: DataFrame, folds: int, key: str = "id", salt: str = "fold", name: str = "fold"
) -> DataFrame:
    """Add a fold number 0..folds-1 by key hash."""
    return df.withColumn(name, hash_bucket(key, folds, salt).cast("int"))


def split_cover(whole: DataFrame, parts: list[DataFrame]) -> DataFrame:
    """(n_rows, n_split, same_rows): whether the parts hold exactly the rows of the whole.

    Compares counts and order-free sums of row hashes, so nothing is shuffled by key.
    """

    def digest(df: DataFrame) -> DataFrame:
        row = F.xxhash64(*df.columns).cast("decimal(38,0)")
        return df.agg(F.count("*").alias("n"), F.sum(row).alias("h"))

    pieces = digest(parts[0])
    for part in parts[1:]:
        pieces = pieces.union(digest(part))
    pieces = pieces.agg(F.sum("n").alias("n_split"), F.sum("h").alias("h_split"))
    total = digest(whole).select(F.struct("n", "h")).scalar()
    return pieces.select(
        total["n"].alias("n_rows"), "n_split", (F.col("h_split") == total["h"]).alias("same_rows")
    )
