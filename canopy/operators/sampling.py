"""Train / test splitting."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from canopy.functions.columns import hash_bucket

SPLIT_SEED = 18  # fixed value: the seed of the 70/30 random split


def in_training(key: str | Column, train_percent: int = 70, modulus: int = 100) -> Column:
    """The one rule of the keyed split; never null."""
    return hash_bucket(key, modulus) < train_percent


def split_train_test(
    df: DataFrame, key: str | Column, train_percent: int = 70, modulus: int = 100
) -> tuple[DataFrame, DataFrame]:
    """Keyed split: ``md5`` bucket of ``key`` below ``train_percent`` → training.

    Deterministic under any partitioning, task retry or executor loss, and
    equal keys (null among them) always land on the same side, so the sides
    add up to the input.  Each side is a filter over the same plan, pushed
    into the scan.
    """
    training = in_training(key, train_percent, modulus)
    return df.where(training), df.where(~training)


def with_side(
    df: DataFrame, key: str | Column, train_percent: int = 70, modulus: int = 100, name: str = "side"
) -> DataFrame:
    """Tag each row ``'train'`` / ``'test'`` by the same rule as ``split_train_test``."""
    training = in_training(key, train_percent, modulus)
    return df.withColumn(name, F.when(training, F.lit("train")).otherwise(F.lit("test")))


def random_split(df: DataFrame, weights=(0.7, 0.3), seed: int = SPLIT_SEED) -> list[DataFrame]:
    """Spark's ``randomSplit`` (compatibility option; depends on partitioning)."""
    return df.randomSplit(list(weights), seed)
