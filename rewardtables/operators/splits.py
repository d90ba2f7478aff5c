"""Reproducible splits: a row's side is a hash of (seed, key), nothing else.

Neither needs a shuffle, and retries or another partitioning give the same rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rewardtables.constants import TEST_SIZE
from rewardtables.functions.hashing import key_hash, key_unit


def kfold(df: DataFrame, key: str, k: int, seed: int = 42, out: str = "fold") -> DataFrame:
    """Add the fold number 0 … k−1."""
    if k < 1:
        raise ValueError("k must be at least 1")
    return df.withColumn(out, (key_hash(seed, F.col(key)) % F.lit(k)).cast("int"))


def holdout(
    df: DataFrame, key: str, test_size: float = TEST_SIZE, seed: int = 42, out: str = "split"
) -> DataFrame:
    """Add ``train`` or ``test``; about ``test_size`` of the keys are test."""
    if not 0.0 <= test_size <= 1.0:
        raise ValueError("test_size must lie in [0, 1]")
    is_test = key_unit(seed, F.col(key)) < F.lit(float(test_size))
    return df.withColumn(out, F.when(is_test, F.lit("test")).otherwise(F.lit("train")))


def load_split(
    df: DataFrame,
    key: str,
    split: str,
    test_size: float = TEST_SIZE,
    k_folds: int = 1,
    fold_index: int = 0,
    seed: int = 42,
) -> DataFrame:
    """Rows of one side: fold ``fold_index`` against the rest for several folds, else a hold-out."""
    if split not in ("train", "test"):
        raise ValueError("split must be 'train' or 'test'")
    if k_folds > 1:
        if not 0 <= fold_index < k_folds:
            raise ValueError("fold_index must lie in [0, k_folds)")
        is_test = key_hash(seed, F.col(key)) % F.lit(k_folds) == F.lit(fold_index)
    else:
        is_test = key_unit(seed, F.col(key)) < F.lit(float(test_size))
    return df.where(is_test if split == "test" else ~is_test)


def fold_sides(
    df: DataFrame, key: str, k_folds: int, fold_index: int, seed: int = 42, out: str = "side"
) -> DataFrame:
    """Add the side that ``load_split`` puts each row on: both sides in one pass."""
    if not 0 <= fold_index < k_folds:
        raise ValueError("fold_index must lie in [0, k_folds)")
    is_test = key_hash(seed, F.col(key)) % F.lit(k_folds) == F.lit(fold_index)
    return df.withColumn(out, F.when(is_test, F.lit("test")).otherwise(F.lit("train")))
