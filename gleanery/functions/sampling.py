"""Bernoulli sampling by a hash of the row key.

Unlike ``DataFrame.sample`` the choice depends on the key only, so it is the same
after a lost task is run again and on any number of partitions.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def in_sample(keys: list[str], fraction: float, seed: int) -> Column:
    if fraction >= 1.0:
        return F.lit(True)
    draw = F.md5(F.concat_ws(":", F.lit(str(seed)), *[F.col(k).cast("string") for k in keys]))
    return F.substring(draw, 1, 8) < F.lit(hash_threshold(fraction))


def hash_threshold(fraction: float) -> str:
    return format(int(max(fraction, 0.0) * (1 << 32)), "08x")


def sample_by_key(df: DataFrame, keys: list[str], fraction: float, seed: int = 1) -> DataFrame:
    return df.filter(in_sample(keys, fraction, seed))
