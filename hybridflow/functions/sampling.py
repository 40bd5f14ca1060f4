"""Bernoulli sampling of rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def unit_hash(row_id: Column, seed: int = 0) -> Column:
    """A number in [0, 1) fixed by the row's id and the seed, for draws that can be repeated."""
    digest = F.md5(F.concat(F.lit(f"{seed}:"), row_id.cast("string")))
    return F.conv(F.substring(digest, 1, 8), 16, 10).cast("double") / float(2**32)


def sample_rows(
    df: DataFrame, rate: float, seed: int = 0, row_id: str | None = None
) -> DataFrame:
    """Keep each row with probability ``rate``.

    With ``row_id`` the draw depends on the id alone, so a repeated run, a retried
    task or another partitioning keeps the same rows. Without it Spark draws.
    """
    if row_id is None:
        return df.sample(fraction=rate, seed=seed)
    return df.where(unit_hash(F.col(row_id), seed) < rate)
