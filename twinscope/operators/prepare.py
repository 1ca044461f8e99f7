"""Numeric preparation of feature columns."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

MAX_DOUBLE = 1.7976931348623157e308


@dataclass(frozen=True)
class Standardizer:
    """Column means and population deviations, learned on one table."""

    mean: dict[str, float]
    deviation: dict[str, float]

    @classmethod
    def fit(cls, df: DataFrame, columns: list[str]) -> Standardizer:
        """One aggregate over the table; one row comes back. NaN values are left out."""
        known = {c: F.when(~F.isnan(F.col(c).cast("double")), F.col(c).cast("double")) for c in columns}
        row = df.agg(
            *[F.avg(v).alias(f"m_{c}") for c, v in known.items()],
            *[F.stddev_pop(v).alias(f"s_{c}") for c, v in known.items()],
        ).first()
        mean = {c: row[f"m_{c}"] or 0.0 for c in columns}
        deviation = {c: row[f"s_{c}"] or 1.0 for c in columns}
        return cls(mean, deviation)

    def transform(self, df: DataFrame) -> DataFrame:
        return df.withColumns({c: (F.col(c) - self.mean[c]) / self.deviation[c] for c in self.mean})


def nan_to_num(c: Column) -> Column:
    """NaN becomes 0; infinities become the largest finite double."""
    c = c.cast("double")
    inf = F.lit(float("inf"))
    return (
        F.when(F.isnan(c), 0.0)
        .when(c == inf, MAX_DOUBLE)
        .when(c == -inf, -MAX_DOUBLE)
        .otherwise(c)
    )


def repair(df: DataFrame, columns: list[str]) -> DataFrame:
    return df.withColumns({c: nan_to_num(F.col(c)) for c in columns})
