"""Cleaning and data audits (anonymous users, excluded ids, missing values)."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def drop_anonymous(df: DataFrame, user: str = "userId") -> DataFrame:
    """Drop rows without a user: ``''`` or null id."""
    return df.where(F.col(user).isNotNull() & (F.col(user) != F.lit("")))


def exclude_users(df: DataFrame, ids: Iterable[str], user: str = "userId") -> DataFrame:
    """Drop known default / test accounts.  A null id is dropped too, as an
    inequality test on it is never true; ``''`` stays unless listed."""
    return df.where(F.col(user).isNotNull() & ~F.col(user).isin([str(i) for i in ids]))


def missing_registration(df: DataFrame, user: str = "userId", registration: str = "registration") -> DataFrame:
    """Distinct users having a row without registration."""
    return df.where(F.col(registration).isNull()).select(user).distinct()


def null_profile(df: DataFrame) -> DataFrame:
    """One row: the row count and, per column, the number of nulls."""
    return df.agg(
        F.count(F.lit(1)).alias("n_rows"),
        *[F.count_if(F.col(c).isNull()).alias(f"null_{c}") for c in df.columns],
    )
