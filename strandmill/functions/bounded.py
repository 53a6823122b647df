"""Small reference lists with a checked size."""

from __future__ import annotations

from pyspark.sql import DataFrame


class TooLarge(ValueError):
    """A table meant to be small holds more rows than its documented bound."""


def collect_bounded(df: DataFrame, limit: int) -> list:
    """Rows of a table known to be small.

    At most ``limit`` + 1 rows ever reach the driver; a larger table raises ``TooLarge`` instead of being cut, so callers
    can take their distributed path.
    """
    rows = df.limit(limit + 1).collect()
    if len(rows) > limit:
        raise TooLarge(f"more than {limit} rows")
    return rows
