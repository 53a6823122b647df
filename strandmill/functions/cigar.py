"""Column functions on alignments: arrays of ``op`` (0 match, 1 insertion, 2 deletion, 3 skip, 4 clip, 7 equal, 8 differing) and ``len``."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_REFERENCE, _QUERY = (0, 2, 3, 7, 8), (0, 1, 4, 7, 8)


def _sum(cigar: Column, ops: tuple[int, ...]) -> Column:
    return F.aggregate(cigar, F.lit(0).cast("bigint"), lambda n, c: n + F.when(c["op"].isin(*ops), c["len"]).otherwise(0))


def reference_length(cigar: Column) -> Column:
    return _sum(cigar, _REFERENCE)


def query_length(cigar: Column) -> Column:
    return _sum(cigar, _QUERY)


def inserted(cigar: Column) -> Column:
    return _sum(cigar, (1,))


def deleted(cigar: Column) -> Column:
    return _sum(cigar, (2,))


def end_clips(cigar: Column) -> Column:
    """Bases clipped at the first and last operation."""
    clip = lambda c: F.when(c["op"] == 4, c["len"]).otherwise(0)
    return F.when(F.size(cigar) == 0, 0).when(F.size(cigar) == 1, clip(F.get(cigar, F.lit(0)))).otherwise(clip(F.get(cigar, F.lit(0))) + clip(F.get(cigar, F.size(cigar) - 1)))


def blocks(cigar: Column, start: Column) -> Column:
    """Each operation with the reference and query place at which it begins."""

    def before(i: Column, ops: tuple[int, ...]) -> Column:
        return _sum(F.slice(cigar, F.lit(1), i), ops)

    return F.transform(
        cigar,
        lambda c, i: F.struct((i + 1).alias("no"), c["op"].alias("op"), c["len"].alias("len"), (start + before(i, _REFERENCE)).alias("ref_at"), before(i, _QUERY).alias("query_at")),
    )


def overlap(start: Column, end: Column, low: Column | int, high: Column | int) -> Column:
    """Bases two half-open intervals share."""
    low, high = (F.lit(x) if isinstance(x, int) else x for x in (low, high))
    return F.greatest(F.lit(0), F.least(end, high) - F.greatest(start, low))
