"""Rows that fail to parse: strict load plus anti-join.

Raw lines keep their offset; a strict grammar loads the conforming rows, their offsets are subtracted from the raw ones and
only the remainder is diagnosed.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strandmill.functions.keyed import same_keys

SHEET_FIELDS = (
    "file", "sample", "substrate", "status", "a1", "a2", "mut_len", "variant", "variant_other", "variant_pos", "paired", "run",
)
#: The accepted spellings of a status, compared in lower case.
STATUSES = ("pos", "neg", "unknown", "positive", "positif", "carrier", "negative", "negatif", "négatif")

# Possessive loops, so that very long fields neither backtrack nor deepen the matcher's stack.
_QUOTED = r'"[^"]*+(?:""[^"]*+)*+"'
_BARE = r'[^",]*+'
_FIELD = f"(?:{_QUOTED}|{_BARE})"
_RECORD = f"^{_FIELD}(?:,{_FIELD})*+$"


@dataclass(frozen=True)
class LoadResult:
    rows: DataFrame
    faults: DataFrame


def clean_line(line: Column) -> Column:
    """A line without its byte-order mark and line end."""
    return F.regexp_replace(F.regexp_replace(line, "^﻿", ""), "[\r\n]+$", "")


def _trim(value: Column) -> Column:
    return F.regexp_replace(value, r"(?U)^\s+|\s+$", "")


def _unquote(value: Column) -> Column:
    return F.when(value.startswith('"'), F.replace(F.substring(value, F.lit(2), F.length(value) - 2), F.lit('""'), F.lit('"'))).otherwise(value)


def split_record(line: Column) -> Column:
    """The fields of a well-quoted record, unquoted and without outer blanks."""
    found = F.regexp_extract_all(F.concat(F.lit(","), line), F.lit(f",({_FIELD})"), 1)
    return F.transform(found, lambda x: _trim(_unquote(x)))


def _parts(value: Column) -> Column:
    return F.transform(F.split(value, r"\|", -1), _trim)


def whole_in(value: Column, low: int, high: int) -> Column:
    """Blank, or whole numbers from ``low`` to ``high`` joined by ``|``; ``.0`` is allowed."""
    number = lambda p: p.rlike(r"^[0-9]{1,9}(?:\.0)?$") & F.regexp_extract(p, "^([0-9]{1,9})", 1).try_cast("int").between(low, high)
    return (value == "") | F.forall(_parts(value), number)


def strict_load(
    raw: DataFrame,
    variants: DataFrame,
    *,
    offset: str = "line_id",
    line: str = "raw_line",
    fields: Sequence[str] = SHEET_FIELDS,
    header: str = "file",
    length: tuple[int, int] = (10, 150),
    statuses: Sequence[str] = STATUSES,
) -> LoadResult:
    """Load the conforming lines of ``raw`` and list the faults of the others.

    ``rows``: ``offset``, the fields as text (blank is null) and ``mut_len_list``. ``faults``: ``offset``, ``reason``,
    one row per fault: ``quoting``, else ``columns``, else any of ``mut_len``, ``variant``, ``status``.

    Defined cases: null and blank lines and header lines are no rows and no faults; an empty table gives two empty
    tables; a line delivered twice under one offset counts as often as it stands there in ``rows`` and once in ``faults``;
    a null offset is kept and subtracted like any other; the list may be of any size, its null and repeated entries do not
    matter, and an empty one knows no variant; other columns of ``raw`` are ignored, so their names can't clash. Very long
    lines are matched without backtracking.
    """
    base = raw.select(F.col(offset).alias("_at"), clean_line(F.col(line)).alias("_line"))
    base = base.filter(F.col("_line").isNotNull() & (_trim(F.col("_line")) != ""))
    first = F.regexp_extract(F.col("_line"), f"^({_FIELD})(?:,|$)", 1)
    base = base.filter(_trim(_unquote(first)) != header).withColumn("_mark", F.xxhash64("_line"))

    status, mut_len, variant = (F.get(F.col("_f"), F.lit(list(fields).index(n))) for n in ("status", "mut_len", "variant"))
    shaped = base.filter(F.col("_line").rlike(_RECORD)).withColumn("_f", split_record(F.col("_line")))
    shaped = shaped.filter(F.size("_f") == len(fields))
    tests = {
        "mut_len": whole_in(mut_len, *length),
        "status": F.lower(status).isin(*statuses),
    }

    # one row per distinct cell that names an unknown variant; blank cells name none
    cells = shaped.select(variant.alias("_cell")).filter("_cell != ''").distinct()
    named = cells.select("_cell", F.explode(F.array_distinct(_parts(F.col("_cell")))).alias("variant"))
    unknown = named.join(variants.select("variant").distinct(), "variant", "left_anti").select("_cell").distinct()

    good = shaped.withColumn("_cell", variant).join(unknown, "_cell", "left_anti").filter(tests["mut_len"] & tests["status"])
    blank = lambda c: F.when(c != "", c)
    rows = good.select(
        F.col("_at").alias(offset),
        *(blank(F.get(F.col("_f"), F.lit(k))).alias(n) for k, n in enumerate(fields)),
        F.when(mut_len != "", F.transform(_parts(mut_len), lambda p: F.regexp_extract(p, "^([0-9]+)", 1).cast("int"))).alias("mut_len_list"),
    )

    loaded = good.select(F.col("_at").alias("_good_at"), F.col("_mark").alias("_good_mark"))
    remainder = base.join(loaded, same_keys([("_at", "_good_at"), ("_mark", "_good_mark")]), "left_anti").dropDuplicates(["_at", "_mark"])
    remainder = remainder.withColumn("_quoted", F.col("_line").rlike(_RECORD)).withColumn("_f", F.when(F.col("_quoted"), split_record(F.col("_line"))))
    remainder = remainder.withColumn("_cell", variant).join(unknown.withColumn("_unknown", F.lit(True)), "_cell", "left")
    reasons = (
        F.when(~F.col("_quoted"), F.array(F.lit("quoting")))
        .when(F.size("_f") != len(fields), F.array(F.lit("columns")))
        .otherwise(
            F.filter(
                F.array(
                    F.when(~tests["mut_len"], F.lit("mut_len")),
                    F.when(F.col("_unknown"), F.lit("variant")),
                    F.when(~tests["status"], F.lit("status")),
                ),
                lambda x: x.isNotNull(),
            )
        )
    )
    faults = remainder.select(F.col("_at").alias(offset), F.explode(reasons).alias("reason"))
    return LoadResult(rows, faults)
