"""Greedy decoding of a consensus into known units, one haplotype per row."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strandmill.functions.bounded import collect_bounded


class Units:
    """Known units: exact ones by sequence, and per length a matrix for the nearest."""

    def __init__(self, units: list[tuple[str, str]]):
        self.exact = dict(units)
        self.lengths = sorted({len(seq) for seq, _ in units}, reverse=True)
        self.near = {}
        for n in self.lengths:
            own = [(seq, name) for seq, name in units if len(seq) == n]
            self.near[n] = (np.frombuffer("".join(seq for seq, _ in own).encode("latin-1", "replace"), np.uint8).reshape(len(own), n), [name for _, name in own])

    def nearest(self, part: np.ndarray, most: int) -> tuple[str, int] | None:
        """Name and differing bases of the nearest unit of the length of ``part``, the first of equals."""
        matrix, names = self.near[len(part)]
        differ = (matrix != part).sum(axis=1)
        k = int(differ.argmin())
        return (names[k], int(differ[k])) if differ[k] <= most else None


def greedy_units(text: str, units: Units, most: int = 3) -> Iterator[tuple[str, int, int, int]]:
    """(name, place, length, differing bases): at each place the exact unit, the longest first, else the nearest of its length; else a base is passed over."""
    letters, at = np.frombuffer(text.encode("latin-1", "replace"), np.uint8), 0
    while at < len(text):
        found = next(((name, at, n, 0) for n in units.lengths if (name := units.exact.get(text[at : at + n]))), None)
        if found is None:
            for n in units.lengths:
                if at + n <= len(text) and (hit := units.nearest(letters[at : at + n], most)) and (found is None or hit[1] < found[3]):
                    found = (hit[0], at, n, hit[1])
        if found is None:
            at += 1
        else:
            yield found
            at += found[2]


def decode(haplotypes: DataFrame, reference: DataFrame, *, text: str = "consensus", most: int = 3, limit: int = 10_000) -> DataFrame:
    """Units of every haplotype's ``text``: ``file_id``, ``hap_no``, ``unit``, ``name``, ``pos``, ``length``, ``mismatches``.

    The reference is a small list (at most ``limit`` rows). Null and empty texts and bases that fit no unit give no rows.
    """
    known = sorted(((r[0].upper(), r[1]) for r in collect_bounded(reference.select("seq", "motif_name").filter("seq is not null and seq != ''"), limit)), key=lambda x: x[1])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        units = Units(known)
        for batch in batches:
            rows = [
                (f, h, i, *unit)
                for f, h, t in zip(*(batch.column(k).to_pylist() for k in range(3)), strict=True)
                for i, unit in enumerate(greedy_units((t or "").upper(), units, most), 1)
            ]
            kinds = (pa.int64(), pa.int32(), pa.int32(), pa.string(), pa.int32(), pa.int32(), pa.int32())
            columns = list(zip(*rows, strict=True)) if rows else [[]] * 7
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=["file_id", "hap_no", "unit", "name", "pos", "length", "mismatches"]
            )

    held = haplotypes.select(F.col("file_id").cast("bigint"), F.col("hap_no").cast("int"), F.col(text).alias("t")).filter("t is not null")
    return held.mapInArrow(run, "file_id bigint, hap_no int, unit int, name string, pos int, length int, mismatches int")
