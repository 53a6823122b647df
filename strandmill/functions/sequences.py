"""Column functions on base sequences."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

#: Bases of an exact seed, every so many bases of a probe; a place counts only if one of the seeds stands there.
SEED = 11


def reverse_complement(seq: Column) -> Column:
    """Other strand of A, C, G, T, N in either case."""
    return F.translate(F.reverse(seq), "ACGTNacgtn", "TGCANtgcan")


def best_place(seq: bytes, probe: bytes, most: int) -> int:
    """Start of ``probe`` in ``seq`` with the fewest differing bases, at most ``most``, the first of equals; -1 if there is none.

    All places are compared at once as a matrix; a place without any exact seed of the probe is none.
    """
    exact = seq.find(probe)
    if exact >= 0 or len(seq) < len(probe):
        return exact
    windows = np.lib.stride_tricks.sliding_window_view(np.frombuffer(seq, np.uint8), len(probe))
    best, found = most + 1, -1
    # in blocks, so that a very long sequence needs no large matrix
    for low in range(0, len(windows), 20_000):
        equal = windows[low : low + 20_000] == np.frombuffer(probe, np.uint8)
        seeds = len(probe) // SEED
        seeded = equal[:, : seeds * SEED].reshape(len(equal), seeds, SEED).all(axis=2).any(axis=1)
        differ = np.where(seeded, len(probe) - equal.sum(axis=1), len(probe) + 1)
        k = int(differ.argmin())
        if differ[k] < best:
            best, found = int(differ[k]), low + k
    return found


@dataclass(frozen=True)
class Measure:
    """How units are counted between two anchors: from the end or the start of the left one to the start or the end of the right one, less ``fixed`` bases."""

    with_anchors: bool
    fixed: int = 0


#: ``flank``: the bases between two anchors that are not units, less the fixed bases beside the array.
#: ``cassette``: the first and last unit themselves are the anchors, so any amplicon around them measures alike.
MEASURES = {"flank": Measure(with_anchors=False, fixed=44), "cassette": Measure(with_anchors=True)}


def measured_copies(seq: Column, left: str, right: str, measure: str | Measure = "flank", *, unit: int = 60, offset: int = 0, most: int = 9) -> Column:
    """Struct of ``copies`` (rounded half to even), ``before``, ``after`` (bases outside the measure) and ``is_reverse``.

    The given strand is tried first, then the other; null without both anchors in order on one strand, for null and for
    empty sequences. Bases are compared in upper case.
    """
    how = MEASURES[measure] if isinstance(measure, str) else measure
    a, b = left.upper().encode(), right.upper().encode()
    swap = bytes.maketrans(b"ACGTN", b"TGCAN")

    @F.pandas_udf("copies int, before int, after int, is_reverse boolean")
    def measured(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for seqs in batches:
            rows = []
            for s in seqs:
                row = (None, None, None, None)
                forward = s.encode() if s else b""
                for k in range(2 if s else 0):
                    strand = forward[::-1].translate(swap) if k else forward
                    x = best_place(strand, a, most)
                    y = best_place(strand, b, most) if x >= 0 else -1
                    if y >= x + len(a):
                        low, high = (x, y + len(b)) if how.with_anchors else (x + len(a), y)
                        row = (round((high - low - how.fixed) / unit) + offset, low, len(strand) - high, bool(k))
                        break
                rows.append(row)
            out = pd.DataFrame(rows, columns=["copies", "before", "after", "is_reverse"])
            yield out.astype({"copies": "Int32", "before": "Int32", "after": "Int32", "is_reverse": "boolean"})

    found = measured(F.upper(seq))
    return F.when(found["copies"].isNotNull(), found)


def oriented(seq: Column, context: str) -> Column:
    """The strand on which ``context`` (a regular expression) stands more often; the given one if equally often."""
    other = reverse_complement(seq)
    return F.when(F.regexp_count(seq, F.lit(context)) >= F.regexp_count(other, F.lit(context)), seq).otherwise(other)


def tract_lengths(seq: Column, left: str, base: str, right: str) -> Column:
    """Lengths of all tracts of ``base`` between two contexts, in order."""
    return F.transform(F.regexp_extract_all(seq, F.lit(f"{left}({base}+){right}"), 1), F.length)


def tract_lengths_both(seq: Column, left: str, base: str, right: str) -> Column:
    """Tract lengths of the given strand, then of the other."""
    return F.concat(tract_lengths(seq, left, base, right), tract_lengths(reverse_complement(seq), left, base, right))


def after_anchor(seq: Column, anchor: str) -> Column:
    """What follows the first exact ``anchor``; null without it."""
    at = F.locate(anchor, seq)
    return F.when(at > 0, F.substring(seq, at + F.lit(len(anchor)), F.length(seq)))


def before_anchor(seq: Column, anchor: str) -> Column:
    """What stands before the last exact ``anchor``; null without it."""
    return F.when(F.locate(anchor, seq) > 0, F.substring(seq, F.lit(1), F.length(seq) - F.locate(anchor[::-1], F.reverse(seq)) + 1 - len(anchor)))


def context_gaps(seq: Column, context: str) -> Column:
    """Distances between the starts of neighbouring exact ``context``s that don't overlap."""
    parts = F.split(seq, f"\\Q{context}\\E", -1)
    inner = F.slice(parts, F.lit(2), F.greatest(F.size(parts) - 2, F.lit(0)))
    return F.transform(inner, lambda p: F.length(p) + len(context))


def segment_type(segment: Column, base: str = "C", other: str = "G", usual: int = 7) -> Column:
    """Type of the segment between two contexts, by its length and bases.

    Only ``base``: ``WT`` at the usual length, else ``dup``/``del`` with the bases more or less (up to four), else ``ins`` or ``del``
    with the number. The usual tract with one ``other`` more: ``dup`` with it at the head, else ``ins``. All else ``other``.
    """
    n = F.length(segment)
    off = n - usual
    pure = segment.rlike(f"^{base}+$")
    more = F.when(off == 0, "WT").when(off.between(1, 4), F.concat(F.lit("dup"), F.repeat(F.lit(base), off))).when(off.between(-4, -1), F.concat(F.lit("del"), F.repeat(F.lit(base), -off)))
    rest = F.concat(F.when(off > 0, base.lower() + "Ins").otherwise(base.lower() + "Del"), F.abs(off).cast("string"))
    one = (off == 1) & (F.length(F.replace(segment, F.lit(other), F.lit(""))) == usual) & F.replace(segment, F.lit(other), F.lit("")).rlike(f"^{base}+$")
    return F.when(pure, F.coalesce(more, rest)).when(one & segment.startswith(other), f"dup{other}").when(one, f"ins{other}").when(segment.isNotNull(), "other")


def longest_tandem(seq: bytes, unit: bytes, most: int) -> tuple[int, int]:
    """Units and start of the longest stretch of ``unit`` one after another, each with at most ``most`` differing bases; the first of equals, (0, -1) without any."""
    n = len(unit)
    if not n or len(seq) < n:
        return 0, -1
    windows = np.lib.stride_tricks.sliding_window_view(np.frombuffer(seq, np.uint8), n)
    like = np.concatenate([(windows[low : low + 20_000] != np.frombuffer(unit, np.uint8)).sum(axis=1) <= most for low in range(0, len(windows), 20_000)])
    # one column per phase: a stretch is a run down a column
    padded = np.zeros(-(-len(like) // n) * n, bool)
    padded[: len(like)] = like
    grid = padded.reshape(-1, n)
    length = np.zeros(grid.shape, np.int64)
    below = np.zeros(n, np.int64)
    for r in range(len(grid) - 1, -1, -1):
        below = np.where(grid[r], below + 1, 0)
        length[r] = below
    at = int(length.argmax())
    best = int(length.flat[at])
    return (best, at) if best else (0, -1)


def tandem_stretch(seq: Column, unit: Column, most: int = 6) -> Column:
    """Struct of ``units`` and ``start`` (from 0) of the longest tandem stretch of ``unit``; 0 and null where there is none, null for nulls."""

    @F.pandas_udf("units int, start int")
    def found(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.DataFrame]:
        for seqs, units in batches:
            rows = [(None, None) if s is None or u is None else longest_tandem(s.encode(), u.encode(), most) for s, u in zip(seqs, units, strict=True)]
            out = pd.DataFrame(rows, columns=["units", "start"])
            out["start"] = out["start"].where(out["units"] != 0)
            yield out.astype({"units": "Int32", "start": "Int32"})

    return found(F.upper(seq), F.upper(unit))
