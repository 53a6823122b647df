"""Splits that keep related records together: a component swap search by parallel annealing.

Records of one subject form a component. Components start at a hashed split; whole components are then moved or exchanged
while the deviation of record and label counts from the plan falls. Blocks of components anneal in parallel, each several
times from different seeds, and the best of each block is kept. Components too large for a block are placed first.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strandmill.functions.bounded import collect_bounded
from strandmill.functions.keyed import attach

#: The codes that name a subject.
SUBJECT_CODES = ("KB", "TM", "RO", "VD", "LS")
#: A component with more than this part of the smallest split's share is placed before the blocks. There are never more such
#: components than ``LARGE_PARTS``: where a share is tiny, a component must also hold that part of all records.
LARGE_SHARE, LARGE_PARTS = 0.05, 2_000
#: Components annealed together.
BLOCK_COMPONENTS = 4_000
#: Independent searches per block.
RESTARTS = 3
#: How much more a deviation in records counts than one in a label's records.
SIZE_WEIGHT = 5.0
#: Tries of a move or an exchange per search.
STEPS = 12_000


def subject_of(sample: Column, codes: Sequence[str] = SUBJECT_CODES) -> Column:
    """The code and number in a sample name, however spelled; null if there is none."""
    pattern = f"(?:^|[^A-Z])({'|'.join(codes)})[^A-Z0-9]{{0,3}}0*([0-9]+)"
    text = F.upper(sample)
    code = F.regexp_extract(text, pattern, 1)
    return F.when(code != "", F.concat_ws("-", code, F.regexp_extract(text, pattern, 2)))


def components(rows: DataFrame, id: str, sample: str) -> DataFrame:
    """``rows`` with ``id``, ``subject`` and ``component``: the subject, or the record itself where it has none."""
    held = rows.withColumn("id", F.col(id)).withColumn("subject", subject_of(F.col(sample)))
    return held.withColumn("component", F.coalesce("subject", F.concat(F.lit("row "), F.col("id").cast("string")), F.lit("row")))


def related_groups(rows: DataFrame, *, id: str = "feature_id", sample: str = "sample") -> DataFrame:
    """``id`` and ``group_id`` (the smallest id of the subject) of every record that shares its subject.

    Defined cases: null names and names without a subject are in no group; a repeated row stays repeated; an empty table
    gives no rows; other columns are ignored.
    """
    named = components(rows.select(id, sample), id, sample).select("id", "subject").filter("subject is not null and id is not null")
    groups = named.groupBy("subject").agg(F.min("id").alias("group_id"), F.count("*").alias("n")).filter("n > 1")
    total = rows.count()
    return attach(named, groups, "subject", "n", total).select(F.col("id").alias(id), "group_id")


def anneal(sizes: np.ndarray, labels: np.ndarray, want: np.ndarray, want_labels: np.ndarray, start: np.ndarray, seed: int, steps: int = STEPS) -> tuple[np.ndarray, float]:
    """Move and exchange components until splits come near ``want`` records and ``want_labels`` records per label; best state and its cost."""
    rng, k, n = np.random.default_rng(seed), len(want), len(sizes)
    at, vec = start.copy(), np.column_stack([sizes, labels]).astype(float)
    goal = np.column_stack([want, want_labels]).astype(float)
    weight = 1.0 / np.maximum(goal.sum(axis=0), 1.0)
    weight[0] *= SIZE_WEIGHT
    have = np.zeros_like(goal)
    np.add.at(have, at, vec)
    part = (((have - goal) * weight) ** 2).sum(axis=1)
    best, best_cost, cost = at.copy(), part.sum(), part.sum()
    if n == 0 or k < 2:
        return best, float(best_cost)
    heat = max(cost / 20, 1e-12)
    first, second, other, chance = rng.integers(n, size=steps), rng.integers(n, size=steps), rng.integers(k - 1, size=steps), rng.random(steps)
    for t in range(steps):
        i = first[t]
        a = at[i]
        if t % 2:
            j = second[t]
            b = at[j]
            if a == b:
                continue
            shift = vec[i] - vec[j]
        else:
            j, b, shift = -1, (a + 1 + other[t]) % k, vec[i]
        x = (((have[a] - shift - goal[a]) * weight) ** 2).sum()
        y = (((have[b] + shift - goal[b]) * weight) ** 2).sum()
        change = x + y - part[a] - part[b]
        if change <= 0 or chance[t] < math.exp(-change / (heat * 0.9995**t + 1e-300)):
            have[a] -= shift
            have[b] += shift
            part[a], part[b], cost = x, y, cost + change
            at[i] = b
            if j >= 0:
                at[j] = a
            if cost < best_cost - 1e-15:
                best, best_cost = at.copy(), cost
    return best, float(best_cost)


def assign_splits(
    rows: DataFrame,
    plan: DataFrame,
    *,
    id: str = "feature_id",
    sample: str = "sample",
    label: str = "has_mut",
    restarts: int = RESTARTS,
    seed: int = 7,
) -> DataFrame:
    """Every record with its split: ``id``, ``subject``, ``split_name``.

    ``plan`` has ``split_name`` and ``share``; shares are scaled to sum 1, null and negative ones count as 0. All records of
    a subject get one split; the counts of records, and of each value of ``label`` (true, false, null), follow the shares.
    A record without subject is a component of its own. Defined cases: repeated rows stay repeated and together; a subject
    larger than its share stays whole; an empty table gives no rows; an empty plan raises ``ValueError``; other columns
    are ignored. Components of more than ``LARGE_SHARE`` of the smallest split are placed first, on the driver; there are at
    most ``LARGE_PARTS``. All others are searched in parallel blocks, each aiming at the shares the large ones leave open.
    """
    splits = sorted((r[0], max(float(r[1] or 0), 0.0)) for r in collect_bounded(plan.select("split_name", "share").filter("split_name is not null"), 1_000))
    whole = sum(s for _, s in splits)
    if whole <= 0:
        raise ValueError("the plan has no share above 0")
    names, shares = [n for n, _ in splits], np.array([s / whole for _, s in splits])
    named = components(rows.select(F.col(id), F.col(sample), F.coalesce(F.col(label).cast("string"), F.lit("null")).alias("_label")), id, sample)
    named = named.select("id", "subject", "component", F.col("_label").alias("label"))
    comps = named.groupBy("component").agg(
        F.count("*").cast("double").alias("n"), *(F.count(F.when(F.col("label") == v, 1)).cast("double").alias(f"l_{v}") for v in ("true", "false", "null"))
    )
    cols = ["n", "l_true", "l_false", "l_null"]
    total_row = comps.agg(F.count("*").alias("c"), *(F.sum(c).alias(c) for c in cols)).first()
    total = np.array([float(total_row[c] or 0) for c in cols])
    limit = max(LARGE_SHARE * shares[shares > 0].min() * total[0], total[0] / LARGE_PARTS)
    blocks = max(1, math.ceil((total_row["c"] or 0) / BLOCK_COMPONENTS))

    # at most LARGE_PARTS rows by the limit's definition
    large = collect_bounded(comps.filter(F.col("n") > limit).orderBy("component"), LARGE_PARTS)
    goal = np.outer(shares, total)
    placed: dict[str, int] = {}
    left = goal.copy()
    if large:
        vec = np.array([[r[c] for c in cols] for r in large])
        start = np.array([hash_unit(r["component"], shares) for r in large])
        runs = [anneal(vec[:, 0], vec[:, 1:], *_aim(shares, goal, vec), start, seed + k) for k in range(restarts)]
        at = min(runs, key=lambda x: x[1])[0]
        placed = {r["component"]: int(s) for r, s in zip(large, at, strict=True)}
        np.add.at(left, at, -vec)
    # what the large ones leave open, as shares of the rest
    left = np.maximum(left, 0)
    open_shares = left / np.maximum(left.sum(axis=0), 1e-9)
    steps = STEPS

    def search(key: tuple, part: pd.DataFrame) -> pd.DataFrame:
        part = part.sort_values("component")
        vec = part[cols].to_numpy()
        aim = open_shares * vec.sum(axis=0)
        base = open_shares[:, 0] if open_shares[:, 0].sum() > 0 else shares
        start = np.array([hash_unit(c, base) for c in part["component"]])
        at, cost = anneal(vec[:, 0], vec[:, 1:], aim[:, 0], aim[:, 1:], start, seed * 1_000_003 + int(key[0]) * 31 + int(key[1]), steps)
        return pd.DataFrame({"block": int(key[0]), "run": int(key[1]), "cost": cost, "component": part["component"].to_numpy(), "split_no": at.astype("int32")})

    small = comps.filter(F.col("n") <= limit).withColumn("block", F.pmod(F.xxhash64("component"), F.lit(blocks)).cast("int"))
    tries = small.withColumn("run", F.explode(F.sequence(F.lit(0), F.lit(restarts - 1))))
    found = tries.groupBy("block", "run").applyInPandas(search, "block int, run int, cost double, component string, split_no int")
    # per block the run of least cost
    kept = found.withColumn("_least", F.min(F.struct("cost", "run")).over(Window.partitionBy("block"))).filter("run = _least.run")
    where = kept.select("component", "split_no")
    if placed:
        where = where.unionByName(rows.sparkSession.createDataFrame(list(placed.items()), "component string, split_no int"))
    sized = where.join(comps.select("component", "n"), "component")
    out = attach(named, sized, "component", "n", int(total[0]))
    return out.select(F.col("id").alias(id), "subject", F.element_at(F.array(*map(F.lit, names)), F.col("split_no") + 1).alias("split_name"))


def _aim(shares: np.ndarray, goal: np.ndarray, vec: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    aim = np.outer(shares, vec.sum(axis=0))
    return aim[:, 0], aim[:, 1:]


def hash_unit(component: str, shares: np.ndarray) -> int:
    """The hashed start: a split drawn by its share, the same everywhere."""
    import xxhash

    x = xxhash.xxh64_intdigest(component.encode()) / 2**64
    return int(min(np.searchsorted(np.cumsum(shares) / max(shares.sum(), 1e-12), x, side="right"), len(shares) - 1))


def split_report(assigned: DataFrame, rows: DataFrame, plan: DataFrame, *, id: str = "feature_id") -> DataFrame:
    """Records and share of each split against the plan."""
    counts = assigned.groupBy("split_name").agg(F.count("*").alias("n_records"), F.countDistinct("subject").alias("n_subjects"))
    whole = F.sum("n_records").over(Window.partitionBy(F.lit(1)))
    return plan.select("split_name", "share").join(counts, "split_name", "left").withColumn("reached", F.col("n_records") / whole)
