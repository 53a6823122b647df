import numpy as np
import pytest

import strandmill.llm.entity_splits as m
from strandmill.llm.entity_splits import anneal, assign_splits, related_groups

SCHEMA = "feature_id bigint, sample string, has_mut boolean, subject string, n int"
PLAN = [("train", 0.8), ("validation", 0.1), ("test", 0.1)]


def rows(spark, items):
    return spark.createDataFrame([(k, s, h, "x", 1) for k, s, h in items], SCHEMA)


def test_groups(spark):
    names = ["KB-0000012", "kb_12_minimap2_T2T", "run12/KB 0012 (rep)", "Kb.000013", None, "", "XKB-12", "redo_TM0000012.fq", "TM-12_R10", "LS-7"]
    got = {tuple(r) for r in related_groups(rows(spark, [(k, n, None) for k, n in enumerate(names)])).collect()}
    assert got == {(0, 0), (1, 0), (2, 0), (7, 7), (8, 7)}
    assert related_groups(rows(spark, [])).count() == 0


def test_splits_follow_the_plan(spark, monkeypatch):
    monkeypatch.setattr(m, "BLOCK_COMPONENTS", 200)
    items, k = [], 0
    for c in range(500):
        for _ in range(1 + c % 7):
            items.append((k, f"KB-{c:07d}" if c % 9 else None, (c * 7 + k) % 5 == 0 if k % 11 else None))
            k += 1
    # one subject holds a third of all rows
    items += [(k + i, "TM-1" if i % 2 else "tm_0001.fq", True) for i in range(k // 2)]
    df = rows(spark, items)
    out = assign_splits(df, spark.createDataFrame(PLAN, "split_name string, share double")).collect()
    assert len(out) == len(items) and len({r.feature_id for r in out}) == len(items)
    by_subject = {}
    for r in out:
        if r.subject:
            by_subject.setdefault(r.subject, set()).add(r.split_name)
    assert all(len(s) == 1 for s in by_subject.values())
    for name, share in PLAN:
        assert abs(sum(r.split_name == name for r in out) / len(items) - share) < 0.01


def test_parallel_blocks_alone(spark, monkeypatch):
    monkeypatch.setattr(m, "BLOCK_COMPONENTS", 100)
    driver = []
    monkeypatch.setattr(m, "collect_bounded", lambda df, n: driver.append(df.limit(n + 1).collect()) or driver[-1])
    # small table, every component of several records: none is placed on the driver
    items = [(k, f"KB-{k // 4}", k // 4 % 3 == 0) for k in range(1_600)]
    out = assign_splits(rows(spark, items), spark.createDataFrame(PLAN, "split_name string, share double")).collect()
    assert driver[1] == [] and len({(r.subject, r.split_name) for r in out}) == 400
    for name, share in PLAN:
        mine = [r.feature_id for r in out if r.split_name == name]
        assert abs(len(mine) / 1_600 - share) < 0.01 and abs(sum(k // 4 % 3 == 0 for k in mine) / 536 - share) < 0.02


def test_edges(spark):
    plan = spark.createDataFrame([("a", 3.0), ("b", 1.0), ("c", None), (None, 1.0)], "split_name string, share double")
    assert assign_splits(rows(spark, []), plan).count() == 0
    same = assign_splits(rows(spark, [(1, "KB-1", True)] * 4 + [(None, None, None)]), plan).collect()
    assert len(same) == 5 and len({r.split_name for r in same if r.feature_id == 1}) == 1
    with pytest.raises(ValueError):
        assign_splits(rows(spark, []), plan.filter("share is null"))


def test_annealing_improves():
    sizes = np.array([5.0, 4, 3, 3, 2, 2, 1])
    labels = sizes[:, None]
    at, cost = anneal(sizes, labels, np.array([10.0, 10]), np.array([[10.0], [10]]), np.zeros(7, int), 1)
    assert cost < 1e-9 and sizes[at == 0].sum() == 10
