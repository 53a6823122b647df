import pytest
from pyspark.sql import functions as F

import strandmill.llm.source_mixing as m
from strandmill.llm.source_mixing import budgets, draw_mixture, reached_shares

DOCS = "doc_id bigint, text string, source string, repeats int"
TARGETS = "source string, target_share double, max_repeats int"


@pytest.fixture(scope="module", autouse=True)
def needs_tokenizer():
    import os

    if not os.path.exists(m.TOKENIZER):
        pytest.skip("no tokenizer files")


def docs(spark, items):
    return spark.createDataFrame([(k, t, s, 0) for k, t, s in items], DOCS)


def test_budgets():
    plan = budgets([("a", 100), ("b", 1000), ("c", 0)], [("a", 0.5, 3), ("b", 0.5, 1), ("c", 0.2, 9), ("d", 0.1, 1)])
    assert plan["a"] == (300, 3, 0.0) and plan["b"][:2] == (300, 0) and plan["b"][2] == 300 and plan["c"][0] == plan["d"][0] == 0
    assert budgets([("a", 100)], [("a", 1.0, 2)], 10_000)["a"] == (200, 2, 0.0)
    assert budgets([("a", 100)], [("a", 1.0, 2)], 150)["a"] == (150, 1, 50)


def test_shares_are_reached(spark, monkeypatch):
    monkeypatch.setattr(m, "RANGES", 8)
    items = [(k, "some words to count " * (1 + k % 5), ("big", " BIG ", "small", None, "other")[k % 5 if k % 3 else 0]) for k in range(3000)]
    targets = spark.createDataFrame([("Big", 0.6, 1), ("small", 0.4, 4), ("none", 0.2, 2)], TARGETS)
    out = draw_mixture(docs(spark, items), targets)
    rows = out.collect()
    assert len({r.doc_id for r in rows}) == len(rows) and max(r.repeats for r in rows if r.source == "small") <= 4
    assert {r.source for r in rows} == {"big", "small"} and max(r.repeats for r in rows if r.source == "big") == 1
    shares = {r.source: r.reached_share for r in reached_shares(out, targets).collect()}
    assert abs(shares["big"] - 0.6) < 0.01 and abs(shares["small"] - 0.4) < 0.01 and shares["none"] == 0
    assert sorted((r.doc_id, r.repeats) for r in rows) == sorted((r.doc_id, r.repeats) for r in draw_mixture(docs(spark, items[::-1]), targets).collect())


@pytest.mark.parametrize("total", [None, 4_000])
def test_drawing_equals_brute_force(spark, monkeypatch, total):
    monkeypatch.setattr(m, "RANGES", 16)
    items = [(k, "word " * (1 + k * 7 % 13), ("a", "b")[k % 3 == 0], 0.05 + k % 10 / 10) for k in range(900)]
    df = spark.createDataFrame(items, "doc_id bigint, text string, source string, grade double")
    targets = [("a", 0.3, 1), ("b", 0.7, 3)]
    got = {r.doc_id: r.repeats for r in draw_mixture(df, spark.createDataFrame(targets, TARGETS), quality="grade", total_tokens=total).collect()}
    keys = {r.doc_id: r.key for r in df.select("doc_id", m.sampling_key(F.col("doc_id"), F.col("grade"), 11).alias("key")).collect()}
    sizes = {r.doc_id: r.n_tokens for r in m.count_tokens(df, ["doc_id"]).collect()}
    held = {s: sorted((k for k, _, own, _ in items if own == s), key=lambda k: (keys[k], k)) for s in "ab"}
    expected = {}
    for s, (_, epochs, left) in budgets([(s, sum(sizes[k] for k in held[s])) for s in "ab"], targets, total).items():
        reached, best = 0, (left, 0)
        for n, k in enumerate(held[s], 1):
            reached += sizes[k]
            # the later of two equally near ends is taken
            if abs(left - reached) <= best[0]:
                best = (abs(left - reached), n)
        for n, k in enumerate(held[s]):
            if times := epochs + (left > 0 and n < best[1]):
                expected[k] = times
    assert got == expected


@pytest.mark.parametrize("weights", ["0.1", "0.2", "1.0", "if(id % 2 = 0, 0.1, 1.0)", "0.1 + (id % 91) / 100", "pow(10, (id % 7) - 3)"])
def test_no_key_range_is_hot(spark, weights):
    df = spark.range(200_000).withColumn("q", F.expr(weights).cast("double")).withColumn("key", m.sampling_key(F.col("id"), F.col("q"), 11))
    spread = m.shares_of([(2.0 ** (r[0] / m.STEPS), r[1]) for r in df.groupBy(m.weight_step(F.col("q"))).count().collect()])
    laid = F.array(*(F.struct(F.lit(a).alias("rate"), F.lit(b).alias("share")) for a, b in spread))
    ranged = df.withColumn("range", m.key_range(F.col("key"), laid))
    assert ranged.groupBy("range").count().agg(F.max("count")).first()[0] < 2_000
    # ranges keep the order of the keys
    edges = ranged.groupBy("range").agg(F.min("key"), F.max("key")).orderBy("range").collect()
    assert all(a[2] <= b[1] for a, b in zip(edges, edges[1:]))


def test_edges(spark):
    targets = spark.createDataFrame([("a", 1.0, 2)], TARGETS)
    assert draw_mixture(docs(spark, []), targets).count() == 0
    twice = draw_mixture(docs(spark, [(1, "x", "a"), (1, "x", "A"), (2, None, "a"), (3, "", "a"), (4, "y", None), (5, "word " * 60_000, "a")]), targets)
    assert sorted((r.doc_id, r.repeats) for r in twice.collect()) == [(1, 2), (1, 2), (2, 2), (3, 2), (5, 2)]
    assert draw_mixture(docs(spark, [(1, "x", "a")]), targets.limit(0)).count() == 0
    with pytest.raises(ValueError):
        draw_mixture(docs(spark, []), targets.union(spark.createDataFrame([(" A", 0.1, 1)], TARGETS)))


def test_better_documents_are_drawn_more(spark):
    items = [(k, "plain words of a text" if k % 2 else "12 34 #### 567 ?? 89 aa", "a") for k in range(4000)]
    out = draw_mixture(docs(spark, items), spark.createDataFrame([("a", 1.0, 1)], TARGETS), total_tokens=8000).collect()
    good = sum(r.doc_id % 2 for r in out)
    assert good > 0.6 * len(out)
