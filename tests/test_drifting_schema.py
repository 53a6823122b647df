import json
from datetime import datetime, timedelta

import strandmill.operators.drifting_schema as m
from strandmill.operators.drifting_schema import ingest, replay, schema_changes

SCHEMA = "stream_id string, file_id bigint, row_no int, written_at timestamp, payload string, field string"


def frame(spark, files, stream="s", start=0):
    rows = []
    for k, payloads in enumerate(files):
        at = datetime(2024, 1, 1) + timedelta(days=9 * (k + start))
        rows += [(stream, k + start + 1, r, at, p if p is None or isinstance(p, str) else json.dumps(p), "x") for r, p in enumerate(payloads, 1)]
    return spark.createDataFrame(rows, SCHEMA)


TARGET = {"sample": "string", "score": "double", "n": "int", "flag": "boolean"}


def changes(df, target=TARGET):
    return sorted(tuple(r) for r in schema_changes(ingest(df, target), target).collect())


def test_kinds_of_change(spark):
    df = frame(
        spark,
        [
            [{"sample": "a", "score": 0.5, "n": 3}, {"sample": "b", "score": None, "n": 90}],
            [{"sample": "a", "Score": 0.5, "n": 7}, {"sample": "c", "Score": -1.5, "n": 60}, "{broken", None, "[1]"],
            [{"sample": "c", "Score": None, "tag": "x"}],
            [{"sample": "c", "Score": "1,0", "tag": "y"}],
            [{"sample": "c", "Score": "1,0", "tag": "y", "n": 5}],
        ],
    )
    expected = [
        (2, "score", "renamed", "Score"), (3, "n", "removed", ""), (3, "tag", "added", ""), (4, "Score", "retyped", ""), (5, "n", "added", ""),
    ]
    assert changes(df) == sorted(expected)
    assert changes(df.union(df)) == sorted(expected)
    assert changes(df.limit(0)) == []


def test_type_is_carried_over_gaps_and_blocks(spark, monkeypatch):
    monkeypatch.setattr(m, "BLOCK", 2)
    df = frame(spark, [[{"a": 1}]] + [[{"a": None}]] * 6 + [[{"a": "1"}], [{"a": [1]}], [{"a": {"value": 1}}], [{"a": True}]])
    assert changes(df) == [(k, "a", "retyped", "") for k in (8, 9, 10, 11)]


def test_streams_are_apart_and_null_stream(spark):
    df = frame(spark, [[{"a": 1}], [{"a": 1, "b": 1}]], stream=None).union(frame(spark, [[{"c": 1}]], start=5))
    assert changes(df) == [(2, "b", "added", "")]


def test_changes_do_not_depend_on_the_target(spark):
    df = frame(spark, [[{"sample": "a", "score": 0.5, "n": 1}], [{"sample": "a", "Score": 0.5, "n": "1"}], [{"sample": "a", "Score": 0.7, "n": 1.5}]])
    expected = changes(df)
    assert expected == [(2, "n", "retyped", ""), (2, "score", "renamed", "Score"), (3, "n", "retyped", "")]
    assert changes(df, {}) == expected and changes(df, {"Score": "double", "n": "string", "sample": "int"}) == expected


def test_free_texts_are_compared_whole(spark):
    # two text fields of 300 values each, none in common
    files = [[{"sample": str(r), "old": f"left {r}"} for r in range(300)], [{"sample": f"x{r}", "new": f"right {r}"} for r in range(300)]]
    assert changes(frame(spark, files)) == [(2, "new", "added", ""), (2, "old", "removed", "")]
    files[1] = [{"sample": f"x{r}", "new": f"left {r}"} for r in range(300)]
    assert changes(frame(spark, files)) == [(2, "old", "renamed", "new")]


def test_ingest_keeps_types_and_loses_nothing(spark):
    payloads = [
        {"score": "63.5 %", "n": [4], "extra": 1}, {"Score": 0.25, "n": "many", "flag": True}, "{bad", None, {"score": 2, "n": 1.5, "flag": "yes", "deep": {"a": [True, None]}},
        {"n": 3_000_000_000, "score": None}, {"sample": "s", "n": 7}, "[1]", {},
    ]
    df = frame(spark, [payloads])
    got = {r.row_no: r for r in ingest(df, TARGET).collect()}
    rescued = {k: r._rescued and json.loads(r._rescued) for k, r in got.items()}
    assert rescued[1] == {"score": "63.5 %", "n": [4], "extra": 1} and got[1].score is None
    assert rescued[2] == {"Score": 0.25, "n": "many"} and got[2].flag is True
    assert got[3]._raw == "{bad" and got[8]._raw == "[1]" and rescued[3] is rescued[8] is rescued[4] is rescued[9] is got[4]._raw is None
    assert got[5].score == 2.0 and got[5].n is None and rescued[5] == {"n": 1.5, "flag": "yes", "deep": {"a": [True, None]}}
    assert rescued[6] == {"n": 3_000_000_000, "score": None}
    assert (got[7].sample, got[7].n, rescued[7]) == ("s", 7, None)
    # every valid payload can be put together again
    for k, p in enumerate(payloads, 1):
        if isinstance(p, dict):
            again = {n: getattr(got[k], n) for n in TARGET if getattr(got[k], n) is not None} | (rescued[k] or {})
            assert again == p
    assert ingest(df.limit(0), TARGET).count() == 0


def test_replay(spark):
    df = frame(spark, [[
        {"score": "63.5 %", "n": [4], "extra": 1}, {"Score": 0.25, "n": "many"}, {"score": 1, "Score": 2}, {"score": None, "Score": {"value": "1,5"}}, {"n": "1.5"}, "{bad",
    ]])
    table = ingest(df, TARGET)
    once = replay(table, {"score": ["Score"], "n": []})
    got = {r.row_no: (r.score, r.n, r._rescued and json.loads(r._rescued)) for r in once.collect()}
    assert got == {1: (0.635, 4, {"extra": 1}), 2: (0.25, None, {"n": "many"}), 3: (1.0, None, {"Score": 2}), 4: (1.5, None, None), 5: (None, None, {"n": "1.5"}), 6: (None, None, None)}
    assert once.columns == table.columns and sorted(map(repr, replay(once, {"score": ["Score"], "n": []}).collect())) == sorted(map(repr, once.collect()))


def test_latest_delivery_counts(spark):
    at = datetime(2024, 1, 1)
    rows = [("s", 1, 1, at, '{"n": 1}', at), ("s", 1, 1, at, '{"n": 9}', at + timedelta(days=1)), ("s", 1, 2, at, '{"n": 5}', None), ("s", 1, 2, at, '{"n": 5}', None), ("s", None, 3, at, '{"n": 6}', at), ("s", None, 3, at, '{"n": 6}', at)]
    df = spark.createDataFrame(rows, "stream_id string, file_id bigint, row_no int, written_at timestamp, payload string, arrived_at timestamp")
    assert sorted(((r.file_id or 0, r.row_no, r.n) for r in ingest(df, TARGET).collect())) == [(0, 3, 6), (0, 3, 6), (1, 1, 9), (1, 2, 5)]
