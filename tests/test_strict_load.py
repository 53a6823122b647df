from strandmill.operators.strict_load import strict_load

GOOD = "f.fq,S1,raw,pos,40,50,50,22dupC,,3,False,R1"


def variants(spark, rows=(("22dupC",), ("13dupA",))):
    return spark.createDataFrame(list(rows), "variant string")


def run(spark, lines, **kw):
    raw = spark.createDataFrame([(k, x, "extra") for k, x in lines], "line_id bigint, raw_line string, status string")
    out = strict_load(raw, variants(spark), **kw)
    return {r.line_id for r in out.rows.collect()}, sorted(((r.line_id, r.reason) for r in out.faults.collect()), key=str)


def test_shapes_and_values(spark):
    lines = [
        (1, GOOD),
        (2, "﻿" + GOOD + "\r\n"),
        (3, '"a, b ""c""\nd",S1,raw,Négatif,40,50,,,,3,False,R1'),
        (4, 'f,S1,raw,"pos,40,50,50,22dupC,,3,False,R1'),
        (5, 'f,"S1" x,raw,pos,40,50,50,22dupC,,3,False,R1'),
        (6, 'f,S"1,raw,pos,40,50,50,22dupC,,3,False,R1'),
        (7, "f,S1,raw,pos"),
        (8, "f,S1,raw,poz,40,50,9,22dupX,,3,False,R1"),
        (9, "f,S1,raw,POS ,40,50, 50.0 | 60 ,22dupC | 13dupA,,3,False,R1"),
        (10, "f,S1,raw,pos,40,50,50.5,22dupC|,,3,False,R1"),
        (11, "file,sample"),
        (12, "  \t"),
        (13, None),
        (14, "controls"),
    ]
    good, bad = run(spark, lines)
    assert good == {1, 2, 3, 9}
    assert sorted(bad) == [
        (4, "quoting"), (5, "quoting"), (6, "quoting"), (7, "columns"), (8, "mut_len"), (8, "status"), (8, "variant"),
        (10, "mut_len"), (10, "variant"), (14, "columns"),
    ]


def test_edges(spark):
    assert run(spark, [])[0] == set()
    long = "x" * 300_000
    good, bad = run(spark, [(1, f'"{long}",S1,raw,pos,40,50,50,,,,,'), (2, "," * 200_000), (None, "bad"), (3, GOOD), (3, "bad"), (3, "bad")])
    assert good == {1, 3}
    assert sorted(bad, key=str) == sorted([(2, "columns"), (3, "columns"), (None, "columns")], key=str)
    assert run(spark, [(1, ('"' + 'a""b' * 20_000 + '"') + ",S1,raw,pos,40,50,50,,,,,")])[0] == {1}


def test_null_offsets_and_any_list(spark):
    lines = [(1, GOOD), (2, GOOD.replace("22dupC", "22dupX")), (3, GOOD.replace("22dupC", "")), (None, GOOD), (None, GOOD.replace("22dupC", "22dupX")), (None, GOOD.replace("22dupC", "a|22dupC"))]
    raw = spark.createDataFrame([(k, x) for k, x in lines], "line_id bigint, raw_line string")
    for listed in ([("22dupC",)], [("22dupC",), ("22dupC",), (None,)] + [(f"{k}insA",) for k in range(20_000)]):
        for threshold in ("10MB", "-1"):
            spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
            out = strict_load(raw, variants(spark, listed))
            assert sorted((r.line_id or 0 for r in out.rows.collect())) == [0, 1, 3]
            assert sorted(((r.line_id or 0, r.reason) for r in out.faults.collect())) == [(0, "variant"), (0, "variant"), (2, "variant")]
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "10MB")
    assert {r.line_id for r in strict_load(raw, variants(spark, [])).rows.collect()} == {3}
