import json

from pyspark.sql import functions as F

from strandmill.operators.nested_records import haplotype_sizes, nested_tables

M = {"name": "A", "pos": 0, "length": 60, "mismatches": 0}
HAP = {"rank": 1, "contig": "c", "motifs": [M, None, M], "unmatched": [{"pos": "7", "sequence": "ACG"}], "coverage": {"n_reads": 3}}


def frame(spark, rows):
    return spark.createDataFrame(rows, "file_id bigint, body string, rank string")


def sizes(spark, *bodies):
    rows = [(k, b if b is None or isinstance(b, str) else json.dumps(b), "x") for k, b in enumerate(bodies)]
    return sorted(tuple(r) for r in haplotype_sizes(frame(spark, rows)).collect())


def test_layouts(spark):
    got = sizes(
        spark,
        {"haplotypes": [HAP, None, {"rank": "2"}]},
        {"result": {"haplotypes": [HAP]}},
        {"haplotypes": {"HP2": {"contig": "c", "motifs": None}, "HP1": HAP}},
        {"haplotypes": HAP},
        {"haplotypes": [{"contig": "c", "motifs": json.dumps([M, M])}]},
        {"haplotypes": None},
        json.dumps({"haplotypes": [HAP]})[:-9],
        None,
        "",
        "[1, 2]",
    )
    assert got == [(0, 1, 2, 1), (0, 2, 0, 0), (1, 1, 2, 1), (2, 1, 2, 1), (2, 2, 0, 0), (3, 1, 2, 1), (4, 1, 2, 0)]


def test_twice_and_empty(spark):
    body = json.dumps({"haplotypes": [HAP]})
    again = json.dumps({"haplotypes": {"HP1": HAP}})
    out = nested_tables(frame(spark, [(1, body, "x"), (1, again, "y"), (1, "{", "z"), (None, body, ""), (None, again, "")]))
    assert out.files.count() == 3
    assert out.motifs.filter("file_id = 1").count() == 2
    first = out.haplotypes.filter("file_id = 1").first()
    assert (first.hap_no, first.hap_rank, first.n_reads, first.motif_rows) == (1, 1, 3, 2)
    assert out.unmatched.filter("file_id = 1").select("pos", "sequence").first() == (7, "ACG")
    empty = nested_tables(frame(spark, []))
    assert [x.count() for x in (empty.files, empty.haplotypes, empty.motifs, empty.unmatched)] == [0, 0, 0, 0]


def test_sizes_count_the_emitted_children(spark, monkeypatch):
    import strandmill.operators.nested_records as m

    df = frame(spark, [(1, json.dumps({"haplotypes": [HAP, {"rank": 2}]}), "x"), (None, json.dumps({"haplotypes": [HAP]}), "y")])
    assert sorted(tuple(r)[1:] for r in haplotype_sizes(df).collect()) == [(1, 2, 1), (1, 2, 1), (2, 0, 0)]
    emit = m.child_rows
    monkeypatch.setattr(m, "child_rows", lambda name, *rest: F.slice(emit(name, *rest), 1, 1))
    assert sorted(tuple(r) for r in haplotype_sizes(df).filter("file_id = 1").collect()) == [(1, 1, 1, 1), (1, 2, 0, 0)]
