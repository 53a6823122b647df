import gzip

from pyspark.sql import functions as F

from strandmill.operators import cohort, read_filters, scaffolds
from strandmill.sources import sequence_files as s
from strandmill.streaming import read_counts


def test_fastq(spark, tmp_path):
    record = lambda n, q="@III": f"@{n} HP:i:1\tzm:i:4\nacgt\n+\n{q}\n"
    plain, packed, empty = tmp_path / "a.fastq", tmp_path / "b.fastq.gz", tmp_path / "c.fastq"
    plain.write_text(record("r1") + record("r2") + "@cut\nac")
    with gzip.open(packed, "wt") as f:
        f.write("".join(record(f"z{k}", "!!!!") for k in range(6_000)))
    empty.write_text("")
    df = s.read_fastq(spark, [str(plain), str(packed), str(empty)]).cache()
    assert df.count() == 6_002
    one = df.filter("read_id = 'r1'").select("seq", "qual", s.kept_tags(F.col("comment")).alias("tags"), s.mean_quality(F.col("qual")).alias("q")).first()
    assert tuple(one) == ("ACGT", "@III", "HP:i:1", (31 + 3 * 40) / 4)
    assert df.filter("read_id = 'z5'").select(s.mean_quality(F.col("qual"))).first()[0] == 0


def test_fasta_round_trip(spark, tmp_path):
    (tmp_path / "x.fa").write_text(">one first\nacg\nTT\n>two\n" + "A" * 200 + "\n")
    df = s.read_fasta(spark, str(tmp_path / "x.fa"))
    assert sorted(tuple(r) for r in df.collect()) == [("one", "first", "ACGTT"), ("two", "", "A" * 200)]
    df.select(s.fasta_text(F.col("name"), F.col("seq"))).write.text(str(tmp_path / "out"))
    again = s.read_fasta(spark, str(tmp_path / "out"))
    assert sorted((r.name, r.seq) for r in again.collect()) == [("one", "ACGTT"), ("two", "A" * 200)]


def test_tables(spark, tmp_path):
    (tmp_path / "v.vcf").write_text("##x\n#CHROM\tPOS\nc1\t180\t.\tG\tGC\t9.5\tPASS\nc1\t170\t.\tG\tGC\t.\tLOW\nc1\t130\t.\tGC\tG\t1\tPASS\nc2\t5\t.\tG\tA\t1\tPASS\n")
    vcf = s.read_vcf(spark, str(tmp_path / "v.vcf"))
    assert vcf.count() == 3 and s.read_vcf(spark, str(tmp_path / "v.vcf"), passed=False).count() == 4
    assert [tuple(r) for r in s.indel_units(vcf, start=100).collect()] == [("c1", 130, "GC", "G", 0, 30)]
    (tmp_path / "g.gff").write_text("##gff\nc1\ts\tunit\t1\t60\t.\t+\t.\tID=1\nc2\ts\tunit\t1\t60\t.\t+\t.\tID=2\r\n")
    assert [r.attributes for r in s.read_gff(spark, str(tmp_path / "g.gff"), "c2").collect()] == ["ID=2"]
    (tmp_path / "t.tsv").write_text("a\tb\n1\t\n")
    assert tuple(s.read_tsv(spark, str(tmp_path / "t.tsv")).first()) == ("1", None)


def test_read_filters(spark):
    cases = [
        (4, 60, "c", 0, [(0, 9000)], "unmapped"), (256, 60, "c", 0, [(0, 9000)], "secondary"), (2048, 60, "c", 0, [(0, 9000)], "supplementary"), (1024, 60, "c", 0, [(0, 9000)], "duplicate"),
        (0, 3, "c", 0, [(0, 9000)], "low_mapq"), (0, 60, "d", 0, [(0, 9000)], "wrong_contig"), (0, 60, "c", 8000, [(0, 9000)], "low_span"), (0, 60, "c", 0, [(4, 20000), (0, 9000)], "high_clip"),
        (16, 60, "c", 0, [(0, 9000)], None), (0, 60, "c", 100, [(0, 9000), (1, 5)], None),
    ]
    df = spark.createDataFrame([(*x[:4], [{"op": o, "len": n} for o, n in x[4]], x[5]) for x in cases], "flag int, mapq int, contig string, ref_start int, cigar array<struct<op:int,len:int>>, expected string")
    reason = read_filters.rejection_reason("c", 0, 10_000, min_mapq=20)
    assert df.filter(~reason.eqNullSafe(F.col("expected"))).count() == 0
    kept, dropped = read_filters.split_by_reason(df, reason)
    assert kept.count() == 2 and dropped.count() == 8
    assert tuple(read_filters.strand_balance(kept, "contig").first()) == ("c", 2, 1, 1, 0.5)
    assert df.filter(read_filters.primary()).count() == 5 and df.filter(read_filters.in_region("c", 0, 50)).count() == 7


def test_cohort(spark):
    sheet = spark.createDataFrame(
        [(1, "a", "raw_fastq", "pos", 40, 50, 50, "v"), (2, "a_minimap2_x", "t2t_clean", "NEG", 40, 50, None, None), (3, "b", "raw_fastq", "carrier", 43, 44, 78, "False"), (4, "c", None, "unknown", None, None, None, None), (5, None, None, None, None, None, None, None)],
        "row_id int, sample string, substrate string, status string, a1 int, a2 int, mut_len int, variant string",
    )
    assert sorted(tuple(r) for r in cohort.row_checks(sheet).collect()) == [(3, "mut_len_far"), (3, "no_variant")]
    assert [tuple(r) for r in cohort.paired_subjects(sheet).collect()] == [("a", 1, 1, 1, 0, False)]
    scored = sheet.withColumn("outcome", cohort.outcome(F.col("row_id") != 3, F.col("status")))
    got = {(r.substrate, r.level): (r.tp, r.fn, r.fp, r.tn, r.sens) for r in cohort.confusion(scored, "substrate").collect()}
    assert got[None, 1] == (1, 1, 1, 0, 0.5) and got["t2t_clean", 0] == (0, 0, 1, 0, 0.0)
    families = sheet.select(cohort.variant_family(F.lit("X-13dupA (?)"), ["dupA", "13dupA", "22dupC"])).first()[0]
    assert families == "13dupA"
    reads = spark.createDataFrame([("s", f"r{k}") for k in range(50)] + [("t", "r1")], "sample_id string, read_id string")
    assert cohort.depth_capped(reads, 7).count() == 8


def test_scaffolds(spark):
    hist = spark.createDataFrame([("s", 40, 90), ("s", 43, 90), ("s", 50, 10), ("s", 99, 200)], "sample_id string, copies int, n bigint")
    want = spark.createDataFrame([(1, "s", 41, 42), (2, "s", 70, None), (3, "x", 40, 50), (4, "s", None, 51)], "row_id int, sample_id string, a1 int, a2 int")
    got = {r.row_id: (r.scaffold1, r.scaffold2) for r in scaffolds.scaffolds_for_lengths(hist, want).collect()}
    assert got == {1: (40, 43), 2: (99, None), 3: (None, None), 4: (None, 50)}
    calls = spark.createDataFrame([("s", 45, 41), ("x", None, None)], "sample_id string, allele1 int, allele2 int")
    status = {r.row_id: r.status for r in scaffolds.length_congruence(calls, want).collect()}
    assert status == {1: "SPREAD", 2: "DIVERGENT", 3: "INSUFFICIENT", 4: "DIVERGENT"}
    values = spark.createDataFrame([("g", 0.1), ("g", 0.1), ("g", 0.12), ("g", 0.8), ("h", 0.5), ("g", None)], "k string, v double")
    assert [tuple(r) for r in scaffolds.min_variance_cut(values, "k", "v").collect()] == [("g", 0.12, 3, 1)]


def test_streaming_restart(spark, data, tmp_path):
    reads = read_counts.read_stream(spark, data)
    first = read_counts.run_counts(reads, str(tmp_path / "t"))
    total = first.agg(F.sum("n")).first()[0]
    # nothing new: the same counts again
    assert read_counts.run_counts(read_counts.read_stream(spark, data), str(tmp_path / "t")).agg(F.sum("n")).first()[0] == total
