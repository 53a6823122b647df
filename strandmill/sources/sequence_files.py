"""Readers and writers of sequence files: FASTQ, FASTA, VCF, GFF and header-driven tables."""

from __future__ import annotations

import gzip
from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Reads per Arrow batch; bounds a task's memory whatever the file's size.
BATCH = 5_000
#: Tags carried over from a read's comment.
TAGS = ("MM", "ML", "HP", "PS")
_FASTQ = "file string, read_id string, comment string, seq string, qual string"


def read_fastq(spark: SparkSession, paths: Sequence[str]) -> DataFrame:
    """Four-line FASTQ files (plain or gzip), one task per file, read as a stream: ``file``, ``read_id``, ``comment``, ``seq`` (upper case), ``qual``.

    The files must be visible to the executors. A broken last record is left out; an empty file gives no rows.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["file", "read_id", "comment", "seq", "qual"]
        for batch in batches:
            for path in batch.column(0).to_pylist():
                opened = gzip.open(path, "rt") if path.endswith(".gz") else open(path)
                rows: list[tuple] = []
                with opened as lines:
                    while head := lines.readline():
                        seq, plus, qual = lines.readline().strip(), lines.readline(), lines.readline().rstrip("\r\n")
                        if head[:1] == "@" and plus[:1] == "+" and len(seq) == len(qual):
                            name, _, comment = head[1:].strip().partition(" ")
                            name, _, tabbed = name.partition("\t")
                            rows.append((path, name, "\t".join(x for x in (tabbed, comment) if x) or None, seq.upper(), qual))
                        if len(rows) >= BATCH:
                            yield pa.RecordBatch.from_arrays([pa.array(c, pa.string()) for c in zip(*rows, strict=True)], names=names)
                            rows = []
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array(c, pa.string()) for c in zip(*rows, strict=True)], names=names)

    listed = spark.createDataFrame([(p,) for p in paths], "path string").repartition(max(1, len(paths)))
    return listed.mapInArrow(run, _FASTQ)


def kept_tags(comment: Column) -> Column:
    """The allowed tags of a comment, in order; empty if there is none."""
    return F.array_join(F.filter(F.split(F.coalesce(comment, F.lit("")), r"\s+"), lambda t: t.rlike(f"^({'|'.join(TAGS)}):[A-Za-z]:")), "\t")


def mean_quality(qual: Column) -> Column:
    """Mean Phred quality of a quality string; null if it is empty."""
    total = F.aggregate(F.split(qual, ""), F.lit(0), lambda n, c: n + F.when(c == "", 0).otherwise(F.ascii(c) - 33))
    return F.when(F.length(qual) > 0, total / F.length(qual))


def read_fasta(spark: SparkSession, path: str | Sequence[str]) -> DataFrame:
    """FASTA records, split at their marks so that large files are read in parallel: ``name``, ``description``, ``seq`` (upper case)."""
    records = spark.read.option("lineSep", ">").text(path).filter(F.trim("value") != "")
    head = F.regexp_extract("value", r"^([^\r\n]*)", 1)
    body = F.regexp_replace(F.regexp_replace("value", r"^[^\r\n]*", ""), r"\s+", "")
    return records.select(
        F.regexp_extract(head, r"^(\S*)", 1).alias("name"), F.trim(F.regexp_replace(head, r"^\S*", "")).alias("description"), F.upper(body).alias("seq")
    )


def fasta_text(name: Column, seq: Column, width: int = 80) -> Column:
    """A FASTA record with wrapped lines, for ``df.select(...).write.text``."""
    return F.concat(F.lit(">"), name, F.lit("\n"), F.regexp_replace(seq, f"(.{{{width}}})(?=.)", "$1\n"))


def _tabbed(spark: SparkSession, path: str | Sequence[str], names: Sequence[str]) -> DataFrame:
    rows = spark.read.text(path).filter(~F.col("value").startswith("#") & (F.trim("value") != ""))
    parts = F.split(F.regexp_replace("value", "\r$", ""), "\t")
    return rows.select(*(F.get(parts, F.lit(k)).alias(n) for k, n in enumerate(names)))


def read_vcf(spark: SparkSession, path: str | Sequence[str], *, passed: bool = True) -> DataFrame:
    """Variant rows: ``chrom``, ``pos``, ``id``, ``ref``, ``alt``, ``qual``, ``filter``; by default those that passed."""
    rows = _tabbed(spark, path, ("chrom", "pos", "id", "ref", "alt", "qual", "filter"))
    rows = rows.withColumn("pos", F.col("pos").try_cast("bigint")).withColumn("qual", F.col("qual").try_cast("double"))
    return rows.filter("filter = 'PASS'") if passed else rows


def indel_units(variants: DataFrame, *, start: int, unit: int = 60) -> DataFrame:
    """The first length-changing variant of each contig inside the array, with its repeat and place in the unit."""
    inside = variants.filter((F.length("ref") != F.length("alt")) & (F.col("pos") >= start))
    first = inside.groupBy("chrom").agg(F.min_by(F.struct("pos", "ref", "alt"), F.struct("pos", "ref", "alt")).alias("v"))
    off = F.col("v.pos") - start
    return first.select("chrom", "v.pos", "v.ref", "v.alt", F.floor(off / unit).alias("repeat"), (off % unit).alias("place"))


def read_gff(spark: SparkSession, path: str | Sequence[str], contig: str | None = None) -> DataFrame:
    """Feature rows, of one contig if given."""
    rows = _tabbed(spark, path, ("seqid", "source", "type", "start", "end", "score", "strand", "phase", "attributes"))
    rows = rows.withColumn("start", F.col("start").try_cast("bigint")).withColumn("end", F.col("end").try_cast("bigint"))
    return rows.filter(F.col("seqid") == contig) if contig is not None else rows


def read_tsv(spark: SparkSession, path: str | Sequence[str]) -> DataFrame:
    """A table with a header line, all columns as text, blanks as null."""
    return spark.read.option("header", True).option("sep", "\t").option("nullValue", "").csv(path)
