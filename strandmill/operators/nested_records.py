"""Deeply nested analyzer records to related flat tables, by higher-order projection.

A body is parsed once per nesting level into typed arrays; nested ``transform`` calls attach the keys and indices of the
ancestors, ``flatten`` joins the arrays of one file and a single ``inline`` per target table emits its rows.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strandmill.functions.keyed import split_repeated

_MOTIF = "ARRAY<STRUCT<name: STRING, pos: STRING, length: STRING, mismatches: STRING, sequence: STRING>>"
_BLOCK = "ARRAY<STRUCT<pos: STRING, sequence: STRING>>"
_HAP = (
    "STRUCT<rank: STRING, contig: STRING, contig_length: STRING, read_count: STRING, nomenclature: STRING, consensus: STRING, "
    "n_motifs: STRING, n_exact: STRING, n_approx: STRING, phased: STRING, same_length: STRING, motifs: STRING, "
    "unmatched: STRING, coverage: STRING>"
)
_COVERAGE = "STRUCT<n_reads: STRING, n_fwd: STRING, n_rev: STRING>"
_TOP = "STRUCT<sample: STRING, haplotypes: STRING, result: STRUCT<haplotypes: STRING>>"


@dataclass(frozen=True)
class NestedTables:
    files: DataFrame
    haplotypes: DataFrame
    motifs: DataFrame
    unmatched: DataFrame


def whole(value: Column) -> Column:
    """A whole number stored as number or text; anything else is null."""
    return F.coalesce(F.trim(value).try_cast("int"), F.trim(value).try_cast("double").try_cast("int"))


def _entries(text: Column, schema: str) -> Column:
    """An array of objects, also where it is stored as JSON text or as one bare object; null entries go."""
    bare = F.trim(text)
    parsed = F.when(bare.startswith("["), F.from_json(bare, schema)).when(
        bare.startswith("{"), F.array(F.from_json(bare, schema[len("ARRAY<") : -1]))
    )
    empty = F.array().cast(schema)
    return F.coalesce(F.filter(parsed, lambda x: x.isNotNull()), empty)


def _haplotype_entries(text: Column) -> Column:
    """(key, haplotype) pairs of a list, of a map keyed by name, or of one bare haplotype; null entries go."""
    bare = F.trim(text)
    pair = f"ARRAY<STRUCT<key: STRING, value: {_HAP}>>"
    keyless = lambda xs: F.transform(xs, lambda x: F.struct(F.lit(None).cast("string").alias("key"), x.alias("value")))
    single = F.from_json(bare, _HAP)
    is_single = F.coalesce(single["rank"], single["motifs"], single["contig"], single["read_count"], single["unmatched"]).isNotNull()
    found = (
        F.when(bare.startswith("["), keyless(F.from_json(bare, f"ARRAY<{_HAP}>")))
        .when(bare.startswith("{") & is_single, keyless(F.array(single)))
        .when(bare.startswith("{"), F.map_entries(F.from_json(bare, f"MAP<STRING, {_HAP}>")))
    )
    return F.coalesce(F.filter(found, lambda x: x["value"].isNotNull()), F.array().cast(pair))


def deliveries(raw: DataFrame, *, file_id: str = "file_id", body: str = "body", run: str | None = None) -> DataFrame:
    """Each file once: ``file_id``, ``_body``, ``_key`` (content hash of files without an id, else null) and, if asked for, its least ``run``.

    Only files that come several times are shuffled; of their valid bodies the one of least hash is taken. Files without an
    id are told apart by content. Bodies of files that come once are not yet checked.
    """
    extra = [F.col(run).alias("run")] if run else []
    held = raw.select(F.col(file_id).alias("file_id"), F.col(body).alias("_body"), *extra)
    single, several = split_repeated(held, "file_id")
    key = F.when(F.col("file_id").isNull(), F.xxhash64("_body")).alias("_key")
    mark = F.when(F.try_parse_json("_body").isNotNull(), F.xxhash64("_body"))
    chosen = several.groupBy("file_id", key).agg(F.min_by("_body", mark).alias("_body"), *([F.min("run").alias("run")] if run else []))
    return single.withColumn("_key", key).unionByName(chosen)


def parse_records(raw: DataFrame, *, file_id: str = "file_id", body: str = "body", run: str | None = None) -> DataFrame:
    """One row per valid file: ``file_id``, ``_key``, ``sample``, ``haps`` (array of typed haplotypes) and, if asked for, ``run``."""
    valid = deliveries(raw, file_id=file_id, body=body, run=run).filter(F.try_parse_json("_body").isNotNull())
    top = valid.withColumn("_top", F.from_json("_body", _TOP))
    pairs = _haplotype_entries(F.coalesce(F.col("_top.haplotypes"), F.col("_top.result.haplotypes")))

    def motif(m: Column) -> Column:
        return F.struct(m["name"].alias("name"), whole(m["pos"]).alias("pos"), whole(m["length"]).alias("length"), whole(m["mismatches"]).alias("mismatches"), m["sequence"].alias("sequence"))

    def hap(p: Column, i: Column) -> Column:
        h, cover = p["value"], F.from_json(p["value"]["coverage"], _COVERAGE)
        number = F.regexp_extract(F.coalesce(p["key"], F.lit("")), "([0-9]+)$", 1)
        return F.struct(
            (i + 1).alias("hap_no"),
            F.coalesce(whole(h["rank"]), whole(F.when(number != "", number)), i + 1).alias("hap_rank"),
            *(h[n].alias(n) for n in ("contig", "nomenclature", "consensus")),
            *(whole(h[n]).alias(n) for n in ("contig_length", "read_count", "n_motifs", "n_exact", "n_approx")),
            *(h[n].try_cast("boolean").alias(n) for n in ("phased", "same_length")),
            *(whole(cover[n]).alias(n) for n in ("n_reads", "n_fwd", "n_rev")),
            F.transform(_entries(h["motifs"], _MOTIF), motif).alias("motifs"),
            F.transform(_entries(h["unmatched"], _BLOCK), lambda u: F.struct(whole(u["pos"]).alias("pos"), u["sequence"].alias("sequence"))).alias("unmatched"),
        )

    return top.select("file_id", "_key", F.col("_top.sample").alias("sample"), F.transform(pairs, hap).alias("haps"), *(["run"] if run else []))


def with_previous(events: Column) -> Column:
    """Array of ``m`` and the element before it, ``p`` (null for the first)."""
    before = F.concat(F.array(F.lit(None)), F.slice(events, F.lit(1), F.greatest(F.size(events) - 1, F.lit(0))))
    return F.filter(F.zip_with(events, before, lambda m, p: F.struct(m.alias("m"), p.alias("p"))), lambda x: x["m"].isNotNull())


def in_order(events: Column) -> Column:
    """Motifs with a position, by position, each position once (as first stored)."""
    keyed = F.transform(
        F.filter(events, lambda m: m["pos"].isNotNull()),
        lambda m, i: F.struct(m["pos"].alias("pos"), i.alias("i"), m["length"].alias("length"), m["name"].alias("name"), m["sequence"].alias("sequence")),
    )
    # pairs with the event before: inside a lambda the whole array would be sorted again for each event
    pairs = with_previous(F.array_sort(keyed))
    return F.transform(F.filter(pairs, lambda x: x["p"].isNull() | (x["p"]["pos"] != x["m"]["pos"])), lambda x: x["m"])


_HAP_COLUMNS = ("contig", "nomenclature", "consensus", "contig_length", "read_count", "n_motifs", "n_exact", "n_approx", "phased", "same_length", "n_reads", "n_fwd", "n_rev")


def haplotype_rows(columns: tuple[str, ...] = _HAP_COLUMNS) -> Column:
    """The rows of the haplotype table of one file, with the file's id and the sizes of the children."""
    return F.transform(
        "haps",
        lambda h: F.struct(
            F.col("file_id").alias("file_id"), h["hap_no"].alias("hap_no"), h["hap_rank"].alias("hap_rank"), *(h[n].alias(n) for n in columns),
            F.size(h["motifs"]).alias("motif_rows"), F.size(h["unmatched"]).alias("unmatched_rows"),
        ),
    )


def child_rows(name: str, index: str, columns: tuple[str, ...]) -> Column:
    """The rows of one child table of one file, each with the keys of its ancestors and its own index."""
    return F.flatten(
        F.transform(
            "haps",
            lambda h: F.transform(
                h[name],
                lambda m, j: F.struct(F.col("file_id").alias("file_id"), h["hap_no"].alias("hap_no"), h["hap_rank"].alias("hap_rank"), (j + 1).alias(index), *(m[c].alias(c) for c in columns)),
            ),
        )
    )


def nested_tables(raw: DataFrame, *, file_id: str = "file_id", body: str = "body") -> NestedTables:
    """Tables of files, haplotypes, motifs and unmatched blocks, each child tied to its parents by ``file_id``, ``hap_no`` and index.

    Defined cases: null bodies and bodies that are no valid JSON give no rows; a file delivered twice counts once; absent or
    null parts and null entries give no child rows, repeated entries do; ``haplotypes`` may be a list, a map, one object, or
    below ``result``; ``motifs`` may be JSON text; whole numbers may be stored as text; a missing rank is taken from the
    map key, else from the place in the list; an empty table gives four empty tables; other columns are ignored.
    """
    base = parse_records(raw, file_id=file_id, body=body)
    files = base.select("file_id", "sample", F.size("haps").alias("n_haplotypes"))
    return NestedTables(
        files, base.select(F.inline(haplotype_rows())),
        base.select(F.inline(child_rows("motifs", "motif_no", ("name", "pos", "length", "mismatches", "sequence")))),
        base.select(F.inline(child_rows("unmatched", "block_no", ("pos", "sequence")))),
    )


def haplotype_sizes(raw: DataFrame, *, file_id: str = "file_id", body: str = "body") -> DataFrame:
    """``file_id``, ``hap_rank``, ``n_motifs``, ``n_unmatched`` of every haplotype: the rows of the child tables, counted per parent.

    One projection emits the rows of the three tables by their keys, so that files are parsed once.
    """
    keys = lambda rows, kind: F.transform(rows, lambda r: F.struct(r["hap_no"].alias("hap_no"), r["hap_rank"].alias("hap_rank"), F.lit(kind).alias("kind")))
    emitted = F.concat(keys(haplotype_rows(()), "haplotype"), keys(child_rows("motifs", "no", ()), "motif"), keys(child_rows("unmatched", "no", ()), "unmatched"))
    rows = parse_records(raw, file_id=file_id, body=body).select("file_id", "_key", F.inline(emitted))
    count = lambda kind: F.count(F.when(F.col("kind") == kind, 1)).cast("int")
    counted = rows.groupBy("file_id", "_key", "hap_no", "hap_rank").agg(count("motif").alias("n_motifs"), count("unmatched").alias("n_unmatched"))
    return counted.select("file_id", "hap_rank", "n_motifs", "n_unmatched")
