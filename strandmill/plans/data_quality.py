"""Queries of the drifting-schema, nested-record and strict-load operators."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strandmill.operators import drifting_schema, nested_records, strict_load
from strandmill.sources import load_table

#: Typed columns of the score table.
SCORE_FIELDS = {
    "sample": "string", "mut_len": "int", "healthy_len": "int", "position": "int", "ratio": "double", "onset_index": "double",
    "severity_score": "double", "fs_tail": "int", "splice_base": "string", "mut_is_long": "boolean",
}
#: Further names approved for a column.
SCORE_NAMES = {
    "severity_score": ("SeverityScore", "severity-score", "sev_score", "severity"),
    "mut_is_long": (), "sample": (), "healthy_len": (), "splice_base": (),
    "onset_index": ("OnsetIndex", "onset_idx", "onset_frac", "oi"),
    "ratio": ("len_ratio", "ratio_vntr"), "position": ("mut_position", "repeat_pos"), "mut_len": ("vntr_len_mut", "l_mut"),
    "fs_tail": ("tail_len", "frameshift_tail"),
}


def p2_found(spark: SparkSession, folder: str) -> DataFrame:
    found = drifting_schema.schema_changes(drifting_schema.ingest(load_table(spark, folder, "score_rows"), SCORE_FIELDS), SCORE_FIELDS)
    return found.select(F.col("file_id").cast("bigint"), "field_name", "change_kind", "new_name")


def score_table(spark: SparkSession, folder: str) -> DataFrame:
    """All score rows as one table, approved names replayed."""
    return drifting_schema.replay(drifting_schema.ingest(load_table(spark, folder, "score_rows"), SCORE_FIELDS), SCORE_NAMES)


def p2_score_table(spark: SparkSession, folder: str) -> DataFrame:
    return score_table(spark, folder)


def p3_found(spark: SparkSession, folder: str) -> DataFrame:
    found = nested_records.haplotype_sizes(load_table(spark, folder, "analyzer_json"))
    return found.select(F.col("file_id").cast("bigint"), *(F.col(c).cast("int") for c in ("hap_rank", "n_motifs", "n_unmatched")))


def p3_haplotypes(spark: SparkSession, folder: str) -> DataFrame:
    return nested_records.nested_tables(load_table(spark, folder, "analyzer_json")).haplotypes


def p3_motifs(spark: SparkSession, folder: str) -> DataFrame:
    return nested_records.nested_tables(load_table(spark, folder, "analyzer_json")).motifs


def p3_unmatched(spark: SparkSession, folder: str) -> DataFrame:
    return nested_records.nested_tables(load_table(spark, folder, "analyzer_json")).unmatched


def p3_files(spark: SparkSession, folder: str) -> DataFrame:
    return nested_records.nested_tables(load_table(spark, folder, "analyzer_json")).files


def _loaded(spark: SparkSession, folder: str) -> strict_load.LoadResult:
    return strict_load.strict_load(load_table(spark, folder, "sheet_lines"), load_table(spark, folder, "variant_ref"))


def p5_found(spark: SparkSession, folder: str) -> DataFrame:
    return _loaded(spark, folder).faults.select(F.col("line_id").cast("bigint"), "reason")


def p5_rows(spark: SparkSession, folder: str) -> DataFrame:
    return _loaded(spark, folder).rows.drop("mut_len_list")


QUERIES = {f.__name__: f for f in (p2_found, p2_score_table, p3_found, p3_haplotypes, p3_motifs, p3_unmatched, p3_files, p5_found, p5_rows)}

_QUOTED = '"[^"]*(?:""[^"]*)*"'
_FIELD = f'(?:{_QUOTED}|[^",]*)'
_LINES = f"""
lines AS (SELECT line_id, regexp_replace(regexp_replace(raw_line, '^\\x{{FEFF}}', ''), '[\\r\\n]+$', '') AS line FROM sheet_lines),
fields AS (
  SELECT line_id, line, regexp_full_match(line, '{_FIELD}(?:,{_FIELD})*', 's') AS quoted,
    list_transform(regexp_extract_all(',' || line, ',({_FIELD})', 1),
      lambda x: trim(CASE WHEN x LIKE '"%' THEN replace(x[2:-2], '""', '"') ELSE x END, ' ' || chr(9) || chr(10) || chr(13) || chr(160))) AS f
  FROM lines WHERE trim(line, ' ' || chr(9) || chr(10) || chr(13) || chr(160)) <> ''),
judged AS (
  SELECT line_id, f, quoted, quoted AND len(f) = 12 AS shaped,
    f[7] = '' OR len(list_filter(string_split(f[7], '|'), lambda p: NOT (regexp_full_match(trim(p), '[0-9]{{1,9}}([.]0)?')
      AND coalesce(TRY_CAST(regexp_extract(trim(p), '^[0-9]+') AS INT) BETWEEN 10 AND 150, false)))) = 0 AS mut_len_ok,
    f[8] = '' OR len(list_filter(string_split(f[8], '|'), lambda p: NOT list_contains(known, trim(p)))) = 0 AS variant_ok,
    lower(f[4]) IN ('pos', 'neg', 'unknown', 'positive', 'positif', 'carrier', 'negative', 'negatif', 'négatif') AS status_ok
  FROM fields, (SELECT list(variant) AS known FROM variant_ref) WHERE NOT coalesce(f[1] = 'file', false))"""
_NAMES = strict_load.SHEET_FIELDS



def _score_sql() -> str:
    """The score table: of each row its latest delivery; of each column the first of its names whose value can be read. Rescued whole numbers have no decimals."""
    text = lambda n: f"""CASE json_type(p->'$."{n}"') WHEN 'ARRAY' THEN p->>'$."{n}"[0]' WHEN 'OBJECT' THEN p->>'$."{n}".value' ELSE p->>'$."{n}"' END"""
    number = lambda n: (
        f"(CASE WHEN regexp_full_match(trim({text(n)}), '[-+]?[0-9]+([.,][0-9]+)? *%?') THEN replace(regexp_extract(trim({text(n)}), '[-+]?[0-9]+([.,][0-9]+)?'), ',', '.')::DOUBLE"
        f" / CASE WHEN trim({text(n)}) LIKE '%\\%' ESCAPE '\\' THEN 100 ELSE 1 END END)"
    )

    def value(n: str, kind: str) -> str:
        if kind == "int":
            return f"(CASE WHEN {number(n)} = floor({number(n)}) THEN {number(n)}::INT END)"
        return {"double": number(n), "string": f"({text(n)})", "boolean": f"TRY_CAST({text(n)} AS BOOLEAN)"}[kind]

    names = {c: (c, *SCORE_NAMES[c]) for c in SCORE_FIELDS}
    lists = ", ".join(f"[{', '.join(value(n, SCORE_FIELDS[c]) for n in ns)}] AS v_{c}" for c, ns in names.items())
    chosen = ", ".join(f"list_filter(v_{c}, lambda x: x IS NOT NULL)[1] AS {c}" for c in names)
    quoted = lambda ns: "[" + ", ".join(f"'{n}'" for n in ns) + "]"
    taken = ", ".join(f"{quoted(ns)}[list_position(list_transform(v_{c}, lambda x: x IS NOT NULL), true)]" for c, ns in names.items())
    known = quoted([n for ns in names.values() for n in ns])
    return f"""latest AS (SELECT file_id, row_no, stream_id, written_at, payload FROM (SELECT *, row_number() OVER (PARTITION BY file_id, row_no ORDER BY arrived_at DESC NULLS LAST, payload DESC) AS r FROM score_rows) WHERE r = 1),
read AS (SELECT *, CASE WHEN json_valid(payload) AND json_type(payload) = 'OBJECT' THEN payload::JSON END AS p FROM latest),
lists AS (SELECT *, {lists} FROM read),
taken AS (SELECT *, [{taken}] AS taken, list_sort(json_keys(p)) AS keys FROM lists),
lost AS (SELECT *, list_filter(keys, lambda k: NOT list_contains(taken, k) AND NOT (list_contains({known}, k) AND json_type(json_extract(p, '$."' || k || '"')) = 'NULL')) AS lost FROM taken),
score AS (SELECT file_id, row_no, stream_id, written_at, {chosen}, CASE WHEN len(lost) > 0 THEN '{{' || array_to_string(list_transform(lost, lambda k: '"' || k || '":' || regexp_replace(json_extract(p, '$."' || k || '"')::VARCHAR, '^(-?[0-9]+)[.]0+$', '\\1')), ',') || '}}' END AS _rescued,
  CASE WHEN p IS NULL THEN payload END AS _raw FROM lost)"""


SCORE_SQL = _score_sql()
_TABLES = """valid AS (SELECT file_id, any_value(body::JSON) AS j FROM analyzer_json WHERE json_valid(body) GROUP BY file_id),
h AS (SELECT file_id, j, coalesce(nullif(j->'$.haplotypes', 'null'), j->'$.result.haplotypes') AS h FROM valid),
lists AS (SELECT file_id, j, CASE WHEN json_type(h) = 'ARRAY' THEN from_json(h, '["JSON"]') WHEN json_extract(h, '$.motifs') IS NOT NULL OR json_extract(h, '$.rank') IS NOT NULL THEN [h]
  WHEN json_type(h) = 'OBJECT' THEN json_extract(h, '$.*') END AS l FROM h),
haps AS (SELECT file_id, unnest(range(1, len(l) + 1))::INT AS hap_no, unnest(l) AS x FROM lists),
parts AS (SELECT file_id, hap_no, x, (x->>'$.rank')::INT AS hap_rank, CASE WHEN json_type(x->'$.motifs') = 'VARCHAR' THEN (x->>'$.motifs')::JSON ELSE x->'$.motifs' END AS m, x->'$.unmatched' AS u FROM haps),
stored AS (SELECT *, list_filter(from_json(CASE WHEN json_type(m) = 'ARRAY' THEN m END, '["JSON"]'), lambda e: json_type(e) <> 'NULL') AS motifs,
  list_filter(from_json(CASE WHEN json_type(u) = 'ARRAY' THEN u END, '["JSON"]'), lambda e: json_type(e) <> 'NULL') AS blocks FROM parts)"""
_INT = lambda path: f"TRY_CAST(TRY_CAST({path} AS DOUBLE) AS INT)"

ORACLE = {
    "p2_score_table": f"WITH {SCORE_SQL} SELECT * FROM score",
    "p3_files": f"WITH {_TABLES} SELECT file_id, j->>'$.sample' AS sample, coalesce(len(l), 0)::INT AS n_haplotypes FROM lists",
    "p3_haplotypes": f"""WITH {_TABLES} SELECT file_id, hap_no, hap_rank, {", ".join(f"x->>'$.{n}' AS {n}" for n in ("contig", "nomenclature", "consensus"))},
  {", ".join(f"{_INT(f"x->>'$.{n}'")} AS {n}" for n in ("contig_length", "read_count", "n_motifs", "n_exact", "n_approx"))}, {", ".join(f"TRY_CAST(x->>'$.{n}' AS BOOLEAN) AS {n}" for n in ("phased", "same_length"))},
  {", ".join(f"{_INT(f"x->>'$.coverage.{n}'")} AS {n}" for n in ("n_reads", "n_fwd", "n_rev"))}, coalesce(len(motifs), 0)::INT AS motif_rows, coalesce(len(blocks), 0)::INT AS unmatched_rows FROM stored""",
    "p3_motifs": f"""WITH {_TABLES}, each AS (SELECT file_id, hap_no, hap_rank, unnest(range(1, len(motifs) + 1))::INT AS motif_no, unnest(motifs) AS e FROM stored)
SELECT file_id, hap_no, hap_rank, motif_no, e->>'$.name' AS name, {", ".join(f"{_INT(f"e->>'$.{n}'")} AS {n}" for n in ("pos", "length", "mismatches"))}, e->>'$.sequence' AS sequence FROM each""",
    "p3_unmatched": f"""WITH {_TABLES}, each AS (SELECT file_id, hap_no, hap_rank, unnest(range(1, len(blocks) + 1))::INT AS block_no, unnest(blocks) AS e FROM stored)
SELECT file_id, hap_no, hap_rank, block_no, {_INT("e->>'$.pos'")} AS pos, e->>'$.sequence' AS sequence FROM each""",
    "p5_found": f"""WITH {_LINES}
SELECT line_id, 'quoting' AS reason FROM judged WHERE NOT quoted
UNION ALL SELECT line_id, 'columns' FROM judged WHERE quoted AND len(f) <> 12
UNION ALL SELECT line_id, 'mut_len' FROM judged WHERE shaped AND NOT mut_len_ok
UNION ALL SELECT line_id, 'variant' FROM judged WHERE shaped AND NOT variant_ok
UNION ALL SELECT line_id, 'status' FROM judged WHERE shaped AND NOT status_ok""",
    "p5_rows": f"""WITH {_LINES}
SELECT line_id, {", ".join(f"nullif(f[{k}], '') AS {n}" for k, n in enumerate(_NAMES, 1))}
FROM judged WHERE shaped AND mut_len_ok AND variant_ok AND status_ok""",
    "p3_found": """WITH valid AS (SELECT file_id, any_value(body::JSON) AS j FROM analyzer_json WHERE json_valid(body) GROUP BY file_id),
h AS (SELECT file_id, coalesce(nullif(j->'$.haplotypes', 'null'), j->'$.result.haplotypes') AS h FROM valid),
each AS (SELECT file_id, unnest(CASE WHEN json_type(h) = 'ARRAY' THEN from_json(h, '["JSON"]')
    WHEN json_extract(h, '$.motifs') IS NOT NULL OR json_extract(h, '$.rank') IS NOT NULL THEN [h]
    WHEN json_type(h) = 'OBJECT' THEN json_extract(h, '$.*') END) AS x FROM h),
parts AS (SELECT file_id, (x->>'$.rank')::INT AS hap_rank,
    CASE WHEN json_type(x->'$.motifs') = 'VARCHAR' THEN (x->>'$.motifs')::JSON ELSE x->'$.motifs' END AS m, x->'$.unmatched' AS u FROM each)
SELECT file_id, hap_rank,
  coalesce(len(list_filter(from_json(CASE WHEN json_type(m) = 'ARRAY' THEN m END, '["JSON"]'), lambda e: json_type(e) <> 'NULL')), 0)::INT AS n_motifs,
  coalesce(len(list_filter(from_json(CASE WHEN json_type(u) = 'ARRAY' THEN u END, '["JSON"]'), lambda e: json_type(e) <> 'NULL')), 0)::INT AS n_unmatched
FROM parts""",
}
