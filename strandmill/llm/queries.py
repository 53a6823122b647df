"""Registered queries of the training-data operators."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from strandmill.llm import canonical_values, entity_splits, event_runs, language_segments, leak_search, source_mixing
from strandmill.sources import load_table


#: The languages of the documents.
LANGUAGES = ("en", "de", "fr", "es", "pt")


def p1_found(spark: SparkSession, folder: str) -> DataFrame:
    found = event_runs.motif_runs(load_table(spark, folder, "analyzer_json"))
    return found.select(F.col("file_id").cast("bigint"), *(F.col(c).cast("int") for c in ("hap_rank", "start_pos", "end_pos", "n_units")))


def _mapped(spark: SparkSession, folder: str) -> DataFrame:
    return canonical_values.map_entries(load_table(spark, folder, "cohort_sheet"), load_table(spark, folder, "variant_ref"))


def p4_found(spark: SparkSession, folder: str) -> DataFrame:
    return _mapped(spark, folder).select(F.col("row_id").cast("bigint"), F.col("entry_no").cast("int"), F.col("variant_id").cast("int"))


def p4_unmatched(spark: SparkSession, folder: str) -> DataFrame:
    """Unmatched spellings and how many rows hold them."""
    return _mapped(spark, folder).filter("variant_id = 0").groupBy("entry").agg(F.count("*").alias("n_entries"))


def p6_found(spark: SparkSession, folder: str) -> DataFrame:
    found = entity_splits.related_groups(load_table(spark, folder, "review_features"))
    return found.select(F.col("feature_id").cast("bigint"), F.col("group_id").cast("bigint"))


def p6_splits(spark: SparkSession, folder: str) -> DataFrame:
    return entity_splits.assign_splits(load_table(spark, folder, "review_features"), load_table(spark, folder, "split_plan"))


def p6_split_check(spark: SparkSession, folder: str) -> DataFrame:
    """Every group of ``p6_found`` with its records and the number of splits it lies in, which is 1."""
    features = load_table(spark, folder, "review_features")
    assigned = entity_splits.assign_splits(features, load_table(spark, folder, "split_plan"))
    grouped = entity_splits.related_groups(features).join(assigned, "feature_id")
    return grouped.groupBy("group_id").agg(F.count("*").alias("n_records"), F.countDistinct("split_name").alias("n_splits"))


def p6_shares(spark: SparkSession, folder: str) -> DataFrame:
    """Each split, and whether its share of the records is within a hundredth of the plan's (or two records, in small tables)."""
    features, plan = load_table(spark, folder, "review_features"), load_table(spark, folder, "split_plan")
    report = entity_splits.split_report(entity_splits.assign_splits(features, plan), features, plan)
    off = F.abs(F.col("n_records") - F.col("share") * F.col("n_records") / F.col("reached"))
    return report.select("split_name", "share", (off <= F.greatest(0.01 * F.col("n_records") / F.col("reached"), F.lit(2.0))).alias("is_reached"))


def p7_found(spark: SparkSession, folder: str) -> DataFrame:
    found = leak_search.leaked_items(load_table(spark, folder, "documents"), load_table(spark, folder, "eval_items"))
    return found.select(F.col("doc_id").cast("bigint"), F.col("item_id").cast("bigint"))


def p8_drawing(spark: SparkSession, folder: str) -> DataFrame:
    return source_mixing.draw_mixture(load_table(spark, folder, "documents"), load_table(spark, folder, "mix_targets"))


def p8_shares(spark: SparkSession, folder: str) -> DataFrame:
    targets = load_table(spark, folder, "mix_targets")
    return source_mixing.reached_shares(source_mixing.draw_mixture(load_table(spark, folder, "documents"), targets), targets)


def p8_share_check(spark: SparkSession, folder: str) -> DataFrame:
    """Each target, whether its source has documents, and whether its cap is kept and its share met as nearly as whole documents allow.

    A source's drawing ends with the document that brings it nearest to its budget, so it misses that by half of its largest
    document at most; a share also moves with what the others miss.
    """
    targets, documents = load_table(spark, folder, "mix_targets"), load_table(spark, folder, "documents")
    shares = source_mixing.reached_shares(source_mixing.draw_mixture(documents, targets), targets)
    named = documents.select("doc_id", source_mixing.source_name(F.col("source")).alias("source"), "text")
    held = source_mixing.count_tokens(named, ["source"]).groupBy("source").agg(F.count("*").alias("n_source_docs"), F.max("n_tokens").alias("largest"))
    known = shares.join(held, "source", "left").fillna(0, ["n_source_docs", "largest"])
    # one row per target
    whole = Window.partitionBy(F.lit(1))
    usable = F.when(F.col("n_source_docs") > 0, F.col("target_share"))
    aim = F.coalesce(usable / F.sum(usable).over(whole), F.lit(0.0))
    off = (F.col("largest") / 2 + aim * F.sum("largest").over(whole) / 2) / F.greatest(F.sum("drawn_tokens").over(whole), F.lit(1))
    met = (F.abs(F.col("reached_share") - aim) <= off + 1e-9) & (F.col("most_repeats") <= F.col("max_repeats"))
    return known.select("source", "n_source_docs", F.round(aim, 6).alias("aim"), met.alias("is_met"))


def _segments(spark: SparkSession, folder: str) -> DataFrame:
    documents = load_table(spark, folder, "documents")
    return language_segments.language_segments(documents, language_segments.fit_on_labels(documents, LANGUAGES))


def p9_found(spark: SparkSession, folder: str) -> DataFrame:
    return language_segments.mislabelled(_segments(spark, folder)).select(F.col("doc_id").cast("bigint"), F.col("seg_no").cast("int"), "lang")


def p9_segments(spark: SparkSession, folder: str) -> DataFrame:
    return _segments(spark, folder)


QUERIES = {f.__name__: f for f in (p1_found, p4_found, p4_unmatched, p6_found, p6_splits, p6_split_check, p6_shares, p7_found, p8_drawing, p8_shares, p8_share_check, p9_found, p9_segments)}

_NAMED = """named AS (SELECT feature_id,
    regexp_extract(upper(sample), '(?:^|[^A-Z])(KB|TM|RO|VD|LS)[^A-Z0-9]{0,3}0*([0-9]+)', 1) AS code,
    regexp_extract(upper(sample), '(?:^|[^A-Z])(KB|TM|RO|VD|LS)[^A-Z0-9]{0,3}0*([0-9]+)', 2) AS number FROM review_features),
grouped AS (SELECT feature_id, min(feature_id) OVER w AS group_id, count(*) OVER w AS n FROM named WHERE code <> ''
  WINDOW w AS (PARTITION BY code, number))"""

ORACLE = {
    "p6_found": f"WITH {_NAMED} SELECT feature_id, group_id FROM grouped WHERE n > 1",
    # what must hold of any right assignment
    "p6_split_check": f"WITH {_NAMED} SELECT group_id, count(*) AS n_records, 1::BIGINT AS n_splits FROM grouped WHERE n > 1 GROUP BY group_id",
    "p6_shares": "SELECT split_name, share, true AS is_reached FROM split_plan",
    "p8_share_check": """WITH held AS (SELECT lower(trim(source)) AS source, count(*) AS n FROM documents GROUP BY 1),
known AS (SELECT lower(trim(t.source)) AS source, target_share, coalesce(n, 0) AS n_source_docs FROM mix_targets t LEFT JOIN held h ON h.source = lower(trim(t.source)))
SELECT source, n_source_docs, round(coalesce(target_share / sum(target_share) FILTER (n_source_docs > 0) OVER () * (CASE WHEN n_source_docs > 0 THEN 1 END), 0), 6) AS aim, true AS is_met FROM known""",
}
