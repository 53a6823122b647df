"""Mixing sources to target weights by Efraimidis-Spirakis sampling.

Every document gets an exponential key divided by its quality weight; within a source the smallest keys are drawn until the
source's token budget is met. Complete epochs of a small source come first, the key order decides the rest. The order is
found from sums per key range, so no source is sorted in one task.
"""

from __future__ import annotations

import base64
import os
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strandmill.functions.bounded import collect_bounded
from strandmill.functions.lineage import checkpointed

#: Ranks file of the public tokenizer whose tokens are counted.
TOKENIZER = "/opt/tokenizers/byte_bpe_multi_50k.tiktoken"
#: Fixed value: how that tokenizer cuts text before merging.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: Key ranges per source; one of them is sorted.
RANGES = 4_096
#: Weights are told apart by steps of a quarter of an octave when key ranges are laid out; weights lie between these.
STEPS, LEAST_WEIGHT, MOST_WEIGHT = 4, 1e-3, 1e3
#: Targets that may be given.
MOST_TARGETS = 10_000
#: A ranks file of up to so many bytes is sent to the executors.
MOST_BYTES = 64_000_000


@lru_cache(maxsize=2)
def tokenizer(ranks: bytes):
    import tiktoken

    table = {base64.b64decode(a): int(b) for a, b in (line.split() for line in ranks.splitlines() if line.strip())}
    return tiktoken.Encoding("counting", pat_str=PATTERN, mergeable_ranks=table, special_tokens={})


def count_tokens(documents: DataFrame, keep: list[str], text: str = "text", path: str = TOKENIZER) -> DataFrame:
    """``keep`` and ``n_tokens`` of every whole text; null texts have 0 tokens. Texts aren't passed on.

    The ranks file is read on the driver, where ``path`` must exist, and broadcast.
    """
    if os.path.getsize(path) > MOST_BYTES:
        raise ValueError("the ranks file is too large to be broadcast")
    with open(path, "rb") as f:
        ranks = documents.sparkSession.sparkContext.broadcast(f.read())
    source = documents.select(*keep, F.col(text).alias("_text"))
    fields = [source.schema[c] for c in keep]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = tokenizer(ranks.value).encode_ordinary
        for batch in batches:
            counts = pa.array([len(encode(t)) if t else 0 for t in batch.column("_text").to_pylist()], pa.int64())
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in keep), counts], names=[*keep, "n_tokens"])

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in fields) + ", n_tokens bigint"
    return source.mapInArrow(run, schema)


def quality_of(text: Column) -> Column:
    """A stand-in for a quality score, from 0.1 to 1: the part of letters and blanks, less for broken characters and markup."""
    length = F.length(text)
    plain = F.length(F.regexp_replace(text, r"[^\p{L}\s]+", "")) / F.greatest(length, F.lit(1))
    broken = F.when(text.rlike("\\x{FFFD}|Ã[\\x{80}-\\x{BF}]|â€|\\?\\?\\?"), 0.2).otherwise(0.0) + F.when(text.rlike("<[a-zA-Z/][^<>]*>|&[a-z]+;"), 0.1).otherwise(0.0)
    return F.coalesce(F.greatest(F.lit(0.1), plain - broken), F.lit(0.1))


def source_name(source: Column) -> Column:
    """Sources are equal apart from case and outer blanks."""
    return F.lower(F.trim(F.regexp_replace(source, r"(?U)^\s+|\s+$", "")))


def sampling_key(id: Column, quality: Column, seed: int) -> Column:
    """An exponential variable of rate ``quality``, drawn from a hash of the id: the smallest keys are a weighted sample without replacement."""
    unit = (F.shiftrightunsigned(F.xxhash64(id, F.lit(seed)), 11) + 0.5) / float(1 << 53)
    return -F.log(unit) / quality


def weight_step(quality: Column) -> Column:
    return F.round(F.log2(quality) * STEPS).cast("int")


def shares_of(spread: list[tuple[float, float]]) -> list[tuple[float, float]]:
    whole = sum(n for _, n in spread)
    return [(rate, n / whole) for rate, n in sorted(spread)]


def key_range(key: Column, spread: Column) -> Column:
    """The range, from 0, in which a key lies: its place in the source's distribution of keys.

    Keys of documents of one weight are exponential, so a source's keys follow the mixture of its weights' distributions.
    That is monotone in the key, so ranges keep the order of keys, and fills the ranges about evenly at any weights.
    """
    below = F.aggregate(spread, F.lit(0.0), lambda a, x: a + x["share"] * (1 - F.exp(-key * x["rate"])))
    return F.least(F.floor(below * RANGES), F.lit(RANGES - 1)).cast("int")


def budgets(sizes: list[tuple[str, int]], targets: list[tuple[str, float, int]], total: int | None = None) -> dict[str, tuple[float, int, float]]:
    """Per source: token budget, complete epochs, tokens left to draw.

    Without ``total`` the total is the largest at which every source that has tokens reaches its share; a given larger
    total leaves sources at their cap.
    """
    have, share, cap = dict(sizes), {s: max(x, 0.0) for s, x, _ in targets}, {s: max(c, 0) for s, _, c in targets}
    useful = [s for s in share if share[s] > 0 and have.get(s, 0) > 0 and cap[s] > 0]
    whole = sum(share[s] for s in useful)
    if total is None:
        total = min((have[s] * cap[s] / (share[s] / whole) for s in useful), default=0.0)
    out = {}
    for s in share:
        want = total * share[s] / whole if s in useful else 0.0
        want = min(want, have.get(s, 0) * cap[s])
        epochs = int(want // have[s] + 1e-9) if want > 0 else 0
        out[s] = (want, epochs, want - epochs * have[s] if epochs < cap[s] and want > 0 else 0.0)
    return out


def draw_mixture(
    documents: DataFrame,
    targets: DataFrame,
    *,
    doc_id: str = "doc_id",
    text: str = "text",
    source: str = "source",
    quality: str | None = None,
    total_tokens: int | None = None,
    path: str = TOKENIZER,
    seed: int = 11,
) -> DataFrame:
    """The drawing: ``doc_id``, ``source``, ``n_tokens``, ``repeats`` (1 or more) of every drawn document.

    ``targets`` has ``source``, ``target_share``, ``max_repeats``; ``quality`` names a column of weights (null and what lies
    outside ``LEAST_WEIGHT`` and ``MOST_WEIGHT`` is brought inside), without it ``quality_of`` is used. Shares are taken relative to the sources that have
    tokens; a source is never repeated more than ``max_repeats`` times. The drawing of a source ends with the document
    that brings it nearest to its budget.

    Defined cases: documents whose source is null or has no target are not drawn; sources are equal apart from case and
    outer blanks, several targets of one source raise ``ValueError``; empty texts have no tokens and come only with
    complete epochs or on the way; equal keys go by id; repeated documents are drawn each; an empty table or no usable
    target gives an empty drawing; other columns are ignored.
    """
    wanted = [
        (r[0], float(r[1] or 0), int(r[2] or 0)) for r in collect_bounded(targets.select(source_name(F.col("source")), "target_share", "max_repeats"), MOST_TARGETS) if r[0] is not None
    ]
    if len({s for s, _, _ in wanted}) < len(wanted):
        raise ValueError("a source has several targets")
    names = [s for s, _, _ in wanted]
    weight = F.least(F.greatest(F.coalesce(F.col(quality).cast("double"), F.lit(LEAST_WEIGHT)), F.lit(LEAST_WEIGHT)), F.lit(MOST_WEIGHT)) if quality else quality_of(F.col(text))
    held = documents.select(F.col(doc_id).alias("doc_id"), source_name(F.col(source)).alias("source"), weight.alias("quality"), F.col(text).alias("text")).filter(
        F.col("source").isin(names) if names else F.lit(False)
    )
    # narrow from here on and used several times: written once
    counted = checkpointed(count_tokens(held, ["doc_id", "source", "quality"], path=path))
    # a row per source and step of weight
    steps = counted.groupBy("source", weight_step(F.col("quality")).alias("step")).agg(F.sum("n_tokens").alias("tokens"), F.count("*").alias("docs")).collect()
    sizes: dict[str, int] = {}
    spread: dict[str, list[tuple[float, float]]] = {s: [] for s in names}
    for r in steps:
        sizes[r["source"]] = sizes.get(r["source"], 0) + r["tokens"]
        spread[r["source"]].append((2.0 ** (r["step"] / STEPS), float(r["docs"])))
    plan = budgets(list(sizes.items()), wanted, total_tokens)

    keyed = counted.withColumn("key", sampling_key(F.col("doc_id"), F.col("quality"), seed))
    spark = documents.sparkSession
    per_source = F.broadcast(spark.createDataFrame([(s, e, left, shares_of(spread[s])) for s, (_, e, left) in plan.items()] or [("", 0, 0.0, [])], "source string, epochs int, to_draw double, spread array<struct<rate:double,share:double>>"))
    keyed = keyed.join(per_source.select("source", "spread"), "source").withColumn("range", key_range(F.col("key"), F.col("spread"))).drop("spread")
    per_source = per_source.drop("spread")
    sums = keyed.groupBy("source", "range").agg(F.sum("n_tokens").alias("in_range"))
    ordered = Window.partitionBy("source").orderBy("range")
    # at most RANGES rows per source
    edges = sums.withColumn("before", F.sum("in_range").over(ordered) - F.col("in_range")).join(per_source, "source")
    # ranges below the one in which the budget is met are taken whole; one row per target
    met = edges.filter(F.col("before") + F.col("in_range") > F.col("to_draw")).groupBy("source").agg(F.min_by(F.struct("range", "before"), "range").alias("met"))
    marked = keyed.join(F.broadcast(per_source.join(met, "source", "left")), "source")
    inside = F.coalesce(F.col("range") == F.col("met.range"), F.lit(False))
    place = Window.partitionBy("source").orderBy("key", "doc_id")
    part = marked.filter(inside).withColumn("reached", F.col("met.before") + F.sum("n_tokens").over(place.rowsBetween(Window.unboundedPreceding, 0)))
    part = part.withColumn("more", (F.col("reached") - F.col("n_tokens") / 2.0 <= F.col("to_draw")).cast("int"))
    below = F.col("met").isNull() & (F.col("to_draw") > 0) | F.coalesce(F.col("range") < F.col("met.range"), F.lit(False))
    rest = marked.filter(~inside).withColumn("more", below.cast("int"))
    cols = ["doc_id", "source", "n_tokens", (F.col("epochs") + F.col("more")).alias("repeats")]
    return rest.select(*cols).unionAll(part.select(*cols)).filter("repeats > 0").withColumnRenamed("doc_id", doc_id)


def reached_shares(drawing: DataFrame, targets: DataFrame) -> DataFrame:
    """Each target with the documents and tokens drawn for it and the share reached."""
    drawn = drawing.groupBy("source").agg(
        F.count("*").alias("n_docs"), F.sum(F.col("n_tokens") * F.col("repeats")).alias("drawn_tokens"), F.max("repeats").alias("most_repeats")
    )
    known = targets.select(source_name(F.col("source")).alias("source"), "target_share", "max_repeats")
    whole = F.sum("drawn_tokens").over(Window.partitionBy(F.lit(1)))
    filled = known.join(drawn, "source", "left").fillna(0, ["n_docs", "drawn_tokens", "most_repeats"])
    return filled.withColumn("reached_share", F.when(whole > 0, F.col("drawn_tokens") / whole).otherwise(0.0))
