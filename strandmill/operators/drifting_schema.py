"""Schemas that drift between files: rescue-column ingestion and a list of every change.

``ingest`` enforces a target schema on JSON rows: a value of another JSON type, an unknown field and a null that a typed column
can't tell from an absent field are kept, as JSON, in a rescue column, so that nothing of a row is lost. ``replay`` reads rescued
values of approved names into their typed columns. ``schema_changes`` compares the files of each stream by the ingested table.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strandmill.functions.keyed import BROADCAST_ROWS, split_repeated
from strandmill.functions.lineage import checkpointed

#: Files numbered per block when a stream's history is carried on; bounds what one task sorts.
BLOCK = 256
WHOLE_TYPES, REAL_TYPES = ("tinyint", "smallint", "int", "bigint"), ("float", "double")
_KINDS = ("array", "boolean", "number", "object", "string")


def json_kind(value: Column) -> Column:
    """``number``, ``string``, ``boolean``, ``array``, ``object``, or null for JSON null."""
    kind = F.schema_of_variant(value)
    return (
        F.when(kind == "VOID", F.lit(None).cast("string"))
        .when(kind == "STRING", "string")
        .when(kind == "BOOLEAN", "boolean")
        .when(kind.startswith("ARRAY"), "array")
        .when(kind.startswith("OBJECT"), "object")
        .otherwise("number")
    )


def plain_text(value: Column) -> Column:
    """The scalar a value carries: itself, the only member of an array, or the ``value`` of an object."""
    return F.coalesce(
        F.try_variant_get(value, "$[0]", "string"), F.try_variant_get(value, "$.value", "string"), F.try_variant_get(value, "$", "string")
    )


def plain_number(text: Column) -> Column:
    """The number in a text: decimal comma and percent sign are understood; null if it is not one number."""
    clean = F.trim(text)
    number = F.regexp_extract(clean, r"^([-+]?[0-9]+(?:[.,][0-9]+)?)\s*%?$", 1)
    value = F.translate(number, ",", ".").try_cast("double")
    return F.when(clean.endswith("%"), value / 100).otherwise(value)


def members(text: Column) -> Column:
    """The members of a JSON object by name, each with its JSON type; null if the text is no valid JSON or no object."""
    return F.try_variant_get(F.try_parse_json(text), "$", "map<string,variant>")


def strict_value(value: Column, kind: str) -> Column:
    """A JSON value as Spark type ``kind`` if it is of the JSON type that belongs to it and fits without loss, else null."""
    json = json_kind(value)
    if kind in WHOLE_TYPES:
        number = F.try_variant_get(value, "$", "double")
        return F.when((json == "number") & (number == F.floor(number)), F.try_variant_get(value, "$", kind))
    if kind in REAL_TYPES:
        return F.when(json == "number", F.try_variant_get(value, "$", kind))
    if kind == "boolean":
        return F.when(json == "boolean", F.try_variant_get(value, "$", kind))
    text = F.when(json == "string", F.try_variant_get(value, "$", "string"))
    return text if kind == "string" else text.try_cast(kind)


def lenient_value(value: Column, kind: str) -> Column:
    """As ``strict_value``, but numbers given as text or percent, and the scalar in an array of one or an object with ``value``, are read too."""
    text = plain_text(value)
    if kind in WHOLE_TYPES:
        number = plain_number(text)
        return F.when(number == F.floor(number), number.try_cast(kind))
    if kind in REAL_TYPES:
        return plain_number(text).try_cast(kind)
    # an object or array as a whole is no text
    whole = ~json_kind(value).isin("object", "array") | F.try_variant_get(value, "$[0]", "string").isNotNull() | F.try_variant_get(value, "$.value", "string").isNotNull()
    return F.when(whole, text if kind == "string" else text.try_cast(kind))


def ingest(
    rows: DataFrame,
    target: Mapping[str, str],
    *,
    key: Sequence[str] = ("file_id", "row_no"),
    keep: Sequence[str] = ("stream_id", "written_at"),
    arrived: str = "arrived_at",
    payload: str = "payload",
) -> DataFrame:
    """All rows as one table: ``key``, ``keep``, the typed ``target`` columns, ``_rescued`` and ``_raw``.

    ``target`` maps columns to Spark types. Only values of the right JSON type that fit without loss are taken; all else of
    a row stays in ``_rescued`` as a JSON object with its types: values that do not fit, unknown fields, and nulls (so that
    a field that is there without a value is told from an absent one). ``_rescued`` is null if nothing was rescued.

    Defined cases: of a row delivered several times under one key the latest by ``arrived`` counts, ties by the greater
    payload; rows with a null in the key are kept each; a payload that is no JSON object gives null columns and is kept
    whole in ``_raw``; a null payload gives nulls; target columns replace columns of the same name in ``rows``.
    """
    cols = [c for c in dict.fromkeys((*key, *keep)) if c not in target]
    at = F.col(arrived) if arrived in rows.columns else F.lit(None).cast("timestamp")
    held = rows.select(*cols, at.alias("_at"), F.col(payload).alias("_p"))
    single, several = split_repeated(held, *key)
    complete = ~F.greatest(*(F.col(k).isNull() for k in key)) if len(key) > 1 else F.col(key[0]).isNotNull()
    rest = [c for c in cols if c not in key]
    latest = several.filter(complete).groupBy(*key).agg(F.max_by(F.struct(*rest, "_p"), F.struct("_at", "_p")).alias("_l"))
    latest = latest.select(*key, *(F.col(f"_l.{c}").alias(c) for c in (*rest, "_p"))).select(*cols, "_p")
    base = single.select(*cols, "_p").unionByName(several.filter(~complete).select(*cols, "_p")).unionByName(latest)

    base = base.withColumn("_m", members(F.col("_p")))
    at_name = {n: f"_t{k}" for k, n in enumerate(target)}
    typed = base.select("*", *(strict_value(F.try_element_at("_m", F.lit(n)), kind).alias(at_name[n]) for n, kind in target.items()))
    fitting = F.array_compact(F.array(*(F.when(F.col(at_name[n]).isNotNull(), F.lit(n)) for n in target))) if target else F.array().cast("array<string>")
    lost = F.map_filter("_m", lambda k, _: ~F.array_contains(fitting, k))
    return typed.select(
        *cols, *(F.col(at_name[n]).alias(n) for n in target), F.when(F.size(lost) > 0, F.to_json(lost)).alias("_rescued"), F.when(F.col("_m").isNull(), F.col("_p")).alias("_raw")
    )


def replay(table: DataFrame, approved: Mapping[str, Sequence[str]]) -> DataFrame:
    """An ingested table with rescued values read into typed columns.

    ``approved`` maps a column to further names whose rescued values it may take; its own name comes first, then these in
    order. A column that has a value keeps it. Values that were taken, and nulls under an approved name, leave ``_rescued``;
    a value that can't be read, or stands beside one already taken, stays there. Replaying again changes nothing.
    """
    kinds = dict(table.dtypes)
    missing = [c for c in approved if c not in kinds]
    if missing:
        raise ValueError(f"no such columns: {missing}")
    names = {c: tuple(dict.fromkeys((c, *more))) for c, more in approved.items()}
    held = table.withColumn("_m", members(F.col("_rescued")))
    option = lambda n, kind: F.struct(F.lit(n).alias("name"), lenient_value(F.try_element_at("_m", F.lit(n)), kind).alias("value"))
    first = lambda c: F.get(F.filter(F.array(*(option(n, kinds[c]) for n in names[c])), lambda o: o["value"].isNotNull()), F.lit(0))
    held = held.select("*", *(F.when(F.col(c).isNull() & F.col("_m").isNotNull(), first(c)).alias(f"_take{k}") for k, c in enumerate(names)))
    taken = F.array_compact(F.array(*(F.col(f"_take{k}.name") for k in range(len(names)))))
    known = F.array(*map(F.lit, sorted({n for more in names.values() for n in more})))
    left = F.map_filter("_m", lambda k, v: ~F.array_contains(taken, k) & ~(F.array_contains(known, k) & F.is_variant_null(v)))
    values = {c: F.coalesce(F.col(c), F.col(f"_take{k}.value")) for k, c in enumerate(names)}
    rescued = F.when(F.size(left) > 0, F.to_json(left))
    return held.select(*(values[c].alias(c) if c in values else rescued.alias(c) if c == "_rescued" else F.col(c) for c in table.columns))


def exploded_fields(table: DataFrame, target: Mapping[str, str], keep: Sequence[str | Column]) -> DataFrame:
    """One row per field of each row of an ingested table: ``keep``, ``field``, ``kind``, ``text``, ``number``."""

    def typed(name: str, kind: str) -> Column:
        json = "number" if kind in (*WHOLE_TYPES, *REAL_TYPES) else "boolean" if kind == "boolean" else "string"
        number = F.col(name).cast("double") if json == "number" else plain_number(F.col(name)) if kind == "string" else F.lit(None).cast("double")
        held = F.struct(F.lit(name).alias("field"), F.lit(json).alias("kind"), F.col(name).cast("string").alias("text"), number.alias("number"))
        return F.when(F.col(name).isNotNull(), held)

    def rescued(e: Column) -> Column:
        text = plain_text(e["value"])
        return F.struct(e["key"].alias("field"), json_kind(e["value"]).alias("kind"), text.alias("text"), plain_number(text).alias("number"))

    lost = F.transform(F.map_entries(members(F.col("_rescued"))), rescued)
    fields = F.concat(F.array_compact(F.array(*(typed(n, kind) for n, kind in target.items()))), F.coalesce(lost, F.array().cast("array<struct<field:string,kind:string,text:string,number:double>>")))
    return table.select(*keep, F.inline(fields))


def number_files(files: DataFrame, stream: str, file: str, at: str) -> DataFrame:
    """``seq`` from 1 per stream by (``at``, ``file``), and ``last_seq``; sorted per stream and day, so that no stream is one task."""
    files = files.withColumn("_day", F.date_trunc("day", at))
    counts = files.groupBy(stream, "_day").agg(F.count("*").alias("_n"))
    by_day = Window.partitionBy(stream).orderBy(F.col("_day").asc_nulls_first())
    before = counts.select(
        F.col(stream).alias("_s"), F.col("_day").alias("_m"),
        (F.sum("_n").over(by_day) - F.col("_n")).alias("_before"), F.sum("_n").over(Window.partitionBy(stream)).alias("last_seq"),
    )
    inside = F.row_number().over(Window.partitionBy(stream, "_day").orderBy(F.col(at).asc_nulls_first(), file))
    ranked = files.withColumn("_in", inside)
    joined = ranked.join(before, F.col(stream).eqNullSafe(F.col("_s")) & F.col("_day").eqNullSafe(F.col("_m")))
    return joined.withColumn("seq", (F.col("_before") + F.col("_in")).cast("long")).drop("_s", "_m", "_before", "_in", "_day")


def last_before(df: DataFrame, keys: Sequence[str], order: str, value: str, out: str) -> DataFrame:
    """``out``: the last non-null ``value`` at a lower ``order``, carried over blocks of ``order``."""
    df = df.withColumn("_block", F.floor(F.col(order) / BLOCK))
    inside = F.last(value, ignorenulls=True).over(Window.partitionBy(*keys, "_block").orderBy(order).rowsBetween(Window.unboundedPreceding, -1))
    blocks = df.groupBy(*keys, "_block").agg(F.max_by(value, F.when(F.col(value).isNotNull(), F.col(order))).alias("_end"))
    carried = blocks.withColumn(
        "_carry", F.last("_end", ignorenulls=True).over(Window.partitionBy(*keys).orderBy("_block").rowsBetween(Window.unboundedPreceding, -1))
    ).drop("_end")
    return df.withColumn("_inside", inside).join(carried, [*keys, "_block"]).withColumn(out, F.coalesce("_inside", "_carry")).drop("_inside", "_carry", "_block")


def _name_likeness(a: Column, b: Column) -> Column:
    flat = lambda c: F.regexp_replace(F.lower(c), "[^a-z0-9]", "")
    x, y = flat(a), flat(b)
    return 1 - F.levenshtein(x, y) / F.greatest(F.length(x), F.length(y), F.lit(1))


def schema_changes(
    table: DataFrame,
    target: Mapping[str, str],
    *,
    stream: str = "stream_id",
    file: str = "file_id",
    at: str = "written_at",
    entity: str = "sample",
    least_score: float = 0.5,
) -> DataFrame:
    """Every change of a field against the previous file of its stream: ``file``, ``field_name``, ``change_kind``, ``new_name``.

    ``table`` is what ``ingest`` gave for ``target``, before any replay: a field is in a row if its column has a value or its
    name was rescued, and has the JSON type of its column or of its rescued value. A removed and an added field of one file
    are the same quantity (``renamed``) if they are each other's best partner with a score of ``least_score`` or more: both
    carry numbers and their central ranges in the stream overlap, or both carry text from overlapping value sets; equal
    values for the same entity in the two files, and like names, add to the score. Two flags need such support.

    Defined cases: payloads that are null, no valid JSON or no object are no rows of the file; a file without any valid row
    is not in the series; null values have no type; of several types in one file the most frequent counts, ties by name;
    files of equal time are ordered by id; a null stream is a stream of its own, a null file none; an empty table gives an
    empty result; other columns are ignored.
    """
    # read three times below; written once, so that rows are parsed once
    held = checkpointed(table.filter(F.col(file).isNotNull() & F.col("_raw").isNull()))
    own = F.col(entity).cast("string") if entity in target else F.lit(None).cast("string")
    # an entity of another type was rescued
    named = F.coalesce(own, F.get_json_object("_rescued", f"$.{entity}"))
    keys = [F.coalesce(F.col(stream), F.lit("")).alias("s"), F.col(file).alias("f"), F.col(at).alias("w"), named.alias("entity")]
    cells = exploded_fields(held, target, keys)

    # one row per (file, field): everything later works on this
    when = lambda c: F.when(c, 1)
    number = F.col("number")
    profile = cells.groupBy("s", "f", "field").agg(
        F.min("w").alias("w"), *(F.count(when(F.col("kind") == k)).alias(f"_{k}") for k in _KINDS),
        F.count("kind").alias("n"), F.count("number").alias("known"), F.count(when(number == F.floor(number))).alias("whole"),
        F.min("number").alias("least"), F.max("number").alias("most"), F.sum("number").alias("total"), F.sum(number * number).alias("squares"),
    )
    top = F.greatest(*(f"_{k}" for k in _KINDS))
    kind = F.lit(None).cast("string")
    for k in reversed(_KINDS):
        kind = F.when((top > 0) & (F.col(f"_{k}") == top), k).otherwise(kind)
    shape = ("n", "known", "whole", "least", "most", "total", "squares", F.col("_boolean").alias("flags"))
    profile = profile.select("s", "f", "w", "field", kind.alias("kind"), *shape)
    profile = checkpointed(profile)
    files = number_files(profile.groupBy("s", "f").agg(F.min("w").alias("w")), "s", "f", "w").select("s", "f", "seq", "last_seq")
    # read by all that follows; written once, so that plans stay small
    series = checkpointed(last_before(profile.select("s", "f", "field", "kind").join(files, ["s", "f"]), ("s", "field"), "seq", "kind", "kind_before"))
    files = series.select("s", "seq", "f").distinct()

    earlier = series.select("s", "field", (F.col("seq") + 1).alias("seq"))
    added = series.filter("seq > 1").join(earlier, ["s", "field", "seq"], "left_anti").select("s", "seq", "f", "field")
    later = series.select("s", "field", (F.col("seq") - 1).alias("seq"))
    gone = series.filter("seq < last_seq").join(later, ["s", "field", "seq"], "left_anti")
    gone = gone.select("s", (F.col("seq") + 1).alias("seq"), "field", F.col("f").alias("f_before"))
    removed = gone.join(files.select("s", "seq", "f"), ["s", "seq"])
    moved = added.withColumn("f_before", F.lit(None).cast(added.schema["f"].dataType)).withColumn("change_kind", F.lit("added"))
    moved = checkpointed(moved.unionByName(removed.withColumn("change_kind", F.lit("removed"))))
    added, removed = (moved.filter(F.col("change_kind") == k).drop("change_kind") for k in ("added", "removed"))

    # what a field's values look like in the stream
    sums = profile.groupBy("s", "field").agg(*(F.sum(c).alias(c) for c in ("n", "known", "whole", "total", "squares", "flags")), F.min("least").alias("least"), F.max("most").alias("most"))
    known = F.nullif(F.col("known"), F.lit(0))
    mean = F.col("total") / known
    spread = 1.65 * F.sqrt(F.greatest(F.col("squares") / known - mean * mean, F.lit(0.0)))
    numbers, flags = F.col("known") / F.col("n"), F.col("flags") / F.col("n")
    # the central part of the values, by mean and deviation; only fields of one class can be one quantity
    domain = sums.filter("n > 0").select(
        "s", "field", "known", F.greatest("least", mean - spread).alias("low"), F.least("most", mean + spread).alias("high"), (F.col("whole") / known).alias("wholes"),
        flags.alias("flags"), F.when(flags > 0.5, "flag").when(numbers > 0.5, "number").otherwise("text").alias("class"),
    )
    side = lambda df, n: df.withColumnRenamed("field", n).join(domain.select("s", F.col("field").alias(n), "class", *(F.col(c).alias(f"{n}_{c}") for c in ("low", "high", "known", "wholes", "flags"))), ["s", n])
    pairs = checkpointed(side(removed, "old").join(side(added.drop("f", "f_before"), "new"), ["s", "seq", "class"]))
    # one row per pair was written, so its number is known: the lists of fields to look up are broadcast if they are short
    n_pairs, n_texts = pairs.agg(F.count("*"), F.count(F.when(F.col("class") == "text", 1))).first()
    short = (lambda df: F.broadcast(df)) if 2 * n_pairs <= BROADCAST_ROWS else (lambda df: df)
    # only the paired fields of the files with such a pair are read again
    sides = pairs.select("s", F.col("f_before").alias("f"), F.col("old").alias("field")).unionByName(pairs.select("s", "f", F.col("new").alias("field"))).distinct()
    again = cells.filter("entity is not null and text is not null").join(short(sides), ["s", "f", "field"])
    values = again.select("s", "f", "field", "entity", F.coalesce(F.col("number").cast("string"), "text").alias("value")).distinct()
    olds = values.select("s", F.col("f").alias("f_before"), F.col("field").alias("old"), "entity", F.col("value").alias("x"))
    news = values.select("s", "f", F.col("field").alias("new"), "entity", F.col("value").alias("y"))
    agree = (
        pairs.select("s", "f", "f_before", "old", "new").join(olds, ["s", "f_before", "old"]).join(news, ["s", "f", "new", "entity"])
        .groupBy("s", "f", "old", "new").agg(F.count("*").alias("shared"), F.avg((F.col("x") == F.col("y")).cast("int")).alias("agreed"))
    )
    pairs = pairs.join(agree, ["s", "f", "old", "new"], "left")
    # texts: the share of their values that two fields have in common
    texts = pairs.filter("class = 'text'").select("s", "old", "new").distinct()
    listed = texts.select("s", F.explode(F.array("old", "new")).alias("field")).distinct()
    none = cells.sparkSession.createDataFrame([], "s string, field string, text string")
    sets = cells.filter("text is not null").join(short(listed), ["s", "field"]).select("s", "field", "text").distinct() if n_texts else none
    sizes = sets.groupBy("s", "field").agg(F.count("*").alias("size"))
    both = texts.join(sets.withColumnRenamed("field", "old"), ["s", "old"]).join(sets.withColumnRenamed("field", "new"), ["s", "new", "text"])
    both = both.groupBy("s", "old", "new").agg(F.count("*").alias("both"))
    sized = lambda n: sizes.select("s", F.col("field").alias(n), F.col("size").alias(f"{n}_size"))
    both = both.join(sized("old"), ["s", "old"]).join(sized("new"), ["s", "new"])
    shared = both.select("s", "old", "new", (F.col("both") / (F.col("old_size") + F.col("new_size") - F.col("both"))).alias("shared_values"))
    pairs = pairs.join(shared, ["s", "old", "new"], "left")

    low, high = F.greatest("old_low", "new_low"), F.least("old_high", "new_high")
    span = F.greatest("old_high", "new_high") - F.least("old_low", "new_low")
    narrow = F.least(F.col("old_high") - F.col("old_low"), F.col("new_high") - F.col("new_low"))
    common = F.greatest(high - low, F.lit(0))
    # few values fill only a part of their range: lying inside the other's counts as well
    inside = F.when(narrow > 0, common / narrow).otherwise((high >= low).cast("double"))
    overlap = 0.6 * inside + 0.4 * F.when(span > 0, common / span).otherwise(F.lit(1.0))
    fewest = F.least("old_known", "new_known")
    unlike = F.abs(F.col("old_wholes") - F.col("new_wholes")) * fewest / (fewest + 5)
    is_number, is_flag = F.col("class") == "number", F.col("class") == "flag"
    flag_like = F.when(F.col("old_flags") == F.col("new_flags"), 0.2).otherwise(0.0)
    like = F.when(is_flag, flag_like).when(is_number, overlap * (1 - unlike)).otherwise(F.coalesce("shared_values", F.lit(0.0)) * 0.8)
    # two flags agree by chance; they need several equal values
    witnesses = F.when(is_flag, 5).otherwise(1)
    agreed = F.coalesce(F.when((F.col("shared") >= witnesses) & (~is_flag | (F.col("agreed") >= 0.95)), F.col("agreed")), F.lit(0.0))
    names = _name_likeness(F.col("old"), F.col("new"))
    # a short stream may show too few values for its ranges to meet
    like = F.when(is_number & ((names >= 0.8) | ((F.col("shared") >= 2) & (agreed >= 0.8))), F.greatest(like, F.lit(0.3))).otherwise(like)
    support = 0.5 * agreed + 0.3 * names
    scored = pairs.withColumn("score", F.when(like > 0, like + support).otherwise(0.0)).filter(F.col("score") >= least_score)
    best = lambda side: F.row_number().over(Window.partitionBy("s", "seq", side).orderBy(F.desc("score"), "old", "new"))
    renamed = scored.withColumn("_o", best("old")).withColumn("_n", best("new")).filter("_o = 1 and _n = 1").select("s", "seq", "f", "old", "new")
    renamed = checkpointed(renamed)

    # a renamed field goes on from what its old name carried
    tail = series.select("s", F.col("field").alias("old"), (F.col("seq") + 1).alias("seq"), F.coalesce("kind", "kind_before").alias("old_kind"))
    heirs = renamed.join(tail, ["s", "old", "seq"]).select("s", F.col("new").alias("field"), F.col("seq").alias("from_seq"), "old_kind")
    first = series.filter("kind is not null and kind_before is null").join(heirs, ["s", "field"]).filter("seq >= from_seq and kind != old_kind")
    retyped = series.filter("kind is not null and kind_before is not null and kind != kind_before").select("f", "field").unionByName(first.select("f", "field")).distinct()

    change = lambda df, name, what, new: df.select(F.col("f").alias(file), F.col(name).alias("field_name"), F.lit(what).alias("change_kind"), new.alias("new_name"))
    none = F.lit("")
    taken = renamed.select("s", "seq", F.inline(F.array(F.struct(F.col("old").alias("field"), F.lit("removed").alias("change_kind")), F.struct(F.col("new").alias("field"), F.lit("added").alias("change_kind")))))
    plain = moved.join(taken, ["s", "seq", "field", "change_kind"], "left_anti")
    return (
        plain.select(F.col("f").alias(file), F.col("field").alias("field_name"), "change_kind", none.alias("new_name"))
        .unionByName(change(renamed, "old", "renamed", F.col("new")))
        .unionByName(change(retyped, "field", "retyped", none))
    )


