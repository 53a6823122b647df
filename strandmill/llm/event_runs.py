"""Repeated consecutive events: runs found by a regular expression over symbol strings.

The events of an entity become one string in order, a code point per canonical event, and a backreference finds the
repetitions of equal events. Events that continue the one before without being equal to it, and places where a run cannot go
on, carry a mark before their code point. The matches map back to the events' positions. Everything is a per-row array
expression of linear cost: no shuffle of events and no Python.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strandmill.operators.nested_records import in_order, parse_records, with_previous

#: Private-use code points for canonical events. A break between runs is marked, so two events of one code point never meet by chance.
FIRST_SYMBOL, SYMBOLS = 0xE000, 6_400
#: Marks before an event that starts anew, and before one that continues its neighbour without being equal.
BREAK, NEAR = "|", "~"
#: One run: equal events, joined by near ones. Possessive, so that long runs neither backtrack nor deepen the matcher's stack.
RUN = rf"(?s)([^{BREAK}{NEAR}])\1*+(?:{NEAR}([^{BREAK}{NEAR}])\2*+)*+"


def differing(a: Column, b: Column) -> Column:
    """The number of places in which two texts of equal length differ."""
    pairs = F.zip_with(F.split(a, ""), F.split(b, ""), lambda x, y: F.when(x != y, 1).otherwise(0))
    return F.aggregate(pairs, F.lit(0), lambda n, x: n + x)


def cleaned(events: Column) -> Column:
    """Events with what they are compared by, worked out once each: ``pos``, ``length``, ``bases``, ``name``, ``symbol``.

    An event's symbol is a code point for what it is apart from its place: its sequence, or its name where it has none.
    """

    def one(m: Column) -> Column:
        bases = F.when(F.trim(m["sequence"]) != "", F.upper(F.trim(m["sequence"])))
        name = F.when(F.trim(m["name"]) != "", F.trim(m["name"]))
        return F.struct(m["pos"].alias("pos"), m["length"].alias("length"), bases.alias("bases"), name.alias("name"))

    return F.transform(F.transform(events, one), lambda m: F.struct(m["pos"].alias("pos"), m["length"].alias("length"), m["bases"].alias("bases"), m["name"].alias("name"), _symbol(m).alias("symbol")))


def same_unit(a: Column, b: Column, most: int) -> Column:
    """Cleaned events whose sequences are of equal length and differ in at most ``most`` bases; where either has none, equal names."""
    x, y = a["bases"], b["bases"]
    # edits are never more than differing places: the cheap bound goes first
    near = F.when(F.length(x) != F.length(y), False).when(F.levenshtein(x, y, most) < 0, False).otherwise(differing(x, y) <= most)
    return F.when(x == y, True).otherwise(F.coalesce(F.when(x.isNotNull() & y.isNotNull(), near).otherwise(a["name"] == b["name"]), F.lit(False)))


def _symbol(event: Column) -> Column:
    what = F.coalesce(F.concat(F.lit("s"), event["bases"]), F.concat(F.lit("n"), event["name"]), F.lit(""))
    return F.decode(F.unhex(F.hex(F.lit(FIRST_SYMBOL) + F.pmod(F.xxhash64(what), F.lit(SYMBOLS)))), "UTF-16BE")


def marked_symbols(pairs: Column, most: int) -> Column:
    """Per pair of ``with_previous`` over cleaned events its code point, with a mark before it unless the event equals the one before and follows it without a gap."""

    def one(x: Column) -> Column:
        m, p = x["m"], x["p"]
        follows = F.coalesce(p["pos"] + p["length"] == m["pos"], F.lit(False))
        equal = F.coalesce(p["bases"] == m["bases"], p["bases"].isNull() & m["bases"].isNull() & (p["name"] == m["name"]), F.lit(False))
        mark = F.when(~follows, BREAK).when(equal, "").when(same_unit(p, m, most), NEAR).otherwise(BREAK)
        return F.concat(mark, m["symbol"])

    return F.transform(pairs, one)


def runs_of(events: Column, symbols: Column, least: int) -> Column:
    """Array of ``start_pos``, ``end_pos``, ``n_units`` of the maximal runs of ``least`` or more events."""
    # every break starts one match: the k-th match begins at the k-th break
    starts = F.filter(F.transform(symbols, lambda s, i: F.when(s.startswith(BREAK), i)), lambda i: i.isNotNull())
    sizes = F.transform(F.regexp_extract_all(F.array_join(symbols, ""), F.lit(RUN), 0), lambda t: F.length(F.replace(t, F.lit(NEAR), F.lit(""))))
    spans = F.filter(F.zip_with(starts, sizes, lambda i, n: F.struct(i.alias("first"), (i + n - 1).alias("last"), n.alias("n"))), lambda r: r["n"] >= least)
    return F.transform(
        spans,
        lambda r: F.struct(
            F.get(events, r["first"])["pos"].alias("start_pos"),
            (F.get(events, r["last"])["pos"] + F.coalesce(F.get(events, r["last"])["length"], F.lit(0))).alias("end_pos"),
            r["n"].alias("n_units"),
        ),
    )


def motif_runs(raw: DataFrame, *, file_id: str = "file_id", body: str = "body", most: int = 2, least: int = 2) -> DataFrame:
    """Every run of one repeat unit in the haplotypes of analyzer files: ``file_id``, ``hap_rank``, ``start_pos``, ``end_pos``, ``n_units``.

    Being the same unit is no equivalence (two neighbours may each be near a third unit), so near neighbours are compared in
    pairs along the array and joined by a mark; runs of equal units are found by the regular expression alone.

    Defined cases: files as in ``parse_records`` (invalid and null bodies give nothing, a file delivered twice counts
    once); events without a position are no events; an event stored twice at one position counts once, as first stored;
    an event without a length ends a run; without sequence and name it equals nothing; empty arrays and an empty table
    give no rows; arrays of any length are read in time in proportion to it; other columns are ignored.
    """
    haps = parse_records(raw, file_id=file_id, body=body).select("file_id", F.explode("haps").alias("h"))
    # materialised step by step, else each expression would repeat the ones below it
    ordered = haps.select("file_id", F.col("h.hap_rank").alias("hap_rank"), in_order(F.col("h.motifs")).alias("e"))
    clean = ordered.select("file_id", "hap_rank", cleaned(F.col("e")).alias("e"))
    coded = clean.withColumn("s", marked_symbols(with_previous(F.col("e")), most))
    return coded.select("file_id", "hap_rank", F.inline(runs_of(F.col("e"), F.col("s"), least)))
