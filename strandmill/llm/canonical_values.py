"""Free-entered variant names mapped to a reference list by a set-similarity join.

An entry is read as a set of tokens: of a named change its kind, its positions or size and its bases; of a name its letters
and letter pairs. A prefix-filtered join finds the most similar entry of the list and its similarity decides.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strandmill.functions.keyed import attach
from strandmill.functions.lineage import checkpointed
from strandmill.llm.similarity_join import best_match, similar_pairs

#: Names are compared from this similarity on; a change must agree in every token.
NAME_SIMILARITY = 0.55
#: A name may differ by up to this many edits.
NAME_EDITS = 2

# Kind marks: upper case letters, which the lower-cased text doesn't hold.
_KINDS = {"D": ("dup", "dupl", "duplication"), "L": ("del", "deletion"), "I": ("ins", "insertion"), "X": ("indel", "delins")}
_FULL_WIDTH = "".join(chr(c) for c in range(0xFF01, 0xFF5F))
_HALF_WIDTH = "".join(chr(c - 0xFEE0) for c in range(0xFF01, 0xFF5F))
_ACCENTS = ("áàâäãéèêëíìîïóòôöõúùûüçñ", "aaaaaeeeeiiiiooooouuuucn")


#: Runs of blanks of any kind, and marks without width.
BLANKS = r"[\s\x{00A0}\x{2000}-\x{200D}\x{202F}\x{2060}\x{3000}\x{FEFF}]+"


def _misspelt(word: str) -> set[str]:
    """The word, and it with two neighbours exchanged, a letter doubled or, if it is long, a letter left out."""
    swaps = {word[:k] + word[k + 1] + word[k] + word[k + 2 :] for k in range(len(word) - 1)}
    doubles = {word[:k] + word[k] + word[k:] for k in range(len(word))}
    drops = {word[:k] + word[k + 1 :] for k in range(1, len(word))} if len(word) >= 6 else set()
    return {word} | swaps | doubles | drops


def _kind_pattern(mark: str) -> str:
    words = set().union(*(_misspelt(w) for w in _KINDS[mark]))
    others = set().union(*(_misspelt(w) for m, ws in _KINDS.items() if m != mark for w in ws))
    known = set().union(*map(set, _KINDS.values()))
    words = {w for w in words if w in _KINDS[mark] or w not in others and w not in known}
    # kind words may follow a digit and be followed by bases, but are no parts of other words
    return r"(?<![a-z])(?<![a-z][a-z])((?<=[0-9][lo])|)(?:" + "|".join(sorted(words, key=lambda w: (-len(w), w))) + r")(?=[acgtnlo]*(?![a-z]))"


def fold(value: Column) -> Column:
    """Lower case, without accents, full-width forms, odd dashes and odd blanks."""
    x = F.translate(value, _FULL_WIDTH, _HALF_WIDTH)
    x = F.translate(F.lower(x), *_ACCENTS)
    x = F.regexp_replace(x, r"[\x{2010}-\x{2015}\x{2212}]", "-")
    return F.trim(F.regexp_replace(x, BLANKS, " "))


def change_text(value: Column, *, digit_first: bool = False) -> Column:
    """An entry with kind marks for kind words and digits for letters read as such, without doubt marks, unit letters and repeat numbers.

    ``digit_first`` reads an l after a kind word as the digit it may stand for, not as part of the word.
    """
    x = F.regexp_replace(fold(value), r"@? ?repeat ?[0-9lo]+", " ")
    x = F.regexp_replace(x, r"\(conf\.?\)|\bhet\b|[?!*]", " ")
    x = F.regexp_replace(F.trim(x), r"^[cgnp]\. ?", "")
    x = F.regexp_replace(x, r"^[a-z]-(?=[a-z0-9])", "")
    if digit_first:
        x = F.regexp_replace(x, r"(?<=(?:del|dle|dup|dpu|ins|isn))l(?=[0-9l]+(?![a-z]))", "1")
    # a digit's look-alike before a kind word would hide the word
    x = F.regexp_replace(x, r"(?<=[0-9])[l](?=[dix])", "1")
    x = F.regexp_replace(x, r"(?<=[0-9])[o](?=[dix])", "0")
    for mark in ("X", "D", "L", "I"):
        x = F.regexp_replace(x, _kind_pattern(mark), mark)
    x = F.regexp_replace(x, r"L[ /_-]*I", "X")
    # letters that stand for digits: next to a digit, or a number of their own
    for letter, digit in (("l", "1"), ("o", "0")):
        x = F.regexp_replace(x, rf"(?<=[0-9]){letter}|{letter}(?=[0-9])", digit)
    for letter, digit in (("l", "1"), ("o", "0")):
        x = F.regexp_replace(x, rf"(?<=[0-9]){letter}|{letter}(?=[0-9])", digit)
    x = F.regexp_replace(x, r"(?<![a-z0-9])ll(?![a-z0-9])", "11")
    return F.regexp_replace(x, r"(?<![a-z0-9])lo(?![a-z0-9])", "10")


def change_tokens(text: Column) -> Column:
    """Tokens of a change (``change_text``): kind, positions or size, bases; null if it names no change."""
    kind = F.regexp_extract(text, "([DLIX])", 1)
    bases = F.regexp_extract(text, r"[DLIX][ ._:(-]*(?:of |de |d')?[ ]*([acgt]+)(?![a-z])", 1)
    # "14 a 29" is a span
    spans = F.regexp_replace(text, r"(?<=[0-9]) a (?=[0-9])", "-")
    is_span = spans != text
    bases = F.when(is_span & (bases == "a") & ~text.rlike("[DLIX][ ._:(-]*a(?! [0-9])"), "").otherwise(bases)
    numbers = F.transform(F.regexp_extract_all(spans, F.lit("([0-9]+)"), 1), lambda n: F.regexp_replace(n, "^0+(?=[0-9])", ""))
    at = F.when(F.size(numbers) > 0, F.concat(F.lit("at:"), F.array_join(numbers, "_"))).otherwise("at:none")
    return F.when(kind != "", F.array(F.concat(F.lit("kind:"), kind), at, F.concat(F.lit("bases:"), bases)))


def name_tokens(text: Column) -> Column:
    """Letters, numbered where they recur, and letter pairs of a name."""
    letters = F.filter(F.split(F.regexp_replace(text, "[^a-z0-9]", ""), ""), lambda c: c != "")
    times = lambda c: F.sequence(F.lit(1), F.size(F.filter(letters, lambda d: d == c)))
    numbered = F.flatten(F.transform(F.array_distinct(letters), lambda c: F.transform(times(c), lambda i: F.concat(F.lit("letter:"), c, i.cast("string")))))
    padded = F.concat(F.array(F.lit("^")), letters, F.array(F.lit("$")))
    pairs = F.zip_with(F.slice(padded, 1, F.size(padded) - 1), F.slice(padded, 2, F.size(padded) - 1), lambda x, y: F.concat(F.lit("pair:"), x, y))
    return F.when(F.size(letters) > 1, F.concat(numbered, pairs))


def reference_sets(reference: DataFrame) -> DataFrame:
    """``id``, ``variant_id``, ``name`` and ``tokens`` of every way to name an entry of the list."""
    known = reference.filter("variant_id is not null").select("variant_id", "variant", "other_name")
    exact = known.filter("variant is not null").select("variant_id", change_tokens(change_text(F.col("variant"))).alias("tokens")).filter("tokens is not null")
    kind, bases = F.col("tokens")[0], F.col("tokens")[2]
    # kind and bases are enough where only one entry has them
    loose = exact.filter(bases != "bases:").groupBy(kind.alias("k"), bases.alias("b")).agg(F.min("variant_id").alias("variant_id"), F.countDistinct("variant_id").alias("n"))
    loose = loose.filter("n = 1").select("variant_id", F.array("k", F.lit("at:none"), "b").alias("tokens"))
    names = known.filter("other_name is not null").select("variant_id", fold(F.col("other_name")).alias("full"))
    first = F.split("full", " ")[0]
    names = names.select("variant_id", F.explode(F.array_distinct(F.array("full", first))).alias("name"))
    names = names.withColumn("tokens", name_tokens(F.col("name"))).filter("tokens is not null")
    changes = exact.unionByName(loose).withColumn("name", F.lit(None).cast("string"))
    return changes.unionByName(names).distinct().withColumn("id", F.concat_ws("/", F.lpad(F.col("variant_id").cast("string"), 12, "0"), F.array_join("tokens", ",")))


def _entries(rows: DataFrame, key: str, value: str) -> DataFrame:
    cell = F.col(value)
    held = rows.filter(cell.isNotNull() & ~F.lower(F.trim(F.regexp_replace(cell, BLANKS, " "))).isin("", "nan"))
    return held.select(F.col(key).alias("key"), F.posexplode(F.split(cell, r"\|", -1)).alias("at", "entry"))


def map_entries(rows: DataFrame, reference: DataFrame, *, key: str = "row_id", value: str = "variant_raw") -> DataFrame:
    """Each entry of ``value`` with its entry of the list: ``key``, ``entry_no``, ``entry``, ``variant_id`` (0: unmatched), ``similarity``.

    Equal entries are compared once. Defined cases: null, blank and 'nan' cells have no entries; a blank entry between
    marks counts and is unmatched; ties go to the smaller ``variant_id``; repeated rows are kept; an empty table gives no
    rows, an empty list leaves everything unmatched; other columns are ignored.
    """
    entries = _entries(rows, key, value)
    readings = F.array_distinct(F.array(change_text(F.col("entry")), change_text(F.col("entry"), digit_first=True)))
    texts = entries.groupBy("entry").agg(F.count("*").alias("n")).select("entry", "n", F.explode(readings).alias("text"), fold(F.col("entry")).alias("folded"))
    plain = F.trim(F.regexp_replace(F.regexp_replace(F.col("folded"), r"@? ?repeat ?[0-9lo]+|\(conf\.?\)|\bhet\b|[?!*]", " "), "^[a-z]-", ""))
    # one row per distinct reading, and the list: both are read several times below, so that they are worked out once
    # a short id, as it is copied to each token of a perhaps very long entry
    sets = checkpointed(texts.select(F.sha2(F.concat_ws("\u0000", "entry", "text"), 256).alias("id"), "entry", "n", plain.alias("plain"), F.coalesce(change_tokens(F.col("text")), name_tokens(plain)).alias("tokens")))
    known = checkpointed(reference_sets(reference))
    pairs = similar_pairs(sets.select("id", "tokens"), known.select("id", "tokens"), NAME_SIMILARITY)
    pairs = pairs.join(known.select(F.col("id").alias("right_id"), "variant_id", "name"), "right_id").join(sets.select(F.col("id").alias("left_id"), "entry", "plain"), "left_id")
    close = F.when(F.col("name").isNull(), F.col("similarity") > 1 - 1e-9).otherwise(F.levenshtein("plain", "name") <= NAME_EDITS)
    best = best_match(pairs.filter(close).select(F.col("entry").alias("left_id"), F.col("variant_id").alias("right_id"), "similarity"))
    spelled = sets.select("entry", "n").distinct()
    found = spelled.join(best.select(F.col("left_id").alias("entry"), F.col("right_id").alias("variant_id"), "similarity"), "entry", "left")
    # one spelling may fill a third of the rows: frequent ones, matched or not, are broadcast
    total = spelled.agg(F.sum("n")).first()[0] or 0
    joined = attach(entries, found, "entry", "n", total)
    return joined.select(
        F.col("key").alias(key), (F.col("at") + 1).alias("entry_no"), "entry", F.coalesce("variant_id", F.lit(0)).cast("int").alias("variant_id"), "similarity"
    )
