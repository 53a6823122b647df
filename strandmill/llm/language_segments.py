"""Missing or wrong language labels: hyperdimensional letter profiles.

Letters have random vectors; permuting and multiplying three of them binds an n-gram, summing n-grams bundles a text, and
the cosine with the bundles of labelled text tells the language. As bundling is a sum, a text's product with a prototype is
the sum of its n-grams' products, which are tabled once: scoring a text is one look-up per letter.
"""

from __future__ import annotations

import re
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strandmill.llm.leak_search import repaired

#: Length of the vectors.
DIMENSIONS = 2_048
#: Places in the alphabet: blank, unknown letter, and the most frequent letters of the sample.
ALPHABET = 64
#: The classifier is fitted on at most so many labelled documents of a language, drawn by a hash of the id, of at most so many letters each.
SAMPLE_PER_LANGUAGE, MOST_CHARS = 300, 50_000
#: Without a list of languages, those of the labels: each with this part of the labelled documents or more, and so many at most.
LEAST_SHARE, MOST_LANGUAGES = 0.01, 64
#: A sentence has at least so many words and letters, and letters make up this part of it; formulas have fewer.
LEAST_WORDS, LEAST_LETTERS, LEAST_DENSITY = 4, 18, 0.6
#: The best language must lead the next by this part of its cosine.
LEAST_LEAD = 0.08
#: Accepted names of a language.
NAMES = {
    "en": ("en", "eng", "english"), "de": ("de", "deu", "ger", "german", "deutsch"), "fr": ("fr", "fra", "fre", "french"),
    "es": ("es", "spa", "spanish"), "pt": ("pt", "por", "portuguese"), "und": ("und",),
}
#: Labels that say nothing.
NO_LABEL = ("", "unknown", "xx")

_END = re.compile(r"[.!?;]+(?=\s)|\n+")


def canonical_label(label: Column) -> Column:
    """The language a label names, whatever its case, region or length; null if it is missing, itself if it is unknown."""
    text = F.lower(F.trim(label))
    base = F.split(text, "[-_]")[0]
    out = base
    for language, names in NAMES.items():
        out = F.when(base.isin(*names), language).otherwise(out)
    return F.when(text.isin(*NO_LABEL), None).otherwise(out)


@dataclass(frozen=True)
class Profiles:
    """The tabled products of every n-gram with the prototypes of ``languages``."""

    languages: tuple[str, ...]
    letters: np.ndarray  # code point -> place in the alphabet
    table: np.ndarray  # n-gram -> product with each prototype of length 1, in units of an n-gram vector's length

    def symbols(self, text: str) -> np.ndarray:
        points = np.frombuffer(text.encode("utf-32-le", "replace"), "<u4")
        return self.letters[np.minimum(points, len(self.letters) - 1)]

    def products(self, symbols: np.ndarray) -> np.ndarray:
        """Product of the n-gram at each place (two are added at the end) with each prototype."""
        s = symbols.astype(np.int32)
        grams = np.zeros(len(s), np.int32)
        if len(s) > 2:
            grams[:-2] = (s[:-2] * ALPHABET + s[1:-1]) * ALPHABET + s[2:]
        return self.table[grams]


def _letter_table(texts: Sequence[str]) -> np.ndarray:
    points = np.frombuffer("".join(texts).encode("utf-32-le", "replace"), "<u4")
    counts = np.bincount(np.minimum(points, 0x3000), minlength=0x3001)
    table = np.zeros(0x3001, np.uint8)
    is_letter = np.array([chr(c).isalpha() for c in range(0x3001)])
    is_letter[0x3000] = False
    table[is_letter] = 1
    frequent = sorted(np.flatnonzero(is_letter & (counts > 0)), key=lambda c: (-counts[c], c))[: ALPHABET - 2]
    for place, c in enumerate(frequent, 2):
        table[c] = place
    return table


def _tabled(counts: np.ndarray) -> np.ndarray:
    """From n-gram counts per language to the table of products with the prototypes."""
    rng = np.random.default_rng(2_024)
    base = rng.choice(np.array([-1.0, 1.0], np.float32), (ALPHABET, DIMENSIONS))
    one, two, three = np.roll(base, 2, axis=1), np.roll(base, 1, axis=1), base
    pair = lambda a: one[a] * two  # noqa: E731  (ALPHABET x DIMENSIONS for a first letter)
    by_first = counts.reshape(len(counts), ALPHABET, ALPHABET, ALPHABET).astype(np.float32)
    prototypes = np.zeros((len(counts), DIMENSIONS), np.float32)
    for a in range(ALPHABET):
        if by_first[:, a].any():
            # sum over b and c of count * one[a] * two[b] * three[c]
            prototypes += np.einsum("lbd,bd->ld", by_first[:, a] @ three, pair(a), optimize=True)
    prototypes /= np.maximum(np.linalg.norm(prototypes, axis=1, keepdims=True), 1e-9)
    table = np.zeros((ALPHABET, ALPHABET, ALPHABET, len(counts)), np.float32)
    for a in range(ALPHABET):
        bound = pair(a)
        for k, p in enumerate(prototypes):
            table[a, :, :, k] = (bound * p) @ three.T
    table /= np.sqrt(DIMENSIONS)
    # runs of blanks are no n-grams
    table[0, 0], table[:, 0, 0] = 0, 0
    return table.reshape(-1, len(counts))


def fit(samples: dict[str, list[str]], rounds: int = 2) -> Profiles:
    """Profiles of the languages of ``samples``; the labels may be partly wrong.

    After the first fit the sample's sentences are labelled anew and counted again, ``rounds`` times in all.
    """
    languages = tuple(sorted(samples))
    texts = {k: [repaired(t).lower() for t in samples[k]] for k in languages}
    letters = _letter_table([t for k in languages for t in texts[k]])
    size = ALPHABET**3
    counts = np.zeros((len(languages), size))
    joined, profiles = "\n\n".join(t for k in languages for t in texts[k]), None
    for turn in range(max(rounds, 1)):
        if profiles is None:
            for k, language in enumerate(languages):
                counts[k] = _gram_counts(letters[np.minimum(np.frombuffer("\n\n".join(texts[language]).encode("utf-32-le", "replace"), "<u4"), 0x3000)], size)
        else:
            symbols = profiles.symbols(joined)
            starts, scores, _, ok = _sentences(joined, symbols, profiles)
            stops = np.append(starts[1:], len(symbols))
            counts[:] = 0
            for k in range(len(languages)):
                chosen = np.zeros(len(symbols) + 1, np.int8)
                mine = ok & (scores.argmax(axis=1) == k)
                np.add.at(chosen, starts[mine], 1)
                np.add.at(chosen, stops[mine], -1)
                counts[k] = _gram_counts(symbols[np.cumsum(chosen[:-1]) > 0], size)
        profiles = Profiles(languages, letters, _tabled(np.sqrt(counts)))
    return profiles


def _gram_counts(symbols: np.ndarray, size: int) -> np.ndarray:
    s = symbols.astype(np.int64)
    return np.bincount((s[:-2] * ALPHABET + s[1:-1]) * ALPHABET + s[2:], minlength=size) if len(s) > 2 else np.zeros(size)


def _sentences(text: str, symbols: np.ndarray, profiles: Profiles) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Start, cosines, number of n-grams of each piece between sentence ends, and whether it is a sentence of one language."""
    starts = np.array([0, *(m.end() for m in _END.finditer(text))], np.int64)
    starts = starts[starts < len(symbols)]
    if not len(starts):
        return np.zeros(0, np.int64), np.zeros((0, len(profiles.languages))), np.zeros(0), np.zeros(0, bool)
    is_letter = symbols > 0
    # n-grams must not reach over a sentence end: the end marks are blanks, so they only add word ends
    sums = np.add.reduceat(profiles.products(symbols), starts, axis=0)
    before = np.concatenate([[False], is_letter[:-1]])
    words = np.add.reduceat((is_letter & ~before).astype(np.int64), starts)
    letters = np.add.reduceat(is_letter.astype(np.int64), starts)
    length = np.diff(np.append(starts, len(symbols)))
    scores = sums / np.sqrt(np.maximum(letters + words, 1))[:, None]
    if scores.shape[1] > 1:
        top = np.partition(scores, -2, axis=1)[:, -2:]
        lead = top[:, 1] - top[:, 0]
    else:
        top = np.repeat(scores, 2, axis=1)
        lead = top[:, 1]
    ok = (words >= LEAST_WORDS) & (letters >= LEAST_LETTERS) & (letters >= LEAST_DENSITY * length) & (top[:, 1] > 0) & (lead >= LEAST_LEAD * top[:, 1])
    return starts, scores, letters, ok


def segments_of(texts: Sequence[str | None], profiles: Profiles) -> list[list[tuple[str, float, int, int]]]:
    """Per text its segments in reading order: language, confidence, first letter, letter after the last."""
    plain = [repaired(t).lower() if t else "" for t in texts]
    edges = np.cumsum([0, *(len(t) + 2 for t in plain)])
    joined = "\n\n".join(plain)
    symbols = profiles.symbols(joined)
    starts, scores, letters, ok = _sentences(joined, symbols, profiles)
    stops = np.append(starts[1:], len(symbols))
    out: list[list] = [[] for _ in texts]
    at = np.flatnonzero(ok)
    best = scores.argmax(axis=1)
    ordered = np.sort(scores, axis=1)
    lead = np.clip((ordered[:, -1] - ordered[:, -2]) / np.maximum(ordered[:, -1], 1e-9), 0, 1) if scores.shape[1] > 1 else np.ones(len(scores))
    owner = np.searchsorted(edges, starts[at], side="right") - 1
    for d, i in zip(owner.tolist(), at.tolist(), strict=True):
        own, language, weight = out[d], int(best[i]), int(letters[i])
        if own and own[-1][0] == language:
            own[-1][1] += lead[i] * weight
            own[-1][2] += weight
            own[-1][4] = int(stops[i])
        else:
            own.append([language, lead[i] * weight, weight, int(starts[i]), int(stops[i])])
    return [
        [(profiles.languages[k], round(float(x / w), 4), a - int(edges[d]), b - int(edges[d])) for k, x, w, a, b in own] or [("und", 1.0, 0, len(plain[d]))]
        for d, own in enumerate(out)
    ]


def labelled_sample(
    documents: DataFrame, languages: Sequence[str] | None, *, doc_id: str = "doc_id", text: str = "text", lang: str = "lang", per_language: int = SAMPLE_PER_LANGUAGE
) -> DataFrame:
    """``id``, ``lang``, ``text`` of at most ``per_language`` documents per language, those of least hash; none of over ``MOST_CHARS`` letters."""
    labelled = documents.select(F.col(doc_id).alias("id"), canonical_label(F.col(lang)).alias("lang")).filter("id is not null and lang is not null and lang != 'und'")
    if languages is None:
        counts = labelled.groupBy("lang").agg(F.count("*").alias("n"))
        # one row per label; Spark keeps the most frequent of each task only
        counts = counts.withColumn("share", F.col("n") / F.sum("n").over(Window.partitionBy(F.lit(1)))).filter(F.col("share") >= LEAST_SHARE).orderBy(F.desc("n"), "lang").limit(MOST_LANGUAGES)
        labelled = labelled.join(F.broadcast(counts.select("lang")), "lang")
    else:
        labelled = labelled.filter(F.col("lang").isin(list(languages)))
    # ids only: each task keeps its smallest hashes before they are shuffled
    ranked = labelled.withColumn("r", F.row_number().over(Window.partitionBy("lang").orderBy(F.xxhash64("id"), "id"))).filter(F.col("r") <= per_language)
    chosen = ranked.groupBy("id").agg(F.min("lang").alias("lang"))
    texts = documents.select(F.col(doc_id).alias("id"), F.col(text).alias("text")).filter(F.length("text") <= MOST_CHARS)
    return texts.join(F.broadcast(chosen), "id").groupBy("id").agg(F.min("lang").alias("lang"), F.min("text").alias("text"))


def fit_on_labels(
    documents: DataFrame, languages: Sequence[str] | None = None, *, doc_id: str = "doc_id", text: str = "text", lang: str = "lang", per_language: int = SAMPLE_PER_LANGUAGE
) -> Profiles:
    """Profiles of ``languages``, or of those that name ``LEAST_SHARE`` or more of the labelled documents, fitted on ``labelled_sample``."""
    samples: dict[str, list[str]] = {}
    # bounded by languages, documents and letters
    for r in sorted(labelled_sample(documents, languages, doc_id=doc_id, text=text, lang=lang, per_language=per_language).collect(), key=lambda r: r["id"]):
        samples.setdefault(r["lang"], []).append(r["text"])
    return fit(samples or {"en": [""]})


def language_segments(documents: DataFrame, profiles: Profiles, *, doc_id: str = "doc_id", text: str = "text", lang: str = "lang") -> DataFrame:
    """Segments of every document: ``doc_id``, ``label`` (canonical), ``seg_no``, ``lang``, ``confidence``, ``n_segments``, ``doc_lang``, ``doc_confidence``.

    A segment is a maximal run of sentences of one language; pieces that are no sentences (headings, formulas) are passed
    over. ``doc_lang`` is the language of most text. Confidence is the lead of the best cosine over the next, from 0 to 1,
    weighted by letters. Documents are not shuffled.

    Defined cases: null, empty and sentence-less texts have one segment ``und``; whole texts are read, however long; repeated
    documents are repeated; an empty table gives no rows; other columns are ignored.
    """
    held = documents.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"), canonical_label(F.col(lang)).alias("label"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, labels, texts = batch.column("doc_id"), batch.column("label"), batch.column("text")
            for low in range(0, batch.num_rows, 250):
                found = segments_of(texts.slice(low, 250).to_pylist(), profiles)
                rows, no, languages, sure, many, main, main_sure = [], [], [], [], [], [], []
                for d, own in enumerate(found):
                    sizes: dict[str, int] = {}
                    for name, _, a, b in own:
                        sizes[name] = sizes.get(name, 0) + b - a
                    top = max(sizes, key=lambda n: (sizes[n], n))
                    weight = max(sizes[top], 1)
                    top_sure = sum(c * (b - a) for name, c, a, b in own if name == top) / weight if sizes[top] else 1.0
                    for k, (name, c, _, _) in enumerate(own, 1):
                        rows.append(low + d)
                        no.append(k)
                        languages.append(name)
                        sure.append(c)
                        many.append(len(own))
                        main.append(top)
                        main_sure.append(top_sure)
                at = pa.array(rows, pa.int64())
                yield pa.RecordBatch.from_arrays(
                    [ids.take(at), labels.take(at), pa.array(no, pa.int32()), pa.array(languages), pa.array(sure, pa.float64()), pa.array(many, pa.int32()), pa.array(main), pa.array(main_sure, pa.float64())],
                    names=["doc_id", "label", "seg_no", "lang", "confidence", "n_segments", "doc_lang", "doc_confidence"],
                )

    schema = "doc_id bigint, label string, seg_no int, lang string, confidence double, n_segments int, doc_lang string, doc_confidence double"
    return held.mapInArrow(run, schema).withColumnRenamed("doc_id", doc_id)


def mislabelled(segments: DataFrame) -> DataFrame:
    """The segments of documents with a missing or wrong label, or with more than one segment."""
    return segments.filter(F.col("label").isNull() | (F.col("n_segments") > 1) | (F.col("label") != F.col("lang")))
