import random

import pytest

from strandmill.llm.language_segments import canonical_label, fit, fit_on_labels, labelled_sample, language_segments, mislabelled, segments_of

WORDS = {
    "en": "the of and to in is that for it with as was on are by this be from or which have an they one had word not all were".split(),
    "de": "der die und den von zu das mit sich des auf für ist im dem nicht ein eine als auch es an werden aus er hat dass sie nach".split(),
    "fr": "le de la les et des en un du une que est pour qui dans il au sur ce ne pas plus par avec sont mais cette elle être ont".split(),
}


def sentence(rng, language, n=14):
    return " ".join(rng.choice(WORDS[language]) for _ in range(n)).capitalize() + ". "


@pytest.fixture(scope="module")
def profiles():
    rng = random.Random(2)
    samples = {k: ["".join(sentence(rng, k) for _ in range(10)) for _ in range(40)] for k in WORDS}
    # a part of the labels is wrong
    samples["en"][:4], samples["de"][:4] = samples["de"][:4], samples["en"][:4]
    return fit(samples)


def test_accuracy_held_out(profiles):
    rng = random.Random(9)
    truth = [rng.choice(list(WORDS)) for _ in range(300)]
    got = segments_of([sentence(rng, k) for k in truth], profiles)
    assert sum(len(g) == 1 and g[0][0] == k for g, k in zip(got, truth, strict=True)) >= 297


def test_segments(profiles):
    rng = random.Random(4)
    text = "TITLE\n" + sentence(rng, "en") + sentence(rng, "en") + "\nx = 4 + {y}\n" + sentence(rng, "de") + "THE\n" + sentence(rng, "de") + sentence(rng, "fr")
    (got,) = segments_of([text], profiles)
    assert [g[0] for g in got] == ["en", "de", "fr"] and all(0 < g[1] <= 1 for g in got)
    assert [[g[0] for g in x] for x in segments_of([None, "", "x = {1}\n(II)", "HEADING ONLY"], profiles)] == [["und"]] * 4
    (long,) = segments_of([sentence(rng, "fr") * 20_000 + sentence(rng, "de")], profiles)
    assert [g[0] for g in long] == ["fr", "de"]


def test_labels_and_found(spark, profiles):
    rng = random.Random(6)
    labels = ["en", "EN", "eng", "en-GB", "de", None, " ", "unknown", "XX", "und"]
    rows = [(k, sentence(rng, "en") * 2, x, 1) for k, x in enumerate(labels)] + [(20, sentence(rng, "en") + sentence(rng, "fr"), "en", 1), (21, "(I)", "und", 1), (22, "(I)", None, 1)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, lang string, seg_no int")
    out = sorted((r.doc_id, r.seg_no, r.lang) for r in mislabelled(language_segments(df, profiles)).collect())
    assert out == [(4, 1, "en"), (5, 1, "en"), (6, 1, "en"), (7, 1, "en"), (8, 1, "en"), (9, 1, "en"), (20, 1, "en"), (20, 2, "fr"), (22, 1, "und")]
    assert language_segments(df.limit(0), profiles).count() == 0
    assert df.select(canonical_label(df.lang)).distinct().count() == 4
    assert set(fit_on_labels(df, per_language=2).languages) == {"en", "de"}
    assert fit_on_labels(df.limit(0)).languages == ("en",)
    assert set(fit_on_labels(df, ["en"]).languages) == {"en"}
    # too long for the sample
    long = spark.createDataFrame([(1, "the of and to " * 20_000, "en"), (2, sentence(rng, "de"), "de")], "doc_id bigint, text string, lang string")
    assert fit_on_labels(long).languages == ("de",)


def test_accuracy_on_held_out_documents(spark, data):
    """Fitted on 12 documents a language; of all others the label is nearly always the language found (a part of the labels is wrong)."""
    documents = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text", "lang")
    languages = ["en", "de", "fr", "es", "pt"]
    drawn = labelled_sample(documents, languages, per_language=12)
    assert drawn.count() <= 60
    held_out = documents.join(drawn.select(drawn["id"].alias("doc_id")), "doc_id", "left_anti")
    found = language_segments(held_out, fit_on_labels(documents, languages, per_language=12)).filter("seg_no = 1 and n_segments = 1")
    known = [(r.label, r.doc_lang) for r in found.filter("label is not null and doc_lang != 'und'").collect() if r.label in languages]
    assert len(known) > 300 and sum(a == b for a, b in known) >= 0.93 * len(known)
