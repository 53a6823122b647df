import random
import re
import unicodedata

from pyspark.sql import functions as F

import strandmill.llm.leak_search as m
from strandmill.llm.leak_search import close_words, folded_words, leaked_items, words_of
from strandmill.llm.multi_pattern import PatternSearch

FILLER = "the device has a frame and a cover that keeps the motor dry while the pump is running in the house".split()
ITEM = (
    "Figure 35 shows the griulmistax nozzle in section, where a lortavporel layer is pushed against the yantoron cover by hand. "
    "Known from earlier documents is an emfraite lens that drives the griulmistax nozzle by means of emfraite at 218 revolutions per minute."
)


def test_pattern_search_is_exact():
    rng = random.Random(5)
    text = "".join(rng.choice("abc ") for _ in range(20_000)).encode()
    patterns = sorted({text[k : k + rng.randint(5, 12)] for k in rng.sample(range(19_000), 60)} | {b"zzzzz"})
    expected = sorted((m.start(), k) for k, p in enumerate(patterns) for m in re.finditer(b"(?=" + re.escape(p) + b")", text))
    assert sorted(PatternSearch(patterns).find(text)) == expected
    assert PatternSearch([]).find(text) == [] and PatternSearch(patterns).find(b"") == []


def test_words():
    assert words_of("Hö&amp;ren <b>Stra&szlig;e</b>­ 5 pump-\nen dÃ©jÃ  ÉTÉ") == ["ho", "ren", "strasse", "5", "pumpen", "deja", "ete"]
    assert close_words("griulmistax", "griulmsitax") and close_words("layer", "layr") and not close_words("218", "219") and not close_words("plate", "frame")


def leaks(spark, docs, items=((1, ITEM),)):
    d = spark.createDataFrame([(k, t, "x") for k, t in docs], "doc_id bigint, text string, item_id string")
    return sorted(tuple(r) for r in leaked_items(d, spark.createDataFrame(list(items), "item_id bigint, text string")).collect())


def test_passages(spark):
    rng = random.Random(1)
    filler = lambda n: " ".join(rng.choice(FILLER) for _ in range(n))
    noisy = ITEM.upper().replace("LAYER", "LAYRE").replace("PUSHED", "firmly PUSHED").replace("FIGURE", "Fig-\nure").replace(", ", "<br>")
    other = ITEM.replace("griulmistax", "breldon").replace("lortavporel", "kavstin").replace("yantoron", "bazzel").replace("emfraite", "tornelax").replace("nozzle", "spring").replace("35", "4")
    docs = [
        (1, filler(90) + " " + ITEM + " " + filler(50)),
        (2, filler(40) + noisy + filler(900)),
        (3, filler(60) + " " + " ".join(ITEM.split()[3:26]) + " " + filler(60)),
        (4, filler(60) + other + filler(60)),
        (5, filler(60) + " " + " ".join(ITEM.split()[3:10]) + " " + filler(60)),
        (6, None), (7, ""), (8, "griulmistax " * 30), (1, ITEM),
    ]
    assert leaks(spark, docs) == [(1, 1), (1, 1), (2, 1), (3, 1)]
    assert leaks(spark, []) == [] and leaks(spark, docs, [(1, None), (2, ""), (3, "too short"), (None, ITEM)]) == []


def test_long_text_and_blocks(spark, monkeypatch):
    import strandmill.llm.leak_search as m

    monkeypatch.setattr(m, "ITEM_BLOCK", 2)
    text = " ".join(FILLER) * 40_000 + " " + ITEM
    names = ("brelkon", "kavzilux", "tormexad", "pelgrast", "onivagor")
    items = []
    for k, n in enumerate(names):
        t = ITEM
        for j, old in enumerate(("griulmistax", "lortavporel", "yantoron", "emfraite")):
            t = t.replace(old, n + names[(k + j + 1) % 5])
        items.append((k, t))
    # sentences of one pattern are told apart, in whatever blocks the items are read
    docs = [(1, text + " " + items[3][1])]
    assert leaks(spark, docs, [(9, ITEM), *items]) == [(1, 3), (1, 9)]
    monkeypatch.setattr(m, "ITEM_BLOCK", 100)
    assert leaks(spark, docs, [(9, ITEM), *items]) == [(1, 3), (1, 9)]


def test_parts_of_a_long_item_and_texts_under_one_id(spark):
    rng = random.Random(4)
    usual = [f"{rng.choice('bdfgkl')}{a}{b}" for a in ("ara", "elo", "iti", "oma", "unu") for b in ("den", "sor", "lig", "tam")]
    # 60 words, two of them in no other item or document
    own = [usual[(k * 7) % 20] + "abcdefghij"[k % 10] for k in range(60)]
    own[9], own[50] = "griulmistax", "lortavporel"
    pad = " ".join(FILLER)
    # many documents hold the other words, in another order
    usual_docs = [(100 + k, " ".join(rng.sample([w for w in own if len(w) < 11], 50))) for k in range(25)]
    short = "the emfraite lens drives the yantoron nozzle by hand at 218 turns while the tornelax pump is kept from running"
    docs = [(1, f"{pad} {' '.join(own[20:45])} {pad}"), (2, f"{pad} {' '.join(own[15:60])} {pad}"), (3, f"{pad} {short} {pad}"), (4, f"{pad} {' '.join(own[20:33])} {pad}")]
    assert len(short.split()) == 20
    # one name within 25 words, and a word exchanged: the other words of the item bear it
    near = own[38:60]
    near[4] = "house"
    docs.append((5, f"{pad} {' '.join(near)} {pad}"))
    assert leaks(spark, docs + usual_docs, [(1, " ".join(own)), (2, short), (2, ITEM), (2, ITEM), (2, "too short")]) == [(1, 1), (2, 1), (3, 2), (5, 1)]


def test_short_passages_with_changes(spark):
    pad = " ".join(FILLER)
    words = ITEM.split()
    changed = lambda n, *pairs: " ".join(dict(pairs).get(w, w) for w in words[:n])
    passages = [
        changed(20), changed(20, ("in", "")), changed(20, ("in", "at")), changed(21, ("in", "near at")), changed(22, ("in", "at"), ("is", "was")),
        changed(24, ("in", "at"), ("is", "")), " ".join(words[2:24]),
    ]
    short = " ".join(words[2:14])
    parts = changed(20, ("35", "61"), ("nozzle", "spring"), ("layer", "plate"), ("cover", "sleeve"))
    docs = [(k, f"{pad} {p} {pad}") for k, p in enumerate([*passages, short, parts])]
    assert leaks(spark, docs) == [(k, 1) for k in range(len(passages))]


PLAIN = "it can then be set down on its left side so that no air may get in from the rear end of the box"


def test_slips_in_every_distinctive_word_and_none_at_all(spark):
    pad = " ".join(FILLER)
    slipped = " ".join(w[:3] + w[4:] if len(w) >= 5 else w for w in ITEM.replace(",", "").split()[:20])
    figures = lambda n: PLAIN.replace("side", f"side {n}")
    items = [(1, ITEM), (2, f"{figures(7)} {ITEM}")]
    docs = [(1, f"{pad} {slipped} {pad}"), (2, f"{pad} {figures(7)} {pad}"), (3, f"{pad} {figures(8)} {pad}"), (4, pad)]
    assert leaks(spark, docs, items[:1]) == [(1, 1)]
    assert leaks(spark, docs[1:], items[1:]) == [(2, 2)]


def test_passage_in_a_third_of_the_documents(spark):
    pad = " ".join(FILLER)
    hot = " ".join(ITEM.split()[:20])
    other = hot.replace("griulmistax", "breldon").replace("lortavporel", "kavstin").replace("yantoron", "bazzel").replace("nozzle", "spring").replace("35", "4")
    docs = [(k, f"{pad} {hot if k < 30 else other if k < 40 else pad} {pad}") for k in range(90)]
    assert leaks(spark, docs) == [(k, 1) for k in range(30)]


def test_slips_at_both_ends_and_counted_words(spark):
    assert close_words("griulmistax", "briulmistay") and close_words("yantoron", "antorom") and not close_words("yantoron", "bantirom")
    text = "Žluťoučký KŮŇ čerpadlo, Größe pøhlen ŝanĝo — насос e\u0301te"
    got = spark.createDataFrame([(text,)], "t string").select(folded_words(F.col("t"))).first()[0]
    assert [w for w in got if w] == words_of(text)


def test_words_beyond_ascii():
    rng = random.Random(6)
    parts = ["a", "B", "é", "é", "ß", "ẞ", "Σ", "œ", "ж", "İ", "_", "5", "²", "’", "–", "€", "-", "\n", " ", "​", "­", "Ã©", "ï¬"]
    for _ in range(20_000):
        text = "".join(rng.choice(parts) for _ in range(rng.randint(1, 14)))
        plain = re.sub("[­​]+", "", m._BROKEN.sub(m._decode_again, text))
        plain = re.sub(r"(?<=\w)[-‐]\s*\n\s*(?=\w)", "", plain).replace("ß", "ss")
        assert words_of(text) == re.findall(r"[^\W_]+", re.sub("[̀-ͯ]+", "", unicodedata.normalize("NFKD", plain)).lower()), text


def test_alignment_equals_the_whole_table():
    rng = random.Random(9)
    words = "griulmistax griulmitax the of nozzle nozle nozzel 35 36 cover covre layer is pump pumps".split()

    def whole(item, part, offset, rare, band=9):
        best, cells = (0.0, 0, 0, 0, 0), {}
        for i, a in enumerate(item):
            empty, before = (0.0, 0, 0, 0, i + 1), (0.0, 0, 0, 0, i)
            for j in range(max(0, i + offset - band), min(len(part), i + offset + band + 1)):
                b = part[j]
                d, up, left = (cells.get(at, before if at[0] < i else empty) for at in ((i - 1, j - 1), (i - 1, j), (i, j - 1)))
                other = a in rare or (a.isdigit() and b.isdigit())
                if close_words(a, b):
                    cell = (d[0] + 1.0, d[1] + 1, d[2] + (a in rare), *d[3:])
                else:
                    cell = (d[0] - (3.0 if other or b in rare else 1.5), d[1], d[2], d[3] + other, d[4])
                if up[0] - 1.5 > cell[0]:
                    cell = (up[0] - 1.5, up[1], up[2], up[3] + (a in rare), up[4])
                if left[0] - 1.0 > cell[0]:
                    cell = (left[0] - 1.0, *left[1:])
                if cell[0] > 0:
                    cells[i, j] = cell
                    if cell[0] > best[0]:
                        best, span = cell, i + 1 - cell[4]
        return (*best[:4], span if best[1] else 0)

    for _ in range(400):
        item = [rng.choice(words) for _ in range(rng.randint(1, 40))]
        part = [rng.choice(words) if rng.random() < 0.2 else w for w in item[rng.randint(0, 3) :] for _ in range(rng.choice((1, 1, 1, 1, 1, 0, 2)))]
        rare, offset = frozenset(rng.sample(words, 4)), rng.randint(-10, 10)
        rows = {a: [k for k, w in enumerate(item) if w == a] for a in item}
        equal = m.equal_places(rows, [tuple(a for a in rows if close_words(a, b)) for b in part], offset)
        assert m.align(item, part, offset, rare, equal) == whole(item, part, offset, rare)


def test_a_word_is_compared_with_like_words_of_items_only(monkeypatch):
    calls = []
    monkeypatch.setattr(m, "close_words", lambda a, b: calls.append((a, b)) or close_words(a, b))
    item = words_of(ITEM)
    block = m.ItemBlock([(1, item)], frozenset(w for w in item if w in ("griulmistax", "lortavporel", "yantoron", "emfraite")), frozenset(item))
    rng = random.Random(2)
    other = ["".join(rng.choice("bdfgklmnprst") for _ in range(7)) for _ in range(400)]
    # the item with every third word exchanged, another one each time
    docs = [[rng.choice(other) if j % 3 == 2 and w not in block.rare else w for j, w in enumerate(item)] for _ in range(100)]
    block.leaks(docs)
    assert len(calls) <= 2 * len(set(item))
    assert block.leaks([item, item[:23], other]) == [(0, 1), (1, 1)]
