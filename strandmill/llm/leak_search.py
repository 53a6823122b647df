"""Evaluation texts leaking into training text, found by Wu-Manber search and confirmed by alignment.

The held-out items are a stated query set and are read in blocks of bounded size; each block becomes test strings for one
pass over whole documents. What is rare is counted over all items and all documents, so blocks don't change what is found. A passage is confirmed by aligning the words of item and document around the test strings.
"""

from __future__ import annotations

import html
import re
import unicodedata
import uuid
from bisect import bisect_right
from collections import defaultdict
from collections.abc import Iterator
from operator import eq, itemgetter

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strandmill.functions.bounded import collect_bounded
from strandmill.functions.keyed import small_side
from strandmill.functions.lineage import checkpointed
from strandmill.llm.multi_pattern import PatternSearch

#: Items per pass over the documents; the test strings of one pass go to every executor.
ITEM_BLOCK = 2_000
#: A word of an item is distinctive if at most this part of the documents, or so few documents, hold it, and likewise of the items.
RARE_SHARE, RARE_DOCS = 0.01, 20
RARE_ITEM_SHARE, RARE_ITEMS = 0.02, 2
#: A distinctive word has so many letters.
LEAST_LETTERS = 5
#: Stretches of items without distinctive words are searched by windows of so many words.
WINDOW = 5
#: A passage spans at least so many words of the item, so many of them equal.
LEAST_SPAN, LEAST_WORDS = 18, 15
#: The score is at least this part of the equal words; a passage of a lower score than ``LONG_SCORE`` bears fewer changes.
LEAST_DENSITY, SHORT_DENSITY, LONG_SCORE = 0.55, 0.75, 20.5
#: Beside one distinctive word, a passage holds so many figures and words of hardly any other item, that word among them.
LEAST_TOLD = 4
#: Equal words on the diagonal of a test string's occurrence before an alignment is tried; a passage has a stretch without gaps around it.
LEAST_ON_DIAGONAL = 5
#: An alignment leaves its diagonal by so many words at most.
BAND = 9

_MARKS = re.compile("[̀-ͯ]+")
_TAG = re.compile("<[^<>]{1,60}>")
_BROKEN = re.compile("[Â-ô][\u0080-¿‘-›€ŒœŠšŸŽžƒˆ˜™]{1,3}")
_NO_WIDTH = re.compile("[­​-‍⁠﻿]+")
# begins with its rarest part, which is looked for fastest
_HYPHEN = re.compile(r"[-‐](?<=\w.)\s*\n\s*(?=\w)")
_WORD = re.compile(r"[^\W_]+")
_BLANKS = {c: " " for c in range(128) if not chr(c).isalnum()}
_ASCII = bytes(range(128))


def beyond_ascii(text: str) -> str:
    """The other characters of ``text``, in order; neighbours stay neighbours."""
    return text.encode("utf-8", "surrogatepass").translate(None, _ASCII).decode("utf-8", "surrogatepass")


def _decode_again(found: re.Match) -> str:
    for encoding in ("cp1252", "latin-1"):
        try:
            return found[0].encode(encoding).decode("utf-8")
        except UnicodeError:
            pass
    return found[0]


def repaired(text: str) -> str:
    """Text without markup, character references, wrongly decoded letters, marks without width and line-end hyphens."""
    if "&" in text:
        text = html.unescape(text)
    if "<" in text:
        text = _TAG.sub(" ", text)
    # most texts have none of these, which their few characters beyond ASCII show
    if not text.isascii():
        if _BROKEN.search(beyond_ascii(text)):
            text = _BROKEN.sub(_decode_again, text)
        if _NO_WIDTH.search(beyond_ascii(text)):
            text = _NO_WIDTH.sub("", text)
    return _HYPHEN.sub("", text) if "\n" in text else text


def words_of(text: str | None) -> list[str]:
    """Lower-case words without accents, of repaired text."""
    if not text:
        return []
    text = repaired(text)
    if not text.isascii():
        text = unicodedata.normalize("NFKD", text.replace("ß", "ss"))
        others = {c for c in beyond_ascii(text) if not _MARKS.match(c)}
        if any(map(str.isalnum, others)):
            return _WORD.findall(_MARKS.sub("", text).lower())
        for c in others:
            text = text.replace(c, " ")
        # only marks are left to go
        text = text.encode("ascii", "ignore").decode()
    # the same words, found faster
    return text.lower().translate(_BLANKS).split()


def close_words(a: str, b: str) -> bool:
    """Equal but for slips: one edit or exchange from 4 letters on, two from 8; figures must be equal."""
    if a == b:
        return True
    x, y = len(a), len(b)
    if min(x, y) < 4 or abs(x - y) > 2 or a.isdigit() or b.isdigit():
        return False
    most = 2 if max(x, y) >= 8 else 1
    if abs(x - y) > most:
        return False
    # an edit changes one letter of each word at most
    s, t = set(a), set(b)
    if len(s - t) > most or len(t - s) > most:
        return False
    # so few edits stay as near the diagonal
    before, last = None, list(range(y + 1))
    for i in range(1, x + 1):
        row = [most + 1] * (y + 1)
        if i <= most:
            row[0] = i
        for j in range(max(1, i - most), min(y, i + most) + 1):
            row[j] = min(last[j] + 1, row[j - 1] + 1, last[j - 1] + (a[i - 1] != b[j - 1]))
            if i > 1 and j > 1 and a[i - 1] == b[j - 2] and a[i - 2] == b[j - 1]:
                row[j] = min(row[j], before[j - 2] + 1)
        if min(row) > most:
            return False
        before, last = last, row
    return last[y] <= most


def equal_places(rows: dict[str, list[int]], alike: list[tuple[str, ...]], offset: int, band: int = BAND) -> dict[int, list[int]]:
    """By word of an item: the columns near the diagonal ``offset`` that hold an equal word; ``rows`` are the words' places, ``alike`` the equal words by document word."""
    found: dict[int, list[int]] = defaultdict(list)
    for j, names in enumerate(alike):
        for a in names:
            for i in rows.get(a, ()):
                k = j - i - offset + band
                if 0 <= k <= 2 * band:
                    found[i].append(k)
    return found


def align(item: list[str], part: list[str], offset: int, rare: frozenset, equal: dict[int, list[int]], band: int = BAND) -> tuple[float, int, int, int, int]:
    """Best local alignment near the diagonal ``offset``: score, equal words, distinctive words kept, distinctive words replaced, words of the item spanned.

    Of each row only the columns that something reaches are filled: those of ``equal_places``, and those beside the last row's.
    """
    width = 2 * band + 1
    best, span, empty = (0.0, 0, 0, 0, 0), 0, [(0.0, 0, 0, 0, 0)] * (width + 2)
    # the columns of the last row that hold something lie from low to high
    last, low, high = empty, width, -1
    for i, a in enumerate(item):
        here = equal.get(i, ())
        if high < 0 and not here:
            continue
        # the last member of a cell is where its alignment starts
        nothing = (0.0, 0, 0, 0, i + 1)
        row = [nothing] * (width + 2)
        is_rare, is_figure = a in rare, a.isdigit()
        first = i + offset - band
        end = min(width, len(part) - first)
        to, new_low, new_high = max(high, here[-1] if here else -1), width, -1
        k = max(0, -first, min(low - 1, here[0] if here else width))
        while k < end and (k <= to or row[k][0] > 1.0):
            d = last[k + 1]
            if k in here:
                # a start where nothing was before
                cell = (d[0] + 1.0, d[1] + 1, d[2] + is_rare, d[3], d[4] if last is not empty else i)
            elif d[0] <= 1.5 and last[k + 2][0] <= 1.5 and row[k][0] <= 1.0:
                # nothing that reaches here is left
                k += 1
                continue
            else:
                # another figure is like another name
                b = part[first + k]
                other = is_rare or (is_figure and b.isdigit())
                cell = (d[0] - (3.0 if other or b in rare else 1.5), d[1], d[2], d[3] + other, d[4])
            up, left = last[k + 2], row[k]
            if up[0] - 1.5 > cell[0]:
                cell = (up[0] - 1.5, up[1], up[2], up[3] + is_rare, up[4])
            if left[0] - 1.0 > cell[0]:
                cell = (left[0] - 1.0, left[1], left[2], left[3], left[4])
            if cell[0] > 0:
                k += 1
                row[k] = cell
                new_low, new_high = min(new_low, k - 1), k - 1
                if cell[0] > best[0]:
                    best, span = cell, i + 1 - cell[4]
            else:
                k += 1
        last, low, high = (row, new_low, new_high) if new_high >= 0 else (empty, width, -1)
    return *best[:4], span


def is_passage(found: tuple[float, int, int, int, int], has_rare: bool) -> bool:
    """Enough equal words in order; with one distinctive word among them nothing else may differ, as in a sentence of the same pattern."""
    score, words, kept, replaced, span = found
    if span < LEAST_SPAN or words < LEAST_WORDS or score < (LEAST_DENSITY if score >= LONG_SCORE else SHORT_DENSITY) * words:
        return False
    if not has_rare or kept >= 2:
        return replaced * 3 <= kept
    return kept == 1 and replaced == 0 and words >= LEAST_WORDS + 2 and score >= words - 1.0


def may_hold(stretch: list[str], part: list[str], telling: frozenset) -> bool:
    """False if the figures that ``part`` lacks leave no room for a passage of ``stretch``; saves most alignments with stock wording."""
    held = set(part)
    told = [k for k, w in enumerate(stretch) if w in telling]
    lost = [k for k in told if stretch[k].isdigit() and stretch[k] not in held]
    # as many may be missing as the others bear
    ends = [-1, *lost, len(stretch)]
    step = (len(told) - len(lost)) // 6 + 1
    return any(ends[min(k + step, len(ends) - 1)] - ends[k] > LEAST_SPAN for k in range(len(ends) - 1))


def shortened(word: str, most: int) -> set[str]:
    """``word`` with up to ``most`` letters left out, two at most: words within so many edits or exchanges share one of these."""
    found, places = {word}, range(len(word))
    if most:
        found.update([word[:k] + word[k + 1 :] for k in places])
    if most > 1:
        found.update([word[:j] + word[j + 1 : k] + word[k + 1 :] for k in places for j in range(k)])
    return found


def slips(word: str) -> int:
    """Most edits ``close_words`` allows between ``word`` and any other."""
    return 0 if len(word) < 4 or word.isdigit() else 2 if len(word) >= 6 else 1


class ItemBlock:
    """Test strings of a block of items, each a text of its own even where several stand under one id.

    A passage that holds distinctive words keeps one of them at least, perhaps with slips; one that holds none lies in a
    stretch of ``LEAST_SPAN`` words or more without any. So distinctive words, with their slips, and the windows of such stretches
    are all test strings needed. ``rare`` are the distinctive words, ``own`` the words that hardly any other item holds.
    """

    def __init__(self, items: list[tuple[int, list[str]]], rare: frozenset, own: frozenset):
        self.ids, self.items, self.rare = [i for i, _ in items], [words for _, words in items], rare
        # test string: (item's place, place of the string, start and end of what is aligned)
        names: dict[bytes, list[tuple[int, int, int, int]]] = defaultdict(list)
        windows: dict[bytes, list[tuple[int, int, int, int]]] = defaultdict(list)
        self.telling: dict[tuple[int, int], frozenset] = {}
        for item, words in enumerate(self.items):
            anchors = [k for k, w in enumerate(words) if w in rare]
            # what tells an item from a sentence of the same pattern: figures, and words of this item that many documents hold
            told = frozenset(w for w in words if w.isdigit() or w in rare or (w in own and len(w) >= 5))
            self.telling[item, -1] = told
            for k in anchors:
                names[f" {words[k]} ".encode()].append((item, k, 0, len(words)))
            for before, after in zip([-1, *anchors], [*anchors, len(words)], strict=True):
                low = before + 1
                if after - low < LEAST_SPAN:
                    continue
                self.telling[item, low] = told.intersection(words[low:after])
                for k in range(low, after - WINDOW + 1):
                    windows[f" {' '.join(words[k : k + WINDOW])} ".encode()].append((item, k, low, after))
        # apart, as the shortest test string bounds the shifts
        self.searches = [(PatternSearch(list(p)), list(p.values())) for p in (names, windows)]
        self.names = {p[1:-1].decode(): at for p, at in names.items()}
        self.by_shortened: dict[str, list[str]] = defaultdict(list)
        self.words = frozenset(w for words in self.items for w in words)
        for word in self.words:
            if slips(word):
                for w in shortened(word, slips(word)):
                    self.by_shortened[w].append(word)
        self.longest = max(map(len, self.words), default=0)
        # words seen so far: the words of items they equal, but for slips; the places of distinctive words they are like, or that there are none
        self.equal: dict[str, tuple[str, ...]] = {}
        self.near: dict[str, list[tuple[int, int, int, int]]] = {}
        self.far: set[str] = set()
        #: (item, start, stop): the words, whether they are a whole item with distinctive words, what tells them, places of each word
        self.stretches: dict[tuple[int, int, int], tuple[list[str], bool, frozenset, dict[str, list[int]]]] = {}

    def alike(self, word: str) -> tuple[str, ...]:
        """The words of items that are ``word``, or like it but for slips."""
        equal = self.equal.get(word)
        if equal is None:
            like = set()
            if slips(word) and len(word) <= self.longest + 2:
                like = {a for x in self.by_shortened.keys() & shortened(word, slips(word)) for a in self.by_shortened[x]}
            equal = self.equal[word] = tuple(a for a in sorted(like | (self.words & {word})) if close_words(a, word))
        return equal

    def slipped(self, words: list[str]) -> dict[str, list[tuple[int, int, int, int]]]:
        """Places of the distinctive words that are like a word of ``words`` but for slips, by that word."""
        near, far, found = self.near, self.far, {}
        if len(near) + len(far) > 1_000_000:
            near.clear()
            far.clear()
            self.equal.clear()
        for w in set(words) - far:
            places = near.get(w)
            if places is None:
                places = [p for n in self.alike(w) if n != w for p in self.names.get(n, ())]
                if not places:
                    far.add(w)
                    continue
                near[w] = places
            found[w] = places
        return found

    def leaks(self, docs: list[list[str]]) -> list[tuple[int, int]]:
        """(place in ``docs``, item id) of every document that holds a passage of an item."""
        texts = [f" {' '.join(words)} ".encode() for words in docs]
        starts, total = [], 0
        for t in texts:
            starts.append(total)
            total += len(t) + 1
        buffer = b"\n".join(texts)
        by_doc: dict[int, list[tuple[int, list[tuple[int, int, int, int]]]]] = defaultdict(list)
        for search, places in self.searches:
            for at, pattern in search.find(buffer):
                by_doc[bisect_right(starts, at) - 1].append((at, places[pattern]))
        found = []
        for d, words in enumerate(docs):
            offsets: dict[tuple[int, int, int], set[int]] = defaultdict(set)
            like = self.slipped(words)
            for w, places in like.items():
                p = -1
                for _ in range(words.count(w)):
                    p = words.index(w, p + 1)
                    for item, q, low, high in places:
                        offsets[item, low, high].add(p - q)
            p, passed = 0, 0
            for at, places in sorted(by_doc.get(d, ()), key=itemgetter(0)):
                # a word's place is the number of blanks before its own
                p += texts[d].count(b" ", passed, at - starts[d])
                passed = at - starts[d]
                for item, q, low, high in places:
                    offsets[item, low, high].add(p - q)
            held: set[int] = set()
            for (item, start, stop), seen in sorted(offsets.items()):
                if self.ids[item] not in held and self._holds(item, start, stop, sorted(seen), words):
                    held.add(self.ids[item])
            found += [(d, i) for i in sorted(held)]
        return found

    def _holds(self, item: int, start: int, stop: int, offsets: list[int], words: list[str]) -> bool:
        """Whether a passage of the item lies on one of the diagonals in a document's ``words``."""
        stretch = self.stretches.get((item, start, stop))
        if stretch is None:
            own_words, rows = self.items[item][start:stop], defaultdict(list)
            for k, w in enumerate(own_words):
                rows[w].append(k)
            whole = stop - start == len(self.items[item]) and any(w in self.rare for w in own_words)
            stretch = self.stretches[item, start, stop] = own_words, whole, self.telling[item, -1 if whole else start], dict(rows)
        own_words, whole, telling, rows = stretch
        done = None
        for o in offsets:
            # the band around one diagonal covers its neighbours
            if done is not None and o - done <= 4:
                continue
            o += start
            low, high = max(0, o - 12), o + len(own_words) + 16
            if sum(map(eq, own_words[max(0, -o) :], words[max(0, o) : high])) < LEAST_ON_DIAGONAL:
                continue
            done, least = o - start, 0
            if not whole and not may_hold(own_words, words[low:high], telling):
                continue
            # the document's words are all known since ``slipped``
            equal = equal_places(rows, [self.equal[w] for w in words[low:high]], o - low)
            # each word of the item counts once
            if len(equal) < LEAST_WORDS:
                continue
            if whole:
                score, n, kept, replaced, span = align(own_words, words[low:high], o - low, self.rare, equal)
                # without a distinctive word it lies in a stretch that has its own windows
                if kept and is_passage((score, n, kept, replaced, span), True):
                    return True
                # one name alone may stand in a sentence of the same pattern: several figures and own words of the item must bear it
                if kept != 1 or replaced or span < LEAST_SPAN:
                    continue
                least = LEAST_TOLD
                if not may_hold(own_words, words[low:high], telling):
                    continue
            score, n, kept, replaced, span = align(own_words, words[low:high], o - low, telling, equal)
            # stock wording goes on with other names and figures: hardly any of these may differ
            if kept >= least and replaced * 6 <= kept and is_passage((score, n, kept, replaced, span), False):
                return True
        return False


def _folds() -> tuple[str, str]:
    """Lower-case letters with accents and their plain letters; marks without a partner are taken out."""
    plain = {}
    for c in map(chr, range(128, 0x2000)):
        base = _MARKS.sub("", unicodedata.normalize("NFKD", c)).lower()
        if c == c.lower() and len(base) == 1 and base != c and base.isalnum():
            plain[c] = base
    return "".join(plain) + "".join(map(chr, range(0x300, 0x370))) + "\u00ad\u200b\u200c\u200d\u2060\ufeff", "".join(plain.values())


def folded_words(text: Column, least: int = 1) -> Column:
    """The words of ``least`` letters or more of a text as in ``words_of``, but that markup and wrongly decoded letters are not repaired."""
    folded = F.replace(F.translate(F.lower(text), *_folds()), F.lit("ß"), F.lit("ss"))
    return F.regexp_extract_all(folded, F.lit(rf"[a-z0-9\p{{L}}\p{{N}}]{{{least},}}"), 0)


def distinct_words(texts: DataFrame, text: str) -> DataFrame:
    """``word``: each word of each text once, by ``words_of``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            words = [w for t in batch.column(0).to_pylist() for w in sorted(set(words_of(t)))]
            yield pa.RecordBatch.from_arrays([pa.array(words, pa.string())], names=["word"])

    return texts.select(F.col(text)).mapInArrow(run, "word string")


def telling_words(documents: DataFrame, items: DataFrame, *, text: str = "text", item_text: str = "text") -> DataFrame:
    """``word``, ``is_rare``, ``is_own`` of the words of items that few items hold, counted over all items and all documents.

    ``is_rare``: distinctive, as ``RARE_SHARE`` and ``RARE_ITEM_SHARE`` say; ``is_own``: in at most ``RARE_ITEMS`` items.
    """
    n_items, n_docs = items.count(), documents.count()
    few = max(RARE_ITEMS, RARE_ITEM_SHARE * n_items) if n_items > RARE_ITEMS else 1
    held = distinct_words(items, item_text).groupBy("word").agg(F.count("*").alias("n_items")).filter(F.col("n_items") <= max(few, RARE_ITEMS))
    candidate = (F.col("n_items") <= few) & (F.length("word") >= LEAST_LETTERS) & ~F.col("word").rlike(r"^\p{Nd}+$")
    held = small_side(held.select("word", candidate.alias("is_candidate"), (F.col("n_items") <= RARE_ITEMS).alias("is_own")))
    each = documents.select(F.explode(F.array_distinct(folded_words(F.col(text), LEAST_LETTERS))).alias("word"))
    counts = each.join(held.filter("is_candidate").select("word"), "word").groupBy("word").agg(F.count("*").alias("n_docs"))
    is_rare = F.col("is_candidate") & (F.coalesce("n_docs", F.lit(0)) <= max(RARE_DOCS, RARE_SHARE * n_docs))
    return checkpointed(held.join(counts, "word", "left").select("word", is_rare.alias("is_rare"), "is_own").filter("is_rare or is_own"))


def leaked_items(
    documents: DataFrame, items: DataFrame, *, doc_id: str = "doc_id", text: str = "text", item_id: str = "item_id", item_text: str = "text"
) -> DataFrame:
    """``doc_id`` and ``item_id`` of every document that holds a passage of about 20 words or more of an item.

    One pass over whole documents per ``ITEM_BLOCK`` items, and one to count words; documents are not shuffled. A passage is
    confirmed if enough words agree in order, but for slips, and distinctive words (names) agree where the item has them; with
    one name alone several figures and words of hardly any other item must agree as well.

    Defined cases: null and empty texts hold nothing; an item of fewer words than a passage is never found; several texts
    under one item id are searched each (more than ``ITEM_BLOCK`` under one id may raise ``TooLarge``); several passages of one item in a document count once; items without an id are
    none; repeated documents are reported each; empty tables give no rows; other columns are ignored.
    """
    wanted = items.select(F.col(item_id).alias("item_id"), F.col(item_text).alias("text")).filter("item_id is not null and text is not null").distinct()
    blocks = max(1, -(-wanted.count() // ITEM_BLOCK))
    told = telling_words(documents, wanted, text=text)
    held = documents.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text")).filter("text is not null")
    out = None
    for b in range(blocks):
        part = wanted.filter(F.pmod(F.xxhash64("item_id"), F.lit(blocks)) == b)
        # hashed blocks are about equal; this bound is far outside of chance
        listed = [(r[0], words_of(r[1])) for r in collect_bounded(part, 2 * ITEM_BLOCK + 1_000)]
        # at most the words of the block
        words = told.join(distinct_words(part, "text").distinct(), "word", "left_semi").collect()
        found = held.mapInArrow(_searcher(listed, frozenset(r[0] for r in words if r[1]), frozenset(r[0] for r in words if r[2])), "doc_id bigint, item_id bigint")
        out = found if out is None else out.unionAll(found)
    return out.select(F.col("doc_id").alias(doc_id), F.col("item_id").alias(item_id))


#: The block a worker process last used, with what it has learnt about words; its tasks for one block share it.
_LAST: dict[str, ItemBlock] = {}


def _searcher(items: list[tuple[int, list[str]]], rare: frozenset, own: frozenset):
    name = uuid.uuid4().hex

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block = _LAST.get(name)
        if block is None:
            _LAST.clear()
            block = _LAST[name] = ItemBlock(items, rare, own)
        for batch in batches:
            ids, texts = batch.column("doc_id").to_pylist(), batch.column("text")
            # a few hundred texts at a time bound the buffer
            for low in range(0, len(ids), 500):
                docs = [words_of(t) for t in texts.slice(low, 500).to_pylist()]
                found = block.leaks(docs)
                if found:
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([ids[low + d] for d, _ in found], pa.int64()), pa.array([i for _, i in found], pa.int64())], names=["doc_id", "item_id"]
                    )

    return run
