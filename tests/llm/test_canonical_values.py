import itertools
import random

import pytest

from strandmill.llm.canonical_values import map_entries
from strandmill.llm.similarity_join import similar_pairs

REF = [
    (1, "13dupA", "Aldra type"), (2, "22dupC", None), (3, "55dupC", None), (4, "17_18delAC", "Delvoy"), (5, "del11_24", None), (6, "del9_28", None),
    (7, "33_34delinsA", None), (8, "ins12", None), (9, "dup14_29", None), (10, "37_38insTT", None), (11, "47dupT", None),
]


@pytest.fixture(scope="module")
def mapped(spark):
    def run(cells, ref=REF):
        rows = spark.createDataFrame([(k, c, 9) for k, c in enumerate(cells)], "row_id bigint, variant_raw string, variant_id int")
        known = spark.createDataFrame(ref, "variant_id int, variant string, other_name string")
        return sorted(tuple(r) for r in map_entries(rows, known).select("row_id", "entry_no", "variant_id").collect())

    return run


def test_spellings(mapped):
    cases = {
        "13dupA": 1, "c.13dupA ?": 1, "W-13dpuA": 1, "dup A at l3": 1, "duplication A (pos １３)": 1, "dupl. A en 13 @ repeat 7": 1, "13\xa0dup\xa0A": 1, "ALDRA": 1, "aldrra type": 1,
        "14dupA": 0, "13dupT": 0, "dupA": 1, "dupC": 0, "dupT": 11, "delAC": 4, "dlevoy": 4, "délétion AC 17-18": 4, "17/18 del AC (conf.)": 4, "del AC 17..18 het": 4,
        "deletion from ll to 24": 5, "del. 11 a 24": 5, "del(11_24)": 5, "dell9_28": 6, "del9–28": 6, "33_34 del/ins A": 7, "33 34 indel A": 7, "delins A": 7, "12 bp insertion": 8,
        "insertion 12 pb": 8, "insl2": 8, "ins 13": 0, "dupl4_29": 9, "dup. 14 a 29": 9, "insertion of TT between 37 and 38": 10, "see report": 0, "repeat 37": 0, "*": 0, "del": 0,
    }
    got = mapped(list(cases))
    assert {list(cases)[r]: v for r, _, v in got} == cases


def test_cells(mapped):
    assert mapped(["13dupA | 22 dup C", None, "", " nan ", "NaN", "x||55dupC"]) == [(0, 1, 1), (0, 2, 2), (5, 1, 0), (5, 2, 0), (5, 3, 3)]
    assert mapped([]) == []
    assert mapped(["13dupA", "y" * 50_000], ref=[]) == [(0, 1, 0), (1, 1, 0)]
    assert mapped(["13dupA"], ref=[(None, "13dupA", None), (4, None, None), (2, "13dupA", None), (1, "13dupA", "")]) == [(0, 1, 1)]


def test_join_loses_no_pair(spark):
    rng = random.Random(3)
    sets = [(str(k), [f"t{int(rng.paretovariate(0.8))}" for _ in range(rng.randint(0, 9))]) for k in range(120)]
    left, right = sets[:80], sets[60:]
    frames = [spark.createDataFrame(s, "id string, tokens array<string>") for s in (left, right)]
    for threshold in (0.4, 0.7, 1.0):
        expected = set()
        for (i, a), (j, b) in itertools.product(left, right):
            a, b = set(a), set(b)
            if a and b and len(a & b) / len(a | b) >= threshold:
                expected.add((i, j))
        assert {(r[0], r[1]) for r in similar_pairs(*frames, threshold).collect()} == expected
