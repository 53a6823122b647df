import json
import time

from strandmill.llm.event_runs import motif_runs

A, B = "ACGTACGT", "ACGTACGA"  # one base apart
C = "ACGTATCA"  # three apart from A, two from B


def motif(pos, seq=None, name="A", length=8):
    return {"name": name, "pos": pos, "length": length} | ({"sequence": seq} if seq else {})


def found(spark, *bodies, ids=None):
    rows = [(ids[k] if ids else k, json.dumps(b) if not isinstance(b, str) else b, "x") for k, b in enumerate(bodies)]
    df = spark.createDataFrame(rows, "file_id bigint, body string, h string")
    return sorted((tuple(r) for r in motif_runs(df).collect()), key=str)


def hap(*motifs, rank=1):
    return {"rank": rank, "motifs": list(motifs)}


def test_runs(spark):
    body = {
        "haplotypes": [
            # out of order, one stored twice, neighbours alike though the ends are not
            hap(motif(8, B), motif(0, A), motif(16, C), motif(8, B), None, motif(25, C), motif(33, C)),
            # names decide where a sequence is missing; blanks around them do not count
            hap(motif(0, name="X"), motif(8, A, name=" X "), motif(16, B, name="Y"), motif(24, name="Z", length=9), rank=2),
        ]
    }
    assert found(spark, body) == [(0, 1, 0, 24, 3), (0, 1, 25, 41, 2), (0, 2, 0, 24, 3)]


def test_edges(spark):
    one = {"haplotypes": [hap(motif(0, A))]}
    lengths = {"haplotypes": [hap(motif(0, A), motif(8, A + "C", length=9), motif(None, A), {"pos": 17}, motif(17, A))]}
    body = {"haplotypes": [hap(motif(0, A), motif(8, A))]}
    again = {"haplotypes": {"HP1": hap(motif("8", A), motif("0", A))}}
    assert found(spark) == []
    assert found(spark, one, lengths, "{", "null", {"haplotypes": [hap()]}) == []
    assert found(spark, body, again, ids=[5, 5]) == [(5, 1, 0, 16, 2)]
    assert found(spark, body, again, ids=[None, None]) == [(None, 1, 0, 16, 2)] * 2


def test_long_array(spark):
    body = {"haplotypes": [hap(*(motif(8 * k, A if k % 7 else "TTTTTTTT") for k in range(15_000)))]}
    got = found(spark, body)
    assert len(got) == 2143 and got[0][4] == 6 and sum(r[4] for r in got) == 15_000 - 2143


def test_long_chains_of_near_units_and_linear_time(spark):
    def seconds(n):
        # runs of two equal units, then a chain in which each unit is near its neighbour only
        units = [(A, "TTTTTTTT")[(k // 2) % 2] for k in range(n // 2)] + [(A, B)[k % 2] for k in range(n - n // 2)]
        body = {"haplotypes": [hap(*(motif(8 * k, u) for k, u in enumerate(units)))]}
        began = time.perf_counter()
        got = found(spark, body)
        took = time.perf_counter() - began
        assert sum(r[4] for r in got) == n and max(r[4] for r in got) >= n - n // 2 and len(got) in (n // 4, n // 4 + 1)
        return took

    seconds(8_000)
    short, long = seconds(32_000), seconds(128_000)
    assert long < 4 * short + 5
