"""Hard negatives against plain integer arithmetic."""

import math
import random

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
import pytest

from ledgerwing.llm import negatives as ng

SCHEMA = "vec_id long, embedding array<float>, label int, row string, q string, score double"


def plain(rows, every=50):
    kept = [
        (i, l, [math.floor(256 * float(x)) for x in v])
        for i, v, l in rows
        if i is not None and l is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)
    ]
    out = []
    for a, (ai, al, av) in enumerate(kept):
        if ai % every:
            continue
        s = [(-sum(x * y for x, y in zip(av, v)), i, l, r) for r, (i, l, v) in enumerate(kept) if r != a]
        for neg, pid, _, _ in sorted((x[0], x[1], x[2], x[3]) for x in s if x[2] == al)[:5]:
            ps = -neg
            near = sorted((x[0], x[1]) for x in s if x[2] != al and 50 * ps <= -100 * x[0] <= 95 * ps)[:3]
            out += [(ai, pid, rank, nid, ps, -n) for rank, (n, nid) in enumerate(near, 1)]
    return sorted(out)


def mined(spark, rows):
    data = [(i, None if v is None else [None if x is None else float(x) for x in v], l, "r", "q", 0.5) for i, v, l in rows]
    df = ng.hard_negatives(ng.whole_numbers(spark.createDataFrame(data, SCHEMA)))
    assert df.columns == ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
    return sorted(tuple(r) for r in df.collect())


def f32(x):
    return float(np.float32(x))


def vectors(rng, n, d=8, labels=3):
    return [(i, [f32(rng.gauss(0.2, 0.4)) for _ in range(d)], rng.randrange(labels)) for i in range(n)]


def test_matches_plain_integers_with_nulls_ties_and_repeats(spark):
    rng = random.Random(3)
    rows = vectors(rng, 400)
    rows += [(i, rows[7][1], 1) for i in range(400, 460)]  # one very common vector
    rows += [rows[50], rows[100], (50, rows[3][1], 2)]  # repeated ids
    rows += [
        (None, rows[1][1], 0), (501, None, 0), (502, rows[1][1], None), (503, [None] * 8, 1),
        (550, [float("nan")] * 8, 1), (600, [float("inf")] * 8, 1), (650, [0.0] * 8, 1), (700, [-1.0] * 8, 2),
    ]
    want = plain(rows)
    assert len(want) > 60
    assert mined(spark, rows) == want


def test_large_components_and_other_lengths(spark):
    rng = random.Random(4)
    rows = [(i, [f32(rng.uniform(0, 5000)) for _ in range(rng.choice([3, 5]))], i % 2) for i in range(120)]
    rows.append((150, [], 0))
    assert mined(spark, rows) == plain(rows)
    with pytest.raises(ValueError, match="64 bits"):
        mined(spark, [*rows, (200, [1e20], 0)])


def test_empty_tables_and_no_partners(spark):
    assert mined(spark, []) == []
    assert mined(spark, [(1, [1.0], 0), (2, [1.0], 1)]) == []  # no anchor
    assert mined(spark, [(50, [1.0], 0)]) == []  # nothing else
    assert mined(spark, [(50, [1.0], 0), (51, [1.0], 0)]) == []  # no negative


def test_blocks_and_slabs_keep_the_order_of_ties(spark, monkeypatch, tmp_path):
    rng = np.random.default_rng(5)
    x, labels = rng.integers(-4, 5, (300, 6)), rng.integers(0, 2, 300)
    ids, rows = np.arange(300), rng.permutation(300)
    moduli = ng.primes(6 * 16)
    fields = {"row": rows, "vec_id": ids, "label": labels, "q": x.tolist()}
    batch = pa.RecordBatch.from_pydict(fields)
    pq.write_table(pa.Table.from_batches([batch.slice(0, 9)]), tmp_path / "part-0.parquet")
    monkeypatch.setattr(ng, "ROW_BLOCK", 16)
    monkeypatch.setattr(ng, "ANCHOR_BLOCK", 4)
    s = x[:9] @ x.T
    for slab in (300, 100):
        monkeypatch.setattr(ng, "SLAB_ROWS", slab)
        run = ng._positives(str(tmp_path), moduli, 7)
        got = pa.Table.from_batches(list(run(iter([batch.slice(0, 130), batch.slice(130)])))).to_pylist()
        for i in range(9):
            mine = [r for r in got if r["anchor_id"] == i]
            same = [j for j in range(300) if j != i and labels[j] == labels[i]]
            order = sorted(same, key=lambda j: (-s[i, j], j))[:7]
            best = sorted(mine, key=lambda r: (-r["score"], r["vec_id"]))[:7]
            assert [r["vec_id"] for r in best] == order
            assert [r["row"] for r in best] == rows[order].tolist()


@pytest.mark.parametrize("size", [1, 3000])
def test_products_are_exact_for_any_width_and_sign(size):
    rng = np.random.default_rng(size)
    for top in (1, 300, 10**6):
        a, b = (rng.integers(-top, top + 1, (5, size)) for _ in range(2))
        a[0], b[0] = top, -top
        moduli = ng.primes(size * top * top)
        got = ng.scores([ng.residues(a, p) for p in moduli], [ng.residues(b, p) for p in moduli], moduli)
        assert (got == a @ b.T).all()
