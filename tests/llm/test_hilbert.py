"""Hilbert blocks, centroid clustering and hard negatives against brute force."""

import hashlib
import random

import numpy as np
import pytest
from fixtures_llm import odd  # noqa: F401

from clickfeat.llm import centroids, hilbert, negatives
from clickfeat.llm import queries as Q

SCHEMA = "vec_id long, embedding array<double>, label int, cid long, q string, block long"


def frame(spark, rows):
    return spark.createDataFrame([(i, v, c, 1, "q", 2) for i, v, c in rows], SCHEMA)


@pytest.mark.parametrize("dims,bits", [(1, 3), (2, 3), (3, 2), (5, 1)])
def test_the_curve_visits_every_cell_by_steps_of_one(dims, bits):
    cells = np.stack(np.meshgrid(*[np.arange(1 << bits)] * dims, indexing="ij"), -1).reshape(-1, dims)
    place = hilbert.curve_place(cells, bits)
    assert sorted(place.tolist()) == list(range(1 << dims * bits))
    walk = cells[np.argsort(place)]
    assert (np.abs(np.diff(walk, axis=0)).sum(1) == 1).all()


def test_blocks_hold_every_row_once_in_exact_boxes(spark):
    rng = random.Random(1)
    rows = [(i, [rng.randrange(-300, 300) for _ in range(4)]) for i in range(3000)] + [(9000 + i, [7, 7, 7, 7]) for i in range(1500)] \
        + [(20000 + i, [rng.randrange(9)]) for i in range(50)] + [(30000, []), (30000, [])]
    df = spark.createDataFrame([(i, len(q), q) for i, q in rows], "vec_id long, dim int, q array<long>")
    found = hilbert.blocks(df, "test-blocks", 64, ("vec_id",)).collect()
    got = []
    for b in found:
        vals, ids = hilbert.unpacked(b["vals"], b["n"], b["dim"]), hilbert.longs(b["vec_id"])
        assert 0 < len(ids) == b["n"] <= 64
        if b["dim"]:
            assert vals.min(0).tolist() == b["lo"] and vals.max(0).tolist() == b["hi"]
        assert (ids.min(), ids.max()) == (b["vec_id_lo"], b["vec_id_hi"])
        got += list(zip(ids.tolist(), vals.tolist(), strict=True))
    assert sorted(got) == sorted(rows) and len({b["block"] for b in found}) == len(found)
    copies = {b["block"] >> 32 for b in found if b["dim"] == 4 and b["lo"] == b["hi"] == [7] * 4}
    assert len(copies) > 1          # the copies' group lies in several tasks


def test_blocks_are_tighter_than_rows_as_they_come(spark):
    rng = np.random.default_rng(2)
    x = rng.integers(0, 1000, (4000, 3))
    df = spark.createDataFrame([(i, 3, v) for i, v in enumerate(x.tolist())], "vec_id long, dim int, q array<long>")
    spread = [np.mean(np.array(b["hi"]) - np.array(b["lo"])) for b in hilbert.blocks(df, "test-tight", 64, ("vec_id",)).collect()]
    plain = [np.mean(x[k:k + 64].max(0) - x[k:k + 64].min(0)) for k in range(0, 4000, 64)]
    assert np.mean(spread) < 0.4 * np.mean(plain)


# ---------------------------------------------------------------- clustering

def brute_clusters(rows, count, rounds, dims, scale=256, seed=2):
    kept = [(i, [int(np.floor(scale * float(x))) for x in v]) for i, v, _ in rows
            if v is not None and len(v) == dims and all(x is not None and np.isfinite(x) for x in v)]
    first = sorted((hashlib.sha256(f"{seed}:{i}".encode()).hexdigest(), v) for i, v in kept if i is not None)
    cs = [list(v) for _, v in first[:count]]

    def nearest(v):
        return min((sum((a - b) ** 2 for a, b in zip(v, c, strict=True)), k) for k, c in enumerate(cs))

    for _ in range(rounds):
        own = [nearest(v)[1] for _, v in kept]
        for k in range(len(cs)):
            mine = [v for (_, v), o in zip(kept, own, strict=True) if o == k]
            if mine:
                cs[k] = [sum(c) // len(mine) for c in zip(*mine, strict=True)]
    out = [(i, k, d) for (i, v) in kept for d, k in [nearest(v)]]
    part = {k: sum(d for _, o, d in out if o == k) for k in range(len(cs))}
    return sorted(((i, k, d, part[k], sum(part.values()), hashlib.sha256(",".join(map(str, cs[k])).encode()).hexdigest())
                   for i, k, d in out), key=str)


def clusters(spark, rows, **options):
    got = centroids.cluster_report(frame(spark, rows), **options)
    assert got.columns == ["vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"]
    return sorted(map(tuple, got.collect()), key=str)


def test_clusters_equal_brute_force(spark):
    rng = random.Random(5)
    # Coarse values make ties; copies, repeated rows and every kind of row that takes no part.
    rows = [(i, [rng.randrange(-3, 4) / 16 for _ in range(3)], 1) for i in range(300)]
    rows += [(1000 + i, [0.25, 0.25, 0.25], 1) for i in range(200)] + rows[:20] + [(None, [0.1, 0.2, 0.3], 1)] * 2
    rows += [(2000, None, 1), (2001, [1.0, None, 0.0], 1), (2002, [float("nan"), 0.0, 0.0], 1), (2003, [float("inf"), 0.0, 0.0], 1),
             (2004, [0.1, 0.2], 1), (2005, [], 1), (2006, [0.1] * 4, 1)]
    for count, rounds in ((7, 3), (40, 5), (1000, 2)):
        assert clusters(spark, rows, count=count, rounds=rounds, dims=3) == brute_clusters(rows, count, rounds, 3)


def test_clusters_of_large_components(spark):
    rng = random.Random(6)
    rows = [(i, [rng.uniform(-4e5, 4e5) for _ in range(2)], 1) for i in range(60)]
    assert clusters(spark, rows, count=5, rounds=4, dims=2) == brute_clusters(rows, 5, 4, 2)
    with pytest.raises(Exception, match="too large"):
        clusters(spark, [(1, [1e9, 0.0], 1)], count=5, rounds=1, dims=2)


def test_fewer_vectors_than_centroids(spark):
    rows = [(5, [1.0] * 64, 1), (6, [2.0] * 64, 1)]
    assert {(r[0], r[2], r[4]) for r in clusters(spark, rows)} == {(5, 0, 0), (6, 0, 0)}


def test_clusters_of_odd_tables(spark, odd):
    assert Q.op11_centroids(spark, odd).count() == 0           # no vector there has 64 components


def test_no_box_loses_a_nearest_centroid():
    rng = np.random.default_rng(7)
    dropped = 0
    for _ in range(300):
        dims = int(rng.integers(1, 6))
        c = rng.integers(-40, 40, (12, dims))
        v = rng.integers(-5, 6, (20, dims)) + rng.integers(-40, 40, dims)
        left = centroids.candidates(v.min(0), v.max(0), c)
        dropped += 12 - len(left)
        dist = ((v[:, None] - c[None]) ** 2).sum(2)
        assert (dist.argmin(1) == centroids.nearest(v, c, left)[0]).all()
        corners = np.stack([v.min(0), v.max(0)])
        inside = np.array([[corners[rng.integers(2)][d] for d in range(dims)] for _ in range(16)])
        ties = ((inside[:, None] - c[None]) ** 2).sum(2)
        assert set(np.nonzero(ties == ties.min(1, keepdims=True))[1]) <= set(left.tolist())
    assert dropped > 1000


# ---------------------------------------------------------------- negatives

def brute_negatives(rows, every=100, top=5):
    kept = [(i, (c + 1) % 10 if i % 7 == 0 else c, [int(np.floor(256 * float(x))) for x in v]) for i, v, c in rows
            if i is not None and c is not None and v is not None and all(x is not None and np.isfinite(x) for x in v)]
    out = []
    for a, (i, c, v) in enumerate(kept):
        if i % every:
            continue
        scored = sorted((-sum(x * y for x, y in zip(v, w, strict=True)), j, d) for b, (j, d, w) in enumerate(kept) if b != a and len(w) == len(v))
        for s, j, _ in [x for x in scored if x[2] == c][:top]:
            near = [(t, k) for t, k, d in scored if d != c and 80 * -s <= 100 * -t <= 100 * -s][:top]
            out += [(i, j, r + 1, k, -s, -t) for r, (t, k) in enumerate(near)]
    return sorted(out)


def mined(spark, rows):
    got = negatives.hard_negatives(frame(spark, rows))
    assert got.columns == ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
    return sorted(map(tuple, got.collect()))


def test_negatives_equal_brute_force(spark, monkeypatch):
    rng = random.Random(8)
    for name, size in (("BLOCK_ROWS", 16), ("TILE_ROWS", 4), ("PAGE_ROWS", 3), ("GROUP_BLOCKS", 2)):
        monkeypatch.setattr(negatives, name, size)
    coarse = [(i, [rng.randrange(-2, 4) / 16 for _ in range(3)], rng.randrange(3)) for i in range(0, 2000, 5)]
    fine = [(i, [rng.gauss(0.3, 0.3) for _ in range(6)], rng.randrange(12)) for i in range(0, 3000, 10)]
    hot = [(i, [0.25, 0.5, 0.25], 4) for i in range(5000, 5200)]
    rows = coarse + coarse[:30] + fine + hot + [(100, None, 1), (200, [1.0, None, 0.0], 1), (300, [float("inf")] * 3, 1), (None, [0.1] * 3, 1),
                                               (400, [0.1] * 3, None), (700, [-1.0] * 3, -1), (800, [], 1), (801, [], 2), (900, [], 1)]
    want = brute_negatives(rows)
    assert len(want) > 100 and mined(spark, rows) == want


def test_negatives_of_one_label_and_of_none(spark):
    rows = [(i, [0.1, 0.2], 3 if i % 7 else 2) for i in range(0, 300, 50)]
    assert mined(spark, rows) == []
    assert mined(spark, [(100, [0.5], 1), (200, [0.5], 2)]) == []


def test_negatives_of_odd_tables(spark, odd):
    # All usable rows of an anchor's length have its label, or only a zero score.
    assert sorted(map(tuple, Q.op13_negatives(spark, odd).collect())) == []


def test_bounds_hold_every_score():
    rng = np.random.default_rng(9)
    for _ in range(200):
        a, v = rng.integers(-50, 50, (4, 5)), rng.integers(-50, 50, (9, 5))
        least, most = negatives.interval(a, v.min(0)[None], v.max(0)[None])
        scores = a @ v.T
        assert (least[:, 0] <= scores.min(1)).all() and (scores.max(1) <= most[:, 0]).all()


def test_windows_prune_blocks(spark, monkeypatch):
    """Far groups: only blocks whose zones meet a window are read, and the result is whole."""
    monkeypatch.setattr(negatives, "BLOCK_ROWS", 32)
    rng = np.random.default_rng(10)
    rows = []
    for g in range(8):
        centre = np.zeros(8)
        centre[g] = 1.0
        rows += [(g * 1000 + 5 * i, (centre + rng.normal(0, 0.01, 8)).tolist(), int(rng.integers(3))) for i in range(160)]
    read = []
    plain = negatives.read_blocks
    monkeypatch.setattr(negatives, "read_blocks", lambda tiles, pairs, *r, **k: read.append((pairs.count(), tiles.count())) or plain(tiles, pairs, *r, **k))
    assert mined(spark, rows) == brute_negatives(rows)
    blocks = 8 * 160 / 32
    assert read[1][0] < 0.5 * blocks * read[1][1] and read[2][0] < 0.5 * blocks * read[2][1]
