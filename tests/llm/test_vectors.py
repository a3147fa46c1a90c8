"""Vector search and whitening against brute force."""

import numpy as np
import pytest

from daymart.llm import code_search, whitening

DDL = "vec_id long, embedding array<float>, label int, x string, id string, score double, asked string, `key` string"


@pytest.fixture(scope="module")
def vectors():
    """300 vectors around ten centres, with copies, and rows that take no part."""
    chance = np.random.default_rng(3)
    centres = chance.standard_normal((10, 12))
    found = [(i, (centres[i % 10] + chance.standard_normal(12) * 0.6).astype(np.float32).tolist()) for i in range(300)]
    found += [(400 + i, found[7][1]) for i in range(30)] + [(440, [2.0 * c for c in found[8][1]])]
    found += [(500, None), (501, []), (502, [0.0] * 12), (503, [1.0, None] * 6), (504, [float("nan")] * 12), (505, [float("inf")] * 12)]
    return found + [(506, [1.0, 2.0]), (None, found[3][1]), (40, found[40][1]), (41, found[41][1])]


def _frame(spark, rows):
    return spark.createDataFrame([(*r, 1, "x", "x", 0.5, "x", "x") for r in rows], DDL).repartition(5)


def _nearest(rows, asked, k):
    used = [(i, np.array(v, dtype=float)) for i, v in rows if v and len(v) == 12 and None not in v and np.isfinite(v).all() and any(v)]
    found = {}
    for q in sorted({i for i, _ in used if i is not None and asked(i)}):
        own = np.array(min(v.tolist() for i, v in used if i == q))
        ranked = sorted((-float(code_search.scores(own[None], v[None])[0]), i is None, i or 0) for i, v in used if i != q)
        found[q] = [(r + 1, None if none else i, -s) for r, (s, none, i) in enumerate(ranked[:k])]
    return found


@pytest.mark.parametrize("radius", [0, 5, 40, 77, 256])
def test_probing_finds_every_code_within_the_radius(radius):
    chance = np.random.default_rng(radius)
    codes = chance.integers(0, 1 << 16, (400, 16), dtype=np.uint16)
    codes[200:] = codes[:200] ^ (chance.random((200, 16)) < 0.3)  # a few bits away
    query, row = code_search.MultiIndex(codes).within(codes[:50], radius)
    expected = {(q, r) for q in range(50) for r in range(400) if code_search.distances(codes[q], codes[r]) <= radius}
    assert set(zip(query.tolist(), row.tolist())) == expected


def test_depths_cover_the_radius():
    for radius in range(0, 257):
        depth = code_search.depths(radius, 16)
        # The dearest way to miss every substring costs more than the radius.
        assert sum(d + 1 for d in depth) == radius + 1


def test_patterns_and_buckets_probe_alike():
    codes = np.random.default_rng(1).integers(0, 1 << 16, (3000, 16), dtype=np.uint16)
    index = code_search.MultiIndex(codes)
    assert code_search._patterns(2, 3000) is not None and code_search._patterns(6, 3000) is None
    keys = index.indexes[0][1]
    left = index._hits(codes[:20, 0], keys, 2)
    right = np.nonzero(np.bitwise_count(codes[:20, 0][:, None] ^ keys[None, :]) <= 2)
    assert set(zip(*map(np.ndarray.tolist, left))) == set(zip(*map(np.ndarray.tolist, right)))


@pytest.mark.parametrize("share", [1.0, 0.5])
def test_nearest(spark, vectors, share):
    """All is found with a radius from all of the true neighbours; with one from half of them queries that come short are asked again."""
    frame = _frame(spark, vectors)
    from pyspark.sql import functions as F

    got = {}
    for r in code_search.nearest(frame, F.col("vec_id") % 20 == 0, k=10, bits=128, sample_queries=10_000, share=share).collect():
        got.setdefault(r["query_id"], []).append((r["rank"], r["vec_id"], r["score"]))
    expected = _nearest(vectors, lambda i: i % 20 == 0, 10)
    assert got.keys() == expected.keys()
    assert all(len(v) == 10 for v in got.values())
    same = sum(len({x[1] for x in got[q]} & {x[1] for x in expected[q]}) for q in got) / (10 * len(got))
    assert same >= (0.97 if share == 1.0 else 0.5)
    if share == 1.0:
        exact = [q for q in got if {x[1] for x in got[q]} == {x[1] for x in expected[q]}]
        assert [sorted(got[q]) for q in exact] == [expected[q] for q in exact]  # ranks, ties and scores to the last bit


def test_reach_finds_what_its_depths_probe():
    chance = np.random.default_rng(2)
    codes = chance.integers(0, 1 << 16, (500, 16), dtype=np.uint16)
    codes[250:] = codes[:250] ^ (chance.random((250, 16)) < 0.3)
    for radius, reach in ((100, 30), (60, 17), (100, 300)):
        query, row = code_search.MultiIndex(codes).within(codes[:40], radius, reach)
        differing = np.bitwise_count(codes[:40, None] ^ codes[None]).astype(int)
        found = (differing <= np.array(code_search.depths(min(radius, reach), 16))).any(axis=2) & (differing.sum(axis=2) <= radius)
        assert sorted(zip(query.tolist(), row.tolist())) == list(zip(*map(np.ndarray.tolist, np.nonzero(found))))
    near = chance.integers(0, 9, (1000, 16))
    for share in (0.5, 0.99, 1.0):
        radius, reach = code_search.bounds(near, share)
        assert ((near <= np.array(code_search.depths(reach, 16))).any(axis=1) & (near.sum(axis=1) <= radius)).mean() >= share


def test_bounds_are_those_of_all_rows(spark, monkeypatch):
    """Each of 60 groups has 30 near vectors, but few in the sample, whose nearest are strangers: bounds from these would let in most rows."""
    from pyspark.sql import functions as F

    chance, seen, real = np.random.default_rng(4), [], code_search.fit
    centres = chance.standard_normal((60, 24))
    rows = [(i, (centres[i % 60] + chance.standard_normal(24) * 0.05).tolist()) for i in range(1800)]
    monkeypatch.setattr(code_search, "fit", lambda *args, **options: seen.append(real(*args, **options)) or seen[-1])
    got = {}
    for r in code_search.nearest(_frame(spark, rows), F.col("vec_id") % 20 == 0, k=20, sample_rows=120).collect():
        got.setdefault(r["query_id"], set()).add(r["vec_id"])
    expected = _nearest(rows, lambda i: i % 20 == 0, 20)
    assert sum(len(got[q] & {x[1] for x in expected[q]}) for q in expected) >= 0.97 * 20 * len(expected)
    points = np.array([v for _, v in rows])
    found = seen[0]
    codes = code_search.coded(code_search.raised(points, found.longest), found.directions)
    questions = code_search.coded(np.hstack([points[::20], np.zeros((90, 1))]), found.directions)
    assert np.mean(code_search.distances(questions[:, None], codes[None]) <= found.radius) < 0.2


def test_copies_do_not_fill_the_sampled_queries(spark, monkeypatch):
    """The vector with the smallest digest has 300 copies; queries for these alone would give a radius of 0."""
    from pyspark.sql import functions as F

    chance, seen, real = np.random.default_rng(6), [], code_search.fit
    rows = [(20 * i, chance.standard_normal(24).tolist()) for i in range(200)]
    first = _frame(spark, rows).orderBy(F.xxhash64("embedding")).first()["embedding"]
    rows += [(20 * i, first) for i in range(200, 500)]
    monkeypatch.setattr(code_search, "fit", lambda *args, **options: seen.append(real(*args, **options)) or seen[-1])
    assert code_search.nearest(_frame(spark, rows), F.col("vec_id") % 20 == 0, k=10, sample_queries=50).count() == 5000
    assert seen[0].radius > 0


def test_rough_scores_lose_nothing():
    """Scores that differ by less than the error of a matrix product all stay, and so do all that overflow."""
    chance = np.random.default_rng(5)
    for scale in (1.0, 1e-170, 1e160):
        stored = np.repeat(chance.standard_normal((1, 64)), 200, axis=0) * scale
        stored[:, 5] *= 1 + np.arange(200) * 2.0**-52
        asked = chance.standard_normal((3, 64)) * scale
        query, row = np.repeat(np.arange(3), 200), np.tile(np.arange(200), 3)
        with np.errstate(all="ignore"):
            near = code_search._foremost(query, row, asked, stored, float(np.sqrt((stored**2).sum(axis=1).max())), 20)
            for q in range(3):
                best = np.argsort(-code_search.scores(np.repeat(asked[q : q + 1], 200, axis=0), stored), kind="stable")[:20]
                assert near[200 * q + best].all()


def test_all_rows_if_fewer_and_none(spark, vectors):
    from pyspark.sql import functions as F

    few = code_search.nearest(_frame(spark, vectors[:5]), F.col("vec_id") == 0, k=20).collect()
    assert sorted(r["vec_id"] for r in few) == [1, 2, 3, 4]
    for rows in ([], vectors[-11:-5], vectors[1:2]):
        assert code_search.nearest(_frame(spark, rows), F.col("vec_id") % 20 == 0).collect() == []


def _white(rows, scale=64, shift=1_000_000):
    used = [(i, tuple(int(np.floor(float(c) * scale)) + shift for c in v)) for i, v in rows if v and len(v) == 12 and None not in v and np.isfinite(v).all()]
    fit = sorted({x for _, x in used})
    n, total = len(fit), [sum(c) for c in zip(*fit)]
    centred = np.array([[n * a - s for a, s in zip(x, total)] for x in fit], dtype=float) / n
    values, axes = np.linalg.eigh(centred.T @ centred / n)
    return used, n, total, values[::-1], axes[:, ::-1]


def test_whitening(spark, vectors):
    used, n, total, values, axes = _white(vectors)
    rows = whitening.whitened(_frame(spark, vectors), components=5, rows_per_block=64).collect()
    assert len(rows) == 5 * len(used) and {r["n"] for r in rows} == {n}
    assert sorted(r["vec_id"] or -1 for r in rows if r["component"] == 1) == sorted(i or -1 for i, _ in used)
    assert {r["identity_error"] for r in rows} == {rows[0]["identity_error"]} and rows[0]["identity_error"] < 1e-9
    of = dict(used)
    signs = {}
    for r in rows:
        x, k = of[r["vec_id"]], r["component"] - 1
        assert r["deviation"] == sum((n * a - s) ** 2 for a, s in zip(x, total))
        assert r["explained"] == pytest.approx(values[k] / values.sum(), rel=1e-9)
        value = np.dot([(n * a - s) / n for a, s in zip(x, total)], axes[:, k]) / np.sqrt(values[k])
        assert abs(r["whitened"]) == pytest.approx(abs(value), abs=1e-8)
        if abs(value) > 1e-6:
            assert signs.setdefault(k, np.sign(value * r["whitened"])) == np.sign(value * r["whitened"])


def test_whitening_without_variance_and_without_rows(spark):
    flat = whitening.whitened(_frame(spark, [(1, [1.0, 2.0]), (2, [2.0, 2.0]), (2, [2.0, 2.0]), (3, [1e30, 1.0][:1])]), components=4).collect()
    assert len(flat) == 6 and {r["whitened"] for r in flat if r["component"] == 2} == {0.0}
    assert sorted(r["whitened"] for r in flat if r["component"] == 1 and r["vec_id"] == 2) == pytest.approx([flat[0]["whitened"]] * 2, abs=2.1)
    alone = whitening.whitened(_frame(spark, [(1, [1e30, -1e30])])).collect()
    assert [(r["whitened"], r["identity_error"], r["deviation"]) for r in alone] == [(0.0, 0.0, 0)] * 2
    wide = whitening.whitened(_frame(spark, [(1, [1e30]), (2, [-1e30])])).collect()
    assert {r["deviation"] for r in wide} == {None}
    assert whitening.whitened(_frame(spark, [(1, None), (2, [])])).collect() == []
