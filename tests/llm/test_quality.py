"""Quality rules and pairwise quality."""

import collections
import random
import re

import numpy as np
import pytest
from samples import prose

from daymart.llm import pairwise_quality, quality_rules

WORD = re.compile("[^\x20\x09-\x0d]+")


def brute(text):
    text = text or ""
    words = WORD.findall(text)
    windows = [tuple(words[i : i + 5]) for i in range(len(words) - 4)]
    times = collections.Counter(windows)
    covered = {i + k for i, w in enumerate(windows) if times[w] > 1 for k in range(5)}
    lines = [x for x in text.split("\n") if WORD.search(x)]
    return {
        "n_words": len(words),
        "word_chars": sum(map(len, words)),
        "n_symbols": sum(c in "#*$%&|<>" for c in text),
        "n_dup_lines": len(lines) - len(set(lines)),
        "n_repeat_words": len(covered),
    }


def random_text(seed):
    draw = random.Random(seed)
    words = ["a", "b", "ü|", "#x", "🙂", "c d", "e"]
    return "".join(draw.choice(words) + draw.choice([" ", "\n", " \t", "\n\n", "\x0b"]) for _ in range(draw.randint(0, 40)))


def test_measures_against_brute_force(make, messy):
    texts = [random_text(k) for k in range(80)] + [r[1] for r in messy] + ["a b c d e " * 500, "x " * 5, "same line\n" * 30]
    frame = quality_rules.judged(make([(i, t, "en", "s") for i, t in enumerate(texts)]), into="m", keep=["doc_id"])
    got = {r["doc_id"]: r["m"] for r in frame.collect()}
    for i, text in enumerate(texts):
        want = brute(text)
        assert {k: got[i][k] for k in want} == want, repr(text)[:100]
        failed = want["n_words"] < 10 or 100 * want["n_repeat_words"] > 20 * want["n_words"]
        assert got[i]["base_failed"] == failed and not (failed and got[i]["kept"])


def test_votes_separate_junk_from_prose(make):
    good = [prose(k) for k in range(150)]
    bad = [" ".join(w + "*$%" for w in prose(k).split()) for k in range(200, 230)]
    kept = {r["doc_id"] for r in quality_rules.accepted(make([(i, t, "en", "s") for i, t in enumerate(good + bad)])).collect()}
    assert kept == set(range(150))


def test_estimate_finds_the_reliable_rule():
    draw = random.Random(1)
    counts = collections.Counter()
    for _ in range(4000):
        truth = 1 if draw.random() < 0.7 else -1
        right = [0.95, 0.9, 0.85, 0.6, 0.6, 0.6, 0.6]
        counts[tuple(truth if draw.random() < p else -truth for p in right)] += 1
    model = quality_rules.estimate(sorted(counts.items()))
    assert abs(model.prior - 0.7) < 0.05
    first, last = list(quality_rules.RULES)[0], list(quality_rules.RULES)[-1]
    assert model.when_good[first] > 2 * model.when_good[last]


def test_stage_keeps_columns_and_survives_messy_rows(make, messy, spark):
    docs = make(messy)
    out = quality_rules.accepted(docs)
    assert out.columns == docs.columns
    # Blank texts and a text of one word go; the copies of a row are judged alike.
    assert sorted(str(r["doc_id"]) for r in out.collect()) == ["1", "5", "6", "6", "8", "None"]
    empty = docs.filter("false")
    assert quality_rules.accepted(empty).count() == 0


@pytest.fixture(scope="module")
def labelled():
    good = [prose(k, 20 + k % 90) for k in range(240)]
    bad = [prose(1000 + k, 20 + k % 90).upper().replace(" ", "!! ") if k % 2 else " | ".join(prose(k).split()) for k in range(60)]
    return [(i, t) for i, t in enumerate(good + bad)], [(i, int(i < 240)) for i in range(300)]


def test_pairwise_scores_held_out_texts(make, spark, labelled):
    texts, labels = labelled
    docs = make([(i, t, "en", "s") for i, t in texts])
    taught = spark.createDataFrame([x for x in labels if x[0] % 3 != 1], "doc_id long, label int")
    model = pairwise_quality.fit(docs, taught)
    truth = dict(labels)
    rows = pairwise_quality.scored(docs, model).collect()
    held = [r for r in rows if r["doc_id"] % 3 == 1]
    assert np.mean([r["predicted"] == truth[r["doc_id"]] for r in held]) > 0.97
    assert all(0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.5) for r in rows)


def test_pairwise_weights_against_plain_gradient_descent():
    draw = np.random.default_rng(3)
    n = pairwise_quality.N_FEATURES
    good, bad = draw.normal(0.4, 1, (60, n)), draw.normal(0, 2, (50, n))
    pairs, ridge = 2_000, 0.05
    model = pairwise_quality.learn(good, bad, 0.4, pairs=pairs, ridge=ridge)
    again = np.random.default_rng(7)
    left, right = again.integers(0, len(good), pairs), again.integers(0, len(bad), pairs)
    spread = np.vstack([good, bad]).std(0)
    weights = np.zeros(n)
    for _ in range(4_000):
        slope = ridge * weights
        gaps = (good[left] - bad[right]) / spread
        slope = slope - (gaps / (1 + np.exp(gaps @ weights))[:, None]).mean(0)
        weights = weights - 0.1 * slope
    assert np.allclose(model.weights, weights, atol=1e-4)
    scores = sorted([(s, 0.6 / 60) for s in model.raw(good)] + [(s, 0.4 / 50) for s in model.raw(bad)])
    below = sum(w for s, w in scores if s < model.threshold)
    assert abs(below - 0.4) <= 0.01


def test_pairwise_takes_one_text_of_a_repeated_id(make, spark):
    rows = [(i, f"word {i} " * (5 + i % 3), "en", "s") for i in range(8)] + [(1, "x " * k, "en", "s") for k in range(1, 40)]
    taught = spark.createDataFrame([(i, i % 2) for i in range(8)], "doc_id long, label int")
    seen = []
    learn, pairwise_quality.learn = pairwise_quality.learn, lambda good, bad, share: seen.append((len(good), len(bad)))
    try:
        pairwise_quality.fit(make(rows), taught)
    finally:
        pairwise_quality.learn = learn
    assert seen == [(4, 4)]


def test_pairwise_edge_cases(make, spark, messy):
    docs = make(messy)
    odd = [(1, 1), (1, 0), (2, 7), (None, 1), (5, None), (6, 1), (9, 0)]
    model = pairwise_quality.fit(docs, spark.createDataFrame(odd, "doc_id long, label int"))
    rows = pairwise_quality.scored(docs, model).collect()
    assert len(rows) == len(messy) and len({r["score"] for r in rows if r["doc_id"] == 6}) == 1
    one_class = pairwise_quality.fit(docs, spark.createDataFrame([(1, 1)], "doc_id long, label int"))
    assert {r["score"] for r in pairwise_quality.scored(docs, one_class).collect()} == {0.5}
    assert pairwise_quality.scored(docs.filter("false"), model).count() == 0
