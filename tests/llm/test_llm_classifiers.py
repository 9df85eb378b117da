"""Classifiers against plain versions: whole vectors in dictionaries or dense matrices, no tasks, no chunks."""

import math
import random
from collections import Counter

import fixtures_llm as fx
import numpy as np
from pyspark.sql import functions as F

from skillgrid.llm import language, toxicity

WORDS = {
    "aa": "the of and river stone with mountain over under light".split(),
    "bb": "der und nicht fluss stein mit berg auf unter licht".split(),
    "cc": "le de et pas fleuve pierre avec montagne sur lumiere".split(),
}


def texts(lang, count, seed):
    rng = random.Random(seed)
    return [" ".join(rng.choice(WORDS[lang]) for _ in range(rng.randint(5, 25))) for _ in range(count)]


def grams(text, sizes, bits):
    from skillgrid.llm.common import letter_codes, ngram_hashes

    return Counter(ngram_hashes(letter_codes(text), sizes, bits).tolist())


def test_languages_equal_a_plain_nearest_centroid(spark):
    train = [(lang, t) for k, lang in enumerate(WORDS) for t in texts(lang, 40, k)]
    held = [t for k, lang in enumerate(WORDS) for t in texts(lang, 15, 50 + k)] + ["xyzzy qwfp", "1234", "the fluss et", "a"]
    rows = [(i, t, lang) for i, (lang, t) in enumerate(train)] + [(1000 + i, t, None) for i, t in enumerate(held)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string")
    model = language.fit(docs, centroids=3)
    # TF-IDF weights from counts in dictionaries.
    seen = Counter(g for _, t in train for g in grams(t, language.SIZES, language.BITS))
    idf = {g: math.log((1 + len(train)) / (1 + k)) + 1 for g, k in seen.items()}
    assert all(math.isclose(model.idf[g], v, rel_tol=1e-9) for g, v in idf.items())
    rest = math.log(1 + len(train)) + 1

    def vector(text):
        v = {g: math.log1p(k) * idf.get(g, rest) for g, k in grams(text, language.SIZES, language.BITS).items()}
        length = math.sqrt(sum(x * x for x in v.values())) or 1.0
        return {g: x / length for g, x in v.items()}

    def cosine(text, k):
        return sum(x * float(model.centroids[k, g]) for g, x in vector(text).items())

    # Each centroid has length 1 and is the direction of the mean of its language's nearest texts.
    for lang in WORDS:
        own = [k for k, name in enumerate(model.languages) if name == lang]
        assert len(own) == 3
        groups, smallest = {k: [] for k in own}, 1.0
        for name, t in train:
            if name == lang:
                best = max(own, key=lambda k: cosine(t, k))
                groups[best].append(t)
                smallest = min(smallest, cosine(t, best))
        for k, members in groups.items():
            mean = Counter()
            for t in members:
                mean.update(vector(t))
            length = math.sqrt(sum(x * x for x in mean.values()))
            assert math.isclose(sum(x / length * float(model.centroids[k, g]) for g, x in mean.items()), 1.0, abs_tol=1e-3)
        assert all(math.isclose(model.reach[k], language.REJECT * smallest, abs_tol=1e-4) for k in own)
    got = {r.doc_id: r._lang for r in language.detect(docs, model).collect()}
    for i, t, _ in rows:
        if not any(c.isalpha() for c in t):
            assert (got[i].lang, got[i].score, got[i].rejected) == ("und", 0.0, True)
            continue
        all_of = [cosine(t, k) for k in range(len(model.languages))]
        best = max(all_of)
        assert math.isclose(got[i].score, min(1.0, best), abs_tol=1e-5)
        near = {model.languages[k] for k, c in enumerate(all_of) if c > best - 1e-6}
        assert got[i].lang in near and got[i].rejected == (best < min(model.reach[k] for k, n in enumerate(model.languages) if n == got[i].lang))
    assert all(got[i].lang == lang for i, (lang, _) in enumerate(train))


def test_toxicity_equals_a_plain_regression_on_scaled_features(spark):
    clean = [t for k, lang in enumerate(WORDS) for t in texts(lang, 60, k)]
    rude = [f"{t} you {w}" for t, w in zip(texts("aa", 45, 9), ["slimeball", "slimebag", "nitwit"] * 15)]
    rows = [(i, t, int(i >= len(clean))) for i, t in enumerate(clean + rude)]
    docs = fx.table(spark, [(i, t) for i, t, _ in rows])
    labels = spark.createDataFrame([(i, y) for i, _, y in rows], "doc_id bigint, toxic int")
    model = toxicity.fit(docs, labels, allowed=F.lit(True))
    sets = [set(grams(t, toxicity.SIZES, toxicity.BITS)) for _, t, _ in rows]
    y = np.array([label for *_, label in rows], float)
    n = [len(rows) - len(rude), len(rude)]
    found = [Counter(g for s, label in zip(sets, y) if label == k for g in s) for k in (0, 1)]
    ratio, telling = {}, {}
    for g in set(found[0]) | set(found[1]):
        c, t = found[0][g], found[1][g]
        ratio[g] = math.log((t + 1) / (n[1] + 2)) - math.log((c + 1) / (n[0] + 2))
        share = (c + t) / len(rows)
        if c + t >= toxicity.LEAST:
            telling[g] = (t - share * n[1]) ** 2 / max(share * n[1] * (1 - min(share, 0.999)), 1e-9)
    order = sorted((g for g in telling if telling[g] > 0), key=lambda g: (-telling[g], g))[: toxicity.FEATURES]
    kept = np.flatnonzero(model.slot >= 0)
    assert len(kept) == len(order)
    # Features that tell equally much may change places at the end of the list.
    least = min(telling[g] for g in order)
    assert all(telling[g] >= least - 1e-9 for g in kept)
    x = np.array([[ratio[g] if g in s else 0.0 for g in kept] for s in sets])
    w, b = np.zeros(len(kept)), math.log(n[1] / n[0])
    with_one = np.hstack([x, np.ones((len(x), 1))])
    ridge = np.diag([toxicity.RIDGE] * len(kept) + [0.0])
    for _ in range(40):  # Newton's method on the whole matrix
        p = 1 / (1 + np.exp(-(x @ w + b)))
        slope = with_one.T @ (p - y) / len(y) + ridge @ np.append(w, b)
        curve = with_one.T @ (with_one * (p * (1 - p))[:, None]) / len(y) + ridge + 1e-12 * np.eye(len(slope))
        step = np.linalg.solve(curve, slope)
        w, b = w - step[:-1], b - step[-1]
    want = 1 / (1 + np.exp(-(x @ w + b)))
    got = {r.doc_id: r._toxic for r in toxicity.score(docs, model).collect()}
    assert max(abs(got[i] - want[i]) for i in range(len(rows))) < 0.02
    # A score is the plain sum of the weights of a text's features, each once.
    for i, s in enumerate(sets):
        z = model.bias + sum(float(model.weights[model.slot[g]]) for g in s if model.slot[g] >= 0)
        assert math.isclose(got[i], 1 / (1 + math.exp(-z)), abs_tol=1e-9)
