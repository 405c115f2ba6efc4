"""Centroid clustering, quality classifier and divergence audit on odd inputs and against plain forms."""

import math
import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from clicklens.llm import centroids, divergence, quality_classifier
from clicklens.llm import queries as Q
from clicklens.sources.tables import read_table
from tests.conftest import SF_MID, rows
from tests.llm import brute


# ---------------------------------------------------------------- 11
def test_transform_keeps_distances_in_integers():
    rng = np.random.default_rng(1)
    v = rng.integers(-1 << 24, 1 << 24, (50, 64))
    t = centroids.transform(v)
    assert (((t[:1] - t[1:]) ** 2).sum(axis=1) == 64 * ((v[:1] - v[1:]) ** 2).sum(axis=1)).all()
    changes = [np.count_nonzero(np.diff(row)) for row in centroids.transform(np.eye(64, dtype=np.int64)).T]
    assert changes == sorted(changes) and changes[0] == 0 and changes[-1] == 63


def test_progressive_search_equals_plain_search_with_ties():
    rng = np.random.default_rng(2)
    for spread in (1, 2, 40):       # few values: many ties
        v, c = rng.integers(-spread, spread + 1, (300, 64)), rng.integers(-spread, spread + 1, (16, 64))
        c[5] = c[3]                 # equal centroids: the smaller number
        plain = ((v[:, None] - c[None]) ** 2).sum(axis=2)
        number, distance = centroids.nearest(v, centroids.transform(c))
        assert (number == plain.argmin(axis=1)).all() and (distance == plain.min(axis=1)).all()


def _vectors(spark, table):
    return spark.createDataFrame(table, "vec_id long, embedding array<float>, id string, cluster string, `a.b` int")


def test_clusters_equal_plain_clusters_and_odd_vectors_are_left_out(spark):
    rng = random.Random(3)
    good = [(i, [rng.choice([-1.5, -0.3, 0.0, 0.01, 0.7, 2.25]) for _ in range(64)]) for i in range(120)]
    good += [(500 + i, good[i][1]) for i in range(30)]      # copies
    odd = [(900, None), (901, []), (902, [1.0] * 63), (903, [1.0] * 65), (904, [None] + [1.0] * 63), (905, [math.nan] + [0.0] * 63),
           (906, [math.inf] + [0.0] * 63), (907, [-math.inf] + [0.0] * 63)]
    got = centroids.cluster(_vectors(spark, [(i, v, "x", "y", 1) for i, v in good + odd]).repartition(5))
    ints = {i: [math.floor(64 * float(np.float32(x))) for x in v] for i, v in good}
    want, centers = brute.centroids(ints)
    found = {r.id: r for r in got.collect()}
    assert {i: (r.cluster, r.distance) for i, r in found.items()} == want
    assert all(r.inertia == sum(d for _, d in want.values()) for r in found.values())
    assert all(list(r.centroid) == centers[r.cluster] for r in found.values())
    assert all(r.cluster_inertia == sum(d for c, d in want.values() if c == r.cluster) for r in found.values())


def test_clusters_of_few_and_no_vectors(spark):
    one = [(1, [0.5] * 64, "", "", 0)]
    assert [(r.id, r.cluster, r.distance, r.inertia) for r in centroids.cluster(_vectors(spark, one)).collect()] == [(1, 0, 0, 0)]
    assert centroids.cluster(_vectors(spark, [])).count() == 0
    twice = one + one + [(None, [1.0] * 64, "", "", 0)]     # a repeated id and a null id
    assert sorted((r.id or 0, r.distance) for r in centroids.cluster(_vectors(spark, twice)).collect()) == [(0, 0), (1, 0), (1, 0)]
    with pytest.raises(Exception, match="beyond"):
        centroids.cluster(_vectors(spark, [(1, [1e6] * 64, "", "", 0)])).collect()


# ---------------------------------------------------------------- 12
def test_held_out_quality(spark):
    labels = {r.doc_id: r.quality for r in read_table(spark, SF_MID, "labels").collect()}
    found = Q.op12_quality_classifier(spark, SF_MID).collect()
    assert len(found) == read_table(spark, SF_MID, "documents").count()
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.7) and r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in found)
    held = [(r.score, labels[r.doc_id], r.predicted) for r in found if r.held_out and r.doc_id in labels]
    assert sum(y == p for _, y, p in held) / len(held) > 0.95
    bad, good = ([s for s, y, _ in held if y == k] for k in (0, 1))
    assert sum(g > b for g in good for b in bad) / len(good) / len(bad) > 0.95


def test_isotonic_regression_equals_the_min_max_formula():
    rng = random.Random(5)
    for _ in range(30):
        counts = [rng.randint(1, 9) for _ in range(rng.randint(1, 14))]
        ones = [rng.randint(0, n) for n in counts]
        assert np.allclose(quality_classifier.pool_adjacent_violators(np.array(ones), np.array(counts)), brute.rising(ones, counts))


def _labelled(spark, n=400):
    rng = random.Random(7)
    texts = [" ".join(rng.choice(["apple", "Tree", "the", "of", "river."] if i % 3 else ["a|b", "##", "!!", "XX", "9"]) for _ in range(rng.randint(1, 60)))
             for i in range(n)]
    docs = spark.createDataFrame([(i, t, 1, 2) for i, t in enumerate(texts)], "doc_id long, text string, stats int, `a.b` int")
    return docs, spark.createDataFrame([(i, int(i % 3 > 0)) for i in range(n)], "doc_id long, quality int")


def test_normal_equations_do_not_depend_on_the_partitions(spark):
    docs, labels = _labelled(spark)
    models = [quality_classifier.fit(quality_classifier.statistics(d), labels, F.lit(True), features=32) for d in (docs.coalesce(1), docs.repartition(7))]
    assert (models[0].weights == models[1].weights).all() and (models[0].share == models[1].share).all()
    stats = quality_classifier.statistics(docs).toPandas()
    x = np.vstack(stats["stats"]).astype(float)
    m = models[0]
    phi = np.column_stack([np.cos(np.clip((x - m.mean) / m.deviation, -6, 6) @ m.frequency + m.phase), np.ones(len(x))])
    y = (stats["id"] % 3 > 0).to_numpy(dtype=float)
    penalty = np.diag([1e-5 * len(x)] * 32 + [1e-9 * len(x)])
    assert np.allclose(phi @ m.weights, phi @ np.linalg.solve(phi.T @ phi + penalty, phi.T @ y), atol=0.02)
    scored = {r.id: r.predicted for r in quality_classifier.score(quality_classifier.statistics(docs), m).collect()}
    assert np.mean([scored[i] == (i % 3 > 0) for i in scored]) > 0.95


def test_quality_of_odd_texts_and_labels(spark):
    docs, labels = _labelled(spark, 60)
    odd = spark.createDataFrame([(900, None, 1, 2), (901, "", 1, 2), (None, "apple tree", 1, 2), (902, "word " * 300_000, 1, 2), (902, "\n\n", 1, 2)], docs.schema)
    stats = quality_classifier.statistics(docs.unionByName(odd))
    assert stats.count() == 65 and all(np.isfinite(r.stats).all() and len(r.stats) == len(quality_classifier.STATISTICS) for r in stats.collect())
    more = labels.unionByName(spark.createDataFrame([(7, 0), (999, 1), (None, 1), (8, None)], labels.schema))
    model = quality_classifier.fit(stats, more, F.lit(True), features=16)
    assert quality_classifier.score(stats, model).count() == 65
    for few, score in ((labels.where("quality = 1"), 1.0), (labels.where("quality = 0"), 0.0), (labels.limit(0), 0.5)):
        flat = quality_classifier.score(stats, quality_classifier.fit(stats, few, F.lit(True), features=16))
        assert {r.score for r in flat.collect()} == {score}
    none = quality_classifier.statistics(docs.limit(0))
    assert quality_classifier.score(none, quality_classifier.fit(none, labels, F.lit(True), features=16)).count() == 0


# ---------------------------------------------------------------- 13
def _audited(spark, docs, least, top, **kw):
    frame = spark.createDataFrame([(r["lang"], r["source"], r["text"], 1, 2) for r in docs], "lang string, source string, text string, part int, `a.b` int")
    return sorted(tuple(r) for r in divergence.audit(frame.repartition(3), least, top, **kw).collect())


def test_divergence_equals_plain_loops(spark):
    rng = random.Random(11)
    words = ["the", "The", "rivière", "Öl", "öl", "x1y", "zug", "日本", "a-b", "\U0001F600x", "Éa", "éa"] + [f"w{chr(97 + i)}" for i in range(20)]
    docs = [{"lang": rng.choice(["en", "de", None, "fr"]), "source": rng.choice(["s1", "s2", "s3", None]),
             "text": " ".join(rng.choices(words, k=rng.randint(0, 40)))} for _ in range(300)]
    docs += [{"lang": "xx", "source": f"s{i}", "text": None if i else ""} for i in range(3)]       # no kept terms
    docs += [{"lang": "one", "source": "only", "text": "alone alone"}] * 8                          # one source
    docs += [{"lang": "en", "source": "s9", "text": "!!! 123"}]                                     # a group without terms
    for least, top, block in ((5, 50, 200_000), (3, 4, 10), (1, 1, 3)):
        assert _audited(spark, docs, least, top, block=block) == brute.divergence(docs, least, top)


def test_divergence_of_nothing_and_of_long_texts(spark, monkeypatch):
    assert _audited(spark, [], 1, 5) == []
    assert _audited(spark, [{"lang": None, "source": None, "text": None}], 1, 5) == []
    docs = [{"lang": "en", "source": "ab"[i % 2], "text": f"long{'abcde'[i % 5]} common " * (40_000 if i == 0 else 3)} for i in range(12)]
    assert _audited(spark, docs, 2, 5) == brute.divergence(docs, 2, 5)
    monkeypatch.setattr(divergence, "HELD", 3)      # tasks let their counts go after every block
    assert _audited(spark, docs, 2, 5) == brute.divergence(docs, 2, 5)


def test_levels_of_equal_value_are_cut_in_utf8_order(spark):
    # 70 terms of one cell in one source, more than the report takes
    docs = [{"lang": "en", "source": "a", "text": " ".join(f"t{chr(97 + i % 26)}{'é' if i % 2 else 'z'}{chr(97 + i // 26)}" for i in range(70))}] * 3
    docs += [{"lang": "en", "source": "b", "text": "other words"}] * 3
    assert _audited(spark, docs, 2, 50) == brute.divergence(docs, 2, 50)
    assert rows(spark.range(1)) == [(0,)]
