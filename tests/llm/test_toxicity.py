"""The risk estimator against its definition, and held-out accuracy."""

import random
import zlib

import numpy as np

from farelens.llm import toxicity as tox


def test_slopes_follow_the_risk():
    rng = np.random.default_rng(3)
    zp, zu, prior, eps = rng.normal(size=5), rng.normal(size=7), 0.3, 1e-6
    total = lambda p, u: sum(tox.pu_risk(p, u, prior))
    sp, su = tox.pu_slopes(zp, zu, prior)
    for z, s, f in ((zp, sp, lambda d: total(zp + d, zu)), (zu, su, lambda d: total(zp, zu + d))):
        for i in range(len(z)):
            d = np.eye(len(z))[i] * eps
            assert abs((f(d) - f(-d)) / (2 * eps) - s[i]) < 1e-6
    # Positives scored high and all others low: the clean risk is negative, the step turns.
    zp, zu = np.full(5, 9.0), np.full(7, -9.0)
    assert tox.pu_risk(zp, zu, prior)[1] < 0
    sp, su = tox.pu_slopes(zp, zu, prior)
    assert (sp > 0).all() and (su < 0).all()


def test_held_out_accuracy(spark):
    rng = random.Random(2)
    plain = [f"wort{i}" for i in range(300)]
    docs, labels = [], []
    for i in range(900):
        words = rng.choices(plain, k=80)
        toxic = rng.random() < 0.2
        if toxic:
            for _ in range(4):
                words[rng.randrange(80)] = rng.choice(["Vile.", "vileness", "NASTY", "nasty,"])
        docs.append((i, " ".join(words), "x"))
        if i % 2 or i % 3:
            labels.append((i, int(toxic)))
    docs += [(None, None, None), (5000, "", "e"), (5001, "nasty " * 30_000, "l")]
    truth = dict(labels)
    docs_df = spark.createDataFrame(docs, "doc_id long, text string, score string")
    labels_df = spark.createDataFrame(
        labels + [(None, 1), (77777, None), (99999, 1)], "doc_id long, toxic int")
    found = tox.judge(docs_df, labels_df).collect()
    assert len(found) == len(docs)
    by_id = {r.doc_id: r for r in found}
    for i, r in by_id.items():
        assert r.held_out == (i is not None and zlib.crc32(str(i).encode()) % 3 == 1)
        assert 0 <= r.score <= 1 and r.predicted == (r.score >= 0.7)
    held = [r for r in found if r.held_out and r.doc_id in truth]
    assert np.mean([r.predicted == truth[r.doc_id] for r in held]) > 0.97
    assert by_id[5001].predicted == 1 and by_id[5000].predicted == 0
    assert by_id[None].score == by_id[5000].score
    # The same input gives the same scores.
    again = {r.doc_id: r.score for r in tox.judge(docs_df.repartition(3), labels_df).collect()}
    assert all(abs(again[i] - r.score) < 1e-9 for i, r in by_id.items())


def test_without_labels(spark):
    docs = spark.createDataFrame([(1, "a b")], "doc_id long, text string")
    none = spark.createDataFrame([], "doc_id long, toxic int")
    assert tox.judge(docs, none).first().predicted == 0
    assert tox.judge(docs.limit(0), none).count() == 0
