import random
import tracemalloc

import numpy as np
import pytest

from plaintlens.llm.quality_classifier import (
    CoTraining, View, co_train, fit, kept_documents, logistic, quality_scores, text_features)

GOOD = "the river runs past old houses where people talk about weather and bread".split()
BAD = "buy | now $$$ | click | here | free ### | win | cash !!! | deal".split()


def corpus(n, seed=1, tell=True):
    """Documents whose source hints at quality if ``tell``."""
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        good = rng.random() < 0.7
        words = [rng.choice(GOOD if rng.random() < (0.9 if good else 0.2) else BAD) for _ in range(rng.randint(20, 80))]
        source = f"s{rng.randrange(4) + 4 * (not good)}" if tell and rng.random() < 0.9 else "s9"
        rows.append((i, " ".join(words), rng.choice(["en", "de"]), source, 100, int(good)))
    return rows


SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
SMALL = CoTraining(labelled=300, held_out=150, pool=200)


def frames(spark, rows, labelled=0.5):
    docs = spark.createDataFrame([r[:5] for r in rows], SCHEMA)
    share = [(r[0], r[5], 0) for r in rows[: int(len(rows) * labelled)]]
    return docs, spark.createDataFrame(share, "doc_id long, quality int, toxic int")


def test_held_out_accuracy(spark):
    rows = corpus(1200)
    docs, labels = frames(spark, rows)
    got = {r.doc_id: r for r in quality_scores(docs, labels, SMALL).collect()}
    unseen = rows[600:]
    right = sum(got[r[0]].kept == bool(r[5]) for r in unseen)
    good_lost = sum(r[5] and not got[r[0]].kept for r in unseen)
    assert right > 0.97 * len(unseen) and good_lost < 0.01 * len(unseen)
    kept = {r.doc_id for r in kept_documents(docs, labels, SMALL).collect()}
    assert kept == {i for i, r in got.items() if r.kept}


def test_views_teach_each_other():
    """With few labels, pseudo-labels of the other view raise what the weak view knows."""
    rng = np.random.default_rng(1)
    y = rng.integers(0, 2, 2000)
    strong = (y * 2 - 1)[:, None] * 2 + rng.normal(size=(2000, 2))
    weak = (y * 2 - 1)[:, None] * 0.2 + rng.normal(size=(2000, 60))
    part = lambda a, b: (strong[a:b], weak[a:b])
    args = part(0, 30), y[:30], part(30, 200), y[30:200], part(200, 1500)
    alone = co_train(*args, CoTraining(rounds=0))
    taught = co_train(*args, CoTraining(rounds=5))
    score = lambda m: ((m.scores(*part(1500, 2000))[1] > 0.5) == y[1500:]).mean()
    assert score(taught) > score(alone) + 0.05


def test_scores_do_not_depend_on_the_batch(spark):
    docs, labels = frames(spark, corpus(300))
    one = {r.doc_id: r.score for r in quality_scores(docs.coalesce(1), labels, SMALL).collect()}
    many = {r.doc_id: r.score for r in quality_scores(docs.repartition(7), labels, SMALL).collect()}
    assert one.keys() == many.keys() and all(abs(one[i] - many[i]) < 1e-9 for i in one)


@pytest.mark.parametrize("labels", [[], [(1, 1, 0), (2, 1, 0)], [(None, 0, 0), (1, None, 0)]])
def test_without_two_classes_everything_stays(spark, labels):
    docs, _ = frames(spark, corpus(20))
    labels = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    rows = quality_scores(docs, labels, SMALL).collect()
    assert len(rows) == 20 and all(r.kept and r.score is None for r in rows)
    assert kept_documents(docs, labels, SMALL).count() == 20


def test_nulls_long_texts_and_repeated_rows(spark):
    rows = corpus(300)
    docs, labels = frames(spark, rows)
    odd = [(None, None, None, None, None), (1, None, None, None, None), (2, "x" * 300_000, "en", "", -5), rows[0][:5], (900, "", "", "", 0)]
    more = docs.union(spark.createDataFrame(odd, SCHEMA)).selectExpr("*", "text AS score", "1 AS kept")
    got = quality_scores(more, labels.union(spark.createDataFrame([(3, 1, 0), (3, 0, 0)], labels.schema)), SMALL)
    assert got.count() == 305 and got.filter("score IS NULL").count() == 0
    assert kept_documents(more, labels, SMALL).columns == more.columns
    assert quality_scores(docs.limit(0), labels, SMALL).collect() == []


def test_features_and_regression():
    x = text_features(["abc", "", "aé\n#1", "abc"])
    assert x.shape[0] == 4 and not x[1].any() and (x[0] == x[3]).all()
    y = np.array([0, 0, 1, 1.0])
    z = np.array([[0.0], [1.0], [2.0], [3.0]])
    p = logistic(View(1e-3).fit(z, y).odds(z))
    assert (p[:2] < 0.5).all() and (p[2:] > 0.5).all()


def test_sample_is_bounded(spark):
    docs, labels = frames(spark, corpus(400))
    assert fit(docs, labels, CoTraining(labelled=40, held_out=30, pool=10)) is not None


@pytest.mark.parametrize("n", [110, 1500])
@pytest.mark.parametrize("wrong", [1, 3, 6])
def test_a_few_wrong_good_labels_let_no_junk_through(n, wrong):
    rng = np.random.default_rng(3)

    def part(rows):
        y = (rng.random(rows) < 0.7).astype(int)
        return tuple((y * 2 - 1)[:, None] + rng.normal(size=(rows, 8)) for _ in range(2)), y

    (train, y), (held, y_held), (unseen, y_unseen) = part(600), part(n), part(2000)
    for view in held:  # good labels on the most junk-like texts
        view[np.flatnonzero(y_held == 1)[:wrong]] = -2.5
    model = co_train(train, y, held, y_held, tuple(v[:0] for v in train), CoTraining())
    kept = model.scores(*unseen)[2] >= model.threshold
    assert kept[y_unseen == 0].mean() < 0.1 and kept[y_unseen == 1].mean() > 0.95


def test_fitting_holds_one_wide_copy():
    rng = np.random.default_rng(3)
    x = rng.random((1_500, 2_059)).astype(np.float16)
    y = (rng.random(1_500) < 0.5).astype(float)
    wide = x.size * 8
    tracemalloc.start()
    view = View(1e-2).fit(x, y, steps=5)
    odds = view.odds(x)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 1.5 * wide
    plain = x.astype(float)
    scale = np.where(plain.std(axis=0) < 1e-3, 1.0, plain.std(axis=0))
    assert np.array_equal(view.mean, plain.mean(axis=0)) and np.array_equal(view.scale, scale)
    assert np.array_equal(odds, (plain - view.mean) / scale @ view.weights[:-1] + view.weights[-1])
