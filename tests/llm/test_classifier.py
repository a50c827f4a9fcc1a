import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from hard import words
from rollcall.llm import classifier
from rollcall.llm.words import word_slices


def rows_of(texts):
    return [x for w in word_slices(pa.array(texts)) for x in classifier.indicators(w)]


def junk(k):
    return [f"again{k} " * 80, words(k, 60).upper().replace(" ", "!! "),
            words(k, 60).replace(" ", "*** ")][k % 3]


def test_held_out_accuracy(spark, hard):
    docs = [(k, words(k, 60) if k % 4 else junk(k), "en", "s", 0) for k in range(400)]
    docs = hard(docs)
    labels = spark.range(0, 400).selectExpr("id AS doc_id", "id % 4 > 0 AS good", "'x' AS text")
    model = classifier.train(docs, labels.where("doc_id < 300"))
    scored = docs.where("doc_id >= 300").select(
        "doc_id", classifier.score(F.col("text"), model).alias("s")).collect()
    right = sum((r["s"] >= classifier.THRESHOLD) == (r["doc_id"] % 4 > 0) for r in scored)
    assert right >= 0.97 * len(scored)
    again = classifier.train(docs.repartition(5), labels.where("doc_id < 300"))
    assert np.allclose(model.weights, again.weights) and model.shift == again.shift


def test_hard_rows_get_scores(spark, hard):
    labels = spark.createDataFrame([(1, True), (2, False), (None, True), (3, None), (50, True),
                                    (53, False), (70, True)], "doc_id long, good boolean")
    model = classifier.train(hard(), labels)
    got = hard().select(classifier.score(F.col("text"), model).alias("s")).collect()
    assert len(got) == hard().count() and all(0 <= r["s"] <= 1 for r in got)


def test_no_labels_or_one_class(spark, hard):
    none = classifier.train(hard(), spark.createDataFrame([], "doc_id long, good boolean"))
    assert none.scores(rows_of(["a b c"]))[0] == 0.5
    one = classifier.train(hard(), spark.createDataFrame([(1, True)], "doc_id long, good boolean"))
    assert 0.6 < one.scores(rows_of([""]))[0] < 0.7
    empty = classifier.train(hard([]), spark.createDataFrame([(1, True)],
                                                             "doc_id long, good boolean"))
    assert empty.scores(rows_of(["x"]))[0] == 0.5


def test_coordinate_descent_reaches_the_optimum():
    """The primal and the dual objective meet."""
    r = np.random.default_rng(0)
    rows = [np.sort(r.choice(300, 20, replace=False)) for _ in range(60)]
    sign = np.where([x[0] % 2 == 0 for x in rows], 1.0, -1.0)
    ratios = np.ones(classifier.WIDTH)
    weights, bias = classifier._coordinate_descent(rows, ratios, sign)
    margins = np.array([(ratios * weights)[x].sum() / np.sqrt(20 + classifier.DAMPING) + bias for x in rows]) * sign
    share = np.where(sign > 0, (sign > 0).mean(), (sign < 0).mean())
    most = classifier.COST / (2 * share)
    primal = 0.5 * (weights @ weights + bias ** 2) + (most * np.maximum(0, 1 - margins)).sum()
    worse = 0.5 * ((1.01 * weights) @ (1.01 * weights) + bias ** 2) + \
        (most * np.maximum(0, 1 - margins * 1.01)).sum()
    assert primal <= worse + 1e-2


def test_equal_to_a_plain_dual_solver():
    """Log ratios by counting in dictionaries, the dual by sweeps over a whole Gram matrix."""
    r = np.random.default_rng(4)
    good = np.arange(50) % 3 > 0
    rows = [np.sort(r.choice(np.arange(40) + 5 * y, 12, replace=False)) for y in good]
    counts = [{}, {}]
    for x, y in zip(rows, good):
        for place in x.tolist():
            counts[int(y)][place] = counts[int(y)].get(place, 0) + 1
    totals = [sum(c.values()) + classifier.SMOOTHING * classifier.WIDTH for c in counts]
    ratio = {p: np.log((counts[1].get(p, 0) + classifier.SMOOTHING) / totals[1]
                       / ((counts[0].get(p, 0) + classifier.SMOOTHING) / totals[0]))
             for p in range(50)}
    ratios = classifier._log_ratios(rows, good)
    assert all(abs(ratios[p] - v) < 1e-9 for p, v in ratio.items())

    sign = np.where(good, 1.0, -1.0)
    x = np.zeros((50, 50))
    for k, places in enumerate(rows):
        for p in places:
            x[k, p] = ratio[p] / np.sqrt(len(places) + classifier.DAMPING)
    gram = (x @ x.T + 1) * np.outer(sign, sign)
    most = classifier.COST / (2 * np.where(good, good.mean(), (~good).mean()))
    dual = np.zeros(50)
    for _ in range(20000):
        for k in range(50):
            dual[k] = min(max(dual[k] + (1 - gram[k] @ dual) / gram[k, k], 0.0), most[k])
    plain = (x @ x.T + 1) @ (dual * sign)
    weights, bias = classifier._coordinate_descent(rows, ratios, sign)
    assert abs(x @ weights[:50] + bias - plain).max() < 0.02


def test_a_very_often_repeated_id_counts_once(spark, hard):
    docs = [(k, words(k, 60) if k % 4 else junk(k), "en", "s", 0) for k in range(60)]
    often = docs + [(7, docs[7][1], "en", "s", 0)] * 300 + [(8, docs[8][1], "en", "s", 0)] * 300
    labels = spark.range(0, 60).selectExpr("id AS doc_id", "id % 4 > 0 AS good")
    one, many = (classifier.train(hard(d), labels) for d in (docs, often))
    assert np.allclose(one.weights, many.weights) and one.shift == many.shift
