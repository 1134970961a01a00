"""The field's sums and gradients against every labelling; scores on held-out labels and odd rows."""

from itertools import product

import numpy as np
import pyarrow.parquet as pq
import pytest

from millrace.llm import line_quality as lq
from millrace.llm.common import labelled_sample
from millrace.llm.queries import QUERIES

TEXTS = ["One line here.\nTWO!! LINES!!\nthree | four | five", "single", "a\nb\nc\nd\ne", "", "x " * 9 + "\n\n \n" + "$$$ %%%\n" * 3]


def small_field(seed=3):
    table, sizes = lq.measure([lq.lines_of(t) for t in TEXTS])
    field = lq.Field(lq.Bins(table, 3))
    field.weights = np.random.default_rng(seed).normal(0, 0.7, len(field.weights))
    return field, field.lay_out(table, sizes), sizes


def weight_of(field, laid, begin, states):
    """Log weight of one labelling of the lines from `begin`, straight from the definition."""
    places, _, _, kinds, _ = laid
    own, before, after, edge, change = field.parts(field.weights)
    change = change.reshape(lq.KINDS, 2, 2)
    total = 0.0
    for i, state in enumerate(states):
        at = begin + i
        if state:
            total += own[places[at]].sum()
            total += before[places[at - 1]].sum() if i else edge[0]
            total += after[places[at + 1]].sum() if i + 1 < len(states) else edge[1]
        if i:
            total += change[kinds[at], int(states[i - 1]), int(state)]
    return total


def test_marginals_and_sum_equal_all_labellings():
    field, laid, sizes = small_field()
    good, pairs, log_all, _ = field.run(laid, field.weights)
    begin, logs = 0, 0.0
    for size in sizes.tolist():
        weights = {s: np.exp(weight_of(field, laid, begin, s)) for s in product((False, True), repeat=size)}
        whole = sum(weights.values())
        logs += np.log(whole)
        for i in range(size):
            assert good[begin + i] == pytest.approx(sum(w for s, w in weights.items() if s[i]) / whole, rel=1e-9)
            if i:
                for a, b in product((0, 1), repeat=2):
                    both = sum(w for s, w in weights.items() if (s[i - 1], s[i]) == (a, b)) / whole
                    assert pairs[begin + i, a, b] == pytest.approx(both, rel=1e-9)
        begin += size
    assert log_all == pytest.approx(logs, rel=1e-9)


def test_gradient_equals_differences():
    field, laid, sizes = small_field(5)
    states = np.random.default_rng(1).random(sizes.sum()) < 0.5
    _, slope = field.loss(laid, states, field.weights)
    for i in np.random.default_rng(2).choice(len(field.weights), 40, replace=False):
        step = np.zeros(len(field.weights))
        step[i] = 1e-5
        up, down = (field.loss(laid, states, field.weights + s)[0] for s in (step, -step))
        assert slope[i] == pytest.approx((up - down) / 2e-5, abs=1e-4)


def test_descent_reaches_the_minimum():
    scale = np.array([1.0, 10.0, 100.0])
    found = lq.descend(lambda w: (float(scale @ (w - 1) ** 2) / 2, scale * (w - 1)), np.zeros(3), 100)
    assert found == pytest.approx(np.ones(3), abs=1e-2)


def test_texts_do_not_touch_each_other():
    """The marginals of a text are the same alone and among others, however many lines it has."""
    field, _, _ = small_field()
    model = lq.LineQuality(field)
    many = ["\n".join(f"line {i} {'!!' * (i % 7)}" for i in range(5000)), *TEXTS]
    together = np.split(model.marginals(many)[0], np.cumsum([len(lq.lines_of(t)) for t in many])[:-1])
    for text, met in zip(many, together):
        assert model.marginals([text])[0] == pytest.approx(met, abs=1e-9)


def test_measures_of_a_line():
    row = dict(zip(lq.FEATURES, lq.measure([[b"Ab cd!! 12 | x", b"Ab cd!! 12 | x", b"zz"]])[0][0]))
    assert (row["bars"], row["cries"], row["doubled"], row["copies"]) == (pytest.approx(0.2), pytest.approx(0.4), pytest.approx(0.2), 1)
    assert (row["capitals"], row["digits"]) == (pytest.approx(0.2), pytest.approx(0.2))
    assert row["ending_marks"] == pytest.approx(0.4) and row["longest"] == pytest.approx(np.log2(5))


@pytest.mark.parametrize("folder, least", [("/root/testdata/sf0.01", 0.9), ("/root/testdata/sf0.1", 0.95)])
def test_held_out_labels(spark, folder, least):
    rows = {r["doc_id"]: r for r in QUERIES["op12_line_quality"](spark, folder).collect()}
    known = [(rows[x["doc_id"]], x["quality"]) for x in pq.read_table(f"{folder}/labels.parquet").to_pylist()]
    held = [(r["score"], r["predicted"], y) for r, y in known if r["held_out"]]
    good, bad = ([(s, p) for s, p, y in held if y == wanted] for wanted in (1, 0))
    assert np.mean([p for _, p in good]) >= 0.97
    pairs = [(a > b) + (a == b) / 2 for a, _ in good for b, _ in bad]
    print(folder, "auc", np.mean(pairs), "good kept", np.mean([p for _, p in good]), "bad caught", 1 - np.mean([p for _, p in bad]))
    assert np.mean(pairs) >= least
    assert all(0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.3) for r in rows.values())


def test_odd_rows(spark, odd, empty):
    labels = spark.createDataFrame([(1, 1), (2, 1), (2, 0), (3, 0), (5, 1), (8, 0), (10, 0), (None, 1), (9, None), (6, 1), (7, 0), (4, 0)],
                                   "doc_id long, quality int")
    model = lq.LineQuality.fit(odd, labels)
    rows = odd.select("doc_id", model.score("text").alias("s"), model.line_scores("text").alias("lines"), "text").collect()
    assert len(rows) == odd.count() and all(0 <= r["s"] <= 1 for r in rows)
    for r in rows:
        lines = (r["text"] or "").split("\n")
        assert [x is None for x in r["lines"]] == [not line.strip(" \t\r\x0b\x0c") for line in lines]
    assert lq.keep_good(odd, model, 0.0).columns == odd.columns
    assert lq.keep_good(odd, model, 0.0).count() == odd.count()
    assert empty.select(model.score("text")).count() == 0
    nothing = lq.LineQuality.fit(empty, labels)
    assert {r[0] for r in odd.select(nothing.score("text")).collect()} == {0.5}


def test_a_hot_labelled_id_gives_one_text(spark):
    """A third of the rows with one id and labels that repeat: the sample holds one text of an id."""
    docs = spark.range(3000).selectExpr("if(id % 3 = 0, 1, id) as doc_id", "concat('text ', id, if(id % 2 = 0, ' $$$ %%%', '')) as text")
    labels = spark.range(1, 3000).selectExpr("id as doc_id", "cast(id % 2 as int) as quality").union(
        spark.createDataFrame([(1, 1)] * 5, "doc_id long, quality int"))
    sample = labelled_sample(docs, labels, 10_000, "doc_id", "text", "quality", 12, 3)
    assert sample.count() == docs.filter("doc_id is not null and doc_id > 0").select("doc_id").distinct().count()
    assert labelled_sample(docs, labels, 100, "doc_id", "text", "quality", 12, 3).count() < 200
