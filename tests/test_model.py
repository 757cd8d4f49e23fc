from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from skyledger.operators.running import running_sums
from skyledger.plans import delay_model
from skyledger.sources.driver_tables import DriverTables
from tests.conftest import SMALL, rows_of


@pytest.fixture(scope="module")
def trained(spark):
    prepared = delay_model.prepare(DriverTables(spark, SMALL).flights)
    train, test = delay_model.split(prepared)
    return train, test, delay_model.train_forest(train, trees=5, depth=5, min_leaf=20)


def test_airports_beyond_the_busiest_are_grouped(spark):
    rows = spark.createDataFrame([(a,) for a in "AAABBCD"], "origin string")
    grouped = delay_model.group_airports(rows, "origin", keep=2)
    found = sorted(r.origin_grp for r in grouped.collect())
    assert found == ["A", "A", "A", "B", "B", "OTHER", "OTHER"]


def test_split_is_exact_for_each_label(spark, trained):
    train, test, _ = trained
    n = lambda df: {r.label: r["count"] for r in df.groupBy("label").count().collect()}
    learned, held = n(train), n(test)
    assert all(held[k] == (learned[k] + held[k]) // 5 for k in learned)
    rows = spark.createDataFrame([(1.0, f"{i % 3:032x}") for i in range(30)], "label double, key string")
    marked = delay_model.mark_test(rows, 0.5).groupBy("key", "is_test").count().collect()
    assert {(r.key[-1], r.is_test): r["count"] for r in marked} == {
        ("0", True): 10, ("1", True): 5, ("1", False): 5, ("2", False): 10
    }


@pytest.mark.parametrize("share", [0.0, 0.2, 0.61, 1.0])
@pytest.mark.parametrize("bound", [1, 5, 10**6])
def test_split_of_keys_that_begin_alike(spark, share, bound):
    """A hot prefix, a key that a third of the rows have, and a few others."""
    keys = [f"{'ab' * 13}{i % 40:06x}" for i in range(200)] + ["ab" * 16] * 130 + [f"{i:032x}" for i in range(60)]
    rows = [(float(i % 7 == 0), k) for i, k in enumerate(keys)]
    data = spark.createDataFrame(rows, "label double, key string").repartition(5)
    found = [tuple(r) for r in delay_model.mark_test(data, share, bound).collect()]
    want = []
    for label in (0.0, 1.0):
        own = sorted(k for x, k in rows if x == label)
        want += [(label, k, i < int(len(own) * share)) for i, k in enumerate(own)]
    assert sorted(found) == sorted(want)


def test_split_of_no_rows(spark):
    none = spark.createDataFrame([], "label double, key string")
    assert delay_model.mark_test(none).columns == ["label", "key", "is_test"]


def test_fit_rows_are_bounded(trained):
    train, _, _ = trained
    total = train.count()
    assert delay_model.fit_rows(train).count() == total
    assert delay_model.fit_rows(train, 300).count() == pytest.approx(300, abs=90)


def test_running_sums_over_ranges(spark):
    df = spark.range(1000).select((F.col("id") * 7919 % 1000).alias("x"), F.lit(2).alias("n"))
    found = running_sums(df.repartition(8), [F.col("x").desc()], ["n"]).collect()
    assert all(r.n_so_far == 2 * (1000 - r.x) for r in found)


def test_weights_balance_the_classes(trained):
    totals = delay_model.balanced(trained[0]).groupBy("label").agg(F.sum("weight"))
    (_, a), (_, b) = rows_of(totals)
    assert a == pytest.approx(b)


def test_evaluation_is_consistent(trained):
    _, test, model = trained
    scored = delay_model.score(model, test)
    cells = {(r.label, r.prediction): r["count"] for r in delay_model.confusion_matrix(scored).collect()}
    assert sum(cells.values()) == test.count()
    (row,) = delay_model.metrics(scored).collect()
    assert row.accuracy == pytest.approx((cells[0, 0] + cells[1, 1]) / sum(cells.values()))
    assert row.recall == pytest.approx(cells[1, 1] / (cells[1, 0] + cells[1, 1]))
    assert 0.5 < row.roc_auc < 1.0
    curve = delay_model.roc_curve(scored).orderBy(F.desc("threshold")).collect()
    assert (curve[-1].false_positive_rate, curve[-1].true_positive_rate) == (1.0, 1.0)


def test_area_under_known_scores(spark):
    rows = [(1.0, 0.9), (0.0, 0.8), (1.0, 0.7), (0.0, 0.1)]
    scored = spark.createDataFrame(rows, "label double, probability double")
    (area,) = delay_model.area_under(scored).first()
    assert area == pytest.approx(0.75)


def test_importances(spark, trained):
    _, test, model = trained
    gini = delay_model.feature_importance(spark, model).collect()
    assert len(gini) == 16 and sum(r.importance for r in gini) == pytest.approx(1.0)
    shuffled = delay_model.permutation_importance(
        delay_model.forest_scorer(model), test
    ).collect()
    assert {r.feature for r in shuffled} == {r.feature for r in gini}
