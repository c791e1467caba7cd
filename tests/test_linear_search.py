import numpy as np
import pandas as pd
import pytest

from voltide.operators import linear_search, models, search
from voltide.operators.metrics import search_comparison


@pytest.fixture(scope="module")
def folds(spark):
    rng = np.random.default_rng(3)
    n = 600
    x = rng.normal(size=(n, 4))
    x[:, 1] = x[:, 0] + 0.1 * x[:, 1]
    y = 0.4 * x[:, 0] - 0.2 * x[:, 2] + 0.3 * rng.normal(size=n)
    pdf = pd.DataFrame(x, columns=list("abcd")).assign(y=y, series_id="s", date=pd.date_range("2000-01-01", periods=n).date)
    pdf["constant"] = 2.0
    pdf.loc[::50, "c"] = np.nan
    pdf.loc[::70, "y"] = np.nan
    parts = []
    for fold, (train, test) in enumerate([(300, 400), (400, 500), (500, 600)]):
        parts += [pdf[:train].assign(fold=fold, role="train"), pdf[train:test].assign(fold=fold, role="test")]
    return spark.createDataFrame(pd.concat(parts)).cache()


X = ["a", "b", "c", "d", "constant"]


def test_sums_give_the_scores_of_refitting(folds):
    quick = linear_search.LinearValidator(folds, X, "y", n_splits=3)
    for params in ({"alpha": 0.01, "l1_ratio": 0.5}, {"alpha": 0.1, "l1_ratio": 1.0}, {"alpha": 0.001, "l1_ratio": 0.3}):
        slow = search.CrossValidator(folds, X, "y", models.elastic_net, n_splits=3)
        assert quick.score("q", [params])[0] == pytest.approx(slow.score("s", [params])[0], abs=1e-6)


def test_ridge_equals_normal_equations(folds):
    quick = linear_search.LinearValidator(folds, X, "y", n_splits=3)
    gram = quick.train[0]
    n, centre = gram[0, 0], gram[0, 1:-1] / gram[0, 0]
    xx = gram[1:-1, 1:-1] / n - np.outer(centre, centre)
    xy = gram[1:-1, -1] / n - centre * gram[0, -1] / n
    want = np.linalg.solve(xx + 0.2 * np.eye(len(xy)), xy)
    got = linear_search.elastic_net_paths([gram], np.array([0.2]), np.array([0.0]))[0, 0]
    assert np.allclose(got[1:], want, atol=1e-6)


def test_all_searches_at_full_size(folds):
    cv = linear_search.LinearValidator(folds, X, "y", n_splits=3)
    search.grid_search(cv, linear_search.LINEAR_GRID)
    for run in (search.random_search, search.bayesian_search, search.genetic_search):
        run(cv, linear_search.LINEAR_SPACE)
    table = search_comparison(cv.trial_table(), cv.untuned()).collect()
    assert {r["method"]: r["n_evaluations"] for r in table} == {
        "Grid Search": 27, "Random Search": 50, "Bayesian": 100, "Genetic": 30 * 16,
    }
    assert all(r["improvement"] >= -1e-3 for r in table)
    assert cv.fresh().trials == []


def test_fold_without_rows_is_refused(folds):
    with pytest.raises(ValueError):
        linear_search.LinearValidator(folds, X, "y", n_splits=4)


def test_stages_of_one_boosted_fit(folds):
    def make(trees, depth):
        return models.boosting("regression", trees, depth, rate=0.1)

    batch = [{"trees": t, "depth": 2} for t in (2, 5)]
    one = search.CrossValidator(folds, X, "y", make, n_splits=1, staged="trees")
    each = search.CrossValidator(folds, X, "y", make, n_splits=1)
    assert one.score("m", batch) == pytest.approx(each.score("m", batch), abs=1e-9)
    assert [t[1] for t in one.trials] == [0, 1]
