"""The registered model queries run the original's whole search."""

import pytest

from conftest import SF001
from riskspark.operators import train
from riskspark.plans import model_queries, modeling


class Asked(Exception):
    pass


@pytest.mark.parametrize("query", sorted(model_queries.MODEL_QUERIES))
def test_queries_ask_for_the_whole_search(spark, monkeypatch, query):
    """50 trials x 5 folds over the original's ranges: no parameter set of the query's own."""
    def asked(tables, budget):
        raise Asked(budget.n_trials, budget.n_folds, budget.space)
    monkeypatch.setattr(modeling, "fit_models", asked)
    with pytest.raises(Asked) as got:
        model_queries.MODEL_QUERIES[query](spark, SF001)
    assert got.value.args == (50, 5, train.SEARCH_SPACE)
    assert dict((s[0], s[1:3]) for s in train.SEARCH_SPACE)["n_estimators"] == (100, 1000)
