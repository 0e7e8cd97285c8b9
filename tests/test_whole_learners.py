"""The registered learner queries train what the catalog names."""

import inspect

import pytest

from checks import queries
from faremill.operators import learners
from faremill.plans import training


class Asked(Exception):
    pass


def asked(monkeypatch, name, query):
    """The arguments with which a query calls a function of the training plan."""
    signature = inspect.signature(getattr(training, name))

    def stop(*args, **settings):
        given = signature.bind(*args, **settings)
        given.apply_defaults()
        raise Asked(given.arguments)

    monkeypatch.setattr(training, name, stop)
    for helper in ("_train", "_held_out", "_preprocessor", "obt_rows", "new_folder"):
        monkeypatch.setattr(queries, helper, lambda *_: None)
    with pytest.raises(Asked) as found:
        queries.REGISTERED[query](None, "")
    return found.value.args[0]


@pytest.mark.parametrize("name", ["catboost", "gradient_boosting", "hist_gradient_boosting", "voting", "xgboost"])
def test_learners_train_all_their_trees(monkeypatch, name):
    assert asked(monkeypatch, "train", f"learner_{name}")["preset"] == learners.CATALOG[name]


def test_the_benchmark_runs_the_curated_presets(monkeypatch):
    assert list(asked(monkeypatch, "benchmark", "model_benchmark")["presets"]) == [learners.CATALOG[name] for name in learners.CURATED]


def test_the_production_model_has_all_its_trees(monkeypatch):
    assert asked(monkeypatch, "train_production", "production_model")["preset"] == learners.CATALOG[learners.PRODUCTION]
