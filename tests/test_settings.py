from datetime import date

import pytest

from faremill.settings import Settings


def test_ranges_follow_each_other(january):
    assert january.split_ranges == {
        "train": (date(2025, 1, 1), date(2025, 1, 21)),
        "validation": (date(2025, 1, 22), date(2025, 1, 27)),
        "test": (date(2025, 1, 28), date(2025, 1, 31)),
    }


@pytest.mark.parametrize(
    "env",
    [
        {"TRAIN_END_DATE": "2025-01-27"},
        {"VAL_END_DATE": "2025-01-31"},
        {"TRIP_TYPE": "blue"},
        {"TRAINING_BATCH_GRAIN": "day"},
        {"MODEL_TARGET": "total_amount"},
        {"EDA_SAMPLE_LIMIT": "0"},
        {"ENABLE_ZONE_LOOKUP": "perhaps"},
    ],
)
def test_bad_settings_are_refused(env):
    with pytest.raises(ValueError):
        Settings.from_env(env)


def test_environment_is_read():
    settings = Settings.from_env({"TRIP_TYPE": " Green,green ", "TRAINING_BATCH_GRAIN": "WEEK", "EDA_SAMPLE_SEED": ""})
    assert settings.fleets == ("green",)
    assert settings.grain == "week"
    assert settings.eda_sample_seed == 42
    assert Settings.from_env({}).fleets == ("yellow",)
