"""Train, score and judge lap-time models; compare predictions per driver."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pitlane.operators import learning, statistics
from pitlane.operators.quantiles import iqr_filter
from pitlane.operators.shaping import drop_missing, melt, of_drivers


def evaluate(
    dataset: DataFrame,
    features: list[str],
    label: str,
    keys: list[str],
    text: list[str],
    group: str = "Track",
    seed: int = 1221,
    **params,
) -> DataFrame:
    """MSE and R2 per track of a boosted and a linear model trained on 80 % of the laps.

    Rows are split by their keys as they are given; text features are encoded and all
    features scaled over both parts; the whole season is scored.
    """
    # The needed columns are stored, as several passes look for the cut and the values to encode.
    columns = dict.fromkeys([*keys, *features, label, group])
    rows = learning.train_test_split(learning.stored(dataset.select(*columns), "season"), keys, 0.2, seed)
    ready = learning.numeric(learning.label_encode(rows, text), features)
    # Stored, as both fits and the scores, which are read later, go over the same rows.
    parts = learning.stored(statistics.standard_scale(ready, features), "parts")
    train = parts.where(F.col("Part") == "train")
    boosted = learning.boosted(train, features, label, **params)
    linear = learning.linear(train, features, label)
    scored = linear.score(boosted.score(parts, "Boosted"), "Linear")
    return statistics.regression_metrics(
        scored, label, {"Boosted": "Boosted", "Linear": "Linear"}, [group]
    )


def lap_curve(scored: DataFrame, actual: str, predictions: list[str]) -> DataFrame:
    """Mean actual and predicted time per lap number without outlying laps, in long form."""
    means = statistics.column_means(scored, [actual, *predictions], ["LapNumber"])
    clean = iqr_filter(means, actual, [actual, *predictions])
    return melt(clean, ["LapNumber"], [actual, *predictions], "Type", "Seconds")


def compare_drivers(
    laps: DataFrame,
    models: dict[str, learning.Fitted],
    drivers: list[str],
    features: list[str],
    actual: str = "LapTime_s",
) -> DataFrame:
    """Actual and predicted lap times of some drivers, per lap, in long form."""
    known = drop_missing(laps, [actual, *features, "LapNumber", "Driver"])
    scored = learning.numeric(of_drivers(known, drivers), features)
    for name, model in models.items():
        scored = model.score(scored, name)
    columns = [actual, *models]
    means = statistics.column_means(scored, columns, ["LapNumber", "Driver"])
    return melt(means, ["LapNumber", "Driver"], columns, "Type", "Seconds")
