"""Trials of noise in batches, up to a stated width of the interval."""

import math
from statistics import NormalDist, pstdev

import pytest
from pyspark.sql import functions as F

from tabkit.operators import models as L


@pytest.fixture(scope="module")
def fitted(spark):
    df = spark.range(300).select("id", (F.col("id") % 2).cast("double").alias("x"), (F.col("id") % 2).cast("double").alias("label"))
    return L.make_pipeline("decision_tree", ["x"], "label", maxDepth=1).fit(df), df


def accuracies(frame):
    return {r["trial"]: round(r["accuracy"], 12) for r in frame.collect()}


def test_batches_end_at_the_first_interval_that_is_narrow_enough(fitted):
    model, df = fitted
    all_trials = accuracies(L.perturbation_scores(model, df, ["x"], "label", "id", 1.2, 24))
    assert sorted(all_trials) == list(range(1, 25))
    z = NormalDist().inv_cdf(0.95)
    widths = {n: 2 * z * pstdev([all_trials[t] for t in range(1, n + 1)]) / math.sqrt(n) for n in (6, 12, 18, 24)}
    for width in (1.0, (widths[6] + widths[18]) / 2, widths[24] * 1.000001, 1e-6):
        last = next((n for n, w in widths.items() if w <= width), 24)
        got = accuracies(L.perturbation_until(model, df, ["x"], "label", "id", width, 1.2, 0.9, batch=6, most=24))
        assert got == {t: all_trials[t] for t in range(1, last + 1)}


def test_the_last_batch_is_cut_at_the_most_trials(fitted):
    model, df = fitted
    assert L.perturbation_until(model, df, ["x"], "label", "id", 1e-9, batch=4, most=6).count() == 6


def test_an_empty_table_gives_no_trials(fitted):
    model, df = fitted
    assert L.perturbation_until(model, df.limit(0), ["x"], "label", "id", 0.1).count() == 0


def test_senseless_limits_are_refused(fitted):
    model, df = fitted
    for limits in ({"width": 0}, {"width": 0.1, "batch": 1}):
        with pytest.raises(ValueError):
            L.perturbation_until(model, df, ["x"], "label", "id", **limits)
