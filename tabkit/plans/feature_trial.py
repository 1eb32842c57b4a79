"""Trial of engineered features: does a model with pairwise features beat the one in production, and is it robust?"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame

from tabkit.columns import numeric_cols, string_cols
from tabkit.operators import features as E
from tabkit.operators import metrics as X
from tabkit.operators import models as L
from tabkit.operators import outliers as O
from tabkit.operators import validity as V
from tabkit.operators.splits import split_by_key
from tabkit.runtime import settle

# Share of test rows, outlier bound, tolerance, size and number of perturbations, confidence.
TEST_SHARE, OUTLIER_WIDTH, TOLERANCE = 0.2, 3.0, 0.01
NOISE, TRIALS, CONFIDENCE = 1.2, 50, 0.95
CHAMPION, CHALLENGERS = "production", ("max", "product")


def clean(df: DataFrame, key: str, label: str) -> DataFrame:
    """Complete rows without outliers, text columns replaced by their codes, stored for the steps that follow."""
    df = V.drop_null_rows(df)
    df = O.outliers_zscore(df, numeric_cols(df, [key, label]), OUTLIER_WIDTH, TOLERANCE)
    text = string_cols(df, [key, label])
    return settle(E.label_encode(df, text).drop(*text), "clean")


def split_and_scale(df: DataFrame, key: str, label: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Training and test part, both scaled by the ranges of the training part, and those ranges."""
    train, test = split_by_key(df, key, 1 - TEST_SHARE)
    params = E.fit_minmax(train, numeric_cols(train, [key, label]))
    return E.apply_minmax(train, params), E.apply_minmax(test, params), params


def with_features(df: DataFrame, cols: Sequence[str], kind: str) -> DataFrame:
    """Add the pairwise features of one kind; production has none."""
    if kind == CHAMPION:
        return df
    return E.pairwise(df, cols, kind, name={"max": "max_{a}_{b}", "product": "{a}*{b}"}[kind])


def compare(train: DataFrame, key: str, label: str) -> DataFrame:
    """Accuracy of every feature set on held-out training rows."""
    base = numeric_cols(train, [key, label])
    board = None
    for kind in (CHAMPION, *CHALLENGERS):
        df = with_features(train, base, kind)
        fit, validate = split_by_key(df, key, 1 - TEST_SHARE, salt="validate")
        contestant = {kind: L.make_pipeline("logreg", numeric_cols(df, [key, label]), label)}
        rows = L.leaderboard(fit, validate, contestant, label, ["accuracy"])
        board = rows if board is None else board.unionByName(rows)
    return board


def robustness(train: DataFrame, test: DataFrame, key: str, label: str, kind: str, trials: int = TRIALS) -> DataFrame:
    """Mean accuracy of one feature set on perturbed test rows, with its confidence interval."""
    base = numeric_cols(train, [key, label])
    wide = with_features(train, base, kind)
    cols = numeric_cols(wide, [key, label])
    model = L.make_pipeline("logreg", cols, label).fit(wide)
    scores = L.perturbation_scores(model, with_features(test, base, kind), cols, label, key, NOISE, trials)
    return X.score_interval(scores, "accuracy", CONFIDENCE)


def run(df: DataFrame, key: str, label: str, trials: int = TRIALS) -> dict[str, DataFrame]:
    """The whole trial: ``params``, ``leaderboard``, ``decision`` and, if a challenger is promoted, its ``robustness``."""
    train, test, params = split_and_scale(clean(df, key, label), key, label)
    board = compare(train, key, label)
    decision = X.promote_decision(board, CHAMPION, CHALLENGERS, tolerance=TOLERANCE)
    results = {"params": params, "leaderboard": board, "decision": decision}
    chosen = decision.first()["decision"]
    if chosen != "do_nothing":
        results["robustness"] = robustness(train, test, key, label, chosen, trials)
    return results
