"""Patient records in two steps: clean text cells and fill gaps, then compare classifiers."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import Estimator
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabkit.columns import ref
from tabkit.operators import missing as M
from tabkit.operators import models as L
from tabkit.operators import projection as P
from tabkit.operators import validity as V
from tabkit.operators.splits import split_by_key
from tabkit.runtime import settle, spread

# The columns of a patient record.
RECORD = ("age", "sex", "painloc", "painexer", "cp", "trestbps", "smoke", "fbs", "prop", "nitr", "pro", "diuretic",
          "thaldur", "thalach", "exang", "oldpeak", "slope", "target")
FLAGS = ("fbs", "prop", "nitr", "pro", "diuretic")

# Least number of filled cells, and stand-ins for implausible measurements.
MIN_FILLED = 12
LOW_PRESSURE, PRESSURE = 100, 130
HIGH_DEPRESSION, DEPRESSION = 4, 1.5


def clean_initial(raw: DataFrame, key: str, cols: Sequence[str] = RECORD) -> DataFrame:
    """Text cells to numbers: rows with unreadable or too few cells go, a missing age becomes the most common one."""
    df = V.valid_rows_parse(P.project(raw, [key, *cols]), cols)
    df = settle(M.nan_to_null(P.cast_all(P.trim_strings(df), cols, "double")), "records")
    df = V.drop_rows_thresh(df, MIN_FILLED, cols)
    return M.impute_mode(df.withColumn("age", F.col("age").try_cast("int")), ["age"])


def fill_smoke(df: DataFrame, key: str, rates: DataFrame, sex_rates: DataFrame) -> DataFrame:
    """Missing smoking flags drawn from published rates by age, and by sex and age."""
    return M.impute_by_rate(df, "smoke", key, "age", "sex", rates, sex_rates)


def clean_advanced(df: DataFrame) -> DataFrame:
    """Fill or replace what is left, column by column; the statistics take one pass for all modes and one for all means.

    No rule looks at the smoking flag, so call this on the stored frame, before flags are drawn: a join would run again for
    each pass.
    """
    df = V.drop_null_subset(df, ["cp"])
    df = M.clamp_flag(M.impute_constant(df, {"painloc": 0.0, "painexer": 0.0, "exang": 0.0}), FLAGS)
    implausible = (F.col("oldpeak") >= HIGH_DEPRESSION) | (F.col("oldpeak") <= 0)
    df = P.case_replace(df, "oldpeak", [(implausible, DEPRESSION)])
    df = M.impute_constant(df, M.modes(df, ["trestbps", "slope"]) | M.means(df, {c: ref(c) for c in ("thaldur", "thalach", "oldpeak")}))
    return P.case_replace(df, "trestbps", [(F.col("trestbps") <= LOW_PRESSURE, PRESSURE)])


def searches(kinds: Sequence[str], label: str, grids: dict[str, dict[str, list]] = L.GRIDS, folds: int = 5) -> dict[str, Estimator]:
    """A grid search for each kind of model over all record columns."""
    features = [c for c in RECORD if c != label]
    return {kind: L.grid_search(L.make_pipeline(kind, features, label), grids[kind], label, folds) for kind in kinds}


def compare(df: DataFrame, key: str, kinds: Sequence[str] = ("random_forest", "logreg", "gbt", "decision_tree"),
            grids: dict[str, dict[str, list]] = L.GRIDS, folds: int = 5, ratio: float = 0.9, label: str = "target") -> DataFrame:
    """Leaderboard of grid searches on the same split, by area under the ROC curve."""
    train, test = split_by_key(L.with_folds(spread(settle(df, "cleaned")), key, folds), key, ratio)
    return L.leaderboard(train, test, searches(kinds, label, grids, folds), label)
