"""Small literal frames for the choices made where a rule could be read in two ways."""

import math
import random

import pytest
from pyspark.sql import functions as F

from tabkit.columns import ref
from tabkit.functions import draws, numbers, text
from tabkit.operators import features as E
from tabkit.operators import html as H
from tabkit.operators import joins as J
from tabkit.operators import metrics as X
from tabkit.operators import missing as M
from tabkit.operators import outliers as O
from tabkit.operators import projection as P
from tabkit.operators import splits
from tabkit.operators import stats as S
from tabkit.operators import validity as V
from tabkit.operators.neighbours import knn_classify, nearest
from tabkit.operators.transformers import PairwiseProduct, Square
from tabkit.runtime import scratch, scratch_path, settle
from tabkit.sources.readers import read_csv, read_parquet, read_table
from tabkit.sources.staging import run_step, stage
from tabkit.sources.writers import write_csv, write_parquet

CELLS = ["5", "5.", ".5", ".", "", "-3", "+3", "1e5", "1E-5", " 4 ", "3 4", "1.2.3", "nan", "-inf", "Infinity", "abc", "1_000",
         "_1", "1__0", "1.5f", "0x1p3", "5\n", "\t7", "1d", "e5", "1e", None]


def values(df, col):
    return sorted((r[0] for r in df.select(ref(col)).collect()), key=str)


def reads_as_number(cell):
    try:
        float(cell)
        return True
    except (TypeError, ValueError):
        return cell is None


def test_lenient_cells_are_those_python_reads(spark):
    df = spark.createDataFrame([(c,) for c in CELLS], "c string")
    assert values(V.valid_rows_parse(df), "c") == sorted(filter(reads_as_number, CELLS), key=str)


def test_lenient_cells_at_random(spark):
    rnd = random.Random(11)
    cells = ["".join(rnd.choice("0123456789.eE+-_ nanif\t") for _ in range(rnd.randint(0, 6))) for _ in range(4000)]
    df = spark.createDataFrame([(c,) for c in cells], "c string")
    assert values(V.valid_rows_parse(df), "c") == sorted(filter(reads_as_number, cells), key=str)


def test_strict_cells_are_digits_with_one_dot(spark):
    def strict(c):
        return c is None or (" " not in c and c.replace(".", "", 1).isdigit())
    df = spark.createDataFrame([(c,) for c in CELLS], "c string")
    assert values(V.valid_rows_pattern(df), "c") == sorted(filter(strict, CELLS), key=str)


def test_threshold_rounds_up(spark):
    df = spark.createDataFrame([(1, 1, None), (1, None, None), (1, 1, 1)], "a int, b int, c int")
    assert V.drop_rows_thresh(df, 1.2).count() == 2
    assert V.drop_rows_thresh(df, 2).count() == 2
    assert V.drop_rows_thresh(df, 3).count() == 1


def test_mode_ignores_null_and_takes_the_smallest(spark):
    df = spark.createDataFrame([(None, "b"), (None, "a"), (None, "b"), (2, "a"), (1, None)], "n int, s string")
    assert M.modes(df, ["n", "s"]) == {"n": 1, "s": "a"}
    empty = spark.createDataFrame([(None,)], "n int")
    assert M.modes(empty, ["n"]) == {"n": None}
    assert M.impute_mode(empty, ["n"]).first()[0] is None


def test_nan_is_missing_everywhere(spark, tmp_path):
    df = spark.createDataFrame([(1.0, "x"), (math.nan, " NaN "), (None, None)], "d double, s string")
    clean = M.nan_to_null(df, text=True)
    assert values(clean, "d") == [1.0, None, None] and values(clean, "s") == [None, None, "x"]
    assert M.means(M.nan_to_null(df), {"d": F.col("d")}) == {"d": 1.0}
    path = str(tmp_path / "in.csv")
    with open(path, "w") as out:
        out.write("a,b\n1.5,x\nNaN,y\n")
    assert values(read_csv(spark, path, "a double, b string"), "a") == [1.5, None]


def test_band_lookup_keeps_rows_outside_all_bands(spark):
    df = spark.createDataFrame([(10,), (18,), (24,), (70,), (None,)], "age int")
    bands = spark.createDataFrame([(18, 24, 0.1), (65, None, 0.2)], "lo int, hi int, prob double")
    left = {r["age"]: r["prob"] for r in J.join_band(df, bands, "age").collect()}
    assert left == {10: None, 18: 0.1, 24: 0.1, 70: 0.2, None: None}
    assert J.join_band(df, bands, "age", "inner").count() == 3
    assert not J.bands_overlap(bands)
    assert J.bands_overlap(bands.unionByName(spark.createDataFrame([(20, 30, 0.3)], bands.schema)))


def test_rates_fill_only_gaps(spark):
    df = spark.createDataFrame([(i, 20, 1, None if i % 2 else 1) for i in range(200)], "id int, age int, sex int, smoke int")
    sure = spark.createDataFrame([(0, 99, 1.0)], "lo int, hi int, prob double")
    never = spark.createDataFrame([(0, 0, 99, 1.0), (1, 0, 99, 0.0)], "grp int, lo int, hi int, prob double")
    assert M.impute_by_rate(df, "smoke", "id", "age", "sex", sure, never).filter("smoke = 1").count() == 200
    none = sure.withColumn("prob", F.lit(0.0))
    filled = M.impute_by_rate(df, "smoke", "id", "age", "sex", none, never)
    assert filled.columns == df.columns
    assert filled.filter("smoke = 0").count() == 100 and filled.filter("id % 2 = 0 AND smoke = 1").count() == 100


def test_column_without_spread_is_skipped(spark):
    df = spark.createDataFrame([(5.0, float(i)) for i in range(20)] + [(5.0, 1000.0)], "a double, b double")
    assert O.outliers_zscore(df, ["a", "b"]).count() == 20
    assert O.outliers_sequential(df, ["a", "b"]).count() == 20
    assert O.outliers_onepass(df, ["a"]).count() == 21


def test_sequential_outliers_use_the_rows_still_there(spark):
    rows = [(float(i % 3), float(i % 5)) for i in range(60)] + [(500.0, 900.0), (1.0, 60.0)]
    df = spark.createDataFrame(rows, "a double, b double")
    assert O.outliers_sequential(df, ["a", "b"]).count() == 60
    assert O.outliers_onepass(df, ["a", "b"]).count() == 61


def test_clamp_and_replace(spark):
    df = spark.createDataFrame([(0,), (1,), (22,), (None,)], "f int")
    assert values(M.clamp_flag(df, ["f"]), "f") == [0, 0, 0, 1]
    x = spark.createDataFrame([(5.0,), (1.0,), (3.0,), (None,)], "x double")
    mean = values(M.replace_out_of_range(x, "x", F.col("x") >= 4, "mean"), "x")
    assert mean == pytest.approx([1.0, 7 / 3, 3.0, 3.0])
    assert values(M.replace_out_of_range(x, "x", F.col("x") >= 4, 1.5), "x") == pytest.approx([1.0, 1.5, 11 / 6, 3.0])


def test_dedup_keeps_the_first(spark):
    df = spark.createDataFrame([("a", 2, None), ("a", 1, "x"), ("b", 3, "y")], "k string, o int, v string")
    assert sorted(map(tuple, V.dedup_first(df, ["k"], ["o"]).collect())) == [("a", 1, "x"), ("b", 3, "y")]


def test_names_with_brackets(spark):
    df = spark.createDataFrame([(1, None, 2.0)], "`day(of` int, `a.b` string, x double")
    assert P.drop_columns(df, ["day(of"]).columns == ["a.b", "x"]
    assert [tuple(r) for r in M.missing_counts(df).collect()] == [("day(of", 0), ("a.b", 1), ("x", 0)]


def test_scaling_of_test_rows_and_constant_columns(spark):
    train = spark.createDataFrame([(0.0, 7.0), (10.0, 7.0)], "a double, b double")
    params = E.fit_minmax(train, ["a", "b"])
    assert {r["name"]: r["scale"] for r in params.collect()} == {"a": 0.1, "b": 1.0}
    test = spark.createDataFrame([(20.0, 8.0)], "a double, b double")
    assert tuple(E.apply_minmax(test, params).first()) == (2.0, 1.0)


def test_one_hot_of_null_is_all_zero(spark):
    df = spark.createDataFrame([(1, "x"), (2, None), (3, "y")], "id int, c string")
    assert sorted(map(tuple, E.one_hot(df, "c").collect())) == [(1, 1, 0), (2, 0, 0), (3, 0, 1)]


def test_pairwise_max_skips_null_and_products_do_not_overflow(spark):
    df = spark.createDataFrame([(2_000_000_000, None), (2_000_000_000, 2_000_000_000)], "a int, b int")
    assert values(E.pairwise(df, ["a", "b"], "max", name="m"), "m") == [2_000_000_000] * 2
    assert values(E.pairwise(df, ["a", "b"], name="p"), "p") == [4e18, None]


def test_promotion(spark):
    def decide(champion, m, p):
        rows = [("production", "accuracy", champion), ("max", "accuracy", m), ("product", "accuracy", p), ("max", "auc", 9.0)]
        board = spark.createDataFrame(rows, "model string, metric string, value double")
        return X.promote_decision(board, "production", ["max", "product"]).first()["decision"]
    assert decide(0.9, 0.8, 0.85) == "do_nothing"
    assert decide(0.9, 0.895, 0.85) == "max"
    assert decide(0.9, 0.92, 0.92) == "product"


def test_best_compares_one_metric_and_takes_the_first_on_ties(spark):
    rows = [(0, "a", "auc", 0.7), (1, "b", "auc", 0.9), (2, "c", "auc", 0.9), (3, "d", "accuracy", 0.99)]
    board = spark.createDataFrame(rows, "place int, model string, metric string, value double")
    assert X.select_best(board, "auc", "place").first()["model"] == "b"


def test_report_without_predictions_of_a_class(spark):
    df = spark.createDataFrame([(0, 0), (1, 0)], "y int, p int")
    rows = {r["label"]: r for r in X.classification_report(df, "y", "p").collect()}
    assert rows["1"]["precision"] == 0.0 and rows["1"]["f1"] == 0.0 and rows["accuracy"]["f1"] == 0.5
    cells = {(r["actual"], r["predicted"]): r["count"] for r in X.confusion_matrix(df, "y", "p").collect()}
    assert cells == {(0, 0): 1, (0, 1): 0, (1, 0): 1, (1, 1): 0}


def test_step_may_replace_a_table_it_reads(spark):
    stage(spark.createDataFrame([(1,), (2,)], "a int"), "step_in")

    def double(tables):
        return {"step_in": tables["step_in"].selectExpr("a * 2 AS a")}, {"rows": 2}

    assert run_step(spark, double, ["step_in"], ["step_in"], drop=["step_in"]) == {"rows": 2}
    assert values(spark.table("step_in"), "a") == [2, 4]
    assert run_step(spark, lambda t: ({}, {}), ["step_in"], [], drop=["step_in"]) == {}
    assert not spark.catalog.tableExists("step_in")


def test_text_functions(spark):
    df = spark.createDataFrame([("men (13.1%) and 5%",), ("adults aged 25–44 years (12.6%)",), ("none",)], "t string")
    rows = df.select(text.extract_percentage(F.col("t")), text.extract_age_range(F.col("t")), text.extract_numbers(F.col("t"))).collect()
    assert [r[0] for r in rows] == [13.1, 12.6, None]
    assert [r[1] and tuple(r[1]) for r in rows] == [None, (25, 44), None]
    assert [r[2] for r in rows] == [[13, 1, 5], [25, 44, 12, 6], []]


def test_table_rows(spark):
    page = ("<table><tr><td>no</td></tr></table><table><thead><tr><th>Age</th><th>2022 (%)</th></tr></thead>"
            "<tr><td>18–24</td><td>8.3 </td></tr><tr><td>All &amp;<br>more</td></tr></table>")
    rows = H.html_table_rows(spark.createDataFrame([(1, page)], "id int, html string"), "html").collect()
    assert [(r["is_header"], r["cells"]) for r in rows] == [
        (True, ["Age", "2022 (%)"]), (False, ["18–24", "8.3"]), (False, ["All &more", "150"])]


def test_word_count_keeps_case_and_empty_words(spark):
    df = spark.createDataFrame([("The the, the  'the",), ("THE !",)], "line string")
    assert {tuple(r) for r in S.word_count(df, "line", min_count=2).collect()} == {("the", 3), ("", 2)}


def test_labels_outside_the_list(spark):
    df = spark.createDataFrame([(0,), (1,), (7,), (8,), (None,)], "d int")
    assert [r[0] for r in df.select(numbers.code_to_label(F.col("d"))).collect()] == [None, "Monday", "Sunday", None, None]


def test_draws_are_uniform_and_independent(spark):
    df = spark.range(20000).select(draws.uniform_by_key(F.col("id"), 1).alias("a"), draws.uniform_by_key(F.col("id"), 2).alias("b"),
                                   draws.normal_by_key(F.col("id"), 1.2).alias("n"))
    row = df.agg(F.avg("a"), F.stddev("a"), F.corr("a", "b"), F.avg("n"), F.stddev("n"), F.min("a"), F.max("a")).first()
    assert row[0] == pytest.approx(0.5, abs=0.01) and row[1] == pytest.approx(12 ** -0.5, abs=0.01)
    assert abs(row[2]) < 0.03 and abs(row[3]) < 0.04 and row[4] == pytest.approx(1.2, abs=0.03)
    assert 0 <= row[5] and row[6] < 1


def test_pages_without_end_tags(spark):
    page = ("<table><tr><th>A<th>B<tr><td>1<td>x<table><tr><td>in</table>y<tr><th>h<td>v</table><ul><li>menu<li>home</ul>"
            "<div class='a cont'>t<ul><li>one &#8211; x<li>two</ul><ol><li>three</ol></div><div class=cont><ul><li>five</div><li>six")
    df = spark.createDataFrame([(1, page)], "id int, html string")
    rows = [(r["is_header"], r["cells"]) for r in H.html_table_rows(df, "html", 0).collect()]
    assert rows == [(True, ["A", "B"]), (False, ["1", "xiny"]), (False, ["h", "v"])]
    assert [r["cells"] for r in H.html_table_rows(df, "html", 1).collect()] == [["in", "150"]]

    def items(**chosen):
        return [r["item"] for r in H.html_list_items(df, "html", **chosen).collect()]

    assert items() == ["menu", "home", "one – x", "two", "three", "five", "six"]
    assert items(container="cont") == ["one – x", "two", "three"] and items(container="cont", n=1) == ["five"]
    assert items(list_no=0) == ["menu", "home"] and items(container="cont", list_no=1) == ["three"]


def test_filters_pass_the_readers(spark):
    """Columnar reads leave filters to the files, in staged steps too; NaN does not get into what the package writes."""
    df = spark.range(100).selectExpr("id", "CASE WHEN id % 3 = 0 THEN double('NaN') ELSE double(id) END AS x")
    path = write_parquet(df, scratch_path(spark, "pushdown"))
    assert read_parquet(spark, path).where("x IS NULL").count() == 34
    stage(df, "pushed_table")
    plans = []

    def step(tables):
        plans.append(tables["pushed_table"].where("x > 49")._jdf.queryExecution().executedPlan().toString())
        return {"pushed_result": tables["pushed_table"]}, {}

    run_step(spark, step, ["pushed_table"], ["pushed_result"], drop=["pushed_table"])
    plans += [x.where("x > 49")._jdf.queryExecution().executedPlan().toString() for x in (read_parquet(spark, path), read_table(spark, "pushed_result"))]
    spark.sql("DROP TABLE pushed_result")
    assert len(plans) == 3 and all("GreaterThan(x,49.0)" in p for p in plans)


def test_words_for_nan_in_text(spark):
    path = write_csv(spark.createDataFrame([("NaN", 1), (" nan ", 2), ("nanny", 3)], "a string, b int"), scratch_path(spark, "nan"))
    assert [r["a"] for r in read_csv(spark, path, "a string, b int").orderBy("b").collect()] == [None, None, "nanny"]


def test_rates_keep_columns_and_refuse_overlaps(spark):
    df = spark.createDataFrame([(1, 30, 0, None, 5, "x", 7)], "id int, age int, sex int, smoke int, lo int, hi string, grp int")
    bands = spark.createDataFrame([(0, 40, 1.0), (41, None, 0.0), (9, 5, 0.5)], "lo int, hi int, prob double")
    by_sex = spark.createDataFrame([(0, 0, 40, 1.0), (1, 0, 40, 0.0)], "grp int, lo int, hi int, prob double")
    row = M.impute_by_rate(df, "smoke", "id", "age", "sex", bands, by_sex).first()
    assert (row["smoke"], row["lo"], row["hi"], row["grp"]) == (1, 5, "x", 7)
    for lo, hi in ((35, 50), (0, 5), (40, 40), (-5, None)):
        with pytest.raises(ValueError):
            M.impute_by_rate(df, "smoke", "id", "age", "sex", bands.unionByName(spark.createDataFrame([(lo, hi, 0.1)], "lo int, hi int, prob double")), by_sex)


def test_overlaps(spark):
    for bands, want in (([(0, 10), (5, 20), (40, 30)], True), ([(0, 10), (11, 20), (40, 30)], False), ([(0, 10), (0, 10)], True), ([(3, None), (0, 2)], False),
                        ([(0, None), (9, 9)], True), ([], False)):
        assert J.bands_overlap(spark.createDataFrame(bands, "lo int, hi int")) == want
    grouped = spark.createDataFrame([(1, 0, 5), (2, 3, 8), (2, 9, None)], "g int, lo int, hi int")
    assert J.bands_overlap(grouped) and not J.bands_overlap(grouped, "g")


def test_band_join_refuses_clashes(spark):
    df = spark.createDataFrame([(1, 2)], "lo int, x int")
    with pytest.raises(ValueError):
        J.join_band(df, spark.createDataFrame([(0, 5)], "lo int, hi int"), "x")


@pytest.mark.parametrize("per_slice", [3, 10 ** 6])
def test_auc_of_special_scores(spark, monkeypatch, per_slice):
    """NaN counts as the highest score, above infinity, whatever the number of slices."""
    monkeypatch.setattr(X, "SCORES_PER_SLICE", per_slice)
    scores = [float("nan"), float("inf"), float("-inf"), 0.0, -0.0, 1.0, None, float("inf"), float("inf"), float("nan"), 2.0, 3.0]
    rows = [(i % 3 % 2, s) for i, s in enumerate(scores)]
    key = lambda s: (1, 0.0) if s != s else (0, s)
    pos, neg = ([key(s) for y, s in rows if y == v and s is not None] for v in (1, 0))
    want = sum((p > n) + 0.5 * (p == n) for p in pos for n in neg) / (len(pos) * len(neg))
    assert X.auc_roc(spark.createDataFrame(rows, "y int, s double"), "y", "s").first()[0] == pytest.approx(want)


def test_stratified_split_needs_keys(spark):
    with pytest.raises(ValueError):
        splits.split_stratified(spark.createDataFrame([(None, "a"), (1, "a")], "id int, y string"), "id", "y", 0.5)


def test_neighbours_of_two_tables(spark):
    base = spark.createDataFrame([(1, [0.0], "near"), (2, [10.0], "far"), (3, [float("inf")], "gone")], "id int, vec array<double>, label string")
    queries = spark.createDataFrame([(1, [0.1]), (7, [9.0])], "id int, vec array<double>")
    assert {r["id"]: r["prediction"] for r in knn_classify(base, queries, 1).collect()} == {1: "near", 7: "far"}
    assert nearest(base, queries, 3).count() == 6
    flat = spark.createDataFrame([(1, [0.0, 0.0], 0)], "id int, vec array<double>, label int")
    assert nearest(flat, flat.selectExpr("id + 1 AS id", "array(1.0D, 2.0D) AS vec"), 1, 3).first()["distance"] == pytest.approx(9 ** (1 / 3))
    with pytest.raises(ValueError):
        nearest(base, queries, 1, 0.5)


def test_named_outputs_and_saved_stages(spark):
    df = spark.createDataFrame([(2.0, 3.0)], "a double, b double")
    stage_ = PairwiseProduct(inputCols=["a", "b"], outputCols=["ab"])
    path = scratch_path(spark, "stage")
    stage_.write().save(path)
    assert PairwiseProduct.load(path).transform(df).first()["ab"] == 6.0
    assert Square(inputCols=["a"], outputCols=["aa"]).transform(df).first()["aa"] == 4.0
    assert Square(inputCols=["a"]).transform(df).columns == ["a", "b", "a_square"]


def test_scratch_deletes_what_was_stored(spark):
    with scratch(spark) as path:
        kept = settle(spark.range(5))
        assert kept.count() == 5 and kept.inputFiles()[0].split(":")[-1].lstrip("/").startswith(path.split(":")[-1].lstrip("/"))
    with pytest.raises(Exception, match="(?i)not.*exist|PATH_NOT_FOUND"):
        spark.read.parquet(path)
    assert not scratch_path(spark, "x").startswith(path)


def test_columns_without_spread(spark):
    assert O.without_spread(spark.createDataFrame([(1.0, 2.0), (1.0, 3.0)], "a double, b double"), ["a", "b"]) == ["a"]
