from __future__ import annotations

import math

from conftest import plan, rows
from pyspark.sql import functions as F

from smogline.operators import explore, profile
from smogline.operators.correlation import correlation_matrix
from smogline.schema import CORRELATED

TWO = {"x": "double", "y": "double"}


def matrix(df, columns):
    return {(r["row"], r["col"]): r["value"] for r in correlation_matrix(df, columns).collect()}


def test_correlation_uses_rows_where_both_are_known(table):
    df = table(TWO, (1.0, 2.0), (2.0, 4.0), (None, 9.0), (5.0, None))
    found = matrix(df, ["x", "y"])
    assert math.isclose(found["x", "y"], 1.0) and found["x", "y"] == found["y", "x"]
    assert math.isclose(found["x", "x"], 1.0)


def test_correlation_of_a_constant_is_unknown(table):
    df = table(TWO, (0.1, 2.0), (0.1, 4.0), (0.1, 9.0))
    found = matrix(df, ["x", "y"])
    assert found["x", "y"] is None and found["x", "x"] is None and math.isclose(found["y", "y"], 1.0)


def test_correlation_constant_only_where_both_are_known(table):
    df = table(TWO, (0.1, 2.0), (0.1, 4.0), (50.3, None), (7.7, None))
    assert matrix(df, ["x", "y"])["x", "y"] is None


def test_correlation_without_common_rows(table):
    df = table(TWO, (1.0, None), (None, 4.0), (2.0, None), (None, 1.0))
    found = matrix(df, ["x", "y"])
    assert len(found) == 4 and found["x", "y"] is None


def test_correlation_matches_the_built_in_with_a_large_offset(spark):
    df = spark.range(5000).select(
        (F.rand(1) + 1e6).alias("a"), F.rand(2).alias("b"), F.when(F.col("id") % 4 > 0, F.rand(3)).alias("c")
    ).withColumn("d", F.col("a") * 2 + F.col("b"))
    found = matrix(df, ["a", "b", "c", "d"])
    for x in "abcd":
        for y in "abcd":
            both = df.where(F.col(x).isNotNull() & F.col(y).isNotNull())
            assert abs(found[x, y] - both.agg(F.corr(x, y)).first()[0]) < 1e-9


def test_correlation_of_complete_rows_far_from_the_column_mean(spark):
    """Complete rows near 5e7, the rest of x and y near zero; and tiny values beside a huge mean."""
    far = spark.range(200_000).select(
        F.when(F.col("id") < 2000, F.rand(4) + 5e7).otherwise(F.rand(5)).alias("x"), F.rand(6).alias("z"), "id"
    )
    far = far.select("x", F.when(F.col("id") < 2000, F.col("x") + F.col("z")).alias("y"), "z")
    both = far.where("y is not null")
    found = matrix(far, ["x", "y", "z"])
    for a, b in ("xy", "yx", "xx", "yy", "yz", "zy"):
        assert abs(found[a, b] - both.agg(F.corr(a, b)).first()[0]) < 1e-6, (a, b)
    small = spark.range(1000).select(
        F.when(F.col("id") < 500, F.col("id") * 1e-9).otherwise(1e12).alias("x"), F.when(F.col("id") < 500, F.col("id") * 2.0).alias("y")
    )
    assert math.isclose(matrix(small, ["x", "y"])["x", "y"], 1.0)


def test_correlation_merges_patterns_and_leaves_out_what_is_not_finite(table):
    df = table({"x": "double", "y": "double", "z": "double"}, (1.0, 1.0, None), (2.0, 5.0, None), (7.0, 3.0, 1.0), (9.0, 4.0, float("nan")))
    found = matrix(df, ["x", "y", "z"])
    assert math.isclose(found["x", "y"], df.agg(F.corr("x", "y")).first()[0])
    assert found["x", "z"] is None and found["z", "z"] is None


def test_correlation_names_with_dots(table):
    df = table({"PM2.5": "double", "y": "double"}, (1.0, 1.0), (2.0, 0.0))
    assert math.isclose(matrix(df, ["PM2.5", "y"])["PM2.5", "y"], -1.0)


def test_histogram_closes_the_last_bin(table):
    df = table({"v": "double"}, (0.0,), (60.0,), (59.99,), (None,))
    counts = {r["bin"]: r["n"] for r in explore.histogram(df, "v").collect()}
    assert len(counts) == 60 and counts[0] == 1 and counts[59] == 2


def test_histogram_of_one_value(table):
    df = table({"v": "double"}, (3.0,), (3.0,))
    found = {r["bin"]: r for r in explore.histogram(df, "v").collect()}
    assert found[30]["n"] == 2 and found[0]["low"] == 2.5 and found[59]["high"] == 3.5


def test_histogram_follows_the_edges(table):
    """Values on computed edges belong to the bin that starts there."""
    step = (9.1 - 0.3) / 60
    df = table({"v": "double"}, *[(0.3 + k * step,) for k in range(60)], (9.1,))
    counts = {r["bin"]: r["n"] for r in explore.histogram(df, "v").collect()}
    assert counts == {k: 2 if k == 59 else 1 for k in range(60)}


def test_histogram_of_nothing(table):
    assert explore.histogram(table({"v": "double"}, (None,)), "v").count() == 0


def test_counts_add_up(cleaned):
    total = cleaned.count()
    assert explore.histogram(cleaned).agg(F.sum("n")).first()[0] == total
    assert explore.bucket_counts(cleaned).agg(F.sum("n")).first()[0] == total


def test_density_integrates_to_nearly_one(cleaned):
    points = explore.density(cleaned).orderBy("point").collect()
    width = points[1]["x"] - points[0]["x"]
    assert 0.9 < sum(p["density"] for p in points) * width < 1.0


def test_density_counts_equal_values_once(spark):
    """Different and repeated values take one path."""
    values = spark.range(400).select((F.col("id") * 1.37 % 91).alias("v"))
    doubled = values.union(values).union(values).union(values).union(values).union(values)
    single = {r["point"]: r["density"] for r in explore.density(values, "v", 20).collect()}
    merged = explore.density(doubled, "v", 20)
    assert "Generate" in plan(merged)
    numbers = [r["v"] for r in values.collect()]
    n, mean = len(numbers), sum(numbers) / len(numbers)
    width = 1.06 * math.sqrt(sum((v - mean) ** 2 for v in numbers) / n) * n ** -0.2
    low, high = min(numbers), max(numbers)
    for k, found in single.items():
        x = low + (high - low) * k / 19
        wanted = sum(math.exp(-0.5 * ((x - v) / width) ** 2) for v in numbers) / (n * width * math.sqrt(2 * math.pi))
        assert math.isclose(found, wanted, rel_tol=1e-9)


def test_one_scan_serves_histogram_density_and_axis(spark):
    read = spark.sparkContext.accumulator(0)

    def count(batches):
        for batch in batches:
            read.add(batch.num_rows)
            yield batch

    df = spark.range(1000).select((F.col("id") % 90 * 0.5).alias("v")).mapInArrow(count, "v double")
    counts = explore.value_counts(df, "v")
    shown = [f(df, "v", counts=counts).collect() for f in (explore.histogram, explore.density, explore.axis_range)]
    assert read.value == 1000 and sum(r["n"] for r in shown[0]) == 1000 and shown[2][0]["axis_high"] == 49.5
    assert explore.extent(counts)[:3] == (1000, 0.0, 44.5)
    assert math.isclose(explore.extent(counts).deviation, df.agg(F.stddev_pop("v")).first()[0])


def test_long_rows_hold_every_value(cleaned):
    bundle = explore.explore(cleaned)
    found = explore.long_rows(bundle).collect()
    sizes = {name: result.count() * len(explore.MEASURES[name][1]) for name, result in bundle.items()}
    assert len(found) == sum(sizes.values()) and len({(r["result"], r["key"], r["measure"]) for r in found}) == len(found)


def test_density_of_one_value(table):
    df = table({"v": "double"}, (3.0,), (3.0,))
    assert {r["density"] for r in explore.density(df, "v").collect()} == {None}


def test_smoothing_averages_what_the_edges_have(spark):
    df = spark.sql("SELECT make_date(2020, m, 1) AS Date, CAST(m AS DOUBLE) AS AQI FROM VALUES (1), (2), (3), (4) t(m)")
    found = explore.monthly_trend(df).orderBy("Month").collect()
    assert [r["smoothed_aqi"] for r in found] == [1.5, 2.0, 3.0, 3.5]
    assert [r["label"] for r in found] == ["Jan", "Feb", "Mar", "Apr"]


def test_bucket_order(table):
    df = table({"AQI_Bucket": "string"}, ("Poor",), ("Good",), ("Poor",))
    assert [(r["AQI_Bucket"], r["n"]) for r in explore.bucket_counts(df).collect()] == [("Good", 1), ("Poor", 2)]


def test_equal_means_go_by_name(table):
    df = table({"City": "string", "AQI": "double"}, ("b", 1.0), ("a", 1.0), ("c", 2.0))
    assert [r["City"] for r in explore.top_means(df, n=2).collect()] == ["c", "a"]
    assert [r["City"] for r in explore.for_display(explore.top_means(df), "mean_aqi", "City").collect()] == ["b", "a", "c"]


def test_top_list_is_not_a_full_sort(cleaned):
    assert "TakeOrderedAndProject" in plan(explore.top_means(cleaned))
    assert "TakeOrderedAndProject" in plan(profile.preview(cleaned))


def test_no_python_in_any_plan_and_no_cross_join(cleaned):
    for name, result in explore.explore(cleaned).items():
        text = plan(result)
        assert "Python" not in text and "Pandas" not in text, name
        assert "CartesianProduct" not in text and "NestedLoop" not in text, name


def test_correlation_shuffles_only_pattern_rows(cleaned):
    text = plan(correlation_matrix(cleaned, CORRELATED))
    assert text.count("Exchange") == 2 and "Join" not in text


def test_axis_starts_at_zero(table):
    df = table({"AQI": "double"}, (3.0,), (40.0,))
    assert rows(explore.axis_range(df)) == [(0.0, 45.0)]


def test_describe(table):
    df = table({"x": "double"}, *[(float(v),) for v in range(200)], (None,))
    row = profile.describe(df).first()
    assert (row["count"], row["q25"], row["q50"], row["q75"]) == (200, 49.75, 99.5, 149.25)
    assert row["std"] == 57.88 and (row["min"], row["max"]) == (0.0, 199.0)


def test_describe_dates(spark):
    df = spark.sql("SELECT CAST(d AS DATE) AS Date FROM VALUES ('2020-01-01'), ('2020-01-02'), (NULL) t(d)")
    row = profile.describe_dates(df).first()
    assert row["count"] == 2 and str(row["mean"]) == "2020-01-01 12:00:00"
