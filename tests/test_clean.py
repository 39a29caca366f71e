from __future__ import annotations

from conftest import plan, rows
from pyspark.sql import functions as F

from smogline.operators import clean, quantiles
from smogline.plans.observations import staged_observations
from smogline.schema import POLLUTANTS

NUMBER = {"x": "double"}


def test_drop_missing_targets(table):
    df = table({"AQI": "double", "AQI_Bucket": "string"}, (1.0, "Good"), (None, "Good"), (1.0, None), (None, None))
    assert rows(clean.drop_missing_targets(df)) == [(1.0, "Good")]


def test_nan_target_counts_as_missing(spark):
    df = spark.sql("SELECT * FROM VALUES (DOUBLE('NaN'), 'Good'), (1D, 'Good') t(AQI, AQI_Bucket)")
    assert rows(clean.drop_missing_targets(df)) == [(1.0, "Good")]


def test_median_skips_missing_and_averages_the_middle_two(table):
    df = table(NUMBER, (1.0,), (2.0,), (4.0,), (10.0,), (None,))
    assert quantiles.exact_medians(df, ["x"]) == {"x": 3.0}


def test_median_of_nothing(table):
    df = table(NUMBER, (None,), (None,))
    assert quantiles.exact_medians(df, ["x"]) == {"x": None}
    assert quantiles.exact_medians(df, []) == {}


def test_quantiles_do_not_depend_on_narrowing(spark):
    df = spark.range(20_000).select(
        F.pow(F.rand(5) * 100, 3).alias("spread"),
        # One value makes up a third of the rows.
        F.when(F.col("id") % 3 == 0, 7.0).otherwise(F.col("id") * 1.0).alias("hot"),
        F.lit(4.0).alias("constant"),
        F.when(F.col("id") % 10 == 0, F.randn(6)).alias("sparse"),
    )
    df = df.checkpoint() if spark.sparkContext.getCheckpointDir() else df
    columns, shares = df.columns, [0.0, 0.1, 0.25, 0.5, 0.75, 1.0]
    native = df.agg(*[F.percentile(c, shares).alias(c) for c in columns]).first()
    for limit in (1, 50, 3_000, 1 << 20):
        ours = quantiles.exact_quantiles(df, columns, shares, ranked_rows=limit)
        for c in columns:
            assert all(abs(a - b) < 1e-9 * max(1, abs(b)) for a, b in zip(ours[c], native[c])), (limit, c)


def scans(spark, df):
    """The table, and a counter of the rows that its scans have read."""
    read = spark.sparkContext.accumulator(0)

    def count(batches):
        for batch in batches:
            read.add(batch.num_rows)
            yield batch

    return df.mapInArrow(count, df.schema), read


def test_quantiles_take_two_scans_at_any_size(spark, monkeypatch):
    rows_each = 30_000
    df = spark.range(rows_each).select(
        (F.pmod(F.col("id") * 7919, F.lit(rows_each)) * 1.5).alias("a"), F.rand(3).alias("b"), (F.col("id") % 7).cast("double").alias("c")
    )
    shares = [0.1, 0.25, 0.5, 0.9]
    native = df.agg(*[F.percentile(c, shares).alias(c) for c in df.columns]).first()
    for whole, limit in ((1 << 18, 1 << 18), (1 << 18, 20), (25_000, 2)):
        monkeypatch.setattr(quantiles, "KEPT_WHOLE", whole)
        counted, read = scans(spark, df)
        found, measured = quantiles.summarise(counted, df.columns, shares, {"n": F.count, "top": F.max}, limit)
        assert read.value == 2 * rows_each, (whole, limit)
        for c in df.columns:
            assert all(abs(a - b) < 1e-9 * max(1, abs(b)) for a, b in zip(found[c], native[c])), (whole, limit, c)
            assert measured[c]["n"] == rows_each
        assert measured["a"]["top"] == (rows_each - 1) * 1.5


def test_large_columns_keep_only_values_near_the_ranks(spark, monkeypatch):
    """Beyond KEPT_WHOLE few values are written; a sketch that is wrong costs scans, not the result."""
    written = []
    monkeypatch.setattr(quantiles, "KEPT_WHOLE", 1000)
    monkeypatch.setattr(quantiles, "stage", lambda df, name, real=quantiles.stage: written.append(real(df, name)) or written[-1])
    df = spark.range(400_000).select(F.rand(9).alias("x"))
    [[low, middle]] = [quantiles.exact_quantiles(df, ["x"], [0.25, 0.5])["x"]]
    assert [low, middle] == list(df.agg(F.percentile("x", [0.25, 0.5])).first()[0])
    assert written[0].count() < 1000
    monkeypatch.setattr(quantiles, "SKETCH_ACCURACY", 10)
    monkeypatch.setattr(F, "percentile_approx", lambda v, places, accuracy, real=F.percentile_approx: real(v, [p / 2 for p in places], 100))
    small = spark.range(5000).select((F.col("id") * 1.0).alias("x"))
    assert quantiles.exact_quantiles(small, ["x"], [0.9])["x"] == [4499.1]


def test_fill(table):
    df = table({"NO": "double", "CO": "double", "other": "double"}, (1.0, None, None), (None, None, 5.0), (3.0, None, None))
    assert rows(clean.fill_medians(df)) == [(1.0, None, None), (2.0, None, 5.0), (3.0, None, None)]


def test_fill_without_measured_columns(table):
    df = table({"other": "double"}, (None,))
    assert clean.fill_medians(df) is df


def test_rows_made_equal_by_filling_collapse(table):
    df = table({"NO": "double", "AQI": "double", "AQI_Bucket": "string"}, (2.0, 1.0, "Good"), (None, 1.0, "Good"), (2.0, 1.0, "Good"))
    assert rows(clean.clean(df)) == [(2.0, 1.0, "Good")]


def test_missing_equals_missing_among_copies(table):
    df = table({"a": "string", "x": "double"}, ("p", None), ("p", None), (None, 1.0), (None, 1.0))
    assert clean.drop_copies(df).count() == 2


def test_cleaning_twice_changes_nothing(cleaned):
    again = clean.clean(cleaned)
    assert again.exceptAll(cleaned).count() == 0 and again.count() == cleaned.count()


def test_audit_adds_up(spark, folder, cleaned):
    raw = staged_observations(spark, folder)
    steps = dict(rows(clean.cleaning_audit(raw, cleaned)))
    assert steps["raw_rows"] - steps["dropped_without_target"] == steps["rows_with_targets"]
    assert steps["rows_with_targets"] - steps["copies_removed"] == steps["clean_rows"] == 5607
    assert steps["values_still_missing"] == 0


def test_audit_counts_columns_without_values(table):
    raw = table({"NO": "double", "CO": "double", "AQI": "double", "AQI_Bucket": "string"}, (1.0, None, 1.0, "Good"), (None, None, 2.0, "Good"))
    steps = dict(rows(clean.cleaning_audit(raw, clean.clean(raw))))
    assert steps["values_filled"] == 1 and steps["values_still_missing"] == 2


def test_filling_is_a_projection_and_pruning_reaches_the_scan(spark, folder):
    raw = staged_observations(spark, folder)
    filled = clean.fill_medians(clean.drop_missing_targets(raw), POLLUTANTS).select("PM10")
    text = plan(filled)
    assert "Join" not in text and "Exchange" not in text
    assert "ReadSchema: struct<PM10:double,AQI:double,AQI_Bucket:string>" in text
    assert "IsNotNull(AQI), IsNotNull(AQI_Bucket)" in text


def test_copies_are_merged_before_the_shuffle(spark, folder):
    text = plan(clean.drop_copies(staged_observations(spark, folder)))
    assert text.count("HashAggregate") == 2 and text.count("Exchange") == 1


def test_audit_counts_a_nan_target_as_missing(table):
    from smogline.operators.clean import clean, cleaning_audit

    raw = table({"NO": "double", "AQI": "double", "AQI_Bucket": "string"}, (1.0, 5.0, "Good"), (2.0, float("nan"), "Good"))
    steps = {r["step"]: r["n"] for r in cleaning_audit(raw, clean(raw)).collect()}
    assert steps["dropped_without_target"] == 1 and steps["copies_removed"] == 0


def test_audit_of_the_one_write(spark, folder):
    raw = staged_observations(spark, folder)
    counted, read = scans(spark, raw)
    before, audit = clean.audited_clean(counted)
    medians = read.value
    before.write.format("noop").mode("overwrite").save()
    found = audit()
    assert sorted(rows(found)) == sorted(rows(clean.cleaning_audit(raw, clean.clean(raw))))
    n = raw.count()
    assert medians == 2 * n and read.value == 3 * n  # two scans for the medians, one for the write
    empty, audit = clean.audited_clean(raw.limit(0))
    empty.write.format("noop").mode("overwrite").save()
    assert {r["n"] for r in audit().collect()} == {0}
