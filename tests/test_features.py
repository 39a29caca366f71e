from __future__ import annotations

from conftest import plan, rows
from hypothesis import given
from hypothesis import strategies as st
from pyspark.sql import functions as F

from smogline.functions import scalars
from smogline.functions.calendar import to_day, with_calendar
from smogline.operators import encode, rank, split

CITIES = ("b", "a", "B", "é", None, "a")


def test_calendar(spark):
    df = spark.sql("SELECT CAST(d AS DATE) AS Date FROM VALUES ('2024-01-01'), ('2024-01-06'), ('2024-12-31') t(d)")
    found = rows(with_calendar(df).orderBy("Date").select("DayOfWeek", "IsWeekend", "DayOfYear", "Quarter"))
    assert found == [(0, False, 1, 1), (5, True, 6, 1), (1, False, 366, 4)]


def test_to_day(table):
    df = table({"t": "string"}, ("2020-01-01",), ("bad",))
    assert [str(r[0]) for r in df.select(to_day(F.col("t"))).collect()] == ["2020-01-01", "None"]


def test_dictionary_in_code_point_order(table):
    df = table({"City": "string"}, *[(c,) for c in CITIES])
    wanted = {"B": 0, "a": 1, "b": 2, "nan": 3, "é": 4}
    assert dict(rows(encode.dictionary(df, "City"))) == wanted
    assert dict(rows(encode.dictionary(df, "City", sorted_rows=2))) == wanted


def test_long_dictionary_by_ranges(spark):
    df = spark.range(3000).select((F.col("id") * 7919 % 2503).cast("string").alias("t"))
    by_ranges = encode.dictionary(df, "t", sorted_rows=10)
    assert sorted(rows(by_ranges)) == sorted(rows(encode.dictionary(df, "t")))


def test_encode_and_decode(table):
    df = table({"City": "string"}, *[(c,) for c in CITIES])
    codes = encode.dictionary(df, "City")
    coded = encode.encode(df, "City", codes, "code")
    assert coded.count() == len(CITIES)
    back = encode.decode(coded, "code", codes, "text")
    assert back.where(encode.as_text(F.col("City")) != F.col("text")).count() == 0
    unseen = encode.encode(table({"City": "string"}, ("zzz",)), "City", codes, "code")
    assert unseen.first()["code"] is None


def test_split_has_exact_size_for_any_partitioning(spark):
    df = spark.range(200).select("id", (F.col("id") % 7).alias("g"))
    first = {r["id"] for r in split.random_split(df).where("is_test").collect()}
    other = {r["id"] for r in split.random_split(df.repartition(13, "g")).where("is_test").collect()}
    assert len(first) == 40 and first == other
    narrowed = {r["id"] for r in split.random_split(df, ranked_rows=3).where("is_test").collect()}
    assert narrowed == first


def test_split_is_disjoint_complete_and_without_shuffle(cleaned):
    marked = split.random_split(cleaned)
    train, test = marked.where("NOT is_test").drop("is_test"), marked.where("is_test").drop("is_test")
    assert train.unionAll(test).exceptAll(cleaned).count() == 0
    assert train.count() + test.count() == cleaned.count()
    assert "Exchange" not in plan(marked)


def with_copies(spark):
    """3000 rows, a third of them copies of one row."""
    return spark.range(3000).select(
        F.when(F.col("id") < 1000, -1).otherwise(F.col("id")).alias("id"),
        F.when(F.col("id") < 1500, "a").otherwise("b").alias("label"),
    )


def test_split_divides_copies_at_the_threshold(spark, monkeypatch):
    monkeypatch.setattr(split, "CHUNK", 64)
    df = with_copies(spark)
    divided = 0
    for seed in range(6):
        key = split.row_key(df.columns, seed)
        marked = split.random_split(df, key, share=0.5, ranked_rows=(100, 10_000)[seed % 2])
        assert marked.where("is_test").count() == 1500
        assert marked.drop("is_test").exceptAll(df).count() == 0 and marked.count() == 3000
        divided += marked.where("id = -1").select("is_test").distinct().count() == 2
    assert divided > 0


def test_stratified_split_divides_copies_at_the_threshold(spark):
    df = with_copies(spark)
    divided = 0
    for seed in range(4):
        key = split.row_key(df.columns, seed)
        marked = split.stratified_split(df, "label", key, share=0.5, ranked_rows=200)
        assert dict(rows(marked.where("is_test").groupBy("label").count())) == {"a": 750, "b": 750}
        assert marked.drop("is_test").exceptAll(df).count() == 0 and marked.count() == 3000
        divided += marked.where("id = -1").select("is_test").distinct().count() == 2
    assert divided > 0


def test_seed_changes_the_split(spark):
    df = spark.range(500)
    keyed = [split.random_split(df, split.row_key(["id"], seed)).where("is_test") for seed in (1, 2)]
    assert keyed[0].exceptAll(keyed[1]).count() > 0


def test_class_sizes():
    assert split.class_test_sizes({"a": 10, "b": 5}) == {"a": 2, "b": 1}
    sizes = split.class_test_sizes({"x": 7, "y": 11, "z": 1, "w": 33})
    assert sum(sizes.values()) == split.test_size(52)


@given(st.dictionaries(st.text("abcdef", min_size=1, max_size=3), st.integers(1, 10**12), min_size=1))
def test_class_sizes_add_up_and_stay_next_to_their_share(counts):
    sizes, rows_in_all = split.class_test_sizes(counts), sum(counts.values())
    wanted = split.test_size(rows_in_all)
    assert sum(sizes.values()) == wanted
    for c, n in counts.items():
        assert abs(sizes[c] * rows_in_all - n * wanted) <= rows_in_all


def test_stratified_split(spark):
    df = spark.range(15).select("id", F.when(F.col("id") < 10, "a").otherwise("b").alias("label"))
    marked = split.stratified_split(df, "label")
    assert dict(rows(marked.where("is_test").groupBy("label").count())) == {"a": 2, "b": 1}
    narrowed = split.stratified_split(df, "label", ranked_rows=1)
    assert sorted(rows(narrowed)) == sorted(rows(marked))


def test_stratified_split_with_one_class_holding_most_rows(spark):
    df = spark.range(5000).select(
        "id", F.when(F.col("id") % 10 < 9, "hot").otherwise(F.concat(F.lit("c"), F.col("id") % 3)).alias("label")
    )
    counts = dict(rows(df.groupBy("label").count()))
    marked = split.stratified_split(df, "label", ranked_rows=100)
    assert dict(rows(marked.where("is_test").groupBy("label").count())) == split.class_test_sizes(counts)


def test_places_by_ranges(spark):
    df = spark.range(1000).select((F.col("id") * 37 % 1000).alias("v"), F.lit("x").alias("place_part_"))
    placed = rank.with_place(df, [F.desc("v")])
    assert sorted((r["v"], r["place"]) for r in placed.collect()) == [(v, 999 - v) for v in range(1000)]
    assert rank.with_place(df.limit(0), [F.desc("v")]).collect() == []


def test_class_sizes_of_a_table(spark):
    counts = {f"c{k}": k * k % 23 + 1 for k in range(300)}
    df = spark.createDataFrame(list(counts.items()), "label string, n long")
    found = split.class_sizes(df, "label", sum(counts.values()))
    assert {r["label"]: r["n_test"] for r in found.collect()} == split.class_test_sizes(counts)
    big = {"a": 10**18 // 3, "b": 10**17 + 1, "c": 7}
    df = spark.createDataFrame(list(big.items()), "label string, n long")
    found = split.class_sizes(df, "label", sum(big.values()))
    assert {r["label"]: r["n_test"] for r in found.collect()} == split.class_test_sizes(big)


def test_stratified_split_of_very_many_classes(spark):
    """105,000 classes and a hot one; every class keeps its exact share."""
    df = spark.range(350_000).select("id", F.when(F.col("id") % 5 < 2, "hot").otherwise(F.concat(F.lit("c"), F.col("id") % 175_000)).alias("label"))
    marked = split.stratified_split(df, "label", ranked_rows=5_000)
    sizes = {r["label"]: (r["n"], r["t"]) for r in marked.groupBy("label").agg(F.count("*").alias("n"), F.count_if("is_test").alias("t")).collect()}
    assert len(sizes) == 105_001 and sum(n for n, _ in sizes.values()) == 350_000
    assert {c: t for c, (_, t) in sizes.items()} == split.class_test_sizes({c: n for c, (n, _) in sizes.items()})


def test_stratified_split_of_nothing(table):
    df = table({"c": "string", "x": "double"})
    assert rows(split.stratified_split(df, "c")) == []


def test_safe_divide(table):
    df = table({"a": "double", "b": "double"}, (1.0, 0.0), (3.0, 8.0), (None, 2.0))
    found = df.select(
        scalars.safe_divide(F.col("a"), F.col("b"), F.lit(-1.0)), scalars.safe_divide(F.col("a"), F.col("b"))
    )
    assert rows(found) == [(-1.0, None), (0.375, 0.375), (-1.0, None)]


def test_percent_text(table):
    df = table({"t": "string"}, ("0.1234",), ("x",), (None,), ("1",), ("NaN",))
    assert [r[0] for r in df.select(scalars.percent_text(F.col("t"))).collect()] == ["12.3%", "N/A", "N/A", "100.0%", "nan%"]
    assert df.select(scalars.percent_text(F.col("t"), 2)).first()[0] == "12.34%"


def test_rounding_goes_by_the_binary_value(spark):
    import random

    pick = random.Random(2)
    numbers = [0.0, 2.675, 0.125, 0.375, 2.5, 3.5, 1e-20, 5e-324, 1 / 3, 2.0**39 + 0.5, 1e11 + 0.05, 0.045, 1.005, 1e15, 0.5, 2.0**-7, 1 - 2**-53]
    numbers += [round(pick.uniform(-200, 200), pick.randint(0, 6)) for _ in range(500)] + [pick.gauss(0, 1) for _ in range(200)]
    numbers += [k / 8 for k in range(40)] + [k / 200 for k in range(400)]
    df = spark.createDataFrame([(v,) for v in numbers], "v double")
    for digits in (0, 1, 2, 4, 6):
        found = df.select("v", scalars.exact_rounded(F.col("v"), digits).cast("double").alias("r")).collect()
        assert [(r["v"], r["r"]) for r in found] == [(v, round(v, digits)) for v in numbers], digits
    texts = df.where("v > 0 and v < 1e9").select("v", scalars.percent_text(F.col("v"), 2).alias("t")).collect()
    assert all(r["t"] == f"{r['v'] * 100:.2f}%" for r in texts)
    odd = spark.createDataFrame([(0.02675,), (-0.0004,), (-1.5,), (float("-inf"),)], "v double")
    assert [r[0] for r in odd.select(scalars.percent_text(F.col("v"), 2)).collect()] == ["2.67%", "-0.04%", "-150.00%", "-inf%"]


def test_display_texts(table):
    df = table({"v": "double", "m": "int", "b": "string"}, (1234567.25, 3, "Poor"), (0.0, 12, "odd"))
    found = df.select(
        scalars.grouped_text(F.col("v")),
        scalars.month_text(F.col("m")),
        scalars.bucket_colour(F.col("b")),
        scalars.one_if_zero(F.col("v")),
        scalars.at_least_zero(-F.col("v")),
    )
    assert rows(found) == [
        ("1,234,567.2", "Mar", "#e67e22", 1234567.25, 0.0),
        ("0.0", "Dec", "#95a5a6", 1.0, 0.0),
    ]


def test_utc_text(spark):
    text = spark.sql("SELECT TIMESTAMP '2024-05-06 07:08:09.123456' AS t").select(scalars.utc_text(F.col("t")))
    assert text.first()[0] == "2024-05-06T07:08:09.123456Z"


def test_safe_divide_of_text_gives_the_default(table):
    from pyspark.sql import functions as F

    from smogline.functions.scalars import safe_divide

    df = table({"a": "string", "b": "double"}, ("x", 2.0), ("3", 2.0))
    assert [r[0] for r in df.select(safe_divide(F.col("a"), F.col("b"), F.lit(-1.0))).collect()] == [-1.0, 1.5]


def test_stratified_split_asks_for_labels(table):
    import pytest

    from smogline.operators.split import stratified_split

    with pytest.raises(ValueError, match="without c"):
        stratified_split(table({"c": "string", "x": "double"}, ("a", 1.0), (None, 2.0)), "c")
