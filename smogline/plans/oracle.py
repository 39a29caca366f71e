"""The registered queries as SQL for another engine, written independently."""

from __future__ import annotations

MEASURED = [
    "PM2_5", "PM10", "NO", "NO2", "NOx", "NH3", "CO", "SO2", "O3", "Benzene", "Toluene", "Xylene",
]
NUMBERS = [*MEASURED, "AQI"]
COLUMNS = ["City", "Date", "k", *NUMBERS, "AQI_Bucket"]
CALENDAR = ["Year", "Month", "Day", "DayOfWeek", "Quarter", "DayOfYear", "IsWeekend"]
FEATURES = [*MEASURED, *CALENDAR, "City_Encoded"]

OBSERVED = """
joined AS (
  SELECT n_name AS City, CAST(l_shipdate AS DATE) AS Date,
    l_orderkey*31 + l_partkey*17 + l_suppkey*7 + l_linenumber AS k,
    l_quantity*9e0 AS PM2_5, l_extendedprice/3e2 AS PM10, p_size*1e0 AS NO,
    l_discount*1e3 + 0e0 AS NO2, (l_discount*1e3 + 0e0)*6e-1 + (p_size*1e0)*8e-1 AS NOx,
    l_tax*5e2 + 0e0 AS NH3, p_retailprice - 9e2 AS SO2, o_totalprice/4e3 AS O3,
    (c_acctbal + 1e3)/1e3 AS Benzene, (s_acctbal + 1e3)/5e2 AS Toluene, l_linenumber*1e0 AS Xylene
  FROM lineitem
  JOIN orders ON l_orderkey = o_orderkey
  JOIN customer ON o_custkey = c_custkey
  JOIN part ON l_partkey = p_partkey
  JOIN supplier ON l_suppkey = s_suppkey
  JOIN nation ON s_nationkey = n_nationkey
),
indexed AS (
  SELECT *, CAST(floor(greatest(PM2_5, PM10, NO2*1.2e0, SO2) + O3*1e-1) AS DOUBLE) AS a FROM joined
),
gapped AS (
  SELECT City, Date, k,
    CASE WHEN k%13 <> 0 THEN PM2_5 END AS PM2_5, CASE WHEN k%5 <> 0 THEN PM10 END AS PM10,
    CASE WHEN k%17 <> 0 THEN NO END AS NO, CASE WHEN k%19 <> 0 THEN NO2 END AS NO2,
    CASE WHEN k%23 <> 0 THEN NOx END AS NOx, CASE WHEN k%3 <> 0 THEN NH3 END AS NH3,
    (k%211)/1e1 AS CO, SO2, CASE WHEN k%37 <> 0 THEN O3 END AS O3, Benzene,
    CASE WHEN k%7 <> 0 THEN Toluene END AS Toluene, CASE WHEN k%2 <> 0 THEN Xylene END AS Xylene,
    CASE WHEN k%29 <> 0 THEN a END AS AQI,
    CASE WHEN k%31 <> 0 THEN
      CASE WHEN a <= 50 THEN 'Good' WHEN a <= 100 THEN 'Satisfactory' WHEN a <= 200 THEN 'Moderate'
        WHEN a <= 300 THEN 'Poor' WHEN a <= 400 THEN 'Very Poor' ELSE 'Severe' END
    END AS AQI_Bucket
  FROM indexed
),
obs AS (SELECT * FROM gapped UNION ALL SELECT * FROM gapped WHERE k%50 = 0)"""

KEPT = OBSERVED + """,
kept AS (SELECT * FROM obs WHERE AQI IS NOT NULL AND AQI_Bucket IS NOT NULL),
medians AS (SELECT {medians} FROM kept)""".format(
    medians=", ".join(f"median({c}) AS m_{c}" for c in MEASURED)
)

FILLED = KEPT + """,
filled AS (SELECT City, Date, k, {filled}, AQI, AQI_Bucket FROM kept, medians)""".format(
    filled=", ".join(f"coalesce({c}, m_{c}) AS {c}" for c in MEASURED)
)

CLEAN = FILLED + """,
clean AS (SELECT DISTINCT * FROM filled)"""

CALENDAR_SQL = """CAST(year(Date) AS INTEGER) AS Year, CAST(month(Date) AS INTEGER) AS Month,
  CAST(day(Date) AS INTEGER) AS Day, CAST(isodow(Date) - 1 AS INTEGER) AS DayOfWeek,
  CAST(quarter(Date) AS INTEGER) AS Quarter, CAST(dayofyear(Date) AS INTEGER) AS DayOfYear,
  isodow(Date) >= 6 AS IsWeekend"""

CODES = """(SELECT {c} AS value, CAST(dense_rank() OVER (ORDER BY {c}) - 1 AS INTEGER) AS code
  FROM (SELECT DISTINCT {c} FROM clean))"""

FEATURED = CLEAN + f""",
featured AS (
  SELECT clean.*, {CALENDAR_SQL}, code AS City_Encoded
  FROM clean JOIN {CODES.format(c='City')} ON City = value
)"""

IDENTITY = " || '|' || ".join(
    ["CAST(k AS VARCHAR)", "City", "CAST(Date AS VARCHAR)"]
    + [f"CAST(CAST(floor({c}*1e6) AS BIGINT) AS VARCHAR)" for c in ["PM10", "SO2", "O3", "Benzene", "Toluene"]]
)

KEYED = FEATURED + f""",
keyed AS (
  SELECT *, CAST('0x' || substr(md5('42|' || {IDENTITY}), 1, 13) AS BIGINT) AS key FROM featured
)"""

SPLIT = KEYED + """,
marked AS (
  SELECT *, row_number() OVER (ORDER BY key) <= ceil(2e-1 * count(*) OVER ()) AS is_test FROM keyed
)"""

STRATIFIED = KEYED + """,
sizes AS (
  SELECT AQI_Bucket, count(*) AS c, sum(count(*)) OVER () AS total FROM keyed GROUP BY AQI_Bucket
),
shares AS (SELECT *, total - CAST(ceil(2e-1 * total) AS BIGINT) AS train FROM sizes),
whole AS (
  SELECT AQI_Bucket, c, train, c*train // total AS w, c*train % total AS rest FROM shares
),
given AS (
  SELECT AQI_Bucket, c - w - CASE WHEN row_number() OVER (ORDER BY rest DESC, AQI_Bucket)
    <= train - sum(w) OVER () THEN 1 ELSE 0 END AS t
  FROM whole
),
classed AS (
  SELECT keyed.*, row_number() OVER (PARTITION BY keyed.AQI_Bucket ORDER BY key) <= t AS is_test
  FROM keyed JOIN given USING (AQI_Bucket)
)"""

GUESSED = SPLIT + """,
overall AS (SELECT avg(AQI) AS m FROM marked WHERE NOT is_test),
by_city AS (SELECT City, avg(AQI) AS m FROM marked WHERE NOT is_test GROUP BY City),
by_month AS (SELECT City, Month, avg(AQI) AS m FROM marked WHERE NOT is_test GROUP BY City, Month),
guessed AS (
  SELECT marked.AQI, overall.m AS overall, coalesce(by_city.m, overall.m) AS city,
    coalesce(by_month.m, overall.m) AS city_month
  FROM marked CROSS JOIN overall
  LEFT JOIN by_city ON marked.City = by_city.City
  LEFT JOIN by_month ON marked.City = by_month.City AND marked.Month = by_month.Month
  WHERE is_test
)"""


def _bands(c: str) -> str:
    return (
        f"CASE WHEN {c} <= 60 THEN 'Good' WHEN {c} <= 120 THEN 'Satisfactory' "
        f"WHEN {c} <= 200 THEN 'Moderate' WHEN {c} <= 300 THEN 'Poor' "
        f"WHEN {c} <= 400 THEN 'Very Poor' ELSE 'Severe' END"
    )


GUESSED_CLASSES = STRATIFIED + f""",
classes AS (
  SELECT AQI_Bucket AS label, {_bands('PM2_5')} AS by_pm2_5, {_bands('PM10')} AS by_pm10
  FROM classed WHERE is_test
)"""


def _regression(guess: str, digits: str = "round({}, 6)") -> str:
    mae, rmse = f"avg(abs(AQI - {guess}))", f"sqrt(avg((AQI - {guess})*(AQI - {guess})))"
    r2 = f"1e0 - sum((AQI - {guess})*(AQI - {guess})) / (SELECT sum((AQI - m)*(AQI - m)) FROM guessed, (SELECT avg(AQI) AS m FROM guessed))"
    return " UNION ALL ".join(
        f"SELECT '{n}' AS metric, {digits.format(x)} AS value FROM guessed"
        for n, x in (("MAE", mae), ("RMSE", rmse), ("R2", r2))
    )


def _classification(guess: str, digits: str = "round({}, 6)") -> str:
    per_class = f"""SELECT c, (SELECT count(*) FROM classes WHERE label = c) AS s,
      (SELECT count(*) FROM classes WHERE {guess} = c) AS p,
      (SELECT count(*) FROM classes WHERE label = c AND {guess} = c) AS h
      FROM (SELECT label AS c FROM classes UNION SELECT {guess} FROM classes)"""
    scores = {
        "Accuracy": "sum(h)/sum(s)",
        "Precision": "sum(s*CASE WHEN p = 0 THEN 0e0 ELSE h*1e0/p END)/sum(s)",
        "Recall": "sum(CASE WHEN s = 0 THEN 0e0 ELSE s*(h*1e0/s) END)/sum(s)",
        "F1_Score": "sum(s*CASE WHEN s + p = 0 THEN 0e0 ELSE 2e0*h/(s + p) END)/sum(s)",
    }
    return " UNION ALL ".join(
        f"SELECT '{n}' AS metric, {digits.format(x)} AS value FROM ({per_class})" for n, x in scores.items()
    )


FOUR = "round_even(CAST({} AS DOUBLE), 4)"
MODELS = [
    ("regression", "Overall mean", _regression("overall", FOUR)),
    ("regression", "City mean", _regression("city", FOUR)),
    ("regression", "City and month mean", _regression("city_month", FOUR)),
    ("classification", "PM2_5 bands", _classification("by_pm2_5", FOUR)),
    ("classification", "PM10 bands", _classification("by_pm10", FOUR)),
]
BOARD = (
    GUESSED
    + GUESSED_CLASSES[len(KEYED):]
    + ", board AS ("
    + " UNION ALL ".join(
        f"SELECT '{t}' AS task, '{m}' AS model, {i} AS ord, metric, value FROM ({q})"
        for i, (t, m, q) in enumerate(MODELS)
    )
    + """),
decided AS (
  SELECT *, row_number() OVER (PARTITION BY task ORDER BY value DESC, ord) AS place FROM board
  WHERE metric = CASE task WHEN 'regression' THEN 'R2' ELSE 'F1_Score' END
)"""
)

DAY = "CAST(Date AS VARCHAR) AS Date"
ROW = ", ".join(DAY if c == "Date" else c for c in COLUMNS)
KINDS = {
    **{c: "double" for c in NUMBERS},
    "City": "string", "Date": "date", "k": "bigint", "AQI_Bucket": "string",
}
SCORES = ["MAE", "RMSE", "R2", "Accuracy", "Precision", "Recall", "F1_Score"]
MOMENTS = {
    "mean": "avg(d)", "min": "min(d)", "q25": "quantile_cont(d, 0.25)",
    "q50": "quantile_cont(d, 0.5)", "q75": "quantile_cont(d, 0.75)", "max": "max(d)",
}
FEATURE_NUMBER = {c: f"CAST({c} AS INTEGER)" if c == "IsWeekend" else c for c in FEATURES}


def _union(parts) -> str:
    return " UNION ALL ".join(parts)


def _correlations(table: str) -> str:
    cells = _union(
        f"SELECT '{a}' AS \"row\", '{b}' AS col, corr({a}, {b}) AS r FROM {table}"
        for a in NUMBERS
        for b in NUMBERS
    )
    return f"SELECT \"row\", col, round(CASE WHEN isnan(r) THEN NULL ELSE r END, 6) AS value FROM ({cells})"


def _with(tables: str, query: str) -> str:
    return f"WITH {tables.strip()} {query}"


ORACLE: dict[str, str] = {
    "scan_observations": _with(OBSERVED, f"SELECT {ROW} FROM obs"),
    "drop_missing_targets": _with(KEPT, f"SELECT {ROW} FROM kept"),
    "column_medians": _with(
        KEPT, _union(f"SELECT '{c}' AS \"column\", m_{c} AS median FROM medians" for c in MEASURED)
    ),
    "impute_medians": _with(FILLED, f"SELECT {ROW} FROM filled"),
    "remove_duplicates": _with(OBSERVED, f"SELECT {ROW} FROM (SELECT DISTINCT * FROM obs)"),
    "clean": _with(CLEAN, f"SELECT {ROW} FROM clean"),
    "cleaning_audit": _with(
        CLEAN,
        """SELECT 'raw_rows' AS step, (SELECT count(*) FROM obs) AS n
        UNION ALL SELECT 'dropped_without_target', (SELECT count(*) FROM obs) - (SELECT count(*) FROM kept)
        UNION ALL SELECT 'rows_with_targets', (SELECT count(*) FROM kept)
        UNION ALL SELECT 'values_filled', (SELECT CAST({gaps} AS BIGINT) FROM kept)
          - (SELECT CAST({left} AS BIGINT) FROM filled)
        UNION ALL SELECT 'values_still_missing', (SELECT CAST({left} AS BIGINT) FROM filled)
        UNION ALL SELECT 'clean_rows', (SELECT count(*) FROM clean)
        UNION ALL SELECT 'copies_removed', (SELECT count(*) FROM kept) - (SELECT count(*) FROM clean)
        """.format(
            gaps=" + ".join(f"count(*) - count({c})" for c in MEASURED),
            left=" + ".join(f"count(*) - count({c})" for c in MEASURED),
        ),
    ),
    "null_counts": _with(
        OBSERVED,
        _union(f"SELECT '{c}' AS \"column\", count(*) - count({c}) AS n_missing FROM obs" for c in COLUMNS),
    ),
    "table_info": _with(
        OBSERVED,
        _union(
            f"SELECT {i} AS position, '{c}' AS \"column\", '{KINDS[c]}' AS type, count({c}) AS n_present FROM obs"
            for i, c in enumerate(COLUMNS)
        ),
    ),
    "shape": _with(
        CLEAN, f"SELECT count(*) AS n_rows, CAST({len(COLUMNS)} AS BIGINT) AS n_columns FROM clean"
    ),
    "preview": _with(
        CLEAN, f"SELECT {ROW} FROM (SELECT * FROM clean ORDER BY {', '.join(COLUMNS)} LIMIT 5)"
    ),
    "describe": _with(
        CLEAN,
        _union(
            f"""SELECT '{c}' AS "column", count({c}) AS count, round(avg({c}), 6) AS mean,
            round(stddev_samp({c}), 6) AS std, min({c}) AS min,
            round(quantile_cont({c}, 0.25), 9) AS q25, round(quantile_cont({c}, 0.5), 9) AS q50,
            round(quantile_cont({c}, 0.75), 9) AS q75, max({c}) AS max FROM clean"""
            for c in NUMBERS
        ),
    ),
    "describe_dates": _with(
        CLEAN,
        "SELECT 'Date' AS \"column\", count(d) AS count, "
        + ", ".join(
            f"strftime(TIMESTAMP '1970-01-01' + to_seconds(CAST(round(({x})*86400e0) AS BIGINT)), "
            f"'%Y-%m-%d %H:%M:%S') AS {n}"
            for n, x in MOMENTS.items()
        )
        + " FROM (SELECT CAST(date_diff('day', DATE '1970-01-01', Date) AS DOUBLE) AS d FROM clean)",
    ),
    "column_range": _with(CLEAN, "SELECT min(AQI) AS smallest, max(AQI) AS largest FROM clean"),
    "distinct_buckets": _with(CLEAN, "SELECT DISTINCT AQI_Bucket FROM clean"),
    "city_count": _with(CLEAN, "SELECT count(DISTINCT City) AS n_distinct FROM clean"),
    "temporal_features": _with(CLEAN, f"SELECT City, {DAY}, k, AQI, {CALENDAR_SQL} FROM clean"),
    "city_dictionary": _with(CLEAN, f"SELECT value, code FROM {CODES.format(c='City')}"),
    "encode_city": _with(FEATURED, "SELECT k, City, AQI, City_Encoded FROM featured"),
    "encode_bucket": _with(
        CLEAN,
        f"SELECT k, AQI_Bucket, AQI, code, value AS decoded FROM clean "
        f"JOIN {CODES.format(c='AQI_Bucket')} ON AQI_Bucket = value",
    ),
    "feature_matrix": _with(FEATURED, f"SELECT {', '.join(FEATURES)}, AQI, AQI_Bucket FROM featured"),
    "histogram": _with(
        CLEAN,
        """SELECT CAST(b AS INTEGER) AS bin, round(lo + b*step, 6) AS low,
          round(CASE WHEN b = 59 THEN hi ELSE lo + (b + 1)*step END, 6) AS high,
          (SELECT count(*) FROM clean WHERE AQI >= lo + b*step AND (b = 59 OR AQI < lo + (b + 1)*step)) AS n
        FROM range(60) r(b), (SELECT min(AQI) AS lo, max(AQI) AS hi, (max(AQI) - min(AQI))/60e0 AS step FROM clean)""",
    ),
    "density": _with(
        CLEAN,
        """SELECT CAST(p AS INTEGER) AS point, round(x, 6) AS x,
          round(sum(w*exp(-0.5e0*((x - v)/bw)*((x - v)/bw)))/(n*bw*sqrt(2e0*pi())), 9) AS density
        FROM (SELECT p, lo + (hi - lo)*p/299e0 AS x, n, 1.06e0*sd*pow(n, -0.2e0) AS bw
          FROM range(300) r(p), (SELECT min(AQI) AS lo, max(AQI) AS hi, count(AQI) AS n, stddev_pop(AQI) AS sd FROM clean)),
          (SELECT AQI AS v, count(*) AS w FROM clean GROUP BY AQI)
        GROUP BY p, x, n, bw""",
    ),
    "correlation_matrix": _with(CLEAN, _correlations("clean")),
    "correlation_with_gaps": _with(OBSERVED, _correlations("obs")),
    "top_cities": _with(
        CLEAN,
        """SELECT City, round(m, 6) AS mean_aqi FROM
        (SELECT City, avg(AQI) AS m FROM clean GROUP BY City ORDER BY m DESC, City LIMIT 15)""",
    ),
    "monthly_trend": _with(
        CLEAN,
        """SELECT CAST(mo AS INTEGER) AS Month, strftime(make_date(2000, mo, 1), '%b') AS label,
        round(m, 6) AS mean_aqi,
        round(avg(m) OVER (ORDER BY mo ROWS BETWEEN 1 PRECEDING AND 1 FOLLOWING), 6) AS smoothed_aqi
        FROM (SELECT month(Date) AS mo, avg(AQI) AS m FROM clean GROUP BY mo)""",
    ),
    "bucket_counts": _with(
        CLEAN,
        """SELECT CAST(ord AS INTEGER) AS ord, b AS AQI_Bucket, n, colour FROM (VALUES
          (0, 'Good', '#2ecc71'), (1, 'Satisfactory', '#a8e063'), (2, 'Moderate', '#f1c40f'),
          (3, 'Poor', '#e67e22'), (4, 'Very Poor', '#e74c3c'), (5, 'Severe', '#8e44ad')) d(ord, b, colour)
        JOIN (SELECT AQI_Bucket, count(*) AS n FROM clean GROUP BY AQI_Bucket) ON b = AQI_Bucket""",
    ),
    "axis_range": _with(
        CLEAN, "SELECT greatest(0e0, min(AQI) - 5e0) AS axis_low, max(AQI) + 5e0 AS axis_high FROM clean"
    ),
    "random_split": _with(SPLIT, f"SELECT k, City, {DAY}, AQI, is_test FROM marked"),
    "split_counts": _with(
        SPLIT, "SELECT is_test, count(*) AS n, sum(AQI) AS sum_aqi FROM marked GROUP BY is_test"
    ),
    "stratified_counts": _with(
        STRATIFIED,
        "SELECT AQI_Bucket, is_test, count(*) AS n, sum(AQI) AS sum_aqi FROM classed GROUP BY AQI_Bucket, is_test",
    ),
    "scaler_stats": _with(
        SPLIT,
        _union(
            f"SELECT '{c}' AS feature, round(avg({x}), 6) AS mean, round(stddev_pop({x}), 6) AS std "
            "FROM marked WHERE NOT is_test"
            for c, x in FEATURE_NUMBER.items()
        ),
    ),
    "scaled_checksum": _with(
        SPLIT,
        _union(
            f"SELECT '{c}' AS feature, round(avg(({x} - m)/s), 6) AS mean, "
            f"round(avg(({x} - m)/s*(({x} - m)/s)), 6) AS square FROM marked, "
            f"(SELECT avg({x}) AS m, CASE WHEN stddev_pop({x}) = 0 THEN 1e0 ELSE stddev_pop({x}) END AS s "
            "FROM marked WHERE NOT is_test) WHERE is_test"
            for c, x in FEATURE_NUMBER.items()
        ),
    ),
    "regression_metrics": _with(GUESSED, _regression("city_month")),
    "classification_metrics": _with(GUESSED_CLASSES, _classification("by_pm2_5")),
    "confusion_matrix": _with(
        GUESSED_CLASSES,
        """SELECT l AS label, p AS prediction,
          (SELECT count(*) FROM classes WHERE label = l AND by_pm2_5 = p) AS n,
          round(100e0*(SELECT count(*) FROM classes WHERE label = l AND by_pm2_5 = p)
            /(SELECT count(*) FROM classes), 6) AS pct
        FROM (SELECT label AS l FROM classes UNION SELECT by_pm2_5 FROM classes),
          (SELECT label AS p FROM classes UNION SELECT by_pm2_5 FROM classes)""",
    ),
    "leaderboard": _with(BOARD, "SELECT task, model, CAST(ord AS INTEGER) AS ord, metric, value FROM board"),
    "best_model": _with(
        BOARD, "SELECT task, model AS best_model, value AS best_score FROM decided WHERE place = 1"
    ),
    "marked_leaderboard": _with(
        BOARD,
        "SELECT board.task, board.model, board.model = d.model AS is_best, "
        + ", ".join(f"coalesce(max(value) FILTER (WHERE metric = '{s}'), -1e0) AS {s}" for s in SCORES)
        + " FROM board JOIN (SELECT task, model FROM decided WHERE place = 1) d ON board.task = d.task"
        " GROUP BY board.task, board.model, d.model",
    ),
    "top_importances": _with(
        CLEAN,
        "SELECT feature, round(r, 6) AS importance, round(100e0*r/sum(r) OVER (), 6) AS share FROM ("
        + _union(f"SELECT '{c}' AS feature, abs(corr({c}, AQI)) AS r FROM clean" for c in MEASURED)
        + " ORDER BY r DESC, feature LIMIT 15)",
    ),
    "safe_divide": _with(
        OBSERVED,
        f"""SELECT k, City, {DAY},
        CASE WHEN PM2_5 IS NULL OR NO2 IS NULL OR NO2 = 0 THEN -1e0 ELSE PM2_5/NO2 END AS ratio FROM obs""",
    ),
    "format_percentage": _with(
        OBSERVED,
        """SELECT CASE WHEN Xylene IS NULL THEN 'N/A' ELSE printf('%.1f%%', round_even(Xylene/7e0*100e0, 1)) END AS text,
        count(*) AS n FROM obs GROUP BY 1""",
    ),
    "number_labels": _with(
        CLEAN,
        """SELECT City, format('{:,}', n) AS n_text, format('{:,.1f}', m*100e0) AS mean_text,
        printf('%.4f (%.1f%%)', m, n*100e0/sum(n) OVER ()) AS share_text
        FROM (SELECT City, count(*) AS n, avg(AQI) AS m FROM clean GROUP BY City)""",
    ),
    "write_read_csv": _with(CLEAN, f"SELECT {ROW} FROM clean"),
    "write_read_json": _with(OBSERVED, f"SELECT {ROW} FROM obs"),
    "clean_metadata": _with(
        CLEAN, f"SELECT count(*) AS rows, CAST({len(COLUMNS)} AS INTEGER) AS cols FROM clean"
    ),
    "metrics_round_trip": _with(BOARD, "SELECT task, model, metric, value FROM board"),
    "dataset_facts": _with(
        CLEAN,
        """SELECT (SELECT count(*) FROM obs) AS raw_rows, count(*) AS clean_rows,
        count(DISTINCT City) AS n_cities, CAST(min(Date) AS VARCHAR) AS first_day,
        CAST(max(Date) AS VARCHAR) AS last_day, CAST(20 AS INTEGER) AS n_features FROM clean""",
    ),
}

# Keys and measures of each exploratory result.
BUNDLE = {
    "histogram": ("CAST(bin AS VARCHAR)", ["low", "high", "n"]),
    "density": ("CAST(point AS VARCHAR)", ["x", "density"]),
    "correlation": ("\"row\" || '|' || col", ["value"]),
    "top_cities": ("City", ["mean_aqi"]),
    "monthly_trend": ("CAST(Month AS VARCHAR)", ["mean_aqi", "smoothed_aqi"]),
    "bucket_counts": ("AQI_Bucket", ["ord", "n"]),
    "axis_range": ("''", ["axis_low", "axis_high"]),
}
ORACLE["explore_bundle"] = _union(
    f"SELECT '{name}' AS result, {key} AS key, '{m}' AS measure, CAST({m} AS DOUBLE) AS value "
    f"FROM ({ORACLE['correlation_matrix' if name == 'correlation' else name]})"
    for name, (key, measures) in BUNDLE.items()
    for m in measures
)

ORACLE["observed_audit"] = ORACLE["cleaning_audit"]
ORACLE["metrics_without_counts"] = ORACLE["metrics_round_trip"]

FEWER = [c for c in MEASURED if c not in ("NH3", "Xylene")]
ORACLE["clean_without_columns"] = _with(
    OBSERVED,
    f"""SELECT DISTINCT City, {DAY}, k, {', '.join(f'coalesce({c}, m_{c}) AS {c}' for c in FEWER)}, AQI, AQI_Bucket
    FROM obs, (SELECT {', '.join(f'median({c}) AS m_{c}' for c in FEWER)} FROM obs WHERE AQI IS NOT NULL AND AQI_Bucket IS NOT NULL)
    WHERE AQI IS NOT NULL AND AQI_Bucket IS NOT NULL""",
)
ORACLE["top_cities_for_display"] = _with(
    CLEAN,
    """SELECT City, round(m, 6) AS mean_aqi, CAST(row_number() OVER (ORDER BY m, City DESC) AS INTEGER) AS place FROM
    (SELECT City, avg(AQI) AS m FROM clean GROUP BY City ORDER BY m DESC, City LIMIT 15)""",
)
ORACLE["stratified_split"] = _with(STRATIFIED, f"SELECT k, City, {DAY}, AQI_Bucket, is_test FROM classed")
ORACLE["split_of_many_classes"] = _with(
    KEYED.replace("AS key FROM featured", "AS key, City || '|' || strftime(Date, '%Y-%m') AS place_month FROM featured")
    + STRATIFIED[len(KEYED) :].replace("AQI_Bucket", "place_month"),
    f"SELECT k, place_month, {DAY}, is_test FROM classed",
)
ORACLE["columnar_rescan"] = _with(CLEAN, "SELECT k, City, AQI FROM clean WHERE AQI > 200")
ORACLE["parsed_days"] = """SELECT CAST(CAST(ts AS DATE) AS VARCHAR) AS day,
  CASE WHEN event_id % 3 = 0 THEN strftime(ts, '%Y-%m-%d') END AS text_day, count(*) AS n FROM events GROUP BY 1, 2"""
ORACLE["utc_texts"] = "SELECT event_id, strftime(ts, '%Y-%m-%dT%H:%M:%S.%fZ') AS text FROM events"

# Models of the small profile: 10 trees of depth 8, 5 stages of depth 5.
ORACLE["linear_normal_equations"] = _with(
    SPLIT,
    _union(
        f"SELECT '{c}' AS feature, round(avg({x}*AQI), 3) AS value FROM marked WHERE NOT is_test"
        for c, x in [*FEATURE_NUMBER.items(), ("1", "1e0")]
    ),
)
ORACLE["logistic_gradient"] = _with(
    STRATIFIED,
    """SELECT AQI_Bucket AS class, round(count(*)/(SELECT count(*)*1e0 FROM classed WHERE NOT is_test), 3) AS share,
    CAST(1 AS INTEGER) AS settled FROM classed WHERE NOT is_test GROUP BY AQI_Bucket""",
)
ORACLE["model_structure"] = _with(
    CLEAN,
    """SELECT task, model, property, CAST(value AS DOUBLE) AS value FROM (
    SELECT 'regression' AS task, 'Linear Regression' AS model, 'coefficients' AS property, 20 AS value
    UNION ALL SELECT 'regression', 'Random Forest Regressor', 'trees', 10
    UNION ALL SELECT 'regression', 'Random Forest Regressor', 'depth', 8
    UNION ALL SELECT 'regression', 'Gradient Boosting Regressor', 'trees', 5
    UNION ALL SELECT 'regression', 'Gradient Boosting Regressor', 'stages', 5
    UNION ALL SELECT 'regression', 'Gradient Boosting Regressor', 'depth', 5
    UNION ALL SELECT 'classification', 'Logistic Regression', 'coefficients', 20*count(DISTINCT AQI_Bucket) FROM clean
    UNION ALL SELECT 'classification', 'Random Forest Classifier', 'trees', 10
    UNION ALL SELECT 'classification', 'Random Forest Classifier', 'depth', 8
    UNION ALL SELECT 'classification', 'Gradient Boosting Classifier', 'trees', 5*count(DISTINCT AQI_Bucket) FROM clean
    UNION ALL SELECT 'classification', 'Gradient Boosting Classifier', 'stages', 5
    UNION ALL SELECT 'classification', 'Gradient Boosting Classifier', 'depth', 5)""",
)
ORACLE["boosting_losses"] = _with(
    SPLIT + STRATIFIED[len(KEYED) :],
    """SELECT 'regression' AS task, 'first_loss' AS fact, round(var_pop(AQI), 4) AS value FROM marked WHERE NOT is_test
    UNION ALL SELECT 'regression', 'start_0', round(avg(AQI), 4) FROM marked WHERE NOT is_test
    UNION ALL SELECT task, 'stage_' || i || '_falls', 1e0 FROM range(5) r(i), (VALUES ('regression'), ('classification')) t(task)
    UNION ALL SELECT 'classification', 'first_loss', round(-sum(p*ln(p)), 4) FROM (
      SELECT count(*)/(SELECT count(*)*1e0 FROM classed WHERE NOT is_test) AS p FROM classed WHERE NOT is_test GROUP BY AQI_Bucket)
    UNION ALL SELECT 'classification', 'start_' || (row_number() OVER (ORDER BY AQI_Bucket) - 1),
      round(ln(count(*)/(SELECT count(*)*1e0 FROM classed WHERE NOT is_test)), 4) FROM classed WHERE NOT is_test GROUP BY AQI_Bucket""",
)
ORACLE["saved_models_agree"] = _with(
    CLEAN,
    """SELECT task, model, CAST(ceil(2e-1*(SELECT count(*) FROM clean)) AS BIGINT) AS n, CAST(0 AS BIGINT) AS n_different FROM (VALUES
      ('regression', 'Linear Regression'), ('regression', 'Random Forest Regressor'), ('regression', 'Gradient Boosting Regressor'),
      ('classification', 'Logistic Regression'), ('classification', 'Random Forest Classifier'),
      ('classification', 'Gradient Boosting Classifier')) m(task, model)""",
)
# The job reads observations without their key.
BY_CONTENT = [("SELECT DISTINCT * FROM filled", "SELECT DISTINCT * EXCLUDE (k) FROM filled")]


def _job_sql() -> str:
    bundle = ORACLE["explore_bundle"] + f""" UNION ALL SELECT 'cleaning_audit', step, 'n', CAST(n AS DOUBLE) FROM ({ORACLE['cleaning_audit']})
    UNION ALL SELECT 'cleaned', '', 'rows', CAST(n_rows AS DOUBLE) FROM ({ORACLE['shape']})
    UNION ALL SELECT t, CAST(s AS VARCHAR), 'rows', CAST(CASE WHEN s THEN ceil(2e-1*n) ELSE n - ceil(2e-1*n) END AS DOUBLE)
      FROM (VALUES ('by_row'), ('by_class')) a(t), (VALUES (true), (false)) b(s), ({ORACLE['shape']}) c(n, m)
    UNION ALL SELECT 'confusion_matrix', '', 'rows', CAST(ceil(2e-1*n_rows) AS DOUBLE) FROM ({ORACLE['shape']})
    UNION ALL SELECT 'leaderboard', task, 'models', 3e0 FROM (VALUES ('regression'), ('classification')) t(task)
    UNION ALL SELECT 'metrics', 'regression', 'scores', 9e0 UNION ALL SELECT 'metrics', 'classification', 'scores', 12e0
    UNION ALL SELECT 'scaler_stats', '', 'features', 20e0"""
    for c in ("raw_rows", "clean_rows", "n_cities", "n_features"):
        bundle += f" UNION ALL SELECT 'dataset_facts', '', '{c}', CAST({c} AS DOUBLE) FROM ({ORACLE['dataset_facts']})"
    for a, b in BY_CONTENT:
        bundle = bundle.replace(a, b)
    return bundle


ORACLE["job_outputs"] = _job_sql()
