"""Shared inputs of the registered queries.

The tables hold no vehicle ads, so listing texts, records, runs and artifacts are
derived from them by SQL both engines understand: the Spark query and its SQL twin
start from the same rows.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from ...session import prepare, scratch_path

NL = "chr(10)"
K = "o_orderkey"
MONTH = "CAST(year(o_orderdate) * 100 + month(o_orderdate) AS STRING)"

#: Run id of an order: one run per month, in either id style, some unreadable.
RUN = (
    f"CASE WHEN {K} % 997 = 3 THEN 'zz' WHEN {K} % 3 = 0 THEN {MONTH} || '01T000000Z' "
    f"ELSE {MONTH} || '01000000' END"
)
THOUSANDS = "CAST(CAST(floor({x} / 1000) AS BIGINT) AS STRING) || ',' || lpad(CAST({x} % 1000 AS STRING), 3, '0')"
PRICE = "CAST(floor(o_totalprice / 10) AS BIGINT)"
MILES = f"(1000 + ({K} * 7919) % 250000)"


def cases(key: str, n: int, *values: str) -> str:
    whens = " ".join(f"WHEN {i} THEN {v}" for i, v in enumerate(values[:-1]))
    return f"CASE {key} % {n} {whens} ELSE {values[-1]} END"


MAKE = cases(K, 6, "'Honda'", "'Ford'", "'Toyota'", "'Subaru'", "'Chevrolet'", "'Volkswagen'")
MODEL = cases(K, 5, "'Civic'", "'F150'", "'Camry'", "'Outback'", "'Jetta'")
TEXT = " || ".join([
    f"'listing ' || CAST({K} AS STRING) || {NL}",
    f"CASE WHEN {K} % 11 = 0 THEN 'honda civic' ELSE {MAKE} || ' ' || {MODEL} END || ' for sale' || {NL}",
    f"CASE WHEN {K} % 13 = 0 THEN 'year 12015' ELSE 'year ' || CAST(1985 + {K} % 40 AS STRING) END || {NL}",
    cases(K, 6, f"'Price: $' || {THOUSANDS.format(x=PRICE)} || ' obo'", f"'asking $ ' || CAST({PRICE} AS STRING)",
          f"{THOUSANDS.format(x=PRICE)}", "'$, call'", f"'now $' || CAST({PRICE} AS STRING) || '.50'",
          f"'Listed price - $' || {THOUSANDS.format(x=PRICE)}") + f" || {NL}",
    cases(K, 7, f"'odometer: ' || {THOUSANDS.format(x=MILES)}", f"'mileage ' || CAST({MILES} AS STRING)",
          f"CAST(CAST(floor({MILES} / 1000) AS BIGINT) AS STRING) || '.5k miles'", f"{THOUSANDS.format(x=MILES)} || ' mi'",
          "'mileage: , about 45k mi'", f"CAST({MILES} AS STRING) || ' miles'", "'tmu'") + f" || {NL}",
    cases(K, 6, "'CVT'", "'stick shift'", "'AUTO'", "'manual'", "'automatic'", "'gearbox'") + f" || {NL}",
    cases(K, 7, "'Gasoline'", "'EV'", "'diesel'", "'Hybrid'", "'gas'", "'electric'", "'steam'") + f" || {NL}",
    cases(K, 8, "'all wheel drive'", "'allwheeldrive'", "'4WD'", "'fwd'", "'rear wheel drive'", "'AWD'",
          "'front wheel drive'", "'tracks'") + f" || {NL}",
    f"CASE WHEN {K} % 4 = 0 THEN 'image_url: https://images.example.org/' || CAST({K} AS STRING) || '_a.jpg' "
    f"ELSE 'see https://example.org/' || CAST({K} AS STRING) END",
])
#: One listing text per order: a customer is a post seen in many runs.
LISTINGS = (
    f"SELECT {K} AS listing_id, CAST(o_custkey AS STRING) AS post_id, {RUN} AS run_id, "
    f"'scrapes/' || {RUN} || '/' || CAST({K} AS STRING) || '.txt' AS path, {TEXT} AS text FROM {{orders}}"
)
L = f"l AS ({LISTINGS.format(orders='orders')})"


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return prepare(spark).read.parquet(f"{folder}/{name}.parquet")


def derive(spark: SparkSession, folder: str, sql: str, *names: str) -> DataFrame:
    """Run portable SQL whose ``{name}`` placeholders are tables of the folder."""
    return spark.sql(sql, **{n: table(spark, folder, n) for n in names})


def listings(spark: SparkSession, folder: str) -> DataFrame:
    return derive(spark, folder, LISTINGS, "orders")


#: Run metrics: one run per day of events, the events playing the scored listings.
RUNS = """
SELECT CAST(year(ts) * 10000 + month(ts) * 100 + day(ts) AS STRING) || '00' AS run_id,
  CAST(count(*) AS BIGINT) AS train_rows, CAST(count(DISTINCT user_id) AS BIGINT) AS holdout_rows,
  round(avg(value), 9) AS mae_today, round(max(value), 9) AS rmse_today,
  round(avg(value * value), 9) AS mape_today, round(avg(value) - 20, 9) AS bias_today,
  round(stddev_samp(value), 9) AS best_cv_mae,
  CAST(count(*) % 3 AS BIGINT) AS max_depth, CAST(count(DISTINCT user_id) % 4 AS BIGINT) AS n_estimators
FROM {events} GROUP BY 1
"""
RUNS_CTE = f"runs AS ({RUNS.format(events='events')})"

#: Importance: mean event value per day and event type.
IMPORTANCE = """
SELECT CAST(year(ts) * 10000 + month(ts) * 100 + day(ts) AS STRING) || '00' AS run_id,
  event_type AS feature, round(avg(value), 9) AS importance
FROM {events} WHERE NOT (event_type = 'error' AND day(ts) % 5 = 0) GROUP BY 1, 2
"""
IMPORTANCE_CTE = f"imp AS ({IMPORTANCE.format(events='events')})"

#: Predicted and actual classes: line status against a rule on its flag and size.
CLASSES = """
SELECT l_orderkey, l_linenumber,
  CASE l_returnflag WHEN 'A' THEN 'low' WHEN 'N' THEN 'medium' ELSE 'high' END AS actual_tier,
  CASE WHEN l_quantity < 17 THEN 'low' WHEN l_quantity < 34 OR l_returnflag = 'N' THEN 'medium'
    ELSE 'high' END AS predicted_tier
FROM {lineitem}
"""
CLASSES_CTE = f"c AS ({CLASSES.format(lineitem='lineitem')})"


def runs(spark: SparkSession, folder: str) -> DataFrame:
    return derive(spark, folder, RUNS, "events")


def importance(spark: SparkSession, folder: str) -> DataFrame:
    return derive(spark, folder, IMPORTANCE, "events")


def classes(spark: SparkSession, folder: str) -> DataFrame:
    return derive(spark, folder, CLASSES, "lineitem")


def landed(spark: SparkSession, folder: str, name: str, write: Callable[[str], None]) -> str:
    """A fresh folder below the shared scratch folder that ``write`` filled from the tables."""
    path = scratch_path(spark, name)
    write(path)
    return path
