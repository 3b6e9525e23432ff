"""Column lists and explicit schemas. Nothing in the engine infers a schema."""

from __future__ import annotations

from pyspark.sql import types as T

# Published column order of the three listing tables.
MASTER_COLUMNS = [
    "post_id", "run_id", "scraped_at", "price", "year", "make", "model", "mileage", "source_txt",
]
MASTER_V2_COLUMNS = MASTER_COLUMNS + ["transmission", "fuel_type", "drivetrain"]
LISTING_COLUMNS = [
    "post_id", "run_id", "scraped_at", "price", "year", "make", "model", "mileage",
    "transmission", "drivetrain", "fuel_type", "engine_cylinders", "condition", "color",
    "body_type", "title_status", "city", "state", "zip_code", "image_url", "source_txt",
    "combined_text", "combined_text_len", "has_combined_text",
]

LONG_FIELDS = {"price", "year", "mileage", "engine_cylinders", "combined_text_len"}
BOOLEAN_FIELDS = {"has_combined_text"}

#: Fields the field-extraction callable must answer with, all nullable.
EXTRACTED_FIELDS = [
    "price", "year", "make", "model", "mileage", "transmission", "drivetrain", "fuel_type",
    "engine_cylinders", "condition", "color", "body_type", "title_status", "city", "state",
    "zip_code",
]

# Model feature lists.
CATEGORICAL_FEATURES = [
    "make", "model", "transmission", "drivetrain", "fuel_type", "condition", "color", "body_type",
    "title_status",
]
TRAIN_NUMERIC_FEATURES = ["year_num", "mileage_num", "engine_cylinders"]
TIER_NUMERIC_FEATURES = [
    "year_num", "mileage_num", "vehicle_age", "miles_per_year", "engine_cylinders_num",
]
PREDICTION_COLUMNS = [
    "post_id", "scraped_at", "make", "model", "year", "mileage", "price", "transmission",
    "drivetrain", "fuel_type", "engine_cylinders", "condition", "color", "body_type",
    "title_status", "image_url",
]
TRAIN_REQUIRED_COLUMNS = [
    "post_id", "scraped_at", "price", "make", "model", "year", "mileage", "engine_cylinders",
]
TIERS = ["low", "medium", "high"]


def field_type(name: str) -> T.DataType:
    if name in LONG_FIELDS:
        return T.LongType()
    if name in BOOLEAN_FIELDS:
        return T.BooleanType()
    return T.StringType()


def table_schema(columns: list[str]) -> T.StructType:
    """Typed schema of a listing table; ids and zip codes stay strings."""
    return T.StructType([T.StructField(c, field_type(c)) for c in columns])


def text_schema(columns: list[str]) -> T.StructType:
    """Same columns, all STRING: a badly typed value then never voids its record."""
    return T.StructType([T.StructField(c, T.StringType()) for c in columns])


RECORD_COLUMNS = LISTING_COLUMNS + ["llm_provider", "llm_model", "llm_ts"]

PARAMS_SCHEMA = T.StructType([
    T.StructField("model__learning_rate", T.DoubleType()),
    T.StructField("model__max_depth", T.LongType()),
    T.StructField("model__min_samples_leaf", T.LongType()),
    T.StructField("model__n_estimators", T.LongType()),
])
RUN_METRICS_SCHEMA = T.StructType([
    T.StructField("run_ts", T.StringType()),
    T.StructField("today_local", T.StringType()),
    T.StructField("train_rows", T.LongType()),
    T.StructField("holdout_rows", T.LongType()),
    T.StructField("mae_today", T.DoubleType()),
    T.StructField("rmse_today", T.DoubleType()),
    T.StructField("mape_today", T.DoubleType()),
    T.StructField("bias_today", T.DoubleType()),
    T.StructField("best_cv_mae", T.DoubleType()),
    T.StructField("best_params", PARAMS_SCHEMA),
])
IMPORTANCE_SCHEMA = T.StructType([
    T.StructField("feature", T.StringType()),
    T.StructField("importance_mean", T.DoubleType()),
])
