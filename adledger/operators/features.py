"""Feature preparation. What is fitted is small (a number or a vocabulary per
column); what is applied is a projection, so applying never shuffles."""

from __future__ import annotations

import json
from collections.abc import Sequence

from pyspark.ml import Estimator, Model
from pyspark.ml.feature import IndexToString, StringIndexer
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from ..functions.text import split_tokens
from .dictionary import SHORT, Dictionary, fit_dictionary, sparse_vector, unit_array, with_size
from .quantiles import quantiles_of

# Text vocabulary size, sequence length, ids of padding and unknown.
MAX_TOKENS, SEQUENCE_LENGTH = 5000, 150
PAD_ID, UNKNOWN_ID, FIRST_TOKEN_ID = 0, 1, 2


# ---- imputation and scaling -------------------------------------------------

def fit_medians(train: DataFrame, columns: Sequence[str]) -> dict[str, float | None]:
    """Exact medians; None marks a column without any value."""
    return {c: q[0] for c, q in quantiles_of(train, columns, [0.5]).items()}


def fill_values(df: DataFrame, values: dict) -> DataFrame:
    """Replace NULL (and NaN) by the fitted value; columns fitted as None stay as they are."""
    numeric = {f.name for f in df.schema.fields if f.dataType.typeName() in ("double", "float")}
    fixes = {}
    for c, v in values.items():
        if v is not None:
            known = F.nanvl(F.col(c), F.lit(None).cast("double")) if c in numeric else F.col(c)
            fixes[c] = F.coalesce(known, F.lit(v))
    return df.withColumns(fixes) if fixes else df


def impute_median(train: DataFrame, df: DataFrame, columns: Sequence[str]) -> DataFrame:
    as_double = df.withColumns({c: F.col(c).cast("double") for c in columns})
    return fill_values(as_double, fit_medians(train, columns))


def fit_modes(train: DataFrame, columns: Sequence[str]) -> dict[str, str | None]:
    """Most frequent value per column, smallest value on ties.

    All columns are counted in one shuffle of (column, value) pairs, pre-summed
    per task; the ranking keeps one row per column and task before it shuffles.
    """
    pairs = train.select(F.inline(F.array(*[
        F.struct(F.lit(c).alias("column"), F.col(c).cast("string").alias("value")) for c in columns
    ]))).where(F.col("value").isNotNull())
    counts = pairs.groupBy("column", "value").count()
    best = Window.partitionBy("column").orderBy(F.desc("count"), F.asc("value"))
    top = counts.withColumn("_rn", F.row_number().over(best)).where("_rn = 1")
    found = {r["column"]: r["value"] for r in top.select("column", "value").collect()}
    return {c: found.get(c) for c in columns}


def impute_mode(train: DataFrame, df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return fill_values(df, fit_modes(train, columns))


def fit_scale(train: DataFrame, columns: Sequence[str]) -> dict[str, tuple[float, float]]:
    """Mean and population deviation; a deviation of 0 counts as 1."""
    row = train.agg(*[x for c in columns for x in (
        F.avg(c).alias(f"m_{c}"), F.stddev_pop(c).alias(f"s_{c}"))]).first()
    return {c: (row[f"m_{c}"], row[f"s_{c}"] or 1.0) for c in columns}


def apply_scale(df: DataFrame, scale: dict[str, tuple[float, float]]) -> DataFrame:
    return df.withColumns({c: (F.col(c) - F.lit(m)) / F.lit(s) for c, (m, s) in scale.items()})


def standard_scale(train: DataFrame, df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return apply_scale(df, fit_scale(train, columns))


# ---- encoding ---------------------------------------------------------------

def label_encoder(train: DataFrame, column: str, out: str = "label"):
    """Alphabetical class -> index."""
    return StringIndexer(inputCol=column, outputCol=out, stringOrderType="alphabetAsc",
                         handleInvalid="error").fit(train)


def label_encode(train: DataFrame, df: DataFrame, column: str, out: str = "label") -> DataFrame:
    return label_encoder(train, column, out).transform(df)


def label_decode(df: DataFrame, labels: Sequence[str], column: str, out: str) -> DataFrame:
    return IndexToString(inputCol=column, outputCol=out, labels=list(labels)).transform(df)


def one_hot(train: DataFrame, df: DataFrame, columns: Sequence[str], suffix: str = "_vec") -> DataFrame:
    """Training categories as sparse 0/1 vectors; a category not seen in training is all zeros."""
    known = fit_dictionary(train, columns)
    hot = lambda c: F.when(F.col(f"{c}__at").isNotNull(), F.array(f"{c}__at")).otherwise(F.array().cast("array<long>"))
    vectors = [with_size(sparse_vector(known.sizes[c], hot(c), F.transform(hot(c), lambda _: F.lit(1.0))), f"{c}{suffix}", known.sizes[c]) for c in columns]
    return known.number(df, columns, "__at").select(*df.columns, *vectors)


class ColumnTransform(Estimator):
    """Numeric branch (median, optional scaling) and categorical branch (mode, one-hot)
    assembled into one vector. Columns without any training value are left out."""

    def __init__(self, numeric: Sequence[str], categorical: Sequence[str], scale: bool = False,
                 out: str = "features"):
        super().__init__()
        self.numeric, self.categorical = list(numeric), list(categorical)
        self.scale, self.out = scale, out

    def _fit(self, df: DataFrame) -> "ColumnTransformModel":
        medians = fit_medians(df, self.numeric)
        modes = fit_modes(df, self.categorical) if self.categorical else {}
        numeric = [c for c in self.numeric if medians[c] is not None]
        categorical = [c for c in self.categorical if modes[c] is not None]
        model = ColumnTransformModel(numeric, categorical, medians, modes, {}, None, self.out)
        filled = model.fill(df)
        if self.scale and numeric:
            model.scale = fit_scale(filled, numeric)
        if categorical:
            model.dictionary = fit_dictionary(filled, categorical)
        return model


class ColumnTransformModel(Model):
    """One vector, sparse if it is long: the numeric columns, then a 0/1 entry per category of each column."""

    def __init__(self, numeric, categorical, medians, modes, scale, dictionary, out):
        super().__init__()
        self.numeric, self.categorical = numeric, categorical
        self.medians, self.modes, self.scale = medians, modes, scale
        self.dictionary, self.out = dictionary, out

    @property
    def starts(self) -> dict[str, int]:
        """Index of the first category of each column."""
        at, starts = len(self.numeric), {}
        for c in self.categorical:
            starts[c] = at
            at += self.dictionary.sizes[c]
        return starts

    @property
    def width(self) -> int:
        return len(self.numeric) + sum(self.dictionary.sizes[c] for c in self.categorical)

    def categories(self, column: str, indices: Sequence[int]) -> list[str]:
        """Categories of a column that these entries of the vector stand for."""
        first = self.starts[column]
        return self.dictionary.values(column, [i - first for i in indices if first <= i < first + self.dictionary.sizes[column]])

    def save(self, path: str) -> None:
        """Write the fitted preparation to a new folder."""
        if self.dictionary:
            self.dictionary.save(f"{path}/dictionary")
        own = {k: getattr(self, k) for k in ("numeric", "categorical", "medians", "modes", "scale", "out")}
        own["sizes"] = self.dictionary.sizes if self.dictionary else None
        SparkSession.active().range(1).select(F.lit(json.dumps(own))).write.text(f"{path}/about")

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> "ColumnTransformModel":
        own = json.loads(spark.read.text(f"{path}/about").first()[0])
        sizes = own.pop("sizes")
        return cls(dictionary=Dictionary.load(spark, f"{path}/dictionary", sizes) if sizes else None, **own)

    def fill(self, df: DataFrame) -> DataFrame:
        df = df.withColumns({c: F.col(c).cast("double") for c in self.numeric})
        return fill_values(df, {c: self.medians[c] for c in self.numeric}
                           | {c: self.modes[c] for c in self.categorical})

    def _transform(self, df: DataFrame) -> DataFrame:
        # Raw columns keep their values; filled copies live only inside.
        raw = {f"__raw_{i}": c for i, c in enumerate(df.columns)}
        kept = self.fill(df.select("*", *[F.col(c).alias(r) for r, c in raw.items()]))
        if self.categorical:
            kept = self.dictionary.number(kept, self.categorical, "__at")
        starts = self.starts

        def scaled(c: str) -> Column:
            m, s = self.scale.get(c, (0.0, 1.0))
            return (F.col(c) - F.lit(m)) / F.lit(s)

        numbers = F.array(*map(scaled, self.numeric)) if self.numeric else F.array().cast("array<double>")
        if self.width <= SHORT:
            vector = array_to_vector(F.concat(numbers, *[unit_array(self.dictionary.sizes[c], F.col(f"{c}__at")) for c in self.categorical]))
        else:
            hot = F.array_compact(F.array(*[F.col(f"{c}__at") + F.lit(starts[c]) for c in self.categorical])) if self.categorical else F.array().cast("array<long>")
            indices = F.concat(F.array(*[F.lit(i).cast("long") for i in range(len(self.numeric))]).cast("array<long>"), hot)
            vector = sparse_vector(self.width, indices, F.concat(numbers, F.transform(hot, lambda _: F.lit(1.0))))
        return kept.select(*[F.col(r).alias(c) for r, c in raw.items() if c != self.out], with_size(vector, self.out, self.width))


def column_transform(train: DataFrame, df: DataFrame, numeric: Sequence[str],
                     categorical: Sequence[str], scale: bool = False) -> DataFrame:
    return ColumnTransform(numeric, categorical, scale).fit(train).transform(df)


# ---- text -------------------------------------------------------------------

def text_vocab(df: DataFrame, text: str, max_tokens: int = MAX_TOKENS) -> DataFrame:
    """Most frequent tokens with their ids, ties by token.

    Padding and the unknown id take two of the ``max_tokens`` places. Tokens are
    counted per task first, so a token found everywhere is no hot spot, and the
    final ranking sees at most ``max_tokens`` rows.
    """
    counts = df.select(F.explode(split_tokens(text)).alias("token")).groupBy("token").count()
    top = counts.orderBy(F.desc("count"), "token").limit(max_tokens - FIRST_TOKEN_ID)
    place = F.row_number().over(Window.orderBy(F.desc("count"), "token"))
    return top.withColumn("id", (place + FIRST_TOKEN_ID - 1).cast("int"))


def vocab_lookup(vocab: DataFrame, buckets: int = 1024) -> Column:
    """Constant array of small maps token -> id, a token being in the map its hash names.

    Spark searches a map entry by entry; split up like this a lookup looks at a few
    entries only. ``vocab`` comes from `text_vocab`, so it has fewer rows than
    ``max_tokens`` whatever the size of the data.
    """
    table: list[dict[str, int]] = [{} for _ in range(buckets)]
    for r in vocab.select("token", "id", _bucket(F.col("token"), buckets).alias("b")).collect():
        table[r["b"]][r["token"]] = r["id"]
    return F.from_json(F.lit(json.dumps(table)), "array<map<string,int>>")


def _bucket(token: Column, buckets: int) -> Column:
    return F.pmod(F.hash(token), F.lit(buckets))


def text_sequence(df: DataFrame, vocab: DataFrame, text: str, out: str = "token_ids",
                  length: int = SEQUENCE_LENGTH, buckets: int = 1024) -> DataFrame:
    """The first ``length`` tokens of each text as ids, padded to ``length``. One projection."""
    lookup = vocab_lookup(vocab, buckets)
    ids = F.transform(split_tokens(text, length), lambda t: F.coalesce(
        F.try_element_at(F.get(lookup, _bucket(t, buckets)), t), F.lit(UNKNOWN_ID)))
    padded = F.concat(ids, F.array_repeat(F.lit(PAD_ID), F.lit(length)))
    return df.withColumn(out, F.slice(padded, 1, length))
