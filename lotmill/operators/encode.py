"""Feature stages for ``pyspark.ml`` pipelines; every fitted stage can be saved and loaded."""

from __future__ import annotations

import json
from collections.abc import Sequence

from pyspark import keyword_only
from pyspark.ml import Estimator, Model, Transformer
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.util import (
    DefaultParamsReadable, DefaultParamsReader, DefaultParamsWritable, DefaultParamsWriter, MLReadable, MLReader, MLWritable, MLWriter,
)
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lotmill.functions.numeric import known, per_unit, to_number, vehicle_age
from lotmill.operators.fixed import Fixed
from lotmill.operators.lookups import attach, frequency_table
from lotmill.operators.order_stats import quantile_row

MAX_LEVELS = 1_000


class ListingFeatures(Transformer, DefaultParamsReadable, DefaultParamsWritable):
    """Age, mileage per year, mileage per power and log mileage; drops the year."""

    currentYear = Param(Params._dummy(), "currentYear", "year the age is counted to", TypeConverters.toInt)

    @keyword_only
    def __init__(self, *, currentYear: int | None = None):
        super().__init__()
        self._set(**self._input_kwargs)

    def _transform(self, df: DataFrame) -> DataFrame:
        km = to_number("kilometer")
        age = vehicle_age("yearOfRegistration", self.getOrDefault(self.currentYear))
        return df.withColumns({
            "vehicleAge": age, "kmPerYear": per_unit("kilometer", age),
            "km_power_ratio": per_unit("kilometer", to_number("power")), "log_km": F.log1p(km),
        }).drop("yearOfRegistration")


def documented_features(df: DataFrame, current_year: int) -> DataFrame:
    """Further features the project documents mention: flags, log power, power per (clipped) year of age."""
    age = F.greatest(F.lit(0), vehicle_age("yearOfRegistration", current_year))
    return df.withColumns({
        "isAutomatic": (F.col("gearbox") == "automatic").cast("int"),
        "isVintageClassic": (age >= 30).cast("int"),
        "log_power": F.log1p("power"),
        "power_per_age": F.col("power") / (age + 1),
        "powerTierBin": F.when(F.col("power") < 100, "low").when(F.col("power") < 200, "mid").otherwise("high"),
    })


class DropColumns(Transformer, DefaultParamsReadable, DefaultParamsWritable):
    """Drops columns; absent ones are ignored."""

    cols = Param(Params._dummy(), "cols", "columns to drop", TypeConverters.toListString)

    @keyword_only
    def __init__(self, *, cols: Sequence[str] = ()):
        super().__init__()
        self._set(**self._input_kwargs)

    def _transform(self, df: DataFrame) -> DataFrame:
        return df.drop(*self.getOrDefault(self.cols))


class _Columns(Params):
    cols = Param(Params._dummy(), "cols", "columns to encode", TypeConverters.toListString)
    unseen = Param(Params._dummy(), "unseen", "frequency of values not seen while fitting", TypeConverters.toFloat)


class FrequencyEncoder(Estimator, _Columns, DefaultParamsReadable, DefaultParamsWritable):
    """Learns the relative frequency of the values of each column."""

    @keyword_only
    def __init__(self, *, cols: Sequence[str] = (), unseen: float = 0.0):
        super().__init__()
        self._setDefault(unseen=0.0)
        self._set(**self._input_kwargs)

    def _fit(self, df: DataFrame) -> "FrequencyEncoderModel":
        tables = [
            frequency_table(df, c).select(F.lit(c).alias("column"), F.col(c).cast("string").alias("value"), "freq")
            for c in self.getOrDefault(self.cols) if c in df.columns
        ]
        table = None
        for t in tables:
            table = t if table is None else table.unionByName(t)
        if table is None:
            table = df.sparkSession.createDataFrame([], "column string, value string, freq double")
        model = FrequencyEncoderModel(table.persist())
        return self._copyValues(model)


class FrequencyEncoderModel(Model, _Columns, MLReadable, MLWritable):
    """Adds ``<column>_freq``. The learned table stays a table: it grows with the distinct values."""

    def __init__(self, table: DataFrame | None = None):
        super().__init__()
        self._setDefault(unseen=0.0)
        self.table = table

    def _transform(self, df: DataFrame) -> DataFrame:
        unseen = F.lit(self.getOrDefault(self.unseen))
        for c in self.getOrDefault(self.cols):
            name = f"{c}_freq"
            if c not in df.columns:
                df = df.withColumn(name, F.lit(0.0))
                continue
            learned = self.table.where(F.col("column") == c).select(F.col("value").alias(c), F.col("freq").alias(name))
            df = attach(df, learned, [c]).withColumn(name, F.coalesce(name, unseen))
        return df

    def write(self) -> MLWriter:
        return _TableWriter(self)

    @classmethod
    def read(cls) -> MLReader:
        return _TableReader(cls)


class _TableWriter(MLWriter):
    def __init__(self, instance):
        super().__init__()
        self.instance = instance

    def saveImpl(self, path: str) -> None:
        DefaultParamsWriter.saveMetadata(self.instance, path, self.sparkSession)
        self.instance.table.write.mode("overwrite").parquet(f"{path}/table")


class _TableReader(MLReader):
    def __init__(self, cls):
        super().__init__()
        self.cls = cls

    def load(self, path: str):
        metadata = DefaultParamsReader.loadMetadata(path, self.sparkSession)
        instance = self.cls(self.sparkSession.read.parquet(f"{path}/table"))
        instance._resetUid(metadata["uid"])
        DefaultParamsReader.getAndSetParams(instance, metadata)
        return instance


class DummyEncoder(Estimator, _Columns, DefaultParamsReadable, DefaultParamsWritable):
    """0/1 column per level, alphabetically first level left out."""

    @keyword_only
    def __init__(self, *, cols: Sequence[str] = ()):
        super().__init__()
        self._set(**self._input_kwargs)

    def _fit(self, df: DataFrame) -> "DummyEncoderModel":
        columns = self.getOrDefault(self.cols)
        long = df.select(*[F.col(c).cast("string").alias(c) for c in columns]).unpivot([], list(columns), "column", "value")
        rows = long.where(F.col("value").isNotNull()).distinct().limit(MAX_LEVELS * len(columns) + 1).collect()
        levels = {c: sorted(r["value"] for r in rows if r["column"] == c) for c in columns}
        for c, found in levels.items():
            if len(found) > MAX_LEVELS:
                raise ValueError(f"'{c}' has more than {MAX_LEVELS} levels; use the frequency encoder")
        return self._copyValues(DummyEncoderModel(levels=json.dumps(levels)))


class DummyEncoderModel(Model, _Columns, DefaultParamsReadable, DefaultParamsWritable):
    """Unseen levels and nulls are all-zero, also in a batch of one row."""

    levels = Param(Params._dummy(), "levels", "levels per column as JSON", TypeConverters.toString)

    @keyword_only
    def __init__(self, *, levels: str | None = None):
        super().__init__()
        self._set(**self._input_kwargs)

    def output_columns(self) -> list[str]:
        return [f"{c}_{v}" for c, found in json.loads(self.getOrDefault(self.levels)).items() for v in found[1:]]

    def _transform(self, df: DataFrame) -> DataFrame:
        levels = json.loads(self.getOrDefault(self.levels))
        dummies = [
            F.coalesce((F.col(c).cast("string") == v).cast("int"), F.lit(0)).alias(f"{c}_{v}")
            for c, found in levels.items() for v in found[1:]
        ]
        return df.select(*[F.col(f"`{c}`") for c in df.columns if c not in levels], *dummies)


def impute_and_scale(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Exact-median fill, then standardise (population deviation, constant columns only centred)."""
    medians = quantile_row(df, columns, {"median": 0.5})
    filled = df.withColumns({c: F.coalesce(F.col(c).cast("double"), medians.getField(f"{c}_median")) for c in columns})
    stats = Fixed(filled.agg(*[F.avg(c).alias(f"{c}_m") for c in columns], *[F.stddev_pop(c).alias(f"{c}_s") for c in columns]))
    return filled.withColumns({
        c: (F.col(c) - stats.getField(f"{c}_m")) / F.coalesce(F.nullif(stats.getField(f"{c}_s"), F.lit(0.0)), F.lit(1.0)) for c in columns
    })


class Preprocessor:
    """Fills and scales numbers, fills categories by their most frequent value, and sets a 0/1 entry per level.

    Numbers: missing ones take the exact median of the fitted table, then mean 0 and population deviation 1 (constant
    columns become 0). Categories: missing ones take the most frequent value, ties the smallest; levels are those of the
    filled fitted table in order of name, and an unseen value gets no entry. The entries are the places of the
    ones in increasing order (a sparse row), so the number of levels sets no width of the table. A column without any value keeps its nulls and has no levels.
    """

    def __init__(self, numeric: Sequence[str], categorical: Sequence[str], output: str = "levels"):
        self.numeric, self.categorical, self.output = list(numeric), list(categorical), output

    def fit(self, df: DataFrame) -> "Preprocessor":
        names = {f"n{i}": c for i, c in enumerate(self.numeric)}
        numbers = df.select(*[F.col(f"`{c}`").cast("double").alias(n) for n, c in names.items()])
        if names:
            medians = quantile_row(numbers, list(names), {"median": 0.5})
            self.medians = {c: medians.value(f"{n}_median") for n, c in names.items()}
            filled = [F.coalesce(known(n), F.lit(self.medians[c]).cast("double")) for n, c in names.items()]
            row = numbers.agg(*[F.struct(F.avg(v).alias("m"), F.stddev_pop(v).alias("s")).alias(n) for n, v in zip(names, filled)]).first()
            self.scales = {c: (row[n]["m"], row[n]["s"] or 1.0) for n, c in names.items()}
        self.levels, self.modes = {}, {}
        if self.categorical:
            cells = {f"c{i}": c for i, c in enumerate(self.categorical)}
            long = df.select(*[F.col(f"`{c}`").cast("string").alias(n) for n, c in cells.items()]).unpivot([], list(cells), "column", "value")
            # the levels of the categories, which the vector needs by name on the driver
            rows = long.where("value IS NOT NULL").groupBy("column", "value").agg(F.count(F.lit(1)).alias("n")).collect()
            for n, c in cells.items():
                own = sorted((r["value"], r["n"]) for r in rows if r["column"] == n)
                self.levels[c] = [v for v, _ in own]
                self.modes[c] = min(own, key=lambda e: (-e[1], e[0]))[0] if own else None
        return self

    def transform(self, df: DataFrame) -> DataFrame:
        """Columns of their names replaced, ``output`` added: levels of the first category first."""
        new = {}
        for c in self.numeric:
            mean, scale = self.scales[c]
            value = F.coalesce(known(F.col(f"`{c}`").cast("double")), F.lit(self.medians[c]).cast("double"))
            new[c] = (value - F.lit(mean).cast("double")) / F.lit(scale).cast("double")
        for c in self.categorical:
            new[c] = F.coalesce(F.col(f"`{c}`").cast("string"), F.lit(self.modes[c]).cast("string"))
        out = df.withColumns(new)
        start, entries = 0, []
        for c in self.categorical:
            levels = self.levels[c]
            place = F.array_position(F.array(*[F.lit(v) for v in levels]), F.col(f"`{c}`")) if levels else F.lit(0)
            entries.append(F.when(place > 0, (place - 1 + start).cast("int")))
            start += len(levels)
        return out.withColumn(self.output, F.array_compact(F.array(*entries)) if entries else F.array().cast("array<int>"))

    def level_names(self) -> list[str]:
        """Names of the places that ``output`` holds."""
        return [f"{c}_{v}" for c in self.categorical for v in self.levels[c]]


CATEGORIES = ["vehicleType", "gearbox", "fuelType", "seller", "dataSource"]


def feature_stages(current_year: int, categories: Sequence[str] = CATEGORIES) -> list:
    """The stages from cleaned listings to flat numeric features."""
    return [
        ListingFeatures(currentYear=current_year), FrequencyEncoder(cols=["brand", "model"]),
        DropColumns(cols=["brand", "model"]), DummyEncoder(cols=list(categories)),
    ]


def feature_columns(df: DataFrame, exclude: Sequence[str] = ("price", "price_tier", "label", "split")) -> list[str]:
    """Numeric columns that may serve as features."""
    from lotmill.operators.profile import numeric_columns

    return [c for c in numeric_columns(df) if c not in exclude]


