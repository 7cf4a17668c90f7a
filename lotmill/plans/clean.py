"""The cleaning workflow: coerce, filter, impute, cap, deduplicate, drop incomplete rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lotmill import rules
from lotmill.operators.fixed import Fixed
from lotmill.functions.numeric import to_integer, to_number
from lotmill.functions.text import fold, hyphenate, lookup_or_self, only_word_characters, unless_dropped, without_punctuation
from lotmill.operators.copies import drop_copies
from lotmill.operators.filters import cap_outliers, remove_invalid
from lotmill.operators.lookups import attach
from lotmill.operators.order_stats import quantile_row
from lotmill.operators.project import require_columns
from lotmill.operators.quality import rule_violations
from lotmill.session import kept


def coerce(df: DataFrame, columns: Sequence[str] = rules.LISTING_COLUMNS) -> DataFrame:
    """Expected layout, numeric types (bad text -> null), folded text without placeholders.

    Each text step is its own projection: a value used several times in the next step would
    otherwise be written out, and computed, once per use.
    """
    df = require_columns(df, columns)
    texts = [c for c in rules.TEXT_COLUMNS if c in df.columns]
    typed = {c: to_number(c) for c in ("power", "kilometer", "price")}
    typed["yearOfRegistration"] = to_integer("yearOfRegistration")
    typed.update({c: fold(c) for c in texts})
    return df.withColumns(typed).withColumns({c: _unless_placeholder(c) for c in texts})


def _unless_placeholder(column: str):
    return F.when(~F.col(column).isin(rules.MISSING_PLACEHOLDERS), F.col(column))


CATEGORY_ALIASES = {
    "vehicleType": rules.VEHICLE_ALIASES, "fuelType": rules.FUEL_ALIASES,
    "seller": rules.SELLER_ALIASES, "gearbox": rules.GEARBOX_ALIASES,
}


def normalise_text(df: DataFrame) -> DataFrame:
    """Brand, model and category spelling of folded text, in three projections (see :func:`coerce`)."""
    spelled = {"brand": only_word_characters(hyphenate("brand", "_")), "model": hyphenate("model", "_")}
    spelled.update({c: hyphenate(c, "_", " ") for c in CATEGORY_ALIASES})
    named = {
        "brand": unless_dropped("brand", rules.BRANDS_TO_DROP, rules.BRAND_ALIASES),
        "model": unless_dropped("model", rules.MODELS_TO_DROP, rules.MODEL_ALIASES),
    }
    named.update({c: lookup_or_self(c, aliases) for c, aliases in CATEGORY_ALIASES.items()})
    return df.withColumns(spelled).withColumns(named).withColumn("model", without_punctuation("model"))


def fill_tables(df: DataFrame, group: str, columns: Sequence[str], constant: dict[str, str]) -> tuple[DataFrame, DataFrame]:
    """(mode per group wide, one-row table of fallbacks), both from one count of the data.

    The count per (group, column, value) combines map-side. Group modes and the overall modes,
    which are taken after the group fill, are both derived from it, so the data is read once.
    """
    cells = df.select(group, *columns).unpivot([group], list(columns), "column", "value")
    counted = cells.groupBy(group, "column", "value").agg(F.count(F.lit(1)).alias("n")).persist(StorageLevel.MEMORY_AND_DISK)
    smallest_of_most = F.min(F.when(F.col("value").isNotNull(), F.struct((-F.col("n")).alias("n"), F.col("value").alias("v"))))
    modes = (
        counted.where(F.col(group).isNotNull()).groupBy(group, "column")
        .agg(F.coalesce(smallest_of_most["v"], F.lit("unknown")).alias("mode"))
    )
    filled = attach(counted, modes, [group, "column"]).select("column", F.coalesce("value", "mode").alias("value"), "n")
    overall = filled.where(F.col("value").isNotNull()).groupBy("column", "value").agg(F.sum("n").alias("n"))
    fallback = overall.groupBy("column").agg(smallest_of_most["v"].alias("mode"))
    pick = lambda c: F.max(F.when(F.col("column") == c, F.col("mode")))
    wide = modes.groupBy(group).agg(*[pick(c).alias(f"_{c}") for c in columns])
    final = fallback.agg(*[
        F.lit(constant[c]).alias(c) if c in constant else F.coalesce(pick(c), F.lit("unknown")).alias(c) for c in columns
    ])
    return wide, final


def impute(df: DataFrame, numeric: Sequence[str] = ("power", "yearOfRegistration")) -> DataFrame:
    """Normalise the text columns and fill the gaps (see :func:`fill_gaps`)."""
    folded = df.withColumns({c: fold(c) for c in rules.TEXT_COLUMNS if c in df.columns and c != "dataSource"})
    return fill_gaps(normalise_text(folded).persist(StorageLevel.MEMORY_AND_DISK), numeric)


def fill_gaps(df: DataFrame, numeric: Sequence[str] = ("power", "yearOfRegistration")) -> DataFrame:
    """Fill text columns by the brand's mode, then by a fallback; numbers by their median.

    ``brand`` itself is never filled. Pass ``numeric=()`` when earlier steps rule out nulls there.
    The frame is read twice, so callers persist it when it is expensive to compute.
    """
    targets = [c for c in rules.TEXT_COLUMNS if c != "brand" and c in df.columns]
    wide, final = fill_tables(df, "brand", targets, {"model": "unknown"})
    fallback = Fixed(final)
    joined = attach(df, wide, ["brand"])
    values = {c: F.coalesce(F.col(c), F.col(f"_{c}"), fallback.getField(c)) for c in targets}
    numeric = [c for c in numeric if c in df.columns]
    if numeric:
        medians = quantile_row(df.select(*numeric), numeric, {"median": 0.5})
        for c in numeric:
            values[c] = F.coalesce(F.col(c), medians.getField(f"{c}_median").cast(df.schema[c].dataType))
    return joined.withColumns(values).select(*df.columns)


def clean(df: DataFrame, use_iqr_capping: bool = True) -> DataFrame:
    """The whole chain on a merged table. Duplicates are removed after capping, as capping makes some.

    The valid, normalised rows are needed three times (counts for the fill values, quantiles, the
    result itself) and are kept for that; the copy also keeps later null filters from being pushed
    down into, and repeating, the text expressions.
    """
    ready = kept(normalise_text(remove_invalid(coerce(df))), "valid")
    done = fill_gaps(ready, numeric=())  # the domain filter leaves no null numbers
    if use_iqr_capping:
        done = cap_outliers(done, ["power", "kilometer", "yearOfRegistration"], statistics_from=ready)
    return drop_copies(done.dropna(how="any"))


def clean_table(spark, in_path: str, out_path: str, in_format: str = "parquet", out_format: str = "parquet",
                use_iqr_capping: bool = True) -> dict:
    """Read, clean, write, and report the rule violations before and after."""
    from lotmill.sources.tables import read_table, write_table

    raw = read_table(spark, in_path, in_format)
    before = rule_violations(coerce(raw))
    write_table(clean(raw, use_iqr_capping), out_path, out_format)
    done = read_table(spark, out_path, out_format)
    if out_format == "csv":
        done = coerce(done)
    return {
        "raw_rows": raw.count(), "clean_rows": done.count(),
        "violations_before": [r.asDict() for r in before.collect()],
        "violations_after": [r.asDict() for r in rule_violations(done).collect()],
    }
