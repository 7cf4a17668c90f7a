"""CSV / parquet tables, lookup dictionaries, result tables, saved pages."""

from __future__ import annotations

import json
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lotmill import rules


def csv_header(spark: SparkSession, path: str, encoding: str = "UTF-8") -> list[str]:
    reader = spark.read.option("header", True).option("inferSchema", False).option("encoding", encoding)
    return reader.csv(path).columns


def read_csv(spark: SparkSession, path: str, columns: Sequence[str] | None = None, encoding: str = "UTF-8",
             null_tokens: Sequence[str] = rules.CSV_NULL_TOKENS, multi_line: bool = False) -> DataFrame:
    """CSV with a header, every column as text, 'missing' tokens as null.

    Types are not inferred (that would be another pass over the data); numeric coercion is a
    projection of the cleaning step, and :func:`read_typed_csv` makes that pass. ``columns`` skips the header peek. A file whose header differs is an
    error, as its values would land under other names. ``multi_line`` reads values with line breaks; a file is
    then not split over tasks.
    """
    names = list(columns) if columns else csv_header(spark, path, encoding)
    schema = T.StructType([T.StructField(n, T.StringType()) for n in names])
    reader = spark.read.schema(schema).option("header", True).option("encoding", encoding)
    reader = reader.option("quote", '"').option("escape", '"').option("enforceSchema", False).option("multiLine", multi_line)
    df = reader.csv(path)
    tokens = list(null_tokens)
    return df.select(*[F.when(~F.col(f"`{c}`").isin(tokens), F.col(f"`{c}`")).alias(c) for c in df.columns])


#: type names in the order of the lattice: a column takes the first one that holds all its values, else text
TYPES = ("boolean", "bigint", "double")


def _fits(text: Column) -> dict[str, Column]:
    """Whether a value reads as each type. Whole numbers need digits only and 64 bits; numbers may have a point, an
    exponent or be inf; numbers keep blanks around them, booleans do not."""
    plain = F.trim(text)
    whole = plain.rlike(r"^[+-]?[0-9]+$") & plain.try_cast("bigint").isNotNull()
    number = plain.rlike(r"(?i)^[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)(e[+-]?[0-9]+)?$|^[+-]?inf(inity)?$")
    fits = {"boolean": text.isin("True", "TRUE", "true", "False", "FALSE", "false"), "bigint": whole, "double": number}
    return {kind: F.when(text.isNotNull(), fit) for kind, fit in fits.items()}


def inferred_types(df: DataFrame) -> dict[str, str]:
    """Type of every text column from all its values, in one aggregation: boolean, bigint, double or string.

    The flags of a column merge by AND, so the result depends neither on the order nor on the partitioning of the rows. Whole
    numbers beside other numbers give double; any other mix gives string. A column without a value gives double, as a
    reader of such files would. Columns that are not text keep their type and are left out.
    """
    names = [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]
    if not names:
        return {}
    cells = [F.bool_and(fit).alias(f"{i}_{kind}") for i, c in enumerate(names) for kind, fit in _fits(F.col(f"`{c}`")).items()]
    row = df.agg(*cells).first()
    found = {}
    for i, c in enumerate(names):
        flags = {kind: row[f"{i}_{kind}"] for kind in TYPES}
        found[c] = "double" if flags["double"] is None else next((kind for kind in TYPES if flags[kind]), "string")
    return found


def with_types(df: DataFrame, types: Mapping[str, str]) -> DataFrame:
    """Text columns as their inferred types; columns that are not named stay."""

    def cast(c: str) -> Column:
        text = F.col(f"`{c}`")
        kind = types.get(c, "string")
        if kind == "string":
            return text
        value = F.lower(text) == "true" if kind == "boolean" else F.trim(text).try_cast(kind)
        return value.alias(c)

    return df.select(*[cast(c) for c in df.columns])


def read_typed_csv(spark: SparkSession, path: str, columns: Sequence[str] | None = None, encoding: str = "UTF-8",
                   null_tokens: Sequence[str] = rules.CSV_NULL_TOKENS, multi_line: bool = False) -> DataFrame:
    """As :func:`read_csv`, with types found from all values (a second pass over the file)."""
    raw = read_csv(spark, path, columns, encoding, null_tokens, multi_line)
    return with_types(raw, inferred_types(raw))


def read_table(spark: SparkSession, path: str, fmt: str = "parquet", required: Sequence[str] = ()) -> DataFrame:
    """Table with an existence check and a required-column check."""
    if not path_exists(spark, path):
        raise FileNotFoundError(path)
    df = read_csv(spark, path) if fmt == "csv" else spark.read.format(fmt).load(path)
    missing = [c for c in required if c not in df.columns]
    if missing:
        raise ValueError(f"missing required columns: {missing}")
    return df


def path_exists(spark: SparkSession, path: str) -> bool:
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop.getFileSystem(spark._jsc.hadoopConfiguration()).exists(hadoop)


def write_table(df: DataFrame, path: str, fmt: str = "parquet", partition_by: Sequence[str] = (), mode: str = "overwrite") -> None:
    """Parquet by default; CSV gets a header and no index column."""
    writer = df.write.mode(mode).format(fmt)
    if fmt == "csv":
        # the writer would otherwise trim values, which turns ' N/A ' into a missing token
        writer = writer.option("header", True).option("escape", '"')
        writer = writer.option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.save(path)


def append_run(spark: SparkSession, path: str, run: Mapping) -> None:
    """One row per training run: name, parameters and metrics."""
    params = {k: str(v) for k, v in (run.get("best_params") or {}).items()}
    metrics = {k: float(v) for k, v in run.items() if isinstance(v, (int, float))}
    row = [(run["model"], run["dataset"], params, metrics)]
    schema = "model string, dataset string, params map<string,string>, metrics map<string,double>"
    rows = spark.createDataFrame(row, schema).withColumn("logged_at", F.current_timestamp())
    write_table(rows, path, mode="append")


def read_lookup(spark: SparkSession, path: str, key: str = "key", value: str = "value") -> DataFrame:
    """JSON object -> (key, value) rows; JSON array -> (key) rows. These files are configuration."""
    text = "\n".join(r["value"] for r in spark.read.text(path, wholetext=True).collect())
    entries = json.loads(text)
    if isinstance(entries, dict):
        return spark.createDataFrame([(k, str(v)) for k, v in entries.items()], f"{key} string, {value} string")
    return spark.createDataFrame([(str(v),) for v in entries], f"{key} string")


def read_pages(spark: SparkSession, path: str) -> DataFrame:
    """Saved pages: one row per page with its address and markup."""
    return read_table(spark, path, required=("url", "html")).select("page_id", "url", "html")


def write_text(text: str, path: str, spark: SparkSession) -> None:
    """A small report as one text file on any file system Spark can reach."""
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(path)
    stream = hadoop.getFileSystem(spark._jsc.hadoopConfiguration()).create(hadoop, True)
    try:
        stream.write(bytearray(text, "utf-8"))
    finally:
        stream.close()


def export_split(df: DataFrame, path: str, label: str = "price_tier", fmt: str = "parquet") -> None:
    """Features, label and ``split``, laid out by split."""
    if label not in df.columns or "split" not in df.columns:
        raise ValueError("export needs the label and a 'split' column")
    write_table(df, path, fmt, partition_by=["split"])
