"""Reading tables: typed CSV and Parquet, untyped CSV, first path that exists."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from arrearium.functions import expressions as X
from arrearium.schemas import DATE_COLUMNS, RAW_SCHEMAS
from arrearium.session import stored


def read_raw_tables(spark: SparkSession, folder: str, fmt: str = "csv") -> dict[str, DataFrame]:
    """The four raw tables; CSV files have fixed schemas and no scan is spent on inference."""
    out = {}
    for name, schema in RAW_SCHEMAS.items():
        if fmt == "csv":
            # one file <name>.csv, or a folder of part files <name>
            df = read_first_existing(
                spark, [f"{folder}/{name}.csv", f"{folder}/{name}"],
                lambda s, p, schema=schema: s.read.schema(schema).option("header", True).csv(p))
            for c in DATE_COLUMNS.get(name, ()):
                df = df.withColumn(c, X.parse_date(c))
        else:
            df = read_first_existing(spark, [f"{folder}/{name}.parquet", f"{folder}/{name}"])
        out[name] = df
    return out


def read_master(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


# From the narrowest type on: name, form of its texts, and whether a text is one. A column takes the first that all its values fit.
_NUMBER = r"^\s*[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?\s*$|^\s*(NaN|[+-]?Infinity|[+-]?Inf)\s*$"
_LATTICE = [
    ("boolean", r"(?i)^\s*(true|false)\s*$"), ("int", r"^\s*[+-]?\d{1,10}\s*$"), ("bigint", r"^\s*[+-]?\d{1,19}\s*$"), ("double", _NUMBER),
    ("date", r"^\s*\d{4}-\d{1,2}-\d{1,2}\s*$"), ("timestamp", r"^\s*\d{4}-\d{1,2}-\d{1,2}[ T]\d{1,2}:\d{2}"),
]


def infer_types(texts: DataFrame, columns: Sequence[str]) -> dict[str, str]:
    """The narrowest type of each text column that all its values have; string for a column without values.

    One aggregate of one row, which merges from tasks as it is a count for each column and type.
    """
    def fits(c: str, kind: str, form: str) -> Column:
        return F.col(f"`{c}`").isNull() | (F.col(f"`{c}`").rlike(form) & F.col(f"`{c}`").try_cast(kind).isNotNull())

    checks = [F.bool_and(fits(c, kind, form)).alias(f"{i}_{kind}") for i, c in enumerate(columns) for kind, form in _LATTICE]
    row = texts.agg(*checks, *[F.count(F.col(f"`{c}`")).alias(f"{i}_n") for i, c in enumerate(columns)]).first()
    found = {}
    for i, c in enumerate(columns):
        fitting = [kind for kind, _ in _LATTICE if row[f"{i}_{kind}"]]
        found[c] = fitting[0] if fitting and row[f"{i}_n"] else "string"
    return found


def read_untyped_csv(spark: SparkSession, path: str, rescue: str | None = None) -> DataFrame:
    """A CSV of unknown schema. The file is read once: its texts are stored by column, types are found there and cast.

    rescue names a column for the raw lines whose number of fields is wrong; such lines teach no types. Without it they are read as
    far as they go.
    """
    names = spark.read.option("header", True).csv(path).columns  # reads the first line
    schema = T.StructType([T.StructField(c, T.StringType()) for c in [*names, *([rescue] if rescue else [])]])
    reader = spark.read.schema(schema).option("header", True).option("mode", "PERMISSIVE")
    if rescue:
        reader = reader.option("columnNameOfCorruptRecord", rescue)
    texts = stored(reader.csv(path), "csv-texts")
    types = infer_types(texts.where(F.col(f"`{rescue}`").isNull()) if rescue else texts, names)
    # A broken line may hold anything in its fields: what does not fit becomes NULL, the line itself is kept.
    cells = [F.col(f"`{c}`") if types[c] == "string" else F.col(f"`{c}`").try_cast(types[c]).alias(c) for c in names]
    return texts.select(*cells, *([F.col(f"`{rescue}`")] if rescue else []))


def _by_suffix(spark: SparkSession, path: str) -> DataFrame:
    return read_untyped_csv(spark, path) if path.endswith(".csv") else spark.read.parquet(path)


def read_first_existing(spark: SparkSession, paths: Sequence[str], read=_by_suffix) -> DataFrame:
    """The first path that exists; other reading errors are not hidden."""
    for path in paths:
        try:
            return read(spark, path)
        except AnalysisException as e:
            if e.getCondition() != "PATH_NOT_FOUND":
                raise
    raise FileNotFoundError(f"none of these paths exists: {', '.join(paths)}")


def table_shapes(tables: Mapping[str, DataFrame]) -> DataFrame:
    """One row per table: its row and column count."""
    parts = [df.agg(F.count("*").alias("n_rows")).select(
        F.lit(name).alias("table_name"), "n_rows", F.lit(len(df.columns)).alias("n_columns"))
        for name, df in tables.items()]
    return reduce(DataFrame.unionByName, parts)
