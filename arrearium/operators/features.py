"""Feature engineering: encoding, scaling, splits and class weights."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import (OneHotEncoder, StandardScaler, StringIndexer, StringIndexerModel,
                                VectorAssembler)
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from arrearium import fixed_values as fv
from arrearium.functions import expressions as X
from arrearium.operators.clean import distinct_beyond, numeric_columns, text_columns
from arrearium.operators.standardize import standardize_dataset
from arrearium.operators.stats import attach, first_share_by_hash


#: More labels than this in one column are no categories to encode.
MOST_LABELS = 10_000


def few_labels(df: DataFrame, columns: Sequence[str], most: int) -> dict[str, list[str] | None]:
    """Sorted distinct labels of each text column, or None for a column of more than `most`; exact at the limit.

    One pass finds how many distinct values each column has by a sketch that is exact while they are few and whose size is
    bounded; only columns within the limit give their labels to the driver, most of them at the most.
    """
    if not columns:
        return {}
    about = df.agg(*[distinct_beyond(df, c, most).alias(c) for c in columns]).first()
    few = [c for c in columns if about[c] <= most]
    if not few:
        return dict.fromkeys(columns)
    levels = df.agg(*[F.array_sort(F.collect_set(F.col(f"`{c}`").cast("string"))).alias(c) for c in few]).first()
    return {c: levels[c] if c in few else None for c in columns}


def checked_labels(df: DataFrame, columns: Sequence[str], most: int = MOST_LABELS) -> None:
    """An error for a column with more labels than can be encoded, before any of them leaves the executors."""
    about = df.agg(*[distinct_beyond(df, c, most).alias(c) for c in columns]).first() if columns else {}
    many = [c for c in columns if about[c] > most]
    if many:
        raise ValueError(f"more than {most} labels in {', '.join(many)}; these are no categories")


def encoder_stages(columns: Sequence[str]) -> list:
    """Index and one-hot encode; an unknown or NULL value gives all zeros."""
    return [
        StringIndexer(inputCols=list(columns), outputCols=[f"{c}_idx" for c in columns],
                      handleInvalid="keep", stringOrderType="alphabetAsc"),
        OneHotEncoder(inputCols=[f"{c}_idx" for c in columns], outputCols=[f"{c}_hot" for c in columns],
                      dropLast=True, handleInvalid="error"),
    ]


def one_hot_encode(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Add one 0/1 column <column>=<value> per value of the fitted table; at most MOST_LABELS values a column."""
    checked_labels(df, columns)
    model = Pipeline(stages=encoder_stages(columns)).fit(df)
    labels = model.stages[0].labelsArray
    out = model.transform(df)
    parts = {c: vector_to_array(f"{c}_hot") for c in columns}
    return out.select(*df.columns, *[
        parts[c][i].cast("int").alias(f"{c}={v}") for c, vs in zip(columns, labels) for i, v in enumerate(vs)])


def dummies_drop_first(df: DataFrame, columns: Sequence[str] | None = None, max_levels: int = 30,
                       exclude: Sequence[str] = tuple(fv.TARGET_COLUMNS)) -> DataFrame:
    """Replace text columns of fewer than max_levels values by 0/1 columns, first value left out."""
    columns = [c for c in (text_columns(df) if columns is None else columns) if c not in set(exclude)]
    if not columns:
        return df
    use = {c: vs for c, vs in few_labels(df, columns, max_levels - 1).items() if vs is not None}
    return df.select(
        *[F.col(f"`{c}`") for c in df.columns if c not in use],
        *[F.coalesce((F.col(c) == v).cast("int"), F.lit(0)).alias(f"{c}_{v}")
          for c, vs in use.items() for v in vs[1:]])


def standard_scale(df: DataFrame, columns: Sequence[str], suffix: str = "", places: int | None = None) -> DataFrame:
    """(x - mean) / population deviation from one shared pass; a constant column becomes zero."""
    stats = df.agg(*[f(c).alias(f"{n}_{c}") for c in columns for n, f in (("mean", F.avg), ("sd", F.stddev_pop))])
    out = {}
    for c in columns:
        sd = F.col(f"_s.sd_{c}")
        z = (F.col(c) - F.col(f"_s.mean_{c}")) / F.when(sd == 0, F.lit(1.0)).otherwise(sd)
        out[f"{c}{suffix}"] = z if places is None else X.round_to(z, places)
    return attach(df, _s=stats).withColumns(out).drop("_s")


def scaled_copies(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return standard_scale(df, columns, "_scaled", 3)


def engineer_features(df: DataFrame, add_dti: bool = True, add_severity: bool = True, encode: bool = True, scale: bool = True,
                      max_levels: int = 30, most_scaled: int = 8, key: str | None = None) -> DataFrame:
    """The feature stage in one step: ratio and severity columns, 0/1 columns of text labels, scaled copies, standard columns.

    dti_ratio (4 places) and delinquency_severity_score (2 places) come first, from standard values where a column is
    absent. Then text columns of fewer than max_levels labels become 0/1 columns, and the first most_scaled numeric columns that
    are no targets get a scaled copy. The table is standardised last, as every later stage expects it.
    """
    def given(column: str, otherwise: float) -> Column:
        return F.col(column) if column in df.columns else F.lit(otherwise)

    out = df
    if add_dti:
        out = out.withColumn("dti_ratio", X.round_to(X.dti_simple(given("loan_amount", 25000.0), given("annual_income", 50000.0)), 4))
    if add_severity:
        severity = X.delinquency_severity(given("overdue_days", 0.0), given("credit_score", 650.0))
        out = out.withColumn("delinquency_severity_score", X.round_to(severity, 2))
    numbers = [c for c in numeric_columns(out) if c not in fv.TARGET_COLUMNS and not c.endswith("_scaled")][:most_scaled]
    if encode:
        out = dummies_drop_first(out, max_levels=max_levels)
    if scale and numbers:
        out = scaled_copies(out, numbers)
    return standardize_dataset(out, key)


def feature_matrix(numeric: Sequence[str] = tuple(fv.MODEL_NUMERIC),
                   categorical: Sequence[str] = tuple(fv.MODEL_CATEGORICAL), scale: bool = False) -> Pipeline:
    """Numeric columns and encoded categories in one vector named features.

    scale standardises the numeric part, as linear models want; trees do not care.
    """
    stages = encoder_stages(categorical) if categorical else []
    numbers = VectorAssembler(inputCols=list(numeric), outputCol="numbers", handleInvalid="error")
    stages.append(numbers)
    if scale:
        stages.append(StandardScaler(inputCol="numbers", outputCol="scaled", withMean=True, withStd=True))
    hot = [f"{c}_hot" for c in categorical]
    stages.append(VectorAssembler(inputCols=["scaled" if scale else "numbers", *hot], outputCol="features"))
    return Pipeline(stages=stages)


def feature_names(model: PipelineModel) -> list[str]:
    """Names of the vector's entries as fitted: numeric columns, then <column>=<value>."""
    numeric = next(s for s in model.stages if isinstance(s, VectorAssembler)).getInputCols()
    indexer = next((s for s in model.stages if isinstance(s, StringIndexerModel)), None)
    pairs = zip(indexer.getInputCols(), indexer.labelsArray) if indexer else []
    return [*numeric, *[f"{c}={v}" for c, vs in pairs for v in vs]]


def stratified_split(df: DataFrame, key: str, label: str, test_share: float = 0.2, seed: str = "") -> DataFrame:
    """is_test = 1 for test_share of each class, exactly, in hash order of the key."""
    return first_share_by_hash(df, key, test_share, [label], "is_test", seed)


def random_split(df: DataFrame, key: str, test_pct: int = 20) -> DataFrame:
    """is_test by a hash of the key alone: repeatable, no shuffle."""
    bucket = F.conv(F.substring(F.md5(F.col(key).cast("string")), 1, 8), 16, 10).cast("long") % 100
    return df.withColumn("is_test", (bucket < test_pct).cast("int"))


def class_weights(df: DataFrame, label: str) -> DataFrame:
    """label, n, weight = total / (classes * n), and neg_pos_ratio = negatives / positives."""
    counts = df.where(F.col(label).isNotNull()).groupBy(label).agg(F.count("*").alias("n"))
    s = F.col("_s")
    stats = counts.agg(
        F.sum("n").alias("total"), F.count("*").alias("classes"),
        F.sum(F.when(F.col(label) == 0, F.col("n")).otherwise(0)).alias("neg"),
        F.sum(F.when(F.col(label) == 1, F.col("n")).otherwise(0)).alias("pos"))
    return attach(counts, _s=stats).withColumns({
        "weight": s["total"] / (s["classes"] * F.col("n")),
        "neg_pos_ratio": X.round_to(s["neg"] / F.greatest(s["pos"], F.lit(1)), 2)}).drop("_s")


def with_class_weight(df: DataFrame, label: str, out: str = "weight") -> DataFrame:
    """Balanced weight on every row of a 0/1 label: total / (2 * rows of the row's class)."""
    stats = df.agg(F.count(label).alias("n"), F.sum(F.col(label).cast("long")).alias("pos"))
    s = F.col("_s")
    mine = F.when(F.col(label) == 1, s["pos"]).otherwise(s["n"] - s["pos"])
    return attach(df, _s=stats).withColumn(out, s["n"] / (2.0 * mine)).drop("_s")
