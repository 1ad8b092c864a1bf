"""Dataset profile: one long table per section.

A whole profile reads its input twice: once for everything that is one number per column (missing, moments, times), in one
wide aggregate, and once for the counts of distinct values, which are written and serve all other sections.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cohortweave.functions.ordering import percentiles_of_counts
from cohortweave.functions.times import as_time
from cohortweave.session import fresh_path


def numeric_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema if isinstance(f.dataType, T.NumericType)]


def category_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema if isinstance(f.dataType, (T.StringType, T.BooleanType))]


def time_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema if isinstance(f.dataType, (T.TimestampType, T.TimestampNTZType))]


def _missing(field: T.StructField) -> str:
    name = f"`{field.name}`"
    if isinstance(field.dataType, (T.DoubleType, T.FloatType)):
        return f"({name} IS NULL OR isnan({name}))"
    return f"({name} IS NULL)"


def _text(value: str, dtype: T.DataType) -> str:
    """Text of a value as it appears in a profile."""
    if isinstance(dtype, T.BooleanType):
        return f"initcap(cast({value} AS string))"
    return f"cast({value} AS string)"


_MISSING = "position int, column_name string, missing_count bigint, missing_fraction double"
_NUMERIC = (
    "column_name string, non_null_count bigint, mean double, std double, min_value double, "
    "p25 double, median double, p75 double, max_value double"
)
_TIMES = "column_name string, min_time timestamp_ntz, max_time timestamp_ntz, non_null_count bigint"


def _missing_sums(df: DataFrame) -> list[F.Column]:
    return [F.expr(f"count_if({_missing(f)}) AS missing_{i}") for i, f in enumerate(df.schema)]


def _number(column: str) -> str:
    return f"CASE WHEN NOT isnan(try_cast(`{column}` AS double)) THEN try_cast(`{column}` AS double) END"


_MOMENTS = (
    ("non_null_count", "count({0})"),
    ("mean", "avg({0})"),
    ("std", "nullif(stddev_samp({0}), double('nan'))"),
    ("min_value", "min({0})"),
    ("max_value", "max({0})"),
)


def _moment_sums(columns: Sequence[str]) -> list[F.Column]:
    return [F.expr(f"{how.format(_number(c))} AS {name}_{i}") for i, c in enumerate(columns) for name, how in _MOMENTS]


def _time_sums(df: DataFrame, columns: Sequence[str]) -> list[F.Column]:
    sums = (("min_time", F.min), ("max_time", F.max), ("time_count", F.count))
    return [how(as_time(df, c)).alias(f"{name}_{i}") for i, c in enumerate(columns) for name, how in sums]


def _long(wide: DataFrame, columns: Sequence[str], names: Sequence[tuple[str, str]], carried: Sequence[str] = ()) -> DataFrame:
    """One row per column of the one wide row; ``names`` pairs a field with the start of its wide name."""
    entries = ", ".join(
        f"named_struct('position', {i}, 'column_name', {_quoted(c)}, {', '.join(f'{_quoted(n)}, {w}_{i}' for n, w in names)})"
        for i, c in enumerate(columns)
    )
    return wide.selectExpr(*carried, f"inline(array({entries}))")


def missingness(df: DataFrame) -> DataFrame:
    """``(position, column_name, missing_count, missing_fraction)`` from one scan."""
    return _missing_shares(df.agg(F.expr("count(1) AS row_count"), *_missing_sums(df)), df.columns)


def _missing_shares(wide: DataFrame, columns: Sequence[str]) -> DataFrame:
    share = "coalesce(missing_count / nullif(row_count, 0), 0.0D) AS missing_fraction"
    return _long(wide, columns, [("missing_count", "missing")], ["row_count"]).selectExpr("position", "column_name", "missing_count", share)


def _quoted(text: str) -> str:
    escaped = text.replace("\\", "\\\\").replace("'", "\\'")
    return f"'{escaped}'"


def patient_count(df: DataFrame, patient_id: str) -> DataFrame:
    return df.agg(F.expr(f"count(DISTINCT `{patient_id}`) AS patient_count"))


def value_balance(df: DataFrame, column: str, name: str) -> DataFrame:
    """``(name, count, fraction)`` per value; NULL is a value of its own.

    Order by count descending, value ascending at the sink.
    """
    counts = df.groupBy(column).agg(F.expr("count(1) AS count"))
    value = f"CASE WHEN `{column}` IS NULL THEN 'nan' ELSE {_text(f'`{column}`', df.schema[column].dataType)} END"
    total = df.agg(F.expr("count(1) AS n")).scalar()
    return counts.selectExpr(f"{value} AS {name}", "count").withColumn(
        "fraction", F.col("count") / total
    )


def class_balance(df: DataFrame, label: str) -> DataFrame:
    return value_balance(df, label, "label_value")


def split_balance(df: DataFrame, split: str) -> DataFrame:
    return value_balance(df, split, "split_value")


def numeric_summaries(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Count, mean, sample deviation and exact quartiles per column.

    Moments are one wide aggregate. Only for the quartiles are the columns stacked, and equal values of a column meet
    before they leave a task.
    """
    chosen = [c for c in columns if c in df.columns] if columns else numeric_columns(df)
    if not chosen:
        return df.sparkSession.createDataFrame([], _NUMERIC)
    return _numeric(df.agg(*_moment_sums(chosen)), chosen, _stacked(df, numbers=chosen))


def _numeric(wide: DataFrame, columns: Sequence[str], counts: DataFrame) -> DataFrame:
    moments = _long(wide, columns, [(name, name) for name, _ in _MOMENTS])
    finite = counts.filter(f"kind = '{NUMBER}' AND abs(number) < double('infinity')").selectExpr("column_name", "number AS value", "n")
    quartiles = percentiles_of_counts(finite, ["column_name"], [0.25, 0.5, 0.75], ["p25", "median", "p75"])
    return moments.join(quartiles, "column_name", "left").select(
        "column_name", "non_null_count", "mean", "std", "min_value", "p25", "median", "p75", "max_value"
    )


NUMBER, CATEGORY, LABEL, SPLIT, PATIENT = "number", "category", "label", "split", "patient"


def _stacked(
    df: DataFrame,
    numbers: Sequence[str] = (),
    categories: Sequence[str] = (),
    label: str | None = None,
    split: str | None = None,
    patient_id: str | None = None,
) -> DataFrame:
    """Counts ``(kind, column_name, number, text, n)`` of the distinct values of all columns, NULL included for label and split."""

    def entry(kind: str, column: str, number: str, text: str) -> str:
        return f"named_struct('kind', '{kind}', 'column_name', {_quoted(column)}, 'number', {number}, 'text', {text})"

    def shown(column: str) -> str:
        return _text(f"`{column}`", df.schema[column].dataType)

    none, blank = "cast(NULL AS double)", "cast(NULL AS string)"
    entries = [entry(NUMBER, c, _number(c), blank) for c in numbers]
    entries += [entry(CATEGORY, c, none, shown(c)) for c in categories]
    entries += [entry(kind, c, none, f"coalesce({shown(c)}, 'nan')") for kind, c in ((LABEL, label), (SPLIT, split)) if c]
    entries += [entry(PATIENT, c, none, f"cast(`{c}` AS string)") for c in [patient_id] if c]
    rows = df.selectExpr(f"inline(array({', '.join(entries)}))") if entries else df.sparkSession.createDataFrame([], _COUNTS).drop("n")
    known = rows.filter("number IS NOT NULL OR text IS NOT NULL")
    return known.groupBy("kind", "column_name", "number", "text").agg(F.expr("count(1) AS n"))


_COUNTS = "kind string, column_name string, number double, text string, n bigint"


def category_values(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """``(column_name, value, count)`` of every non-null value."""
    chosen = [c for c in columns if c in df.columns] if columns else category_columns(df)
    return _categories(_stacked(df, categories=chosen))


def _categories(counts: DataFrame) -> DataFrame:
    return counts.filter(f"kind = '{CATEGORY}'").selectExpr("column_name", "text AS value", "n AS count")


def category_cardinality(df: DataFrame, columns: Sequence[str] | None = None, top_n: int = 10) -> DataFrame:
    """Distinct count and the ``top_n`` most frequent values per column, one row per value."""
    return _top_values(category_values(df, columns), top_n)


def _top_values(counts: DataFrame, top_n: int) -> DataFrame:
    """The rank filter is pushed below the shuffle, so each task hands on at most ``top_n`` values per column."""
    # Reading the (never zero) count keeps both uses of the counts the same plan.
    unique = counts.groupBy("column_name").agg(F.expr("count_if(count > 0) AS unique_count"))
    top = counts.selectExpr(
        "*", "row_number() OVER (PARTITION BY column_name ORDER BY count DESC, value) AS place"
    ).filter(f"place <= {int(top_n)}")
    return top.join(unique, "column_name").select("column_name", "unique_count", "place", "value", "count")


def temporal_coverage(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """First and last time and count of parsable times per column."""
    chosen = [c for c in columns if c in df.columns] if columns else time_columns(df)
    if not chosen:
        return df.sparkSession.createDataFrame([], _TIMES)
    return _coverage(df.agg(*_time_sums(df, chosen)), chosen)


def _coverage(wide: DataFrame, columns: Sequence[str]) -> DataFrame:
    return _long(wide, columns, [("min_time", "min_time"), ("max_time", "max_time"), ("non_null_count", "time_count")]).drop("position")


def missing_column_notes(
    df: DataFrame,
    patient_id: str | None = None,
    label: str | None = None,
    split: str | None = None,
    times: Sequence[str] | None = None,
    categories: Sequence[str] | None = None,
    numbers: Sequence[str] | None = None,
) -> list[str]:
    """Notes for requested columns that the table does not have; no job runs."""
    requested = (
        ("patient_id_col", [patient_id] if patient_id else []),
        ("label_col", [label] if label else []),
        ("split_col", [split] if split else []),
        ("time_cols", times or []),
        ("categorical_cols", categories or []),
        ("numeric_cols", numbers or []),
    )
    return [
        f"requested {argument} missing: {column}"
        for argument, columns in requested
        for column in columns
        if column not in df.columns
    ]


@dataclass(frozen=True)
class Profile:
    """All sections of one profile as lazy tables; absent sections are None."""

    dataset_name: str
    overview: DataFrame
    missingness: DataFrame
    numeric: DataFrame
    categories: DataFrame
    times: DataFrame
    class_balance: DataFrame | None
    split_balance: DataFrame | None
    notes: list[str]

    def sections(self) -> dict[str, DataFrame]:
        named = {
            "overview": self.overview,
            "missingness": self.missingness,
            "numeric_summaries": self.numeric,
            "category_cardinality": self.categories,
            "temporal_coverage": self.times,
            "class_balance": self.class_balance,
            "split_balance": self.split_balance,
        }
        return {name: section for name, section in named.items() if section is not None}


def profile(
    df: DataFrame,
    dataset_name: str,
    patient_id: str | None = None,
    label: str | None = None,
    split: str | None = None,
    times: Sequence[str] | None = None,
    categories: Sequence[str] | None = None,
    numbers: Sequence[str] | None = None,
    top_n: int = 10,
) -> Profile:
    """Profile a table with two scans of it, done here: the wide aggregate, one row, and the counts of values, written.

    Sections are lazy tables over these two.
    """
    spark = df.sparkSession
    notes = missing_column_notes(df, patient_id, label, split, times, categories, numbers)
    numeric = [c for c in numbers if c in df.columns] if numbers else numeric_columns(df)
    texts = [c for c in categories if c in df.columns] if categories else category_columns(df)
    seen = [c for c in times if c in df.columns] if times else time_columns(df)
    label, split = (c if c and c in df.columns else None for c in (label, split))
    has_patients = patient_id is not None and patient_id in df.columns
    sums = df.agg(F.expr("count(1) AS row_count"), *_missing_sums(df), *_moment_sums(numeric), *_time_sums(df, seen))
    wide = spark.createDataFrame([sums.first()], sums.schema)  # one row
    path = fresh_path(spark, "value-counts")
    _stacked(df, numeric, texts, label, split, patient_id if has_patients else None).write.parquet(path)
    counts = spark.read.schema(_COUNTS).parquet(path)
    patients = f"count_if(kind = '{PATIENT}')" if has_patients else "cast(NULL AS bigint)"
    rows = int(wide.first().row_count)

    def balance(kind: str, name: str) -> DataFrame:
        return counts.filter(f"kind = '{kind}'").selectExpr(f"text AS {name}", "n AS count", f"n / {max(rows, 1)}L AS fraction")

    return Profile(
        dataset_name=dataset_name,
        overview=counts.agg(F.expr(f"{patients} AS patient_count")).selectExpr(
            f"{_quoted(dataset_name)} AS dataset_name",
            f"{rows}L AS row_count",
            f"cast({len(df.columns)} AS bigint) AS column_count",
            "patient_count",
        ),
        missingness=_missing_shares(wide, df.columns),
        numeric=_numeric(wide, numeric, counts) if numeric else spark.createDataFrame([], _NUMERIC),
        categories=_top_values(_categories(counts), top_n),
        times=_coverage(wide, seen) if seen else spark.createDataFrame([], _TIMES),
        class_balance=balance(LABEL, "label_value") if label else None,
        split_balance=balance(SPLIT, "split_value") if split else None,
        notes=notes,
    )


def top_missing(missing: DataFrame, top_n: int = 10) -> DataFrame:
    """Columns with the largest missing share; ties by name."""
    return (
        missing.orderBy(F.desc("missing_fraction"), "column_name")
        .limit(top_n)
        .select("column_name", "missing_count", "missing_fraction")
    )


def profile_summary(profiled: Profile, top_n_missing: int = 10) -> DataFrame:
    """Condensed one-row summary: counts, label maps and the emptiest columns.

    A label map is bounded by the number of label values.
    """
    summary = profiled.overview
    for name, section, value in (
        ("class_balance", profiled.class_balance, "label_value"),
        ("split_balance", profiled.split_balance, "split_value"),
    ):
        if section is None:
            summary = summary.withColumn(name, F.expr("cast(map() AS map<string, bigint>)"))
        else:
            counts = section.agg(F.expr(f"map_from_entries(collect_list(struct({value}, count))) AS m"))
            summary = summary.withColumn(name, counts.scalar())
    emptiest = top_missing(profiled.missingness, top_n_missing).agg(
        F.expr(
            """transform(sort_array(collect_list(struct(-missing_fraction AS k, column_name, missing_count,
                 missing_fraction))), r -> struct(r.column_name, r.missing_count, r.missing_fraction)) AS m"""
        )
    )
    return summary.withColumn("top_missing_columns", emptiest.scalar()).withColumn(
        "notes", F.array(*[F.lit(n) for n in profiled.notes]).cast("array<string>")
    )
