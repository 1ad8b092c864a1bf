"""CSV, gzip CSV and Parquet tables with soft validation."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cohortweave.functions.text import null_if_na
from cohortweave.functions.times import as_time
from cohortweave.schemas import NA_TOKENS

FORMATS = ("csv", "csv.gz", "parquet")


class RequiredColumnsMissing(ValueError):
    """Raised when a loaded table lacks required columns."""


@dataclass(frozen=True)
class TableRequest:
    """One table to load.

    Text columns stay strings unless ``types`` (name -> Spark type) or ``dates`` say
    otherwise, so zero-led codes survive; ``infer_types`` asks Spark to infer the rest.
    ``spread`` repartitions after reading, for a single large gzip file.
    """

    path: str
    file_format: str | None = None
    columns: Sequence[str] | None = None
    required: Sequence[str] | None = None
    types: Mapping[str, str] | None = None
    dates: Sequence[str] | None = None
    date_formats: tuple[str, ...] = ()
    na_tokens: tuple[str, ...] = NA_TOKENS
    infer_types: bool = False
    multi_line: bool = False
    spread: int | None = None
    name: str | None = None


@dataclass(frozen=True)
class LoadInfo:
    path: str
    file_format: str
    column_names: list[str]
    missing_required: list[str]
    used_batches: bool = False
    notes: list[str] = field(default_factory=list)


def infer_format(path: str) -> str:
    lowered = path.lower()
    for suffix, name in ((".csv.gz", "csv.gz"), (".csv", "csv"), (".parquet", "parquet")):
        if lowered.endswith(suffix):
            return name
    raise ValueError(f"Unsupported file format for path: {path}")


def normalize_format(file_format: str) -> str:
    name = file_format.lower().lstrip(".")
    name = "csv.gz" if name == "gz" else name
    if name not in FORMATS:
        raise ValueError(f"Unsupported file format: {file_format}")
    return name


def resolve_format(request: TableRequest) -> tuple[str, list[str]]:
    if request.file_format is None:
        return infer_format(request.path), ["file format inferred from path"]
    return normalize_format(request.file_format), []


def _csv_options(reader, separator: str = ",", multi_line: bool = False):
    return reader.options(header=True, sep=separator, escape='"', multiLine=multi_line)


def _open(spark: SparkSession, path: str, file_format: str, request: TableRequest | None = None) -> DataFrame:
    try:
        if file_format == "parquet":
            return spark.read.parquet(path)
        multi_line = bool(request and request.multi_line)
        infer = bool(request and request.infer_types)
        return _csv_options(spark.read, multi_line=multi_line).option("inferSchema", infer).csv(path)
    except AnalysisException as error:
        if "PATH_NOT_FOUND" in str(error):
            raise FileNotFoundError(f"Table path does not exist: {path}") from error
        raise


def peek_columns(spark: SparkSession, path: str, file_format: str | None = None) -> list[str]:
    """Column names from the header or footer only."""
    return _open(spark, path, normalize_format(file_format) if file_format else infer_format(path)).columns


def missing_columns(df: DataFrame, required: Sequence[str] | None) -> list[str]:
    return [c for c in dict.fromkeys(required or []) if c not in df.columns]


def project(df: DataFrame, columns: Sequence[str] | None) -> tuple[DataFrame, list[str]]:
    """Requested columns in request order; unknown ones become notes."""
    if not columns:
        return df, []
    wanted = list(dict.fromkeys(columns))
    notes = [f"requested selected column missing: {c}" for c in wanted if c not in df.columns]
    return df.select(*[F.col(f"`{c}`") for c in wanted if c in df.columns]), notes


def clean(df: DataFrame, request: TableRequest) -> DataFrame:
    """NA tokens, NaN, type overrides and dates; a bad value becomes NULL."""
    types, dates = dict(request.types or {}), set(request.dates or [])
    columns = []
    for f in df.schema:
        column = F.col(f"`{f.name}`")
        if isinstance(f.dataType, T.StringType):
            column = null_if_na(column, request.na_tokens)
        elif isinstance(f.dataType, (T.DoubleType, T.FloatType)):
            column = F.when(~F.isnan(column), column)
        if f.name in types:
            column = column.try_cast(types[f.name])
        columns.append(column.alias(f.name))
    cleaned = df.select(*columns)
    for name in dates & set(df.columns):
        cleaned = cleaned.withColumn(name, as_time(cleaned, name, request.date_formats))
    return cleaned


def request_notes(request: TableRequest, batches: bool = False) -> list[str]:
    notes = ["chunking was used"] if batches else []
    if request.dates:
        notes.append("date parsing was requested")
    if request.columns:
        notes.append("selected columns were used")
    return notes


def check_required(df: DataFrame, request: TableRequest) -> list[str]:
    missing = missing_columns(df, request.required)
    if missing:
        raise RequiredColumnsMissing(f"Required columns missing from {request.path}: {', '.join(missing)}")
    return missing


def load_table(spark: SparkSession, request: TableRequest) -> tuple[DataFrame, LoadInfo]:
    """Lazy table plus plan-time metadata. Row counts come from ``load_metadata``."""
    file_format, notes = resolve_format(request)
    df, column_notes = project(_open(spark, request.path, file_format, request), request.columns)
    missing = check_required(df, request)
    df = clean(df, request)
    if request.spread:
        df = df.repartition(request.spread)
    notes = [*notes, *column_notes, *request_notes(request)]
    return df, LoadInfo(request.path, file_format, df.columns, missing, False, list(dict.fromkeys(notes)))


def load_metadata(df: DataFrame, info: LoadInfo) -> DataFrame:
    """Load record with its row count, as one row."""
    return _load_record(df.agg(F.expr("count(1) AS row_count")), info)


def _load_record(counts: DataFrame, info: LoadInfo) -> DataFrame:
    return counts.select(
        F.lit(info.path).alias("path"),
        F.lit(info.file_format).alias("file_format"),
        *counts.columns,
        F.array(*[F.lit(c) for c in info.column_names]).cast("array<string>").alias("column_names"),
        F.array(*[F.lit(c) for c in info.column_names]).cast("array<string>").alias("loaded_columns"),
        F.array(*[F.lit(c) for c in info.missing_required]).cast("array<string>").alias("missing_required_columns"),
        F.lit(info.used_batches).alias("used_chunking"),
        F.array(*[F.lit(n) for n in info.notes]).cast("array<string>").alias("notes"),
    )


def store_with_metadata(spark: SparkSession, request: TableRequest, path: str) -> tuple[DataFrame, DataFrame]:
    """Load a table and write it as Parquet; rows and missing values are counted as they pass, without a second scan.

    Returns the stored table and its load record, which adds ``missing_counts`` by column. The load runs in a session of its
    own: once a session has observed anything, Spark 4.1 can no longer send a model that was fitted in it to a task.
    """
    df, info = load_table(spark.newSession(), request)
    passing = Observation("load")
    sums = [F.expr("count(1) AS row_count"), *[F.expr(f"count_if(`{c}` IS NULL) AS missing_{i}") for i, c in enumerate(df.columns)]]
    df.observe(passing, *sums).write.mode("overwrite").parquet(path)
    found = passing.get
    missing = {c: int(found[f"missing_{i}"]) for i, c in enumerate(df.columns)}
    counts = spark.createDataFrame([(int(found["row_count"]), missing)], "row_count bigint, missing_counts map<string, bigint>")
    return spark.read.schema(df.schema).parquet(path), _load_record(counts, info)


def numeric_where_possible(df: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """Turn text columns whose values are all numbers into numbers; one scan decides.

    Columns in ``keep`` (identifiers) stay text, and so do columns without any value.
    """
    chosen = [f.name for f in df.schema if isinstance(f.dataType, T.StringType) and f.name not in keep]
    if not chosen:
        return df
    tests = [
        F.expr(f"count(`{c}`) > 0 AND count(`{c}`) = count(try_cast(`{c}` AS {kind})) AS `{kind}_{i}`")
        for i, c in enumerate(chosen)
        for kind in ("bigint", "double")
    ]
    found = df.agg(*tests).first()
    for i, c in enumerate(chosen):
        kind = "bigint" if found[f"bigint_{i}"] else "double" if found[f"double_{i}"] else None
        if kind:
            df = df.withColumn(c, F.col(f"`{c}`").cast(kind))
    return df


def load_participants(spark: SparkSession, path: str, required: bool = False) -> DataFrame | None:
    """Tab-separated participant table with numeric columns, or None when it may be absent."""
    try:
        df = _csv_options(spark.read, "\t").csv(path)
    except AnalysisException as error:
        if "PATH_NOT_FOUND" not in str(error):
            raise
        if required:
            raise FileNotFoundError(f"Missing participants file: {path}") from error
        return None
    texts = df.select(*[null_if_na(F.col(f"`{c}`"), NA_TOKENS).alias(c) for c in df.columns])
    return numeric_where_possible(texts, keep=("participant_id", "subject_id"))


# --- hospital extracts -----------------------------------------------------------------------

# Source column -> normalised column.
DIAGNOSIS_EXTRACT = {"subject_id": "patient_id", "icd_code": "diagnosis_code"}
PRESCRIPTION_EXTRACT = {
    "subject_id": "patient_id",
    "drug": "medication_name",
    "starttime": "medication_start",
    "stoptime": "medication_end",
}


def rename_extract(df: DataFrame, names: Mapping[str, str]) -> DataFrame:
    """Select and rename as text; an absent column or value becomes an empty text."""
    return df.select(
        *[
            (F.coalesce(F.col(f"`{old}`").cast("string"), F.lit("")) if old in df.columns else F.lit("")).alias(new)
            for old, new in names.items()
        ]
    )


def normalize_diagnoses(df: DataFrame) -> DataFrame:
    return rename_extract(df, DIAGNOSIS_EXTRACT)


def normalize_prescriptions(df: DataFrame) -> DataFrame:
    return rename_extract(df, PRESCRIPTION_EXTRACT)


# --- validation report -----------------------------------------------------------------------


def check_frame(df: DataFrame, name: str, path: str, required: Sequence[str] | None = None) -> DataFrame:
    """``(name, present, path, detail)`` of a table that can be read."""
    missing = sorted(missing_columns(df, required))
    if missing:
        detail = F.lit(f"missing columns: {missing}")
        return df.sparkSession.range(1).select(
            F.lit(name).alias("name"), F.lit(False).alias("present"), F.lit(path).alias("path"), detail.alias("detail")
        )
    return df.agg(F.expr("count(1) AS n")).select(
        F.lit(name).alias("name"),
        F.lit(True).alias("present"),
        F.lit(path).alias("path"),
        F.concat(F.lit("present, rows="), F.col("n").cast("string")).alias("detail"),
    )


def check_table(
    spark: SparkSession, name: str, path: str, required: Sequence[str] | None = None, file_format: str | None = None
) -> DataFrame:
    """One validation row: missing, empty, missing columns, or present with its row count."""
    try:
        df = _open(spark, path, normalize_format(file_format) if file_format else infer_format(path))
    except FileNotFoundError:
        detail = "missing file"
    else:
        if df.columns:
            return check_frame(df, name, path, required)
        detail = "file is empty"
    return spark.range(1).select(
        F.lit(name).alias("name"), F.lit(False).alias("present"), F.lit(path).alias("path"), F.lit(detail).alias("detail")
    )
