"""Declared schemas and the NA tokens used by the text readers."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

# Times are wall-clock values without a zone, as in the source records, so no
# result depends on the session time zone.
TIME = T.TimestampNTZType()


def _schema(*fields: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(name, dtype, True) for name, dtype in fields])


_S, _B, _L, _D = T.StringType(), T.BooleanType(), T.LongType(), T.DoubleType()

DIAGNOSES = _schema(("patient_id", _S), ("diagnosis_code", _S), ("diagnosis_time", TIME), ("encounter_time", TIME))
MEDICATIONS = _schema(
    ("patient_id", _S), ("medication_name", _S), ("medication_start", TIME), ("medication_end", TIME), ("source", _S)
)
SEIZURE_EVENTS = _schema(("patient_id", _S), ("event_time", TIME), ("event_type", _S))

SIGNAL_SAMPLES = _schema(
    ("patient_id", _S),
    ("recording_id", _S),
    ("edf_path", _S),
    ("channel", T.IntegerType()),
    ("sample_idx", _L),
    ("value", _D),
    ("sfreq", _D),
)
SIGNAL_SEGMENTS = _schema(
    ("patient_id", _S),
    ("recording_id", _S),
    ("edf_path", _S),
    ("channel", T.IntegerType()),
    ("start", _L),
    ("sfreq", _D),
    ("values", T.ArrayType(_D)),
)
IMAGE_LINES = _schema(
    ("subject_id", _S), ("x", T.IntegerType()), ("z", T.IntegerType()), ("values", T.ArrayType(T.FloatType()))
)
VOXELS = _schema(
    ("subject_id", _S), ("x", T.IntegerType()), ("y", T.IntegerType()), ("z", T.IntegerType()), ("value", T.FloatType())
)
VOLUME_HEADERS = _schema(("subject_id", _S), ("t1_path", _S), ("zoom_x", _D), ("zoom_y", _D), ("zoom_z", _D))

SUBJECT_ERRORS = _schema(("subject_id", _S), ("error_type", _S), ("error_message", _S))
RECORDING_ERRORS = _schema(("patient_id", _S), ("edf_path", _S), ("error_type", _S), ("error_message", _S))

RUN_DATASETS = T.StructType(
    [
        T.StructField("run_id", _S),
        T.StructField("dataset_name", _S),
        T.StructField("modality", _S),
        T.StructField("source_format", _S),
        T.StructField("row_count", _L),
        T.StructField("patient_count", _L),
        T.StructField("description", _S),
        T.StructField("metadata", T.MapType(_S, _S)),
    ]
)
RUN_ARTIFACTS = T.StructType(
    [
        T.StructField("run_id", _S),
        T.StructField("position", T.IntegerType()),
        T.StructField("artifact_name", _S),
        T.StructField("artifact_type", _S),
        T.StructField("relative_path", _S),
        T.StructField("description", _S),
        T.StructField("created_by", _S),
        T.StructField("metadata", T.MapType(_S, _S)),
    ]
)

# Texts that the text readers treat as a missing value.
NA_TOKENS = (
    "",
    "#N/A",
    "#N/A N/A",
    "#NA",
    "-1.#IND",
    "-1.#QNAN",
    "-NaN",
    "-nan",
    "1.#IND",
    "1.#QNAN",
    "<NA>",
    "N/A",
    "NA",
    "NULL",
    "NaN",
    "None",
    "n/a",
    "nan",
    "null",
)


def empty(spark: SparkSession, schema: T.StructType) -> DataFrame:
    return spark.createDataFrame([], schema)
