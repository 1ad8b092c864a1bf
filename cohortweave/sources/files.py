"""Inventories of imaging and signal folders, from file listings only."""

from __future__ import annotations

import re

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# A folder with one of these beginnings names the patient.
PATIENT_PREFIXES = ("chb", "sub-", "patient", "pt")


def list_files(spark: SparkSession, root: str, pattern: str | None = None) -> DataFrame:
    """``(path, relative, length, modificationTime)`` below ``root``; contents are not read."""
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", True)
    if pattern:
        reader = reader.option("pathGlobFilter", pattern)
    try:
        files = reader.load(root)
    except AnalysisException as error:
        if "PATH_NOT_FOUND" in str(error):
            raise FileNotFoundError(f"Dataset root does not exist: {root}") from error
        raise
    return relative_paths(files.select("path", "length", "modificationTime"), root)


def relative_paths(files: DataFrame, root: str) -> DataFrame:
    """Drop the local-file scheme and add the path below ``root``."""
    plain = re.sub("^file:/+", "/", root).rstrip("/") + "/"
    return files.withColumn("path", F.regexp_replace("path", "^file:/+", "/")).withColumn(
        "relative",
        F.when(F.contains("path", F.lit(plain)), F.substring_index("path", plain, -1)).otherwise(F.col("path")),
    )


def _glob_to_regex(pattern: str) -> str:
    return re.escape(pattern).replace(r"\*", "[^/]*").replace(r"\?", "[^/]")


def image_inventory(
    files: DataFrame, participants: DataFrame | None = None, pattern: str = "*T1w.nii.gz"
) -> DataFrame:
    """One row per ``sub-*`` folder: its first image by path order in ``anat/``, or NULL.

    Subjects come from any listed file, and from the participants when given.
    """
    image = f"^sub-[^/]+/anat/{_glob_to_regex(pattern)}$"
    found = (
        files.withColumn("subject_id", F.regexp_extract("relative", "^(sub-[^/]+)/", 1))
        .filter("subject_id <> ''")
        .groupBy("subject_id")
        .agg(F.min(F.when(F.col("relative").rlike(image), F.col("path"))).alias("t1_path"))
    )
    if participants is not None and "participant_id" in participants.columns:
        ids = participants.select(F.col("participant_id").alias("subject_id")).dropna().distinct()
        found = found.join(ids, "subject_id", "full_outer")
    return found.withColumn("has_t1", F.col("t1_path").isNotNull())


def patient_from_path(relative: str = "relative") -> str:
    """SQL: nearest folder that names a patient, else the file name without its suffix."""
    folders = f"slice(split({relative}, '/'), 1, size(split({relative}, '/')) - 1)"
    test = f"^({'|'.join(PATIENT_PREFIXES)})"
    nearest = f"try_element_at(filter(reverse({folders}), p -> lower(p) RLIKE '{test}'), 1)"
    name = f"element_at(split({relative}, '/'), -1)"
    # A leading dot alone does not start a suffix.
    return f"coalesce({nearest}, regexp_replace({name}, '(?<=.)[.][^.]*$', ''))"


def recording_inventory(files: DataFrame) -> DataFrame:
    """``(patient_id, edf_path, file_name)`` of EDF files in either case of the suffix."""
    return files.filter("relative RLIKE '[.](edf|EDF)$'").selectExpr(
        f"{patient_from_path()} AS patient_id",
        "path AS edf_path",
        "element_at(split(relative, '/'), -1) AS file_name",
    )


def scan_images(
    spark: SparkSession, root: str, participants: DataFrame | None = None, pattern: str = "*T1w.nii.gz"
) -> DataFrame:
    return image_inventory(list_files(spark, root), participants, pattern)


def scan_recordings(spark: SparkSession, root: str) -> DataFrame:
    return recording_inventory(list_files(spark, root, "*.{edf,EDF}"))


def image_inventory_counts(inventory: DataFrame) -> DataFrame:
    return inventory.agg(
        F.expr("count(1) AS subject_count"), F.expr("count_if(has_t1) AS subjects_with_t1_count")
    )


def recording_inventory_counts(inventory: DataFrame) -> DataFrame:
    return inventory.agg(F.expr("count(1) AS file_count"), F.expr("count(DISTINCT patient_id) AS patient_count"))


def check_images(inventory: DataFrame, name: str, path: str, has_participants: bool) -> DataFrame:
    """Validation row of an imaging folder."""
    return image_inventory_counts(inventory).selectExpr(
        f"'{name}' AS name",
        "true AS present",
        f"'{path}' AS path",
        f"""concat('subjects=', subject_count, ', t1_files=', subjects_with_t1_count,
                   ', participants_tsv={has_participants}') AS detail""",
    )


def check_recordings(inventory: DataFrame, name: str, path: str) -> DataFrame:
    """Validation row of a signal folder."""
    return recording_inventory_counts(inventory).selectExpr(
        f"'{name}' AS name", "true AS present", f"'{path}' AS path", "concat('edf_files=', file_count) AS detail"
    )
