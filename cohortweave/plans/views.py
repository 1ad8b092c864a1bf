"""The given star-schema tables recast as the operators' inputs.

Every view keeps all rows of its tables; gaps (NULL times, empty types, NaN
samples) are put in by value so that the NULL rules are exercised. ``CTES`` holds
the same definitions in SQL for the side-by-side check.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortweave.config import ColumnMap, EvidenceRules

# Settings that give a mixed label on the synthetic tables.
RULES = EvidenceRules(
    epilepsy_prefixes=("1F.0", "2p01"),
    seizure_prefixes=("2P.0", "1f.01"),
    medication_patterns=(
        "brand#3 blue",
        "brand#5 hot",
        "brand#7 cold",
        "brand#9 red",
        "brand#11 new",
        "brand#13 old",
        "brand#15 small",
        "brand#17 large",
    ),
    medication_aliases=(("azurol", ("brand#3 blue", "brand#5 hot")),),
)
COLUMNS = ColumnMap()


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def diagnoses(spark: SparkSession, sf_dir: str) -> DataFrame:
    code = F.concat(
        F.substring("o_orderpriority", 1, 1), "o_orderstatus", F.lit("."), F.date_format("o_orderdate", "MM")
    )
    return table(spark, sf_dir, "orders").select(
        F.col("o_custkey").cast("string").alias("patient_id"),
        F.when(F.col("o_orderstatus") == "F", F.concat(F.lit(" "), F.lower(code))).otherwise(code).alias(
            "diagnosis_code"
        ),
        F.when(F.col("o_totalprice") >= 100000, F.col("o_orderdate")).alias("diagnosis_time"),
        F.when(
            F.col("o_orderpriority") != "5-LOW", F.col("o_orderdate") + F.expr("INTERVAL 3 DAYS")
        ).alias("encounter_time"),
    )


def medications(spark: SparkSession, sf_dir: str) -> DataFrame:
    line = table(spark, sf_dir, "lineitem")
    orders = table(spark, sf_dir, "orders")
    part = table(spark, sf_dir, "part")
    return (
        line.join(orders, line.l_orderkey == orders.o_orderkey)
        .join(part, line.l_partkey == part.p_partkey)
        .select(
            F.col("o_custkey").cast("string").alias("patient_id"),
            F.concat("p_brand", F.lit("  "), "p_name").alias("medication_name"),
            F.when(
                ~((F.col("l_returnflag") == "R") & (F.col("l_discount") > 0.05)), F.col("l_shipdate")
            ).alias("medication_start"),
            F.when(
                F.col("l_linestatus") == "F", F.col("l_shipdate") + F.expr("INTERVAL 30 DAYS")
            ).alias("medication_end"),
            F.col("l_linestatus").alias("source"),
        )
    )


def seizure_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").select(
        F.col("user_id").cast("string").alias("patient_id"),
        F.when(F.col("value") >= 2, F.col("ts") - F.expr("INTERVAL 9300 DAYS")).alias("event_time"),
        F.when(F.col("value") < 100, F.col("event_type")).otherwise(F.lit("")).alias("event_type"),
    )


def _recorded(raw: str) -> str:
    """SQL: small values are zero, large ones missing."""
    return f"CASE WHEN abs({raw}) < 0.005D THEN 0D WHEN {raw} > 0.35D THEN double('NaN') ELSE {raw} END"


def _segments(spark: SparkSession, sf_dir: str, channels: list[tuple[int, int, float]]) -> DataFrame:
    """Each vector is a recording whose channels are stretches (first place, number, rate) of it."""
    stretches = ", ".join(f"struct({k} AS channel, {a} AS place, {n} AS n, {rate}D AS sfreq)" for k, (a, n, rate) in enumerate(channels))
    return table(spark, sf_dir, "embeddings").selectExpr(
        "vec_id", "label", "embedding", f"inline(array({stretches}))"
    ).selectExpr(
        "concat('p', label) AS patient_id",
        "cast(vec_id AS string) AS recording_id",
        "concat('/signals/p', label, '/r', vec_id, '.edf') AS edf_path",
        "channel",
        "0L AS start",
        "sfreq",
        f"transform(slice(embedding, place + 1, n), x -> {_recorded('cast(x AS double)')}) AS values",
    )


def segments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each vector is a recording of two channels with 32 samples at 64 Hz."""
    return _segments(spark, sf_dir, [(0, 32, 64.0), (32, 32, 64.0)])


def mixed_segments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Half a second at two rates: 31 samples at 62 Hz, and 37 at 74 Hz, which overlap in the vector."""
    return _segments(spark, sf_dir, [(0, 31, 62.0), (27, 37, 74.0)])


def samples(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The samples of ``segments`` as a long table."""
    return segments(spark, sf_dir).selectExpr(
        "patient_id", "recording_id", "edf_path", "channel", "posexplode(values) AS (sample_idx, value)", "sfreq"
    ).selectExpr("patient_id", "recording_id", "edf_path", "channel", "cast(sample_idx AS bigint) AS sample_idx", "value", "sfreq")


def lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Vectors with one label make a volume, each an image row: z from the id's last bits, y from the position."""
    return table(spark, sf_dir, "embeddings").selectExpr(
        "concat('p', label) AS subject_id",
        "cast(vec_id % 8 AS int) AS z",
        "cast(floor(vec_id / 8) AS int) AS x",
        "transform(embedding, v -> if(v > 0.35D, float('NaN'), v)) AS values",
    )


def voxels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The voxels of ``lines`` as a long table."""
    cells = lines(spark, sf_dir).selectExpr("subject_id", "x", "z", "posexplode(values) AS (y, value)")
    return cells.select("subject_id", "x", "y", "z", "value")


def volume_headers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (
        table(spark, sf_dir, "embeddings")
        .select("label")
        .distinct()
        .select(
            F.concat(F.lit("p"), F.col("label").cast("string")).alias("subject_id"),
            F.concat(F.lit("/volumes/sub-p"), "label", F.lit("/anat/T1w.nii.gz")).alias("t1_path"),
            (F.lit(1.0) + F.col("label") / 10).alias("zoom_x"),
            F.lit(0.5).alias("zoom_y"),
            F.lit(2.0).alias("zoom_z"),
        )
    )


def participants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "customer").select(
        F.concat(F.lit("p"), F.col("c_custkey").cast("string")).alias("participant_id"),
        F.col("c_mktsegment").alias("segment"),
        F.col("c_acctbal").alias("balance"),
    )


# The same views in SQL.
CTES = {
    "diagnoses": """
        SELECT CAST(o_custkey AS VARCHAR) AS patient_id,
               CASE WHEN o_orderstatus = 'F' THEN ' ' || lower(raw_code) ELSE raw_code END AS diagnosis_code,
               CASE WHEN o_totalprice >= 100000 THEN o_orderdate END AS diagnosis_time,
               CASE WHEN o_orderpriority <> '5-LOW' THEN o_orderdate + INTERVAL 3 DAY END AS encounter_time
        FROM (SELECT *, substr(o_orderpriority, 1, 1) || o_orderstatus || '.' || strftime(o_orderdate, '%m')
                        AS raw_code FROM orders)""",
    "medications": """
        SELECT CAST(o_custkey AS VARCHAR) AS patient_id,
               p_brand || '  ' || p_name AS medication_name,
               CASE WHEN NOT (l_returnflag = 'R' AND l_discount > 0.05) THEN l_shipdate END AS medication_start,
               CASE WHEN l_linestatus = 'F' THEN l_shipdate + INTERVAL 30 DAY END AS medication_end,
               l_linestatus AS source
        FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN part ON l_partkey = p_partkey""",
    "seizure_events": """
        SELECT CAST(user_id AS VARCHAR) AS patient_id,
               CASE WHEN value >= 2 THEN ts - INTERVAL 9300 DAY END AS event_time,
               CASE WHEN value < 100 THEN event_type ELSE '' END AS event_type
        FROM events""",
    "positions": """
        SELECT vec_id, label, unnest(range(64)) AS pos, unnest(embedding) AS raw
        FROM embeddings""",
    "samples": """
        SELECT 'p' || label AS patient_id, CAST(vec_id AS VARCHAR) AS recording_id,
               '/signals/p' || label || '/r' || vec_id || '.edf' AS edf_path,
               CASE WHEN pos >= 32 THEN 1 ELSE 0 END AS channel,
               CASE WHEN pos >= 32 THEN pos - 32 ELSE pos END AS sample_idx,
               CASE WHEN abs(raw) < 0.005 THEN 0.0 WHEN raw > 0.35 THEN NULL ELSE CAST(raw AS DOUBLE) END AS value,
               64.0 AS sfreq
        FROM positions""",
    "mixed": """
        SELECT 'p' || label AS patient_id, CAST(vec_id AS VARCHAR) AS recording_id,
               '/signals/p' || label || '/r' || vec_id || '.edf' AS edf_path, channel, pos - low AS sample_idx,
               CASE WHEN abs(raw) < 0.005 THEN 0.0 WHEN raw > 0.35 THEN NULL ELSE CAST(raw AS DOUBLE) END AS value,
               n, 2.0::DOUBLE * n AS sfreq
        FROM positions JOIN (VALUES (0, 0, 31), (1, 27, 37)) AS stretch(channel, low, n) ON pos >= low AND pos < low + n""",
    "voxels": """
        SELECT 'p' || label AS subject_id, vec_id // 8 AS x, pos AS y, vec_id % 8 AS z,
               CASE WHEN raw > 0.35 THEN NULL ELSE raw END AS value
        FROM positions""",
    "volume_headers": """
        SELECT DISTINCT 'p' || label AS subject_id,
               '/volumes/sub-p' || label || '/anat/T1w.nii.gz' AS t1_path,
               1.0 + CAST(label AS DOUBLE) / 10 AS zoom_x, CAST(0.5 AS DOUBLE) AS zoom_y,
               CAST(2.0 AS DOUBLE) AS zoom_z
        FROM embeddings""",
    "participants": """
        SELECT 'p' || c_custkey AS participant_id, c_mktsegment AS segment, c_acctbal AS balance
        FROM customer""",
}
