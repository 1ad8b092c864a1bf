"""Registered queries for linkage, fusion, profiles and reports."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortweave.config import LinkageConfig, RunContext
from cohortweave.operators import fusion, linkage, profile, report
from cohortweave.plans import views as v
from cohortweave.plans.registry import presented, register
from cohortweave.plans.sql_views import r6

RUN = RunContext("run-001", "cohortweave", "evidence", "2025-01-01T00:00:00")

# --- linkage ---------------------------------------------------------------------------------

# Orders name their customer; some carry padding or nothing. The mapping lists
# all customers, without an id at a negative balance, and suppliers reuse some of their numbers.
_SOURCES = """
    SELECT o_orderkey, CASE WHEN o_orderstatus = 'P' AND o_totalprice < 50000 THEN '  '
                            WHEN o_orderstatus = 'O' THEN ' C' || o_custkey || ' '
                            ELSE 'c' || o_custkey END AS source_id FROM orders"""
_MAPPING = """
    SELECT 'c' || c_custkey AS source_id, CASE WHEN c_acctbal >= 0 THEN ' person-' || c_custkey END AS canonical_patient_id
    FROM customer
    UNION ALL SELECT 'C' || s_suppkey, 'supplier-' || s_suppkey FROM supplier"""
_LINKED = f"""
    WITH src AS ({_SOURCES}), map AS ({_MAPPING}),
         keys AS (SELECT lower(trim(source_id)) AS k, max(trim(canonical_patient_id)) AS canonical,
                         count(DISTINCT trim(canonical_patient_id)) > 1 AS conflicting FROM map
                  WHERE canonical_patient_id IS NOT NULL GROUP BY 1),
         keyed AS (SELECT o_orderkey, nullif(lower(trim(source_id)), '') AS k FROM src),
         linked AS (
           SELECT o_orderkey, coalesce(keyed.k, '') AS source_id,
                  CASE WHEN NOT conflicting THEN canonical END AS canonical_patient_id,
                  CASE WHEN keyed.k IS NULL THEN 'unmatched' WHEN conflicting THEN 'ambiguous'
                       WHEN canonical IS NOT NULL THEN 'matched' ELSE 'unmatched' END AS match_status,
                  CASE WHEN keyed.k IS NULL THEN 'source identifier was missing'
                       WHEN conflicting THEN 'source identifier had conflicting explicit mappings'
                       WHEN canonical IS NULL THEN 'source identifier was absent from explicit mapping' END AS notes
           FROM keyed LEFT JOIN keys ON keyed.k = keys.k)"""
_CONFIG = LinkageConfig("source_id", mode="lower", keep_source=False)


def _sources(spark: SparkSession, d: str) -> DataFrame:
    return v.table(spark, d, "orders").selectExpr(
        "o_orderkey",
        """CASE WHEN o_orderstatus = 'P' AND o_totalprice < 50000 THEN '  '
                WHEN o_orderstatus = 'O' THEN concat(' C', o_custkey, ' ')
                ELSE concat('c', o_custkey) END AS source_id""",
    )


def _mapping(spark: SparkSession, d: str) -> DataFrame:
    people = v.table(spark, d, "customer").selectExpr(
        "concat('c', c_custkey) AS source_id",
        "CASE WHEN c_acctbal >= 0 THEN concat(' person-', c_custkey) ELSE ' ' END AS canonical_patient_id",
    )
    suppliers = v.table(spark, d, "supplier").selectExpr("concat('C', s_suppkey)", "concat('supplier-', s_suppkey)")
    return people.union(suppliers)


def _linked(spark: SparkSession, d: str) -> DataFrame:
    return linkage.link(_sources(spark, d), _CONFIG, _mapping(spark, d))


@register(
    "link_mapping",
    _LINKED
    + """ SELECT 'ehr' AS source_modality, source_id, canonical_patient_id, match_status,
                 'explicit_mapping' AS match_method, notes FROM linked""",
)
def link_mapping(spark: SparkSession, d: str) -> DataFrame:
    return linkage.link_records(_linked(spark, d), "ehr")


@register("linked_table", _LINKED + " SELECT o_orderkey, canonical_patient_id AS patient_id FROM linked")
def linked_table(spark: SparkSession, d: str) -> DataFrame:
    return linkage.linked_table(_linked(spark, d), _CONFIG)


_NORMALIZED = f"""
    SELECT 'mri' AS source_modality, coalesce(k, '') AS source_id, k AS canonical_patient_id,
           CASE WHEN k IS NULL THEN 'unmatched' ELSE 'matched' END AS match_status,
           'normalization:subject_to_patient' AS match_method,
           CASE WHEN k IS NULL THEN 'source identifier was missing' END AS notes
    FROM (SELECT nullif(trim(source_id), '') AS k FROM ({_SOURCES}))"""


def _normalized(spark: SparkSession, d: str) -> DataFrame:
    config = LinkageConfig("source_id", mode="subject_to_patient")
    return linkage.link_records(linkage.link(_sources(spark, d), config), "mri")


@register("link_normalised", _NORMALIZED)
def link_normalised(spark: SparkSession, d: str) -> DataFrame:
    return _normalized(spark, d)


@register(
    "link_summary",
    _LINKED
    + f""", records AS (SELECT 'ehr' AS source_modality, match_status FROM linked
                        UNION ALL SELECT source_modality, match_status FROM ({_NORMALIZED}))
      SELECT source_modality, count(DISTINCT source_modality) AS modality_count, count(*) AS row_count,
             count(*) FILTER (match_status = 'matched') AS matched_count,
             count(*) FILTER (match_status = 'unmatched') AS unmatched_count,
             count(*) FILTER (match_status = 'ambiguous') AS ambiguous_count
      FROM records GROUP BY ROLLUP (source_modality)""",
)
def link_summary(spark: SparkSession, d: str) -> DataFrame:
    each = [
        linkage.link_counts(linkage.link_records(_linked(spark, d), "ehr")),
        linkage.link_counts(_normalized(spark, d)),
    ]
    return linkage.link_summary(each)


@register(
    "link_counts",
    _LINKED
    + """ SELECT 'ehr' AS source_modality, count(*) AS row_count,
                 count(*) FILTER (match_status = 'matched') AS matched_count,
                 count(*) FILTER (match_status = 'unmatched') AS unmatched_count,
                 count(*) FILTER (match_status = 'ambiguous') AS ambiguous_count,
                 'patient_id' AS output_patient_id_col,
                 count(*) FILTER (match_status = 'unmatched') || ' ehr rows were unmatched|'
                 || count(*) FILTER (match_status = 'ambiguous') || ' ehr rows were ambiguous' AS notes
          FROM linked""",
)
def link_counts(spark: SparkSession, d: str) -> DataFrame:
    return presented(linkage.link_counts(linkage.link_records(_linked(spark, d), "ehr")))


# --- fusion ----------------------------------------------------------------------------------

_FUSED = f"""
    WITH ehr AS (SELECT CAST(o_custkey AS VARCHAR) AS patient_id, count(*)::DOUBLE AS visits,
                        sum(o_totalprice) / count(*) AS shared FROM orders GROUP BY 1),
         mri AS (SELECT CAST(s_suppkey AS VARCHAR) AS patient_id, s_acctbal AS shared FROM supplier),
         eeg AS (SELECT CASE WHEN user_id > 0 THEN CAST(user_id AS VARCHAR) END AS patient_id,
                        min(value) AS shared, count(*)::DOUBLE AS recording_count FROM events GROUP BY 1),
         fused AS (
           SELECT coalesce(ehr.patient_id, mri.patient_id, eeg.patient_id) AS patient_id,
                  ehr.patient_id IS NOT NULL AS has_ehr, mri.patient_id IS NOT NULL AS has_mri,
                  eeg.recording_count IS NOT NULL AS has_eeg, ehr.visits AS ehr_visits, {r6('ehr.shared')} AS ehr_shared,
                  {r6('mri.shared')} AS mri_shared, {r6('eeg.shared')} AS eeg_shared,
                  eeg.recording_count AS eeg_recording_count
           FROM ehr FULL JOIN mri ON ehr.patient_id = mri.patient_id
                FULL JOIN eeg ON eeg.patient_id = coalesce(ehr.patient_id, mri.patient_id))"""


def modalities(spark: SparkSession, d: str) -> dict[str, DataFrame]:
    ehr = v.table(spark, d, "orders").groupBy(F.col("o_custkey").cast("string").alias("patient_id")).agg(
        F.expr("cast(count(1) AS double) AS visits"), F.expr("sum(o_totalprice) / count(1) AS shared")
    )
    mri = v.table(spark, d, "supplier").selectExpr("cast(s_suppkey AS string) AS patient_id", "s_acctbal AS shared")
    eeg = (
        v.table(spark, d, "events")
        .selectExpr("CASE WHEN user_id > 0 THEN cast(user_id AS string) END AS patient_id", "value")
        .groupBy("patient_id")
        .agg(F.expr("min(value) AS shared"), F.expr("cast(count(1) AS double) AS recording_count"))
    )
    return {"ehr": ehr, "mri": mri, "eeg": eeg}


@register("fused", _FUSED + " SELECT * FROM fused")
def fused(spark: SparkSession, d: str) -> DataFrame:
    return presented(fusion.fuse(modalities(spark, d)))


_MODALITY_COUNTS = """count(*) FILTER (has_ehr) AS patients_with_ehr, count(*) FILTER (has_mri) AS patients_with_mri,
    count(*) FILTER (has_eeg) AS patients_with_eeg,
    count(*) FILTER (has_ehr AND has_mri AND has_eeg) AS patients_with_all_modalities"""


@register("fusion_counts", _FUSED + f" SELECT {_MODALITY_COUNTS} FROM fused")
def fusion_counts(spark: SparkSession, d: str) -> DataFrame:
    return fusion.modality_counts(fusion.fuse(modalities(spark, d)))


@register(
    "fusion_result",
    _FUSED
    + f""" SELECT count(*) AS row_count, count(DISTINCT patient_id) AS patient_count,
                  count(*) FILTER (has_ehr) AS ehr_row_count, count(*) FILTER (has_mri) AS mri_row_count,
                  count(*) FILTER (has_eeg) AS eeg_row_count, {_MODALITY_COUNTS} FROM fused""",
)
def fusion_result(spark: SparkSession, d: str) -> DataFrame:
    built = fusion.fused_dataset(**modalities(spark, d))
    return fusion.fusion_result(built.table)


@register(
    "duplicate_ids",
    """SELECT CAST(count(*) - count(DISTINCT id) - max((id IS NULL)::INT) AS BIGINT) AS duplicate_count
       FROM (SELECT CASE WHEN o_totalprice >= 5000 THEN o_custkey END AS id FROM orders)""",
)
def duplicate_ids(spark: SparkSession, d: str) -> DataFrame:
    ids = v.table(spark, d, "orders").selectExpr("CASE WHEN o_totalprice >= 5000 THEN o_custkey END AS patient_id")
    return fusion.duplicate_count(ids)


@register(
    "modality_checks",
    """SELECT count(*) AS row_count, CAST(sum((id IS NULL)::INT) AS BIGINT) AS missing_ids,
              CAST(count(*) - count(DISTINCT id) - max((id IS NULL)::INT) AS BIGINT) AS duplicate_count
       FROM (SELECT CASE WHEN l_quantity > 2 THEN l_partkey END AS id FROM lineitem)""",
)
def modality_checks(spark: SparkSession, d: str) -> DataFrame:
    ids = v.table(spark, d, "lineitem").selectExpr("CASE WHEN l_quantity > 2 THEN l_partkey END AS patient_id")
    return fusion.modality_checks(ids)


@register(
    "single_modality_rows",
    _FUSED
    + """ SELECT count(*) FILTER (has_ehr::INT + has_mri::INT + has_eeg::INT < 2) AS single_modality_rows FROM fused""",
)
def single_modality_rows(spark: SparkSession, d: str) -> DataFrame:
    from cohortweave.operators.modeling import single_modality_count

    return single_modality_count(fusion.fuse(modalities(spark, d)))


# --- profile ---------------------------------------------------------------------------------

_PROFILED = """
    WITH t AS (
      SELECT CAST(o_custkey AS VARCHAR) AS patient_id, o_orderstatus AS status, o_totalprice > 250000 AS high,
             CASE WHEN o_orderpriority <> '5-LOW' THEN o_totalprice END AS price,
             CASE WHEN o_orderstatus <> 'P' THEN o_orderdate END AS seen_at,
             CASE WHEN o_totalprice > 20000 THEN lower(o_orderpriority) END AS priority,
             CASE WHEN o_totalprice < 400000 THEN 'train' WHEN o_totalprice < 450000 THEN 'val' ELSE 'test' END AS split
      FROM orders)"""


def profiled_table(spark: SparkSession, d: str) -> DataFrame:
    # Gaps are NaN on this side, which a profile counts as missing.
    return v.table(spark, d, "orders").selectExpr(
        "cast(o_custkey AS string) AS patient_id",
        "o_orderstatus AS status",
        "o_totalprice > 250000 AS high",
        "CASE WHEN o_orderpriority <> '5-LOW' THEN o_totalprice ELSE double('nan') END AS price",
        "CASE WHEN o_orderstatus <> 'P' THEN o_orderdate END AS seen_at",
        "CASE WHEN o_totalprice > 20000 THEN lower(o_orderpriority) END AS priority",
        """CASE WHEN o_totalprice < 400000 THEN 'train' WHEN o_totalprice < 450000 THEN 'val'
                ELSE 'test' END AS split""",
    )


_COLUMNS = ("patient_id", "status", "high", "price", "seen_at", "priority", "split")
_MISSING = " UNION ALL ".join(
    f"""SELECT {i} AS position, '{c}' AS column_name, count(*) - count({c}) AS missing_count,
               {r6(f'(count(*) - count({c})) / count(*)::DOUBLE')} AS missing_fraction FROM t"""
    for i, c in enumerate(_COLUMNS)
)


@register("profile_missing", f"{_PROFILED} {_MISSING}")
def profile_missing(spark: SparkSession, d: str) -> DataFrame:
    return presented(profile.missingness(profiled_table(spark, d)))


@register(
    "profile_top_missing",
    f"""{_PROFILED} SELECT column_name, missing_count, missing_fraction FROM ({_MISSING})
        ORDER BY missing_fraction DESC, column_name LIMIT 3""",
)
def profile_top_missing(spark: SparkSession, d: str) -> DataFrame:
    return presented(profile.top_missing(profile.missingness(profiled_table(spark, d)), 3))


_NUMERIC = ("l_quantity", "l_extendedprice", "l_discount", "l_tax", "l_linenumber")


@register(
    "profile_numeric",
    " UNION ALL ".join(
        f"""SELECT '{c}' AS column_name, count(v) AS non_null_count, {r6('avg(v)')} AS mean,
                   {r6('stddev_samp(v)')} AS std, {r6('min(v)')} AS min_value, {r6('quantile_cont(v, 0.25)')} AS p25,
                   {r6('quantile_cont(v, 0.5)')} AS median, {r6('quantile_cont(v, 0.75)')} AS p75,
                   {r6('max(v)')} AS max_value
            FROM (SELECT CASE WHEN l_returnflag <> 'N' THEN CAST({c} AS DOUBLE) END AS v FROM lineitem)"""
        for c in _NUMERIC
    ),
)
def profile_numeric(spark: SparkSession, d: str) -> DataFrame:
    gapped = v.table(spark, d, "lineitem").selectExpr(
        *[f"CASE WHEN l_returnflag <> 'N' THEN {c} END AS {c}" for c in _NUMERIC]
    )
    return presented(profile.numeric_summaries(gapped))


@register(
    "profile_categories",
    f"""{_PROFILED}, long AS (
            SELECT 'patient_id' AS column_name, patient_id AS value FROM t
            UNION ALL SELECT 'status', status FROM t
            UNION ALL SELECT 'high', CASE WHEN high THEN 'True' ELSE 'False' END FROM t
            UNION ALL SELECT 'priority', priority FROM t UNION ALL SELECT 'split', split FROM t),
        counts AS (SELECT column_name, value, count(*) AS count FROM long WHERE value IS NOT NULL GROUP BY ALL),
        ranked AS (SELECT *, count(*) OVER (PARTITION BY column_name) AS unique_count,
                          row_number() OVER (PARTITION BY column_name ORDER BY count DESC, value) AS place FROM counts)
        SELECT column_name, unique_count, place, value, count FROM ranked WHERE place <= 10""",
)
def profile_categories(spark: SparkSession, d: str) -> DataFrame:
    return profile.category_cardinality(profiled_table(spark, d))


@register(
    "profile_class_balance",
    f"""{_PROFILED} SELECT CASE WHEN high THEN 'True' ELSE 'False' END AS label_value, count(*) AS count,
            {r6('count(*)::DOUBLE / (SELECT count(*) FROM t)')} AS fraction FROM t GROUP BY 1""",
)
def profile_class_balance(spark: SparkSession, d: str) -> DataFrame:
    return presented(profile.class_balance(profiled_table(spark, d), "high"))


@register(
    "profile_split_balance",
    f"""{_PROFILED} SELECT coalesce(priority, 'nan') AS split_value, count(*) AS count,
            {r6('count(*)::DOUBLE / (SELECT count(*) FROM t)')} AS fraction FROM t GROUP BY 1""",
)
def profile_split_balance(spark: SparkSession, d: str) -> DataFrame:
    return presented(profile.split_balance(profiled_table(spark, d), "priority"))


@register(
    "profile_time",
    f"""{_PROFILED} SELECT 'seen_at' AS column_name, strftime(min(seen_at), '%Y-%m-%d %H:%M:%S.%f') AS min_time,
            strftime(max(seen_at), '%Y-%m-%d %H:%M:%S.%f') AS max_time, count(seen_at) AS non_null_count FROM t""",
)
def profile_time(spark: SparkSession, d: str) -> DataFrame:
    return presented(profile.temporal_coverage(profiled_table(spark, d)))


@register("profile_patient_count", f"{_PROFILED} SELECT count(DISTINCT patient_id) AS patient_count FROM t")
def profile_patient_count(spark: SparkSession, d: str) -> DataFrame:
    return profile.patient_count(profiled_table(spark, d), "patient_id")


@register(
    "profile_summary",
    f"""{_PROFILED} SELECT 'orders' AS dataset_name, count(*) AS row_count, 7::BIGINT AS column_count,
            count(DISTINCT patient_id) AS patient_count,
            count(*) FILTER (high) AS high_count, count(*) FILTER (split = 'val') AS val_count,
            (SELECT string_agg(column_name || ':' || missing_count, '|' ORDER BY missing_fraction DESC, column_name)
             FROM ({_MISSING})) AS top_missing FROM t""",
)
def profile_summary(spark: SparkSession, d: str) -> DataFrame:
    df = profiled_table(spark, d)
    summary = profile.profile_summary(profile.profile(df, "orders", "patient_id", "high", "split"))
    return summary.selectExpr(
        "dataset_name",
        "row_count",
        "column_count",
        "patient_count",
        "class_balance['True'] AS high_count",
        "split_balance['val'] AS val_count",
        """array_join(transform(top_missing_columns,
                      r -> concat(r.column_name, ':', r.missing_count)), '|') AS top_missing""",
    )


# --- reports ---------------------------------------------------------------------------------


@register(
    "descriptor",
    """SELECT 'orders' AS dataset_name, 'ehr' AS modality, 'parquet' AS source_format, count(*) AS row_count,
              count(DISTINCT o_custkey) AS patient_count, 'Order rows.' AS description,
              'likely_dre' AS label_column FROM orders""",
)
def descriptor(spark: SparkSession, d: str) -> DataFrame:
    df = v.table(spark, d, "orders").withColumnRenamed("o_custkey", "patient_id")
    described = report.dataset_descriptor(
        df, "orders", description="Order rows.", metadata={"label_column": "likely_dre"}
    )
    return described.withColumn("label_column", F.expr("metadata['label_column']")).drop("metadata")


@register(
    "run_manifest",
    """SELECT 'run-001' AS run_id, 'cohortweave' AS project_name,
              'events:' || (SELECT count(*) FROM events) || '|orders:' || (SELECT count(*) FROM orders) AS datasets,
              'orders:table|profile:json' AS artifacts, 'first|second' AS notes""",
)
def run_manifest(spark: SparkSession, d: str) -> DataFrame:
    described = [
        report.dataset_descriptor(v.table(spark, d, name), name, patient_id=key)
        for name, key in (("orders", "o_custkey"), ("events", "user_id"))
    ]
    registry = report.artifacts(
        spark, RUN, "job", [("orders", "table", "orders.parquet", None), ("profile", "json", "profile", None)]
    )
    manifest = report.run_manifest(
        RUN, report.run_datasets(RUN, *described), registry, ["first", "second", "first"]
    )
    return manifest.selectExpr(
        "run_id",
        "run_context.project_name AS project_name",
        "array_join(transform(datasets, r -> concat(r.dataset_name, ':', r.row_count)), '|') AS datasets",
        "array_join(transform(artifacts, r -> concat(r.artifact_name, ':', r.artifact_type)), '|') AS artifacts",
        "array_join(notes, '|') AS notes",
    )


@register(
    "pipeline_summary",
    """SELECT 'run-001' AS run_id, 'cohortweave' AS project_name, 'evidence' AS stage_name, 'orders' AS dataset_name,
              count(*) AS row_count, count(DISTINCT o_custkey) AS patient_count, '/out/orders' AS orders_path,
              'one|two' AS notes FROM orders""",
)
def pipeline_summary(spark: SparkSession, d: str) -> DataFrame:
    counts = v.table(spark, d, "orders").agg(
        F.expr("count(1) AS row_count"), F.expr("count(DISTINCT o_custkey) AS patient_count")
    )
    paths = {"orders": "/out/orders", "absent": None}
    summary = report.pipeline_summary(RUN, counts, "orders", paths, ["one", "two", "one"])
    return presented(summary.withColumn("orders_path", F.expr("artifact_paths['orders']")).drop("artifact_paths"))


@register(
    "reporting_bundle",
    f"""{_PROFILED} SELECT count(*) AS summary_rows, count(*) AS profile_rows, count(DISTINCT patient_id) AS patients,
            count(*) FILTER (NOT high) AS low_count, true AS no_model, 'bundled' AS notes FROM t""",
)
def reporting_bundle(spark: SparkSession, d: str) -> DataFrame:
    df = profiled_table(spark, d)
    summary = report.pipeline_summary(RUN, df.agg(F.expr("count(1) AS row_count")), "orders", {}, [])
    bundle = report.reporting_bundle(
        summary, None, profile.profile(df, "orders", "patient_id", "high"), ["bundled", "bundled"]
    )
    return bundle.selectExpr(
        "pipeline_summary.row_count AS summary_rows",
        "dataset_profile_summary.row_count AS profile_rows",
        "dataset_profile_summary.patient_count AS patients",
        "dataset_profile_summary.class_balance['False'] AS low_count",
        "model_summary IS NULL AS no_model",
        "array_join(notes, '|') AS notes",
    )
