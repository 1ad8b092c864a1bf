"""Registered queries for sources: cleaning, extracts, inventories, decoding, increments."""

from __future__ import annotations

import codecs
from collections.abc import Iterator
from typing import BinaryIO

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cohortweave.operators import volume
from cohortweave.plans import views as v
from cohortweave.plans.registry import presented, register
from cohortweave.session import fresh_path
from cohortweave.sources import decode, files, sinks, tables
from cohortweave.streaming.incremental import load_increment, loaded_rows

# --- text cleaning ---------------------------------------------------------------------------


@register(
    "clean_table",
    """SELECT CAST(o_orderkey AS VARCHAR) AS id,
              CASE WHEN o_orderpriority <> '5-LOW' THEN o_orderpriority END AS code,
              CASE WHEN o_orderstatus <> 'P' THEN o_custkey::DOUBLE END AS number,
              CASE WHEN o_orderstatus <> 'F' THEN strftime(o_orderdate, '%Y-%m-%d %H:%M:%S.%f') END AS seen_at
       FROM orders""",
)
def clean_table(spark: SparkSession, d: str) -> DataFrame:
    raw = v.table(spark, d, "orders").selectExpr(
        "cast(o_orderkey AS string) AS id",
        "CASE WHEN o_orderpriority = '5-LOW' THEN 'n/a' ELSE o_orderpriority END AS code",
        "CASE WHEN o_orderstatus = 'P' THEN 'twelve' ELSE cast(o_custkey AS string) END AS number",
        """CASE WHEN o_orderstatus = 'F' THEN 'unknown day'
                WHEN o_orderstatus = 'O' THEN date_format(o_orderdate, 'MM/dd/yyyy')
                ELSE date_format(o_orderdate, 'yyyy-MM-dd') END AS seen_at""",
        "o_totalprice AS unused",
    )
    request = tables.TableRequest(
        "orders.parquet",
        columns=["id", "code", "number", "seen_at", "id", "absent"],
        required=["id", "code"],
        types={"number": "double"},
        dates=["seen_at"],
        date_formats=("MM/dd/yyyy",),
    )
    chosen, _ = tables.project(raw, request.columns)
    tables.check_required(chosen, request)
    return presented(tables.clean(chosen, request))


@register(
    "load_metadata",
    """SELECT count(*) AS row_count, 'parquet' AS file_format, 'event_id|user_id|ts' AS loaded_columns,
              'event_id=' || count(*) FILTER (event_id IS NULL) || '|user_id=' || count(*) FILTER (user_id IS NULL)
                  || '|ts=' || count(*) FILTER (ts IS NULL) AS missing_values,
              '' AS missing_required_columns, false AS used_chunking,
              'file format inferred from path|requested selected column missing: absent|selected columns were used'
                  AS notes
       FROM events""",
)
def load_metadata(spark: SparkSession, d: str) -> DataFrame:
    request = tables.TableRequest(
        f"{d}/events.parquet", columns=["event_id", "user_id", "ts", "absent"], required=["user_id"]
    )
    _, record = tables.store_with_metadata(spark, request, fresh_path(spark, "loaded"))
    missing = "array_join(transform(loaded_columns, c -> concat(c, '=', missing_counts[c])), '|') AS missing_values"
    return presented(record.selectExpr("*", missing).drop("path", "column_names", "missing_counts"))


@register(
    "csv_round_trip",
    """SELECT CAST(o_orderkey AS VARCHAR) AS id, '0' || o_custkey AS code, o_totalprice + 0.0 AS price,
              strftime(o_orderdate, '%Y-%m-%d %H:%M:%S.%f') AS seen_at,
              CASE WHEN o_orderstatus <> 'P' THEN 'say "' || o_orderpriority || '", twice' END AS note
       FROM orders""",
)
def csv_round_trip(spark: SparkSession, d: str) -> DataFrame:
    """Written as gzip CSV and loaded again: quotes, zero-led codes, types, dates and gaps survive."""
    out = v.table(spark, d, "orders").selectExpr(
        "o_orderkey AS id",
        "concat('0', o_custkey) AS code",
        "o_totalprice AS price",
        "o_orderdate AS seen_at",
        """CASE WHEN o_orderstatus <> 'P' THEN concat('say "', o_orderpriority, '", twice') ELSE 'NaN' END AS note""",
    )
    path = sinks.write_table(out, fresh_path(spark, "orders") + ".csv.gz", "csv.gz")
    request = tables.TableRequest(path, types={"price": "double"}, dates=["seen_at"], required=["id", "code"])
    return presented(tables.load_table(spark, request)[0])


@register(
    "participants_file",
    """SELECT 'sub-' || c_custkey AS participant_id, c_mktsegment AS segment, c_acctbal + 0.0 AS balance,
              CASE WHEN c_acctbal > 0 THEN c_nationkey::DOUBLE END AS nation FROM customer""",
)
def participants_file(spark: SparkSession, d: str) -> DataFrame:
    """A tab-separated participant file with numeric columns found by value."""
    path = fresh_path(spark, "participants") + ".tsv"
    v.table(spark, d, "customer").selectExpr(
        "concat('sub-', c_custkey) AS participant_id",
        "c_mktsegment AS segment",
        "c_acctbal AS balance",
        "CASE WHEN c_acctbal > 0 THEN cast(c_nationkey AS string) ELSE 'n/a' END AS nation",
    ).write.options(header=True, sep="\t").csv(path)
    loaded = tables.load_participants(spark, path, required=True)
    return presented(loaded.withColumn("nation", F.col("nation").cast("double")))


@register(
    "normalised_diagnoses",
    "SELECT CAST(o_custkey AS VARCHAR) AS patient_id, o_orderpriority AS diagnosis_code FROM orders",
)
def normalised_diagnoses(spark: SparkSession, d: str) -> DataFrame:
    extract = v.table(spark, d, "orders").selectExpr(
        "cast(o_custkey AS string) AS subject_id", "o_orderkey AS hadm_id", "o_orderpriority AS icd_code"
    )
    return tables.normalize_diagnoses(extract)


@register(
    "normalised_prescriptions",
    """SELECT CAST(l_orderkey AS VARCHAR) AS patient_id, p_name AS medication_name,
              strftime(l_shipdate, '%Y-%m-%d') AS medication_start, '' AS medication_end
       FROM lineitem JOIN part ON l_partkey = p_partkey""",
)
def normalised_prescriptions(spark: SparkSession, d: str) -> DataFrame:
    extract = v.table(spark, d, "lineitem").join(v.table(spark, d, "part"), F.expr("l_partkey = p_partkey")).selectExpr(
        "cast(l_orderkey AS string) AS subject_id",
        "p_name AS drug",
        "date_format(l_shipdate, 'yyyy-MM-dd') AS starttime",
        "l_quantity AS dose",
    )
    return tables.normalize_prescriptions(extract)


@register(
    "table_validation",
    """SELECT 'orders' AS name, true AS present, 'orders.parquet' AS path, 'present, rows=' || count(*) AS detail FROM orders
       UNION ALL SELECT 'lineitem', true, 'lineitem.parquet', 'present, rows=' || count(*) FROM lineitem
       UNION ALL SELECT 'customer', false, 'customer.parquet', 'missing columns: [''a_column'', ''b_column'']'""",
)
def table_validation(spark: SparkSession, d: str) -> DataFrame:
    required = {
        "orders": ["o_orderkey", "o_custkey"],
        "lineitem": ["l_orderkey"],
        "customer": ["c_custkey", "b_column", "a_column"],
    }
    checks = [
        tables.check_frame(v.table(spark, d, name), name, f"{name}.parquet", columns)
        for name, columns in required.items()
    ]
    return checks[0].union(checks[1]).union(checks[2])


# --- inventories from path lists -------------------------------------------------------------


def _image_paths(spark: SparkSession, d: str) -> DataFrame:
    paths = v.table(spark, d, "orders").selectExpr(
        """concat('/bids/sub-', o_custkey, CASE WHEN o_orderstatus = 'F' THEN '/anat/' ELSE '/func/' END,
                  'run-', o_orderkey, '_T1w.nii.gz') AS path"""
    )
    return files.relative_paths(paths, "/bids")


@register(
    "image_inventory",
    """SELECT 'sub-' || o_custkey AS subject_id,
              min(CASE WHEN o_orderstatus = 'F'
                       THEN '/bids/sub-' || o_custkey || '/anat/run-' || o_orderkey || '_T1w.nii.gz' END) AS t1_path,
              max(o_orderstatus = 'F') AS has_t1
       FROM orders GROUP BY o_custkey""",
)
def image_inventory(spark: SparkSession, d: str) -> DataFrame:
    return files.image_inventory(_image_paths(spark, d))


@register(
    "missing_image_errors",
    """SELECT 'sub-' || o_custkey AS subject_id, 'missing_t1' AS error_type,
              'subject has no discovered T1w image' AS error_message
       FROM orders GROUP BY o_custkey HAVING max(o_orderstatus = 'F') = false""",
)
def missing_image_errors(spark: SparkSession, d: str) -> DataFrame:
    return volume.missing_image_errors(files.image_inventory(_image_paths(spark, d)))


@register(
    "recording_inventory",
    """SELECT CASE WHEN o_orderstatus = 'F' THEN 'CHB' || o_custkey WHEN o_orderstatus = 'O' THEN 'patient-' || o_custkey
                   ELSE 'r.' || o_orderkey END AS patient_id,
              '/eeg/' || CASE WHEN o_orderstatus = 'F' THEN 'CHB' || o_custkey || '/day1/'
                              WHEN o_orderstatus = 'O' THEN 'sub-x/patient-' || o_custkey || '/'
                              ELSE 'other/' END
                      || 'r.' || o_orderkey || CASE WHEN o_totalprice > 250000 THEN '.edf' ELSE '.EDF' END AS edf_path,
              'r.' || o_orderkey || CASE WHEN o_totalprice > 250000 THEN '.edf' ELSE '.EDF' END AS file_name
       FROM orders WHERE o_totalprice > 20000""",
)
def recording_inventory(spark: SparkSession, d: str) -> DataFrame:
    # Cheap orders stand for files of another kind, which the inventory leaves out.
    paths = v.table(spark, d, "orders").selectExpr(
        """concat('file:///eeg/',
                  CASE WHEN o_orderstatus = 'F' THEN concat('CHB', o_custkey, '/day1/')
                       WHEN o_orderstatus = 'O' THEN concat('sub-x/patient-', o_custkey, '/')
                       ELSE 'other/' END,
                  'r.', o_orderkey,
                  CASE WHEN o_totalprice > 250000 THEN '.edf' WHEN o_totalprice > 20000 THEN '.EDF'
                       ELSE '.txt' END) AS path"""
    )
    return files.recording_inventory(files.relative_paths(paths, "/eeg"))


@register(
    "folder_validation",
    """SELECT 'images' AS name, true AS present, '/bids' AS path,
              'subjects=' || count(DISTINCT o_custkey) || ', t1_files='
              || count(DISTINCT o_custkey) FILTER (o_orderstatus = 'F') || ', participants_tsv=True' AS detail
       FROM orders
       UNION ALL SELECT 'recordings', true, '/eeg', 'edf_files=' || count(*) FROM orders""",
)
def folder_validation(spark: SparkSession, d: str) -> DataFrame:
    images = files.check_images(files.image_inventory(_image_paths(spark, d)), "images", "/bids", True)
    paths = v.table(spark, d, "orders").selectExpr("concat('/eeg/chb', o_custkey, '/', o_orderkey, '.edf') AS path")
    recordings = files.recording_inventory(files.relative_paths(paths, "/eeg"))
    return images.union(files.check_recordings(recordings, "recordings", "/eeg"))


# --- decoding --------------------------------------------------------------------------------

_LINE = T.StructType([T.StructField("line_no", T.LongType()), T.StructField("n_chars", T.LongType())])


def _decode_lines(content: bytes) -> Iterator[dict[str, list]]:
    """Line lengths of a text; one without a line break is refused."""
    lines = content.decode("utf-8").split("\n")
    if len(lines) < 2:
        raise ValueError("text has a single line")
    yield {"line_no": list(range(len(lines))), "n_chars": [len(line) for line in lines]}


def decoded_documents(spark: SparkSession, d: str) -> DataFrame:
    texts = v.table(spark, d, "documents").selectExpr("doc_id", "encode(text, 'utf-8') AS content")
    return decode.decode_to(texts, ["doc_id"], _decode_lines, _LINE, fresh_path(spark, "decoded"))


@register(
    "decode_errors",
    """SELECT doc_id, 'ValueError' AS error_type, 'text has a single line' AS error_message
       FROM documents WHERE NOT contains(text, chr(10))""",
)
def decode_errors(spark: SparkSession, d: str) -> DataFrame:
    return decode.decode_errors(decoded_documents(spark, d), ["doc_id"])


@register(
    "decoded_rows",
    """SELECT doc_id, count(*) AS lines, CAST(sum(length(line)) AS BIGINT) AS chars
       FROM (SELECT doc_id, unnest(string_split(text, chr(10))) AS line FROM documents WHERE contains(text, chr(10)))
       GROUP BY doc_id""",
)
def decoded_rows(spark: SparkSession, d: str) -> DataFrame:
    rows = decode.decoded_rows(decoded_documents(spark, d))
    return rows.groupBy("doc_id").agg(F.expr("count(1) AS lines"), F.expr("sum(n_chars) AS chars"))


def _count_lines(file: BinaryIO) -> Iterator[dict[str, list]]:
    """Lines of a text file, each ended by a line break; read in pieces, whatever its size."""
    decoder, lines, chars = codecs.getincrementaldecoder("utf-8")(), 0, 0
    while piece := file.read(1 << 20):
        text = decoder.decode(piece)
        breaks = text.count("\n")
        lines, chars = lines + breaks, chars + len(text) - breaks
    decoder.decode(b"", final=True)
    yield {"line_no": [lines], "n_chars": [chars]}


_count_lines.reads_file = _count_lines.validates_first = True  # its only piece comes last


@register(
    "decoded_files",
    """SELECT lang, CAST(sum(length(text) - length(replace(text, chr(10), '')) + 1) AS BIGINT) AS lines,
              CAST(sum(length(replace(text, chr(10), ''))) AS BIGINT) AS chars
       FROM documents GROUP BY lang""",
)
def decoded_files(spark: SparkSession, d: str) -> DataFrame:
    """Documents as text files of each language, read back by tasks that open the files themselves."""
    folder = fresh_path(spark, "text-files")
    v.table(spark, d, "documents").select("lang", "text").write.partitionBy("lang").text(folder)
    listed = files.list_files(spark, folder, "*.txt").selectExpr("path", "regexp_extract(path, 'lang=([^/]+)/', 1) AS lang")
    decoded = decode.read_files(listed, "path", ["lang"], _count_lines, _LINE)
    rows = decode.decoded_rows(decode.stored(decoded, fresh_path(spark, "decoded")))
    return rows.groupBy("lang").agg(F.expr("sum(line_no) AS lines"), F.expr("sum(n_chars) AS chars"))


# --- incremental load ------------------------------------------------------------------------


@register(
    "incremental_load",
    """SELECT 0 AS batch_id, count(*) AS row_count, true AS used_chunking, 'event_id|user_id|event_type' AS loaded_columns,
              'file format inferred from path|chunking was used|selected columns were used' AS notes FROM events""",
)
def incremental_load(spark: SparkSession, d: str) -> DataFrame:
    folder = fresh_path(spark, "increment")
    request = tables.TableRequest(
        f"{d}/events*.parquet", columns=["event_id", "user_id", "event_type"], required=["event_id"]
    )
    log = load_increment(
        spark,
        request,
        v.table(spark, d, "events").schema,
        1,
        f"{folder}/rows",
        f"{folder}/log",
        f"{folder}/state",
    )
    return presented(log.select("batch_id", "row_count", "used_chunking", "loaded_columns", "notes"))


@register(
    "incremental_rows",
    """SELECT event_id, user_id, event_type, value + 0.0 AS value,
              CASE WHEN event_type = (SELECT min(event_type) FROM events) THEN 1 ELSE 2 END AS increment
       FROM events""",
)
def incremental_rows(spark: SparkSession, d: str) -> DataFrame:
    """Rows of two increments of several CSV files each; the stream stops in between and takes up where it was."""
    folder = fresh_path(spark, "increments")
    events = v.table(spark, d, "events").select("event_id", "user_id", "event_type", "value")
    least = events.agg(F.expr("min(event_type)")).first()[0]  # one value
    request = tables.TableRequest(f"{folder}/in", "csv", required=["event_id"], types={"value": "double"})
    loaded = []
    for arrived in (events.filter(F.col("event_type") == least), events.filter(F.col("event_type") != least)):
        arrived.repartition(3, "event_id").write.mode("append").options(header=True, escape='"').csv(f"{folder}/in")
        log = load_increment(spark, request, events.schema, 2, f"{folder}/rows", f"{folder}/log", f"{folder}/state")
        loaded.append(log.agg(F.expr("max(batch_id)")).first()[0])  # one number
    rows = loaded_rows(spark, f"{folder}/rows", events.schema)
    return presented(rows.selectExpr("event_id", "user_id", "event_type", "value", f"if(batch_id <= {loaded[0]}, 1, 2) AS increment"))
