"""Content-addressed web archive: payload bytes stored once, record heads apart, records by joins.

An archive is a folder with two tables. ``payloads`` holds each distinct payload once under its SHA-256.
``records`` holds the exact bytes of every record before its payload (WARC head and HTTP head) and the address
of the payload. A record is rebuilt by joining the two on the address; its bytes are those of WARC/1.1.

Of the records with equal payloads the one of the least key is a response, the others are revisits, which
name the response and carry no payload of their own.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortweave.functions.skew import lookup_join
from cohortweave.llm.blocks import stored
from cohortweave.session import fresh_path

# Fixed values of the WARC/1.1 format.
VERSION = "WARC/1.1"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
BREAK = "\\r\\n"  # as written in Spark SQL

BASE32 = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
DIGITS = "0123456789ABCDEFGHIJKLMNOPQRSTUV"  # those of conv(..., 32)


@dataclass(frozen=True)
class Archive:
    """Folders of the two tables of an archive."""

    payloads: str
    records: str


def base32_sha1(column: str) -> str:
    """SQL: bare upper-case base32 of the SHA-1 of a binary column. Five hex digits are four of base32."""
    parts = ", ".join(f"lpad(conv(substr(_h, {5 * i + 1}, 5), 16, 32), 4, '0')" for i in range(8))
    joined = f"translate(concat({parts}), '{DIGITS}', '{BASE32}')"
    return f"element_at(transform(array(sha1({column})), _h -> {joined}), 1)"


def write_archive(
    pages: DataFrame,
    key: str = "page_id",
    url: str = "url",
    payload: str = "html",
    min_bytes: int = 0,
    date: str = "1970-01-01T00:00:00Z",
    content_type: str = "text/html; charset=utf-8",
    folder: str | None = None,
) -> Archive:
    """Write one WARC record per row of ``pages`` into a new archive.

    * A NULL payload is an empty one, and an empty payload is content like any other.
    * Payloads of fewer than ``min_bytes`` bytes are all responses; their bytes are still stored once.
    * Rows with the same least key and the same payload are all responses. NULL keys come last: they are revisits where
      a key can be referred to, else responses. Such a record has an empty id.
    * A NULL url leaves the header out; line breaks in an url or a key are percent-encoded.
    * An empty table gives an empty archive. Other columns are not read.

    Payloads with equal SHA-256 but different SHA-1 or length stop the job: the address is not proven then.
    """
    spark = pages.sparkSession
    root = folder or fresh_path(spark, "archive")
    rows = pages.select(
        F.col(key).cast("string").alias("key"),
        F.col(key).alias("key_order"),
        F.col(url).cast("string").alias("url"),
        F.coalesce(F.col(payload).cast("string").cast("binary"), F.lit(b"")).alias("payload"),
    ).selectExpr(
        "key", "key_order", "url", "payload", "sha2(payload, 256) AS address", "cast(length(payload) AS bigint) AS n_bytes",
        f"{base32_sha1('payload')} AS digest",
    )

    # Copies meet before the shuffle, so a payload in many rows is sent once per map task.
    contents = rows.groupBy("address").agg(
        F.first("payload").alias("payload"),
        F.min_by("key", "key_order").alias("first_key"),
        F.min(F.struct("n_bytes", "digest")).alias("least"),
        F.max(F.struct("n_bytes", "digest")).alias("most"),
    )
    proven = "CASE WHEN least = most THEN address ELSE raise_error(concat('Different payloads share the address ', address)) END"
    contents.selectExpr(f"{proven} AS address", "first_key", "payload").write.parquet(f"{root}/payloads")

    firsts = spark.read.parquet(f"{root}/payloads").select("address", "first_key")
    facts = lookup_join(rows.select("key", "url", "address", "n_bytes", "digest"), firsts, ["address"])
    facts.selectExpr("*", f"n_bytes >= {int(min_bytes)} AND first_key IS NOT NULL AND NOT (key <=> first_key) AS revisit").selectExpr(
        "key",
        "address",
        "revisit",
        f"encode({_head(date, content_type)}, 'UTF-8') AS head",
    ).write.parquet(f"{root}/records")
    return Archive(f"{root}/payloads", f"{root}/records")


def _head(date: str, content_type: str) -> str:
    """SQL of the exact text before the payload: WARC head, empty line, HTTP head, empty line."""

    def line(name: str, value: str) -> str:
        return f"concat('{name}: ', {value}, '{BREAK}')"

    def urn(column: str) -> str:
        return f"concat('<urn:record:', coalesce(url_encode({column}), ''), '>')"

    http = f"concat('HTTP/1.1 200 OK{BREAK}', {line('Content-Type', _quoted(content_type))}, {line('Content-Length', 'n_bytes')}, '{BREAK}')"
    location = "replace(replace(url, '\\r', '%0D'), '\\n', '%0A')"
    revisit = f"concat({line('WARC-Refers-To', urn('first_key'))}, {line('WARC-Profile', _quoted(REVISIT_PROFILE))})"
    parts = [
        f"'{VERSION}{BREAK}'",
        line("WARC-Type", "if(revisit, 'revisit', 'response')"),
        line("WARC-Record-ID", urn("key")),
        line("WARC-Date", _quoted(date)),
        f"coalesce({line('WARC-Target-URI', location)}, '')",
        line("WARC-Payload-Digest", "concat('sha1:', digest)"),
        f"if(revisit, {revisit}, '')",
        line("Content-Type", "'application/http; msgtype=response'"),
        line("Content-Length", f"octet_length({http}) + if(revisit, 0, n_bytes)"),
        f"'{BREAK}'",
        http,
    ]
    return f"concat({', '.join(parts)})"


def _quoted(text: str) -> str:
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def reconstruct(spark: SparkSession, archive: Archive) -> DataFrame:
    """``address`` and ``record``: the whole bytes of every record, ended by two line breaks.

    Only responses meet payloads. Payloads are checked against their address before they are used.
    """
    checked = "CASE WHEN sha2(payload, 256) = address THEN payload ELSE raise_error(concat('Damaged payload at ', address)) END"
    payloads = spark.read.parquet(archive.payloads).selectExpr("address", f"{checked} AS payload")
    records = spark.read.parquet(archive.records)
    end = f"encode('{BREAK}{BREAK}', 'UTF-8')"
    responses = lookup_join(records.filter("NOT revisit"), payloads, ["address"])
    missing = "raise_error(concat('No payload at ', address))"
    return responses.selectExpr("address", f"concat(head, coalesce(payload, {missing}), {end}) AS record").unionByName(
        records.filter("revisit").selectExpr("address", f"concat(head, {end}) AS record")
    )


def parse(records: DataFrame, record: str = "record") -> DataFrame:
    """Fields of WARC records (one whole record per row), beside the other columns.

    Adds ``fields`` (name and value of each WARC header line), ``http_head`` and ``payload``. Positions are found on bytes,
    so payloads may hold anything. A NULL record, or one without an empty line, gives NULLs; so do the last two columns
    of a record without an HTTP head, or whose block is shorter than its Content-Length. Columns of these three names are replaced.
    """
    gap = f"'{BREAK}{BREAK}'"
    carried = [c for c in records.columns if c not in ("fields", "http_head", "payload")]
    packed = ", ".join(f"`{c}`" for c in carried)
    rows = records.selectExpr(f"struct({packed}) AS carried", f"`{record}` AS raw")
    found = rows.selectExpr("*", f"instr(decode(raw, 'ISO-8859-1'), {gap}) AS gap").selectExpr(
        "*",
        f"""CASE WHEN gap > 0 THEN transform(
              filter(split(make_valid_utf8(cast(substring(raw, 1, gap - 1) AS string)), '{BREAK}'), x -> instr(x, ': ') > 0),
              x -> struct(substring_index(x, ': ', 1) AS name, substr(x, instr(x, ': ') + 2) AS value)) END AS fields""",
    )
    blocks = found.selectExpr("*", f"try_cast({field('Content-Length')} AS int) AS size").selectExpr(
        "*", "CASE WHEN size >= 0 AND length(raw) >= gap + 3 + size THEN substring(raw, gap + 4, size) END AS block"
    )
    return blocks.selectExpr("*", f"instr(decode(block, 'ISO-8859-1'), {gap}) AS http").selectExpr(
        "carried.*",
        "fields",
        "CASE WHEN http > 0 THEN make_valid_utf8(cast(substring(block, 1, http - 1) AS string)) END AS http_head",
        "CASE WHEN http > 0 THEN substring(block, http + 4, length(block)) END AS payload",
    )


def field(name: str) -> str:
    """SQL: value of the first header line of that name, in any case; NULL without one."""
    return f"get(filter(fields, x -> lower(x.name) = '{name.lower()}'), 0).value"


def read_archive(spark: SparkSession, archive: Archive) -> DataFrame:
    """One row per record as read back: ``key``, ``record_type``, ``payload_bytes``, ``payload_digest``, ``refers_to``.

    Length and digest come from the payload inside the rebuilt response; a revisit takes them from the response it
    refers to. A digest that differs from the one the record states stops the job.
    """

    def key(name: str) -> str:
        return f"url_decode(nullif(regexp_extract({field(name)}, '^<urn:record:(.*)>$', 1), '')) "

    rows = parse(reconstruct(spark, archive)).selectExpr(
        "address",
        f"{key('WARC-Record-ID')} AS key",
        f"{field('WARC-Type')} AS record_type",
        f"{key('WARC-Refers-To')} AS refers_to",
        f"substr({field('WARC-Payload-Digest')}, 6) AS stated",
        "cast(length(payload) AS bigint) AS n_bytes",
        f"{base32_sha1('payload')} AS digest",
    )
    rows = stored(rows, "archive-read")
    responses = rows.filter("record_type = 'response'")
    targets = responses.filter("key IS NOT NULL").groupBy("address", F.col("key").alias("refers_to"))
    measured = targets.agg(F.min("n_bytes").alias("_bytes"), F.min("digest").alias("_digest"))
    revisits = lookup_join(rows.filter("record_type = 'revisit'").drop("n_bytes", "digest"), measured, ["address", "refers_to"])
    told = responses.unionByName(revisits.withColumnsRenamed({"_bytes": "n_bytes", "_digest": "digest"}))
    proven = "CASE WHEN digest = stated THEN digest ELSE raise_error(concat('Payload differs from its record: ', key)) END"
    return told.selectExpr("key", "record_type", "n_bytes AS payload_bytes", f"{proven} AS payload_digest", "refers_to")


def archived(pages: DataFrame, **options) -> DataFrame:
    """Write ``pages`` into a new archive and read it back."""
    return read_archive(pages.sparkSession, write_archive(pages, **options))
