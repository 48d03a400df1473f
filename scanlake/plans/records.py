"""Queries over record decoding, encoding, upserts and bulk payloads."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from scanlake import schemas
from scanlake.functions.labels import rfc3339
from scanlake.operators import documents as docs
from scanlake.operators import flushes
from scanlake.plans.query import Registry
from scanlake.sources.records import (
    decode_records,
    encode_records,
    reject_items,
    reject_pages,
    reject_records,
    repo_inventory,
)
from scanlake.sources import bulk as bulk_files
from scanlake.sources.tables import table
from scanlake.streaming.records import fresh_folder

RECORDS = Registry()

EVENT_RECORD = schemas.record(
    event_type=schemas.STRING, user_id=schemas.LONG, k=schemas.INT, at=schemas.TIME
)


def listing_pages(spark: SparkSession, sf: str) -> DataFrame:
    """A page per supplier, of which some are broken and some hold items that are no repository."""
    owners = table(spark, sf, "supplier").join(
        table(spark, sf, "nation"), F.col("s_nationkey") == F.col("n_nationkey")
    )
    forms = [
        '[{"name":"%1$s","id":1},{"name":"%1$s-fork"},{"id":2}]',
        '[{"name":"%1$s"},5,{"name":7},{"name":{"x":1}},null,{"name":"%1$s-fork"},["a"],{"name":null}]',
        '[{"name":"%1$s"}',
        '[{"name":"%1$s"}] tail',
        '{"name":"%1$s"}',
        '[{"name":"%1$s"}][{"name":"b"}]',
        "[]",
    ]
    page = F.element_at(F.array(*[F.format_string(form, "s_name") for form in forms]), (F.col("s_suppkey") % 7 + 1).cast("int"))
    return owners.select("s_suppkey", "n_name", page.alias("value"))


@RECORDS.add(
    "repo_inventory",
    """
    SELECT n_name AS org, unnest([s_name, s_name || '-fork', '']) AS name
    FROM supplier JOIN nation ON s_nationkey = n_nationkey
    WHERE s_suppkey % 7 IN (0, 1)
    """,
)
def inventory(spark: SparkSession, sf: str) -> DataFrame:
    return repo_inventory(listing_pages(spark, sf), F.col("n_name"))


@RECORDS.add("reject_pages", "SELECT s_suppkey FROM supplier WHERE s_suppkey % 7 IN (2, 3, 4, 5)")
def refused_pages(spark: SparkSession, sf: str) -> DataFrame:
    return reject_pages(listing_pages(spark, sf)).select("s_suppkey")


@RECORDS.add(
    "reject_items",
    """
    SELECT s_suppkey, unnest([1, 2, 3, 4, 6]) AS item_no, unnest(['5', '{"name":7}', '{"name":{"x":1}}', 'null', '["a"]']) AS item
    FROM supplier WHERE s_suppkey % 7 = 1
    """,
)
def refused_items(spark: SparkSession, sf: str) -> DataFrame:
    return reject_items(listing_pages(spark, sf), keep=["s_suppkey"])


def event_lines(spark: SparkSession, sf: str) -> DataFrame:
    """Events as JSON text, some of it malformed in each way a decoder must notice."""
    events = table(spark, sf, "events")
    kind = F.col("event_id") % 11
    quoted = F.concat(F.lit('"'), "event_type", F.lit('"'))
    event_type = F.when(kind == 1, "5").when(kind == 3, "null").otherwise(quoted)
    user = F.when(kind == 4, "").otherwise(F.concat(F.lit('"user_id": '), "user_id", F.lit(", ")))
    at = F.when(kind == 5, "2024-01-01").otherwise(rfc3339(F.col("ts")))
    whole = F.concat(
        F.lit('{"event_type": '), event_type, F.lit(", "), user,
        F.lit('"at": "'), at, F.lit('", '), F.expr("substring(props, 2)"),
    )
    text = (
        F.when(kind == 0, F.expr("substring(props, 1, 3)"))
        .when(kind == 2, F.concat(whole, F.lit(" tail")))
        .when(kind == 6, F.concat(whole, whole))
        .otherwise(whole)
    )
    return events.select("event_id", text.alias("value"))


@RECORDS.add(
    "decode_records",
    """
    SELECT event_id,
           CASE WHEN event_id % 11 = 3 THEN '' ELSE event_type END AS event_type,
           CASE WHEN event_id % 11 = 4 THEN 0 ELSE user_id END AS user_id,
           CAST(regexp_extract(props, '[0-9]+') AS INTEGER) AS k,
           strftime(ts, '%Y-%m-%d %H:%M:%S.%f') AS at
    FROM events WHERE event_id % 11 NOT IN (0, 1, 2, 5, 6)
    """,
)
def decoded(spark: SparkSession, sf: str) -> DataFrame:
    rows = decode_records(event_lines(spark, sf), EVENT_RECORD, keep=["event_id"])
    return rows.withColumn("at", F.date_format("at", "yyyy-MM-dd HH:mm:ss.SSSSSS"))


@RECORDS.add(
    "reject_records", "SELECT event_id FROM events WHERE event_id % 11 IN (0, 1, 2, 5, 6)"
)
def rejected(spark: SparkSession, sf: str) -> DataFrame:
    return reject_records(event_lines(spark, sf), EVENT_RECORD).select("event_id")


@RECORDS.add(
    "encode_records",
    """
    SELECT doc_id,
           '{"source":' || to_json(source) || ',"text":' || to_json("text")
           || ',"scanned_at":"' || strftime(TIMESTAMP '2024-01-01' + to_seconds(n_chars), '%Y-%m-%dT%H:%M:%SZ') || '"'
           || CASE WHEN doc_id % 3 = 0 THEN '' ELSE ',"error_message":"e' || doc_id || '"' END
           || CASE WHEN doc_id % 2 = 0 THEN '' ELSE ',"tags":["' || lang || '"]' END
           || ',"findings":[{"line":' || n_chars
           || CASE WHEN doc_id % 5 = 0 THEN '' ELSE ',"service":"s"' END || '}]}' AS value
    FROM documents
    """,
)
def encoded(spark: SparkSession, sf: str) -> DataFrame:
    doc = F.col("doc_id")
    service = F.when(doc % 5 == 0, "").otherwise("s")
    rows = table(spark, sf, "documents").select(
        "doc_id",
        "source",
        "text",
        F.timestamp_seconds(F.col("n_chars") + 1704067200).alias("scanned_at"),
        F.when(doc % 3 == 0, "").otherwise(F.concat(F.lit("e"), doc)).alias("error_message"),
        F.when(doc % 2 == 0, F.array().cast("array<string>")).otherwise(F.array("lang")).alias("tags"),
        F.array(F.struct(F.col("n_chars").alias("line"), service.alias("service"))).alias("findings"),
    )
    omit = ["error_message", "tags", "findings.service"]
    return encode_records(rows, omit, keep=["doc_id"])


UPSERT_SQL = """
    SELECT user_id, event_id, event_type, strftime(ts, '%Y-%m-%d %H:%M:%S.%f') AS at
    FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS rn FROM events)
    WHERE rn = 1
"""


@RECORDS.add("upsert_latest", UPSERT_SQL)
def upserted(spark: SparkSession, sf: str) -> DataFrame:
    events = table(spark, sf, "events").select("user_id", "event_id", "event_type", "ts")
    seq = ["ts", "event_id"]
    old = docs.latest_documents(events.filter("event_id % 3 = 0"), ["user_id"], seq)
    merged = docs.upsert_documents(old, events.filter("event_id % 3 <> 0"), ["user_id"], seq)
    at = F.date_format("ts", "yyyy-MM-dd HH:mm:ss.SSSSSS").alias("at")
    return merged.select("user_id", "event_id", "event_type", at)


@RECORDS.add(
    "bulk_lines",
    """
    WITH d AS (
        SELECT 'orders_' || o_orderkey AS id,
               '{"organization":"c' || o_custkey || '","scan_status":"' || o_orderstatus || '"'
               || CASE WHEN o_orderkey % 4 = 0 THEN '' ELSE ',"error_message":' || to_json(o_orderpriority) END
               || ',"scanned_at":"' || strftime(o_orderdate, '%Y-%m-%dT%H:%M:%SZ') || '"}' AS body
        FROM orders)
    SELECT 'secrets' AS "index", id, 0 AS pos, '{"index":{"_id":"' || id || '","_index":"secrets"}}' AS line FROM d
    UNION ALL SELECT 'secrets', id, 1, body FROM d
    """,
)
def bulk(spark: SparkSession, sf: str) -> DataFrame:
    rows = table(spark, sf, "orders").select(
        F.lit("secrets").alias("index"),
        F.concat(F.lit("orders_"), "o_orderkey").alias("id"),
        F.concat(F.lit("c"), "o_custkey").alias("organization"),
        F.col("o_orderstatus").alias("scan_status"),
        F.when(F.col("o_orderkey") % 4 == 0, "").otherwise(F.col("o_orderpriority")).alias("error_message"),
        F.col("o_orderdate").alias("scanned_at"),
    )
    return docs.bulk_lines(rows, omit_empty=["error_message"])


@RECORDS.add(
    "bulk_batches",
    """
    SELECT event_type, event_id, CAST((rn - 1) // 50 AS BIGINT) AS batch, CAST((rn - 1) % 50 + 1 AS INTEGER) AS position
    FROM (SELECT *, row_number() OVER (PARTITION BY event_type ORDER BY ts, event_id) AS rn FROM events)
    """,
)
def batches(spark: SparkSession, sf: str) -> DataFrame:
    events = table(spark, sf, "events").select("event_type", "event_id", "ts")
    return docs.assign_batches(events, ["ts", "event_id"], ["event_type"], "day").drop("ts")



@RECORDS.add(
    "bulk_sink",
    """
    SELECT CAST(event_id AS VARCHAR) AS id, '{"index":{"_id":"' || event_id || '","_index":"' || event_type || '"}}' AS action,
           '{"event_id":' || event_id || ',"user_id":' || user_id || '}' AS body
    FROM events
    """,
)
def sunk(spark: SparkSession, sf: str) -> DataFrame:
    """Documents written as payload files and read back: each action line with the body line behind it."""
    path = fresh_folder(spark, "bulk-files")
    events = table(spark, sf, "events")
    rows = events.select(F.col("event_type").alias("index"), F.col("event_id").cast("string").alias("id"), "event_id", "user_id")
    bulk_files.write_bulk_files(docs.bulk_pairs(rows), path)
    lines = bulk_files.read_bulk_files(spark, path)
    pairs = lines.groupBy("file", F.floor(F.col("pos") / 2).alias("n")).agg(
        F.max(F.when(F.col("pos") % 2 == 0, F.col("line"))).alias("action"), F.max(F.when(F.col("pos") % 2 == 1, F.col("line"))).alias("body")
    )
    return pairs.select(F.get_json_object("action", "$.index._id").alias("id"), "action", "body")


def flushes_sql(key: str, deadline: str) -> str:
    """From flush to flush: the next one begins after 50 documents or with the first document at or after the deadline."""
    return f"""
    WITH RECURSIVE docs AS MATERIALIZED (
        SELECT {key} AS buffer, event_id, ts, row_number() OVER (PARTITION BY {key} ORDER BY ts, event_id) AS rn FROM events
    ), nexts AS MATERIALIZED (
        SELECT d.buffer, d.rn, least(d.rn + 50, d.rn + count(*) FILTER (x.ts < {deadline})) AS following
        FROM docs d CROSS JOIN range(51) r(k) JOIN docs x ON x.buffer = d.buffer AND x.rn = d.rn + k GROUP BY d.buffer, d.rn, d.ts
    ), chain AS (
        SELECT buffer, CAST(1 AS BIGINT) AS rn, CAST(0 AS BIGINT) AS flush FROM docs WHERE rn = 1
        UNION ALL
        SELECT c.buffer, n.following, c.flush + 1 FROM chain c JOIN nexts n ON n.buffer = c.buffer AND n.rn = c.rn
        WHERE n.following <= (SELECT max(rn) FROM docs d WHERE d.buffer = c.buffer)
    )
    SELECT d.event_id, c.flush, CAST(d.rn - c.rn + 1 AS INTEGER) AS position FROM docs d ASOF JOIN chain c ON d.buffer = c.buffer AND d.rn >= c.rn
    """


@RECORDS.add("bulk_flushes", flushes_sql("1", "d.ts + INTERVAL 3 HOUR"))
def flushed_by_age(spark: SparkSession, sf: str) -> DataFrame:
    """One buffer for events of every type."""
    events = table(spark, sf, "events").select("event_id", "event_type", "ts")
    found = flushes.bulk_flushes(events, ["ts", "event_id"], "day", seconds=3 * 3600, clock="age")
    return found.select("event_id", "flush", "position")


@RECORDS.add("bulk_flushes_by_tick", flushes_sql("event_type", "time_bucket(INTERVAL 5 HOUR, d.ts, TIMESTAMP '2024-01-01 01:00:00') + INTERVAL 5 HOUR"))
def flushed_by_tick(spark: SparkSession, sf: str) -> DataFrame:
    """A buffer for each event type, and a clock that ticks every five hours."""
    events = table(spark, sf, "events").select("event_id", "event_type", "ts")
    found = flushes.bulk_flushes(
        events, ["ts", "event_id"], "day", ["event_type"], seconds=5 * 3600, clock="tick", origin="2024-01-01T01:00:00"
    )
    return found.select("event_id", "flush", "position")
