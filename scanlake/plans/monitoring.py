"""Queries over queue samples, folder listings and refs."""

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from scanlake.functions.labels import signed_rate
from scanlake.operators import monitoring as ops
from scanlake.plans.query import Registry
from scanlake.sources.listing import base_path, folder_inventory, open_system
from scanlake.sources.tables import table
from scanlake.streaming.records import fresh_folder

MONITORING = Registry()


def hourly_samples(spark: SparkSession, sf: str) -> DataFrame:
    """Events per type and hour as queue samples; an hour without events has no sample."""
    return (
        table(spark, sf, "events")
        .groupBy(F.col("event_type").alias("queue"), F.date_trunc("hour", "ts").alias("ts"))
        .agg(F.count(F.lit(1)).alias("length"))
    )


@MONITORING.add(
    "discover_queues",
    """SELECT DISTINCT queue FROM (SELECT c_mktsegment || '_' || c_name || '_queue' AS queue, c_custkey FROM customer)
       WHERE c_custkey % 3 <> 0 AND regexp_matches(queue, '^[A-H].*_Customer#[0-9]*[02468]_queue$') ORDER BY queue""",
)
def queues(spark: SparkSession, sf: str) -> DataFrame:
    samples = table(spark, sf, "customer").select(
        F.concat_ws("_", "c_mktsegment", "c_name", F.lit("queue")).alias("queue"),
        F.when(F.col("c_custkey") % 3 == 0, "string").otherwise("list").alias("key_type"),
    )
    return ops.discover_queues(samples, "[A-H]*_Customer[#]*[02468]_queue")


@MONITORING.add(
    "queue_rates",
    """
    WITH s AS (SELECT event_type AS queue, date_trunc('hour', ts) AS ts, count(*) AS length FROM events GROUP BY 1, 2),
    t AS (SELECT ts, lag(ts) OVER (ORDER BY ts) AS tick FROM (SELECT DISTINCT ts FROM s)),
    p AS (SELECT s.*, tick, lag(s.ts) OVER w AS prev_ts, lag(length) OVER w AS prev
          FROM s JOIN t USING (ts) WINDOW w AS (PARTITION BY queue ORDER BY s.ts)),
    r AS (SELECT *, CASE WHEN prev_ts IS NULL OR prev_ts < tick THEN 0.0::DOUBLE
                         WHEN prev > 0 THEN (length - prev)::DOUBLE / (epoch(ts - prev_ts) / 60) END AS d FROM p),
    f AS (SELECT *, last_value(d IGNORE NULLS) OVER (PARTITION BY queue ORDER BY ts) AS rate FROM r)
    SELECT queue, strftime(ts, '%Y-%m-%d %H') AS hour, length, round(rate, 6) AS rate,
           CASE WHEN rate = 0 THEN '0.0' ELSE printf('%+.1f', rate) END AS label FROM f
    """,
)
def rates(spark: SparkSession, sf: str) -> DataFrame:
    rated = ops.queue_rates(hourly_samples(spark, sf))
    return rated.select(
        "queue", F.date_format("ts", "yyyy-MM-dd HH").alias("hour"), "length",
        F.round("rate", 6).alias("rate"), signed_rate(F.col("rate")).alias("label"),
    )


@MONITORING.add(
    "recent_items",
    """
    SELECT event_type AS queue, CAST(rn AS INTEGER) AS rank, event_type || '/u' || user_id AS label
    FROM (SELECT *, row_number() OVER (PARTITION BY event_type ORDER BY ts DESC, event_id DESC) AS rn FROM events)
    WHERE rn <= 3
    """,
)
def recent(spark: SparkSession, sf: str) -> DataFrame:
    item = F.format_string('{"org":"%s","name":"u%d"}', "event_type", "user_id")
    items = table(spark, sf, "events").select(
        F.col("event_type").alias("queue"), "ts", "event_id", item.alias("item")
    )
    return ops.recent_items(items, ["ts", "event_id"])


@MONITORING.add(
    "pipeline_summary",
    """
    WITH s AS (SELECT user_id, date_trunc('day', ts) AS ts, sum(CASE WHEN event_type = 'error' THEN 1 ELSE 0 END) AS n
               FROM events GROUP BY 1, 2)
    SELECT count(*) AS queues, count(*) FILTER (n > 0) AS active_queues, CAST(sum(n) AS BIGINT) AS total_items
    FROM s WHERE ts = (SELECT max(ts) FROM s)
    """,
)
def summary(spark: SparkSession, sf: str) -> DataFrame:
    samples = (
        table(spark, sf, "events")
        .groupBy(F.col("user_id").alias("queue"), F.date_trunc("day", "ts").alias("ts"))
        .agg(F.count_if(F.col("event_type") == "error").alias("length"))
    )
    return ops.pipeline_summary(samples)


def listing(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "documents").select(
        F.concat_ws("/", F.lit("/data/shared"), "source", "lang", F.col("doc_id").cast("string")).alias("path"),
        F.lit(False).alias("is_dir"),
        F.col("n_chars").alias("size"),
        "lang",
    )


@MONITORING.add(
    "folder_stats",
    """SELECT CAST(sum(n_chars) AS BIGINT) AS total_bytes, count(*) AS files, count(DISTINCT source) AS repositories
       FROM documents""",
)
def folder(spark: SparkSession, sf: str) -> DataFrame:
    return ops.folder_stats(listing(spark, sf), "./shared", cwd="/data")


@MONITORING.add(
    "folder_stats_with_folders",
    """SELECT CAST(sum(n_chars) AS BIGINT) AS total_bytes, count(*) AS files,
              count(DISTINCT source) + (SELECT count(DISTINCT page_id) FROM pages) AS repositories
       FROM documents""",
)
def folder_with_empty_ones(spark: SparkSession, sf: str) -> DataFrame:
    """A listing with rows of folders: those of the sources and, for the pages, empty ones."""
    files = listing(spark, sf).select("path", "is_dir", "size")
    folders = files.select(F.regexp_extract("path", "^(.*)/", 1).alias("path")).distinct()
    empty = table(spark, sf, "pages").select(F.concat(F.lit("/data/shared/page_"), "page_id").alias("path"))
    none = [F.lit(True).alias("is_dir"), F.lit(0).cast("long").alias("size")]
    every = files.unionByName(folders.select("path", *none)).unionByName(empty.select("path", *none))
    return ops.folder_stats(every, "/data/shared")


def _save_files(root: str):
    """Saves texts (path, text) as files below a folder. A repeated task writes the same files again."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, base = open_system(root), base_path(root)
        for batch in batches:
            for path, text in zip(*(column.to_pylist() for column in batch.columns), strict=True):
                system.create_dir(f"{base}/{path.rpartition('/')[0]}", recursive=True)
                with system.open_output_stream(f"{base}/{path}") as out:
                    out.write(text.encode())
            yield pa.RecordBatch.from_pydict({"files": pa.array([batch.num_rows], pa.int64())})

    return work


#: A tree of the documents: of one folder per language, with a level for each digit of the id.
TREE_SQL = """
    file AS (SELECT [lang] || string_split(CAST(doc_id AS VARCHAR), '') || ['text'] AS parts, strlen(text) AS size FROM documents),
    tree AS (SELECT array_to_string(parts, '/') AS path, false AS is_dir, CAST(size AS BIGINT) AS size FROM file
             UNION ALL SELECT DISTINCT array_to_string(parts[1:k], '/'), true, CAST(0 AS BIGINT) FROM file, unnest(range(1, len(parts))) AS t(k))
"""


@MONITORING.add("folder_inventory", f"WITH {TREE_SQL} SELECT path, is_dir, size FROM tree")
def inventory(spark: SparkSession, sf: str) -> DataFrame:
    """The listing of a tree of files that the tasks save first: deep, and most of it below one folder."""
    root = fresh_folder(spark, "tree")
    digits = F.array_join(F.split(F.col("doc_id").cast("string"), ""), "/")
    files = table(spark, sf, "documents").select(F.concat_ws("/", "lang", digits, F.lit("text")).alias("path"), F.coalesce("text", F.lit("")).alias("text"))
    files.mapInArrow(_save_files(root), "files long").agg(F.sum("files")).collect()
    listed = folder_inventory(spark, root, share=200)
    return listed.select(F.substring_index("path", f"{base_path(root)}/", -1).alias("path"), "is_dir", "size")


@MONITORING.add(
    "folder_stats_by_lang",
    """SELECT lang, CAST(sum(n_chars) AS BIGINT) AS total_bytes, count(*) AS files, count(DISTINCT source) AS repositories
       FROM documents GROUP BY lang""",
)
def folder_by_lang(spark: SparkSession, sf: str) -> DataFrame:
    return ops.folder_stats(listing(spark, sf), "/data/shared/", by=["lang"])


@MONITORING.add(
    "growth_rates",
    """
    WITH s AS (SELECT o_orderpriority AS root, o_orderdate AS ts, sum(o_custkey) AS n FROM orders GROUP BY 1, 2),
    v AS (SELECT root, ts, CASE WHEN n % 7 = 0 THEN NULL WHEN n % 5 = 0 THEN 0 ELSE CAST(n AS BIGINT) * 100000 END AS size FROM s),
    p AS (SELECT *, last_value(CASE WHEN size IS NOT NULL THEN struct_pack(ts := ts, size := size) END IGNORE NULLS)
                    OVER (PARTITION BY root ORDER BY ts ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS prev FROM v),
    r AS (SELECT *, CASE WHEN size IS NULL OR prev IS NULL THEN 0.0::DOUBLE
                         WHEN prev.size > 0 THEN (size - prev.size)::DOUBLE / (epoch(ts - prev.ts) / 60) END AS d FROM p)
    SELECT root, strftime(ts, '%Y-%m-%d') AS day, size,
           round(last_value(d IGNORE NULLS) OVER (PARTITION BY root ORDER BY ts) / 1048576, 9) AS growth FROM r
    """,
)
def growth(spark: SparkSession, sf: str) -> DataFrame:
    n = F.col("n")
    samples = (
        table(spark, sf, "orders")
        .groupBy(F.col("o_orderpriority").alias("root"), F.col("o_orderdate").alias("ts"))
        .agg(F.sum("o_custkey").alias("n"))
        .select("root", "ts", F.when(n % 7 == 0, None).when(n % 5 == 0, 0).otherwise(n * 100000).alias("size"))
    )
    rated = ops.growth_rates(samples, keys=["root"], slice_by="month")
    day = F.date_format("ts", "yyyy-MM-dd").alias("day")
    return rated.select("root", day, "size", F.round("growth", 9).alias("growth"))


@MONITORING.add(
    "branch_counts",
    """SELECT 'org' || l_returnflag AS org, 'repo' || l_suppkey AS name, count(*) FILTER (l_linenumber % 3 = 1 AND l_returnflag <> 'N') AS branches
       FROM lineitem GROUP BY 1, 2""",
)
def branches(spark: SparkSession, sf: str) -> DataFrame:
    kind = F.col("l_linenumber") % 3
    prefix = F.when((kind == 1) & (F.col("l_returnflag") != "N"), "refs/heads/").when(kind == 2, "refs/tags/")
    refs = table(spark, sf, "lineitem").select(
        F.concat(F.lit("org"), "l_returnflag").alias("org"),
        F.concat(F.lit("repo"), "l_suppkey").alias("name"),
        F.concat(prefix.otherwise("refs/pull/"), "l_partkey").alias("ref"),
    )
    return ops.branch_counts(refs)


@MONITORING.add("queue_lengths", "SELECT event_type AS queue, count(*) AS length FROM events GROUP BY 1")
def lengths(spark: SparkSession, sf: str) -> DataFrame:
    return ops.queue_lengths(table(spark, sf, "events").select(F.col("event_type").alias("queue")))
