"""The merged document table, de-duplication with bounded state."""

from datetime import datetime, timedelta

from pyspark.sql import functions as F

from scanlake.streaming import merged
from scanlake.streaming import records as streams

SCHEMA = "org string, id int, seq int, body string"


def feed(spark, source, rows):
    spark.createDataFrame(rows, SCHEMA).coalesce(1).write.mode("append").parquet(source)


def flush(spark, base, buckets=8):
    stream = spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).parquet(f"{base}/in")
    streams.drain(merged.merged_sink(stream, f"{base}/table", ["org", "id"], ["seq"], buckets), f"{base}/checkpoint")
    return stream.schema


def test_flushes_merge_touched_buckets_only(spark, tmp_path):
    base = str(tmp_path)
    batches = [
        [("a", i, 1, "first") for i in range(50)] + [(None, 1, 1, "null org")],
        [("a", 3, 2, "second"), ("a", 4, 0, "older"), (None, 1, 1, "a tie goes to the later flush")],
        [("a", 3, 5, "third"), ("a", 3, 4, "in one flush the larger seq wins")],
    ]
    for rows in batches:
        feed(spark, f"{base}/in", rows)
        schema = flush(spark, base)
    want = {("a", i): (1, "first") for i in range(50)} | {("a", 3): (5, "third"), (None, 1): (1, "a tie goes to the later flush")}
    live = merged.read_merged(spark, f"{base}/table", schema)
    assert {(r.org, r.id): (r.seq, r.body) for r in live.collect()} == want and live.count() == len(want)
    versions = spark.read.parquet(f"{base}/table").select("epoch", "bucket").distinct().collect()
    assert sum(r.epoch == 2 for r in versions) == 1  # the last flush had one key
    assert sum(r.epoch == 1 for r in versions) <= 3
    # A read opens one version of each bucket; the others are listed.
    files = [r[0] for r in live.select(F.input_file_name()).distinct().collect()]
    plan = live._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [" in plan and "PartitionFilters: []" not in plan
    stale = {(r.bucket, r.epoch) for r in merged.stale_versions(spark, f"{base}/table", schema).collect()}
    assert stale and all(f"epoch={e}/bucket={b}/" not in f for b, e in stale for f in files)


def test_a_flush_tried_again_changes_nothing(spark, tmp_path):
    """The batch before the commit of its epoch: the same folder is written again from the epochs before it."""
    base = str(tmp_path)
    feed(spark, f"{base}/in", [("a", 1, 1, "x"), ("a", 2, 1, "x")])
    flush(spark, base)
    feed(spark, f"{base}/in", [("a", 1, 2, "y")])
    schema = flush(spark, base)
    before = sorted(map(tuple, merged.read_merged(spark, f"{base}/table", schema).collect()))
    (tmp_path / "checkpoint" / "commits" / "1").unlink()
    crc = tmp_path / "checkpoint" / "commits" / ".1.crc"
    if crc.exists():
        crc.unlink()
    flush(spark, base)
    assert sorted(map(tuple, merged.read_merged(spark, f"{base}/table", schema).collect())) == before == [("a", 1, 2, "y"), ("a", 2, 1, "x")]


def test_an_empty_flush(spark, tmp_path):
    base = str(tmp_path)
    feed(spark, f"{base}/in", [])
    schema = flush(spark, base)
    assert merged.read_merged(spark, f"{base}/table", schema).count() == 0


def test_dedup_state_is_dropped(spark, tmp_path):
    base, start = str(tmp_path), datetime(2024, 1, 1)
    for day in range(6):
        rows = [(f"p{day}-{i % 20}", "secrets", start + timedelta(days=day, minutes=i)) for i in range(40)]
        spark.createDataFrame(rows, "clone_path string, scanner_type string, completed_at timestamp").repartition(1).write.mode("append").parquet(f"{base}/in")
    stream = spark.readStream.schema("clone_path string, scanner_type string, completed_at timestamp").option("maxFilesPerTrigger", 1).parquet(f"{base}/in")
    query = streams.drain(streams.fan_out(streams.dedup_stream(stream), {f"{base}/out": lambda b: b}), f"{base}/checkpoint")
    out = streams.read_epochs(spark, f"{base}/out")
    assert out.count() == out.select("clone_path").distinct().count() == 120
    held = [p["stateOperators"][0]["numRowsTotal"] for p in query.recentProgress if p["stateOperators"]]
    assert max(held) <= 40
    assert out.groupBy("clone_path").agg(F.count("*").alias("n")).where("n > 1").count() == 0
