"""Payload files: cut at the bulk size, read back whole, unchanged by aborted jobs."""

import json

import pytest
from pyspark.sql import functions as F

from scanlake.sources import bulk


def pairs(spark, n, parts=3):
    return spark.range(0, n, 1, parts).select(
        F.lit("i").alias("index"), F.col("id").cast("string"), F.format_string('{"index":{"_id":"%d"}}', "id").alias("action"),
        F.format_string('{"n":%d}', "id").alias("body"),
    )


def ids(spark, path):
    rows = bulk.read_bulk_files(spark, path).collect()
    by_file = {}
    for r in rows:
        by_file.setdefault(r.file, {})[r.pos] = json.loads(r.line)
    found = []
    for lines in by_file.values():
        assert sorted(lines) == list(range(len(lines)))
        for pos in range(0, len(lines), 2):
            assert int(lines[pos]["index"]["_id"]) == lines[pos + 1]["n"]
            found.append(lines[pos + 1]["n"])
    return sorted(found), [len(x) // 2 for x in by_file.values()]


def test_files_are_cut_at_the_bulk_size(spark, tmp_path):
    path = str(tmp_path)
    bulk.write_bulk_files(pairs(spark, 25), path, size=4)
    found, sizes = ids(spark, path)
    assert found == list(range(25)) and max(sizes) == 4
    bulk.write_bulk_files(pairs(spark, 3), path, size=4)
    assert ids(spark, path)[0] == sorted([*range(25), 0, 1, 2])


def test_an_aborted_job_leaves_nothing_to_read(spark, tmp_path):
    path = str(tmp_path)
    bulk.write_bulk_files(pairs(spark, 10), path, size=4)
    broken = pairs(spark, 30).withColumn("body", F.when(F.col("id") == "29", F.raise_error(F.lit("stopped"))).otherwise(F.col("body")))
    with pytest.raises(Exception, match="stopped"):
        bulk.write_bulk_files(broken, path, size=4)
    assert ids(spark, path)[0] == list(range(10))


def test_empty_frames_and_bad_sizes(spark, tmp_path):
    bulk.write_bulk_files(pairs(spark, 2), str(tmp_path), size=1)
    bulk.write_bulk_files(pairs(spark, 0), str(tmp_path))
    assert ids(spark, str(tmp_path))[0] == [0, 1]
    with pytest.raises(Exception, match="size"):
        bulk.write_bulk_files(pairs(spark, 2), str(tmp_path), size=0)
