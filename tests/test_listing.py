import os

import pytest

from scanlake.operators.monitoring import folder_stats
from scanlake.sources import listing
from scanlake.sources.listing import folder_inventory


def found(root):
    return {(str(p), p.is_dir(), 0 if p.is_dir() else p.stat().st_size) for p in root.rglob("*")}


def rows(listed):
    return sorted((r.path, r.is_dir, r.size) for r in listed.collect())


def test_files_and_folders(spark, tmp_path):
    for name in ("r1/a/b", "r2", "r3/empty", "locked/x"):
        (tmp_path / name).mkdir(parents=True)
    (tmp_path / "r1" / "a" / "b" / "f.txt").write_text("12345")
    (tmp_path / "top.txt").write_text("1")
    listed = folder_inventory(spark, str(tmp_path))
    assert rows(listed) == sorted(found(tmp_path))
    stats = folder_stats(listed, str(tmp_path)).first()
    assert (stats.total_bytes, stats.files, stats.repositories) == (6, 2, 4)
    assert folder_inventory(spark, str(tmp_path / "missing")).count() == 0
    assert rows(folder_inventory(spark, f"file://{tmp_path}")) == sorted(found(tmp_path))


@pytest.mark.parametrize("share", [1, 3, 1000])
def test_a_hot_folder_and_a_deep_one_are_dealt_out_by_rounds(spark, tmp_path, share):
    deep = tmp_path / "hot" / "/".join("abcdefgh")
    deep.mkdir(parents=True)
    (deep / "last").write_text("end")
    for i in range(12):
        (tmp_path / "hot" / f"n{i}" / "in").mkdir(parents=True)
        (tmp_path / "hot" / f"n{i}" / "in" / "f").write_text("x" * i)
    assert rows(folder_inventory(spark, str(tmp_path), share)) == sorted(found(tmp_path))


def test_a_task_lists_its_share_and_leaves_the_rest(tmp_path):
    for i in range(20):
        (tmp_path / f"d{i}" / "below").mkdir(parents=True)
    start = listing.pa.RecordBatch.from_pydict({"path": [str(tmp_path)]})
    out = [row for batch in listing._lister(str(tmp_path), 5)([start]) for row in batch.to_pylist()]
    asked = {os.path.dirname(row["path"]) for row in out}
    assert len(asked) <= 5
    seen = {row["path"] for row in out if not row["waits"]} | {str(tmp_path)}
    assert asked <= seen
    # Every folder that was listed as an entry has been entered or waits.
    waiting = {row["path"] for row in out if row["waits"]}
    assert not waiting & seen and {f"{tmp_path}/d{i}" for i in range(20)} <= waiting | seen
    assert len(out) == len({row["path"] for row in out})


def test_links_to_folders_are_listed_but_not_entered(spark, tmp_path):
    (tmp_path / "a" / "b").mkdir(parents=True)
    os.symlink(tmp_path, tmp_path / "a" / "b" / "up")
    got = [(path, is_dir) for path, is_dir, _ in rows(folder_inventory(spark, str(tmp_path), 2))]
    assert got == [(str(tmp_path / p), True) for p in ("a", "a/b", "a/b/up")]
