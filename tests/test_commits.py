"""Sinks while they change: stopped between any two steps, read in between, merged by file."""

import pytest

from bureauframe.sources import commits, sinks
from bureauframe.sources.tables import partition_columns, read_source


class Stopped(Exception):
    pass


def stop_after(monkeypatch, steps):
    """Let a commit do so many steps."""
    done = [0]

    def do(step):
        if done[0] == steps:
            raise Stopped
        done[0] += 1
        step()

    monkeypatch.setattr(commits, "_do", do)
    return done


def rows(df):
    return sorted(tuple(r) for r in df.select(*sorted(df.columns)).collect())


def data_files(path):
    return {str(f.relative_to(path)): f.stat().st_mtime_ns for f in path.rglob("*.parquet")}


@pytest.fixture(params=["path", "table"])
def target(request, spark, tmp_path):
    name = str(tmp_path / "sink") if request.param == "path" else "commit_sink"
    yield name
    if request.param == "table":
        for table in spark.catalog.listTables():
            if table.name.startswith("commit_sink"):
                spark.sql(f"DROP TABLE {table.name}")


def changes(spark, partition):
    old = spark.createDataFrame([(i, f"2024-01-0{i % 3 + 1}", i) for i in range(9)], "k int, d string, v int")
    old = old.withColumn("d", old.d.cast("date"))
    new = old.filter("k < 3 OR k = 8").selectExpr("k + 6 AS k", "d", "-v AS v")
    return {
        "overwrite": (old, lambda t: sinks.write_overwrite(new, t, partition), rows(new)),
        "merge": (
            old,
            lambda t: sinks.write_merge(new, t, ["k", "d"], partition),
            sorted([r for r in rows(old) if r[:2] not in {n[:2] for n in (tuple((x.d, x.k)) for x in new.collect())}] + rows(new)),
        ),
    }


@pytest.mark.parametrize("partition", [None, "d"])
@pytest.mark.parametrize("kind", ["overwrite", "merge"])
def test_stopped_between_any_two_steps(spark, monkeypatch, target, kind, partition):
    """Readers see the old rows or the new ones, and the next writer repairs."""
    if target == "commit_sink" and partition is None:
        pytest.skip("the partitioned table has the same steps and more")
    old, change, want = changes(spark, partition)[kind]
    steps, seen = 0, set()
    while True:
        monkeypatch.undo()
        sinks.write_overwrite(old, target, partition)
        before = rows(old)
        done = stop_after(monkeypatch, steps)
        try:
            change(target)
            break
        except Stopped:
            pass
        monkeypatch.undo()
        found = rows(read_source(spark, target))
        assert found in (before, want)
        seen.add(found == want)
        assert sinks.exists(spark, target)
        commits.recover(spark, target)
        assert rows(read_source(spark, target)) == found
        direct = spark.read.parquet(target) if commits.is_path(target) else spark.table(target)
        assert rows(direct) == found and commits.pending(spark, target) is None
        assert not commits.recover(spark, target)
        steps += 1
    assert done[0] == steps >= 4 and seen == {False, True}
    monkeypatch.undo()
    assert rows(read_source(spark, target)) == want


def test_recovery_may_stop_too(spark, monkeypatch, tmp_path):
    target = str(tmp_path / "sink")
    for steps in range(2, 6):
        for again in range(0, 4):
            sinks.write_overwrite(spark.range(3), target)
            stop_after(monkeypatch, steps)
            with pytest.raises(Stopped):
                sinks.write_overwrite(spark.range(5), target)
            stop_after(monkeypatch, again)
            try:
                commits.recover(spark, target)
            except Stopped:
                pass
            monkeypatch.undo()
            assert read_source(spark, target).count() == 5
            sinks.write(spark.range(5, 6), target, "append")
            assert spark.read.parquet(target).count() == 6


def test_merge_rewrites_only_touched_files(spark, tmp_path):
    target = tmp_path / "sink"
    for lo in (0, 100, 200):  # one file each
        spark.range(lo, lo + 100).selectExpr("id AS k", "id AS v").coalesce(1).write.mode("append").parquet(str(target))
    before = data_files(target)
    new = spark.createDataFrame([(150, -1), (999, -2)], "k long, v long")
    sinks.write(new, str(target), "merge", keys=["k"])
    after = data_files(target)
    kept = before.keys() & after.keys()
    assert len(kept) == 2 and all(before[f] == after[f] for f in kept)
    got = spark.read.parquet(str(target))
    assert got.count() == 301 and rows(got.filter("v < 0")) == [(150, -1), (999, -2)]
    sinks.write(spark.createDataFrame([(5000, 1)], "k long, v long"), str(target), "merge", keys=["k"])
    assert after.items() <= data_files(target).items()
    assert not [p for p in tmp_path.iterdir() if p.name != "sink"]


def test_merge_by_file_keeps_columns_and_partitions(spark, tmp_path):
    target = str(tmp_path / "sink")
    old = spark.createDataFrame([(i, i % 4, i) for i in range(40)], "k int, p int, v int")
    old.write.partitionBy("p").parquet(target)
    before = data_files(tmp_path / "sink")
    moved = spark.createDataFrame([(1, 2), (4, 0)], "k int, p int")  # row 1 moves from p=1 to p=2
    sinks.write(moved, target, "merge", keys=["k"])
    want = sorted((i, {1: 2}.get(i, i % 4), i) for i in range(40))
    assert sorted((r.k, r.p, r.v) for r in spark.read.parquet(target).collect()) == want
    assert partition_columns(spark, target) == ["p"]
    gone = {f.partition("/")[0] for f in before.keys() - data_files(tmp_path / "sink").keys()}
    assert gone == {"p=0", "p=1"}


def test_merge_with_a_new_column_writes_everything(spark, tmp_path):
    target = str(tmp_path / "sink")
    sinks.write_overwrite(spark.range(4).selectExpr("id AS k", "1 AS v"), target)
    sinks.write(spark.createDataFrame([(2, 9)], "k long, w int"), target, "merge", keys=["k"])
    assert rows(spark.read.parquet(target).fillna(0)) == [(0, 1, 0), (1, 1, 0), (2, 1, 9), (3, 1, 0)]


def test_merge_of_a_whole_partition_away(spark, tmp_path):
    """A partition that loses its last row loses its folder."""
    target = str(tmp_path / "sink")
    spark.createDataFrame([(1, "a"), (2, "b")], "k int, p string").write.partitionBy("p").parquet(target)
    sinks.write(spark.createDataFrame([(1, "b")], "k int, p string"), target, "merge", keys=["k"])
    assert sorted(f.name for f in (tmp_path / "sink").glob("p=*")) == ["p=b"]
