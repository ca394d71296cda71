"""Incremental conversion behind a log of commits, and rows in file order."""

from __future__ import annotations

import os

import pytest
from conftest import rows
from pyspark.sql import functions as F

from rolescope.operators import ranking
from rolescope.sources import conversion, tables
from rolescope.sources.schemas import schema_of

SCHEMA = schema_of({"id": "int", "note": "string"})


class Reader:
    """Reads CSV files and remembers which it was asked for."""

    def __init__(self, spark):
        self.spark, self.asked = spark, []

    def __call__(self, paths):
        self.asked.append(sorted(p.rsplit("/", 1)[1] for p in paths))
        return tables.read_csv(self.spark, paths, SCHEMA)


def put(folder, name, ids, at=1_600_000_000):
    folder.mkdir(exist_ok=True)
    path = folder / name
    path.write_text("id,note\n" + "".join(f"{i},n{i}\n" for i in ids))
    os.utime(path, (at, at))


@pytest.fixture
def place(spark, tmp_path):
    read = Reader(spark)

    def run():
        return conversion.convert_files(spark, str(tmp_path / "in"), str(tmp_path / "out"), read)

    def held():
        return sorted(rows(conversion.read_converted(spark, str(tmp_path / "out"), SCHEMA)))

    return tmp_path / "in", run, held, read


def table(ids):
    return [(i, f"n{i}") for i in sorted(ids)]


def test_only_new_and_rewritten_files_are_read(place):
    folder, run, held, read = place
    put(folder, "a.csv", [1, 2, 3])
    put(folder, "b.csv", [4, 5])
    assert run() == conversion.Commit(1, 2, 0, 5)
    assert held() == table(range(1, 6))
    assert run() == conversion.Commit(0, 0, 0, 0)
    assert read.asked == [["a.csv", "b.csv"]]  # the second run read nothing
    put(folder, "c.csv", [6])
    assert run() == conversion.Commit(2, 1, 0, 1)
    put(folder, "a.csv", [7, 8, 9], at=1_600_000_100)  # of the same size
    assert run() == conversion.Commit(3, 1, 0, 3)
    assert read.asked[1:] == [["c.csv"], ["a.csv"]]
    assert held() == table([4, 5, 6, 7, 8, 9])
    (folder / "b.csv").unlink()
    assert run() == conversion.Commit(4, 0, 1, 0)
    assert len(read.asked) == 3 and held() == table([6, 7, 8, 9])


def test_failed_run_leaves_the_table_whole(spark, place, monkeypatch):
    folder, run, held, _ = place
    put(folder, "a.csv", [1, 2])
    run()
    put(folder, "a.csv", [3, 4, 5], at=1_600_000_100)

    def failing(paths):
        broken = F.when(F.col("id") == 5, F.raise_error(F.lit("disk full"))).otherwise(F.col("id"))
        return tables.read_csv(spark, paths, SCHEMA).withColumn("id", broken.cast("int"))

    with pytest.raises(Exception, match="disk full"):
        conversion.convert_files(spark, str(folder), str(folder.parent / "out"), failing)
    assert held() == table([1, 2])
    write = conversion._write

    def after_writing(*args):
        write(*args)
        raise RuntimeError("lost before the commit")

    monkeypatch.setattr(conversion, "_write", after_writing)
    with pytest.raises(RuntimeError, match="lost"):
        run()
    assert held() == table([1, 2])
    monkeypatch.undo()
    assert run() == conversion.Commit(2, 1, 0, 3)
    assert held() == table([3, 4, 5])  # once, though written twice


def test_file_that_changes_meanwhile_is_not_committed(spark, place):
    folder, run, held, _ = place
    put(folder, "a.csv", [1])

    def late(paths):
        put(folder, "a.csv", [1, 2], at=1_600_000_200)
        return tables.read_csv(spark, paths, SCHEMA)

    with pytest.raises(RuntimeError, match="changed while"):
        conversion.convert_files(spark, str(folder), str(folder.parent / "out"), late)
    assert held() == []
    assert run().rows == 2 and held() == table([1, 2])


def test_empty_files_and_odd_names(place):
    folder, run, held, read = place
    put(folder, "none.csv", [])
    assert run() == conversion.Commit(1, 1, 0, 0) and held() == []
    assert run().number == 0 and len(read.asked) == 1
    put(folder, "a b%20c+[1]{x}.csv", [1, 2])
    assert run().rows == 2 and held() == table([1, 2])
    assert run().number == 0


def test_head_rows_follow_files_and_lines(spark, tmp_path):
    folder = tmp_path / "in"
    for k in range(7):
        put(folder, f"part-{k}.csv", range(100 * k, 100 * k + (0 if k == 1 else 40)))
    df = tables.read_csv(spark, str(folder), SCHEMA)
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    want = [100 * k + i for k in range(7) if k != 1 for i in range(40)]
    try:
        for size in ("64b", "128m"):  # files cut into many blocks, or several in one task
            spark.conf.set("spark.sql.files.maxPartitionBytes", size)
            for n in (0, 1, 45, 90, 500):
                assert [r["id"] for r in tables.head_rows(df, n).collect()] == want[:n], (size, n)
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def test_head_opens_the_first_files_only(spark, tmp_path):
    folder = tmp_path / "in"
    for k in range(4):
        put(folder, f"part-{k}.csv", range(10 * k, 10 * k + 10))
    df = tables.head_rows(tables.read_csv(spark, str(folder), SCHEMA), 5)
    assert len(df.collect()) == 5
    assert df._jdf.queryExecution().optimizedPlan().toString().count("part-") == 1


@pytest.mark.parametrize("values", [
    [1.0, 2.0, 2.0, None], [float("nan"), 0.0, -0.0, float("inf"), -1.0, None] * 2,
    [float(i % 997) for i in range(5000)], [5.0] * 1000 + [6.0], [None], []])
def test_top_values_are_exact(spark, values):
    df = spark.createDataFrame([(v,) for v in values], "v double")
    for k in (1, 3, 10):
        want = (df.where("v IS NOT NULL").groupBy("v").agg(F.count("*").alias("cnt"))
                .orderBy(F.desc("v")).limit(k))
        assert list(map(str, rows(ranking.top_values(df, "v", k)))) == list(map(str, rows(want)))


def test_top_values_group_few_rows(spark):
    """Most rows end at the bound, before the grouping."""
    df = spark.range(200_000).select((F.col("id") % 50_000).alias("v"))
    got = ranking.top_values(df, "v", 10)
    assert rows(got) == [(49_999 - i, 4) for i in range(10)]
    bound = rows(df.groupBy(F.pmod(F.xxhash64("v"), F.lit(40)).alias("b")).agg(F.max("v").alias("m"))
                 .orderBy(F.desc("m")).limit(10))[-1][1]
    assert df.where(F.col("v") >= bound).select("v").distinct().count() < 100
