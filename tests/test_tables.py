"""Tables that change as a whole: monthly facts, snapshots, and keys over parts."""

import os
import time

import pytest
from pyspark.sql import functions as F

from tradeloom.operators import keys
from tradeloom.session import scratch
from tradeloom.sources import tables
from tradeloom.sources.tables import MonthlyTable, Snapshot


def rows(spark, *items):
    return spark.createDataFrame(list(items), "k string, date_key int, v string")


def state(table):
    return {r["k"]: (r["sk"], r["date_key"], r["v"]) for r in table.read().collect()}


def files(table):
    return {m: sorted(f for f in os.listdir(table._folder(m, load)) if f.endswith(".parquet")) for m, load in table.months().items()}


def test_monthly_merge_rewrites_the_months_concerned(spark, tmp_path):
    table = MonthlyTable(spark, f"{tmp_path}/f", "k", "sk")
    assert table.is_empty() and table.read() is None
    table.merge(rows(spark, ("a", 19980105, "x"), ("b", 19980220, "x"), ("c", 19990301, "x"), ("d", 19990302, "x")))
    first, before = state(table), files(table)
    assert sorted(sk for sk, _, _ in first.values()) == [1, 2, 3, 4]
    # One row changes, one moves to another month, one is new.
    merged = table.merge(rows(spark, ("c", 19990301, "y"), ("b", 19980104, "x"), ("e", 20000101, "z")))
    assert merged == 3
    second = state(table)
    assert second["a"] == first["a"] and second["d"] == first["d"]
    assert second["c"] == (first["c"][0], 19990301, "y") and second["b"] == (first["b"][0], 19980104, "x")
    assert second["e"] == (5, 20000101, "z") and len(second) == 5
    assert set(table.months()) == {199801, 199903, 200001}  # February 1998 has no rows left
    again = files(table)
    assert again[199801] != before[199801] and again[199903] != before[199903]
    table.merge(rows(spark, ("e", 20000102, "z")))
    assert files(table)[199801] == again[199801] and files(table)[199903] == again[199903]
    assert table.merge(rows(spark)) == 0 and state(table)["e"] == (5, 20000102, "z")


def test_a_year_filter_prunes_months(spark, tmp_path):
    table = MonthlyTable(spark, f"{tmp_path}/f", "k", "sk")
    table.merge(rows(spark, *[(f"k{y}{m}", y * 10000 + m * 100 + 1, "x") for y in (1998, 1999) for m in range(1, 13)]))
    year = table.read().where(F.col("month").between(199901, 199912))
    plan = year._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(month" in plan and year.count() == 12
    assert len(year.inputFiles()) >= 24 and table.read({199901}).count() == 1


def test_a_load_that_dies_leaves_the_old_tables(spark, tmp_path):
    snapshot = Snapshot(spark, f"{tmp_path}/raw")
    assert snapshot.read() == {}
    frames = {name: spark.createDataFrame([(name, 1)], "n string, v int") for name in ("a", "b", "c")}
    snapshot.replace(frames)
    broken = dict(frames, a=frames["a"].withColumn("v", F.lit(2)), c=frames["c"].withColumn("v", F.raise_error(F.lit("stop"))))
    with pytest.raises(Exception, match="stop"):
        snapshot.replace(broken)
    assert {n: df.first()["v"] for n, df in snapshot.read().items()} == {"a": 1, "b": 1, "c": 1}
    for v in (3, 4, 5):
        snapshot.replace({n: df.withColumn("v", F.lit(v)) for n, df in frames.items()})
    assert {n: df.first()["v"] for n, df in snapshot.read().items()} == {"a": 5, "b": 5, "c": 5}
    assert len(os.listdir(tmp_path / "raw" / "a")) == 2  # this load's and the one before


def test_two_writers_cannot_put_the_same_manifest(spark, tmp_path, monkeypatch):
    one, other = Snapshot(spark, f"{tmp_path}/raw"), Snapshot(spark, f"{tmp_path}/raw")
    numbers = one.manifest._numbers()
    monkeypatch.setattr(one.manifest, "_numbers", lambda: numbers)  # has looked before the other put its own
    df = spark.range(1)
    other.replace({"a": df})
    with pytest.raises(RuntimeError, match="another load"):
        one.replace({"a": df})
    assert other.read()["a"].count() == 1


@pytest.mark.parametrize("parts", [1, 3, 50])
def test_keys_do_not_depend_on_parts(spark, parts):
    df = spark.range(500).select(F.concat(F.lit("ID-"), "id").alias("k"), (F.col("id") * 2).alias("v"))
    numbered = {r["k"]: r["sk"] for r in keys.dense_keys(df, "k", "sk", start=10, parts=parts).collect()}
    order = [r["k"] for r in df.orderBy(F.md5("k"), "k").collect()]
    assert numbered == {k: i + 11 for i, k in enumerate(order)}


def test_keys_read_their_input_once(spark):
    seen = spark.sparkContext.accumulator(0)
    counted = F.udf(lambda x: seen.add(1) or x, "string")  # counts the rows that are evaluated
    df = spark.range(100).select(F.col("id").cast("string").alias("k")).withColumn("k", counted("k"))
    assert keys.dense_keys(df, "k", "sk", parts=7).count() == 100
    assert seen.value == 100


def shuffle_files(spark):
    files = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    return {files.apply(i).getName() for i in range(files.size()) if files.apply(i).getName().startswith("shuffle_")}


def test_a_merge_leaves_the_table_only(spark, tmp_path, monkeypatch):
    kept = tmp_path / "shared"
    monkeypatch.setattr("tradeloom.session.shared_dir", lambda *_: str(kept))
    table = MonthlyTable(spark, f"{tmp_path}/f", "k", "sk")
    before = shuffle_files(spark)
    for v in ("x", "y"):
        table.merge(rows(spark, *[(f"k{i}", 19980101 + i, v) for i in range(20)], ("other" + v, 19990101, v)))
    for _ in range(50):
        if not shuffle_files(spark) - before:
            break
        time.sleep(0.1)  # they are removed beside the driver's work
    assert not shuffle_files(spark) - before
    assert [f for _, _, names in os.walk(kept) for f in names if f.endswith(".parquet")] == []
    assert len(state(table)) == 22


def test_settings_of_a_step_end_with_it(spark):
    name = "spark.sql.maxConcurrentOutputFileWriters"
    before = spark.conf.get(name)
    with pytest.raises(ValueError), scratch(spark) as write:
        assert spark.conf.get(name) != before
        stored = write(spark.range(3), "rows")
        assert stored.count() == 3
        raise ValueError
    assert spark.conf.get(name) == before
    with pytest.raises(Exception, match="(?i)not.*exist"):
        stored.count()


def test_months_are_moved_in_bounded_statements(spark, tmp_path, monkeypatch):
    first = [(f"k{i}", 19980101 + 100 * (i % 6), "x") for i in range(60)]
    # January is replaced whole, of February a part, k2 moves to another month, and some are new.
    second = [(f"k{i}", 19980101, "y") for i in range(0, 60, 6)] + [("k1", 19980201, "y"), ("k2", 19980601, "y")]
    second += [(f"new{i}", 19990101 + i, "y") for i in range(9)]
    found = []
    for most in (None, 4):
        if most:
            monkeypatch.setattr(tables, "STATEMENT_ROWS", 3 * most)
            monkeypatch.setattr(tables, "TASK_ROWS", most)
        table = MonthlyTable(spark, f"{tmp_path}/f{most}", "k", "sk")
        table.merge(rows(spark, *first))
        read = []
        monkeypatch.setattr(table, "read", lambda months=None, t=table: read.append(months) or MonthlyTable.read(t, months))
        assert table.merge(rows(spark, *second)) == 21
        found.append(state(table))
        whole = set().union(*read[2:-1])  # after the keys and the counts, before the result
        assert whole == {199802, 199803, 199806}
    assert found[0] == found[1] and len(found[0]) == 69
    assert found[0]["k0"][1:] == (19980101, "y") and found[0]["k2"][1:] == (19980601, "y") and found[0]["k7"][1:] == (19980201, "x")
    assert len(files(table)[199801]) > 1
