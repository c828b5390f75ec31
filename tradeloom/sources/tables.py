"""Parquet tables that are replaced by writing beside the old state.

A table is a folder of version folders.  A version counts once Spark has put
its ``_SUCCESS`` marker there, so a run that dies while writing leaves the
previous state in force, and no path is overwritten while it is being read.
"""

from __future__ import annotations

import json
import math
import uuid
from collections.abc import Callable, Iterator
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, functions as F

from tradeloom.operators.keys import dense_keys
from tradeloom.session import PACKED, scratch

PREFIX = "version-"
KEPT_VERSIONS = 2
#: Identifies an incoming row of a merge.
ROW = "_row"
#: Rows of a month that one task writes at most, and rows that one statement of a merge moves (or one month, if larger).
TASK_ROWS, STATEMENT_ROWS = 500_000, 32_000_000


def _path(spark: SparkSession, path: str):
    """A Hadoop path with its file system, so any shared storage works."""
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration()), hadoop_path


def exists(spark: SparkSession, path: str) -> bool:
    fs, p = _path(spark, path)
    return fs.exists(p)


def delete(spark: SparkSession, path: str) -> None:
    fs, p = _path(spark, path)
    fs.delete(p, True)


class Table:
    """A replaceable or append-only Parquet table."""

    def __init__(self, spark: SparkSession, path: str, kept_versions: int = KEPT_VERSIONS):
        """``kept_versions``: how many complete versions stay; a reader of an older one loses its files."""
        self.spark = spark
        self.path = path
        self.kept_versions = kept_versions

    def _versions(self) -> list[int]:
        fs, p = _path(self.spark, self.path)
        if not fs.exists(p):
            return []
        names = [s.getPath().getName() for s in fs.listStatus(p)]
        return sorted(int(n.removeprefix(PREFIX)) for n in names if n.startswith(PREFIX))

    def _folder(self, version: int) -> str:
        return f"{self.path}/{PREFIX}{version:08d}"

    def _complete(self) -> list[int]:
        return [v for v in self._versions() if exists(self.spark, f"{self._folder(v)}/_SUCCESS")]

    def is_empty(self) -> bool:
        return not self._complete()

    def read(self) -> DataFrame:
        return self.spark.read.parquet(self._folder(self._complete()[-1]))

    def replace(self, df: DataFrame) -> DataFrame:
        """Write a new version and return it; versions older than those kept go."""
        done = self._complete()
        version = (self._versions() or [0])[-1] + 1
        df.write.parquet(self._folder(version))
        for old in (done + [version])[: -self.kept_versions]:
            delete(self.spark, self._folder(old))
        return self.spark.read.parquet(self._folder(version))

    def append(self, df: DataFrame) -> None:
        df.write.mode("append").parquet(f"{self.path}/rows")

    def rows(self) -> DataFrame | None:
        """All appended rows; files with fewer columns are filled with NULL."""
        path = f"{self.path}/rows"
        if not exists(self.spark, path):
            return None
        return self.spark.read.option("mergeSchema", True).parquet(path)


class Manifest:
    """Numbered JSON files in one folder; the highest counts.

    A manifest is written under another name and renamed, so it is there whole
    or not at all.  What it names is written before it.
    """

    PREFIX, SUFFIX = "manifest-", ".json"

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path

    def _numbers(self) -> list[int]:
        fs, p = _path(self.spark, self.path)
        names = [s.getPath().getName() for s in fs.listStatus(p)] if fs.exists(p) else []
        return sorted(int(n[len(self.PREFIX) : -len(self.SUFFIX)]) for n in names if n.startswith(self.PREFIX) and n.endswith(self.SUFFIX))

    def _file(self, number: int) -> str:
        return f"{self.path}/{self.PREFIX}{number:08d}{self.SUFFIX}"

    def last(self) -> dict | None:
        numbers = self._numbers()
        if not numbers:
            return None
        rows = self.spark.read.text(self._file(numbers[-1]), wholetext=True).collect()
        return json.loads(rows[0][0])

    def put(self, content: dict, kept: int = KEPT_VERSIONS) -> None:
        """Make ``content`` count, unless another writer has put its own under the same number."""
        numbers = self._numbers()
        target = self._file((numbers or [0])[-1] + 1)
        fs, temporary = _path(self.spark, f"{self.path}/.{uuid.uuid4().hex}")
        stream = fs.create(temporary)
        stream.write(bytearray(json.dumps(content, sort_keys=True).encode()))
        stream.close()
        if fs.exists(_path(self.spark, target)[1]) or not fs.rename(temporary, _path(self.spark, target)[1]):
            fs.delete(temporary, False)
            raise RuntimeError(f"another load has changed {self.path} meanwhile")
        for old in numbers[: max(0, len(numbers) + 1 - kept)]:
            delete(self.spark, self._file(old))


class Snapshot:
    """Tables that change together: one manifest names the folder of each, and is written last."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path, self.manifest = spark, path, Manifest(spark, path)

    def read(self) -> dict[str, DataFrame]:
        """The tables of the last load that wrote them all."""
        return {name: self.spark.read.parquet(f"{self.path}/{folder}") for name, folder in (self.manifest.last() or {}).items()}

    def replace(self, tables: dict[str, DataFrame]) -> dict[str, DataFrame]:
        before = self.manifest.last() or {}
        load = uuid.uuid4().hex
        folders = {name: f"{name}/load-{load}" for name in tables}
        for name, df in tables.items():
            df.write.parquet(f"{self.path}/{folders[name]}")
        self.manifest.put(folders)
        self._tidy({*folders.values(), *before.values()})
        return self.read()

    def _tidy(self, wanted: set[str]) -> None:
        """Remove folders that neither this load nor the one before names."""
        for name in {w.split("/")[0] for w in wanted}:
            fs, p = _path(self.spark, f"{self.path}/{name}")
            for status in fs.listStatus(p):
                if f"{name}/{status.getPath().getName()}" not in wanted:
                    fs.delete(status.getPath(), True)


def with_row_ids(df: DataFrame) -> DataFrame:
    """Rows with an id each, which holds once they are written."""
    return df.withColumn(ROW, F.monotonically_increasing_id())


@dataclass(frozen=True)
class Places:
    """The tasks that write some months: small months share one, a large month has several."""

    months: dict[int, tuple[int, int]]  # first task and number of tasks
    tasks: int

    @classmethod
    def of(cls, sizes: dict[int, int], cores: int) -> Places:
        most = min(TASK_ROWS, max(TASK_ROWS // 10, math.ceil(sum(sizes.values()) / cores)))
        months, task, room = {}, -1, 0
        for month, n in sorted(sizes.items()):
            if n > room:
                task, room = task + 1, most
            months[month] = (task, max(1, math.ceil(n / most)))
            task += months[month][1] - 1
            room -= n
        return cls(months, task + 1)

    def _placed(self, df: DataFrame, month: str, key: str) -> DataFrame:
        """The rows of these months, each in the task that writes it."""
        rows = [F.struct(*[F.lit(v).alias(n) for v, n in zip((m, *v), (month, "_first", "_tasks"))]) for m, v in self.months.items()]
        tasks = df.sparkSession.range(1).select(F.inline(F.array(*rows)))
        place = F.col("_first") + F.pmod(F.xxhash64(key), F.col("_tasks")).cast("int")
        met = df.join(F.broadcast(tasks), month).select(*df.columns, place.alias("_place"))
        return met.repartitionById(self.tasks, "_place")

    def met(self, left: DataFrame, right: DataFrame, month: str, key: str, how: str = "inner") -> DataFrame:
        """Rows of these months met on ``key`` within their month, in one exchange of each, and left where they are written.

        ``right`` is narrow, and a task's share of it is bounded, so it is looked up there.
        """
        left, right = self._placed(left, month, key), self._placed(right, month, key)
        return left.join(right.hint("shuffle_hash"), ["_place", month, key], how).drop("_place")


class MonthlyTable:
    """A keyed fact in folders by month, merged month by month.

    ``rows/load=<id>/month=<yyyymm>`` holds a month as one load has written it;
    the manifest says which load each month is of, and the highest surrogate
    key.  A merge rewrites the months that its rows are or were in; the others
    keep their files.  Readers prune by ``month``.
    """

    def __init__(self, spark: SparkSession, path: str, key: str, surrogate: str, date_key: str = "date_key"):
        self.spark, self.path, self.manifest = spark, path, Manifest(spark, path)
        self.key, self.surrogate, self.date_key = key, surrogate, date_key

    def is_empty(self) -> bool:
        return self.manifest.last() is None

    def months(self) -> dict[int, str]:
        """Which load each month is of."""
        return {int(m): load for m, load in (self.manifest.last() or {"months": {}})["months"].items()}

    def _folder(self, month: int, load: str) -> str:
        return f"{self.path}/rows/load={load}/month={month}"

    def read(self, months: set[int] | None = None) -> DataFrame | None:
        """The fact with its ``month`` (yyyymm, whole years prune); None where there is none of it yet."""
        chosen = {m: load for m, load in self.months().items() if months is None or m in months}
        if not chosen:
            return None
        reader = self.spark.read.option("basePath", f"{self.path}/rows")
        return reader.parquet(*[self._folder(m, load) for m, load in sorted(chosen.items())]).drop("load")

    def merge(self, incoming: DataFrame, stored: bool = False) -> int:
        """Upsert rows unique on the key; new ones are numbered on from the highest key.  Returns the rows merged.

        The incoming rows are written (unless they are ``stored`` already,
        ``with_row_ids``).  Their keys, months and row ids alone are met with the
        keys, surrogate keys and months of the table, and numbered.  Then each row
        is moved once, to the task that writes its month, and gets its surrogate
        key there.  Of the table only months that keep a row are read whole.  The
        months are a calendar's, so their list is short.
        """
        with scratch(self.spark) as write:
            rows = incoming if stored else write(with_row_ids(incoming), "incoming")
            return self._merge(rows.withColumn("month", F.floor(F.col(self.date_key) / 100).cast("int")), write)

    def _merge(self, rows: DataFrame, write: Callable[[DataFrame, str], DataFrame]) -> int:
        state = self.manifest.last() or {"months": {}, "highest": 0}
        located, known = rows.select(self.key, "month", ROW), self.read()
        if known is None:
            located = located.withColumns({self.surrogate: F.lit(None).cast("bigint"), "_was": F.lit(None).cast("int")})
        else:
            index = known.select(self.key, self.surrogate, F.col("month").alias("_was"))
            located = write(located.join(index, self.key, "left"), "located")
        new = F.col(self.surrogate).isNull()
        found = located.groupBy("month").agg(F.count("*").alias("n"), F.count_if(new).alias("new")).collect()
        if not found:
            return 0
        sizes, added = {r.month: r.n for r in found}, sum(r.new for r in found)
        if None in sizes:
            raise ValueError(f"{self.date_key} is missing in {sizes[None]} rows")
        keys = located.where(~new).select(ROW, "month", self.surrogate)
        if added:
            fresh = located.where(new).select(self.key, ROW, "month")
            keys = keys.unionByName(
                dense_keys(fresh, self.key, self.surrogate, start=state["highest"], columns=[ROW, "month"], write=write)
            )
        touched, kept = set(sizes), {}
        if known is not None:
            replaced = located.where("_was IS NOT NULL").groupBy("_was").agg(F.count_distinct(self.surrogate).alias("n"))
            replaced = {r["_was"]: r.n for r in replaced.collect()}
            touched |= set(replaced)
            here = self.read(touched)
            counts = {r.month: r["count"] for r in here.groupBy("month").count().collect()} if here is not None else {}
            kept = {m: n for m, n in counts.items() if replaced.get(m) != n}
        load = uuid.uuid4().hex
        columns = [self.surrogate, *(c for c in rows.columns if c not in (ROW, "month")), "month"]
        for places in self._statements({m: sizes.get(m, 0) + kept.get(m, 0) for m in {*sizes, *kept}}):
            changed = places.met(rows, keys, "month", ROW).select(columns)
            stay = self.read(set(kept) & set(places.months))
            if stay is not None:
                gone = located.select(F.col("_was").alias("month"), self.key, F.lit(True).alias("_gone"))
                stay = places.met(stay, gone, "month", self.key, "left").where("_gone IS NULL")
                changed = changed.unionByName(stay.select(columns))
            changed.write.mode("append").options(**PACKED).partitionBy("month").parquet(f"{self.path}/rows/load={load}")
        written = {int(s.getPath().getName().removeprefix("month=")) for s in self._list(load) if s.isDirectory()}
        months = {m: own for m, own in state["months"].items() if int(m) not in touched}
        months |= {str(m): load for m in written}
        self.manifest.put({"months": months, "highest": state["highest"] + added})
        self._tidy({*months.values(), *state["months"].values()})
        return sum(sizes.values())

    def _statements(self, sizes: dict[int, int]) -> Iterator[Places]:
        """The months, by their rows, in groups that are moved together."""
        cores = self.spark.sparkContext.defaultParallelism
        group: dict[int, int] = {}
        for month, n in sorted(sizes.items()):
            if group and sum(group.values()) + n > STATEMENT_ROWS:
                yield Places.of(group, cores)
                group = {}
            group[month] = n
        yield Places.of(group, cores)

    def _list(self, load: str):
        fs, p = _path(self.spark, f"{self.path}/rows/load={load}")
        return list(fs.listStatus(p))

    def _tidy(self, wanted: set[str]) -> None:
        """Remove loads that neither this state nor the one before names."""
        fs, p = _path(self.spark, f"{self.path}/rows")
        for status in fs.listStatus(p):
            if status.getPath().getName().removeprefix("load=") not in wanted:
                fs.delete(status.getPath(), True)
