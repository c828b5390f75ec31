"""CSV extracts: headers and cells that do not fit fail the read."""

import pytest

from tradeloom.sources import sample
from tradeloom.sources.csv_scan import read_csv
from tradeloom.sources.tables import Table


def _folder(path, *texts):
    path.mkdir()
    for i, text in enumerate(texts):
        (path / f"part-{i}.csv").write_text(text)
    return str(path)


def test_files_of_one_header_are_read(spark, tmp_path):
    rows = read_csv(spark, _folder(tmp_path / "t.csv", "a,b\n1,\n", 'a,b\n3,"x ""y"""\n')).collect()
    assert sorted((r["a"], r["b"]) for r in rows) == [("1", ""), ("3", 'x "y"')]


@pytest.mark.parametrize("second", ["b,a\n20,10\n", "a,b\n3,4,5\n", "a,b\n3\n"])
def test_swapped_headers_and_odd_lines_fail(spark, tmp_path, second):
    with pytest.raises(Exception, match="(?i)header|malformed|FAILED_READ"):
        read_csv(spark, _folder(tmp_path / "t.csv", "a,b\n1,2\n", second)).collect()


def test_kept_versions(spark, tmp_path):
    table = Table(spark, f"{tmp_path}/t", kept_versions=3)
    for _ in range(5):
        table.replace(spark.range(1))
    assert table._complete() == [3, 4, 5]


def test_rows_of_a_small_file_are_dealt_to_all_cores(spark, tmp_path, monkeypatch):
    rows = spark.range(1000).selectExpr("id p_partkey", "'p' p_name", "'b' p_brand", "'t' p_type", "1 p_size", "9.5D p_retailprice")
    rows.coalesce(1).write.parquet(f"{tmp_path}/part.parquet")
    products = lambda: sample.SampleSources(spark, str(tmp_path)).source("products", dirty=True)
    dealt = products()
    assert len({r[0] for r in dealt.selectExpr("spark_partition_id()").collect()}) == spark.sparkContext.defaultParallelism
    monkeypatch.setattr(sample, "DEALT_INPUT_LIMIT", 0)
    assert products().rdd.getNumPartitions() == 1
    assert sorted(map(tuple, dealt.collect())) == sorted(map(tuple, products().collect()))
