"""The pipeline's stages against what each operator says, and planted rows through all of them."""

import corpus_pipeline
from tests.llm.helpers import docs, texts
from tradeloom.llm import queries


def test_stages_keep_columns_and_take_effect(spark, tmp_path):
    item = "planted words of the benchmark item that nobody else would ever write down here"
    plain = "A rather plain sentence about rivers, hills and the weather of late summer."
    rows = [r for r in texts() if r[0] is not None] + [
        (500, f"Before it stands this. {item}. And after it comes that."),
        (501, f"{plain} My password=abc123def456 is here. {plain[::-1]}"),
        (502, "REPEAT this line of words again\n" * 20),
    ]
    table = docs(spark, rows)
    table.write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    kept = table
    seen = {}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        kept = stage(spark, kept, str(tmp_path)).cache()
        assert kept.columns == table.columns
        seen[name] = {r["doc_id"]: r["text"] for r in kept.collect()}
    assert 502 not in seen["quality_rules"] and {1, 2, 3, 4, 12, 500, 501} <= seen["quality_rules"].keys()
    assert 1 in seen["near_dedup"] and not {2, 3} & seen["near_dedup"].keys()
    assert 500 in seen["near_dedup"] and 500 not in seen["decontamination"]
    assert "[SECRET]" in seen["secret_scan"][501] and seen["secret_scan"][4] == seen["decontamination"][4]
    final = {r["doc_id"]: r["n_tokens"] for r in corpus_pipeline.run(spark, str(tmp_path)).collect()}
    assert final.keys() == seen["secret_scan"].keys() and all(final.values())


def test_repeated_rows_of_an_id_become_one(spark, tmp_path):
    text = " ".join(f"word{i}" for i in range(30))
    found = corpus_pipeline.keep_one_of_each(spark, docs(spark, [(1, text), (1, text), (2, text), (None, text)]), str(tmp_path))
    assert sorted(str(r["doc_id"]) for r in found.collect()) == ["1", "None"]


def test_each_text_of_an_id_is_judged_by_itself(spark, tmp_path):
    text = lambda k: " ".join(f"{k}word{i}" for i in range(30))
    rows = [(5, text("b")), (5, text("c")), (5, text("c")), (6, text("c")), (7, text("d")), (None, text("e")), (None, text("e")), (None, text("f"))]
    found = corpus_pipeline.keep_one_of_each(spark, docs(spark, rows), str(tmp_path))
    assert found.columns == docs(spark, []).columns
    expected = [(5, "b"), (5, "c"), (7, "d"), (None, "e"), (None, "f")]
    assert sorted((str(r["doc_id"]), r["text"]) for r in found.collect()) == sorted((str(i), text(k)) for i, k in expected)


def test_queries_are_registered():
    assert {q.split("_")[0] for q in queries.QUERIES} == {"pipeline", *(f"op{n}" for n in range(1, 14))}
    assert queries.ORACLES.keys() <= queries.QUERIES.keys()


def test_stages_take_any_columns_and_empty_tables(spark, tmp_path):
    item = "planted words of the benchmark item that nobody else would ever write down here"
    plain = " ".join(f"word{i}" for i in range(40))
    columns = "doc_id long, text string, near_key string, near_row string, class_id long, id long, hit_id long, hit_digest string, n_chars long"
    rows = [(i, t, "k", "r", 1, 2, 3, "d", 9) for i, t in [(None, plain), (1, plain), (1, f"{item} {plain[::-1]}"), (2, plain), (3, None), (3, None)]]
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    table = spark.createDataFrame(rows, columns)
    once = corpus_pipeline.keep_one_of_each(spark, table, str(tmp_path))
    assert once.columns == table.columns
    expected = [("1", item[:7]), ("1", "word0 w"), ("3", "None"), ("None", "word0 w")]
    assert sorted((str(r["doc_id"]), str(r["text"])[:7]) for r in once.collect()) == sorted(expected)
    clean = corpus_pipeline.drop_contaminated(spark, table, str(tmp_path))
    assert clean.columns == table.columns and clean.count() == 5
    for _, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, table.where("false"), str(tmp_path)).count() == 0
