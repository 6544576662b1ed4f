import json

from foliant import cli


def test_jobs_from_items_to_answers(spark, tmp_path, capsys):
    t = str(tmp_path / "tables")
    doc = "a" * 64
    (tmp_path / doc).mkdir()
    items = [
        {"page_idx": 0, "type": "title", "text": "第一章 利率", "bbox": [50, 50, 900, 90]}, {"page_idx": 0, "type": "text", "text": "银行的贷款利率上升百分之五，行业借款人增加。", "bbox": [50, 100, 900, 200]},
        {"page_idx": 1, "type": "table", "table_body": "<table><tr><th>名称</th><th>金额</th></tr><tr><td>甲</td><td>5%</td></tr></table>", "bbox": [50, 100, 900, 200]},
    ]
    (tmp_path / doc / "x_content_list.json").write_text(json.dumps(items))
    assert cli.main(["ingest", "--items", f"{tmp_path}/{doc}/*.json", "--tables", t]) == 0
    assert cli.main(["ingest", "--items", f"{tmp_path}/{doc}/*.json", "--tables", t]) == 0  # again: nothing doubles
    assert spark.read.parquet(f"{t}/blocks.parquet").count() == 3
    assert cli.main(["rechunk", "--tables", t, "--out", f"{t}/chunks.parquet"]) == 0
    made = spark.read.parquet(f"{t}/chunks.parquet").collect()
    assert sorted(r.chunk_role for r in made) == ["table_row", "table_summary", "text_segment"] and {r.section_path for r in made if r.chunk_role == "text_segment"} == {"第一章 利率"}
    assert cli.main(["audit-chunks", "--chunks", f"{t}/chunks.parquet"]) == 0
    vectors = spark.createDataFrame([(r.chunk_id, [1.0, 0.0]) for r in made], "chunk_id string, dense_vector array<float>")
    vectors.write.parquet(f"{t}/own_vectors")
    assert cli.main(["index-chunks", "--chunks", f"{t}/chunks.parquet", "--vectors", f"{t}/own_vectors", "--out", f"{t}/index"]) == 0
    assert {r.embedding_state for r in spark.read.parquet(f"{t}/chunks.parquet").collect()} == {"embedded"} and spark.read.parquet(f"{t}/index").where("dim = 2").count() == 3
    assert cli.main(["query", "--chunks", f"{t}/chunks.parquet", "--text", "贷款利率"]) == 0
    assert "利率上升" in capsys.readouterr().out
    assert cli.main(["init", "--tables", t]) == 0
    assert cli.main(["doctor", "--tables", t]) in (0, 1)


def test_bad_sizes_are_refused(spark, tmp_path):
    try:
        cli.main(["rechunk", "--tables", str(tmp_path), "--out", str(tmp_path / "o"), "--overlap", "1200"])
    except ValueError:
        return
    raise AssertionError
