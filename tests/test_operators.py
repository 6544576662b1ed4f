import json

import numpy as np
import pytest
from pyspark.sql import functions as F

from foliant.operators import evaluation, images, quality, reports, retrieval
from foliant.options import Options
from foliant.plans.order import document_order, linked
from foliant.sinks import stores
from foliant.sources import parser_items
from foliant.streaming import ingest


def test_dense_search_against_brute_force(spark):
    rng = np.random.default_rng(5)
    rows = [(k, [float(x) for x in rng.normal(size=6)]) for k in range(80)] + [(80, [0.0] * 6), (81, [1.0]), (82, None)]
    corpus = spark.createDataFrame(rows, "key long, vector array<float>").repartition(5)
    queries = corpus.where("key % 20 = 0").select(F.col("key").alias("query_id"), "vector")
    got = {(r.query_id, r.dense_rank): (r.key, r.similarity) for r in retrieval.dense_ranks(spark, queries, corpus, 7).collect()}
    m = {k: np.array(np.float32(v), np.float64) for k, v in rows if v is not None and len(v) == 6}
    for q in (0, 20, 40, 60):
        cos = {k: round(float(m[q] @ v / (np.linalg.norm(m[q]) * np.linalg.norm(v))) if np.linalg.norm(v) else 0.0, 6) for k, v in m.items()}
        want = sorted(cos.items(), key=lambda x: (-x[1], x[0]))[:7]
        assert [got[q, r + 1] for r in range(7)] == want
    assert retrieval.dense_ranks(spark, queries.limit(0), corpus, 7).count() == 0


def test_fusion_and_parent_cap(spark):
    dense = spark.createDataFrame([("q", "a", 1), ("q", "b", 2)], "query_id string, id string, dense_rank int")
    lexical = spark.createDataFrame([("q", "b", 1), ("q", "c", 2)], "query_id string, id string, lexical_rank int")
    got = {r.id: r.rrf for r in retrieval.fuse(dense, lexical, ["query_id", "id"]).collect()}
    assert abs(got["b"] - (1 / 62 + 1 / 61)) < 1e-12 and abs(got["a"] - 1 / 61) < 1e-12 and abs(got["c"] - 1 / 62) < 1e-12
    rows = [("q", f"r{k}", 1.0 - k / 100, k, None, k, k, "P", "table_row") for k in range(1, 6)] + [("q", f"t{k}", 0.5 - k / 100, 9 + k, k, None, k, "Q", "text_segment") for k in range(1, 4)]
    c = spark.createDataFrame(rows, "query_id string, id string, relevance double, rerank_position int, dense_rank int, lexical_rank int, document_order int, parent string, chunk_role string")
    assert [r.id for r in retrieval.final_order(c).orderBy("rank").collect()] == ["r1", "r2", "r3", "t1", "t2"]


def test_near_ties_follow_rank_agreement(spark):
    rows = [("q", "x", 0.973, 2, 1, 1, 0, "x", "text_segment"), ("q", "y", 0.980, 1, 6, 8, 1, "y", "text_segment")]
    c = spark.createDataFrame(rows, "query_id string, id string, relevance double, rerank_position int, dense_rank int, lexical_rank int, document_order int, parent string, chunk_role string")
    assert retrieval.final_order(c).orderBy("rank").first().id == "x"


def test_prefix_metrics(spark):
    q = spark.createDataFrame([("Q", "text", "hard", ["56963.10亿元", "利率"], 3, None), ("R", "text", "easy", None, None, None)], "id string, modality string, difficulty string, must_retrieve_keywords array<string>, page_no int, page_range array<int>")
    r = spark.createDataFrame([("Q", 1, "单位：亿元\n总额=56963.10", 2, 3), ("Q", 2, "利 率", 9, 9)], "id string, rank int, text string, page_start int, page_end int")
    got = {(m.id, m.k): m for m in retrieval.prefix_metrics(q, r, (1, 3)).collect()}
    assert (got["Q", 1].n_hits, got["Q", 1].page_hit, got["Q", 1].grounded) == (1, True, False)
    assert (got["Q", 3].n_hits, got["Q", 3].best_single, got["Q", 3].strict_success, got["Q", 3].grounded) == (2, 1, True, True)
    assert got["R", 3].page_hit is None and got["R", 3].coverage == 1.0 and got["R", 3].grounded
    near = spark.createDataFrame([("Q", 1, "亿元 156963.10 56963.101", 3, 3)], "id string, rank int, text string, page_start int, page_end int")
    assert retrieval.prefix_metrics(q, near, (1,)).where("id = 'Q'").first().n_hits == 0
    groups = {(g.grouped_by, g.value, g.k): g for g in retrieval.metric_groups(retrieval.prefix_metrics(q, r, (1, 3))).collect()}
    assert groups["overall", "all", 3].n_questions == 2 and groups["overall", "all", 3].page_hit_rate == 1.0 and groups["difficulty", "hard", 1].grounded_rate == 0.0


def test_document_order_and_links(spark):
    rows = [("d", p, k, f"{p}-{k}") for p in (1, 2, 4) for k in range(3)] + [("e", 1, 0, "x")]
    df = spark.createDataFrame(rows, "doc string, page int, k int, id string")
    got = sorted((r.doc, r.document_order, r.id) for r in document_order(df, "doc", "page", ["k"]).collect())
    assert [g[2] for g in got if g[0] == "d"] == [r[3] for r in rows[:9]]
    ids = {r.id: (r.previous_id, r.next_id) for r in linked(df, "doc", "page", ["k"], "id").collect()}
    assert ids["1-0"] == (None, "1-1") and ids["2-0"] == ("1-2", "2-1") and ids["4-2"] == ("4-1", None) and ids["x"] == (None, None)


def test_length_profile_floor_index(spark):
    values = [1, 2, 3, 4, 100, 7]
    df = spark.createDataFrame([("g", v) for v in values] + [("n", None)], "g string, v int")
    r = evaluation.length_profile(df, "g", F.col("v")).collect()
    s = sorted(values)
    assert len(r) == 1 and (r[0].n, r[0].least, r[0].median, r[0].p95, r[0].most) == (6, 1, (s[2] + s[3]) // 2, s[int(5 * 0.95)], 100)


def test_chunk_audit_scores(spark):
    rows = [("a", "text_segment", "x" * 30, "x", "单位：元", ["s"]), ("a", "text_segment", "x" * 30, "x", "", []), ("b", "text_segment", "short", "e", "", ["s"])]
    got = {r.check: r.n for r in evaluation.chunk_audit(spark.createDataFrame(rows, "chunk_id string, chunk_role string, display_text string, embedding_text string, section_path string, source_block_ids array<string>")).collect()}
    assert got == {"duplicate_chunk_id": 1, "missing_source_blocks": 1, "exact_duplicate_text": 1, "bad_section_path": 1, "short_text_chunk": 1, "score": 100 - 80 - 1}
    empty = spark.createDataFrame([], "chunk_id string, chunk_role string, display_text string, embedding_text string, section_path string, source_block_ids array<string>")
    assert {r.check: r.n for r in evaluation.chunk_audit(empty).collect()} == {"empty_chunk_set": 1, "score": 80}


def test_image_statistics():
    grey = np.full((100, 100), 128, np.uint8)
    assert images.image_flags(grey) == ["SRC-003", "SRC-002"]
    assert "SRC-004" in images.image_flags(np.zeros((100, 100), np.uint8))
    page = np.full((800, 1000), 255, np.uint8)
    page[100:150, 200:800] = 0
    assert images.dark_regions(page) == [(200, 100, 600, 50)]
    rules = np.full((900, 600), 100, np.uint8)
    for y in (50, 200):
        rules[y] = 250
    assert images.bright_rules(rules) == [50, 200]
    assert images.ink_share(page) > 0.004


def test_parser_items(spark, tmp_path):
    items = [{"page_idx": 0, "type": "text", "text": "甲", "bbox": [1, 2, 3, 4]}, 7, {"page_idx": 0, "type": "Table", "table_body": "", "html": "<table></table>"}, {"page_no": 3, "type": "image", "image_caption": ["a", "b"]}, {"type": "odd", "content": "x"}]
    (tmp_path / "a.json").write_text(json.dumps(items))
    (tmp_path / "b.json").write_text(json.dumps({"content_list": [{"page_idx": 1, "type": "equation", "latex": "x^2"}]}))
    rows = parser_items.read_items(spark, f"{tmp_path}/*.json")
    blocks = parser_items.blocks_of_items(rows, F.regexp_extract("path", r"([^/]+)\.json", 1))
    got = {(r.document_id, r.page_no, r.reading_order): (r.block_type, r.raw_content) for r in blocks.collect()}
    assert got == {("a", 1, 0): ("text", "甲"), ("a", 1, 1): ("table", "<table></table>"), ("a", 1, 2): ("unknown", "x"), ("a", 3, 0): ("image", "a\nb"), ("b", 2, 0): ("formula", "x^2")}
    counts = spark.createDataFrame([("a", 4), ("b", 0)], "document_id string, page_count int")
    pages = {(r.document_id, r.page_no): r.width for r in parser_items.pages_of_blocks(blocks, counts).collect()}
    assert pages == {("a", 1): 1000.0, ("a", 2): None, ("a", 3): None, ("a", 4): None, ("b", 2): None}


def test_text_lines(spark):
    words = spark.createDataFrame([("d", 1, 0, 1, "b", 20.0, 5.0, 30.0, 10.0, 100.0, 50.0), ("d", 1, 0, 0, "a", 10.0, 6.0, 18.0, 12.0, 100.0, 50.0), ("d", 1, 1, 0, "x", 9.0, 5.0, 3.0, 6.0, 100.0, 50.0)], "document_id string, page_no int, line_no int, word_no int, text string, x0 double, y0 double, x1 double, y1 double, page_width double, page_height double")
    r = parser_items.text_lines(words).collect()
    assert len(r) == 1 and r[0].text == "a b" and tuple(r[0].bbox) == (100.0, 100.0, 300.0, 240.0)
    assert parser_items.invalid_words(words).first().n_invalid == 1


def test_json_of_reply(spark):
    df = spark.createDataFrame([('```json\n{"a": 1}\n```',), ("no json",)], "x string").select(parser_items.json_of_reply(F.col("x")).alias("v"))
    assert [r.j for r in df.select(F.to_json("v").alias("j")).collect()] == ['{"a":1}', None]


def test_replacing_documents(spark, tmp_path):
    store = f"{tmp_path}/store"
    one = spark.createDataFrame([("d", "a", 1), ("e", "b", 1)], "document_id string, chunk_id string, v int")
    stores.replace_documents(spark, store, one)
    stores.replace_documents(spark, store, spark.createDataFrame([("d", "c", 2)], "document_id string, chunk_id string, v int"))
    assert {(r.document_id, r.chunk_id) for r in spark.read.parquet(store).collect()} == {("d", "c"), ("e", "b")}
    assert stores.store_buckets(spark, store) == stores.BUCKETS
    wrong = spark.createDataFrame([("d", "c", "x")], "document_id string, chunk_id string, v string")
    with pytest.raises(TypeError):
        stores.replace_documents(spark, store, wrong)
    assert spark.read.parquet(store).count() == 2  # untouched
    spark.range(3).write.parquet(f"{tmp_path}/other")
    with pytest.raises(ValueError):
        stores.replace_documents(spark, f"{tmp_path}/other", one)
    assert spark.read.parquet(f"{tmp_path}/other").count() == 3
    ids = spark.createDataFrame([("c",)], "chunk_id string")
    marked = stores.marked_embedded(spark.read.parquet(store).withColumn("embedding_state", F.lit("pending")), ids)
    assert {(r.chunk_id, r.embedding_state) for r in marked.collect()} == {("c", "embedded"), ("b", "pending")}


def test_vectors_need_one_length(spark):
    chunks = spark.createDataFrame([("a", "t" * 3)], "chunk_id string, text string")
    good = spark.createDataFrame([("a", [1.0, 2.0])], "chunk_id string, dense_vector array<float>")
    assert stores.vector_rows(chunks, good).first().dim == 2
    for bad in ([("a", [1.0]), ("b", [1.0, 2.0])], [("z", [1.0])]):
        try:
            stores.vector_rows(chunks, spark.createDataFrame(bad, "chunk_id string, dense_vector array<float>")).collect()
        except Exception:  # noqa: S112
            continue
        raise AssertionError(bad)


def test_streams_follow_files(spark, tmp_path):
    folder, store = f"{tmp_path}/in", f"{tmp_path}/store"
    schema = "document_id string, block_id string, v int"
    spark.createDataFrame([("d", "a", 1), ("d", "a", 1)], schema).write.parquet(f"{folder}/1")
    query = ingest.follow_blocks(spark, f"{folder}/*", spark.createDataFrame([], schema).schema, store, f"{tmp_path}/c")
    query.awaitTermination(120)
    spark.createDataFrame([("d", "b", 2), ("e", "x", 2)], schema).write.parquet(f"{folder}/2")
    query = ingest.follow_blocks(spark, f"{folder}/*", spark.createDataFrame([], schema).schema, store, f"{tmp_path}/c")
    query.awaitTermination(120)
    assert {(r.document_id, r.block_id) for r in spark.read.parquet(store).collect()} == {("d", "b"), ("e", "x")}


def test_crops(spark):
    rows = [((844, 143, 870, 373), 1000.0), ((870, 373, 844, 143), 1000.0), ((1200, 100, 1300, 200), 1000.0), (None, 1000.0), ((1.0, 2.0, float("nan"), 3.0), 1000.0), ((1.0, 1.0, 2.0, 2.0), None), ((1.0, None, 2.0, 2.0), 1000.0)]
    rows = [(k, None if b is None else tuple(None if v is None else float(v) for v in b), size, 1000.0, 1871, 2521) for k, (b, size) in enumerate(rows)]
    df = spark.createDataFrame(rows, "k int, bbox struct<x0:double,y0:double,x1:double,y1:double>, source_width double, source_height double, width int, height int")
    got = images.crops(df).orderBy("k").collect()
    assert [r.crop_mode for r in got] == ["bbox_crop", "bbox_crop", "full_page_fallback", "full_page_no_bbox", "full_page_fallback", "full_page_fallback", "full_page_fallback"]
    assert tuple(got[0].crop) == tuple(got[1].crop) == (1567, 348, 1640, 953) and tuple(got[3].crop) == (0, 0, 1871, 2521)


def test_regions():
    assert images.region([0, 0, 1, 0.5], 100, 80) == (0, 0, 100, 40) and images.region([0, 0, 5, 5], 100, 80) is None and images.region("x", 9, 9) is None


def test_coloured_table_tiles_end_on_rules():
    picture = np.full((900, 600, 3), (217, 232, 245), np.uint8)
    picture[:50] = (18, 63, 115)
    for y in (50, 200, 350, 500, 650, 780):
        picture[y : y + 2] = 255
    tiles = images.cut_tiles(picture, [0, 0, 1, 0.15], [0, 0.15, 1, 0.87], most=550, overlap=100)
    assert [t.shape[0] for t in tiles] == [500, 480, 300]
    assert len(images.cut_tiles(picture[:300], most=550)) == 1


def test_sideways_tables():
    grey = np.full((600, 300), 255, np.uint8)
    for y in range(60, 600, 90):
        grey[y : y + 3] = 0
    assert images.sideways(grey) and not images.sideways(grey.T) and images.ruled_lines(grey)[:2] == [61, 151]


def test_dense_search_of_string_keys(spark):
    rng = np.random.default_rng(4)
    vectors = [(f"k{k:03}", [float(x) for x in rng.integers(-2, 3, 4)]) for k in range(300)] + [("none", None), ("short", [1.0]), ("zero", [0.0] * 4)]
    corpus = spark.createDataFrame(vectors, "key string, vector array<float>").repartition(5)
    asked = [("a", [1.0, 0.0, 2.0, -1.0]), ("b", [0.0] * 4), ("c", [1.0]), ("d", None)]
    got = {}
    for r in retrieval.dense_ranks(spark, spark.createDataFrame(asked, "query_id string, vector array<float>"), corpus, 7).orderBy("query_id", "dense_rank").collect():
        got.setdefault(r.query_id, []).append((r.key, r.similarity))
    for name, q in asked[:2]:
        cos = lambda v, q=q: round(float(np.dot(q, v) / (np.linalg.norm(q) * np.linalg.norm(v))), 6) if np.linalg.norm(q) * np.linalg.norm(v) > 0 else 0.0
        want = sorted(((k, cos(v)) for k, v in vectors if v is not None and len(v) == 4), key=lambda x: (-x[1], x[0]))[:7]
        assert got[name] == want
    assert got["c"] == [("short", 1.0)] and "d" not in got


def test_hybrid_search_filters_and_reranks(spark):
    rows = [("1", "d", "text", "贷款利率上升", None), ("2", "d", "table", "贷款利率表", None), ("3", "e", "text", "天气很好", None), ("4", "e", "text", "贷款利率", None)]
    chunks_ = spark.createDataFrame([(*r, "text_segment", 1, 1) for r in rows], "chunk_id string, document_id string, block_type string, display_text string, parent_id string, chunk_role string, page_start int, page_end int")
    asked = spark.createDataFrame([("q", "贷款利率")], "query_id string, query string")
    asked = asked.join(retrieval.hashed_vectors(asked, "query_id", "query"), "query_id")
    vectors = retrieval.hashed_vectors(chunks_, "chunk_id", "display_text")
    search = lambda **more: [r.chunk_id for r in retrieval.hybrid_search(spark, asked, chunks_, vectors, 3, **more).orderBy("rank").collect()]
    assert search()[0] == "4" and set(search(document_id="d")) == {"1", "2"} and search(block_type="table") == ["2"]
    answers = spark.createDataFrame([("q", "3", 0.9), ("q", "1", 0.2)], "query_id string, chunk_id string, relevance double")
    assert search(relevance=answers)[:2] == ["3", "1"]


def test_regressions_in_ranges(spark, monkeypatch):
    import random

    rng = random.Random(2)
    rows = [(d, f"{rng.getrandbits(64):016x}", rng.choice([None, *range(9)]), rng.randint(0, 9)) for d in "ab" for _ in range(700)]
    df = spark.createDataFrame(rows, "document_id string, chunk_id string, page_start int, page_end int")
    monkeypatch.setattr(evaluation, "REGRESSION_ROWS", 8)
    got = {r.document_id: (r.n_start, r.n_end) for r in evaluation.order_regressions(df).collect()}
    for d in "ab":
        own = sorted(r[1:] for r in rows if r[0] == d)
        fell = lambda k: sum(x[k] is not None and y[k] is not None and x[k] > y[k] for x, y in zip(own, own[1:]))
        assert got[d] == (fell(1), fell(2))


def test_small_sinks(spark, tmp_path):
    docs = spark.createDataFrame([("d", "new", 1), ("e", "new", 1)], "document_id string, status string, updated_at int")
    changes = spark.createDataFrame([("d", "done", 3), ("d", "late", 2)], "document_id string, status string, updated_at int")
    assert {(r.document_id, r.status) for r in stores.with_status(docs, changes).collect()} == {("d", "done"), ("e", "new")}
    text = '{"url": "http://a/b?k=1#x", "deep": [{"file_url": "c?d"}], "q": "why?"}'
    got = spark.createDataFrame([(text,)], "t string").select(stores.redacted(F.col("t")).alias("t")).first().t
    assert got == '{"url": "http://a/b", "deep": [{"file_url": "c"}], "q": "why?"}'
    stores.append_events(spark.createDataFrame([(1, "s")], "event_id int, stage string"), f"{tmp_path}/e", "r1")
    stores.append_events(spark.createDataFrame([(2, "t")], "event_id int, stage string"), f"{tmp_path}/e", "r2")
    assert {(r.event_id, r.run_id) for r in spark.read.json(f"{tmp_path}/e").collect()} == {(1, "r1"), (2, "r2")}
    assert stores.read_manifest(spark, f"{tmp_path}/none") == {}
    stores.write_manifest(spark, f"{tmp_path}/m", {"run": 1})
    assert stores.read_manifest(spark, f"{tmp_path}/m")["run"] == 1
    chunks = spark.createDataFrame([("d", "a"), ("d", "a")], "document_id string, chunk_id string")
    for bad, documents in ((chunks, None), (chunks.limit(1), docs.where("document_id = 'e'"))):
        with pytest.raises(ValueError):
            stores.checked_chunks(bad, "d", documents)


def test_answers_and_names(spark):
    got = spark.createDataFrame([("True",), (" 是 ",), ("no",), (None,), ("同一张表",)], "x string").select(quality.said_yes(F.col("x")).alias("y")).collect()
    assert [r.y for r in got] == [True, True, False, False, True]
    assert [r.v for r in spark.createDataFrame([("图表",), ("Photo",)], "x string").select(quality.visual_type(F.col("x")).alias("v")).collect()] == ["chart", "photo"]


def test_change_reports(spark):
    rows = [("i", "text", "甲乙丙丁。", "甲乙丙丁乙丙。"), ("t", "text", "一二三四五六七八九十。", "一二三"), ("n", "text", "利率5%", "利率6%"), ("s", "text", "同 上", "同上"), ("f", "footnote", "①见", "a见")]
    df = spark.createDataFrame(rows, "block_id string, block_type string, raw_content string, resolved_content string")
    got = {r.block_id: r.kinds for r in reports.text_changes(df).collect()}
    assert got == {"i": "repeated_insertion", "t": "truncation", "n": "numbers", "s": "", "f": "footnote_marks"}
    assert {r.kind: r.n for r in reports.change_counts(reports.text_changes(df)).collect()}["any"] == 4


def test_windows_on_streams_drop_repeats_and_late_rows(spark, tmp_path):
    schema = "event_id long, ts timestamp, event_type string, value double"
    rows = [(1, "2024-01-01 00:10:00", "a", 1.0), (1, "2024-01-01 00:10:00", "a", 1.0), (2, "2024-01-01 00:50:00", "a", 2.0), (3, "2024-01-01 05:00:00", "a", 4.0)]
    frame = lambda r: spark.createDataFrame(r, "event_id long, ts string, event_type string, value double").withColumn("ts", F.to_timestamp("ts"))
    batch = {str(r.window_start): (r.n, r.total) for r in ingest.windowed_events(frame(rows)).collect()}
    assert batch == {"2024-01-01 00:00:00": (2, 3.0), "2024-01-01 05:00:00": (1, 4.0)}
    for k, part in enumerate([rows, [(9, "2024-01-01 00:20:00", "a", 8.0), (4, "2024-01-01 09:00:00", "a", 1.0)], [(5, "2024-01-01 12:00:00", "a", 1.0)]]):
        frame(part).coalesce(1).write.mode("append").parquet(f"{tmp_path}/in")
        stream = spark.readStream.schema(frame(rows).schema).parquet(f"{tmp_path}/in")
        query = ingest.windowed_events(stream).writeStream.format("parquet").option("path", f"{tmp_path}/out").option("checkpointLocation", f"{tmp_path}/c").outputMode("append").trigger(availableNow=True).start()
        query.awaitTermination(120)
        assert query.exception() is None, k
    got = {str(r.window_start): (r.n, r.total) for r in spark.read.parquet(f"{tmp_path}/out").collect()}
    assert got == {"2024-01-01 00:00:00": (2, 3.0), "2024-01-01 05:00:00": (1, 4.0), "2024-01-01 09:00:00": (1, 1.0)}


def test_assets_layout_files_and_runs(spark, tmp_path):
    folder = tmp_path / "run"
    folder.mkdir()
    (folder / "pic.png").write_bytes(b"abc")
    (folder / "layout.json").write_text('{"_backend": "vlm-x", "_ocr_enable": true, "pdf_info": [1, 2]}')
    (folder / "a_middle.json").write_text("{}")
    blocks = spark.createDataFrame([("d", 1, "b", "image", "images/pic.png"), ("d", 1, "c", "image", "none.png"), ("d", 1, "e", "text", "")], "document_id string, page_no int, block_id string, block_type string, image string")
    got = parser_items.assets_of_blocks(spark, blocks, f"{folder}/*.png").collect()
    assert [(r.block_id, r.mime_type, r.length) for r in got] == [("b", "image/png", 3)] and got[0].sha256.startswith("ba7816bf")
    meta = parser_items.layout_metadata(spark, f"{folder}/*.json").first()
    assert meta.layout_json.endswith("layout.json") and (meta.backend, meta.ocr_enable, meta.page_count, meta.read_error) == ("vlm-x", True, 2, None)
    (folder / "layout.json").write_text("no")
    assert parser_items.layout_metadata(spark, f"{folder}/*.json").first().read_error == "no JSON object"
    runs = spark.createDataFrame([("vlm-x", 2, 2, True, "a", "b"), ("pipeline", 1, 2, True, "a", "a"), ("vlm", 1, 2, False, None, None)], "backend string, page_count int, expected_pages int, full_document boolean, archive_sha256 string, baseline_sha256 string")
    assert [r.problems for r in parser_items.run_problems(runs).collect()] == [[], ["backend", "page_count", "same_archive"], []]


def test_options_from_the_environment():
    made = Options.from_environment({"FOLIANT_TEXT_SIZE": "900", "FOLIANT_MARGIN_SHARE": "0.5", "OTHER": "x"})
    assert (made.text_size, made.margin_share, made.text_overlap) == (900, 0.5, 120)
    with pytest.raises(ValueError):
        Options.from_environment({"FOLIANT_TEXT_SIZE": "0"})


def test_structure_replies(spark):
    rows = [('```json\n{"rotation_degrees": 90, "title": "t"}\n```',), ('{"rotation_degrees": 45}',), ("no",), (None,)]
    got = [r.s for r in spark.createDataFrame(rows, "x string").select(parser_items.structure_of_reply(F.col("x")).alias("s")).collect()]
    assert got[0].rotation_degrees == 90 and got[0].title == "t" and got[0].header_rows == 1 and got[0].footnotes == [] and got[1:] == [None, None, None]
