from pyspark.sql import functions as F
from pyspark.sql import types as ty

from foliant.operators import audit, chunks, layout, tables

BLOCK = "block_id string, document_id string, page_no int, block_type string, bbox struct<x0:double,y0:double,x1:double,y1:double>, reading_order int, raw_content string, resolved_content string, source string, asset_id string, section_path array<string>, issue_flags array<string>, status string, text_level int, column_index int, skip_chunk boolean, chunk_eligible boolean, source_pages array<int>"


def block(i, text, box=None, kind="text", page=1, order=0, **more):
    row = {"block_id": i, "document_id": "d", "page_no": page, "block_type": kind, "bbox": box, "reading_order": order, "raw_content": text, "resolved_content": text, "source": "s", "asset_id": None, "section_path": [], "issue_flags": [], "status": "accepted", "text_level": None, "column_index": None, "skip_chunk": False, "chunk_eligible": None, "source_pages": None}
    row.update(more)
    return tuple(row.values())


def frames(spark, rows, width=1000.0, height=1400.0):
    blocks = layout.laid_out(spark.createDataFrame(rows, BLOCK))
    pages = blocks.select("document_id", "page_no").distinct().withColumn("width", F.lit(width)).withColumn("height", F.lit(height))
    return blocks, pages


def ordered(spark, rows, **size):
    blocks, pages = frames(spark, rows, **size)
    got = layout.reading_order(blocks, pages).orderBy("page_no", "place").collect()
    return [r.block_id for r in got], got


def test_two_columns_between_wide_blocks(spark):
    rows = [
        block("R1", "r1", (520.0, 200.0, 950.0, 300.0), order=0), block("L1", "l1", (50.0, 200.0, 480.0, 300.0), order=1), block("T", "title", (50.0, 50.0, 950.0, 120.0), kind="title", order=2),
        block("L2", "l2", (50.0, 320.0, 480.0, 420.0), order=3), block("R2", "r2", (520.0, 320.0, 950.0, 420.0), order=4), block("C", "caption", (50.0, 500.0, 950.0, 560.0), order=5),
    ]
    ids, got = ordered(spark, rows)
    assert ids == ["T", "L1", "L2", "R1", "R2", "C"]
    assert sum("LAY-001" in r.new_flags for r in got) == 4 and got[0].strategy == "layout_columns"


def test_year_prefix_goes_before_its_continuation(spark):
    rows = [block("A", "正文", (500.0, 100.0, 900.0, 149.0), order=0), block("C", "末，余额上升", (500.0, 150.0, 900.0, 199.0), order=1), block("P", "截至2024年", (60.0, 201.0, 400.0, 250.0), order=2)]
    ids, got = ordered(spark, rows)
    assert ids.index("P") + 1 == ids.index("C") and got[0].mended == 1


def test_page_without_boxes_and_furniture_last(spark):
    ids, got = ordered(spark, [block("b", "2", order=1), block("a", "1", order=0), block("h", "head", kind="header", order=2)])
    assert ids == ["a", "b", "h"] and got[0].strategy == "delivered_order"


def test_templates_by_repetition_and_place(spark):
    rows = []
    for p in (1, 2, 3):
        rows += [block(f"h{p}", "年度 报告", (0.0, 10.0, 900.0, 40.0), page=p), block(f"n{p}", f"第{p}页", (400.0, 1350.0, 500.0, 1380.0), page=p, order=2), block(f"t{p}", f"正文{'一二三'[p - 1]}", (0.0, 500.0, 900.0, 700.0), page=p, order=1)]
    blocks, pages = frames(spark, rows)
    got = {r.block_id: r.template_kind for r in layout.templates(blocks, pages).collect()}
    assert got == {**{f"h{p}": "repeated_header" for p in (1, 2, 3)}, **{f"n{p}": "page_number" for p in (1, 2, 3)}}
    single, sizes = frames(spark, rows[:3])
    assert layout.templates(single, sizes).count() == 0


def test_carried_over_text(spark):
    rows = [block("a", "前面的文字，以及在页末重复的一行文字内容。", (0.0, 1200.0, 900.0, 1300.0)), block("b", "在页末重复的一行文字内容。", (0.0, 50.0, 900.0, 90.0), page=2), block("c", "新的一行", (0.0, 100.0, 900.0, 190.0), page=2, order=1)]
    blocks, pages = frames(spark, rows)
    assert [(r.block_id, r.duplicate_of, r.from_page) for r in layout.carried_over(blocks, pages).collect()] == [("b", "a", 1)]


def test_context_and_captions(spark):
    rows = [
        block("t", "表1 利率", (100.0, 100.0, 400.0, 130.0), kind="title", order=0), block("u", "单位：亿元", (300.0, 135.0, 400.0, 150.0), order=1), block("T", "<table></table>", (100.0, 160.0, 500.0, 400.0), kind="table", order=2),
        block("n", "注：见附录", (100.0, 410.0, 500.0, 430.0), order=3), block("far", "别处", (600.0, 900.0, 900.0, 950.0), order=4), block("I", "图", (100.0, 960.0, 500.0, 1100.0), kind="image", order=5),
    ]
    blocks, pages = frames(spark, rows)
    assert {(r.context_id, r.kind) for r in layout.table_context(blocks, pages).collect()} == {("t", "title"), ("u", "unit"), ("n", "note")}
    assert [(r.block_id, r.caption) for r in layout.visual_captions(blocks, pages).collect()] == [("I", "别处")]


def test_sections(spark):
    rows = [
        block("c", "第二章", kind="title", order=0), block("n", "利率", kind="title", order=1), block("x", "正文", order=2), block("s", "1.1 小节", kind="title", order=3), block("y", "正文", order=4),
        block("z", "下一页", page=2, order=0), block("d", "第三章", kind="title", page=2, order=1), block("w", "正文", page=2, order=2),
    ]
    blocks, pages = frames(spark, rows)
    got = {r.block_id: r.section_path for r in layout.section_paths(blocks, layout.table_context(blocks, pages)).collect()}
    assert got == {"c": "第二章", "n": "第二章 利率", "x": "第二章 利率", "s": "第二章 利率 / 1.1 小节", "y": "第二章 利率 / 1.1 小节", "z": "第二章 利率 / 1.1 小节", "d": "第三章", "w": "第三章"}


def test_chunk_roles_links_and_tiers(spark):
    table = "<table><tr><th>名称</th><th>金额</th></tr>" + "".join(f"<tr><td>r{k}</td><td>{k}</td></tr>" for k in range(7)) + "</table>"
    rows = [
        block("a", "左一。", (50.0, 100.0, 450.0, 200.0), order=0, column_index=0), block("b", "左二。", (50.0, 210.0, 450.0, 300.0), order=1, column_index=0), block("c", "右一。", (550.0, 100.0, 950.0, 200.0), order=2, column_index=1),
        block("d", "待核。", (550.0, 300.0, 950.0, 400.0), order=3, column_index=1, status="review"), block("f", "E=mc", (100.0, 700.0, 300.0, 730.0), kind="formula", order=4), block("t", table, (50.0, 800.0, 900.0, 1000.0), kind="table", order=5),
        block("h", "页眉", kind="header", order=6), block("k", "a 5%。b 上升。", (50.0, 1100.0, 500.0, 1200.0), kind="chart", order=7), block("e", "", order=8), block("n", "脚注", (50.0, 1300.0, 300.0, 1320.0), kind="footnote", order=9),
    ]
    blocks, pages = frames(spark, rows)
    made = chunks.build_chunks(blocks, layout.table_context(blocks, pages), layout.visual_captions(blocks, pages), chunks.Options(table_row_group=3)).cache()
    got = made.collect()
    roles = {}
    for r in got:
        roles[r.chunk_role] = roles.get(r.chunk_role, 0) + 1
    assert roles == {"text_segment": 3, "table_summary": 1, "table_row_group": 2, "table_row": 7, "formula_context": 1, "chart_summary": 1, "chart_fact": 2, "footnote": 1}
    first = next(r for r in got if r.source_block_ids == ["a", "b"])
    assert first.display_text == "左一。\n\n左二。" and first.retrieval_tier == "verified"
    assert next(r for r in got if r.source_block_ids == ["d"]).retrieval_tier == "provisional"
    assert len({r.chunk_id for r in got}) == len(got) == len({r.display_text for r in got})
    linked = {r.chunk_id: r for r in chunks.link_chunks(made).collect()}
    order = sorted(linked.values(), key=lambda r: r.document_order)
    assert [r.document_order for r in order] == list(range(len(got)))
    assert all(a.next_chunk_id == b.chunk_id and b.previous_chunk_id == a.chunk_id for a, b in zip(order, order[1:]))


def test_text_runs_cross_pages_only_inside_a_sentence(spark):
    rows = [block("a", "没有说完", page=1), block("h", "页眉", kind="header", page=2), block("b", "的句子。", page=2, order=1), block("c", "新的一段。", page=3)]
    blocks, pages = frames(spark, rows)
    groups = chunks.text_groups(chunks.prepared(blocks, layout.table_context(blocks, pages))).collect()
    by = {r.block_id: r.group_id for r in groups}
    assert by["a"] == by["b"] != by["c"]


def test_continuation_and_merge(spark):
    one = "<table><tr><th>名称</th><th>金额</th></tr><tr><td>a</td><td>1</td></tr></table>"
    rows = [block("p", one, (50.0, 1000.0, 900.0, 1350.0), kind="table"), block("q", one.replace("<td>a</td><td>1</td>", "<td>b</td><td>2</td>"), (50.0, 60.0, 900.0, 300.0), kind="table", page=2)]
    blocks, pages = frames(spark, rows)
    pairs = tables.continuation_pairs(blocks, pages)
    pair = pairs.first()
    assert pair.auto_eligible and pair.score >= 0.8 and pair.decision == "merge" and not pair.hard_negative
    merged = tables.merged_tables(blocks, pairs).collect()
    assert [(m.root_id, m.n_parts, m.source_pages, m.child_ids) for m in merged] == [("p", 2, "1,2", ["q"])]
    done = {r.block_id: r for r in tables.with_merged_tables(blocks, pages).collect()}
    assert done["p"].source_pages == [1, 2] and done["p"].issue_flags == ["TAB-003"] and done["p"].raw_content == one and done["p"].content == merged[0].merged_html
    assert done["q"].skip_chunk and not done["p"].skip_chunk
    rows += [block("x", "附表7 资产", (50.0, 950.0, 900.0, 990.0), order=1), block("y", "附表8 负债", (50.0, 10.0, 900.0, 50.0), page=2, order=1)]
    blocks, pages = frames(spark, rows)
    pairs = tables.continuation_pairs(blocks, pages)
    assert pairs.first().hard_negative and tables.merged_tables(blocks, pairs).count() == 0
    merges = spark.createDataFrame([("p", "q", 2)], "root_id string, child_id string, page_no int")
    assert tables.unsafe_merges(merges, pairs).first().revert


def test_arbitration(spark):
    rows = [block("eq", "利率 5%"), block("add", "利率为5%"), block("bad", "利率为5%"), block("none", ""), block("un", "x")]
    blocks, _ = frames(spark, rows)
    readings = spark.createDataFrame([("eq", True, "利率5％"), ("add", True, "利率为5%，上升"), ("bad", True, "利率为6%"), ("none", True, "新"), ("un", False, None)], "block_id string, readable boolean, text string")
    for name in ("html", "latex", "summary", "structured_data"):
        readings = readings.withColumn(name, F.lit(None).cast("string"))
    layer = spark.createDataFrame([("add", "利率为5%，上升")], "block_id string, reference string")
    got = {r.block_id: (r.outcome, r.new_status) for r in audit.arbitrate(blocks, readings, layer).collect()}
    assert got == {"eq": ("agreed", "accepted"), "add": ("verified_addition", "repaired"), "bad": ("conflict", "review"), "none": ("single_source", "repaired"), "un": ("unreadable", "review")}


def test_arbitration_never_rewrites_evidence(spark):
    rows = [block("form", "利率 为5%"), block("twice", "5%和5%"), block("known", "甲乙甲"), block("f", "x_{1}", kind="formula"), block("pic", "", kind="image"), block("lost", "y", kind="title")]
    blocks, _ = frames(spark, rows)
    more = [("form", True, "利率为5%，上升", None, None), ("twice", True, "5%和5%，另5", None, None), ("known", True, "甲乙甲乙", None, None), ("f", True, "t", "x_{2}", None), ("pic", True, None, None, "一张图"), ("lost", True, " ", None, "")]
    readings = spark.createDataFrame(more, "block_id string, readable boolean, text string, latex string, summary string").withColumn("html", F.lit("")).withColumn("structured_data", F.lit(None).cast("string"))
    layer = spark.createDataFrame([("form", "利率为5%，上升"), ("twice", "5%和5%，另5"), ("known", "甲乙甲乙")], "block_id string, reference string")
    got = {r.block_id: r for r in audit.arbitrate(blocks, readings, layer).collect()}
    assert {k: r.outcome for k, r in got.items()} == {"form": "conflict", "twice": "verified_addition", "known": "conflict", "f": "single_source", "pic": "single_source", "lost": "empty"}
    assert got["form"].new_content == "利率 为5%" and got["form"].flag == "TXT-003" and got["form"].eligible is False
    assert got["f"].new_content == "x_{2}" and got["pic"].new_content == "一张图" and got["lost"].new_content == "y"


def line(no, text, box, page=1):
    return ("d", page, no, text, box)


LINE = "document_id string, page_no int, line_no int, text string, bbox struct<x0:double,y0:double,x1:double,y1:double>"


def test_findings_need_numbers_on_both_sides(spark):
    rows = [block("a", "利率为五"), block("b", "利率5%为主"), block("c", "①见表"), block("d", "同 上。"), block("t", "<table><tr><td>1.5</td><td>2</td><td>3</td></tr></table>", kind="table"), block("s", "<table><tr><td>7</td></tr></table>", kind="table")]
    blocks, _ = frames(spark, rows)
    refs = spark.createDataFrame([("a", "利率为5"), ("b", "利率6%为主"), ("c", "a见表"), ("d", "同上。"), ("t", "1.6 2 3"), ("s", "8")], "block_id string, reference string")
    got = {r.block_id: (r.numbers_differ, r.marks_differ) for r in audit.text_findings(blocks, refs).collect()}
    assert got == {"a": (False, False), "b": (True, False), "c": (False, True)}
    tables_ = audit.table_findings(blocks, refs).collect()
    assert [(r.block_id, r.missing, r.added) for r in tables_] == [("t", "1.6", "1.5")]  # one digit doesn't matter
    none = spark.createDataFrame([("d", False)], "document_id string, reliable boolean")
    assert audit.table_findings(blocks, refs, none).count() == 0


def test_completeness_fills_and_adds_blocks(spark):
    body = [block(f"b{k}", f"第{k}行的文字内容", (50.0, 100.0 + 20 * k, 900.0, 118.0 + 20 * k), order=k) for k in range(25)]
    rows = [*body, block("empty", "", (50.0, 700.0, 900.0, 760.0), order=30), block("pic", "", (50.0, 800.0, 900.0, 850.0), kind="image", order=31), block("tab", "<table><tr><td>1</td></tr></table>", (50.0, 900.0, 900.0, 1000.0), kind="table", order=32)]
    blocks, pages = frames(spark, rows)
    lines = [line(k, f"第{k}行的 文字内容", (60.0, 101.0 + 20 * k, 800.0, 117.0 + 20 * k)) for k in range(25)]
    lines += [line(40, "补上的", (60.0, 705.0, 500.0, 720.0)), line(41, "第二行", (60.0, 725.0, 500.0, 740.0)), line(42, "图中字", (60.0, 810.0, 500.0, 830.0)), line(43, "短标题", (60.0, 870.0, 300.0, 890.0)), line(44, "资料来源：某处", (60.0, 1001.0, 300.0, 1020.0)), line(45, "看不见", (60.0, 1200.0, 300.0, 1220.0))]
    words = spark.createDataFrame(lines, LINE)
    ink = spark.createDataFrame([("d", 1, 45, 0.001)], "document_id string, page_no int, line_no int, ink_ratio double")
    done = {r.block_id: r for r in audit.completed_blocks(blocks, words, pages, ink).collect()}
    new = [r for r in done.values() if r.source == "pdf_text_layer"]
    assert sorted((r.block_type, r.resolved_content, tuple(r.issue_flags)) for r in new if r.block_id != "empty") == [("footnote", "资料来源：某处", ("TXT-004", "TAB-008")), ("title", "短标题", ("TXT-004", "TAB-008"))]
    assert done["empty"].resolved_content == "补上的\n第二行" and done["empty"].status == "repaired" and done["empty"].issue_flags == ["TXT-004"]
    assert len(done) == len(rows) + 2 and all(done[f"b{k}"].resolved_content == f"第{k}行的文字内容" for k in range(25))
    few = {r.block_id: r for r in audit.completed_blocks(blocks, words.where("line_no < 3 or line_no = 40"), pages).collect()}  # too few lines to rely on
    assert few["empty"].resolved_content == "" and few["empty"].status == "review" and few["empty"].chunk_eligible is False


def test_crosscheck_and_recovery_of_tables(spark):
    one, two = "<table><tr><td>1</td></tr></table>", "<table><tr><td>2</td></tr></table>"
    rows = [block("same", one, kind="table", issue_flags=["TAB-010", "X"]), block("other", one, kind="table"), block("none", one, kind="table"), block("first", "", kind="table"), block("pic", "", kind="chart")]
    blocks, _ = frames(spark, rows)
    schema = "block_id string, result_id string, readable boolean, html string, text string"
    readings = spark.createDataFrame([("same", "1", True, one, ""), ("other", "2", True, two, ""), ("none", "3", True, "", ""), ("first", "4", True, two, ""), ("pic", "5", True, one, ""), ("pic", "6", True, one.replace("<td>", "<td >"), "")], schema)
    got = {r.block_id: (r.agreed, r.new_status, r.new_flags, r.tag) for r in audit.crosscheck_tables(blocks, readings).collect()}
    assert got["same"] == (True, "repaired", ["X"], "dual_source_agreed") and got["other"] == (False, "review", ["TAB-010"], "dual_source_conflict")
    assert got["none"] == (False, "review", [], "table_crosscheck_unavailable") and got["first"] == (False, "review", ["TAB-010"], "first_empty")
    assert [(r.block_id, r.agreed, r.new_flags) for r in audit.recovered_tables(blocks, readings).collect()] == [("pic", True, ["TAB-009"])]


def test_empty_tables(spark):
    blocks, pages = frames(spark, [])
    context = layout.table_context(blocks, pages)
    for df in (context, layout.templates(blocks, pages), layout.reading_order(blocks, pages), layout.section_paths(blocks, context), layout.carried_over(blocks, pages), tables.continuation_pairs(blocks, pages), chunks.build_chunks(blocks, context, layout.visual_captions(blocks, pages)), chunks.linear_units(blocks)):
        assert df.count() == 0


def test_nulls_everywhere_and_extra_columns(spark):
    kinds = spark.createDataFrame([], BLOCK).schema
    row = tuple("b" if f.name == "block_id" else None for f in kinds)
    schema = ty.StructType([ty.StructField(f.name, f.dataType, True) for f in kinds])
    df = spark.createDataFrame([row], schema).withColumn("content", F.lit("x")).withColumn("key", F.lit(1)).withColumn("h", F.lit(2)).withColumn("t", F.lit(3))
    blocks = layout.laid_out(df)
    pages = spark.createDataFrame([("d", 1, None, None)], "document_id string, page_no int, width double, height double")
    context = layout.table_context(blocks, pages)
    assert context.count() == 0 and layout.templates(blocks, pages).count() == 0 and chunks.linear_units(blocks).count() == 0
    assert chunks.build_chunks(blocks, context, layout.visual_captions(blocks, pages)).count() == 0
