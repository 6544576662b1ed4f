import random
import re
import unicodedata
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from foliant.llm import codepoints, leakage, markup, near_duplicates, packing, repeated_lines, residue, scan_noise, splitting, truncation, visual_form

# 6: visual form


@settings(max_examples=60, deadline=None)
@given(st.lists(st.one_of(st.none(), st.text(st.characters(exclude_categories=["Cs"]), max_size=12)), max_size=6))
def test_code_points_round_trip(rows):
    column = pa.array(rows, pa.string())
    points, starts = codepoints.explode(column)
    back = codepoints.implode(points, starts, np.asarray(column.is_null()) if rows else None).to_pylist()
    assert back == rows
    assert [len(r or "") for r in rows] == np.diff(starts).tolist()


def canonical(*rows):
    points, starts, found = visual_form.canonical_points(*codepoints.explode(pa.array(rows, pa.string())))
    return codepoints.implode(points, starts).to_pylist(), (found > 0).tolist()


def test_visual_forms():
    odd = ["Ｂａｎｋ ２", "cafe" + chr(0x301), "a" + chr(0x302) + chr(0x301), "ad" + chr(0x200B) + "d", "a" + chr(0x2009) + "b", chr(0xFB03) + "x", "b" + chr(0x430) + "nk", chr(0x2FA6) + "融", chr(0xF900)]
    assert canonical(*odd) == (["Bank 2", "café", "ấ", "add", "a b", "ffix", "bank", "金融", unicodedata.normalize("NFKC", chr(0xF900))], [True] * 9)
    usual = ["正常，文字（ok）：50%…", "café Zürnau", "Москва Банк", "β-test σ", "a\tb\nc", "", "©·—", chr(0x301) + "x"]
    forms, found = canonical(*usual)
    assert forms == usual and not any(found)


def test_visual_form_matches_normalisation_of_single_marks():
    pairs = [(a, b) for a in "aeiouncAEOU" for b in map(chr, (0x300, 0x301, 0x302, 0x303, 0x308, 0x327))]
    assert canonical(*(a + b for a, b in pairs))[0] == [unicodedata.normalize("NFC", a + b) for a, b in pairs]


def test_visual_form_in_spark(spark):
    df = spark.createDataFrame([("a", "Ｘ", None), ("a", "Ｘ", None), ("b", "", "x" * 200_000 + chr(0x200B)), (None, None, None)], "block_id string, raw_content string, resolved_content string").withColumn("field_name", F.lit("clash"))
    got = visual_form.values_with_odd_characters(df, "block_id", ("raw_content", "resolved_content"))
    assert sorted(map(tuple, got.collect())) == [("a", "raw_content"), ("b", "resolved_content")]
    assert visual_form.canonical_texts(df, ("block_id",), ("raw_content",)).where("raw_content = 'X'").count() == 2
    assert visual_form.values_with_odd_characters(df.limit(0), "block_id", ("raw_content",)).count() == 0
    looks = spark.createDataFrame([("a", "Ｘ"), ("b", "X"), ("c", "X")], "block_id string, raw_content string")
    assert [(r.n_records, r.n_variants) for r in visual_form.equal_looking_groups(looks, "block_id", "raw_content").collect()] == [(3, 2)]


# 5: repeated lines


def lined(spark, rows):
    return spark.createDataFrame(rows, "block_id string, document_id string, page_no int, reading_order int, raw_content string")


def test_repeated_lines_against_brute_force(spark):
    rng = random.Random(2)
    rows = []
    for k in range(160):
        doc = "big" if k % 3 else f"d{k % 4}"
        rows.append((f"b{k}", doc, rng.randint(1, 9), k, "\n".join(rng.choice(["Page 12", "page  7", "Notice", "", f"text {chr(97 + k % 26)} {k}", "共 同"]) for _ in range(3))))
    rows += rows[:9] + [("n", None, 1, 1, "x"), ("m", "d1", None, 1, "Notice"), ("z", "d1", 1, 1, None)]
    key = lambda s: re.sub(r"\d+", "#", "".join(s.lower().split()))
    pages, support = defaultdict(set), defaultdict(set)
    for b, d, p, _, t in rows:
        if d is not None and p is not None:
            pages[d].add(p)
            for line in (t or "").split("\n"):
                if key(line):
                    support[d, key(line)].add(p)
    want = {(b, n) for b, d, p, _, t in rows if d is not None and p is not None for n, line in enumerate((t or "").split("\n"), 1) if key(line) and len(support[d, key(line)]) >= 3 and len(support[d, key(line)]) >= 0.25 * len(pages[d])}
    df = lined(spark, rows)
    assert {tuple(r) for r in repeated_lines.repeated_lines(df).collect()} == want
    clean = {r.block_id: r.clean_content for r in repeated_lines.without_repeated_lines(df).collect()}
    for b, d, p, _, t in rows:
        assert clean[b] == (None if t is None else "\n".join(line for n, line in enumerate(t.split("\n"), 1) if (b, n) not in want))
    assert repeated_lines.repeated_lines(df.limit(0)).count() == 0


def test_sequences_against_brute_force(spark):
    rows = [(f"b{p}{k}", "d", p, k, t) for p in range(1, 6) for k, t in enumerate(["H", f"own {chr(96 + p)}", "F" if p != 2 else f"x{chr(96 + p)}", "G"])]
    got = Counter((len(r["items"]), r.support) for r in repeated_lines.frequent_sequences(lined(spark, rows)).collect())
    assert got == Counter({(1, 5): 2, (1, 4): 1, (2, 5): 1, (2, 4): 2, (3, 4): 1})


def test_sequences_of_every_length(spark):
    rows = [(f"b{p}{k}", "d", p, k, t) for p in range(1, 5) for k, t in enumerate(["A", "B", f"own {chr(96 + p)}", "C", "D", "E"])]
    got = Counter((len(r["items"]), r.support) for r in repeated_lines.frequent_sequences(lined(spark, rows)).collect())
    assert got == Counter({(1, 4): 5, (2, 4): 10, (3, 4): 10, (4, 4): 5, (5, 4): 1})


# 7: splitting


def check_pieces(text, pieces, size, overlap):
    assert pieces[0][0] == 0 and pieces[-1][1] == len(text)
    for (a, b, t), (c, _, _) in zip(pieces, pieces[1:]):
        assert c == b - overlap or (c == 0 and b <= overlap)
    for a, b, t in pieces:
        assert t == text[a:b] and len(t) <= size


def test_pieces_round_trip(spark):
    rng = random.Random(4)
    texts = {f"t{k}": "".join(rng.choice(["word ", "句子。", "\n\n", "x" * 40, "，", "𠮷", "e" + chr(0x301)]) for _ in range(n)) for k, n in enumerate([5, 60, 400, 2500])}
    texts["solid"], texts["exact"] = "y" * 5000, "z" * 100
    df = spark.createDataFrame([*texts.items(), ("t1", texts["t1"]), ("null", None), ("empty", "")], "id string, body string").withColumn("item", F.lit(1))
    got = defaultdict(list)
    for r in splitting.split_items(df, "id", "body", 100, 10, range_length=512).collect():
        got[r.id].append((r.piece_no, r.start_char, r.end_char, r.piece))
    assert set(got) == set(texts)
    for name, text in texts.items():
        rows = sorted(got[name])
        assert [r[0] for r in rows] == list(range(len(rows)))
        check_pieces(text, [r[1:] for r in rows], 100, 10)
    assert len(got["exact"]) == 1
    assert {r.id for r in splitting.oversized(df, "id", "body", 100, 10).collect()} == {k for k, v in texts.items() if len(v) > 100}


def test_cuts_prefer_natural_boundaries():
    text = ("a" * 50 + ". ") * 40
    pieces = splitting.range_pieces(text, 0, len(text), True, True, 300, 20)
    assert all(text[:end].endswith(". ") for _, _, end in pieces)


def test_files_are_cut_by_byte_ranges(spark, tmp_path):
    text = "".join(f"第{k}句话，内容。\n" for k in range(4000))
    (tmp_path / "big.txt").write_text(text, encoding="utf-8")
    (tmp_path / "none.txt").write_text("")
    paths = [f"{tmp_path}/big.txt", f"{tmp_path}/none.txt"]
    assert splitting.boundary_table(splitting.file_ranges(spark, paths, 4096), 4096, 120, 12).count() > 6
    rows = splitting.split_files(spark, paths, 120, 12, range_bytes=4096).orderBy("piece_no").collect()
    assert {r.path.rsplit("/", 1)[1] for r in rows} == {"big.txt"} and [r.piece_no for r in rows] == list(range(len(rows)))
    check_pieces(text, [(r.start_char, r.end_char, r.piece) for r in rows], 120, 12)


def test_prefix_sums_over_many_ranges(spark, monkeypatch):
    monkeypatch.setattr(splitting, "GROUP", 3)
    rows = [(item, r, (r * 7) % 5) for item in "ab" for r in range(20)]
    got = {(r.item, r.range_no): r.before_n for r in splitting.offsets_of(spark.createDataFrame(rows, "item string, range_no long, n long"), "item", ["n"]).collect()}
    assert got == {(item, r): sum((k * 7) % 5 for k in range(r)) for item in "ab" for r in range(20)}


# 10: residue


def _kinds(spark, texts):
    """The kinds of the residue messages of each text, alone in its table's source."""
    df = spark.createDataFrame([(k, "s", t) for k, t in enumerate(texts)], "doc_id long, source string, text string")
    out = [set() for _ in texts]
    for r in residue.notices(df).select("doc_id", "kind").unionByName(residue.syntax_residue(df)).collect():
        out[r.doc_id].add(r.kind)
    return out


def test_residue_rules(spark):
    residues = ["Dear {{client_name}}, hello", "合计：${金额}。", "<%= report.total %>", "{% if x %}a{% endif %}", "请联系<<经办人>>。", "%BRANCH_NAME% filed", "rate [INSERT FIGURE] on", "为【此处填写数值】。", "于XXXX年XX月", "TBD: add text", "Lorem ipsum dolor", "此处为示例文字，请替换为正式内容。", "404 页面不存在", "Access denied. Sign in.", "Real text. More text.\nLoading... please wait", "正在加载……若长时间无响应，请在浏览器中允许脚本运行。", "Title\nnull\nN/A\nNaN", "Traceback (most recent call last):\n  File \"a.py\", line 3\nKeyError: 'x'"]
    df = spark.createDataFrame([(k, "s", t) for k, t in enumerate(residues)], "doc_id long, source string, text string")
    assert sorted(set(range(len(residues))) - {r.doc_id for r in residue.residue_documents(df).collect()}) == []
    prose = ["Access was denied to 37 late bidders.", "XX Corps, a uniform supplier, repaid its loan.", "The set {a, b, c} of weights stays.", "The item is to be determined by the board.", "12家投标人被拒绝访问系统。", "Error rates fell, and pages not found in the archive were scanned again.", "招聘了JavaScript工程师。", "", None, "See note 404 and 5,003.6 crowns.", "…", "growth of 5%与6%的差", "rose 2.5%，部分，3%左右", "_x_", "per cent (XX century)"]
    df = spark.createDataFrame([(k, "s", t) for k, t in enumerate(prose)], "doc_id long, source string, text string")
    assert residue.residue_documents(df).collect() == []


def test_every_rule_alternative_matches(spark):
    placeholders = ["{{ a }}", "{% a %}", "${a}", "<%= a %>", "<< a >>", "@@ab@@", "%AB_C%", "[YOUR NAME]", "[insert name]", "【请填写】", "______", "XX年XX月", "××年×月", "xX年x月", "XXXX", "rose by XX.X million", "as at XX/XX/20XX", "（待补）", "[待定]", "TBD:", "TODO :", "FIXME: text", "lorem ipsum", "%机构名称%", "__PERIOD_END__", "@@页脚@@"]
    fillers = ["Sample text goes here", "your text here", "text goes here", "replace this sentence", "Dummy TEXT", "此处为示例文本", "请替换为正式内容", "此处输入文字", "占位符", "LOREM İPSUM"]
    notices = ["Page not\tfound", "# not found", "HTTP 502 Bad Gateway", "Access denied.", "You don't have permission", "Session expired", "Your session has timed out", "Internal error", "Service temporarily unavailable", "The report viewer is down", "An unexpected error occurred", "Something went wrong", "Please turn on scripts", "If nothing happens, allow cookies", "Enable JavaScript", "Enable JavaſcrIpt", "Your browser does not run", "JavaScript is disabled", "This page needs cookies", "Loading…", "Please wait while", "Request 17 was blocked", "Traceback (most recent call", "a.KeyError: x", 'File "a.py", line 3', "The filing you asked", "该页无法访问", "页面无法访问", "禁止访问", "对不起，未找到", "抱歉，您无法", "您无权访问", "没有权限", "登录已过期", "访问被拒绝", "系统繁忙", "服务器内部异常", "服务暂不可用", "请先开启脚本", "请在浏览器中允许脚本", "您的浏览器未启用", "正在加载…", "加载失败", "正在加载", "请稍候", "请稍等", "您访问的", "Error while loading report 7: upstream timed out."]
    phrases = ["try again later", "go back to the", "may have been moved", "请稍后再试", "稍后重试", "刷新页面", "返回列表", "重新登录", "已被移除", "is not on this server", "did not answer in time", "down for maintenance", "is being updated", "敬请期待", "Coming soon", "under  construction"]
    assert [t for t, k in zip(placeholders, _kinds(spark, placeholders)) if not k & {"placeholder", "filler"}] == []
    assert [t for t, k in zip(fillers, _kinds(spark, fillers)) if k != {"filler"}] == []
    assert [t for t, k in zip(notices, _kinds(spark, notices)) if k != {"notice"}] == []
    again = [f"{t} {k}" for t in phrases for k in range(3)]
    df = spark.createDataFrame([(k, f"s{k % 3}", t) for k, t in enumerate(again)], "doc_id long, source string, text string")
    assert {r.doc_id for r in residue.notices(df).where("recurring").collect()} == set(range(len(again)))


def test_long_messages_are_read_whole(spark):
    menu = " | Home | Loans | Contact" * 40
    assert _kinds(spark, ["Page not found" + menu, "Page not found " + "a1" * 100_000, "Menu" + menu + " {{name}}"]) == [{"notice"}, {"notice"}, {"placeholder"}]
    masked = spark.createDataFrame([("x 12ab.c+d@e.f-g.org,\ty  2024-01-02",)], "t string").select(residue.masked(residue.lined(F.col("t")))).first()[0]
    assert masked == "x #, y #"


def test_phrases_need_recurrence_at_the_end_of_texts(spark):
    prose = "Long prose about lending. " * 30
    end = [(k, f"s{k % 2}", prose + f"Do come back and try again later {k}.") for k in range(5)]
    inside = [(k, f"s{k % 2}", prose + f"The committee asked lenders to try again later {k}. " + prose) for k in range(10, 15)]
    once = [(20, "s0", prose + "The bank was told to try again later on."), (9, None, None), (21, "s", "")]
    df = spark.createDataFrame([*end, *inside, *once], "doc_id long, source string, text string").withColumn("message", F.lit("clash")).withColumn("kind", F.lit(1))
    assert {r.doc_id for r in residue.residue_documents(df).collect()} == {0, 1, 2, 3, 4}
    groups = {r.message: r for r in residue.message_groups(df).collect()}
    assert groups["Do come back and try again later #."].residue and not groups["The committee asked lenders to try again later #."].residue
    assert groups["Long prose about lending."].kind is None and groups["Long prose about lending."].n_docs == 11
    assert residue.residue_documents(df.where("doc_id in (9, 21)")).count() == 0
    assert residue.clean_corpus(df).count() == 8 and residue.residue_documents(df.limit(0)).count() == 0


# 3: markup


def test_dialects():
    marked = {"<p>x</p>": "html", "a &amp; b": "html", "x<br/>y": "html", "\\section{A} b": "latex", "$E/N \\geq 4$": "latex", "E_{t} = 3": "latex", "5\\% more": "latex", "== A ==": "wiki", "'''b'''": "wiki", "[[a|b]]": "wiki", "{{cite x|y=1}}": "wiki", "**b** c": "markdown", "## H": "markdown", "a\n\n| a | b |\n|---|---|\n| 1 | 2 |": "markdown", "> quoted": "markdown", "[t](https://x.example/1)": "markdown", "```\ncode\n```": "markdown"}
    assert {t: markup.dialects(t) for t in marked if marked[t] not in markup.dialects(t)} == {}
    plain = ["2 < 30且63 > 29", "PDX >= 4.5%", "CAR = (PDX + 71) / LCR", "code FEN_26_Q2 marks 4 * 2 cases", "代码HOL_55对应7 * 8笔", "A & B Ltd", "(1) item\n(2) item", "it's 5 o'clock", "", "[25]", "a | b 2017", "cost $5 and $6", "LGZ = ROE / NSF x 82"]
    assert [t for t in plain if markup.dialects(t)] == []


def test_clean_text():
    clean = lambda t: markup.clean_text(t, markup.dialects(t))
    assert clean("<h2>Title</h2><p>a&nbsp;b</p><ul><li>x</li><li>y</li></ul>") == "## Title\n\na b\n\n- x\n- y"
    assert clean("<table><tr><th>A</th><th>B</th></tr><tr><td>1</td><td></td></tr></table>") == "A | B\n1 |"
    assert clean("\\section{A}\ntext 5\\% \\textbf{b} \\cite{r}. $x^{2}$") == "# A\n\ntext 5% b. $x^{2}$"
    assert clean("== A ==\n'''b''' [[c|d]]\n* e") == "## A\nb d\n- e"
    assert clean("**b** _i_ [t](https://x.example/a) `k`\n\n```\nx = 1\n```") == "b i t `k`\n\n```\nx = 1\n```"
    assert clean("| a | b |\n|---|---|\n| 1 | 2 |") == "a | b\n1 | 2"
    assert clean("\\[ C = \\sqrt{R^2} \\]") == "\\[ C = \\sqrt{R^2} \\]" and clean("plain") == "plain"


def test_host_paths_drop_link_containers(spark):
    page = '<div class="nav"><a href="#">home</a> <a href="#">more links here</a></div><div class="body7"><p>{}</p></div>'
    blocks = spark.createDataFrame([(f"b{k}", "h", page.format("real text " * 9)) for k in range(4)] + [("n", None, None), ("e", "h", ""), ("b0", "h", page.format("real text " * 9))], "block_id string, source string, raw_content string")
    vlm = spark.createDataFrame([("r", "table", "plain 3.5", "$x_{1}$"), ("q", None, None, "")], "result_id string, task string, html string, latex string")
    got = {(r.record_id, r.field_name): r for r in markup.extracted(blocks, vlm).dropDuplicates(["record_id", "field_name"]).collect()}
    assert got["b1", "raw_content"].clean == ("real text " * 9).strip()
    assert {(r.record_kind, r.record_id, r.field_name) for r in markup.values_with_markup(blocks, vlm).collect()} == {("block", f"b{k}", "raw_content") for k in range(4)} | {("vlm", "r", "latex")}
    assert markup.values_with_markup(blocks.limit(0), vlm.limit(0)).count() == 0


# 2: near duplicates


def near(spark, texts):
    df = spark.createDataFrame([*texts.items()], "block_id string, resolved_content string").withColumn("block_type", F.lit("text")).withColumn("norm", F.lit("clash"))
    return near_duplicates.records(df, "block", "block_id", "resolved_content")


def brute_pairs(texts):
    kept = {k: " ".join(v.lower().split()) for k, v in texts.items() if v is not None and len(v) >= 200}
    ids = sorted(kept)
    return {("block", a, b) for i, a in enumerate(ids) for b in ids[i + 1 :] if near_duplicates.jaccard(kept[a], kept[b]) >= 0.7}


def test_near_duplicates_against_brute_force(spark):
    rng = random.Random(8)
    words = ["".join(rng.choice("abcdefghij") for _ in range(6)) for _ in range(400)]
    texts = {}
    for f in range(40):
        base = [rng.choice(words) for _ in range(45)]
        for m in range(rng.randint(1, 5)):
            edit = list(base)
            for _ in range(m):
                edit[rng.randrange(len(edit))] = rng.choice(words)
            texts[f"{f}-{m}"] = (" " if m % 2 else "\n").join(edit).upper() if m == 3 else " ".join(edit)
        texts[f"{f}-copy"] = "  ".join(base)
    texts |= {"short": "abc", "null": None, "blank": " " * 300}
    got = near_duplicates.similar_pairs(near(spark, texts)).collect()
    assert {tuple(r) for r in got} == brute_pairs(texts) and len(got) == len({tuple(r) for r in got})
    groups = {r.id: r.group_id for r in near_duplicates.groups(near(spark, texts)).collect()}
    for _, a, b in brute_pairs(texts):
        assert groups[a] == groups[b]
    assert near_duplicates.similar_pairs(near(spark, {"a": "x"})).count() == 0


def test_large_groups_of_copies_stay_linear(spark):
    rng = random.Random(1)
    text = " ".join("".join(rng.choice("abcdef") for _ in range(5)) for _ in range(50))
    n = near_duplicates.FULL + 40
    texts = {f"c{k:03}": text for k in range(n)} | {"d": text[:-6] + " zzzzz"}
    got = {(r.id_a, r.id_b) for r in near_duplicates.similar_pairs(near(spark, texts)).collect()}
    assert got == {("c000", f"c{k:03}") for k in range(1, n)} | {("c000", "d")}
    assert len({r.group_id for r in near_duplicates.groups(near(spark, texts)).collect()}) == 1


def test_many_different_near_texts(spark):
    rng = random.Random(6)
    base = ["".join(rng.choice("abcdefgh") for _ in range(6)) for _ in range(60)]
    texts = {}
    for k in range(40):
        edit = list(base)
        edit[k] = f"x{k:05}"
        texts[f"t{k:02}"] = " ".join(edit)
    assert {tuple(r) for r in near_duplicates.similar_pairs(near(spark, texts)).collect()} == brute_pairs(texts)


def boilerplate(n, short=8):
    """Texts that share their common part only: under 0.7 to each other, but for the few that have less of their own."""
    rng = random.Random(12)
    word = lambda: "".join(rng.choice("abcdefghijklmnop") for _ in range(6))
    common = [word() for _ in range(52)]
    return {f"t{k:03}": " ".join(common + [word() for _ in range(10 if k < short else 14)]) for k in range(n)}


def test_boilerplate_groups_against_brute_force(spark):
    texts = boilerplate(120)
    want = brute_pairs(texts)
    assert len(want) == 28
    assert {tuple(r) for r in near_duplicates.similar_pairs(near(spark, texts)).collect()} == want


def test_buckets_of_several_blocks_join_all_pairs(spark):
    texts = near(spark, boilerplate(90))
    whole = {(r.a, r.b) for r in near_duplicates.candidate_edges(texts).collect()}
    rows = sorted((r["class"], r.norm) for r in texts.collect())
    sig = near_duplicates.signatures(*codepoints.explode(pa.array([t for _, t in rows])))
    bands, sketch = near_duplicates.band_hashes(sig), near_duplicates.sketches(sig)
    agree = lambda i, j: int(np.bitwise_count(~(sketch[i] ^ sketch[j]))) >= near_duplicates.SKETCH_LEAST
    want = {(rows[i][0], rows[j][0]) for j in range(len(rows)) for i in range(j) if (bands[i] == bands[j]).any() and agree(i, j)}
    assert len(want) > 1000 and whole == want and {tuple(r) for r in near_duplicates.candidate_edges(texts, 7).collect()} == want
    rng = np.random.default_rng(3)
    rows = sorted({(int(b), int(c)) for b, c in zip(rng.integers(0, 9, 700), rng.integers(0, 99, 700))})
    rows = [r for r in rows for _ in range(1 + r[1] % 2)]
    columns = lambda part: {"run": [r[0] for r in part], "bucket": [r[0] for r in part], "salt": [0] * len(part), "salts": [1] * len(part), "class": [r[1] for r in part], "sketch": [0] * len(part)}
    batches = [pa.RecordBatch.from_pydict({n: pa.array(v, pa.int64()) for n, v in columns(rows[k : k + 13]).items()}) for k in range(0, len(rows), 13)]
    out = [r for batch in near_duplicates._bucket_worker(batches, 10) for r in zip(*(batch.column(c).to_pylist() for c in ("a", "b", "block")))]
    members = defaultdict(list)
    for b, c in sorted(set(rows)):
        members[b].append(c)
    assert Counter((a, b) for a, b, n in out if n < 0) == Counter((c[i], c[j]) for c in members.values() for j in range(len(c)) for i in range(j // 10 * 10, j))
    assert sorted((a, b, n) for a, b, n in out if n >= 0) == sorted((b, x, k // 10) for b, c in members.items() if len(c) > 10 for k, x in enumerate(c))
    assert near_duplicates.hot_buckets(texts, block=16, planned=1).count() > 0
    assert {(r.a, r.b) for r in near_duplicates.candidate_edges(texts, block=16, planned=1).collect()} == whole  # hot buckets cut into salted runs


def test_group_rows_give_classes_and_heads(spark):
    rng = random.Random(3)
    text = " ".join("".join(rng.choice("abcdef") for _ in range(5)) for _ in range(50))
    rows = {r.id: r for r in near_duplicates.groups(near(spark, {"a": text, "b": text, "c": text[:-6] + " zzzzz", "d": text[::-1]})).collect()}
    assert rows["a"]["class"] == rows["b"]["class"] != rows["c"]["class"] and rows["b"].head == "a" and rows["c"].head == "c"
    assert rows["a"].n_links == rows["b"].n_links == rows["c"].n_links == 1 and rows["d"].n_links == 0


def test_densified_signatures_keep_similarity():
    rng = np.random.default_rng(0)
    a = "".join(map(chr, rng.integers(97, 123, 600)))
    b = a[:500] + "".join(map(chr, rng.integers(97, 123, 100)))
    sig = near_duplicates.signatures(*codepoints.explode(pa.array([a, b, a])))
    assert (sig[0] == sig[2]).all() and abs((sig[0] == sig[1]).mean() - near_duplicates.jaccard(a, b)) < 0.12
    assert (near_duplicates.signatures(*codepoints.explode(pa.array(["abc", ""]))) == near_duplicates.EMPTY).all()


# 9: leakage


def test_leakage(spark):
    rng = random.Random(9)
    words = ["".join(rng.choice("abcdefghijk") for _ in range(5)) for _ in range(900)]
    han = [chr(0x4E00 + k) for k in range(900)]
    evidence = {"Q1": rng.sample(words, 40), "Q2": rng.sample(han, 60)}
    questions = spark.createDataFrame([("Q1", "What rate held in Orba, and when?", "It was 1,797.4 crowns in 2019.", " ".join(evidence["Q1"])), ("Q2", "q", None, "".join(evidence["Q2"])), ("Q3", None, "", None)], "id string, question string, expected_answer string, answer_evidence string")
    filler = lambda: " ".join(rng.choice(words) for _ in range(50))
    half = evidence["Q1"][:24]
    swapped = [w if k % 9 else "zzzzz" for k, w in enumerate(evidence["Q1"])]
    docs = [
        (1, filler() + "\n" + " ".join(evidence["Q1"]).upper() + "\n" + filler()), (2, filler() + " ".join(half) + filler()), (3, " ".join(evidence["Q1"][:12]) + filler()), (4, filler() + ",\n".join(swapped)),
        (5, "前" + "，".join(evidence["Q2"]) + "后"), (6, "".join(evidence["Q2"][:20])), (7, "what rate held in orba and when it was 1797.4 crowns in 2019"), (8, "What rate held in Orba, and when?"), (9, None), (10, ""), (11, " ".join(rng.sample(evidence["Q1"], 40))), (12, filler() + " ".join(evidence["Q1"]).upper()),
    ]
    df = spark.createDataFrame(docs, "doc_id long, text string").withColumn("item", F.lit("clash"))
    got = {tuple(r) for r in leakage.leaked(spark, df, questions).collect()}
    assert got == {(1, "Q1"), (2, "Q1"), (4, "Q1"), (5, "Q2"), (7, "Q1"), (12, "Q1")}
    exact = {(r.doc_id, r.question_id) for r in leakage.passage_matches(spark, df, questions).where("exact_phrase and part = 'evidence'").collect()}
    assert exact == {(1, "Q1"), (5, "Q2")}  # in 12 a word is glued to the first
    before = leakage.BLOCK_TOKENS
    leakage.BLOCK_TOKENS = 8  # several blocks of items give the same
    assert {tuple(r) for r in leakage.leaked(spark, df, questions).collect()} == got
    leakage.BLOCK_TOKENS = before
    assert leakage.leaked(spark, df, questions.limit(0)).count() == 0 and leakage.leaked(spark, df.limit(0), questions).count() == 0


# 8: packing


def test_packing(spark):
    rng = random.Random(3)
    rows = [(k, "word " * rng.choice([1, 3, 30, 200, rng.randint(1, 900)])) for k in range(400)] + [(400, None), (401, ""), (402, "long text " * 1200)]
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumn("class", F.lit("clash"))
    got = packing.pack(df, capacity=1000, rows_per_salt=50).collect()
    used, seen = defaultdict(int), defaultdict(set)
    for r in sorted(got, key=lambda r: (r.container_id, r.position)):
        assert r.start_token == used[r.container_id]
        used[r.container_id] += r.n_tokens
        seen[r.doc_id].add(r.piece_no)
    assert max(used.values()) <= 1000 and set(seen) == set(range(403)) and len(used) == max(used) + 1
    assert all(len(p) == 1 for d, p in seen.items() if d != 402) and len(seen[402]) == 3
    assert len({(r.container_id, r.position) for r in got}) == len(got)
    assert sum(used.values()) / (1000 * len(used)) > 0.96
    assert packing.pack(df.limit(0)).count() == 0


@settings(max_examples=40, deadline=None)
@given(st.dictionaries(st.integers(1, 500), st.integers(1, 60), max_size=25))
def test_plans_place_every_length(histogram):
    bounds = packing.class_bounds(500)
    groups = packing.plan(histogram, 500)
    placed = Counter()
    for content, n in groups:
        assert sum(int(bounds[c]) * k for c, k in content) <= 500
        for c, k in content:
            placed[c] += k * n
    want = Counter()
    for length, n in histogram.items():
        want[int(np.searchsorted(bounds, length))] += n
    assert placed == want


# 4: truncation


def test_endings():
    cut = {"text": ["A full sentence here, and then the next one sto", "整句话。下一句没有说完的个", "A sentence that ends, with dots…", "A sentence, that ends with H...", "一句话，没有说�", "Rates rose by 5%, of which 2.4%"], "table": ["<table><tr><td>1</td><td"]}
    whole = {"text": ["A sentence.", "一句话。", "The terms, as listed below:", "如下：", "(1) item, one\n(2) item, two", "Bank Trust\n5 Some Street\nTown", "Quen Trust | Outlook for Jun", "Annual Review 2016", "Text ends.\nConfidential draft 9 - not for onward transfer", "x, y.</p>", "", None, "```\nratio = 1\n```", "Ends with a quote.”"], "table": ["<table><tr><td>1</td></tr></table>", "", "| a | b |"]}
    assert [t for k, v in cut.items() for t in v if not truncation.ending(t, k)] == []
    assert [t for k, v in whole.items() for t in v if truncation.ending(t, k)] == []


def test_lengths_under_encodings():
    rows = ["a<&>\"'", "é中𠮷\n", "\t\\", ""]
    import json

    table = truncation.length_table(*codepoints.explode(pa.array(rows)))
    for k, t in enumerate(rows):
        escaped = len(t) + sum({"&": 4, "<": 3, ">": 3, '"': 5, "'": 4}.get(c, 0) for c in t)
        assert table[:, k].tolist() == [len(t), len(t.encode()), len(t.encode("utf-16-le")), escaped, len(json.dumps(t, ensure_ascii=False)) - 2, len(json.dumps(t)) - 2, len(t.replace("\n", "\r\n"))]


def test_cut_values_limits_and_pages(spark):
    rows, long = [], "Growth slowed in winter, as the bank said, and "
    for k in range(40):
        rows.append((f"c{k}", "d", 100 + 2 * k, 1, "text", "limited", (long * 9)[:255], None))
        rows.append((f"w{k}", "d", 100 + 2 * k, 0, "text", "free", f"Lending rose in spring {k}, as the board of the bank said at its meeting.", f"Whole {k}."))
    rows += [("a", "e", 1, 0, "text", "free", "The bank, which grew,", ""), ("b", "e", 2, 0, "text", "free", "reported a gain, as said.", None), ("x", "e", 3, 0, "text", "free", "The bank, which grew,", "Fine."), ("y", "e", 4, 0, "text", "free", "Lending rose in spring 1, as the board of the bank said at its meeting.", None), ("t", "e", 5, 0, "table", None, "<table><tr><td>1", "<table></table>"), ("n", None, None, None, None, None, None, None)]
    df = spark.createDataFrame([*rows, rows[0]], "block_id string, document_id string, page_no int, reading_order int, block_type string, source string, raw_content string, resolved_content string").withColumn("kind", F.lit("clash"))
    got = {(r.block_id, r.field_name) for r in truncation.cut_values(df).collect()}
    assert got == {(f"c{k}", "raw_content") for k in range(40)} | {("x", "raw_content"), ("t", "raw_content")}
    assert {(r.source, r.length) for r in truncation.hidden_limits(df).where("encoding = 'chars'").collect()} == {("limited", 255)}
    rates = {(r.source, r.field_name): (r.n_values, r.n_cut) for r in truncation.source_rates(df).collect()}
    assert rates["limited", "raw_content"] == (40, 40) and rates["", "raw_content"] == (1, 1)
    assert truncation.cut_values(df.limit(0)).count() == 0


def test_sentence_starts_count_every_block(spark):
    text = "Rates rose in spring. Zorp stayed calm as the bank said, which helped. " + "More of the same was said, and so on. " * 80
    rows = [(f"b{k}", "text", text if k < 3 else f"Filler {k} rose in spring, as the board of the bank said at its meeting.") for k in range(5000)]
    rows += [("short", "text", "Zorp stays calm"), ("cut", "text", "The bank, which gre"), ("table", "table", "Zorp is here."), ("null", "text", None)]
    df = spark.createDataFrame(rows, "block_id string, block_type string, raw_content string")
    asked = spark.createDataFrame([(False, "Zorp"), (False, "Filler"), (False, "None"), (True, "helped"), (True, "gre"), (True, "bank"), (True, "bank")], "word boolean, key string")
    got = {(r.word, r.key): (r.opening, r.inside) for r in truncation.sentence_starts(df, asked).collect()}
    assert {k: got.pop((False, k)) for k in truncation.TOTALS.values()} == {"\x00ascii": (4 + 4997 + 3 + 3 * 80 + 1, 0), "\x00other": (0, 0)}
    assert got == {(False, "Zorp"): (4, 0), (False, "Filler"): (4997, 0), (True, "helped"): (3, 0), (True, "bank"): (3 + 4997 + 1, 0)}
    assert truncation.new_sentence("Zorp went", "which gre", 4, 0, False) and not truncation.new_sentence("Zorp went", "which gre", 4, 5, False)
    assert truncation.new_sentence("Zorp went", "which gre", 1, 0, False) and not truncation.new_sentence("Zorp went", "which gre", 1, 0, True)  # its own beginning alone tells nothing
    assert truncation.new_sentence("浔陂银", "以及", 2, 9, False, 50.0) and not truncation.new_sentence("月调查", "，与2", 1, 9, False, 50.0)
    assert truncation.new_sentence("沅泽农商行", "a change of", 1, 15, True, 50.0)  # another script


# 1: scan noise


def scanned(spark, rows):
    return spark.createDataFrame(rows, "block_id string, block_type string, raw_content string, resolved_content string")


def test_scan_noise(spark):
    rng = random.Random(5)
    vocabulary = "the bank lending crowns billion million sector report quarter margin deposit holders standing segment business issuers against reserve balance growth figures moved under terms agreed".split()
    prose = lambda n: " ".join(rng.choice(vocabulary) for _ in range(n)).capitalize() + f", {rng.randint(1, 99)} per cent in 2019."
    clean = [(f"c{k}", "text", prose(40), "") for k in range(150)]
    zh = [(f"z{k}", "text", f"据表{k}列示，机构达到{k}.5亿元，银行的余额上升。", "") for k in range(60)]

    def wrap(text, width, mark, furniture):
        lines = [text[i : i + width] for i in range(0, len(text), width)]
        lines = [x + mark for x in lines[:-1]] + lines[-1:]
        return "\n".join([*lines[:2], furniture, *lines[2:]] if furniture else lines)

    body = prose(60)
    noisy = [
        ("hyphen", "text", "\n".join(x + (" " if k % 2 else "") for k, x in enumerate(re.findall(r".{1,48}(?:\s|$)", prose(60)))), ""), ("page", "text", wrap("银行的贷款余额上升，" * 12 + "机构达到五亿元。", 22, "-", "- 7 -"), ""), ("misread", "text", "The bank moved under terrns agreed aga!nst the reserve ba1ance.", ""), ("spaced", "text", "The bank moved under t e r m s a g r e e d in 2019, as said.", ""),
        ("joined", "footnote", "The bank movedunder termsagreed in the segmentbusiness of 2019.", ""), ("zh", "text", "据表3列示，机构达到2.5忆元，银行旳余额上升。", ""),
    ]
    fine = [
        ("list", "text", "The sample covers:\n(1) margin, one\n(2) deposit, two\n(3) reserve, three", ""), ("address", "text", "Bank Trust\n7 Some Street\nTown", ""), ("notice", "text", "Prepared by the lending desk\n" + body, ""), ("code", "text", "The code A9O-27l and long-term, risk-weighted views differ.", ""), ("markup", "text", "## Title\n\n" + body + "\n\n- a: 1\n- b: 2", ""),
        ("title", "title", "b a n k i n g  l e t t e r s", ""), ("null", "text", None, None), ("empty", "text", "", ""), ("two", "text", body + "\n\n" + prose(30), ""),
    ]
    df = scanned(spark, clean + zh + noisy + fine + noisy[:2]).withColumn("kinds", F.lit("clash"))
    got = {r.block_id: r.kinds for r in scan_noise.damaged_blocks(df).collect()}
    assert set(got) == {r[0] for r in noisy}, got
    assert "furniture" in got["page"] and "words" in got["zh"]
    mended = {r.block_id: r.repaired for r in scan_noise.repaired_blocks(df).collect()}
    assert mended["misread"] == "The bank moved under terms agreed against the reserve balance." and mended["zh"] == "据表3列示，机构达到2.5亿元，银行的余额上升。"
    assert "\n" not in mended["page"] and "7" not in mended["page"] and "-" not in mended["page"] and mended["null"] is None and mended["address"] == fine[1][2]
    assert scan_noise.damaged_blocks(df.limit(0)).count() == 0


def test_line_model_learns_from_pairs(spark):
    rows = [(f"b{k}", "text", "\n".join([f"alpha beta gamma delta number {k} and", "RUNNING HEAD", "epsilon zeta eta theta iota kappa one.", "A new line of words follows here now"]), f"alpha beta gamma delta number {k} and epsilon zeta eta theta iota kappa one.\nA new line of words follows here now") for k in range(30)]
    taught = scan_noise.taught_labels(rows[0][2], rows[0][3])
    assert [s for _, s in taught] == [1, 0, 2, 2]
    model = scan_noise.fit(scanned(spark, rows))
    assert model.labels(scan_noise.features(rows[3][2].split("\n"))) == ["body", "header", "break", "break"]


def test_very_long_texts_take_no_quadratic_time():
    import time

    words = scan_noise.Lexicon({"the": 99, "bank": 99}, {})
    texts = ["a" * 300_000, "word " * 60_000, " " * 200_000 + "x", "<p>" * 50_000, "\n" * 100_000, "银行" * 100_000, "- " * 100_000, "'" * 100_000, "{{" * 50_000, "$x" * 50_000, "x" + " " * 200_000 + "y"]
    began = time.time()
    for t in texts:
        scan_noise.damage(t, scan_noise.LineModel(), words)
        scan_noise.repair(t, scan_noise.LineModel(), words)
        truncation.ending(t, "text")
        truncation.ending(t, "table")
        markup.clean_text(t, markup.dialects(t))
        leakage.tokens(t)
    assert time.time() - began < 60
