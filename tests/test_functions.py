from collections import Counter

from pyspark.sql import functions as F

from foliant.functions import htmltable as H
from foliant.functions import text as T
from foliant.operators import chunks, quality, tables


def column(spark, values, expression):
    rows = spark.createDataFrame([(k, v) for k, v in enumerate(values)], "k int, x string").select("k", expression(F.col("x")).alias("y")).orderBy("k").collect()
    return [r.y for r in rows]


def test_blank_strip_compact(spark):
    values = [None, "", " \t\n", "　a b ", "x"]
    assert column(spark, values, T.blank) == [True, True, True, False, False]
    assert column(spark, values[3:], T.strip) == ["a b", "x"]
    assert column(spark, values[3:], T.compact) == ["ab", "x"]


def test_title_levels(spark):
    values = ["第二章 总则", "专栏3 风险", "三、要点", "1.2 范围", "1.2.3.4.5.6 深", "（一）小节", "Outlook"]
    assert column(spark, values, T.title_level) == [1, 1, 2, 2, 5, 3, 1]


def test_context_kinds(spark):
    rows = [("", "text"), ("注：见下", "text"), ("单位：亿元", "text"), ("2024年6月", "text"), ("表 3-1", "text"), ("续表", "text"), ("利率走势", "title"), ("1 see", "footnote")]
    got = spark.createDataFrame(rows, "x string, t string").select(T.context_kind(F.col("x"), F.col("t")).alias("k")).collect()
    assert [r.k for r in got] == ["empty", "note", "unit", "date", "reference", "continuation", "title", "note"]


def test_lexical_terms(spark):
    got = column(spark, ["Ａ1级 2.5％ 贷款余额 元 x", None, ""], T.lexical_terms)
    assert Counter(got[0]) == Counter(["a1", "级", "2.5%", "贷款", "款余", "余额", "元", "x"]) and got[1:] == [[], []]


def test_number_tokens_stay_strings(spark):
    assert column(spark, ["5.0 与 5.00 或−3 及1,234.5％", ""], T.number_tokens) == [["5.0", "5.00", "-3", "1,234.5%"], []]


def test_char_f1_against_counters(spark):
    pairs = [("abca", "aab"), ("", "x"), ("银行", "银行"), ("a", "b")]
    got = spark.createDataFrame(pairs, "a string, b string").select(T.char_f1(F.col("a"), F.col("b")).alias("f")).collect()
    for (a, b), row in zip(pairs, got):
        m = sum((Counter(a) & Counter(b)).values())
        assert abs(row.f - (2 * m / (len(a) + len(b)) if a and b else 0)) < 1e-9


def test_text_flags(spark):
    values = ["plain words here", "aaaaaaaaab", "█████", "bad � sign", "12A cost ¥5", "已脱敏", ""]
    assert column(spark, values, quality.text_flags) == [[], ["TXT-002"], ["SRC-004", "TXT-002"] if len("█████") >= 8 else ["SRC-004"], ["TXT-001"], ["TXT-002"], ["SRC-004"], []]


def test_repeated_share_against_counter(spark):
    import random

    rng = random.Random(3)
    values = ["".join(rng.choice("abc" if k % 2 else "aab") for _ in range(rng.randint(8, 30))) for k in range(60)]
    want = [max(Counter(v).values()) / len(v) >= 0.45 for v in values]
    assert ["TXT-002" in f for f in column(spark, values, quality.text_flags)] == want


def named(spark, *texts):
    """(cells, header rows, header paths) of table texts."""
    df = spark.createDataFrame([(k, t) for k, t in enumerate(texts)], "k int, t string")
    return [(r.cells, r.header_rows, r.headers) for r in tables.with_grids(df, "k", "t").orderBy("k").collect()]


def test_grid_spans_and_headers(spark):
    multi, plain, same = named(
        spark,
        "<table><tr><td rowspan=2>机构</td><td colspan=2>2015</td></tr><tr><td>甲</td><td>乙</td></tr><tr><td>a</td><td>1</td><td>2</td></tr></table>",
        "<table><tr><td>x1</td><td>y</td></tr><tr><td></td><td></td></tr><tr><td>p</td><td>q</td></tr></table>",
        "<table><thead><tr><th>n</th><th>n</th></tr></thead><tbody><tr><td>1</td></tr></tbody></table>",
    )
    assert multi[1:] == (2, ["机构", "2015 / 甲", "2015 / 乙"])
    assert plain[1:] == (0, ["第1列", "第2列"])
    assert same[2] == ["n [第1列]", "n [第2列]"] and same[0][1] == ["1", ""]


def test_grid_odd_spans():
    grid = lambda t: H.parse_grid(t).cells
    assert grid("<table><tr><td rowspan=9>a</td><td>b</td></tr><tr><td>c</td></tr></table>") == [["a", "b"], ["a", "c"]]
    assert grid("<table><tr><td>a</td><td>b</td><td rowspan=2>c</td></tr><tr><td>d</td></tr></table>") == [["a", "b", "c"], ["d", "", ""]]  # the row doesn't reach the span
    assert grid("<table><tr><td>a</td><td rowspan=2>b</td></tr><tr><td colspan=2>c</td><td>d</td></tr></table>") == [["a", "b", ""], ["c", "c", "d"]]
    assert len(grid("<table><tr><td colspan=1000000000>a</td></tr></table>")[0]) == H.WIDEST_SPAN


def test_grid_errors():
    for bad in ("", "text", "<table></table>", "<table><tr></tr></table>", "<table><tr><td rowspan='x'>1</td></tr></table>"):
        try:
            H.parse_grid(bad)
        except H.TableError:
            continue
        raise AssertionError(bad)


def test_compare_tables():
    a = "<table><tr><td>利率</td><td>5.0\\%</td><td>$x^{2}$</td></tr></table>"
    b = "<table><tr><td>利 率</td><td>5.0%</td><td>x2</td></tr></table>"
    assert H.compare(a, a) == (True, True, 0, 0)
    assert H.compare(a, b) == (True, True, 0, 3)
    assert H.compare(a, b.replace("5.0%", "5.1%"))[:3] == (True, False, 1)
    assert H.compare(a, "none") == (False, False, 0, 0)


def test_merge_and_ranges():
    one = "<table><tr><th>名称</th><th>金额</th></tr><tr><td>a</td><td>1</td></tr></table>"
    two = "<table><tr><td>名称</td><td>金额</td></tr><tr><td>b</td><td>2</td></tr></table>"
    merged = H.parse_grid(H.merge([(one, 4), (two, 5)]))
    assert merged.pages[merged.header_rows :][-1] == 5 and sum(row == ["名称", "金额"] for row in merged.cells) <= 2
    assert H.row_ranges(50, 780, 500, [50, 200, 350, 500, 650, 780]) == [(50, 500), (350, 780)]
    assert H.row_ranges(0, 100, 50, [0, 100]) == []
    for room in (60, 110, 170):
        found = H.row_ranges(0, 600, room, list(range(50, 600, 50)))
        assert not found or (found[0][0] == 0 and found[-1][1] == 600 and all(b - a <= room + 12 for a, b in found) and all(c <= b for (_, b), (c, _) in zip(found, found[1:])))
    tiles = H.parse_grid(H.merge_tiles([one, "<table><tr><th>名称</th><th>金额</th></tr><tr><td>a</td><td>1</td></tr><tr><td>c</td><td>3</td></tr></table>"]))
    assert tiles.cells[tiles.header_rows :] == [["a", "1"], ["c", "3"]]


def test_units_and_windows():
    assert chunks.units("甲。乙！\n\n丙", 10, 2) == ["甲。", "乙！", "丙"]
    assert chunks.split_long("abcdef", 4, 1) == ["abcd", "def"]
    assert chunks.split_long("aa，bb，cc", 4, 1) == ["aa，", "bb，", "cc"]
    got = chunks.windows([("p", "一二三。四五六。"), ("q", "七八九。")], 10, 3)
    assert [ids for _, ids in got] == [["p"], ["p", "q"]] and all(len(t) <= 10 for t, _ in got)
    assert chunks.windows([("p", "")], 10, 3) == []
