"""Column expressions over texts and blocks; all of them stay in the JVM."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

from foliant.options import SETTLED, TEMPLATE_TYPES

# White space in Java's syntax, as Python's str.isspace() has it.
SPACE = r"[\s\p{Z}\x0B\x1C-\x1F\x85]"
FULL_WIDTH = "".join(map(chr, range(0xFF01, 0xFF5F)))
HALF_WIDTH = "".join(map(chr, range(0x21, 0x7F)))

# Patterns that the reference's results depend on.
PLACEHOLDER = r"(?is)^(?:the\s+(?:image|text).*(?:too\s+blurry|cannot|can't|unable).*(?:recognize|read)|(?:图片|图像|文字).*(?:太模糊|无法|不能).*(?:识别|读取)|(?:无法|不能)(?:识别|读取).*(?:图片|图像|文字))"
TERMINAL = r"[。！？!?；;][\"”’」』）)]?\s*$"
FACT = r"(?:[-+]?\d+(?:[.,]\d+)*(?:%|％)?|同比|环比|上升|下降|增长|减少|最高|最低|占比|趋势|峰值|谷值|增加|降低)"
CHAPTER = r"^第[一二三四五六七八九十百\d]+[编章节篇]"
TOPIC = r"^(?:专栏|专题)[一二三四五六七八九十百\d]+"
PAGE_NUMBER = r"^(?:第)?[-—–]?\s*\d+\s*(?:页|/\s*\d+)?$"


def blank(text: Column) -> Column:
    """Whether a text is null, empty or white space only."""
    return text.isNull() | ~text.rlike(rf"[^\s\p{{Z}}\x0B\x1C-\x1F\x85]")


def strip(text: Column) -> Column:
    return F.regexp_replace(text, rf"^{SPACE}+|{SPACE}+$", "")


def compact(text: Column) -> Column:
    """The text without white space."""
    return F.regexp_replace(text, rf"{SPACE}+", "")


def collapse(text: Column) -> Column:
    """Each run of white space as one space, none at the ends."""
    return F.trim(F.regexp_replace(text, rf"{SPACE}+", " "))


def fold_width(text: Column) -> Column:
    """Full-width ASCII as ASCII: what compatibility normalisation does to letters, digits and signs."""
    return F.translate(text, FULL_WIDTH, HALF_WIDTH)


def either(*values: Column) -> Column:
    """The first value that is neither null nor empty, else ''."""
    return F.coalesce(*(F.nullif(v, F.lit("")) for v in values), F.lit(""))


def content() -> Column:
    """A block's content: resolved unless empty, else raw."""
    return either(F.col("resolved_content"), F.col("raw_content"))


def provisional() -> Column:
    return ~F.coalesce(F.col("status").isin(*SETTLED), F.lit(False)) | (F.coalesce(F.col("chunk_eligible"), F.lit(True)) == F.lit(False))


def chunk_content() -> Column:
    """What a chunk shows of a block: the raw evidence while it is provisional."""
    return F.when(provisional() & ~blank(F.col("raw_content")), F.col("raw_content")).otherwise(content())


def failure_placeholder(text: Column) -> Column:
    flat = collapse(text)
    return (F.length(flat) > 0) & (F.length(flat) <= 240) & flat.rlike(PLACEHOLDER)


def template_type() -> Column:
    return F.coalesce(F.col("block_type").isin(*TEMPLATE_TYPES), F.lit(False))


def eligible() -> Column:
    """Whether a block may be chunked at all."""
    text = chunk_content()
    return ~F.coalesce(F.col("skip_chunk"), F.lit(False)) & ~template_type() & ~blank(text) & ~F.coalesce(failure_placeholder(text), F.lit(False)) & (~provisional() | ~blank(F.col("raw_content")))


def template_key(text: Column) -> Column:
    return F.substring(F.regexp_replace(F.lower(compact(text)), r"\p{Nd}+", "#"), 1, 160)


def let(value: Column, use: Callable[[Column], Column]) -> Column:
    """use(value) with value computed once, however often use asks for it: branches of a condition are no common subexpressions."""
    return F.get(F.transform(F.array(value), use), 0)


# Numbered headings by level, and what a line near a table may be.
CHINESE_NUMBER = r"^[一二三四五六七八九十]+[、.]"
BRACKETED_NUMBER = r"^[（(][一二三四五六七八九十\d]+[)）]"
DECIMAL_NUMBER = r"^(\d+(?:\.\d+){0,4})[\s、.]"
NOTE_BEGINS, NOTE_SIGN = r"^[（(]?\s*(?:注|说明|资料来源|数据来源)[：:]", "^[①②③④⑤⑥⑦⑧⑨⑩]"
UNIT_BEGINS = r"^[（(]?\s*(?:单位|币种)[：:]"
DATE_ONLY, DATE_IN_BRACKETS = r"^[（(]?\s*(?:截至)?\d{4}年(?:\d{1,2}月(?:\d{1,2}日)?)?[）)]?$", r"^[（(].*(?:余额|日期).*[）)]$"
REFERENCE_ONLY = r"^(?:续)?(?:附表|表|图)\s*[一二三四五六七八九十百\d]+(?:[-—.]\d+)?$"
CONTINUED = "^续表$"


def title_level(text: Column) -> Column:
    def level(t: Column) -> Column:
        number = F.regexp_extract(t, DECIMAL_NUMBER, 1)
        return (
            F.when(t.rlike(CHAPTER) | t.rlike(TOPIC), F.lit(1)).when(t.rlike(CHINESE_NUMBER), F.lit(2))
            .when(F.length(number) > 0, F.least(F.lit(5), F.length(number) - F.length(F.replace(number, F.lit("."), F.lit(""))) + 1))
            .when(t.rlike(BRACKETED_NUMBER), F.lit(3)).otherwise(F.lit(1))
        )

    return let(strip(text), level)


def context_kind(text: Column, block_type: Column) -> Column:
    """empty, note, unit, date, reference, continuation or title; the first that fits."""

    def kind(t: Column, flat: Column) -> Column:
        return (
            F.when(blank(t), "empty").when(t.rlike(NOTE_BEGINS) | flat.rlike(NOTE_SIGN) | (block_type == "footnote"), "note").when(t.rlike(UNIT_BEGINS), "unit")
            .when(flat.rlike(DATE_ONLY) | t.rlike(DATE_IN_BRACKETS), "date").when(flat.rlike(REFERENCE_ONLY), "reference").when(flat.rlike(CONTINUED), "continuation").otherwise("title")
        )

    return let(strip(text), lambda t: let(F.regexp_replace(compact(t), r"^[（）()]+|[（）()]+$", ""), lambda flat: kind(t, flat)))


def stable_id(*parts: Column) -> Column:
    """The first 32 hexadecimal digits of the SHA-256 of the parts joined by colons."""
    return F.substring(F.sha2(F.concat_ws(":", *parts).cast("binary"), 256), 1, 32)


def lexical_terms(text: Column) -> Column:
    """Latin words with trailing digits, numbers, single Chinese characters standing alone, and bigrams of Chinese runs."""
    folded = F.replace(F.lower(fold_width(F.coalesce(text, F.lit("")))), F.lit("\\%"), F.lit("%"))
    han = r"[\x{4e00}-\x{9fff}]"
    words = F.regexp_extract_all(folded, F.lit(rf"[a-z]+\d*|\d+(?:\.\d+)?%?|(?<!{han}){han}(?!{han})"), F.lit(0))
    pairs = F.regexp_extract_all(folded, F.lit(rf"(?=({han}{{2}})){han}"), F.lit(1))  # overlapping
    return F.concat(words, pairs)


def number_tokens(text: Column) -> Column:
    """Signed numbers with their separators and percent signs, as strings: 5.0 and 5.00 differ."""
    plain = F.translate(F.replace(fold_width(text), F.lit("\\%"), F.lit("%")), "‐‑‒–—−", "------")
    return F.regexp_extract_all(plain, F.lit(r"[-+]?\d+(?:[.,]\d+)*%?"), F.lit(0))


def comparable(text: Column) -> Column:
    """The form in which keywords and results are compared."""
    folded = F.translate(F.replace(F.lower(fold_width(F.coalesce(text, F.lit("")))), F.lit("\\%"), F.lit("%")), "−—", "--")
    return F.regexp_replace(folded, rf"[`*_{{}}$^,。;:、()\[\]《》<>\"'“”‘’，；：（）\s\p{{Z}}\x0B\x1C-\x1F\x85]+", "")


def char_f1(a: Column, b: Column) -> Column:
    """F1 of the character multisets of two texts; 0 if one is empty."""
    chars = F.array_distinct(F.split(a, ""))
    count = lambda t, c: F.length(t) - F.length(F.replace(t, c, F.lit("")))
    matched = F.aggregate(F.filter(chars, lambda c: F.length(c) > 0), F.lit(0), lambda acc, c: acc + F.least(count(a, c), count(b, c)))
    return F.when((F.length(a) > 0) & (F.length(b) > 0), 2.0 * matched / (F.length(a) + F.length(b))).otherwise(F.lit(0.0))
