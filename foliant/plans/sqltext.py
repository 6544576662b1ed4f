"""Pieces of DuckDB SQL that say the same as foliant.functions.text, for the oracle queries."""

from __future__ import annotations

import sys
import unicodedata

from foliant.functions.text import FULL_WIDTH, HALF_WIDTH

SPACE = r"[\s\p{Z}\x0B\x1C-\x1F\x{85}]"
SOLID = r"[^\s\p{Z}\x0B\x1C-\x1F\x{85}]"
CONTENT = "coalesce(nullif(resolved_content, ''), nullif(raw_content, ''), '')"
PROVISIONAL = "(not coalesce(status in ('accepted', 'repaired'), false) or coalesce(chunk_eligible, true) = false)"
TEMPLATE = "coalesce(block_type in ('header', 'footer', 'page_number'), false)"
BLOCKS = f"(select distinct on (block_id) *, {CONTENT} as content, coalesce(reading_order, 1048576) as position from blocks order by block_id)"
CHUNKS = "(select distinct on (chunk_id) *, json_extract_string(metadata_json, '$.chunk_role') as chunk_role from chunks order by chunk_id)"


def lit(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def blank(x: str) -> str:
    return f"(not regexp_matches(coalesce({x}, ''), {lit(SOLID)}))"


def strip(x: str) -> str:
    return f"regexp_replace({x}, {lit(f'^{SPACE}+|{SPACE}+$')}, '', 'g')"


def compact(x: str) -> str:
    return f"regexp_replace({x}, {lit(SPACE + '+')}, '', 'g')"


def collapse(x: str) -> str:
    return f"trim(regexp_replace({x}, {lit(SPACE + '+')}, ' ', 'g'))"


def fold(x: str) -> str:
    return f"translate({x}, {lit(FULL_WIDTH)}, {lit(HALF_WIDTH)})"


def template_key(x: str) -> str:
    return f"left(regexp_replace(lower({compact(x)}), '\\p{{Nd}}+', '#', 'g'), 160)"


CHUNK_CONTENT = f"case when {PROVISIONAL} and not {blank('raw_content')} then raw_content else {CONTENT} end"
PLACEHOLDER = r"(?is)^(?:the\s+(?:image|text).*(?:too\s+blurry|cannot|can''t|unable).*(?:recognize|read)|(?:图片|图像|文字).*(?:太模糊|无法|不能).*(?:识别|读取)|(?:无法|不能)(?:识别|读取).*(?:图片|图像|文字))"


def placeholder(x: str) -> str:
    flat = collapse(x)
    return f"(length({flat}) between 1 and 240 and regexp_matches({flat}, '{PLACEHOLDER}'))"


ELIGIBLE = f"(not coalesce(skip_chunk, false) and not {TEMPLATE} and not {blank(CHUNK_CONTENT)} and not coalesce({placeholder(CHUNK_CONTENT)}, false) and (not {PROVISIONAL} or not {blank('raw_content')}))"


def terms(x: str) -> str:
    """A list of lexical terms."""
    tokens = f"regexp_extract_all(replace(lower({fold(f'coalesce({x}, {lit(str())})')}), '\\%', '%'), '[a-z]+\\d*|\\d+(?:\\.\\d+)?%?|[\\x{{4e00}}-\\x{{9fff}}]+')"
    return f"flatten(list_transform({tokens}, lambda t: case when regexp_full_match(t, '[\\x{{4e00}}-\\x{{9fff}}]{{2,}}') then list_transform(range(1, length(t)), lambda i: substr(t, i, 2)) else [t] end))"


def numbers(x: str) -> str:
    plain = f"translate(replace({fold(x)}, '\\%', '%'), '‐‑‒–—−', '------')"
    return f"regexp_extract_all({plain}, '[-+]?\\d+(?:[.,]\\d+)*%?')"


def kind(x: str, block_type: str) -> str:
    t = strip(x)
    flat = f"regexp_replace({compact(t)}, '^[（）()]+|[（）()]+$', '', 'g')"
    return f"""case when {blank(x)} then 'empty'
      when regexp_matches({t}, '^[（(]?\\s*(?:注|说明|资料来源|数据来源)[：:]') or regexp_matches({flat}, '^[①②③④⑤⑥⑦⑧⑨⑩]') or {block_type} = 'footnote' then 'note'
      when regexp_matches({t}, '^[（(]?\\s*(?:单位|币种)[：:]') then 'unit'
      when regexp_matches({flat}, '^[（(]?\\s*(?:截至)?\\d{{4}}年(?:\\d{{1,2}}月(?:\\d{{1,2}}日)?)?[）)]?$') or regexp_matches({t}, '^[（(].*(?:余额|日期).*[）)]$') then 'date'
      when regexp_matches({flat}, '^(?:续)?(?:附表|表|图)\\s*[一二三四五六七八九十百\\d]+(?:[-—.]\\d+)?$') then 'reference'
      when regexp_matches({flat}, '^续表$') then 'continuation' else 'title' end"""


def level(x: str) -> str:
    t = strip(x)
    number = f"regexp_extract({t}, '^(\\d+(?:\\.\\d+){{0,4}})[\\s、.]', 1)"
    return f"""case when regexp_matches({t}, '^第[一二三四五六七八九十百\\d]+[编章节篇]') or regexp_matches({t}, '^(?:专栏|专题)[一二三四五六七八九十百\\d]+') then 1
      when regexp_matches({t}, '^[一二三四五六七八九十]+[、.]') then 2
      when length({number}) > 0 then least(5, length({number}) - length(replace({number}, '.', '')) + 1)
      when regexp_matches({t}, '^[（(][一二三四五六七八九十\\d]+[)）]') then 3 else 1 end"""


def share(a: str, b: str) -> str:
    """The intersection as a share of a's area."""
    return f"(greatest(0, least({a}.x1, {b}.x1) - greatest({a}.x0, {b}.x0)) * greatest(0, least({a}.y1, {b}.y1) - greatest({a}.y0, {b}.y0)) / greatest(1e-9, greatest(0, {a}.x1 - {a}.x0) * greatest(0, {a}.y1 - {a}.y0)))"


def covers(b: str, l: str) -> str:  # noqa: E741
    w = f"greatest(0, least({b}.x1, {l}.x1) - greatest({b}.x0, {l}.x0)) * greatest(0, least({b}.y1, {l}.y1) - greatest({b}.y0, {l}.y0))"
    area = f"greatest(1e-9, greatest(0, {l}.x1 - {l}.x0) * greatest(0, {l}.y1 - {l}.y0))"
    inside = f"(({l}.x0 + {l}.x1) / 2 between {b}.x0 and {b}.x1 and ({l}.y0 + {l}.y1) / 2 between {b}.y0 and {b}.y1)"
    return f"({inside} or {w} / {area} >= 0.35)"


# Compatibility forms that stand for one character, by rule; and the usual ones that stand for several.
_ONE = [c for c in map(chr, range(sys.maxunicode + 1)) if len(unicodedata.normalize("NFKC", c)) == 1 and unicodedata.normalize("NFKC", c) != c and unicodedata.normalize("NFC", c) == c]
_SEVERAL = "…‥ﬀﬁﬂﬃﬄ℃℉㎡㎞㎏㎎㎜½¼¾™№㈱"
_SIGNS = dict.fromkeys("‐‑‒–—", "-") | {"“": '"', "”": '"', "‘": "'", "’": "'", "﹒": "."}


def nfkc(x: str) -> str:
    for c in _SEVERAL:
        x = f"replace({x}, {lit(c)}, {lit(unicodedata.normalize('NFKC', c))})"
    return f"nfc_normalize(translate({x}, {lit(''.join(_ONE))}, {lit(''.join(unicodedata.normalize('NFKC', c) for c in _ONE))}))"


def unescape(x: str) -> str:
    for name, c in (("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"), ("&nbsp;", "\xa0"), ("&amp;", "&")):
        x = f"replace({x}, '{name}', {lit(c)})"
    return x


def flat(x: str) -> str:
    """The text of a value that may be a table."""
    return f"case when contains(lower({x}), '<table') then regexp_replace({x}, '<[^>]*>', ' ', 'g') else {x} end"


def normal(x: str) -> str:
    """The form in which texts are compared with a text layer."""
    signs = f"translate({nfkc(unescape(x))}, {lit(''.join(_SIGNS) + chr(0xAD) + chr(0x200B) + chr(0xFEFF))}, {lit(''.join(_SIGNS.values()))})"
    return compact(signs)


def plain(x: str) -> str:
    return nfkc("replace(" + unescape(x) + ", '\\%', '%')")


def alike(part: str, whole: str) -> str:
    count = lambda t: f"length({t}) - length(replace({t}, ch, ''))"
    matched = f"list_sum(list_transform(list_filter(list_distinct(string_split({part}, '')), lambda ch: ch <> ''), lambda ch: least({count(part)}, {count(whole)})))"
    return f"(contains({whole}, {part}) or (2.0 * least(length({part}), length({whole})) >= 0.92 * (length({part}) + length({whole})) and 2.0 * {matched} / (length({part}) + length({whole})) >= 0.92))"
