"""Problem 6: one form for text that looks the same but is made of different characters.

Whole Arrow batches are copied to code-point arrays. Lookup tables give each code point its expansion (deleted, replaced or kept),
an offset array places the expansions, base letters and marks are composed pairwise, and look-alike letters are replaced within
words that are Latin otherwise. No string function is called per row.

Null stays null and is never reported; an empty text stays empty. Repeated rows give equal results.
"""

from __future__ import annotations

import functools
import unicodedata

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from foliant.llm import codepoints as cps

# Letters of other scripts that look like a Latin letter, and that letter.
CYRILLIC_AS_LATIN = "аa еe оo рp сc уy хx іi ѕs јj ԁd һh ԛq ԝw ѵv кk АA ВB ЕE КK МM НH ОO РP СC ТT УY ХX ІI ЈJ ЅS ԌG"
GREEK_AS_LATIN = "αa οo νv ιi ρp υu κk χx γy τt ΑA ΒB ΕE ΖZ ΗH ΙI ΚK ΜM ΝN ΟO ΡP ΤT ΥY ΧX"
ARMENIAN_AS_LATIN = "օo հh ոn սu ցg քp"
# Forms in the block of radical supplements that Unicode does not decompose, and the usual character.
RADICAL_SUPPLEMENTS = "⺟母 ⺠民 ⺝月 ⻁虎 ⻄西 ⻅见 ⻆角 ⻉贝 ⻋车 ⻓长 ⻔门 ⻘青 ⻚页 ⻛风 ⻜飞 ⻝食 ⻢马 ⻣骨 ⻤鬼 ⻥鱼 ⻦鸟 ⻨麦 ⻩黄 ⻬齐 ⻮齿 ⻰龙 ⻳龟"
# Full-width signs that are not Chinese punctuation.
PLAIN_SIGNS = "＃＄％＆＊＋－／＜＝＞＠＾＿｀｜"

KEPT, DELETED, REPLACED = 0, 1, 2


@functools.cache
def _tables() -> dict[str, np.ndarray]:
    """Lookup tables over all code points, made by rule from the character database."""
    top = 0x110000
    length = np.ones(top, np.int8)
    first = np.zeros(top, np.int64)
    odd = np.zeros(top, np.bool_)
    pool: list[int] = []
    script = np.zeros(top, np.uint8)  # 1 Latin letter, 2 letter that may stand for a Latin one, 3 other letter of those scripts
    mark = np.zeros(top, np.bool_)

    def put(code: int, text: str, strange: bool = True) -> None:
        length[code], first[code] = len(text), len(pool)
        pool.extend(map(ord, text))
        odd[code] = strange

    replaced = np.zeros(top, np.bool_)
    for code in [*range(0x20), *range(0x7F, 0x3400), *range(0xF900, 0x10000), *range(0x1BCA0, 0x1BCA4), *range(0x1D173, 0x1D17B), *range(0x1D400, 0x1D800), *range(0x2F800, 0x2FA20), *range(0xE0000, 0xE0200)]:
        char = chr(code)
        kind = unicodedata.category(char)
        compatible = unicodedata.normalize("NFKC", char)
        if code in (0x85, 0x2028, 0x2029):
            put(code, "\n")
        elif kind == "Cf" or (kind == "Cc" and char not in "\t\n\r\f\v") or code in (0x34F, 0x115F, 0x1160, 0x3164, 0xFFA0) or 0x180B <= code <= 0x180E or 0xFE00 <= code <= 0xFE0F or 0xE0100 <= code <= 0xE01EF:
            put(code, "")
        elif kind == "Zs" and code != 0x20:
            put(code, " ")
        elif 0xFF10 <= code <= 0xFF5A and compatible.isalnum():
            put(code, compatible)
        elif char in PLAIN_SIGNS:
            put(code, compatible, False)
        elif 0xFB00 <= code <= 0xFB17 or code in (0x132, 0x133) or 0x1C4 <= code <= 0x1CC or 0x1F1 <= code <= 0x1F3:
            put(code, compatible)
        elif 0x1D400 <= code < 0x1D800 and compatible != char:
            put(code, compatible)
        elif (0xF900 <= code < 0xFB00 or code >= 0x2F800 or 0x2F00 <= code < 0x2FE0 or 0x2E80 <= code < 0x2F00) and kind[0] in "LS":
            put(code, compatible)
        else:
            if kind in ("Mn", "Me") and (0x300 <= code < 0x370 or 0x1AB0 <= code < 0x1B00 or 0x1DC0 <= code < 0x1E00 or 0x20D0 <= code < 0x2100 or 0xFE20 <= code < 0xFE30 or code in (0x3099, 0x309A)):
                mark[code] = True
            continue
        replaced[code] = True
    for pair in RADICAL_SUPPLEMENTS.split():
        put(ord(pair[0]), pair[1])
        replaced[ord(pair[0])] = True
    for code in range(0x250):
        script[code] = unicodedata.category(chr(code))[0] == "L"
    script[0x1E00:0x1F00] = 1
    script[0x370:0x530] = [3 * (unicodedata.category(chr(c))[0] == "L") for c in range(0x370, 0x530)]
    script[0x531:0x588] = 3
    latin = np.arange(top, dtype=np.uint32)
    for pair in f"{CYRILLIC_AS_LATIN} {GREEK_AS_LATIN} {ARMENIAN_AS_LATIN}".split():
        latin[ord(pair[0])], script[ord(pair[0])] = ord(pair[1]), 2
    keys, values = [], []
    for code in range(0xC0, 0x3100):
        parts = unicodedata.normalize("NFD", chr(code))
        if len(parts) > 1 and unicodedata.normalize("NFC", parts) == chr(code):
            keys.append(ord(unicodedata.normalize("NFC", parts[:-1])) << 21 | ord(parts[-1]) if len(unicodedata.normalize("NFC", parts[:-1])) == 1 else 0)
            values.append(code)
    order = np.argsort(keys, kind="stable")
    return {
        "length": length, "first": first, "pool": np.array(pool or [0], np.uint32), "odd": odd, "replaced": replaced, "script": script,
        "latin": latin, "mark": mark, "pair": np.array(keys, np.int64)[order], "composed": np.array(values, np.uint32)[order],
    }


def _row_of(starts: np.ndarray, n: int) -> np.ndarray:
    return np.repeat(np.arange(len(starts) - 1, dtype=np.int32), np.diff(starts))


def canonical_points(points: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Code points in the usual form, their row starts, and how many characters of each row stood for usual ones."""
    t = _tables()
    strange = t["odd"][points]
    found = cps.per_row(strange, starts)
    length = t["length"][points].astype(np.int64)
    swap = t["replaced"][points]
    if swap.any():
        ends = np.zeros(len(points) + 1, np.int64)
        np.cumsum(length, out=ends[1:])
        out = np.empty(ends[-1], np.uint32)
        out[ends[:-1][~swap]] = points[~swap]
        where = np.flatnonzero(swap & (length > 0))
        sizes = length[where]
        inner = np.arange(sizes.sum()) - np.repeat(np.cumsum(sizes) - sizes, sizes)
        out[np.repeat(ends[:-1][where], sizes) + inner] = t["pool"][np.repeat(t["first"][points[where]], sizes) + inner]
        points, starts = out, ends[starts]
    # marks: each joins the base before it for as long as a composed letter exists
    while True:
        at = np.flatnonzero(t["mark"][points])
        at = at[at > 0]
        opening = np.zeros(len(points) + 1, np.bool_)
        opening[starts] = True
        at = at[~opening[at]]
        at = at[~t["mark"][points[at - 1]]] if len(at) else at
        base = points[at - 1]
        letter = np.array([], np.int64) if not len(at) else np.flatnonzero((t["script"][base] > 0) | (base > 0x3040))
        at, base = at[letter], base[letter]
        if not len(at):
            break
        row = np.searchsorted(starts, at, "right") - 1
        key = base.astype(np.int64) << 21 | points[at].astype(np.int64)
        place = np.minimum(np.searchsorted(t["pair"], key), len(t["pair"]) - 1)
        fits = t["pair"][place] == key
        np.add.at(found, row, 1)
        if not fits.any():
            break
        points = points.copy()
        points[at[fits] - 1] = t["composed"][place[fits]]
        keep = np.ones(len(points), np.bool_)
        keep[at[fits]] = False
        kept = np.zeros(len(points) + 1, np.int64)
        np.cumsum(keep, out=kept[1:])
        points, starts = points[keep], kept[starts]
    # look-alikes within words that are Latin otherwise
    script = t["script"][points]
    if (script == 2).any():
        inside = np.flatnonzero(script)
        opening = np.zeros(len(points) + 1, np.bool_)
        opening[starts] = True
        fresh = np.ones(len(inside), np.bool_)
        fresh[1:] = (np.diff(inside) > 1) | opening[inside[1:]]
        head = np.flatnonzero(fresh)
        word = np.cumsum(fresh) - 1
        kinds = script[inside]
        counts = [np.add.reduceat((kinds == k).astype(np.int32), head) for k in (1, 2, 3)]
        latin_word = (counts[0] > 0) & (counts[1] > 0) & (counts[2] == 0)
        hit = inside[latin_word[word] & (kinds == 2)]
        if len(hit):
            points = points.copy()
            points[hit] = t["latin"][points[hit]]
            np.add.at(found, np.searchsorted(starts, hit, "right") - 1, 1)
    return points, starts, found


def _found_batches(id_column: str, fields: tuple[str, ...]):
    def run(batches):
        for batch in batches:
            for field in fields:
                column = cps.as_string_array(batch.column(field))
                _, _, found = canonical_points(*cps.explode(column))
                hit = pa.array(found > 0)
                ids = batch.column(id_column).filter(hit)
                yield pa.RecordBatch.from_arrays([ids, pa.array([field] * len(ids), pa.string())], names=[id_column, "field_name"])

    return run


def values_with_odd_characters(df: DataFrame, id_column: str, fields: tuple[str, ...]) -> DataFrame:
    """Distinct (id, field_name) of the values that hold at least one character standing for a usual one."""
    kind = df.schema[id_column].dataType.simpleString()
    return df.select(id_column, *fields).mapInArrow(_found_batches(id_column, fields), f"`{id_column}` {kind}, field_name string").distinct()


def _form_batches(keys: tuple[str, ...], fields: tuple[str, ...]):
    def run(batches):
        for batch in batches:
            arrays = [batch.column(k) for k in keys]
            for field in fields:
                column = cps.as_string_array(batch.column(field))
                points, starts, _ = canonical_points(*cps.explode(column))
                arrays.append(cps.implode(points, starts, np.asarray(column.is_null())))
            yield pa.RecordBatch.from_arrays(arrays, names=[*keys, *fields])

    return run


def canonical_texts(df: DataFrame, keys: tuple[str, ...], fields: tuple[str, ...]) -> DataFrame:
    """The key columns and each field in its usual form."""
    schema = ", ".join(f"`{k}` {df.schema[k].dataType.simpleString()}" for k in keys) + "".join(f", `{f}` string" for f in fields)
    return df.select(*keys, *fields).mapInArrow(_form_batches(keys, fields), schema)


def equal_looking_groups(df: DataFrame, key: str, field: str) -> DataFrame:
    """Texts that differ as delivered but are equal in the usual form: form_hash, n_records, n_variants."""
    both = canonical_texts(df.select(key, F.col(field).alias("form"), F.xxhash64(field).alias("given_hash")), (key, "given_hash"), ("form",))
    one = both.where(F.length("form") > 0).groupBy(F.xxhash64("form").alias("form_hash"), "given_hash").agg(F.count("*").alias("n"))
    return one.groupBy("form_hash").agg(F.sum("n").alias("n_records"), F.count("*").alias("n_variants")).where("n_variants > 1")


def _ranges(codes: np.ndarray) -> str:
    """Code points as the inside of a character class."""
    cuts = np.flatnonzero(np.diff(codes) > 1)
    firsts, lasts = codes[np.append(0, cuts + 1)], codes[np.append(cuts, len(codes) - 1)]
    return "".join(f"\\x{{{a:x}}}" if a == b else f"\\x{{{a:x}}}-\\x{{{b:x}}}" for a, b in zip(firsts.tolist(), lasts.tolist()) if not 0xD800 <= a <= 0xDFFF)


def sql_odd_characters(fields: tuple[str, ...]) -> str:
    """values_with_odd_characters for DuckDB, by character classes: any odd character, a mark after a letter, or a Latin word with look-alikes and no other letters."""
    t = _tables()
    of = lambda mask: _ranges(np.flatnonzero(mask))
    odd, mark, latin, alike, other = of(t["odd"]), of(t["mark"]), of(t["script"] == 1), of(t["script"] == 2), of(t["script"] == 3)
    test = f"""(regexp_matches(v, '[{odd}]') or regexp_matches(v, '[{latin}{alike}{other}\\x{{3041}}-\\x{{d7ff}}\\x{{e000}}-\\x{{10ffff}}][{mark}]')
      or len(list_filter(regexp_extract_all(v, '[{latin}{alike}{other}]+'), lambda w: regexp_matches(w, '[{latin}]') and regexp_matches(w, '[{alike}]') and not regexp_matches(w, '[{other}]'))) > 0)"""
    parts = [f"select block_id, '{f}' as field_name, {f} as v from blocks where {f} is not null" for f in fields]
    return f"select distinct block_id, field_name from ({' union all '.join(parts)}) where {test}"
