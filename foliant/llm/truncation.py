"""Problem 4: values that stop before their text ends, and how often each source cuts.

The length of every value is taken under several encodings (code points, UTF-8, UTF-16, entity escaping, JSON escaping, CRLF line
ends), all from weights of its code points. Lengths are counted per source and encoding; a length that is far more frequent than its
neighbours is a hidden storage limit. Then endings are inspected: prose that ends inside a word or sentence, prose with dots or a
broken character put at its end, and table markup that stops before the table ends are cut. A value at a hidden limit is taken for
cut even where the next page might go on with its sentence.

Only blocks of type text, footnote and table count. Null and empty values are complete. A block delivered twice counts once.
"""

from __future__ import annotations

import re
from collections import Counter

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from foliant.llm import codepoints as cps
from foliant.session import cut_lineage

FIELDS = ("raw_content", "resolved_content")
ENCODINGS = ("chars", "utf8", "utf16", "entities", "json", "json_ascii", "crlf")
NEAR, LEAST_AT_LIMIT, TIMES = 12, 8, 5.0


# lengths


def length_table(points: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """(encodings, rows) lengths of each row of code points."""
    one = np.ones(len(points), np.int64)
    utf8 = one + (points >= 0x80) + (points >= 0x800) + (points >= 0x10000)
    utf16 = 2 * one + 2 * (points >= 0x10000)
    entities = one.copy()
    for char, size in (("&", 5), ("<", 4), (">", 4), ('"', 6), ("'", 5)):
        entities[points == ord(char)] = size
    escaped = one.copy()
    control = points < 0x20
    escaped[control] = 6
    for char in '"\\\n\r\t\b\f':
        escaped[points == ord(char)] = 2
    ascii_ = np.where(points >= 0x10000, 12, np.where(points >= 0x7F, 6, escaped))
    crlf = one + (points == 10)
    return np.stack([cps.per_row(w, starts) for w in (one, utf8, utf16, entities, escaped, ascii_, crlf)])


def _inspect_worker(batches):
    """One pass over the values: counts of their lengths (row 'length') and the values with an open end (row 'open')."""
    names = ["row", "source", "encoding", "length", "n", "n_open", "block_id", "field_name", "document_id", "page_no", "block_type", "kind", "tail", "lengths"]
    long, text = pa.int64(), pa.string()
    types = [text, text, text, long, long, long, text, text, text, pa.int32(), text, text, text, pa.list_(long)]
    for batch in batches:
        columns = {c: batch.column(c).to_pylist() for c in ("block_id", "document_id", "page_no", "block_type", "source")}
        names_of, code = np.unique(np.array([s or "" for s in columns["source"]], dtype=str), return_inverse=True) if len(batch) else (np.array([], str), np.zeros(0, np.int64))
        out: list[list] = [[] for _ in names]
        for field in FIELDS:
            column = cps.as_string_array(batch.column(field))
            lengths = length_table(*cps.explode(column))
            open_ = np.zeros(len(batch), np.int64)
            for k, value in enumerate(column.to_pylist()):
                kind = ending(value, columns["block_type"][k])
                if kind:
                    open_[k] = 1
                    row = ("open", columns["source"][k] or "", None, None, None, None, columns["block_id"][k], field, columns["document_id"][k], columns["page_no"][k], columns["block_type"][k], kind, value.rstrip()[-24:], lengths[:, k].tolist())
                    for o, v in zip(out, row):
                        o.append(v)
            for e, encoding in enumerate(ENCODINGS):
                key, place, n = np.unique(code * (1 << 40) + lengths[e], return_inverse=True, return_counts=True)
                counted = np.bincount(place, open_, len(key)).astype(np.int64)
                out[0].extend(["length"] * len(key))
                out[1].extend(names_of[key >> 40].tolist())
                out[2].extend([encoding] * len(key))
                out[3].extend((key & ((1 << 40) - 1)).tolist())
                out[4].extend(n.tolist())
                out[5].extend(counted.tolist())
                for o in out[6:]:
                    o.extend([None] * len(key))
        yield pa.RecordBatch.from_arrays([pa.array(o, t) for o, t in zip(out, types)], names=names)


_INSPECTED = "row string, source string, encoding string, length long, n long, n_open long, block_id string, field_name string, document_id string, page_no int, block_type string, kind string, tail string, lengths array<long>"


def inspected(blocks: DataFrame) -> DataFrame:
    rows = blocks.where("block_type in ('text', 'footnote', 'table')").select("block_id", "document_id", "page_no", "block_type", "source", *FIELDS)
    return rows.mapInArrow(_inspect_worker, _INSPECTED)


def hidden_limits(blocks: DataFrame, least: int = 64) -> DataFrame:
    """source, encoding, length, n, n_open, near (values per neighbouring length) of the lengths where a source piles up values, most of them with an open end.

    One row per distinct length is compared, so the window holds lengths, not values."""
    return _limits(inspected(blocks), least)


def _limits(seen: DataFrame, least: int = 64) -> DataFrame:
    counts = seen.where("row = 'length'").groupBy("source", "encoding", "length").agg(F.sum("n").alias("n"), F.sum("n_open").alias("n_open"))
    w = Window.partitionBy("source", "encoding").orderBy("length")
    around = F.coalesce(F.sum("n").over(w.rangeBetween(-NEAR, -1)), F.lit(0)) + F.coalesce(F.sum("n").over(w.rangeBetween(1, NEAR)), F.lit(0))
    spiky = counts.withColumn("near", around / (2.0 * NEAR)).where(F.col("length") >= least)
    return spiky.where((F.col("n") >= LEAST_AT_LIMIT) & (F.col("n") >= TIMES * (F.col("near") + 1)) & (2 * F.col("n_open") >= F.col("n")))


# endings

_TAGS = re.compile(r"(?:\s*</[A-Za-z][A-Za-z0-9]*\s*>|\s*<br\s*/?>|\s*```|\s*\\end\{[a-z*]+\})+\s*$", re.I)
_CLOSED = re.compile(r"[。！？.!?；;：:][\"'”’」』）)\]*_]*$|[$|}\]]$|\\\]$|^[-=*_]{3,}$")
_DOTS = re.compile(r"(?:…+|\.{2,}|。{2,}|�+)[\"'”’]?$")
_ITEM = re.compile(r"\s*(?:[(（]\d{1,3}[)）]|\d{1,3}[.、)]\s|[-*+•·]\s|\\item\b|[①-⑳]|[(（][一二三四五六七八九十]+[)）]|#{1,6}\s|\||={1,6}[^=]|[:;>]\s)")
_PROSE = re.compile(r"[,，。；;%]|\.\s|^.{60,}\d\.\d|\d\.\d.{60,}$")
_TABLE = re.compile(r"<(/?)table\b", re.I)


def _untagged(text: str) -> str:
    """The text without closing tags at its end; looks at the end piece by piece, so that long runs of white space inside cost nothing."""
    while True:
        m = _TAGS.search(text[-2000:])
        if not m or not m.group():
            return text
        text = text[: len(text) - len(m.group())].rstrip()


def ending(text: str | None, block_type: str) -> str:
    """'' for a complete value, else 'dots', 'table' or 'open'."""
    if not text or not text.strip():
        return ""
    if block_type == "table":
        tags = _TABLE.findall(text)
        if tags:
            return "table" if sum(1 if x == "" else -1 for x in tags) > 0 else ""
        return "table" if re.search(r"^\s*<", text) and not re.search(r">\s*$", text) else ""
    body = text.rstrip()
    if _DOTS.search(body):
        return "dots" if _PROSE.search(body[:-1]) or len(body) > 60 else ""
    tags = _TABLE.findall(text)
    if tags and sum(1 if x == "" else -1 for x in tags) > 0:
        return "table"
    body = _untagged(body)
    if not body or _CLOSED.search(body):
        return ""
    lines = [x for x in body.split("\n") if x.strip()]
    last = lines[-1].strip()
    if _ITEM.match(last):
        return ""
    if not _PROSE.search(last):
        if len(lines) == 1:
            return "open" if len(last) >= 110 else ""
        before = _untagged(lines[-2].rstrip())
        if _CLOSED.search(before) and len(last) < 110:
            return ""  # a notice after the text
        if all(len(x) < 60 for x in lines) and not any(_PROSE.search(x) for x in lines):
            return ""  # an address
    if re.fullmatch(r"[\w./\-]*\d[\w./\-]*", last) and len(lines) == 1:
        return ""  # a code
    if re.search(r"\b\w+\s*=\s*\S|^\w+\(.*\)$", last) and len(last) < 60 and not re.search(r"[，。]", last):
        return ""  # program text
    return "open"


_SENTENCE_END = re.compile(r"(?<=[。！？])|(?<=[.!?])\s+|\n\s*\n")
_LINE_END = re.compile(r"\s*\n\s*")
TOTALS = {True: "\x00ascii", False: "\x00other"}  # keys of the sums over all beginnings of a script
_NUMBER = re.compile(r"[\d.,]*\d")
_GOES_ON = ",，。、；：）)%;:."  # what no sentence begins with
HELD = 200_000  # counts that a task holds before it sends them on


def start_key(text: str) -> str:
    """The beginning that is counted: the first word, or three characters."""
    return text.split(" ", 1)[0] if text[:1].isascii() and text[:1].isalpha() else _NUMBER.sub("#", text[:12])[:3]


def last_word(tail: str) -> str:
    """The lower-case letters that a text stops with; empty where it stops otherwise."""
    m = re.search(r"[A-Za-z]+$", tail)
    return m.group() if m and m.group().islower() else ""


def count_starts(text: str, opening: Counter, inside: Counter, words: Counter) -> None:
    """Count how often beginnings open a sentence of the text and how often they stand inside one, and its words. A single line end is no end of a sentence.

    The word that a text stops with may be cut, and is no known word."""
    text = text.rstrip()
    parts = _SENTENCE_END.split(text)
    for k, part in enumerate(parts):
        part = (part or "").strip()
        if len(part) < 4:
            continue
        opening[start_key(part)] += 1
        if part.isascii():
            tokens = part.split()
            inside.update(tokens[1:])
            stops = k == len(parts) - 1 and part[-1].isalpha()
            words.update(w.lower().strip(".,;()") for w in (tokens[:-1] if stops else tokens))
        else:
            flat = _NUMBER.sub("#", _LINE_END.sub("", part))
            inside.update(flat[k : k + 3] for k in range(1, len(flat) - 2))


def _starts_worker(batches):
    """Counts of each batch, or of several, by key. Keys that new_sentence never asks for stay out."""
    held = opening, inside, words = Counter(), Counter(), Counter()

    def out():
        rows = [(False, k, opening[k], inside[k]) for k in opening.keys() | inside.keys() if k and not (k[0].islower() or k[0].isdecimal() or k[0] in _GOES_ON)]
        for script, key in TOTALS.items():
            of = [(o, i) for _, k, o, i in rows if k.isascii() == script]
            rows.append((False, key, sum(o for o, _ in of), sum(i for _, i in of)))
        rows += [(True, k, n, 0) for k, n in words.items() if k.isascii() and k.isalpha()]
        for x in held:
            x.clear()
        return pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], t) for k, t in enumerate((pa.bool_(), pa.string(), pa.int64(), pa.int64()))], names=["word", "key", "opening", "inside"])

    for batch in batches:
        for text in batch.column("raw_content").to_pylist():
            count_starts(text, opening, inside, words)
            if len(opening) + len(inside) + len(words) > HELD:
                yield out()
    yield out()


def sentence_starts(blocks: DataFrame, asked: DataFrame) -> DataFrame:
    """word, key, opening, inside of the asked (word, key), counted over all text blocks: of beginnings, and of words (their number is in opening). The keys of TOTALS have the sums over all beginnings."""
    texts = blocks.where("block_type = 'text' and raw_content is not null").select("raw_content")
    counts = texts.mapInArrow(_starts_worker, "word boolean, key string, opening long, inside long")
    asked = asked.unionByName(asked.sparkSession.createDataFrame([(False, k) for k in TOTALS.values()], "word boolean, key string"))
    return counts.join(asked.distinct(), ["word", "key"], "left_semi").groupBy("word", "key").agg(F.sum("opening").alias("opening"), F.sum("inside").alias("inside"))


def _script(text: str) -> bool | None:
    """Whether the letters of a text are all ASCII (True) or none is (False)."""
    letters = [c.isascii() for c in text if c.isalpha()]
    return letters[0] if letters and len(set(letters)) == 1 else None


def new_sentence(head: str, tail: str, opening: int, inside: int, known: bool, odds: float = 1.0) -> bool:
    """Whether a block that begins with head opens a sentence, rather than going on after tail.

    With the counts of its start_key: a beginning is drawn from the openings of sentences, or from the places inside of them, and the
    likelier of the two decides; odds is how many inside places there are for each opening. The block's own beginning is counted as an
    opening and is left out. A text in another script than the one before is no continuation. known: the last_word of tail is known."""
    head = head.strip()
    if not head:
        return True
    if head[0].islower() or head[0] in _GOES_ON:
        return False
    before, after = _script(tail[-12:]), _script(head[:8])
    if before is not None and after is not None and before != after:
        return True
    opening = max(0, opening - 1)
    if opening + inside:
        return opening * odds > inside
    if head[0].isascii() and head[0].isdigit():
        return False
    return bool(last_word(tail)) and not known  # unknown beginnings: names


def cut_values(blocks: DataFrame) -> DataFrame:
    """block_id, field_name, source, kind of the cut values, one row each."""
    seen = cut_lineage(inspected(blocks))  # counts of lengths and the few values with an open end
    open_ = seen.where("row = 'open'").select("block_id", "field_name", "document_id", "page_no", "block_type", "source", "kind", "tail", "lengths").dropDuplicates(["block_id", "field_name"])
    # the first and the last text block of each page; running lines, which are no prose, are passed over where others follow
    text = blocks.where("block_type = 'text' and raw_content is not null and reading_order is not null")
    prose = F.col("raw_content").rlike(r"[,，。；;%]|[.]\s")
    head = F.struct("reading_order", F.substring("raw_content", 1, 60).alias("head"))
    pages = text.groupBy("document_id", "page_no").agg(
        F.max(F.when(prose, F.struct("reading_order", "block_id"))).alias("last"), F.min(head).alias("first"), F.min(F.when(prose, head)).alias("first_prose")
    )
    pages = cut_lineage(pages.select("document_id", "page_no", F.col("last.block_id").alias("last_id"), F.coalesce("first_prose.head", "first.head").alias("head")))
    following = pages.select("document_id", (F.col("page_no") - 1).alias("page_no"), F.col("head").alias("next_head"))
    placed = open_.join(pages.drop("head"), ["document_id", "page_no"], "left").join(following, ["document_id", "page_no"], "left")
    goes_on = (F.col("kind") == "open") & (F.col("block_type") == "text") & (F.col("last_id") == F.col("block_id")) & F.col("next_head").isNotNull()
    placed = cut_lineage(placed.withColumn("goes_on", F.coalesce(goes_on, F.lit(False))))
    doubtful = placed.where("goes_on")
    limits = _limits(seen).select("source", "encoding", "length").distinct()
    sized = doubtful.select("block_id", "field_name", "source", F.posexplode("lengths").alias("e", "length")).withColumn("encoding", F.element_at(F.array(*map(F.lit, ENCODINGS)), F.col("e") + 1))
    at_limit = sized.join(limits, ["source", "encoding", "length"], "left_semi").select("block_id", "field_name").distinct().withColumn("at_limit", F.lit(True))
    doubtful = cut_lineage(doubtful.withColumn("asked", F.pandas_udf(_asked, "start string, last string")("next_head", "tail")).select("*", "asked.start", "asked.last").drop("asked"))
    asked = doubtful.select(F.lit(False).alias("word"), F.col("start").alias("key")).unionByName(doubtful.select(F.lit(True).alias("word"), F.col("last").alias("key")))
    starts = cut_lineage(sentence_starts(blocks, asked))
    totals = {r.key: r.inside / max(1, r.opening) for r in starts.where(F.col("key").isin(*TOTALS.values())).collect()}  # two rows
    odds = F.when(F.col("start").rlike(r"^[\x00-\x7F]*$"), totals.get(TOTALS[True], 1.0)).otherwise(totals.get(TOTALS[False], 1.0))
    doubtful = doubtful.join(starts.where("not word").select(F.col("key").alias("start"), "opening", "inside"), "start", "left")
    doubtful = doubtful.join(starts.where("word").select(F.col("key").alias("last"), F.lit(True).alias("known")), "last", "left").fillna(0, ["opening", "inside"]).fillna(False, ["known"]).withColumn("odds", odds)
    doubtful = doubtful.join(at_limit, ["block_id", "field_name"], "left").where(F.coalesce("at_limit", F.lit(False)) | F.pandas_udf(_fresh, "boolean")("next_head", "tail", "opening", "inside", "known", "odds"))
    names = ["block_id", "field_name", "source", "kind"]
    return placed.where(~F.col("goes_on")).select(*names).unionByName(doubtful.select(*names))


def _asked(heads: pd.Series, tails: pd.Series) -> pd.DataFrame:
    return pd.DataFrame({"start": [start_key((h or "").strip()) for h in heads], "last": [last_word(t or "") for t in tails]}, dtype=object)


def _fresh(heads: pd.Series, tails: pd.Series, opening: pd.Series, inside: pd.Series, known: pd.Series, odds: pd.Series) -> pd.Series:
    return pd.Series([new_sentence(h or "", t or "", o, i, k, r) for h, t, o, i, k, r in zip(heads, tails, opening, inside, known, odds)], dtype=bool)


def source_rates(blocks: DataFrame) -> DataFrame:
    """source ('' where unknown), field_name, n_values (that aren't empty), n_cut, cut_share."""
    values = blocks.where("block_type in ('text', 'footnote', 'table')").select("block_id", "source", F.explode(F.array(*[F.struct(F.lit(f).alias("field_name"), (F.length(f) > 0).alias("some")) for f in FIELDS])).alias("x")).fillna("", ["source"])
    values = values.where("x.some").select("block_id", "source", "x.field_name").distinct().groupBy("source", "field_name").agg(F.count("*").alias("n_values"))
    cut = cut_values(blocks).groupBy("source", "field_name").agg(F.count("*").alias("n_cut"))
    joined = values.alias("v").join(cut.alias("c"), F.col("v.source").eqNullSafe(F.col("c.source")) & (F.col("v.field_name") == F.col("c.field_name")), "left")
    return joined.select("v.source", "v.field_name", "n_values", F.coalesce("n_cut", F.lit(0)).alias("n_cut"), (F.coalesce("n_cut", F.lit(0)) / F.col("n_values")).alias("cut_share"))
