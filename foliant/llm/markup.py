"""Problem 3: clean text from HTML, Markdown, wiki and LaTeX markup, with headings, lists, tables, code and formulas kept.

Consensus host paths: the containers of each HTML value (and its text outside of any) are scored by text length and share of link
text; the scores are summed in Spark per host and generalised tag-class path (digits masked), which gives each host its winning
paths; the values are then extracted again, keeping what stands under winning paths. A value of which the winning paths hold too
little is kept whole, so that no text is lost to a vote. Other dialects are converted by their own rules.

The result has one row per value that isn't empty: the dialects found ('' for plain text) and the clean text. Null and empty values
give no row. Rows delivered twice give equal rows.
"""

from __future__ import annotations

import html
import re
from collections import defaultdict

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from foliant.session import cut_lineage

# HTML's element names.
HTML_NAMES = (
    "a abbr address article aside b blockquote body br button caption center cite code col colgroup dd del details dfn div dl dt em embed figcaption figure font footer form"
    " h1 h2 h3 h4 h5 h6 head header hr html i iframe img input ins kbd label li link main mark math meta nav noscript object ol option p param pre q s samp script section select small"
    " span strike strong style sub summary sup svg table tbody td textarea tfoot th thead title tr tt u ul var video"
).split()
TAG = re.compile(r"<(/?)(" + "|".join(sorted(HTML_NAMES, key=len, reverse=True)) + r")\b((?:[^<>\"']|\"[^\"]*\"|'[^']*')*)(>|$)", re.I)
ENTITY = re.compile(r"&(?:#\d{1,7}|#[xX][0-9a-fA-F]{1,6}|[A-Za-z][A-Za-z0-9]{1,30});")
COMMENT = re.compile(r"<!--.*?(?:-->|$)|<!DOCTYPE[^>]*>|<(script|style|noscript)\b.*?(?:</\1\s*>|$)", re.I | re.S)

LATEX = re.compile(r"\\(?:[A-Za-z]+\s*[\[{]|begin\b|end\b|item\b|(?:d?frac|sqrt|sum|prod|int|geq?|leq?|neq?|times|cdot|alpha|beta|gamma|delta|sigma|mu|pi|infty|left|right|quad|text|math[a-z]+|hline|section|cite|ref)\b)|\\\[|\\\(|\\[%$&#_]|\$\$|\$[^$\n]{0,200}[\\^_][^$\n]{0,200}\$|[A-Za-z0-9}]\s?[_^]\{")
MARKDOWN = re.compile(r"^\s{0,3}#{1,6}\s+\S|^\s{0,3}```|^\s{0,3}~~~|^>\s|\*\*[^*\s][^*\n]*\*\*|(?<![\w_])__[^_\s][^_\n]*__(?![\w_])|!?\[[^\]\n]+\]\((?:https?:|/|#|mailto:|\w+[./])[^)\n]*\)|^[ \t]*\|?(?:[ \t]*:?-{2,}:?[ \t]*\|)+(?:[ \t]*:?-{2,}:?[ \t]*)?$|(?<![\w`])`[^`\n]+`|(?<![\w_])_[^_\s\d][^_\n]{0,80}_(?![\w_])|(?<![\w*])\*[^*\s\d][^*\n]{0,80}[^*\s]\*(?![\w*])", re.M)
WIKI = re.compile(r"^(={1,6})[^=\n]+\1\s*$|\[\[[^\]\n]+\]\]|\{\{[^{}\n]*\|[^{}]*\}\}|'''?[^'\n]+'''?|^\{\||^\|-[ \t]*$|<ref\b|^[:;*#]+\s*\[\[", re.M)
#: Nothing that any dialect uses is in a text without one of these.
HINT = re.compile(r"[<&\\$*_`\[{^>~]|'''|''|(?m:^[#=|])|\]\(|---")


def dialects(text: str) -> list[str]:
    """Which markup languages a text is written in; none for plain text, whatever comparisons, products or codes it holds."""
    if not HINT.search(text):
        return []
    found = []
    if TAG.search(text) or (any(html.unescape(m.group()) != m.group() for m in ENTITY.finditer(text))):
        found.append("html")
    if LATEX.search(text):
        found.append("latex")
    if WIKI.search(text):
        found.append("wiki")
    if MARKDOWN.search(text):
        found.append("markdown")
    return found


# HTML

VOID = frozenset("br hr img input col link meta embed param".split())
BLOCK = frozenset("address article aside blockquote body center dd details div dl dt figcaption figure footer form h1 h2 h3 h4 h5 h6 header hr li main nav ol p pre section summary table ul caption".split())
CONTAINER = frozenset("article aside blockquote body div dl figure footer form header main nav ol p pre section table ul".split())


def _class(attributes: str) -> str:
    m = re.search(r"class\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|(\S+))", attributes, re.I)
    return re.sub(r"\d+", "#", " ".join(sorted(next(x for x in m.groups() if x is not None).split()))) if m else ""


def events(text: str):
    """(kind, value, attributes) with kind 'text', 'open' or 'close'."""
    text, at = COMMENT.sub(" ", text), 0
    for m in TAG.finditer(text):
        if m.start() > at:
            yield "text", text[at : m.start()], ""
        name = m.group(2).lower()
        if m.group(1):
            yield "close", name, ""
        else:
            yield "open", name, m.group(3)
            if name in VOID or m.group(3).endswith("/"):
                yield "close", name, ""
        at = m.end()
    if at < len(text):
        yield "text", text[at:], ""


def container_scores(text: str) -> dict[str, tuple[float, int]]:
    """(score, code points) of each generalised container path of an HTML value; the path '' holds what is outside of containers."""
    stack: list[tuple[str, bool]] = []
    path, links = [], 0
    out: dict[str, list[float]] = defaultdict(lambda: [0.0, 0])
    for kind, value, attributes in events(text):
        if kind == "text":
            n = len(html.unescape(value).strip())
            if n:
                score = out[">".join(path)]
                score[0] += n * (-0.5 if links else 1.0)
                score[1] += n
        elif kind == "open":
            holds = value in CONTAINER
            stack.append((value, holds))
            links += value == "a"
            if holds:
                name = _class(attributes)
                path.append(f"{value}.{name}" if name else value)
        elif any(name == value for name, _ in stack):
            while stack:
                name, holds = stack.pop()
                links -= name == "a"
                if holds:
                    path.pop()
                if name == value:
                    break
    return {p: (s, int(n)) for p, (s, n) in out.items()}


def html_text(text: str, winning: frozenset[str] | None = None) -> str:
    """Clean text of an HTML value; with winning paths, only what stands under them (or below one of them)."""
    out: list[str] = []
    stack: list[tuple[str, bool]] = []
    path: list[str] = []
    lists: list[list] = []
    cells: list[list] = []  # of open tables: [rows of cells, text of the open cell]
    pre = 0

    def put(piece: str) -> None:
        (cells[-1][1] if cells and cells[-1][1] is not None else out).append(piece)

    def shut(name: str) -> None:
        nonlocal pre
        if name in ("td", "th") and cells and cells[-1][1] is not None:
            cells[-1][0][-1].append(re.sub(r"\s+", " ", "".join(cells[-1][1])).strip()) if cells[-1][0] else cells[-1][0].append([""])
            cells[-1][1] = None
        elif name == "table" and cells:
            rows, rest = cells.pop()
            put("\n" + "\n".join(" | ".join(r) for r in rows if any(r)) + "\n" + ("".join(rest) if rest else ""))
        elif name in ("ul", "ol") and lists:
            lists.pop()
            put("\n")
        elif name == "pre":
            pre -= 1
            put("\n```\n")
        elif name == "code" and not pre:
            put("`")
        elif name in ("sup", "sub"):
            put("}")
        elif name in BLOCK and name != "li":  # the next item opens a line of its own
            put("\n\n" if name == "p" or name[0] == "h" else "\n")

    keep = winning is None
    for kind, value, attributes in events(text):
        if kind == "text":
            if keep or any(">".join(path[:k]) in winning for k in range(len(path) + 1)):
                value = html.unescape(value)
                put(value if pre else re.sub(r"[ \t\r\n\f]+", " ", value))
        elif kind == "open":
            holds = value in CONTAINER
            if value in ("td", "th", "tr") and stack and stack[-1][0] in ("td", "th"):
                shut(stack.pop()[0])
            stack.append((value, holds))
            if holds:
                name = _class(attributes)
                path.append(f"{value}.{name}" if name else value)
            if value == "table":
                put("\n")
                cells.append([[], None])
            elif value == "tr" and cells:
                cells[-1][0].append([])
            elif value in ("td", "th") and cells:
                if not cells[-1][0]:
                    cells[-1][0].append([])
                cells[-1][1] = []
            elif value in ("ul", "ol"):
                lists.append([value, 0])
            elif value == "li":
                depth = lists[-1] if lists else ["ul", 0]
                depth[1] += 1
                put("\n" + "  " * max(0, len(lists) - 1) + (f"{depth[1]}. " if depth[0] == "ol" else "- "))
            elif re.fullmatch(r"h[1-6]", value):
                put("\n\n" + "#" * int(value[1]) + " ")
            elif value == "pre":
                pre += 1
                put("\n```\n")
            elif value == "code" and not pre:
                put("`")
            elif value in ("sup", "sub"):
                put("^{" if value == "sup" else "_{")
            elif value == "br":
                put("\n" if not (cells and cells[-1][1] is not None) else " ")
            elif value in BLOCK:
                put("\n")
        elif any(name == value for name, _ in stack):
            while stack:
                name, holds = stack.pop()
                shut(name)
                if holds:
                    path.pop()
                if name == value:
                    break
    while stack:
        shut(stack.pop()[0])
    return "".join(out)


# the other dialects


def latex_text(text: str) -> str:
    """Clean text of LaTeX: sectioning as headings, items as list lines, formulas kept between dollar signs, text commands unwrapped."""
    kept: list[str] = []

    def keep(m: re.Match) -> str:
        kept.append(m.group())
        return f"\x00{len(kept) - 1}\x00"

    text = re.sub(r"\$\$.*?\$\$|\\\[.*?\\\]|\\\(.*?\\\)|\$[^$\n]*[\\^_=<>+][^$\n]*\$|\\begin\{(equation|align|aligned|gather|matrix|cases|array)(\*?)\}.*?\\end\{\1\2\}", keep, text, flags=re.S)
    if not kept and not re.search(r"\\(?:section|subsection|begin|item|text\w+|emph|cite|ref|label|footnote|par|%)", text) and re.search(r"\\[A-Za-z]+|[_^]\{", text):
        return text.strip()  # a bare formula
    text = re.sub(r"\\(sub)*section\*?\{([^{}]*)\}", lambda m: "\n" + "#" * (1 + m.group(0).count("sub")) + " " + m.group(2) + "\n", text)
    text = re.sub(r"\\(?:begin|end)\{[A-Za-z]+\*?\}(?:\[[^\]]*\])?", "\n", text)
    text = re.sub(r"\s*\\item(?:\[([^\]]*)\])?\s*", lambda m: "\n- " + (m.group(1) + " " if m.group(1) else ""), text)
    text = re.sub(r"\s*\\(?:cite[tp]?|ref|label|eqref)\{[^{}]*\}", "", text)
    for _ in range(3):
        text = re.sub(r"\\[A-Za-z]+\*?(?:\[[^\]]*\])?\{([^{}]*)\}", r"\1", text)
    text = re.sub(r"\\([%$&#_{}])", r"\1", text)
    text = re.sub(r"\\\\\s*", "\n", text)
    return re.sub(r"\x00(\d+)\x00", lambda m: kept[int(m.group(1))], text)


def wiki_text(text: str) -> str:
    text = re.sub(r"\{\{[^{}]*\}\}|<ref\b[^>]*/>|<ref\b.*?</ref>", "", text, flags=re.S)
    text = re.sub(r"^(={1,6})\s*([^=\n]+?)\s*\1\s*$", lambda m: "#" * len(m.group(1)) + " " + m.group(2), text, flags=re.M)
    text = re.sub(r"\[\[(?:[^\]|\n]*\|)?([^\]\n]+)\]\]", r"\1", text)
    text = re.sub(r"\[https?://\S+\s+([^\]\n]+)\]", r"\1", text)
    text = re.sub(r"'{2,5}([^'\n]+)'{2,5}", r"\1", text)
    text = re.sub(r"^(?:\{\|.*|\|\}.*|\|-[ \t]*)$\n?", "", text, flags=re.M)
    return re.sub(r"^\*+\s*", "- ", text, flags=re.M)


def markdown_text(text: str) -> str:
    parts = re.split(r"(^\s{0,3}```.*?(?:^\s{0,3}```\s*$|\Z))", text, flags=re.M | re.S)
    for k in range(0, len(parts), 2):  # code blocks stay as they are
        p = parts[k]
        p = re.sub(r"^[ \t]*\|?(?:[ \t]*:?-{2,}:?[ \t]*\|)+(?:[ \t]*:?-{2,}:?[ \t]*)?$\n?", "", p, flags=re.M)
        p = re.sub(r"^[ \t]*\|(.*)\|[ \t]*$", lambda m: " | ".join(c.strip() for c in m.group(1).split("|")), p, flags=re.M)
        p = re.sub(r"^>\s?", "", p, flags=re.M)
        p = re.sub(r"!?\[([^\]\n]+)\]\([^)\n]*\)", r"\1", p)
        p = re.sub(r"\*\*([^*\n]+)\*\*|(?<![\w_])__([^_\n]+)__(?![\w_])", lambda m: m.group(1) or m.group(2), p)
        p = re.sub(r"(?<![\w_])_([^_\s\d][^_\n]{0,80})_(?![\w_])", r"\1", p)
        parts[k] = re.sub(r"(?<![\w*])\*([^*\s\d][^*\n]{0,80}[^*\s])\*(?![\w*])", r"\1", p)
    return "".join(parts)


def clean_text(text: str, kinds: list[str], winning: frozenset[str] | None = None) -> str:
    """The text of a value in the given dialects, with its structure as plain lines."""
    if not kinds:
        return text
    fence = re.fullmatch(r"\s*```\w*\n(.*?)\n?```\s*", text, re.S) if "html" in kinds else None
    if fence:
        text = fence.group(1)
    if "html" in kinds:
        text = html_text(text, winning) if TAG.search(text) else html.unescape(text)
        if TAG.search(text) and "\n```" not in text:  # markup that was escaped once more
            text = html_text(text)
    if "latex" in kinds:
        text = latex_text(text)
    if "wiki" in kinds:
        text = wiki_text(text)
    if "markdown" in kinds:
        text = markdown_text(text)
    text = text.replace("\xa0", " ")
    text = "\n".join(x.rstrip() for x in text.split("\n")) if "```" in text else "\n".join(re.sub(r"[ \t]+", " ", x).strip() if not re.match(r"\s+(?:-|\d+\.) ", x) else x.rstrip() for x in text.split("\n"))
    return re.sub(r"\n{3,}", "\n\n", text).strip()


# Spark


def values(blocks: DataFrame, vlm: DataFrame) -> DataFrame:
    """record_kind, record_id, field_name, host, value of the values that may hold markup. A block's host is what delivered it, a reading's its task."""
    one = blocks.select(F.lit("block").alias("record_kind"), F.col("block_id").alias("record_id"), F.lit("raw_content").alias("field_name"), F.coalesce("source", F.lit("")).alias("host"), F.col("raw_content").alias("value"))
    both = F.explode(F.array(F.struct(F.lit("html").alias("f"), F.col("html").alias("v")), F.struct(F.lit("latex").alias("f"), F.col("latex").alias("v"))))
    two = vlm.select("result_id", "task", both.alias("x")).select(F.lit("vlm").alias("record_kind"), F.col("result_id").alias("record_id"), F.col("x.f").alias("field_name"), F.concat(F.lit("vlm:"), F.coalesce("task", F.lit(""))).alias("host"), F.col("x.v").alias("value"))
    return one.unionByName(two).where("value is not null and value <> ''")


def _score_worker(batches):
    for batch in batches:
        total: dict[tuple[str, str], list] = defaultdict(lambda: [0.0, 0, 0])
        for host, value in zip(batch.column("host").to_pylist(), batch.column("value").to_pylist()):
            if "<" in value and TAG.search(value):
                for path, (score, n) in container_scores(value).items():
                    one = total[host, path]
                    one[0] += score
                    one[1] += n
                    one[2] += 1
        keys = list(total)
        yield pa.RecordBatch.from_arrays(
            [pa.array([k[0] for k in keys], pa.string()), pa.array([k[1] for k in keys], pa.string()), pa.array([total[k][0] for k in keys], pa.float64()), pa.array([total[k][1] for k in keys], pa.int64()), pa.array([total[k][2] for k in keys], pa.int64())],
            names=["host", "path", "score", "n_chars", "n_values"],
        )


def host_paths(texts: DataFrame, least_density: float = 0.5) -> DataFrame:
    """host, path, score, n_chars, n_values, winning of every generalised path, from votes combined batch by batch before the shuffle.

    A path wins if its text is mostly no link text: score at least ``least_density`` of its code points."""
    votes = texts.select("host", "value").mapInArrow(_score_worker, "host string, path string, score double, n_chars long, n_values long")
    total = votes.groupBy("host", "path").agg(F.sum("score").alias("score"), F.sum("n_chars").alias("n_chars"), F.sum("n_values").alias("n_values"))
    return total.withColumn("winning", F.col("score") >= F.col("n_chars") * least_density)


BROADCAST_BYTES = 16 << 20


def _paths_worker(batches):
    """The container paths of each HTML value."""
    names = ["record_kind", "record_id", "field_name", "host"]
    for batch in batches:
        rows, paths = [], []
        for k, value in enumerate(batch.column("value").to_pylist()):
            found = list(container_scores(value)) if "<" in value and TAG.search(value) else []
            rows += [k] * len(found)
            paths += found
        at = pa.array(rows, pa.int64())
        yield pa.RecordBatch.from_arrays([*(batch.column(c).take(at) for c in names), pa.array(paths, pa.string())], names=[*names, "path"])


def _extract_worker(batches):
    for batch in batches:
        out: list[tuple] = []
        columns = (batch.column(c).to_pylist() for c in ("record_kind", "record_id", "field_name", "value", "losing"))
        for kind, record, field, value, losing in zip(*columns):
            found = dialects(value)
            winning = None
            if losing and "html" in found:
                scores = container_scores(value)
                winning = frozenset(scores) - frozenset(losing)
                if sum(n for p, (_, n) in scores.items() if p in winning) < 0.5 * sum(n for _, n in scores.values()):
                    winning = None
            out.append((kind, record, field, ",".join(found), clean_text(value, found, winning)))
        names = ["record_kind", "record_id", "field_name", "dialects", "clean"]
        yield pa.RecordBatch.from_arrays([pa.array([x[k] for x in out], pa.string()) for k in range(5)], names=names)


def _with_losing_paths(texts: DataFrame, lost: DataFrame) -> DataFrame:
    """texts with losing, the losing paths that a value may hold: those of its host where all hosts' are measured to be at most BROADCAST_BYTES, else those of its own paths that lose."""
    lost = cut_lineage(lost.select("host", "path"))
    size = lost.agg(F.sum(F.length("host") + F.length("path") + 16)).first()[0] or 0
    if size <= BROADCAST_BYTES:
        return texts.join(F.broadcast(lost.groupBy("host").agg(F.collect_list("path").alias("losing"))), "host", "left")
    key = ["record_kind", "record_id", "field_name"]
    own = texts.select(*key, "host", "value").mapInArrow(_paths_worker, "record_kind string, record_id string, field_name string, host string, path string")
    own = own.join(lost, ["host", "path"], "left_semi").groupBy(*key).agg(F.collect_set("path").alias("losing"))  # of one value's paths
    return texts.join(own, key, "left")


def extracted(blocks: DataFrame, vlm: DataFrame) -> DataFrame:
    """record_kind, record_id, field_name, dialects, clean of every value, extracted with the winning paths of its host."""
    texts = values(blocks, vlm)
    joined = _with_losing_paths(texts, host_paths(texts).where("not winning")).select("record_kind", "record_id", "field_name", "value", "losing")
    return joined.mapInArrow(_extract_worker, "record_kind string, record_id string, field_name string, dialects string, clean string")


def values_with_markup(blocks: DataFrame, vlm: DataFrame) -> DataFrame:
    """Distinct (record_kind, record_id, field_name) of the values in which the operator found a markup language."""
    return extracted(blocks, vlm).where("dialects <> ''").select("record_kind", "record_id", "field_name").distinct()
