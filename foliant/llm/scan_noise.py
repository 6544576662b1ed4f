"""Problem 1: noise in text from scanned pages.

A hidden Markov model labels the lines of a block as ``header`` (page furniture: running headers, page numbers, notices), ``body``
(goes on in the next line) or ``break`` (ends a paragraph) from layout features; Viterbi's path tells how to put paragraphs together.
Its tables start from stated pseudo-counts and are fitted on at most ``FIT_ROWS`` blocks (a documented bound) of which
resolved_content has a repaired reading: a line that is missing there is furniture, a line end that is missing there is body.

Misread, spaced-out and run-together words are found against counts over all blocks: words and, around characters that scans
confuse, character trigrams. Only entries with at least ``LEAST_SHARE`` of all counts go to the workers, so at most 1/LEAST_SHARE of
each kind, whatever the size of the tables.

Only blocks of type text and footnote are looked at. Null stays null, empty stays empty; a block delivered twice counts once in the
results. Blocks of one line have no line labels to find; a notice as first or last line is no damage.
"""

from __future__ import annotations

import math
import re
from collections import Counter

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from foliant.llm import markup
from foliant.llm.sampling import hash_sample

FIT_ROWS = 2000
LEAST_SHARE, LEAST_COUNT = 1e-5, 5
ITEM_PENALTY = 8.0
STATES = ("header", "body", "break")

# What scans confuse, as read and as meant.
LATIN_CONFUSIONS = "c:e 0:o 1:l 1:i !:i !:l 5:s q:g f:t b:h ii:u cl:d rn:m vv:w m:rn h:li e:c t:f l:i 6:b 8:b I:l |:l".split()
HAN_CONFUSIONS = "忆亿 旳的 日月 无元 入人 人入 未末 末未 木本 台合 攵收 彳行 钡银 欤款 冋同 太大 咸成 贷资 资贷 货贷 颌额 亚业 王至 李季 衣农 牛年 卷券 庹度 己已 士土 千干 干千 巳已 曰日 白自 目日 田由 间问 问间 天夭 夫天 刀力 厂广 第笫 笫第 鸟乌 乌鸟 侯候 侍待 折拆 拔拨 拨拔 洽治 冶治 纳钠 钠纳 朋明 晴睛 情惰 徙徒 戌戍 茶荼 析折 祖租 租祖 惜借 借惜 値值 淸清 汁计 讣计 汀订".split()
MEANT = {x[0]: x[1] for x in HAN_CONFUSIONS}
CENTRES = "".join(sorted({c for x in HAN_CONFUSIONS for c in x}))

HAN = "一-鿿㐀-䶿"
_WORD = re.compile(r"[A-Za-z]{2,}")
_TRIGRAM = re.compile(f"(?=(.?[{CENTRES}].?))")
_SPLIT_LETTERS = re.compile(rf"(?<!\S)[A-Za-z{HAN}0-9](?: [A-Za-z{HAN}0-9，。、；：.,%％()（）]){{4,}}(?!\S)|(?:[{HAN}，。、；：0-9.%] ){{5,}}[{HAN}，。、；：0-9.%]")
_MIXED = re.compile(r"\b[A-Za-z]*[a-z][0-9!][A-Za-z0-9!]*\b|\b[0-9!][a-z]{2,}[A-Za-z0-9!]*|\b[A-Z][0-9!][a-z]{2,}\w*")
_LOWER = re.compile(r"(?<![\w'’.@/\-])[A-Za-z]?[a-z]{3,}(?![\w'’@/])")
_PAGE_NUMBER = re.compile(r"[\s\-—–·•\[(<|]*(?:第\s*\d{1,4}\s*页|(?:page|p\.|p)?\s*\d{1,4}(?:\s*(?:/|of)\s*\d{1,4})?|[ivxlc]{1,6})[\s\-—–·•\])>|]*(?:页)?", re.I)
_ITEM = re.compile(r"\s*(?:[(（]\d{1,3}[)）]|\d{1,3}[.、)]\s|[-*+•·]\s|[①-⑳]|[(（][一二三四五六七八九十]+[)）])")
_END = re.compile(r"[。！？.!?；;：:][\"'”’」』）)\]]*$")
_SPACE = re.compile(r"\s+")


# the model


def features(lines: list[str]) -> list[tuple]:
    """Discrete layout features of the lines of a block that aren't blank: (position in lines, features)."""
    shown = [(k, line.strip(), line) for k, line in enumerate(lines) if line.strip()]
    lengths = sorted(len(s) for _, s, _ in shown)
    width = lengths[(3 * (len(lengths) - 1)) // 4] if lengths else 0
    near = sum(abs(x - width) <= 0.12 * width + 2 for x in lengths)
    prose = any(ch in s for _, s, _ in shown for ch in ",，。；;.%")  # addresses have no such sign
    frame = "wrapped" if prose and width <= 110 and len(lengths) >= 3 and near >= 0.55 * len(lengths) and width >= 12 else "narrow" if lengths and lengths[-1] <= 60 else "long"
    out = []
    for i, (k, s, line) in enumerate(shown):
        size = len(s) / max(1, width)
        following = shown[i + 1][1] if i + 1 < len(shown) else ""
        out.append((k, (
            frame,
            "page" if _PAGE_NUMBER.fullmatch(s) else "item" if _ITEM.match(s) else "label" if (" | " in s or "  " in s or re.search(rf"[A-Za-z{HAN}] ?\d{{1,4}}$", s)) and len(s) < 0.8 * width else "plain",
            "full" if size >= 0.8 else "mid" if size >= 0.45 else "short",
            "hyphen" if re.search(r"[\w，。%）)]-$", s) else "end" if _END.search(s) else "stray" if line != line.rstrip() else "open",
            "none" if not following else "low" if following[0].islower() or following[0] in "，。、；：）)%" else "digit" if following[0].isdigit() else "item" if _ITEM.match(following) and not _PAGE_NUMBER.fullmatch(following) else "other",
            ("first" if i == 0 else "last" if i == len(shown) - 1 else "inner") + ("-apart" if (k > 0 and not lines[k - 1].strip()) else ""),
        )))
    return out


# Pseudo-counts that the fit starts from, for each feature value by header, body, break.
PRIOR = {
    1: {"page": (60, 0.05, 0.3), "item": (0.2, 0.5, 40), "label": (40, 2, 10), "plain": (20, 100, 60)},
    2: {"full": (4, 100, 60), "mid": (30, 4, 30), "short": (40, 1, 30)},
    3: {"hyphen": (0.3, 30, 0.2), "end": (4, 8, 60), "stray": (6, 40, 6), "open": (60, 60, 12)},
    4: {"low": (10, 50, 1), "digit": (10, 20, 6), "item": (2, 0.2, 30), "none": (4, 0.02, 40), "other": (40, 50, 30)},
    5: {"first": (10, 12, 12), "last": (10, 0.05, 40), "inner": (30, 90, 20), "first-apart": (2, 1, 1), "last-apart": (8, 0.02, 20), "inner-apart": (30, 25, 15)},
}
FRAME_PRIOR = {"wrapped": (10, 100, 12), "narrow": (10, 3, 60), "long": (12, 1, 80)}
MOVE_PRIOR = {"header": (4, 60, 30), "body": (14, 80, 20), "break": (10, 40, 40)}


class LineModel:
    """The tables of the hidden Markov model, as logarithms."""

    def __init__(self, counts: Counter | None = None):
        counts = counts or Counter()
        frames = {v: [p + counts["f", 0, v, s] for s, p in enumerate(prior)] for v, prior in FRAME_PRIOR.items()}
        total = [sum(frames[v][s] for v in frames) for s in range(3)]
        self.frame = {v: [math.log(c / t) for c, t in zip(row, total)] for v, row in frames.items()}
        self.table = {}
        for place, prior in PRIOR.items():
            rows = {v: [p + counts["f", place, v, s] for s, p in enumerate(ps)] for v, ps in prior.items()}
            total = [sum(rows[v][s] for v in rows) for s in range(3)]
            self.table[place] = {v: [math.log(c / t) for c, t in zip(row, total)] for v, row in rows.items()}
        self.move = []
        for s, name in enumerate(STATES):
            row = [p + counts["m", s, t] for t, p in enumerate(MOVE_PRIOR[name])]
            self.move.append([math.log(x / sum(row)) for x in row])
        self.known: dict[tuple, list[float]] = {}

    def score(self, f: tuple) -> list[float]:
        if f not in self.known:
            row = [self.frame[f[0]][s] + sum(self.table[k][f[k]][s] for k in self.table) for s in range(3)]
            if f[4] == "item":  # whatever the fit has seen: a line before a list item ends its paragraph
                row[1] -= ITEM_PENALTY
            self.known[f] = row
        return self.known[f]

    def labels(self, found: list[tuple]) -> list[str]:
        """Viterbi's path over the lines of features()."""
        if not found:
            return []
        best, back = list(self.score(found[0][1])), []
        for _, f in found[1:]:
            e, chosen, new = self.score(f), [], []
            for t in range(3):
                s = max(range(3), key=lambda s: best[s] + self.move[s][t])
                chosen.append(s)
                new.append(best[s] + self.move[s][t] + e[t])
            back.append(chosen)
            best = new
        path = [max(range(3), key=best.__getitem__)]
        for chosen in reversed(back):
            path.append(chosen[path[-1]])
        return [STATES[s] for s in reversed(path)]


def _squash(text: str) -> str:
    return re.sub(r"[\s\-]+", "", text.lower())


def taught_labels(raw: str, repaired: str) -> list[tuple[tuple, int]]:
    """(features, state) of the lines of a block by its repaired reading; nothing if the two don't belong together."""
    lines, whole = raw.split("\n"), _squash(repaired)
    grams = {whole[k : k + 4] for k in range(len(whole) - 3)}
    found, out = features(lines), []
    parts = [_squash(lines[k]) for k, _ in found]
    shares = [sum(p[k : k + 4] in grams for k in range(len(p) - 3)) / max(1, len(p) - 3) if len(p) >= 4 else float(p in whole and not p.isdigit()) for p in parts]
    if not grams or sum(len(p) for p, x in zip(parts, shares) if x >= 0.4) < 0.6 * len(whole):
        return []
    for i, ((_, f), share) in enumerate(zip(found, shares)):
        following = next((parts[j] for j in range(i + 1, len(parts)) if shares[j] >= 0.4), "")
        state = 0 if share < 0.4 else 1 if following and (parts[i][-3:] + following[:3]) in whole and not re.search(re.escape(parts[i][-3:]) + r"\n", repaired.lower()) else 2
        out.append((f, state))
    return out


def fit(blocks: DataFrame, rows: int = FIT_ROWS) -> LineModel:
    """The line model, fitted on the ``rows`` blocks of several lines with a repaired reading whose hashed id is least."""
    taught = blocks.where("block_type in ('text', 'footnote') and raw_content <> resolved_content and resolved_content <> '' and instr(raw_content, '\n') > 0")
    taught = hash_sample(taught.select("block_id", "raw_content", "resolved_content"), "block_id", rows)
    counts: Counter = Counter()
    for row in taught.collect():  # at most ``rows``
        if markup.dialects(row.raw_content):
            continue
        last = None
        for f, s in taught_labels(row.raw_content, row.resolved_content):
            for place, value in enumerate(f):
                counts["f", place, value, s] += 1
            if last is not None:
                counts["m", last, s] += 1
            last = s
    return LineModel(counts)


# counts over all blocks


def _masked(text: str) -> str:
    return re.sub(r"[\d.,]*\d", "#", text)


def _count_worker(batches):
    for batch in batches:
        words: Counter = Counter()
        grams: Counter = Counter()
        for text in batch.column("raw_content").to_pylist():
            if not text:
                continue
            if text.isascii():
                words.update(w.lower() for w in _WORD.findall(text))
                continue
            words.update(w.lower() for w in _WORD.findall(text))
            grams.update(g for g in _TRIGRAM.findall(_masked(text)) if len(g) == 3)
        keys = [*words, *grams]
        kinds = ["w"] * len(words) + ["g"] * len(grams)
        yield pa.RecordBatch.from_arrays([pa.array(kinds, pa.string()), pa.array(keys, pa.string()), pa.array([*words.values(), *grams.values()], pa.int64())], names=["kind", "entry", "n"])


def respelled(form: str) -> set[str]:
    """What a form becomes by one confusion, at one place or at all places."""
    out = set()
    for pair in LATIN_CONFUSIONS:
        seen, meant = pair.split(":")
        at = form.find(seen)
        if at >= 0:
            out.add(form.replace(seen, meant))
        while at >= 0:
            out.add(form[:at] + meant + form[at + len(seen) :])
            at = form.find(seen, at + 1)
    return out


class Lexicon:
    """Frequent words and trigrams."""

    def __init__(self, words: dict[str, int], grams: dict[str, int]):
        self.words, self.grams = words, grams
        self.known: dict[str, str | None] = {}
        self.longest = max(map(len, words), default=0)

    def meant_word(self, token: str) -> str | None:
        """The frequent word that a token was misread or run together from (words then apart), or None."""
        if token not in self.known:
            if len(self.known) > 200_000:
                self.known.clear()
            self.known[token] = self._meant_word(token)
        return self.known[token]

    def _meant_word(self, token: str) -> str | None:
        """One confusion is tried before two. Each halves a form's length at most, so that tokens of over four times the longest word need no look; nor, to be put apart into six words, those of over six times."""
        low = token.lower()
        if low in self.words:
            return None
        forms = {low} if len(low) <= 4 * self.longest else set()
        for _ in range(2):
            forms = set().union(*map(respelled, forms))
            hit = [w for w in forms if w in self.words and len(w) >= 3]
            if hit:
                word = max(hit, key=lambda w: (self.words[w], w))
                return word.capitalize() if token[:1].isupper() else word
        return self._apart(low) if 6 <= len(low) <= 6 * self.longest and low.isalpha() else None

    def _apart(self, low: str) -> str | None:
        best: list[tuple[int, list[str]] | None] = [None] * (len(low) + 1)
        best[0] = (0, [])
        for j in range(2, len(low) + 1):
            for i in range(max(0, j - 16), j - 1):
                if best[i] is not None and low[i:j] in self.words and (best[j] is None or best[i][0] + 1 < best[j][0]):
                    best[j] = (best[i][0] + 1, [*best[i][1], low[i:j]])
        found = best[len(low)]
        if found is None or not 2 <= found[0] <= 6 or max(map(len, found[1])) < 4 or sum(len(w) == 2 for w in found[1]) > 2 or min(self.words[w] for w in found[1]) < 20:
            return None
        return " ".join(found[1])

    def misread_han(self, text: str) -> list[tuple[int, str]]:
        """(place, meant character) of characters whose surroundings are frequent with the other character only; digits are masked."""
        out = []
        for m in _TRIGRAM.finditer(text):
            g = m.group(1)
            if len(g) != 3 or g[1] not in MEANT:
                continue
            other = self.grams.get(g[0] + MEANT[g[1]] + g[2], 0)
            if other >= 20 and other > 20 * self.grams.get(g, 0):
                out.append((m.start(1) + 1, MEANT[g[1]]))
        return out


def lexicon(blocks: DataFrame) -> Lexicon:
    """Counts over all text and footnote blocks; combined in each batch before the shuffle, at most 1/LEAST_SHARE entries a kind come back."""
    rows = blocks.where("block_type in ('text', 'footnote')").select("raw_content")
    counted = rows.mapInArrow(_count_worker, "kind string, entry string, n long").groupBy("kind", "entry").agg(F.sum("n").alias("n"))
    total = counted.groupBy("kind").agg(F.sum("n").alias("total"))
    kept = counted.join(F.broadcast(total), "kind").where(F.col("n") >= F.greatest(F.lit(LEAST_COUNT), F.col("total") * LEAST_SHARE))  # total has two rows
    words: dict[str, int] = {}
    grams: dict[str, int] = {}
    for row in kept.select("kind", "entry", "n").toLocalIterator():
        (words if row.kind == "w" else grams)[row.entry] = row.n
    return Lexicon(words, grams)


# damage and repair


def word_faults(text: str, words: Lexicon) -> list[tuple[int, int, str]]:
    """(start, end, meant) of misread, spaced-out and run-together words."""
    out = []
    for m in _SPLIT_LETTERS.finditer(text):
        if sum(ch.isalpha() for ch in m.group()) >= 4:
            out.append((m.start(), m.end(), m.group().replace(" ", "")))
    if re.search(r"[a-z]", text):
        for m in _MIXED.finditer(text):
            token = m.group()
            if sum(ch.islower() for ch in token) >= 2 and not re.search(r"[A-Z].*[A-Z]|\d{3}", token):
                meant = words.meant_word(token)
                if meant or sum(ch.islower() for ch in token) >= 4:
                    out.append((m.start(), m.end(), meant or token))
        for m in _LOWER.finditer(text):
            low = m.group()
            if low.lower() not in words.words and low[0].islower():
                meant = words.meant_word(low)
                if meant:
                    out.append((m.start(), m.end(), meant))
    if not text.isascii():
        flat = re.sub(r"\d", "#", text)
        joined = words.misread_han(re.sub(r"#[#.,]*", lambda m: m.group()[:-1].replace("#", "\x01").replace(".", "\x01").replace(",", "\x01") + "#" if m.group()[-1] == "#" else m.group(), flat))
        out.extend((at, at + 1, meant) for at, meant in joined)
    return sorted(out)


def damage(text: str | None, model: LineModel, words: Lexicon) -> list[str]:
    """Which kinds of scanning damage a block's text has: 'furniture', 'broken lines', 'words'."""
    if not text or not text.strip():
        return []
    kinds = []
    if "\n" in text and not markup.dialects(text):
        lines = text.split("\n")
        found = features(lines)
        labels = model.labels(found)
        body = [i for i, x in enumerate(labels) if x == "body"]
        if found and found[0][1][0] == "wrapped" and body:
            kinds.append("broken lines")
        inner = [i for i in range(1, len(labels) - 1) if labels[i] == "header" and "body" in labels[:i] and any(x != "header" for x in labels[i + 1 :])]
        if inner:
            kinds.append("furniture")
    if word_faults(text, words):
        kinds.append("words")
    return kinds


def repair(text: str | None, model: LineModel, words: Lexicon) -> str | None:
    """The text as continuous paragraphs, parted by blank lines; markup, lists and addresses keep their lines."""
    if not text:
        return text
    if "\n" not in text or markup.dialects(text):
        return _mend(text, words)
    lines = text.split("\n")
    found = features(lines)
    labels = model.labels(found)
    paragraphs, current = [], ""
    wrapped = bool(found) and found[0][1][0] == "wrapped"
    for i, ((k, f), label) in enumerate(zip(found, labels)):
        line = _SPACE.sub(" ", lines[k]).strip()
        if label == "header":
            if wrapped and 0 < i < len(found) - 1 or f[1] == "page":
                continue  # furniture between the lines of the text
            if current:
                paragraphs.append(current)
                current = ""
            paragraphs.append(line)
            continue
        current = _join(current, line, words) if current else line
        if label == "break" or not (wrapped or f[3] in ("hyphen", "stray")):
            paragraphs.append(current)
            current = ""
    if current:
        paragraphs.append(current)
    listed = not wrapped
    return _mend(("\n" if listed else "\n\n").join(paragraphs), words)


def _join(a: str, b: str, words: Lexicon) -> str:
    han = re.compile(rf"[{HAN}，。、；：（）%％0-9]")
    if a.endswith("-"):
        left, right = re.search(r"[A-Za-z]+$", a[:-1]), re.match(r"[A-Za-z]+", b)
        if left and right:
            joined = (left.group() + right.group()).lower()
            keep = joined not in words.words and left.group().lower() in words.words and right.group().lower() in words.words
            return a + b if keep else a[:-1] + b
        if han.match(b[:1]) or (a[-2:-1] and han.match(a[-2])):
            return a[:-1] + b
    if not a.isascii() and (han.match(a[-1:]) or han.match(b[:1])) and not (a[-1:].isascii() and a[-1:].isalpha() and b[:1].isascii() and b[:1].isalpha()):
        return a + b
    return f"{a} {b}"


def _mend(text: str, words: Lexicon) -> str:
    out, at = [], 0
    for start, end, meant in word_faults(text, words):
        if start >= at:
            out += [text[at:start], meant]
            at = end
    return "".join(out) + text[at:]


def _found_worker(model: LineModel, words: Lexicon):
    def run(batches):
        for batch in batches:
            ids, kinds = [], []
            for block, text in zip(batch.column("block_id").to_pylist(), batch.column("raw_content").to_pylist()):
                found = damage(text, model, words)
                if found:
                    ids.append(block)
                    kinds.append(",".join(found))
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.string()), pa.array(kinds, pa.string())], names=["block_id", "kinds"])

    return run


def damaged_blocks(blocks: DataFrame) -> DataFrame:
    """Distinct (block_id, kinds) of the text and footnote blocks with scanning damage."""
    model, words = fit(blocks), lexicon(blocks)
    rows = blocks.where("block_type in ('text', 'footnote')").select("block_id", "raw_content")
    return rows.mapInArrow(_found_worker(model, words), "block_id string, kinds string").distinct()


def _repair_worker(model: LineModel, words: Lexicon):
    def run(batches):
        for batch in batches:
            mended = [repair(t, model, words) for t in batch.column("raw_content").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("block_id"), pa.array(mended, pa.string())], names=["block_id", "repaired"])

    return run


def repaired_blocks(blocks: DataFrame) -> DataFrame:
    """block_id and repaired text of every text and footnote block, one row per id."""
    model, words = fit(blocks), lexicon(blocks)
    rows = blocks.where("block_type in ('text', 'footnote')").select("block_id", "raw_content")
    return rows.mapInArrow(_repair_worker(model, words), "block_id string, repaired string").dropDuplicates(["block_id"])
