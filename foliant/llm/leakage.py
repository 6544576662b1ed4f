"""Problem 9: passages of evaluation items inside a training corpus.

A positional inverted index over runs of tokens (three words, five characters of Chinese), pruned while it is built: of the corpus' runs
those are kept that test items have, with document and position, and of a document's postings for an item only those that can still reach
the required share (half for evidence, nearly all for question and answer) within a band of shifts: a passage that covers share s of L
tokens in runs of n has at least s*L/n postings there. An index of every run would be many times the corpus.

The lists are intersected after subtracting each run's offset in its item: postings of one passage agree in that difference up to
small shifts, and fall into the same band (two overlapping sets of bands of BAND shifts, so that passages that drift by more than BAND / 2
tokens are only found by the part that doesn't). Where several bands of an item cover as much, the one with the rarer runs is taken. The
share of the item's tokens that a band covers decides. Full cover without a shift is an exact phrase.

Test items are few and fixed; they are taken to the workers in blocks of bounded size. Case, punctuation and line breaks don't
count; separators inside numbers are dropped. Null texts and empty items match nothing. Texts repeated under several ids are each
reported.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from foliant.session import cut_lineage

WORD_RUN, HAN_RUN = 3, 5
SHARE, FULL_SHARE = 0.5, 0.9
BAND = 16
SLICE_CHARS = 400_000
BLOCK_TOKENS = 400_000  # tokens of test items that go to the workers at once
_TOKEN = re.compile(r"[㐀-鿿豈-﫿]|[^\W_㐀-鿿豈-﫿]+")
_SEPARATOR = re.compile(r"(?<=\d)[.,，．](?=\d)")


def tokens(text: str | None) -> list[str]:
    """Lower-case words, numbers without separators, and single Chinese characters."""
    return _TOKEN.findall(_SEPARATOR.sub("", text.lower())) if text else []


def run_length(item: list[str]) -> int:
    """How many tokens a run of this item has: by whether most of its tokens are Chinese characters."""
    han = sum(len(t) == 1 and t >= "㐀" for t in item)
    return max(1, min(len(item), HAN_RUN if 2 * han > len(item) else WORD_RUN))


def _hash_runs(ids: np.ndarray, n: int) -> np.ndarray:
    total = np.zeros(max(0, len(ids) - n + 1), np.uint64)
    for k in range(n):
        total = (total ^ ids[k : k + len(total)].astype(np.uint64)) * np.uint64(0x100000001B3) + np.uint64(0x9E3779B97F4A7C15)
        total ^= total >> np.uint64(29)
    return total


def _token_hash(token: str) -> int:
    return xxhash.xxh64_intdigest(token) | 1  # 0 stands for tokens that no item has


class Block:
    """Some test items, ready for lookup: item numbers count from ``first``."""

    def __init__(self, items: list[list[str]], first: int, shares: list[float]):
        self.vocabulary = {t: _token_hash(t) for item in items for t in item}  # values, not numbers of a block: a run has one hash in all blocks
        by_n: dict[int, list[tuple[int, int, int]]] = {}
        least = []
        for number, item in enumerate(items):
            n = run_length(item)
            ids = np.array([self.vocabulary[t] for t in item], np.uint64)
            by_n.setdefault(n, []).extend((int(h), first + number, at) for at, h in enumerate(_hash_runs(ids, n)))
            least.append(max(1, int(np.ceil(shares[number] * len(item) / n - 1e-9))))
        self.first, self.least = first, np.array(least, np.int64)
        self.lists = {}
        for n, entries in by_n.items():
            entries.sort()
            h = np.array([e[0] for e in entries], np.uint64)
            keys, start = np.unique(h, return_index=True)
            self.lists[n] = (keys, np.append(start, len(h)), np.array([e[1] for e in entries], np.int64), np.array([e[2] for e in entries], np.int64))

    def postings(self, texts: list[str | None]) -> tuple[np.ndarray, ...]:
        """(row, item, offset, position, run hash) of the stored postings of some texts."""
        get = self.vocabulary.get
        ids, starts = [], [0]
        for text in texts:
            ids.extend([get(t, 0) for t in tokens(text)])
            starts.append(len(ids))
        ids, starts = np.array(ids, np.uint64), np.array(starts, np.int64)
        row = np.repeat(np.arange(len(texts)), np.diff(starts))
        out = []
        for n, (keys, begin, item, offset) in self.lists.items():
            h = _hash_runs(ids, n)
            if not len(h) or not len(keys):
                continue
            at = np.minimum(np.searchsorted(keys, h), len(keys) - 1)
            hit = np.flatnonzero((keys[at] == h) & (row[: len(h)] == row[n - 1 :]))
            count = begin[at[hit] + 1] - begin[at[hit]]
            entry = np.repeat(begin[at[hit]], count) + np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
            place = np.repeat(hit, count)
            out.append((row[place], item[entry], offset[entry], place - starts[row[place]], h[place].view(np.int64)))
        if not out:
            return tuple(np.zeros(0, np.int64) for _ in range(5))
        rows, items, offsets, places, runs = (np.concatenate(x) for x in zip(*out))
        pair = rows * (len(self.least) + 1) + (items - self.first)
        if not len(pair):
            return rows, items, offsets, places, runs
        span, shift = int(offsets.max()) + 1, places - offsets
        keep = np.zeros(len(pair), np.bool_)
        for lead in (0, BAND // 2):  # a posting stays if one of its two bands can reach the share
            band = (shift + lead) // BAND
            band -= band.min()
            key = pair * (int(band.max()) + 1) + band
            distinct = np.sort(key * span + offsets)
            distinct = distinct[np.append(True, distinct[1:] != distinct[:-1])] // span
            first = np.flatnonzero(np.append(True, distinct[1:] != distinct[:-1]))
            counts = np.diff(np.append(first, len(distinct)))
            keep |= counts[np.searchsorted(distinct[first], key)] >= self.least[items - self.first]
        return rows[keep], items[keep], offsets[keep], places[keep], runs[keep]


def _index_worker(block: Block):
    def run(batches):
        for batch in batches:
            sizes = np.cumsum(pc.fill_null(pc.utf8_length(batch.column("text")), 0).to_numpy(zero_copy_only=False))
            begin = 0
            while begin < len(batch):  # a slice of about SLICE_CHARS at a time: token lists take many times the text's memory
                done = sizes[begin - 1] if begin else 0
                end = max(begin + 1, int(np.searchsorted(sizes, done + SLICE_CHARS, "right")))
                part = batch.slice(begin, end - begin)
                rows, items, offsets, places, runs = block.postings(part.column("text").to_pylist())
                ids = part.column("doc_id").take(pa.array(rows))
                yield pa.RecordBatch.from_arrays([ids, pa.array(items), pa.array(offsets), pa.array(places), pa.array(runs)], names=["doc_id", "item", "offset", "position", "run"])
                begin = end

    return run


def _items(questions: DataFrame) -> list[tuple[str, str, list[str]]]:
    """(question id, part, tokens) of all parts of all test items, in a fixed order."""
    out = []
    for row in questions.select("id", "question", "expected_answer", "answer_evidence").distinct().orderBy("id", "question", "expected_answer", "answer_evidence").toLocalIterator():
        for part, text in (("evidence", row.answer_evidence), ("question", row.question), ("answer", row.expected_answer)):
            words = tokens(text)
            if words:
                out.append((row.id, part, words))
    return out


def build_index(documents: DataFrame, items: list[list[str]], shares: list[float]) -> DataFrame:
    """doc_id, item, offset, position, run: the postings, written once to the shared folder."""
    kind = documents.schema["doc_id"].dataType.simpleString()
    blocks, first, size = [], 0, 0
    for k, item in enumerate([*items, None]):
        if item is None or size + len(item) > BLOCK_TOKENS and k > first:
            if k > first:
                blocks.append(Block(items[first:k], first, shares[first:k]))
            first, size = k, 0
        size += len(item or ())
    index = None
    for block in blocks:
        part = documents.select("doc_id", "text").mapInArrow(_index_worker(block), f"doc_id {kind}, item long, offset long, position long, run long")
        index = part if index is None else index.unionByName(part)
    if index is None:
        index = documents.sparkSession.createDataFrame([], f"doc_id {kind}, item long, offset long, position long, run long")
    return cut_lineage(index)


def passage_matches(spark: SparkSession, documents: DataFrame, questions: DataFrame) -> DataFrame:
    """doc_id, question_id, part, share (of the part's tokens covered), position (of the first), exact_phrase; the best passage of each part."""
    items = _items(questions)
    index = build_index(documents, [words for _, _, words in items], [SHARE if part == "evidence" else FULL_SHARE for _, part, _ in items])
    about = spark.createDataFrame(
        [(k, q, part, len(words), run_length(words)) for k, (q, part, words) in enumerate(items)], "item long, question_id string, part string, n_tokens long, n long"
    )
    rarity = index.groupBy("run").agg((1 / F.count("*")).alias("weight"))
    hits = index.join(rarity, "run").select("doc_id", "item", "offset", "position", "weight", (F.col("position") - F.col("offset")).alias("shift"))
    bands = F.explode(F.array(F.floor(F.col("shift") / BAND) * 2, F.floor((F.col("shift") + BAND // 2) / BAND) * 2 + 1))
    # a band of one item in one document has at most as many offsets as the item has tokens
    voted = hits.withColumn("band", bands).groupBy("doc_id", "item", "band").agg(F.collect_set("offset").alias("offsets"), F.sum("weight").alias("votes"), F.min("position").alias("position"), (F.max("shift") - F.min("shift")).alias("drift"))
    covered = F.size(F.array_distinct(F.flatten(F.transform("offsets", lambda o: F.sequence(o, o + F.col("n") - 1)))))
    scored = voted.join(F.broadcast(about), "item").withColumn("share", covered / F.col("n_tokens"))  # one row for each part of the fixed test items
    best = Window.partitionBy("doc_id", "item").orderBy(F.desc("share"), F.desc("votes"), "position", "band")
    scored = scored.withColumn("place", F.row_number().over(best)).where("place = 1")
    return scored.select("doc_id", "question_id", "part", "share", "position", ((F.col("share") >= 1) & (F.col("drift") == 0)).alias("exact_phrase"))


def leaked(spark: SparkSession, documents: DataFrame, questions: DataFrame) -> DataFrame:
    """Distinct (doc_id, question_id): at least half of the evidence in one passage, or question and answer in full."""
    m = passage_matches(spark, documents, questions)
    evidence = m.where((F.col("part") == "evidence") & (F.col("share") >= SHARE)).select("doc_id", "question_id")
    both = m.where((F.col("part") != "evidence") & (F.col("share") >= FULL_SHARE)).groupBy("doc_id", "question_id").agg(F.count_distinct("part").alias("parts")).where("parts = 2")
    return evidence.unionByName(both.select("doc_id", "question_id")).distinct()
