"""Problem 8: filling containers of fixed capacity with texts, measured in tokens of a public tokenizer.

Pattern packing. The histogram of lengths has at most ``capacity`` entries whatever the corpus, and is all that the driver gets.
Lengths are rounded up to classes (exact while short, then about one percent wide); patterns of a few documents that fill a container
closely are drawn from the histogram, each completed by the class that fits best; non-negative least squares fit how often each
pattern is repeated; the counts are rounded down, and what remains is packed best fit decreasing, into the gaps of patterns first. All
of this works on counts, so its cost doesn't grow with the corpus.

The plan says which ranks of a class go to which containers. A text's rank within its class comes from counts per class and salt and
the order within both; no task gets a whole class. A text longer than the capacity is cut into pieces of the capacity, whose last
shorter piece is packed like any other; no other text is cut. An empty or null text counts as one token.
"""

from __future__ import annotations

import base64
import functools

import numpy as np
import pyarrow as pa
from pyspark import SparkFiles
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from foliant.session import cut_lineage

CAPACITY = 4096
PATTERNS_PER_CLASS, MAX_DOCUMENTS = 16, 8
TOKENIZER = "byte_bpe_50k.tiktoken"


FOLDER = "/opt/tokenizers"  # where names without a folder are looked for; a parameter
# Fixed value: how the vocabulary's own tokenizer parts texts.
PATTERN = r"'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


def tokenizer_path(name: str = TOKENIZER, folder: str = FOLDER) -> str:
    """Where the vocabulary file is on the driver: as given if it is a path, else in the folder."""
    return name if "/" in name else f"{folder}/{name}"


def ship_tokenizer(spark: SparkSession, path: str) -> str:
    """Send the vocabulary file to the executors once per application; its name there."""
    name = path.rsplit("/", 1)[1]
    if (spark.sparkContext.applicationId, path) not in _sent:
        _sent.add((spark.sparkContext.applicationId, path))
        spark.sparkContext.addFile(path)
    return name


_sent: set[tuple[str, str]] = set()


@functools.lru_cache(4)
def _encoder(name: str):
    import tiktoken

    with open(SparkFiles.get(name), "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})


def _size_worker(name: str):
    def run(batches):
        encoder = _encoder(name)
        for batch in batches:
            sizes = [max(1, len(encoder.encode_ordinary(t))) if t else 1 for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(sizes, pa.int64())], names=["doc_id", "n_tokens"])

    return run


def token_sizes(documents: DataFrame, tokenizer: str = TOKENIZER) -> DataFrame:
    """doc_id, n_tokens."""
    kind = documents.schema["doc_id"].dataType.simpleString()
    return documents.select("doc_id", "text").mapInArrow(_size_worker(ship_tokenizer(documents.sparkSession, tokenizer_path(tokenizer))), f"doc_id {kind}, n_tokens long")


# the plan, in numpy on the driver


def class_bounds(capacity: int) -> np.ndarray:
    """Upper bounds of the length classes: exact up to 128, then about one percent apart; the last is the capacity."""
    bounds = list(range(1, min(capacity, 128) + 1))
    while bounds[-1] < capacity:
        bounds.append(min(capacity, bounds[-1] + max(1, bounds[-1] // 100)))
    return np.array(bounds, np.int64)


def nonnegative_least_squares(a: np.ndarray, h: np.ndarray, steps: int = 400) -> np.ndarray:
    """x >= 0 that makes |a x - h| small, by accelerated projected gradients."""
    gram, target = a.T @ a, a.T @ h
    step = 1.0 / max(1e-9, float(np.abs(gram).sum(axis=1).max()))
    x = np.zeros(a.shape[1])
    y, t = x.copy(), 1.0
    for _ in range(steps):
        new = np.maximum(0.0, y - step * (gram @ y - target))
        t_new = (1 + np.sqrt(1 + 4 * t * t)) / 2
        y = new + (t - 1) / t_new * (new - x)
        x, t = new, t_new
    return x


def enumerate_patterns(bounds: np.ndarray, counts: np.ndarray, capacity: int, seed: int = 7) -> list[tuple[tuple[int, int], ...]]:
    """Patterns ((class, copies), ...) of up to MAX_DOCUMENTS documents that leave under one percent of a container unused."""
    rng = np.random.default_rng(seed)
    live = np.flatnonzero(counts)
    if not len(live):
        return []
    share = counts[live] / counts[live].sum()
    found: dict[tuple, None] = {}
    for first in live:
        for _ in range(PATTERNS_PER_CLASS):
            content, room = {int(first): 1}, capacity - int(bounds[first])
            for drawn in rng.choice(live, MAX_DOCUMENTS, p=share):
                fit = int(np.searchsorted(bounds[live], room, "right")) - 1
                if fit < 0:
                    break
                best = int(live[fit])
                documents = sum(content.values())
                if room - bounds[best] <= capacity // 200 or documents >= MAX_DOCUMENTS - 1:
                    content[best] = content.get(best, 0) + 1
                    room -= int(bounds[best])
                    break
                if bounds[drawn] <= room:
                    content[int(drawn)] = content.get(int(drawn), 0) + 1
                    room -= int(bounds[drawn])
            if room <= capacity // 100:
                found[tuple(sorted(content.items()))] = None
    return list(found)


def plan(histogram: dict[int, int], capacity: int) -> list[tuple[list[tuple[int, int]], int]]:
    """Groups (contents, number of containers) of equal containers; contents are (class, copies) in slot order. Every counted length is placed."""
    bounds = class_bounds(capacity)
    counts = np.zeros(len(bounds), np.int64)
    for length, n in histogram.items():
        counts[np.searchsorted(bounds, length)] += n
    patterns = enumerate_patterns(bounds, counts, capacity)
    groups: list[tuple[list[tuple[int, int]], int]] = []
    left = counts.copy()
    if patterns:
        a = np.zeros((len(bounds), len(patterns)), np.float32)
        for p, content in enumerate(patterns):
            for c, k in content:
                a[c, p] = k
        weight = 1 / np.sqrt(counts + 1.0)
        repeats = nonnegative_least_squares((a * weight[:, None]).astype(np.float32), (counts * weight).astype(np.float32))
        for p in np.argsort(-repeats, kind="stable"):
            n = int(repeats[p])
            for c, k in patterns[p]:
                n = min(n, int(left[c]) // k)
            if n > 0:
                for c, k in patterns[p]:
                    left[c] -= n * k
                groups.append((list(patterns[p]), n))
    # best fit decreasing of the rest, in runs of equal containers; gaps of patterns are containers with little room
    open_: dict[int, list[tuple[list[tuple[int, int]], int]]] = {}
    for content, n in groups:
        open_.setdefault(capacity - int(sum(bounds[c] * k for c, k in content)), []).append((content, n))
    for c in range(len(bounds) - 1, -1, -1):
        rest, size = int(left[c]), int(bounds[c])
        while rest:
            room = min((r for r in open_ if r >= size), default=None)
            if room is None:
                content, n, room = [], -(-rest // (capacity // size)), capacity
            else:
                content, n = open_[room].pop()
                if not open_[room]:
                    del open_[room]
            most = min(room // size, rest)
            full = min(n, rest // most)
            open_.setdefault(room - most * size, []).append(([*content, (c, most)], full))
            rest -= full * most
            if n > full:
                if rest and rest < most:
                    open_.setdefault(room - rest * size, []).append(([*content, (c, rest)], 1))
                    n, rest = n - 1, 0
                if n > full and content:
                    open_.setdefault(room, []).append((content, n - full))
    return [(content, n) for _, some in sorted(open_.items()) for content, n in some if content and n]


class Placement:
    """The plan as sorted arrays: from (class, rank) to container and slot."""

    def __init__(self, groups: list[tuple[list[tuple[int, int]], int]], first: int = 0):
        entries, base = [], first
        taken: dict[int, int] = {}
        for content, n in groups:
            slot = 0
            for c, copies in content:
                start = taken.get(c, 0)
                taken[c] = start + copies * n
                entries.append((c, start, base, slot, copies))
                slot += copies
            base += n
        entries.sort()
        table = np.array(entries, np.int64).reshape(-1, 5)
        self.classes, self.start, self.base, self.slot, self.copies = table.T
        self.key, self.containers = (self.classes << 44) + self.start, base - first

    def of(self, classes: np.ndarray, ranks: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        at = np.searchsorted(self.key, (classes << 44) + ranks, "right") - 1
        inner = ranks - self.start[at]
        return self.base[at] + inner // self.copies[at], self.slot[at] + inner % self.copies[at]


# Spark


def _place_worker(placement: Placement):
    def run(batches):
        for batch in batches:
            classes, ranks = (batch.column(c).to_numpy(zero_copy_only=False).astype(np.int64) for c in ("class", "rank"))
            container, position = placement.of(classes, ranks)
            keep = [batch.column(c) for c in ("doc_id", "piece_no", "n_tokens")]
            yield pa.RecordBatch.from_arrays([*keep, pa.array(container), pa.array(position)], names=["doc_id", "piece_no", "n_tokens", "container_id", "position"])

    return run


def _class_worker(capacity: int):
    bounds = class_bounds(capacity)

    def run(batches):
        for batch in batches:
            sizes = batch.column("n_tokens").to_numpy(zero_copy_only=False)
            arrays = [batch.column(c) for c in ("doc_id", "piece_no", "n_tokens", "salt")]
            yield pa.RecordBatch.from_arrays([*arrays, pa.array(np.searchsorted(bounds, sizes).astype(np.int64))], names=["doc_id", "piece_no", "n_tokens", "salt", "class"])

    return run


def pack(documents: DataFrame, capacity: int = CAPACITY, tokenizer: str = TOKENIZER, rows_per_salt: int = 50_000) -> DataFrame:
    """doc_id, piece_no, n_tokens, container_id, position (order in the container from 0), start_token of every text or piece."""
    kind = documents.schema["doc_id"].dataType.simpleString()
    pieces = F.sequence(F.lit(0).cast("long"), F.floor((F.col("n_tokens") - 1) / capacity).cast("long"))
    items = token_sizes(documents, tokenizer).select("doc_id", F.col("n_tokens").alias("total"), F.explode(pieces).alias("piece_no"))
    items = cut_lineage(items.select("doc_id", "piece_no", F.least(F.lit(capacity).cast("long"), F.col("total") - F.col("piece_no") * capacity).alias("n_tokens")))
    histogram = {r.n_tokens: r.n for r in items.groupBy("n_tokens").agg(F.count("*").alias("n")).collect()}  # at most ``capacity`` rows
    placement = Placement(plan(histogram, capacity))
    salts = max(1, -(-sum(histogram.values()) // rows_per_salt))
    salted = items.withColumn("salt", F.pmod(F.xxhash64("doc_id", "piece_no"), F.lit(salts)))
    classed = salted.mapInArrow(_class_worker(capacity), f"doc_id {kind}, piece_no long, n_tokens long, salt long, class long")
    counts = classed.groupBy("class", "salt").agg(F.count("*").alias("n"))
    before = F.sum("n").over(Window.partitionBy("class").orderBy("salt").rowsBetween(Window.unboundedPreceding, -1))
    counts = counts.select("class", "salt", F.coalesce(before, F.lit(0)).alias("before"))
    inner = F.row_number().over(Window.partitionBy("class", "salt").orderBy("doc_id", "piece_no"))
    ranked = classed.withColumn("inner", inner).join(counts, ["class", "salt"]).withColumn("rank", F.col("before") + F.col("inner") - 1)
    placed = ranked.select("doc_id", "piece_no", "n_tokens", "class", "rank").mapInArrow(_place_worker(placement), f"doc_id {kind}, piece_no long, n_tokens long, container_id long, position long")
    earlier = F.sum("n_tokens").over(Window.partitionBy("container_id").orderBy("position").rowsBetween(Window.unboundedPreceding, -1))  # a container's own few texts
    return placed.withColumn("start_token", F.coalesce(earlier, F.lit(0)))


def fill(packed: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """n_containers, n_items, n_tokens, fill (share of the capacity that is used), fullest (tokens of the fullest container)."""
    one = packed.groupBy("container_id").agg(F.count("*").alias("n"), F.sum("n_tokens").alias("t"))
    out = one.agg(F.count("*").alias("n_containers"), F.coalesce(F.sum("n"), F.lit(0)).alias("n_items"), F.coalesce(F.sum("t"), F.lit(0)).alias("n_tokens"), F.coalesce(F.max("t"), F.lit(0)).alias("fullest"))
    return out.withColumn("fill", F.col("n_tokens") / (F.col("n_containers") * capacity))
