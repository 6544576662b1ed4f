"""Problem 2: near-duplicate records with small edits.

One-permutation hashing: each text's shingles (substrings of 5 characters of the lower-cased text with single spaces) are hashed
once, the hash range is cut into bins and the least value of each bin is kept; empty bins take the value of another bin, chosen by a
2-universal hash of bin and attempt until it isn't empty (optimal densification). Bands of bins give buckets. In a bucket, all
members are compared by their sketches. Hot buckets are cut into runs by a salt of the class, runs into blocks of ``BLOCK`` members, and
each pair of blocks is compared by itself, wherever that may be: no task holds more than two blocks, and only pairs whose sketches
agree leave it. An exact comparison of the shingle sets follows.

Exact copies are one class before anything is hashed into buckets: a class of any size is one member of its buckets.

The pairs of ids come last. Classes of up to ``FULL`` copies are expanded; of a larger class, only the smallest id stands for it in
links to other texts, and each other copy is linked to that id.

Null and short texts (under ``MIN_CHARS``) take no part. Rows delivered twice count once per id.
"""

from __future__ import annotations

import functools

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from foliant.llm import codepoints as cps
from foliant.session import cut_lineage

MIN_CHARS, SHINGLE, THRESHOLD = 200, 5, 0.7
BINS, ROWS = 384, 6
BANDS = BINS // ROWS
SKETCH_LEAST = 42  # of 64 equal bits; texts at the threshold have 54 on average, unrelated ones 35
BLOCK, FULL = 1 << 15, 64
PLANNED = 64  # one class in so many is looked at to plan how hot buckets are cut; the results don't depend on it
BROADCAST_BYTES = 16 << 20
EMPTY = np.uint64(0xFFFFFFFFFFFFFFFF)
WHITE_SPACE = "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f\x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"


def _mix(x: np.ndarray) -> np.ndarray:
    """splitmix64's finaliser."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


@functools.cache
def _detours() -> np.ndarray:
    """The bin that an empty bin asks at each attempt."""
    attempts, bins = np.meshgrid(np.arange(1, 65, dtype=np.uint64), np.arange(BINS, dtype=np.uint64), indexing="ij")
    return (_mix(attempts * np.uint64(0x9E3779B97F4A7C15) + bins * np.uint64(0xD1342543DE82EF95)) % np.uint64(BINS)).astype(np.int64)


def shingle_hashes(points: np.ndarray, starts: np.ndarray, size: int = SHINGLE) -> tuple[np.ndarray, np.ndarray]:
    """Hash and row of each shingle."""
    n = len(points) - size + 1
    if n <= 0:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    total = np.zeros(n, np.uint64)
    for k in range(size):
        total = total * np.uint64(0x100000001B3) + points[k : k + n].astype(np.uint64)
    row = np.repeat(np.arange(len(starts) - 1), np.diff(starts))[:n]
    inside = np.arange(n) + size <= starts[row + 1]
    return _mix(total[inside] * np.uint64(0x9E3779B97F4A7C15)), row[inside]


def signatures(points: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """(rows, BINS) densified one-permutation signatures; a row without shingles is EMPTY throughout."""
    hashes, row = shingle_hashes(points, starts)
    sig = np.full((len(starts) - 1) * BINS, EMPTY, np.uint64)
    place = ((hashes >> np.uint64(32)) * np.uint64(BINS) >> np.uint64(32)).astype(np.int64)
    np.minimum.at(sig, row * BINS + place, _mix(hashes) >> np.uint64(8))
    sig = sig.reshape(-1, BINS)
    full = sig != EMPTY
    some = full.any(axis=1)
    want_row, want_bin = np.nonzero(~full & some[:, None])
    out = sig.copy()
    for asked in _detours():
        if not len(want_row):
            break
        source = asked[want_bin]
        has = full[want_row, source]
        out[want_row[has], want_bin[has]] = sig[want_row[has], source[has]]
        want_row, want_bin = want_row[~has], want_bin[~has]
    if len(want_row):  # after many attempts: the row's first full bin, the same for equal rows
        out[want_row, want_bin] = sig[want_row, full[want_row].argmax(axis=1)]
    return out


def band_hashes(sig: np.ndarray) -> np.ndarray:
    """(rows, BANDS) bucket numbers."""
    parts = sig[:, : BANDS * ROWS].reshape(-1, BANDS, ROWS)
    total = np.broadcast_to(np.arange(BANDS, dtype=np.uint64), parts.shape[:2]).copy()
    for k in range(ROWS):
        total = _mix(total * np.uint64(0x9E3779B97F4A7C15) + parts[:, :, k])
    return total


def sketches(sig: np.ndarray) -> np.ndarray:
    """One bit of each of 64 bins in one number per row."""
    bits = (_mix(sig[:, :: BINS // 64][:, :64]) & np.uint64(1)) << np.arange(64, dtype=np.uint64)
    return np.bitwise_or.reduce(bits, axis=1)


def _band_worker(batches):
    """The classes of a batch, each once however many copies it has, in their buckets."""
    for batch in batches:
        column = batch.column("norm")
        classes = batch.column("class").to_numpy(zero_copy_only=False)
        classes, first = np.unique(classes, return_index=True)
        points, starts = cps.explode(column.take(pa.array(first)))
        side = batch.column("side").to_numpy(zero_copy_only=False)[first]
        for a in range(0, len(classes), 2048):
            s = starts[a : a + 2049]
            sig = signatures(points[s[0] : s[-1]], s - s[0])
            some = sig[:, 0] != EMPTY
            sig = sig[some]
            buckets = _mix(band_hashes(sig) ^ side[a : a + 2048][some].view(np.uint64)[:, None])
            yield pa.RecordBatch.from_arrays(
                [pa.array(buckets.reshape(-1).view(np.int64)), pa.array(np.repeat(classes[a : a + 2048][some], BANDS)), pa.array(np.repeat(sketches(sig).view(np.int64), BANDS))], names=["bucket", "class", "sketch"]
            )


def records(df: DataFrame, kind: str, id_column: str, field: str) -> DataFrame:
    """record_kind, id, norm, class (a 64-bit hash of kind and normalised text) of the records that take part."""
    rows = df.where((F.col("block_type") == "text") & (F.length(field) >= MIN_CHARS) & F.col(id_column).isNotNull())
    plain = F.translate(F.lower(field), WHITE_SPACE, " " * len(WHITE_SPACE))
    norm = F.trim(F.when(plain.contains("  "), F.regexp_replace(plain, "  +", " ")).otherwise(plain))
    rows = rows.select(F.lit(kind).alias("record_kind"), F.col(id_column).alias("id"), norm.alias("norm"))
    return rows.withColumn("class", F.xxhash64("record_kind", "norm"))


def _agree(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    return np.bitwise_count((~(x ^ y)).view(np.uint64)) >= SKETCH_LEAST


def _bucket_worker(batches, block: int):
    """Rows sorted by run (a bucket, or a salted part of a hot one) and class: the pairs of different rows of a block of a run whose sketches agree (a, b, -1, 0), and each row of
    a bucket of several runs or blocks (bucket, class, its block, sketch). Only the open block is held."""
    names = ("run", "bucket", "salt", "salts", "class", "sketch")
    carried, base = {c: np.zeros(0, np.int64) for c in names}, 0  # the open block, and the place of its first row in its run
    for batch in batches:
        k = len(carried["run"])
        all_ = {c: np.concatenate([carried[c], batch.column(c).to_numpy(zero_copy_only=False)]) for c in names}
        fresh = np.ones(len(all_["run"]), np.bool_)  # equal rows are neighbours
        fresh[1:] = (all_["run"][1:] != all_["run"][:-1]) | (all_["class"][1:] != all_["class"][:-1])
        all_ = {c: all_[c][fresh] for c in names}
        runs, n = all_["run"], len(all_["run"])
        if not n:
            continue
        head = np.ones(n, np.bool_)
        head[1:] = runs[1:] != runs[:-1]
        first, run = np.flatnonzero(head), np.cumsum(head) - 1
        place = np.arange(n) - first[run]
        if k:
            place[run == 0] += base
        a, b, number, sketch = [], [], [], []
        new, distance = np.arange(k, n), 1
        while len(new := new[place[new] % block >= distance]):
            y = new[_agree(all_["sketch"][new], all_["sketch"][new - distance])]
            one, two = all_["class"][y], all_["class"][y - distance]
            a.append(np.minimum(one, two))
            b.append(np.maximum(one, two))
            number.append(np.full(len(y), -1))
            sketch.append(np.zeros(len(y), np.int64))
            distance += 1
        whole = all_["salts"][k:] == 1
        over = np.arange(k, n)[(place[k:] >= block) | ~whole]
        for start in over[(place[over] == block) & (all_["salts"][over] == 1)]:  # the first block of a bucket in one run is known to need others only now
            over = np.append(over, np.arange(start - block, start))
        a.append(all_["bucket"][over])
        b.append(all_["class"][over])
        number.append((all_["salt"][over] << 32) + place[over] // block)
        sketch.append(all_["sketch"][over])
        a, b, number, sketch = map(np.concatenate, (a, b, number, sketch))
        yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b), pa.array(number, pa.int64()), pa.array(sketch)], names=["a", "b", "block", "sketch"])
        at = n - 1 - int(place[-1] % block)
        base, carried = int(place[-1] - place[-1] % block), {c: all_[c][at:] for c in names}


def _cross_worker(batches):
    """Rows sorted by bucket, pair of blocks (i, j) and block: each row of block j is compared with the rows of block i, which are held."""
    group, left = None, None
    for batch in batches:
        columns = {c: batch.column(c).to_numpy(zero_copy_only=False) for c in ("bucket", "i", "j", "block", "class", "sketch")}
        n, a, b = batch.num_rows, [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
        change = np.zeros(n, np.bool_)
        for c in ("bucket", "i", "j", "block"):
            change[1:] |= columns[c][1:] != columns[c][:-1]
        cuts = [0, *np.flatnonzero(change).tolist(), n] if n else []
        for start, end in zip(cuts, cuts[1:]):
            now = tuple(int(columns[c][start]) for c in ("bucket", "i", "j"))
            classes, sketch = columns["class"][start:end], columns["sketch"][start:end]
            if now != group:
                group, left = now, (np.zeros(0, np.int64), np.zeros(0, np.int64))
            if columns["block"][start] == now[1]:
                left = tuple(map(np.concatenate, zip(left, (classes, sketch))))
                continue
            for k in range(0, len(classes), 256):
                x, y = np.nonzero(_agree(left[1][:, None], sketch[None, k : k + 256]))
                a.append(np.minimum(left[0][x], classes[k + y]))
                b.append(np.maximum(left[0][x], classes[k + y]))
        yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(a)), pa.array(np.concatenate(b))], names=["a", "b"])


def _banded(texts: DataFrame) -> DataFrame:
    return texts.select("class", "norm", F.xxhash64("record_kind").alias("side")).mapInArrow(_band_worker, "bucket long, class long, sketch long")


def hot_buckets(texts: DataFrame, block: int = BLOCK, planned: int = PLANNED) -> DataFrame:
    """bucket, salts of the buckets that are likely to hold more than a block: into how many runs to cut them, from a count over one class in ``planned``."""
    seen = _banded(texts.where(F.pmod("class", F.lit(planned)) == 0)).groupBy("bucket").agg(F.count_distinct("class").alias("n"))
    return seen.where(F.col("n") * planned > block).select("bucket", F.ceil(F.col("n") * planned / block).cast("long").alias("salts"))


def candidate_edges(texts: DataFrame, block: int = BLOCK, planned: int = PLANNED) -> DataFrame:
    """Distinct (a, b) of classes, a < b, that share a bucket and whose sketches agree; written to the shared folder."""
    bands = _banded(texts)
    hot = cut_lineage(hot_buckets(texts, block, planned))
    n_hot = hot.count()
    if n_hot:
        bands = bands.join(F.broadcast(hot) if 32 * n_hot <= BROADCAST_BYTES else hot, "bucket", "left").fillna(1, ["salts"])
    else:
        bands = bands.withColumn("salts", F.lit(1).cast("long"))
    bands = bands.withColumn("salt", F.pmod(F.xxhash64("class"), F.col("salts"))).withColumn("run", F.when(F.col("salts") > 1, F.xxhash64("bucket", "salt")).otherwise(F.col("bucket")))
    runs = bands.select("run", "bucket", "salt", "salts", "class", "sketch") if n_hot else bands.select(F.col("bucket").alias("run"), "class", "sketch")
    runs = runs.repartition("run").sortWithinPartitions("run", "class")
    if not n_hot:  # the columns that say nothing here don't go through the shuffle
        runs = runs.select("run", F.col("run").alias("bucket"), F.lit(0).cast("long").alias("salt"), F.lit(1).cast("long").alias("salts"), "class", "sketch")
    seen = cut_lineage(runs.mapInArrow(lambda batches: _bucket_worker(batches, block), "a long, b long, block long, sketch long").distinct())
    edges = seen.where("block < 0").select("a", "b")
    over = seen.where("block >= 0").select(F.col("a").alias("bucket"), F.col("b").alias("class"), "block", "sketch")
    if not over.take(1):
        return edges
    others = over.select("bucket", F.col("block").alias("other")).distinct()
    pairs = over.join(others, "bucket").where("other <> block")
    pairs = pairs.select("bucket", F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"), "block", "class", "sketch")
    crossed = pairs.repartition("bucket", "i", "j").sortWithinPartitions("bucket", "i", "j", "block").mapInArrow(_cross_worker, "a long, b long")
    return cut_lineage(edges.unionByName(crossed).distinct())


def jaccard(a: str, b: str, size: int = SHINGLE) -> float:
    """The similarity of two normalised texts."""
    x, y = ({t[i : i + size] for i in range(len(t) - size + 1)} for t in (a, b))
    return len(x & y) / len(x | y) if x or y else 0.0


def _verify_worker(batches):
    for batch in batches:
        found = []
        for a, b in zip(batch.column("ta").to_pylist(), batch.column("tb").to_pylist()):
            m, n = sorted((len(a) - SHINGLE + 1, len(b) - SHINGLE + 1))
            x = {a[i : i + SHINGLE] for i in range(len(a) - SHINGLE + 1)}
            y = {b[i : i + SHINGLE] for i in range(len(b) - SHINGLE + 1)} if m > 0 else set()
            found.append(bool(x and y) and len(x & y) >= THRESHOLD * len(x | y) - 1e-12)
        keep = pa.array(found, pa.bool_())
        yield pa.RecordBatch.from_arrays([batch.column(c).filter(keep) for c in ("a", "b")], names=["a", "b"])


def verified(edges: DataFrame, texts: DataFrame, every: DataFrame) -> DataFrame:
    """The edges whose texts are similar enough by exact comparison. Only the texts of classes with an edge move: that of the smallest id of each, so that a class of many copies is no hot key."""
    needed = edges.select(F.explode(F.array("a", "b")).alias("class")).distinct()
    heads = cut_lineage(every.where(F.col("id") == F.col("head")).select("id", "class").join(needed, "class", "left_semi").select("id"))
    size = heads.agg(F.sum(F.length("id") + 16)).first()[0] or 0
    if size <= BROADCAST_BYTES:  # else Spark's own choice, by shuffle where it must
        heads = F.broadcast(heads)
    own = texts.select("id", "class", "norm").join(heads, "id", "left_semi").select("class", "norm").dropDuplicates(["class"])
    a, b = (own.select(F.col("class").alias(s), F.col("norm").alias(f"t{s}")) for s in "ab")
    return edges.join(a, "a").join(b, "b").mapInArrow(_verify_worker, "a long, b long")


def class_links(texts: DataFrame, every: DataFrame) -> DataFrame:
    """Distinct (a, b), a < b: the pairs of classes (different texts) that are similar; written to the shared folder."""
    return cut_lineage(verified(candidate_edges(texts), texts, every))


def members(texts: DataFrame) -> DataFrame:
    """record_kind, id, class, n (copies of the class), head (its smallest id); one row per id."""
    ids = cut_lineage(texts.select("record_kind", "id", "class").distinct())
    size = ids.groupBy("class").agg(F.count("*").alias("n"), F.min("id").alias("head"))
    return ids.join(size, "class")


def similar_pairs(texts: DataFrame) -> DataFrame:
    """Distinct (record_kind, id_a, id_b), id_a < id_b, of the similar records."""
    every = members(texts)
    links = class_links(texts, every)
    who = every.where((F.col("n") <= FULL) | (F.col("id") == F.col("head")))
    a = who.select("record_kind", F.col("id").alias("x"), F.col("class").alias("a"))
    b = who.select(F.col("id").alias("y"), F.col("class").alias("b"))
    between = links.join(a, "a").join(b, "b").select("record_kind", F.least("x", "y").alias("id_a"), F.greatest("x", "y").alias("id_b"))
    small = every.where((F.col("n") > 1) & (F.col("n") <= FULL))
    within = small.select("record_kind", F.col("id").alias("id_a"), "class").join(small.select(F.col("id").alias("id_b"), "class"), "class").where("id_a < id_b")
    large = every.where((F.col("n") > FULL) & (F.col("id") > F.col("head"))).select("record_kind", F.col("head").alias("id_a"), F.col("id").alias("id_b"))
    return between.unionByName(within.select("record_kind", "id_a", "id_b")).unionByName(large).distinct()


def components(edges: DataFrame) -> DataFrame:
    """node, root (the least node that links reach) of every node of the edges (a, b), by alternating large-star and small-star steps until nothing changes; each is written to the shared folder.

    The steps needed grow with the square of the logarithm of the nodes at most, so there is no bound to stop at."""
    edges, before = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a <> b").distinct(), None
    while True:
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("m", "a").alias("m"))
        large = both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(least, "a").select(F.explode(F.array(F.struct(F.col("a").alias("a"), F.col("m").alias("b")), F.struct(F.col("b").alias("a"), F.col("m").alias("b")))).alias("e")).select("e.a", "e.b")
        edges = cut_lineage(small.where("a <> b").distinct())
        now = edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if now == before:
            return edges.select(F.col("a").alias("node"), F.col("b").alias("root"))
        before = now


def groups(texts: DataFrame) -> DataFrame:
    """record_kind, id, class (of equal texts), head (the class's smallest id), group_id (smallest id among the records that links reach), n_links (links of its text to different texts); one row per id.

    With the links of heads in similar_pairs these rows give every link of every copy."""
    every = members(texts)
    links = class_links(texts, every)
    root = components(links).withColumnRenamed("node", "class")
    degree = links.select(F.explode(F.array("a", "b")).alias("class")).groupBy("class").agg(F.count("*").alias("n_links"))
    own = every.join(root, "class", "left").join(degree, "class", "left").withColumn("root", F.coalesce("root", "class"))
    heads = own.select("class", "root", "head").distinct().groupBy("root").agg(F.min("head").alias("group_id"))
    return own.join(heads, "root").select("record_kind", "id", "class", "head", "group_id", F.coalesce("n_links", F.lit(0)).alias("n_links"))


def sql_similar_pairs() -> str:
    """similar_pairs for DuckDB, by joining all shingles; for small tables."""
    norm = "trim(regexp_replace(lower({}), '[\\s\\p{{Z}}\\x0B\\x1C-\\x1F\\x{{85}}]+', ' ', 'g'))"
    one = "select distinct '{}' as record_kind, {} as id, {} as t from {} where block_type = 'text' and length({}) >= 200"
    rows = " union all ".join(one.format(kind, i, norm.format(field), table, field) for kind, i, field, table in (("block", "block_id", "resolved_content", "blocks"), ("chunk", "chunk_id", "display_text", "chunks")))
    return f"""with r as ({rows}), c as (select record_kind, t, row_number() over (order by record_kind, t) as c from (select distinct record_kind, t from r)),
s as (select record_kind, c, unnest(list_distinct(list_transform(range(1, length(t) - 3), lambda i: hash(substr(t, i, 5))))) as h from c), n as (select c, count(*) as n from s group by c),
shared as (select a.c as x, b.c as y, count(*) as k from s a join s b on a.record_kind = b.record_kind and a.h = b.h and a.c < b.c group by a.c, b.c),
near as (select x, y from shared join n p on p.c = x join n q on q.c = y where k >= 0.7 * (p.n + q.n - k) - 1e-9 union all select c, c from c),
m as (select r.record_kind, r.id, c.c from r join c on r.record_kind = c.record_kind and r.t = c.t)
select distinct a.record_kind, least(a.id, b.id) as id_a, greatest(a.id, b.id) as id_b from near join m a on a.c = x join m b on b.c = y where a.id <> b.id"""
