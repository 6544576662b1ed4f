"""Problem 7: cutting oversized items at natural boundaries.

Every item is worked on in ranges of fixed length. A worker sees its range and a halo on both sides. Where two ranges meet, both of
their workers choose the same cut from the same halo, so that no range waits for another; within its range a worker goes from cut
to cut. The boundary tables are stitched by range number, and prefix sums of the ranges' piece counts and lengths give each piece its
number and offset. Of a file no worker holds more than a range with its halos; a column value stands in one row already, but its ranges
are cut off in one pass and spread over the workers.

Files are read twice by byte ranges: the first pass gives the boundary table, numbers only; after its prefix sums the second pass emits
each range's pieces with their offsets, so that no text is shuffled.

A piece has at most ``size`` code points and begins ``overlap`` code points before the end of the piece before it (the first begins
at 0). An item within the size is one piece. Null items have no piece, nor have empty ones. Rows delivered twice count once per id.
"""

from __future__ import annotations

import re

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from foliant.session import cut_lineage

SIZE, OVERLAP = 1200, 120  # the project's limits, in code points
RANGE = 1 << 16
# Boundaries from strongest to weakest; a cut is made after the match.
BOUNDARIES = [re.compile(x) for x in (
    r"\n[ \t]*\n+|</table>\s*|\\end\{[a-z*]+\}\s*",
    r"\n+|</(?:tr|p|div|li|ul|ol|h[1-6])>\s*|<br\s*/?>\s*",
    r"[。！？][”’」』）]*|[.!?][\"')\]]*\s+|[；;]\s*",
    r"[，、：]|[,:]\s+|</t[dh]>",
    r"\s+",
)]
UNSPLIT = re.compile(r"[̀-ͯ‍️\udc00-\udfff]|\n(?<=\r\n)")


def best_cut(text: str, least: int, most: int) -> int:
    """The end of the last strongest boundary in (least, most]; else most, moved back off a mark that belongs to the letter before it."""
    for boundary in BOUNDARIES:
        at = -1
        for m in boundary.finditer(text, max(0, least - 64), min(len(text), most + 64)):
            if least < m.end() <= most:
                at = m.end()
            elif m.end() > most and m.start() < most and least < m.start() + 1 and m.group().isspace():
                at = most  # within a run of white space
        if at > least:
            return at
    at = most
    while at > least + 1 and at < len(text) and UNSPLIT.match(text, at):
        at -= 1
    return at


def cuts_within(text: str, start: int, stop: int, first: int, most: int) -> list[int]:
    """Cuts from start to stop, both included; the first part may have ``first`` code points, each other one ``most``."""
    cuts, room = [start], first
    while stop - cuts[-1] > room:
        at, rest = cuts[-1], stop - cuts[-1]
        goal = room if rest > 1.5 * room else min(room, rest // 2 + room // 8)  # no tiny remainder
        cuts.append(best_cut(text, at + goal // 2, at + goal))
        room = most
    if stop > start:
        cuts.append(stop)
    return cuts


def meeting_point(text: str, middle: int, half: int) -> int:
    """The cut near the place where two ranges meet; text holds at least ``half`` code points on both sides or ends there."""
    a, b = max(0, middle - half), min(len(text), middle + half)
    return a + best_cut(text[a:b], 0, b - a - 1) if b - a > 1 else middle


def range_pieces(text: str, left: int, right: int, begins: bool, ends: bool, size: int, overlap: int) -> list[tuple[int, int, int]]:
    """(start with overlap, core start, end) of the pieces whose core starts between the meeting points of a range.

    text[left:right] is the range, the rest are halos; begins and ends tell whether the item begins or ends with it."""
    half = (size - overlap) // 4
    start = left if begins else meeting_point(text, left, half)
    stop = right if ends else meeting_point(text, right, half)
    cuts = cuts_within(text, start, stop, size if begins else size - overlap, size - overlap)
    return [(max(a - overlap, 0) if (a > left or not begins) else a, a, b) for a, b in zip(cuts, cuts[1:])]


def _pieces_batch(kind, rows: list[tuple]) -> pa.RecordBatch:
    """Rows of item, range_no, in_range, start_char, end_char, piece."""
    columns = list(zip(*rows)) if rows else [[]] * 6
    types = [kind, pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.string()]
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names=["item", "range_no", "in_range", "start_char", "end_char", "piece"])


def _worker(size: int, overlap: int, length: int, halo: int):
    def run(batches):
        for batch in batches:
            out = []
            for item, text, total, r in zip(*(batch.column(c).to_pylist() for c in ("item", "part", "n_chars", "range_no"))):
                base = max(0, r * length - halo)
                left, right = r * length - base, min(total, (r + 1) * length) - base
                found = range_pieces(text, left, right, r == 0, (r + 1) * length >= total, size, overlap)
                out.extend((item, r, k, base + a, base + b, text[a:b]) for k, (a, _, b) in enumerate(found))
            yield _pieces_batch(batch.schema.field("item").type, out)

    return run


def _range_worker(length: int, halo: int, at_once: int = 64):
    """The ranges of long values with their halos, a few at a time; each is a slice, so that a value is walked once."""

    def run(batches):
        for batch in batches:
            kind = batch.schema.field("item").type
            for item, text in zip(batch.column("item").to_pylist(), batch.column("whole").to_pylist()):
                last = -(-len(text) // length)
                for first in range(0, last, at_once):
                    numbers = range(first, min(last, first + at_once))
                    parts = [text[max(0, r * length - halo) : (r + 1) * length + halo] for r in numbers]
                    yield pa.RecordBatch.from_arrays([pa.array([item] * len(parts), kind), pa.array([len(text)] * len(parts), pa.int64()), pa.array(list(numbers), pa.int64()), pa.array(parts, pa.string())], names=["item", "n_chars", "range_no", "part"])

    return run


GROUP = 4096  # ranges that are summed up first, so that no window holds all ranges of an item


def offsets_of(table: DataFrame, item: str, values: list[str]) -> DataFrame:
    """item, range_no and before_<value> of each value: the sums over earlier ranges of the item, in two levels."""
    rows = table.withColumn("_group", F.floor(F.col("range_no") / GROUP))
    sums = rows.groupBy(item, "_group").agg(*[F.sum(v).alias(v) for v in values])
    outer = Window.partitionBy(item).orderBy("_group").rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.select(item, "_group", *[F.coalesce(F.sum(v).over(outer), F.lit(0)).alias(f"_base_{v}") for v in values])
    inner = Window.partitionBy(item, "_group").orderBy("range_no").rowsBetween(Window.unboundedPreceding, -1)
    rows = rows.select(item, "_group", "range_no", *[F.coalesce(F.sum(v).over(inner), F.lit(0)).alias(f"_own_{v}") for v in values])
    return rows.join(sums, [item, "_group"]).select(item, "range_no", *[(F.col(f"_base_{v}") + F.col(f"_own_{v}")).alias(f"before_{v}") for v in values])


def split_items(df: DataFrame, key: str, field: str, size: int = SIZE, overlap: int = OVERLAP, range_length: int = RANGE) -> DataFrame:
    """key, piece_no from 0, start_char, end_char, piece of every item that isn't empty.

    Items of one range are cut where they are. Of longer ones the ranges are spread, and only these few pieces meet their prefix sums."""
    if size < 4 or not 0 <= overlap < size // 2 or range_length < 2 * size:
        raise ValueError("size must be at least 4, overlap under half of it, and a range at least two sizes long")
    kind, halo = df.schema[key].dataType.simpleString(), size + overlap
    once = df.select(F.col(key).alias("item"), F.col(field).alias("whole")).where((F.length("whole") > 0) & F.col("item").isNotNull()).dropDuplicates(["item"])
    schema = f"item {kind}, range_no long, in_range long, start_char long, end_char long, piece string"
    work = _worker(size, overlap, range_length, halo)
    short = once.where(F.length("whole") <= range_length).select("item", F.length("whole").cast("long").alias("n_chars"), F.lit(0).cast("long").alias("range_no"), F.col("whole").alias("part"))
    ranges = once.where(F.length("whole") > range_length).mapInArrow(_range_worker(range_length, halo), f"item {kind}, n_chars long, range_no long, part string")
    cut = ranges.repartition("item", "range_no").mapInArrow(work, schema)
    before = offsets_of(cut.groupBy("item", "range_no").agg(F.count("*").alias("n")), "item", ["n"])
    out = short.mapInArrow(work, schema).withColumn("before_n", F.lit(0).cast("long")).unionByName(cut.join(before, ["item", "range_no"]))
    return out.select(F.col("item").alias(key), (F.col("before_n") + F.col("in_range")).alias("piece_no"), "start_char", "end_char", "piece")


def oversized(df: DataFrame, key: str, field: str, size: int = SIZE, overlap: int = OVERLAP) -> DataFrame:
    """Distinct keys of the items that had to be cut: those of which the operator made a second piece."""
    return split_items(df, key, field, size, overlap).where("piece_no = 1").select(key).distinct()


def file_ranges(spark: SparkSession, paths: list[str], range_bytes: int) -> DataFrame:
    """path, range_no, n_bytes of every byte range of the files, spread over the workers. Only the files' sizes are read."""
    files = spark.read.format("binaryFile").load(paths).select("path", F.col("length").alias("n_bytes"))
    last = F.floor((F.greatest(F.col("n_bytes"), F.lit(1)) - 1) / range_bytes).cast("long")
    return files.select("path", "n_bytes", F.explode(F.sequence(F.lit(0).cast("long"), last)).alias("range_no")).repartition("path", "range_no")


def _read_range(path: str, start: int, end: int) -> bytes:
    from pyarrow import fs

    system, inner = fs.FileSystem.from_uri(path)
    with system.open_input_file(inner) as f:
        f.seek(start)
        return f.read(end - start)


def _file_pieces(path: str, r: int, total: int, range_bytes: int, size: int, overlap: int) -> tuple[str, int, list[tuple[int, int, int]]]:
    """(text of a byte range with halos, where the range begins in it, its pieces as range_pieces gives them)."""
    halo = 4 * (size + overlap)
    a, b = r * range_bytes, min(total, (r + 1) * range_bytes)
    first = max(0, a - halo)
    data = _read_range(path, first, min(total, b + halo))
    left, right = a - first, b - first
    while 0 < left < len(data) and data[left] & 0xC0 == 0x80:  # both neighbours move to the same character
        left += 1
    while right < len(data) and data[right] & 0xC0 == 0x80:
        right += 1
    head, body, tail = (part.decode("utf-8", "ignore") for part in (data[:left], data[left:right], data[right:]))
    text = head + body + tail
    return text, len(head), range_pieces(text, len(head), len(head) + len(body), a == 0, b >= total, size, overlap)


def boundary_table(ranges: DataFrame, range_bytes: int, size: int = SIZE, overlap: int = OVERLAP) -> DataFrame:
    """path, range_no, n_bytes, n_pieces, n_chars (of the pieces without overlaps) of every range: what the first pass over the files gives."""

    def run(batches):
        for batch in batches:
            rows = list(zip(*(batch.column(c).to_pylist() for c in ("path", "range_no", "n_bytes"))))
            found = [_file_pieces(path, r, total, range_bytes, size, overlap)[2] for path, r, total in rows]
            yield pa.RecordBatch.from_arrays([batch.column("path"), batch.column("range_no"), batch.column("n_bytes"), pa.array([len(f) for f in found], pa.int64()), pa.array([sum(b - c for _, c, b in f) for f in found], pa.int64())], names=["path", "range_no", "n_bytes", "n_pieces", "n_chars"])

    return ranges.select("path", "range_no", "n_bytes").mapInArrow(run, "path string, range_no long, n_bytes long, n_pieces long, n_chars long")


def split_files(spark: SparkSession, paths: list[str], size: int = SIZE, overlap: int = OVERLAP, range_bytes: int = 1 << 20) -> DataFrame:
    """path, piece_no, start_char, end_char, piece of UTF-8 files on a file system that all executors reach; only byte ranges are read.

    The boundary table is written to the shared folder; its prefix sums tell every range the number and the offset of its first piece. An empty file has no piece."""
    if range_bytes < 16 * size:
        raise ValueError("a range must have at least 16 times the bytes of a piece")
    table = cut_lineage(boundary_table(file_ranges(spark, paths, range_bytes), range_bytes, size, overlap))
    jobs = table.select("path", "range_no", "n_bytes").join(offsets_of(table, "path", ["n_pieces", "n_chars"]), ["path", "range_no"]).repartition("path", "range_no")

    def run(batches):
        for batch in batches:
            for path, r, total, number, offset in zip(*(batch.column(c).to_pylist() for c in ("path", "range_no", "n_bytes", "before_n_pieces", "before_n_chars"))):
                text, _, found = _file_pieces(path, r, total, range_bytes, size, overlap)
                start = found[0][1] if found else 0
                rows = [(path, number + k, offset + a - start, offset + b - start, text[a:b]) for k, (a, _, b) in enumerate(found)]
                columns = list(zip(*rows)) if rows else [[]] * 5
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, (pa.string(), pa.int64(), pa.int64(), pa.int64(), pa.string()))], names=["path", "piece_no", "start_char", "end_char", "piece"])

    return jobs.mapInArrow(run, "path string, piece_no long, start_char long, end_char long, piece string")
