"""Parser output (JSON arrays of items, or objects that hold one) as pages and blocks."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from foliant.functions import text as X
from foliant.options import PARSER_TYPES

_S, _D, _I = T.StringType(), T.DoubleType(), T.IntegerType()
ITEM = T.StructType(
    [T.StructField(n, _I) for n in ("page_idx", "page_no", "text_level")]
    + [T.StructField(n, _S) for n in ("type", "block_type", "text", "content", "table_body", "html", "latex", "img_path", "image_path")]
    + [T.StructField(n, T.ArrayType(_D)) for n in ("bbox", "page_size")]
    + [T.StructField(n, _S) for n in ("image_caption", "caption")]  # a string, or an array kept as JSON text
)


def read_items(spark: SparkSession, pattern: str) -> DataFrame:
    """path, pos, item of the JSON files of a pattern: an array, or an object with content_list or data. Items that are no objects are skipped."""
    files = spark.read.text(pattern, wholetext=True).select(F.col("_metadata.file_path").alias("path"), F.trim("value").alias("raw"))
    listed = F.coalesce(F.get_json_object("raw", "$.content_list"), F.get_json_object("raw", "$.data"))
    items = F.from_json(F.when(F.col("raw").startswith("["), F.col("raw")).otherwise(listed), "array<string>")
    rows = files.select("path", F.posexplode(items).alias("pos", "text")).where(F.ltrim("text").startswith("{"))
    return rows.select("path", "pos", F.from_json("text", ITEM).alias("item"))


def _caption(c):
    return F.coalesce(F.array_join(F.from_json(c, "array<string>"), "\n"), c)


def blocks_of_items(items: DataFrame, document_id) -> DataFrame:
    """Blocks in the project's form from read_items: type mapped, page from 1, order on the page from 0, content by type; '' counts as missing throughout."""
    i = F.col("item")
    pairs = [x for k, v in PARSER_TYPES.items() for x in (F.lit(k), F.lit(v))]
    kind = F.coalesce(F.try_element_at(F.create_map(*pairs), F.lower(X.either(i["type"], i["block_type"]))), F.lit("unknown"))
    page = F.greatest(F.lit(1), F.coalesce(i["page_idx"] + 1, i["page_no"], F.lit(1)))
    caption = X.either(_caption(i["image_caption"]), _caption(i["caption"]))
    body = (
        F.when(kind == "table", X.either(i["table_body"], i["html"], i["text"])).when(kind == "formula", X.either(i["latex"], i["text"]))
        .when(kind.isin("image", "chart"), X.either(caption, i["text"])).otherwise(X.either(i["text"], i["content"]))
    )
    box = F.when(F.size(i["bbox"]) >= 4, F.struct(*[F.element_at(i["bbox"], k + 1).alias(n) for k, n in enumerate(("x0", "y0", "x1", "y1"))]))
    rows = items.select("path", "pos", document_id.alias("document_id"), page.cast("int").alias("page_no"), kind.alias("block_type"), box.alias("bbox"), body.alias("raw_content"), i["text_level"].alias("text_level"), X.either(i["img_path"], i["image_path"]).alias("image"), i["page_size"].alias("page_size"))
    from pyspark.sql import Window

    w = Window.partitionBy("document_id", "page_no").orderBy("path", "pos")
    rows = rows.withColumn("reading_order", (F.row_number().over(w) - 1).cast("int"))
    return rows.withColumn("block_id", X.stable_id(F.col("document_id"), F.lit("block"), F.col("path"), F.col("pos").cast("string")))


def pages_of_blocks(blocks: DataFrame, page_counts: DataFrame | None = None) -> DataFrame:
    """document_id, page_no, width, height: the stated size, else 1000 x 1000 where a page has boxes; with page_counts (document_id, page_count) empty pages too."""
    stated = F.max(F.when(F.size("page_size") >= 2, F.struct(F.element_at("page_size", 1).alias("w"), F.element_at("page_size", 2).alias("h"))))
    pages = blocks.groupBy("document_id", "page_no").agg(stated.alias("s"), F.max(F.col("bbox").isNotNull()).alias("boxed"))
    size = lambda c: F.coalesce(F.col(f"s.{c}"), F.when(F.col("boxed"), F.lit(1000.0)))
    pages = pages.select("document_id", "page_no", size("w").alias("width"), size("h").alias("height"))
    if page_counts is None:
        return pages
    every = page_counts.where("page_count > 0").select("document_id", F.explode(F.sequence(F.lit(1), F.col("page_count"))).alias("page_no"))
    return every.join(pages, ["document_id", "page_no"], "full")


def text_lines(words: DataFrame) -> DataFrame:
    """Lines of a text layer from words (document_id, page_no, line_no, word_no, text, x0, y0, x1, y1, page_width, page_height), in 0..1000.

    Inverted boxes and pages without size are dropped."""
    ok = words.where("x1 > x0 and y1 > y0 and page_width > 0 and page_height > 0")
    scaled = [(F.col(c) * 1000.0 / F.col("page_width" if c[0] == "x" else "page_height")).alias(c) for c in ("x0", "y0", "x1", "y1")]
    ok = ok.select("document_id", "page_no", "line_no", "word_no", "text", *scaled)
    text = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("word_no", "text"))), lambda w: w["text"]), " ")  # the words of one line
    got = ok.groupBy("document_id", "page_no", "line_no").agg(text.alias("text"), F.min("x0").alias("x0"), F.min("y0").alias("y0"), F.max("x1").alias("x1"), F.max("y1").alias("y1"))
    return got.select("document_id", "page_no", "line_no", "text", F.struct("x0", "y0", "x1", "y1").alias("bbox"))


def invalid_words(words: DataFrame) -> DataFrame:
    """document_id, n_invalid: how many words text_lines leaves out, for layer_reliability."""
    bad = ~F.coalesce((F.col("x1") > F.col("x0")) & (F.col("y1") > F.col("y0")) & (F.col("page_width") > 0) & (F.col("page_height") > 0), F.lit(False))
    return words.groupBy("document_id").agg(F.count_if(bad).alias("n_invalid"))


def file_identities(spark: SparkSession, pattern: str) -> DataFrame:
    """path, document_id (SHA-256 of the bytes), length of files."""
    return spark.read.format("binaryFile").load(pattern).select("path", F.sha2("content", 256).alias("document_id"), "length")


def json_of_reply(reply):
    """A model's JSON reply without its code fence, as a variant; null where it is no JSON."""
    bare = F.regexp_replace(F.regexp_replace(F.trim(reply), r"^```(?:json)?\s*", ""), r"\s*```$", "")
    return F.try_parse_json(bare)


# Media types by suffix.
MEDIA_TYPES = {"png": "image/png", "jpg": "image/jpeg", "jpeg": "image/jpeg", "gif": "image/gif", "webp": "image/webp", "bmp": "image/bmp", "tif": "image/tiff", "tiff": "image/tiff"}


def _basename(path):
    return F.element_at(F.split(path, "/"), -1)


def assets_of_blocks(spark: SparkSession, blocks: DataFrame, pattern: str) -> DataFrame:
    """asset_id, document_id, page_no, block_id, kind, mime_type, sha256, length, source_path: the files that blocks (of blocks_of_items) name, found by their base name; of several the first path.

    Files are hashed where they are read; pictures that no file has give no row."""
    files = spark.read.format("binaryFile").load(pattern).select(_basename(F.col("path")).alias("name"), F.struct("path", F.sha2("content", 256).alias("sha256"), "length").alias("f"))
    files = files.groupBy("name").agg(F.min_by("f", "f.path").alias("f"))
    named = blocks.where(F.length("image") > 0).select("document_id", "page_no", "block_id", F.col("block_type").alias("kind"), _basename(F.col("image")).alias("name"))
    pairs = [x for k, v in MEDIA_TYPES.items() for x in (F.lit(k), F.lit(v))]
    mime = F.coalesce(F.try_element_at(F.create_map(*pairs), F.lower(F.element_at(F.split("name", r"\."), -1))), F.lit("application/octet-stream"))
    return named.join(files, "name").select(X.stable_id(F.col("document_id"), F.lit("asset"), F.col("block_id")).alias("asset_id"), "document_id", "page_no", "block_id", "kind", mime.alias("mime_type"), "f.sha256", "f.length", F.col("f.path").alias("source_path"))


def layout_metadata(spark: SparkSession, pattern: str) -> DataFrame:
    """folder, layout_json, backend, effort, ocr_enable, version_name, page_count, read_error of each folder's layout file: layout.json, else the first that ends in _middle.json. A file that is no JSON object has a read_error."""
    files = spark.read.text(pattern, wholetext=True).select(F.col("_metadata.file_path").alias("path"), "value").where(F.col("path").rlike(r"(/layout|_middle)\.json$"))
    first = files.groupBy(F.regexp_replace("path", "/[^/]*$", "").alias("folder")).agg(F.min_by(F.struct("path", "value"), F.struct(~F.col("path").endswith("/layout.json"), "path")).alias("f"))
    v = F.try_parse_json(F.col("f.value"))
    field = lambda name, kind="string": F.try_variant_get(v, f"$._{name}", kind).alias(name)
    pages = F.size(F.from_json(F.get_json_object("f.value", "$.pdf_info"), "array<string>"))
    broken = v.isNull() | ~F.ltrim("f.value").startswith("{")
    return first.select("folder", F.col("f.path").alias("layout_json"), field("backend"), field("effort"), field("ocr_enable", "boolean"), field("version_name"), F.when(~broken, F.coalesce(F.greatest(pages, F.lit(0)), F.lit(0))).alias("page_count"), F.when(broken, "no JSON object").alias("read_error"))


def run_problems(runs: DataFrame) -> DataFrame:
    """runs (backend, page_count, expected_pages, full_document, archive_sha256, baseline_sha256) with problems: what is wrong with a parse-only run; an empty array where nothing is.

    The backend must be a vision one; page counts are compared for full documents only; an archive equal to the baseline's is none of this run."""
    vision = F.coalesce((F.lower("backend") == "vlm") | F.lower("backend").startswith("vlm-"), F.lit(False))
    pages = F.coalesce(F.col("full_document"), F.lit(False)) & ~F.col("page_count").eqNullSafe(F.col("expected_pages"))
    same = F.coalesce(F.col("archive_sha256") == F.col("baseline_sha256"), F.lit(False))
    return runs.withColumn("problems", F.array_compact(F.array(F.when(~vision, "backend"), F.when(pages, "page_count"), F.when(same, "same_archive"))))


STRUCTURE_REPLY = "readable boolean, rotation_degrees int, header_region array<double>, data_region array<double>, header_rows int, column_count int, title string, date string, unit string, footnotes array<string>, uncertainty array<string>"


def structure_of_reply(reply):
    """A model's reply about a table's structure as a struct with defaults; null where it is no JSON object or its rotation is none of 0, 90, 180 and 270 degrees."""
    bare = F.regexp_replace(F.regexp_replace(F.trim(reply), r"^```(?:json)?\s*", ""), r"\s*```$", "")
    r = F.from_json(bare, STRUCTURE_REPLY)
    none = {"readable": F.lit(True), "rotation_degrees": F.lit(0), "header_rows": F.lit(1), "column_count": F.lit(0), "title": F.lit(""), "date": F.lit(""), "unit": F.lit("")}
    lists = {"header_region": "array<double>", "data_region": "array<double>", "footnotes": "array<string>", "uncertainty": "array<string>"}
    full = F.struct(*[F.coalesce(r[n], v).alias(n) for n, v in none.items()], *[F.coalesce(r[n], F.array().cast(t)).alias(n) for n, t in lists.items()])
    return F.when(F.try_parse_json(bare).isNotNull() & F.ltrim(bare).startswith("{") & F.coalesce(r["rotation_degrees"], F.lit(0)).isin(0, 90, 180, 270), full)
