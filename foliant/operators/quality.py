"""Block flags, gate decisions and tiers."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType

from foliant.functions import text as T
from foliant.functions import geometry as G
from foliant.options import DEFAULT, OTHER_TASK, ROUTING_FLAGS, SETTLED, TASK_OF_TYPE, VISUAL_NAMES, YES_WORDS


def _repeats(flat: Column, share: float) -> Column:
    """Whether one character makes up at least ``share`` of a text. Counting is left to Arrow batches: over arrays of characters it is many times slower."""
    count = F.pandas_udf(lambda texts: pd.Series([bool(t) and max(map(t.count, set(t))) >= share * len(t) for t in texts], dtype=bool), BooleanType())
    return count(F.coalesce(flat, F.lit("")))


def text_flags(text: Column) -> Column:
    flat = T.compact(text)
    # the cheap test first: most texts have no such sign
    hidden = flat.rlike(r"(?i)(?:█{3,}|\*{5,}|已脱敏|已遮挡|redacted)")
    repeated = (F.length(flat) >= 8) & _repeats(flat, DEFAULT.repeated_char_share)
    broken = text.contains("�") | text.rlike(r"[?？]{4,}")
    money = text.rlike("[¥￥$]") & text.rlike(r"(?s)(?:\d+[A-Za-z]+|[A-Za-z]+\d+)[^\n]*[¥￥$]|[¥￥$][^\n]*(?:\d+[A-Za-z]+)")
    some = F.length(flat) > 0
    return F.array_distinct(F.filter(F.array(F.when(some & hidden, "SRC-004"), F.when(some & repeated, "TXT-002"), F.when(some & broken, "TXT-001"), F.when(some & money, "TXT-002")), lambda x: x.isNotNull()))


def formula_flags(text: Column) -> Column:
    count = lambda c: F.length(text) - F.length(F.replace(text, F.lit(c), F.lit("")))
    uneven = (count("{") != count("}")) | (count("(") != count(")")) | (count("[") != count("]"))
    return F.when(T.blank(text) | uneven, F.array(F.lit("FOR-001"))).otherwise(F.array().cast("array<string>"))


def table_flags(text: Column) -> Column:
    from foliant.operators.tables import table_shape

    none = F.array().cast("array<string>")
    return F.when(T.blank(text), F.array(F.lit("TAB-001"))).when(table_shape(text).isNull(), F.array(F.lit("TAB-002"))).otherwise(none)


def detected_flags(tables: bool = True) -> Column:
    """The flags of a block by its type and content, in the order of their discovery."""
    c, kind, none = T.content(), F.col("block_type"), F.array().cast("array<string>")
    visual = F.array_compact(F.array(F.when(kind == "chart", "IMG-002").otherwise("IMG-001"), F.when(T.blank(c), "IMG-003")))
    flags = F.when(kind.isin("text", "title", "footnote"), text_flags(c))
    if tables:
        flags = flags.when(kind == "table", table_flags(F.when(kind == "table", c)))
    return flags.when(kind.isin("image", "chart"), visual).when(kind == "formula", formula_flags(c)).when(kind == "seal", F.array(F.lit("LAY-004"))).otherwise(none)


def needs_second_reading(flags: Column) -> Column:
    return F.arrays_overlap(flags, F.array(*map(F.lit, ROUTING_FLAGS))) & ~F.array_contains(flags, "SRC-004")


def gate(flags: Column, text_layer_agrees: Column | None = None) -> Column:
    """unreadable, accept_text_layer, second_reading or accept, in this order of priority."""
    agrees = F.lit(False) if text_layer_agrees is None else F.coalesce(text_layer_agrees, F.lit(False))
    return F.when(F.array_contains(flags, "SRC-004"), "unreadable").when(agrees, "accept_text_layer").when(needs_second_reading(flags), "second_reading").otherwise("accept")


def gated_blocks(blocks: DataFrame) -> DataFrame:
    """block_id, flags, decision, task: detection, the flag of upright blocks, the gate and the task of a second reading."""
    box = F.col("bbox")
    upright = box.isNotNull() & (G.height(box) > F.greatest(2.5 * G.width(box), F.lit(80.0)))
    flags = F.array_distinct(F.concat(F.coalesce("issue_flags", F.array().cast("array<string>")), detected_flags(), F.when(upright, F.array(F.lit("LAY-002"))).otherwise(F.array().cast("array<string>"))))
    out = blocks.withColumn("flags", flags).withColumn("decision", gate(F.col("flags")))
    pairs = [x for k, v in TASK_OF_TYPE.items() for x in (F.lit(k), F.lit(v))]
    task = F.when(F.col("decision") == "second_reading", F.coalesce(F.try_element_at(F.create_map(*pairs), F.col("block_type")), F.lit(OTHER_TASK)))
    return out.select("block_id", "flags", "decision", task.alias("task"))


def tiers(blocks: DataFrame) -> DataFrame:
    """block_id, eligible, tier (verified or provisional), content_basis (raw or resolved)."""
    basis = F.when(T.provisional() & ~T.blank(F.col("raw_content")), "raw").otherwise("resolved")
    return blocks.select("block_id", F.coalesce(T.eligible(), F.lit(False)).alias("eligible"), F.when(T.provisional(), "provisional").otherwise("verified").alias("tier"), basis.alias("content_basis"))


def said_yes(answer: Column) -> Column:
    """Whether a model's answer, a flag, number or word, means yes."""
    return F.coalesce(F.lower(T.strip(answer.cast("string"))).isin(*YES_WORDS, "1.0"), F.lit(False))


def visual_type(name: Column) -> Column:
    """The usual name of a kind of picture."""
    low = F.lower(T.strip(name))
    pairs = [x for k, v in VISUAL_NAMES.items() for x in (F.lit(k), F.lit(v))]
    return F.coalesce(F.try_element_at(F.create_map(*pairs), low), low)


def settled(status: Column) -> Column:
    return F.coalesce(status.isin(*SETTLED), F.lit(False))
