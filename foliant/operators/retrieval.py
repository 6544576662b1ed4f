"""Lexical and vector retrieval, rank fusion and retrieval metrics, for all queries of a table in one plan."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from foliant.functions import text as T
from foliant.options import DEFAULT
from foliant.session import cut_lineage

BROADCAST_TERMS = 500_000  # (query, term) rows
QUERY_BLOCK = 2048  # query vectors that go to the workers at once


def term_frequencies(corpus: DataFrame, key: str, field: str) -> DataFrame:
    """key, n_terms (distinct terms), term, tf."""
    terms = corpus.select(key, T.lexical_terms(F.col(field)).alias("terms")).withColumn("n_terms", F.size(F.array_distinct("terms")))
    return terms.select(key, "n_terms", F.explode("terms").alias("term")).groupBy(key, "n_terms", "term").agg(F.count("*").alias("tf"))


def lexical_ranks(queries: DataFrame, corpus: DataFrame, key: str, field: str, limit: int, query_key: str = "query_id", query_field: str = "query", order: str | None = None) -> DataFrame:
    """query_key, key, lexical_score, lexical_rank of the best ``limit`` per query.

    Only terms that some query has leave the corpus' rows (AQE broadcasts the query terms when their measured size allows); scores are
    summed per (query, document) with map-side combining. Ties go by ``order``, or the key. A query without terms finds nothing."""
    asked = queries.select(query_key, F.explode(T.lexical_terms(F.col(query_field))).alias("term")).groupBy(query_key, "term").agg(F.count("*").alias("qf"))
    wanted = asked.select("term").distinct()
    tf = corpus.select(key, T.lexical_terms(F.col(field)).alias("terms")).withColumn("n_terms", F.size(F.array_distinct("terms"))).select(key, "n_terms", F.explode_outer("terms").alias("term")).where("term is not null")
    tf = cut_lineage(tf.join(wanted, "term", "left_semi").groupBy(key, "n_terms", "term").agg(F.count("*").alias("tf")))  # read twice below
    total = corpus.agg(F.count("*").alias("total"))
    df = tf.groupBy("term").agg(F.count("*").alias("df")).crossJoin(F.broadcast(total))  # one row
    weights = cut_lineage(asked.join(df, "term").select(query_key, "term", (F.col("qf") * F.log(1.0 + (F.col("total") + 0.5) / (F.col("df") + 0.5))).alias("weight")))
    if weights.count() <= BROADCAST_TERMS:  # as for a stated set of queries; more are joined by shuffle
        weights = F.broadcast(weights)
    # partitioned by document once: sums per (query, document) and each partition's best then need no further shuffle of scores
    scored = tf.repartition(key).join(weights, "term").groupBy(query_key, key, "n_terms").agg(F.sum(F.col("weight") * (1.0 + F.log(F.col("tf").cast("double")))).alias("raw"))
    scored = scored.withColumn("lexical_score", F.round(F.col("raw") / F.sqrt(F.greatest(F.lit(1.0), F.col("n_terms").cast("double"))), 9))
    w = Window.partitionBy(query_key).orderBy(F.desc("lexical_score"), order or key)
    return scored.withColumn("lexical_rank", F.row_number().over(w)).where(F.col("lexical_rank") <= limit).select(query_key, key, "lexical_score", "lexical_rank")


SLICE_ROWS = 2048  # corpus vectors compared at once
SCALE = 1_000_000  # similarities have six digits


def _vectors(column: pa.Array, size: int) -> tuple[np.ndarray, np.ndarray]:
    """(the rows of a list column with vectors of a length, these vectors), from the flat buffer."""
    lengths = pc.fill_null(pc.list_value_length(column), -1).to_numpy(zero_copy_only=False)
    rows = np.flatnonzero(lengths == size)
    kept = column if len(rows) == len(column) else column.take(pa.array(rows))
    return rows, pc.fill_null(kept.flatten(), 0).to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, size)


def _best(score: np.ndarray, keys: pa.Array, limit: int) -> tuple[np.ndarray, np.ndarray]:
    """(scores, places in keys) of the best ``limit`` of each row; of equal scores the smallest keys. score holds whole numbers."""
    n = score.shape[1]
    place = np.empty(n, np.int64)
    place[pc.sort_indices(keys).to_numpy()] = np.arange(n)  # by value
    order = score * n + (n - 1 - place)  # all different
    if n > limit:
        top = np.argpartition(order, n - limit, axis=1)[:, n - limit :]
    else:
        top = np.broadcast_to(np.arange(n), score.shape)
    return np.take_along_axis(score, top, 1), top


def _top_worker(queries, limit: int, kind: pa.DataType):
    def run(batches):
        ids, matrix = queries.value
        norms = np.linalg.norm(matrix, axis=1)
        best = None  # (scores, keys) with one row a query, at most ``limit`` columns
        for batch in batches:
            for start in range(0, len(batch), SLICE_ROWS):
                part = batch.slice(start, SLICE_ROWS)
                rows, vectors = _vectors(part.column("vector"), matrix.shape[1])
                if not len(rows):
                    continue
                product, scale = matrix @ vectors.T, norms[:, None] * np.linalg.norm(vectors, axis=1)[None, :]
                cosine = np.divide(product, scale, out=np.zeros_like(product), where=scale > 0)
                keys = part.column("key").take(pa.array(rows))
                score, top = _best(np.round(cosine * SCALE).astype(np.int64) + SCALE, keys, limit)
                found = np.array(keys.to_pylist(), object)[top]
                if best is not None:
                    score, found = np.concatenate([best[0], score], axis=1), np.concatenate([best[1], found], axis=1)
                    if score.shape[1] > limit:  # at most twice ``limit`` columns: put in order by score, then key
                        keep = np.array([sorted(range(len(s)), key=lambda i, s=s, f=f: (-s[i], f[i]))[:limit] for s, f in zip(score.tolist(), found)])
                        score, found = np.take_along_axis(score, keep, 1), np.take_along_axis(found, keep, 1)
                best = score, found
        if best is None:
            return
        score, found = best
        q = np.repeat(np.arange(len(ids)), score.shape[1])
        yield pa.RecordBatch.from_arrays([pa.array(q, pa.int64()), pa.array(found.ravel().tolist(), kind), pa.array((score.ravel() - SCALE) / SCALE)], names=["q", "key", "similarity"])

    return run


def dense_ranks(spark: SparkSession, queries: DataFrame, corpus: DataFrame, limit: int) -> DataFrame:
    """query_id, key, similarity (cosine, 6 digits), dense_rank: exact search of (query_id, vector) rows over (key, vector) rows; ids and keys of any type.

    The stated query set is taken in blocks of QUERY_BLOCK vectors, each a broadcast variable of bounded size; every partition of the
    corpus keeps ``limit`` rows a query, so that only partitions * limit rows per query are shuffled. Null vectors and those of another
    length than the query have no match; where a norm is 0 the similarity is 0. Equal similarities go by key."""
    key = corpus.schema["key"].dataType
    kind, name = to_arrow_type(key), key.simpleString()
    out = None
    for block in _blocks_of(queries.select("query_id", "vector").where("vector is not null").toLocalIterator(), QUERY_BLOCK):
        by_size: dict[int, list] = {}
        for i, v in block:
            by_size.setdefault(len(v), []).append((i, v))
        for rows in by_size.values():
            ids = [i for i, _ in rows]
            sent = spark.sparkContext.broadcast((list(range(len(ids))), np.array([v for _, v in rows], np.float64)))
            found = corpus.select("key", "vector").mapInArrow(_top_worker(sent, limit, kind), f"q long, key {name}, similarity double")
            who = spark.createDataFrame(list(enumerate(ids)), f"q long, query_id {queries.schema['query_id'].dataType.simpleString()}")
            found = found.join(F.broadcast(who), "q").select("query_id", "key", "similarity")  # a row for each query of the block
            out = found if out is None else out.unionByName(found)
    if out is None:
        out = spark.createDataFrame([], f"query_id {queries.schema['query_id'].dataType.simpleString()}, key {name}, similarity double")
    w = Window.partitionBy("query_id").orderBy(F.desc("similarity"), "key")
    return out.withColumn("dense_rank", F.row_number().over(w)).where(F.col("dense_rank") <= limit)


def _blocks_of(rows, size: int):
    block = []
    for row in rows:
        block.append((row.query_id, row.vector))
        if len(block) == size:
            yield block
            block = []
    if block:
        yield block


HASHED_DIM = 64


def hashed_vectors(df: DataFrame, key: str, text: str, dim: int = HASHED_DIM) -> DataFrame:
    """key, vector: the text's lexical terms hashed into ``dim`` signed counts; the dense side where no embedding model is at hand. A text without terms has a vector of zeros."""
    numbers = F.transform(T.lexical_terms(F.col(text)), lambda t: F.conv(F.substring(F.md5(t.cast("binary")), 1, 7), 16, 10).cast("int"))
    kind = df.schema[key].dataType.simpleString()

    def run(batches):
        for batch in batches:
            lists = batch.column("h")
            h = lists.flatten().to_numpy(zero_copy_only=False)
            row = np.repeat(np.arange(len(batch)), pc.list_value_length(lists).to_numpy(zero_copy_only=False))
            out = np.bincount(row * dim + h % dim, 1.0 - 2.0 * (h // dim % 2), len(batch) * dim).astype(np.float32)
            offsets = pa.array(np.arange(0, len(out) + 1, dim, dtype=np.int32))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.ListArray.from_arrays(offsets, pa.array(out))], names=[key, "vector"])

    return df.select(key, numbers.alias("h")).mapInArrow(run, f"{key} {kind}, vector array<float>")


def pools(limit: int) -> tuple[int, int]:
    """How many candidates the dense and the lexical search give for a number of results."""
    return max(6 * limit, 60), max(3 * limit, 30)


def hybrid_search(spark: SparkSession, queries: DataFrame, chunks: DataFrame, vectors: DataFrame, limit: int = DEFAULT.result_limit, relevance: DataFrame | None = None, document_id: str | None = None, block_type: str | None = None) -> DataFrame:
    """The results of each query (query_id, query, vector): query_id, chunk_id, rank, final_score, relevance, rerank_position, dense_rank, lexical_rank, rrf, sources and the chunk's columns.

    Dense and lexical candidates are united and their ranks fused; all are reranked, by relevance (query_id, chunk_id, relevance) where a
    reranker's answers are given, else by the fused score, scaled; ranks that agree add a little, and of one parent only a few are shown.
    document_id and block_type restrict both searches. vectors: chunk_id, vector."""
    for name, value in (("document_id", document_id), ("block_type", block_type)):
        chunks = chunks if value is None else chunks.where(F.col(name) == value)
    n_dense, n_lexical = pools(limit)
    corpus = vectors if document_id is None and block_type is None else vectors.join(chunks.select("chunk_id"), "chunk_id", "left_semi")
    dense = dense_ranks(spark, queries, corpus.select(F.col("chunk_id").alias("key"), "vector"), n_dense).withColumnRenamed("key", "chunk_id")
    fused = cut_lineage(fuse(dense, lexical_ranks(queries, chunks, "chunk_id", "display_text", n_lexical), ["query_id", "chunk_id"]))  # a bounded number of rows a query
    wanted = fused.select("chunk_id").distinct()
    about = chunks.join(wanted, "chunk_id", "left_semi").select("chunk_id", "document_id", "chunk_role", F.coalesce("parent_id", "chunk_id").alias("parent"), "page_start", "page_end", F.col("display_text").alias("text"))
    rows = fused.join(about, "chunk_id").withColumn("document_order", F.col("chunk_id"))
    if relevance is None:
        rows = rows.withColumn("relevance", F.round(F.col("rrf") * 10, 6))
    else:
        rows = rows.join(relevance.select("query_id", "chunk_id", "relevance"), ["query_id", "chunk_id"], "left").fillna(0.0, ["relevance"])
    rows = rows.withColumn("rerank_position", F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("relevance"), "chunk_id")))
    rows = rows.withColumn("sources", F.array_compact(F.array(F.when(F.col("dense_rank").isNotNull(), "dense"), F.when(F.col("lexical_rank").isNotNull(), "lexical"))))
    return final_order(rows, limit=limit)


def fuse(dense: DataFrame, lexical: DataFrame, keys: list[str]) -> DataFrame:
    """The union of two rankings: keys, dense_rank, lexical_rank, rrf."""
    k = DEFAULT.rrf_constant
    both = dense.select(*keys, "dense_rank").join(lexical.select(*keys, "lexical_rank"), keys, "full")
    part = lambda c: F.coalesce(1.0 / (k + F.col(c)), F.lit(0.0))
    return both.withColumn("rrf", part("dense_rank") + part("lexical_rank"))


def final_order(candidates: DataFrame, query_key: str = "query_id", limit: int = DEFAULT.result_limit) -> DataFrame:
    """The results per query from candidates with relevance, rerank_position, dense_rank, lexical_rank, document_order, parent and chunk_role:
    final_score adds at most .02 for rank agreement; of one parent only 3 table rows or row groups, or 2 other chunks, are shown."""
    near = lambda c: F.coalesce(0.01 / F.sqrt(F.greatest(F.lit(1), F.col(c)).cast("double")), F.lit(0.0))
    scored = candidates.withColumn("final_score", F.round(F.col("relevance") + near("dense_rank") + near("lexical_rank"), 9))
    order = [F.desc("final_score"), "rerank_position", "document_order"]
    cap = F.when(F.col("chunk_role").isin("table_row", "table_row_group"), 3).otherwise(2)
    capped = scored.withColumn("of_parent", F.row_number().over(Window.partitionBy(query_key, "parent").orderBy(*order))).where(F.col("of_parent") <= cap)
    return capped.withColumn("rank", F.row_number().over(Window.partitionBy(query_key).orderBy(*order))).where(F.col("rank") <= limit).drop("of_parent")


UNITS = "万亿元|亿元|亿笔|万笔|亿美元|万亿美元|个百分点|%|家|只"


def keyword_hit(keyword, text):
    """Whether a comparable keyword is in a comparable text; a number with a unit may stand apart from its unit."""
    number = F.regexp_extract(keyword, rf"^(-?\d+(?:\.\d+)?)(?:{UNITS})$", 1)
    unit = F.regexp_extract(keyword, rf"^-?\d+(?:\.\d+)?({UNITS})$", 1)
    apart = (F.length(number) > 0) & text.contains(unit) & F.regexp_like(text, F.concat(F.lit(r"(^|[^0-9.])"), F.replace(number, F.lit("."), F.lit("[.]")), F.lit(r"($|[^0-9.])")))
    return (F.length(keyword) > 0) & (text.contains(keyword) | apart)


def prefix_metrics(questions: DataFrame, results: DataFrame, ks: tuple[int, ...] = (1, 3, 5, 10)) -> DataFrame:
    """id, modality, difficulty, k, page_hit (null without target), n_keywords, n_hits, best_single, coverage, content_success, strict_success, grounded.

    results: id, rank, text, page_start, page_end. One row per question and k, also where nothing was found."""
    asked = questions.select(
        "id", "modality", "difficulty", F.array_distinct(F.col("must_retrieve_keywords")).alias("keywords"),
        F.coalesce("page_no", F.when(F.size("page_range") == 2, F.element_at("page_range", 1))).alias("first_page"),
        F.coalesce("page_no", F.when(F.size("page_range") == 2, F.element_at("page_range", 2))).alias("last_page"), F.explode(F.array(*map(F.lit, ks))).alias("k"),
    )
    hits = asked.join(results, "id", "left").where(F.col("rank").isNull() | (F.col("rank") <= F.col("k")))
    words = F.filter(F.transform(F.coalesce("keywords", F.array().cast("array<string>")), T.comparable), lambda w: F.length(w) > 0)
    found = F.filter("words", lambda w: keyword_hit(w, F.col("plain")))
    hits = hits.withColumn("words", words).withColumn("plain", T.comparable(F.col("text"))).withColumn("found", F.when(F.col("rank").isNotNull(), found))
    on_page = (F.col("page_start") <= F.col("last_page")) & (F.coalesce("page_end", "page_start") >= F.col("first_page"))
    one = hits.groupBy("id", "modality", "difficulty", "k").agg(
        F.max(F.when(F.col("first_page").isNotNull(), F.coalesce(on_page, F.lit(False)))).alias("page_hit"),
        F.max(F.size("words")).cast("long").alias("n_keywords"),
        F.size(F.array_distinct(F.flatten(F.collect_list("found")))).cast("long").alias("n_hits"),  # at most k results of a question
        F.coalesce(F.max(F.size("found")), F.lit(0)).cast("long").alias("best_single"),
    )
    one = one.withColumn("coverage", F.when(F.col("n_keywords") > 0, F.round(F.col("n_hits") / F.col("n_keywords"), 4)).otherwise(F.lit(1.0)))
    one = one.withColumn("content_success", F.col("coverage") >= DEFAULT.content_success).withColumn("strict_success", F.col("n_hits") == F.col("n_keywords"))
    return one.withColumn("grounded", F.col("content_success") & F.coalesce("page_hit", F.lit(True)))


def metric_groups(metrics: DataFrame) -> DataFrame:
    """k, grouped_by, value, n_questions and rates per k overall, by modality and by difficulty (grouping sets)."""
    k, modality, difficulty = F.col("k"), F.col("modality"), F.col("difficulty")
    rate = lambda c: F.round(F.avg(F.col(c).cast("double")), 4)
    kind = F.when(F.grouping("modality") == 0, "modality").when(F.grouping("difficulty") == 0, "difficulty").otherwise("overall")
    out = metrics.groupingSets([[k], [k, modality], [k, difficulty]], k, modality, difficulty).agg(
        kind.alias("grouped_by"), F.count("*").alias("n_questions"), F.round(F.count_if("page_hit") / F.greatest(F.lit(1), F.count("page_hit")), 4).alias("page_hit_rate"),
        rate("content_success").alias("content_success_rate"), rate("grounded").alias("grounded_rate"), rate("strict_success").alias("strict_rate"),
    )
    return out.select("k", "grouped_by", F.coalesce("modality", "difficulty", F.lit("all")).alias("value"), "n_questions", "page_hit_rate", "content_success_rate", "grounded_rate", "strict_rate")
