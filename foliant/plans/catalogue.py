"""The queries over the project's tables and, where SQL can tell the same, their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from foliant.functions import text as T
from foliant.operators import audit, chunks, evaluation, layout, quality, reports, retrieval, tables
from foliant.plans import sqltext as Q
from foliant.plans.order import document_order, linked
from foliant.session import cut_lineage
from foliant.sinks import stores
from foliant.sources.tables import delivered_once, table
from foliant.streaming.ingest import windowed_events

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def _query(sql: str | None = None):
    def keep(f):
        QUERIES[f.__name__] = f
        if sql is not None:
            SQL[f.__name__] = sql
        return f

    return keep


def _blocks(spark: SparkSession, d: str) -> DataFrame:
    return layout.laid_out(table(spark, d, "blocks"))


def _pages(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "page_layout")


def _chunks(spark: SparkSession, d: str) -> DataFrame:
    return evaluation.stored_chunks(table(spark, d, "chunks"))


def _readings(spark: SparkSession, d: str) -> DataFrame:
    return delivered_once(table(spark, d, "vlm_results"), "result_id")


def _text_lines(spark: SparkSession, d: str) -> DataFrame:
    """A text layer's lines: those of the resolved texts, each with its share of the block's box, numbered on the page."""
    texts = _blocks(spark, d).where("bbox is not null and resolved_content <> '' and block_type in ('text', 'title', 'footnote', 'header', 'footer', 'page_number')")
    rows = texts.withColumn("parts", F.split("resolved_content", "\n", -1)).select("document_id", "page_no", "position", "block_id", "bbox", F.size("parts").alias("n"), F.posexplode("parts").alias("k", "text")).where(~T.blank(F.col("text")))
    line_no = F.row_number().over(Window.partitionBy("document_id", "page_no").orderBy("position", "block_id", "k")) - 1
    edge = lambda k: F.col("bbox.y0") + (F.col("bbox.y1") - F.col("bbox.y0")) * k / F.col("n")
    return rows.select("document_id", "page_no", line_no.cast("int").alias("line_no"), "text", F.struct(F.col("bbox.x0"), edge(F.col("k")).alias("y0"), F.col("bbox.x1"), edge(F.col("k") + 1).alias("y1")).alias("bbox"))


_TEXT_LINES = f"""(select document_id, page_no, cast(row_number() over (partition by document_id, page_no order by position, block_id, k) - 1 as integer) as line_no, text,
    {{'x0': b.x0, 'y0': b.y0 + (b.y1 - b.y0) * k / n, 'x1': b.x1, 'y1': b.y0 + (b.y1 - b.y0) * (k + 1) / n}} as bbox
    from (select document_id, page_no, position, block_id, bbox as b, len(string_split(resolved_content, chr(10))) as n, unnest(range(len(string_split(resolved_content, chr(10))))) as k, unnest(string_split(resolved_content, chr(10))) as text
      from {Q.BLOCKS} where bbox is not null and resolved_content <> '' and block_type in ('text', 'title', 'footnote', 'header', 'footer', 'page_number')) where not {Q.blank('text')})"""
_LAYER = f"layer as (select *, {Q.normal('text')} as norm from {_TEXT_LINES})"
_RAW = f"(select * replace (coalesce(raw_content, '') as content) from {Q.BLOCKS})"
_DELIVERED = f"(select * replace (coalesce(raw_content, '') as content) from {Q.BLOCKS} where coalesce(source, '') <> 'pdf_text_layer')"


def _delivered_blocks(spark: SparkSession, d: str) -> DataFrame:
    """What the parser delivered, without the blocks that a text layer added since: a completeness audit has to find these again."""
    return _raw_blocks(spark, d).where(F.coalesce("source", F.lit("")) != "pdf_text_layer")


def _raw_blocks(spark: SparkSession, d: str) -> DataFrame:
    """Blocks as the parser delivered them, for comparison with the text layer."""
    return _blocks(spark, d).withColumn("content", F.coalesce("raw_content", F.lit("")))


# retrieval

_TF = f"""corpus as (select chunk_id, {Q.terms('display_text')} as ts from {Q.CHUNKS}),
asked as (select id as query_id, unnest({Q.terms('question')}) as term from questions), qf as (select query_id, term, count(*) as qf from asked group by all),
exploded as (select chunk_id, len(list_distinct(ts)) as n_terms, unnest(ts) as term from corpus),
tf as (select chunk_id, n_terms, term, count(*) as tf from exploded where term in (select term from asked) group by all),
df as (select term, count(*) as df from tf group by term), total as (select count(*) as total from corpus),
scored as (select query_id, chunk_id, round(sum(qf * ln(1.0 + (total + 0.5) / (df + 0.5)) * (1.0 + ln(tf))) / sqrt(greatest(1.0, any_value(n_terms))), 9) as lexical_score
  from qf join tf using (term) join df using (term), total group by query_id, chunk_id)"""


def _questions(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "questions")


def _lexical(spark: SparkSession, d: str, limit: int) -> DataFrame:
    asked = _questions(spark, d).select(F.col("id").alias("query_id"), F.col("question").alias("query"))
    return retrieval.lexical_ranks(asked, _chunks(spark, d), "chunk_id", "display_text", limit)


@_query(f"with {_TF} select query_id, chunk_id, round(lexical_score, 6) as lexical_score, row_number() over (partition by query_id order by lexical_score desc, chunk_id) as lexical_rank from scored qualify lexical_rank <= 10")
def hybrid_lexical_topk(spark: SparkSession, d: str) -> DataFrame:
    return _lexical(spark, d, 10).select("query_id", "chunk_id", F.round("lexical_score", 6).alias("lexical_score"), F.col("lexical_rank").cast("long"))


@_query(f"""with t as (select chunk_id, unnest({Q.terms('display_text')}) as term from {Q.CHUNKS})
select term, count(distinct chunk_id) as df, count(*) as tf from t group by term""")
def lexical_term_stats(spark: SparkSession, d: str) -> DataFrame:
    tf = retrieval.term_frequencies(_chunks(spark, d), "chunk_id", "display_text")
    return tf.groupBy("term").agg(F.count("*").alias("df"), F.sum("tf").alias("tf"))


_DENSE = """(select q.vec_id as query_id, v.vec_id as key, round(coalesce(list_cosine_similarity(q.embedding::double[], v.embedding::double[]), 0), 6) as similarity
  from embeddings q join embeddings v on q.vec_id % 20 = 0 qualify row_number() over (partition by q.vec_id order by similarity desc, v.vec_id) <= {k})"""


def _dense(spark: SparkSession, d: str, k: int) -> DataFrame:
    e = table(spark, d, "embeddings")
    q = e.where("vec_id % 20 = 0").select(F.col("vec_id").alias("query_id"), F.col("embedding").alias("vector"))
    return retrieval.dense_ranks(spark, q, e.select(F.col("vec_id").alias("key"), F.col("embedding").alias("vector")), k)


@_query(f"select query_id, key, similarity, row_number() over (partition by query_id order by similarity desc, key) as dense_rank from {_DENSE.format(k=10)}")
def dense_topk(spark: SparkSession, d: str) -> DataFrame:
    return _dense(spark, d, 10).select("query_id", "key", "similarity", F.col("dense_rank").cast("long"))


@_query("""select q.vec_id as query_id, v.vec_id as key, round(list_cosine_similarity(q.embedding::double[], v.embedding::double[]), 6) as similarity
from embeddings q join embeddings v on q.vec_id % 20 = 0 and v.label = 3 qualify row_number() over (partition by q.vec_id order by similarity desc, v.vec_id) <= 5""")
def filtered_search(spark: SparkSession, d: str) -> DataFrame:
    e = table(spark, d, "embeddings")
    q = e.where("vec_id % 20 = 0").select(F.col("vec_id").alias("query_id"), F.col("embedding").alias("vector"))
    return retrieval.dense_ranks(spark, q, e.where("label = 3").select(F.col("vec_id").alias("key"), F.col("embedding").alias("vector")), 5).drop("dense_rank")


_HASHED = "select {key}, h % 64 as dim, sum(1 - 2 * (h // 64 % 2)) as v from (select {key}, cast('0x' || left(md5(term), 7) as bigint) as h from (select {key}, unnest(ts) as term from {rows})) group by all"
_FUSED = f"""{_TF}, lex as (select query_id, chunk_id, row_number() over (partition by query_id order by lexical_score desc, chunk_id) as lexical_rank from scored qualify lexical_rank <= 30),
asked_terms as (select id as query_id, {Q.terms('question')} as ts from questions), cv as ({_HASHED.format(key='chunk_id', rows='corpus')}), qv as ({_HASHED.format(key='query_id', rows='asked_terms')}),
cn as (select chunk_id, sqrt(sum(v * v)) as n from cv group by all), qn as (select query_id, sqrt(sum(v * v)) as n from qv group by all), dots as (select query_id, chunk_id, sum(cv.v * qv.v) as dot from cv join qv using (dim) group by all),
den as (select q.id as query_id, c.chunk_id, row_number() over (partition by q.id order by round(coalesce(case when qn.n * cn.n > 0 then dot / (qn.n * cn.n) end, 0), 6) desc, c.chunk_id) as dense_rank
  from questions q cross join corpus c left join dots d on d.query_id = q.id and d.chunk_id = c.chunk_id left join cn on cn.chunk_id = c.chunk_id left join qn on qn.query_id = q.id qualify dense_rank <= 60),
fused as (select query_id, chunk_id, dense_rank, lexical_rank, coalesce(1.0 / (60 + dense_rank), 0.0) + coalesce(1.0 / (60 + lexical_rank), 0.0) as rrf from den full join lex using (query_id, chunk_id))"""


def _asked(spark: SparkSession, d: str) -> DataFrame:
    """The questions with their text's hashed vector."""
    q = _questions(spark, d).select(F.col("id").alias("query_id"), F.col("question").alias("query"))
    return q.join(retrieval.hashed_vectors(q, "query_id", "query"), "query_id")


def _fused(spark: SparkSession, d: str) -> DataFrame:
    """The dense and the lexical ranking of each question fused. The tables have no vectors of chunks; hashed terms give them."""
    c, asked = _chunks(spark, d), _asked(spark, d)
    vectors = retrieval.hashed_vectors(c, "chunk_id", "display_text").withColumnRenamed("chunk_id", "key")
    dense = retrieval.dense_ranks(spark, asked, vectors, 60).withColumnRenamed("key", "chunk_id")
    return retrieval.fuse(dense, retrieval.lexical_ranks(asked, c, "chunk_id", "display_text", 30), ["query_id", "chunk_id"])


@_query(f"with {_FUSED} select query_id, chunk_id, dense_rank, lexical_rank, round(rrf, 9) as rrf from fused")
def rrf_fusion(spark: SparkSession, d: str) -> DataFrame:
    return _fused(spark, d).select("query_id", "chunk_id", F.col("dense_rank").cast("long"), F.col("lexical_rank").cast("long"), F.round("rrf", 9).alias("rrf"))


def _final(spark: SparkSession, d: str, limit: int) -> DataFrame:
    """The final ranking of hybrid_search."""
    c = _chunks(spark, d)
    return retrieval.hybrid_search(spark, _asked(spark, d), c, retrieval.hashed_vectors(c, "chunk_id", "display_text"), limit)


_FINAL = f"""{_FUSED}, c as (select f.*, k.chunk_role, coalesce(k.parent_id, k.chunk_id) as parent, page_start, page_end, display_text as text, round(rrf * 10, 6) as relevance from fused f join {Q.CHUNKS} k using (chunk_id)),
r as (select *, row_number() over (partition by query_id order by relevance desc, chunk_id) as rerank_position,
  round(relevance + coalesce(0.01 / sqrt(greatest(1, dense_rank)), 0) + coalesce(0.01 / sqrt(greatest(1, lexical_rank)), 0), 9) as final_score from c),
p as (select *, row_number() over (partition by query_id, parent order by final_score desc, rerank_position, chunk_id) as of_parent from r),
final as (select *, row_number() over (partition by query_id order by final_score desc, rerank_position, chunk_id) as rank from p where of_parent <= case when chunk_role in ('table_row', 'table_row_group') then 3 else 2 end)"""


@_query(f"with {_FINAL} select query_id, chunk_id, rank, round(final_score, 6) as final_score from final where rank <= 8")
def final_rank_parent_cap(spark: SparkSession, d: str) -> DataFrame:
    return _final(spark, d, 8).select("query_id", "chunk_id", F.col("rank").cast("long"), F.round("final_score", 6).alias("final_score"))


def _results(spark: SparkSession, d: str) -> DataFrame:
    return _final(spark, d, 10).select(F.col("query_id").alias("id"), "rank", "text", "page_start", "page_end")


def _plain(x: str) -> str:
    signs = "[`*_{}$^,。;:、()\\[\\]《》<>\"''“”‘’，；：（）\\s\\p{Z}\\x0B\\x1C-\\x1F\\x{85}]+"
    return f"regexp_replace(translate(replace(lower({Q.fold(f'coalesce({x}, {Q.lit(str())})')}), '\\%', '%'), '−—', '--'), '{signs}', '', 'g')"


_UNIT = f"'^(-?\\d+(?:\\.\\d+)?)({retrieval.UNITS})$'"
_METRICS = f"""{_FINAL}, res as (select query_id as id, rank, {_plain('text')} as plain, page_start, coalesce(page_end, page_start) as page_end from final where rank <= 10),
asked3 as (select id, modality, difficulty, list_filter(list_transform(list_distinct(coalesce(must_retrieve_keywords, [])), lambda w: {_plain('w')}), lambda w: length(w) > 0) as words, coalesce(page_no, case when len(page_range) = 2 then page_range[1] end) as a, coalesce(page_no, case when len(page_range) = 2 then page_range[2] end) as b, unnest([1, 3, 5, 10]) as k from questions),
hit as (select q.*, r.rank, case when a is not null then coalesce(page_start <= b and page_end >= a, false) end as on_page,
  list_filter(words, lambda w: contains(plain, w) or (regexp_matches(w, {_UNIT}) and contains(plain, regexp_extract(w, {_UNIT}, 2)) and regexp_matches(plain, '(^|[^0-9.])' || replace(regexp_extract(w, {_UNIT}, 1), '.', '[.]') || '($|[^0-9.])'))) as found
  from asked3 q left join res r on r.id = q.id and r.rank <= q.k),
pm as (select id, modality, difficulty, k, bool_or(on_page) as page_hit, cast(max(len(words)) as bigint) as n_keywords, cast(len(list_distinct(flatten(list(coalesce(found, []))))) as bigint) as n_hits, cast(coalesce(max(len(found)), 0) as bigint) as best_single from hit group by id, modality, difficulty, k),
metrics as (select *, case when n_keywords > 0 then round(n_hits / n_keywords, 4) else 1.0 end as coverage, case when n_keywords > 0 then round(n_hits / n_keywords, 4) else 1.0 end >= 0.60 as content_success, n_hits = n_keywords as strict_success,
  case when n_keywords > 0 then round(n_hits / n_keywords, 4) else 1.0 end >= 0.60 and coalesce(page_hit, true) as grounded from pm)"""


@_query(f"with {_METRICS} select * from metrics")
def retrieval_prefix_metrics(spark: SparkSession, d: str) -> DataFrame:
    return retrieval.prefix_metrics(_questions(spark, d), _results(spark, d))


@_query(f"""with {_METRICS} select k, case when grouping(modality) = 0 then 'modality' when grouping(difficulty) = 0 then 'difficulty' else 'overall' end as grouped_by, coalesce(modality, difficulty, 'all') as value, count(*) as n_questions,
round(count(*) filter (page_hit) / greatest(1, count(page_hit)), 4) as page_hit_rate, round(avg(cast(content_success as double)), 4) as content_success_rate, round(avg(cast(grounded as double)), 4) as grounded_rate, round(avg(cast(strict_success as double)), 4) as strict_rate
from metrics group by grouping sets ((k), (k, modality), (k, difficulty))""")
def retrieval_metric_groups(spark: SparkSession, d: str) -> DataFrame:
    return retrieval.metric_groups(retrieval.prefix_metrics(_questions(spark, d), _results(spark, d)))


@_query(f"""select id, count(*) as n_chunks from (select id, coalesce(page_no, page_range[1]) as a, coalesce(page_no, page_range[2]) as b from questions) q
join {Q.CHUNKS} c on c.page_start <= q.b and coalesce(c.page_end, c.page_start) >= q.a group by id""")
def question_page_overlap(spark: SparkSession, d: str) -> DataFrame:
    pages = F.coalesce(F.col("page_no"), F.try_element_at("page_range", F.lit(1))).alias("a"), F.coalesce(F.col("page_no"), F.try_element_at("page_range", F.lit(2))).alias("b")
    asked = _questions(spark, d).select("id", *pages).select("id", F.explode(F.sequence("a", "b")).alias("page"), "a")
    # an interval join without a nested loop: pages as equi keys, a pair counted at its first common page
    own = _chunks(spark, d).where("page_start is not null").select("chunk_id", "page_start", F.coalesce("page_end", "page_start").alias("page_end")).where("page_end >= page_start")
    spans = own.groupBy("page_start", "page_end").agg(F.count("*").alias("n")).select("page_start", "n", F.explode(F.sequence("page_start", "page_end")).alias("page"))
    return asked.join(spans, "page").where(F.col("page") == F.greatest("a", "page_start")).groupBy("id").agg(F.sum("n").alias("n_chunks"))


# block quality


@_query(f"""with b as (select block_id, content, {Q.compact('content')} as flat from {Q.BLOCKS} where block_type in ('text', 'title', 'footnote')),
c as (select block_id, unnest(list_distinct(string_split(flat, ''))) as ch, flat from b where length(flat) >= 8),
m as (select block_id, max(length(flat) - length(replace(flat, ch, ''))) / any_value(length(flat)) as share from c where ch <> '' group by block_id)
select block_id, concat_ws(',', case when length(flat) > 0 and regexp_matches(flat, '(?i)(?:█{{3,}}|\\*{{5,}}|已脱敏|已遮挡|redacted)') then 'SRC-004' end,
  case when coalesce(share >= 0.45, false) then 'TXT-002' end, case when length(flat) > 0 and (contains(content, '�') or regexp_matches(content, '[?？]{{4,}}')) then 'TXT-001' end,
  case when not coalesce(share >= 0.45, false) and length(flat) > 0 and regexp_matches(content, '(?:[0-9]+[A-Za-z]+|[A-Za-z]+[0-9]+)[^\\n]*[¥￥$]|[¥￥$][^\\n]*(?:[0-9]+[A-Za-z]+)') then 'TXT-002' end) as flags
from b left join m using (block_id)""")
def text_quality_flags(spark: SparkSession, d: str) -> DataFrame:
    b = _blocks(spark, d).where("block_type in ('text', 'title', 'footnote')")
    return b.select("block_id", F.array_join(quality.text_flags(F.col("content")), ",").alias("flags"))


@_query(f"""select block_id, ({Q.blank('content')} or length(replace(content, '{{', '')) <> length(replace(content, '}}', '')) or length(replace(content, '(', '')) <> length(replace(content, ')', '')) or length(replace(content, '[', '')) <> length(replace(content, ']', ''))) as flagged
from {Q.BLOCKS} where block_type = 'formula'""")
def formula_flags(spark: SparkSession, d: str) -> DataFrame:
    return _blocks(spark, d).where("block_type = 'formula'").select("block_id", (F.size(quality.formula_flags(F.col("content"))) > 0).alias("flagged"))


@_query()
def gate_decisions(spark: SparkSession, d: str) -> DataFrame:
    return quality.gated_blocks(_blocks(spark, d)).select("block_id", F.array_join("flags", ",").alias("flags"), "decision", "task")


_ROUTED = ", ".join(f"'{f}'" for f in quality.ROUTING_FLAGS)


@_query(f"""select block_id, case when list_contains(f, 'SRC-004') then 'unreadable' when list_has_any(f, [{_ROUTED}]) then 'second_reading' else 'accept' end as decision
from (select block_id, coalesce(issue_flags, []) as f from {Q.BLOCKS})""")
def stored_flag_gate(spark: SparkSession, d: str) -> DataFrame:
    flags = F.coalesce("issue_flags", F.array().cast("array<string>"))
    return _blocks(spark, d).select("block_id", quality.gate(flags).alias("decision"))


@_query(f"select block_type, coalesce(status, 'none') as status, coalesce(source, 'none') as source, count(*) as n from {Q.BLOCKS} group by all")
def status_counts(spark: SparkSession, d: str) -> DataFrame:
    b = table(spark, d, "blocks", "block_id", "block_type", "status", "source").dropDuplicates(["block_id"])
    return b.groupBy("block_type", F.coalesce("status", F.lit("none")).alias("status"), F.coalesce("source", F.lit("none")).alias("source")).agg(F.count("*").alias("n"))


@_query(f"select flag, count(*) as n from (select unnest(issue_flags) as flag from {Q.BLOCKS}) group by flag")
def flag_counts(spark: SparkSession, d: str) -> DataFrame:
    b = table(spark, d, "blocks", "block_id", "issue_flags").dropDuplicates(["block_id"])
    return b.select(F.explode("issue_flags").alias("flag")).groupBy("flag").agg(F.count("*").alias("n"))


@_query(f"""select block_id, {Q.ELIGIBLE} as eligible, case when {Q.PROVISIONAL} then 'provisional' else 'verified' end as tier,
case when {Q.PROVISIONAL} and not {Q.blank('raw_content')} then 'raw' else 'resolved' end as content_basis from {Q.BLOCKS}""")
def eligible_tiers(spark: SparkSession, d: str) -> DataFrame:
    return quality.tiers(_blocks(spark, d))


# layout


@_query(f"""with b as (select b.*, {Q.template_key('content')} as key from {Q.BLOCKS} b where bbox is not null and not {Q.blank('content')}), p as (select * from b where length(key) between 1 and 120),
tall as (select document_id, page_no, max(bbox.y1) as max_y from p group by all),
sizes as (select document_id, page_no, case when height > 0 and max_y <= height * 1.5 then height else coalesce(nullif(max_y, 0), nullif(height, 0), 1.0) end as h from tall left join page_layout using (document_id, page_no)),
n as (select document_id, greatest(2, floor(count(distinct page_no) * 0.6 + 0.5)) as needed from blocks group by document_id having count(distinct page_no) >= 2),
often as (select document_id, key from p join n using (document_id) group by document_id, key, needed having count(distinct page_no) >= needed),
j as (select p.*, (bbox.y0 + bbox.y1) / 2 / h as y, o.key is not null as repeated from p join sizes using (document_id, page_no) join n using (document_id) left join often o on o.document_id = p.document_id and o.key = p.key),
k as (select block_id, case when regexp_matches({Q.compact('content')}, '^(?:第)?[-—–]?\\s*[0-9]+\\s*(?:页|/\\s*[0-9]+)?$') and y >= 0.78 then 'page_number' when repeated and y <= 0.14 then 'repeated_header' when repeated and y >= 0.86 then 'repeated_footer' end as template_kind from j)
select * from k where template_kind is not null""")
def template_blocks(spark: SparkSession, d: str) -> DataFrame:
    return layout.templates(_blocks(spark, d), _pages(spark, d))


_SIZES = "(select document_id, page_no, coalesce(nullif(height, 0), 1000.0) as ph, coalesce(nullif(width, 0), 1000.0) as pw from page_layout)"
_CONTEXT = f"""tb as (select document_id, page_no, block_id as table_id, bbox as t, position as tp from {Q.BLOCKS} where block_type = 'table' and bbox is not null),
cb as (select document_id, page_no, block_id as context_id, block_type, bbox as c, content, text_level, {Q.kind('content', 'block_type')} as kind from {Q.BLOCKS} where block_type in ('title', 'text', 'footnote') and bbox is not null and not {Q.blank('content')} and not coalesce(skip_chunk, false)),
pr as (select *, coalesce(s.ph, 1000.0) as h, coalesce(s.pw, 1000.0) as w, not (c.x1 < t.x0 or c.x0 > t.x1) as aligned, t.y0 - c.y1 as above, c.y0 - t.y1 as below, greatest(0, c.y1 - c.y0) as ch, greatest(0, c.x1 - c.x0) as cw, greatest(0, t.y1 - t.y0) as th
  from tb join cb using (document_id, page_no) left join {_SIZES} s using (document_id, page_no)),
context as (select document_id, context_id, table_id, kind from pr where case when above between 0 and h * 0.09 and aligned then kind <> 'title' or block_type = 'title' or text_level is not null or (length({Q.compact('content')}) <= 50 and not contains(content, chr(10)) and not regexp_matches(content, '[。！？；]'))
  else (kind = 'note' and below between 0 and h * 0.08 and aligned) or (ch >= cw * 1.4 and least(abs(t.x0 - c.x1), abs(c.x0 - t.x1)) <= w * 0.08 and greatest(0, least(c.y1, t.y1) - greatest(c.y0, t.y0)) >= least(ch, th) * 0.25) end
  qualify row_number() over (partition by context_id order by tp, table_id) = 1)"""


@_query(f"with {_CONTEXT} select context_id, table_id, kind from context")
def table_context(spark: SparkSession, d: str) -> DataFrame:
    return layout.table_context(_blocks(spark, d), _pages(spark, d)).drop("document_id")


@_query(f"""with {_CONTEXT}, s as (select c.table_id, c.context_id, {Q.strip('b.content')} as caption, position, case when kind = 'title' and length({Q.compact('b.content')}) >= 4 then 0 else 1 end as plain,
  case when b.bbox is null or t.bbox is null then 'infinity'::double when b.bbox.y1 <= t.bbox.y0 then t.bbox.y0 - b.bbox.y1 else abs(t.bbox.x0 - b.bbox.x1) end as gap, coalesce(list_position(['title', 'reference', 'date', 'unit', 'note'], kind) - 1, 5) as kind_rank
  from context c join {Q.BLOCKS} b on b.block_id = c.context_id join (select block_id, bbox from {Q.BLOCKS}) t on t.block_id = c.table_id)
select table_id, context_id as caption_block_id, caption from s qualify row_number() over (partition by table_id order by plain, gap, kind_rank, position, context_id) = 1""")
def table_captions(spark: SparkSession, d: str) -> DataFrame:
    b = _blocks(spark, d)
    return layout.table_captions(b, layout.table_context(b, _pages(spark, d)))


@_query(f"""select document_id, count(*) as attempted, count(*) filter (status in ('accepted', 'repaired')) as repaired, count(*) filter (status in ('review', 'unreadable')) as remaining
from {Q.BLOCKS} where block_id in (select block_id from vlm_results) group by document_id""")
def retry_counts(spark: SparkSession, d: str) -> DataFrame:
    """Blocks with second readings count as attempted."""
    tried = _blocks(spark, d).join(_readings(spark, d).select("block_id").distinct(), "block_id", "left_semi")
    return reports.retry_counts(tried.withColumnRenamed("status", "new_status"))


@_query(f"""with v as (select document_id, page_no, block_id, bbox as v from {Q.BLOCKS} where block_type in ('image', 'chart', 'formula') and bbox is not null),
c as (select document_id, page_no, block_id as caption_block_id, bbox as c, {Q.strip('content')} as caption, position from {Q.BLOCKS} where block_type in ('title', 'text', 'footnote', 'header') and bbox is not null and not {Q.blank('content')} and not coalesce(skip_chunk, false)),
n as (select *, coalesce(ph, 1000.0) as h from v join c using (document_id, page_no) left join {_SIZES} using (document_id, page_no) where c.y1 <= v.y0 qualify row_number() over (partition by block_id order by c.y1 desc, position, caption_block_id desc) = 1)
select block_id, caption, caption_block_id from n where v.y0 - c.y1 <= h * 0.12""")
def visual_captions(spark: SparkSession, d: str) -> DataFrame:
    return layout.visual_captions(_blocks(spark, d), _pages(spark, d))


@_query(f"""with t as (select b.*, {Q.compact('content')} as flat from {Q.BLOCKS} b left join {_SIZES} s using (document_id, page_no) where block_type = 'text' and bbox is not null and not {Q.blank('content')} and bbox.y0 <= coalesce(ph, 1000.0) * 0.20
  qualify row_number() over (partition by document_id, page_no order by bbox.y0, bbox.x0, position, block_id) <= 3),
p as (select document_id, page_no, block_id as duplicate_of, {Q.compact('content')} as other, position from {Q.BLOCKS} where not {Q.TEMPLATE} and not {Q.blank('content')})
select t.block_id, p.duplicate_of, p.page_no as from_page from t join p on p.document_id = t.document_id and p.page_no = t.page_no - 1
where length(flat) between 5 and 220 and contains(other, flat) and (length(flat) >= 12 or ends_with(other, flat)) qualify row_number() over (partition by t.block_id order by p.position desc, p.duplicate_of desc) = 1""")
def carry_over_dups(spark: SparkSession, d: str) -> DataFrame:
    return layout.carried_over(_blocks(spark, d), _pages(spark, d))


@_query(f"""select block_id, row_number() over w - 1 as place, lag(block_id) over w as previous_id, lead(block_id) over w as next_id from {Q.BLOCKS} window w as (partition by document_id, page_no order by position, block_id)""")
def block_links(spark: SparkSession, d: str) -> DataFrame:
    return layout.neighbours(_blocks(spark, d))


@_query()
def reading_order(spark: SparkSession, d: str) -> DataFrame:
    return layout.reading_order(_blocks(spark, d), _pages(spark, d))


def _sections(spark: SparkSession, d: str) -> DataFrame:
    b = _blocks(spark, d)
    return layout.section_paths(b, layout.table_context(b, _pages(spark, d)))


@_query(f"""with {_CONTEXT}, r as (select b.block_id, b.document_id, b.page_no, position, content, c.context_id is not null as bound, block_type, text_level, not {Q.blank('content')} and not {Q.TEMPLATE} as solid,
  (block_type = 'title' or text_level is not null) and not {Q.blank('content')} and c.context_id is null and {Q.kind('content', 'block_type')} = 'title' and length({Q.compact('content')}) <= 100 as is_heading from {Q.BLOCKS} b left join context c on c.context_id = b.block_id),
h as (select *, {Q.level('content')} as level from r where is_heading), counted as (select document_id, count(*) as n_headings, sum(level) as levels from h group by document_id)
select document_id, cast(n_headings as bigint) as n_headings, cast(levels as bigint) as levels from counted""")
def heading_levels(spark: SparkSession, d: str) -> DataFrame:
    s = _sections(spark, d).where("is_heading").join(_blocks(spark, d).select("block_id", "document_id"), "block_id")
    return s.groupBy("document_id").agg(F.count("*").alias("n_headings"), F.sum("level").alias("levels"))


_LEVELS = range(1, 6)
_PATHS = f"""r as (select b.block_id, b.document_id, b.page_no, row_number() over (partition by b.document_id order by b.page_no, position, b.block_id) as pos, {Q.strip('content')} as title, {Q.level('content')} as level, not {Q.blank('content')} and not {Q.TEMPLATE} as solid,
  (block_type = 'title' or text_level is not null) and not {Q.blank('content')} and c.context_id is null and {Q.kind('content', 'block_type')} = 'title' and length({Q.compact('content')}) <= 100 as is_heading from {Q.BLOCKS} b left join context c on c.context_id = b.block_id),
k as (select *, lag(is_heading) over w as ahead, lag(title) over w as ahead_title from r where is_heading or solid window w as (partition by document_id, page_no order by pos)),
h as (select document_id, block_id, pos, level, case when ahead and regexp_full_match({Q.compact('ahead_title')}, '第[一二三四五六七八九十百\\d]+[编章节篇]') and level = 1 and not regexp_matches({Q.compact('title')}, '^(?:第|专栏|专题)') then ahead_title || ' ' || title else title end as title from k where is_heading),
g as (select *, {', '.join(f"last_value(case when level = {n} then pos end ignore nulls) over w as p{n}, last_value(case when level = {n} then title end ignore nulls) over w as t{n}, last_value(case when level < {n} then pos end ignore nulls) over w as c{n}" for n in _LEVELS)}
  from h window w as (partition by document_id order by pos rows between unbounded preceding and current row)),
paths as (select block_id, level, concat_ws(' / ', {', '.join(f"case when level >= {n} and p{n} is not null and (c{n} is null or p{n} > c{n}) then t{n} end" for n in _LEVELS)}) as path from g)"""


@_query(f"""with {_CONTEXT}, {_PATHS} select r.block_id, r.is_heading, cast(case when r.is_heading then p.level end as bigint) as level, coalesce(last_value(path ignore nulls) over (partition by r.document_id order by pos rows between unbounded preceding and current row), '') as section_path from r left join paths p using (block_id)""")
def section_paths(spark: SparkSession, d: str) -> DataFrame:
    return _sections(spark, d)


@_query()
def structure_summary(spark: SparkSession, d: str) -> DataFrame:
    b, p = _blocks(spark, d), _pages(spark, d)
    return evaluation.structure_summary(b, _sections(spark, d), layout.table_context(b, p), layout.carried_over(b, p))


@_query("select document_id, cast(floor((page_no - 1) / 64) as bigint) as unit_no, min(page_no) as first_page, max(page_no) as last_page, count(distinct page_no) as n_pages from page_layout group by all")
def work_units(spark: SparkSession, d: str) -> DataFrame:
    return evaluation.work_units(_pages(spark, d))


# text layer and readings


@_query(f"""select b.block_id, count(*) as n_lines from {Q.BLOCKS} b join {_TEXT_LINES} l on b.document_id = l.document_id and b.page_no = l.page_no where b.bbox is not null and {Q.covers('b.bbox', 'l.bbox')} group by b.block_id""")
def span_covers(spark: SparkSession, d: str) -> DataFrame:
    return audit.covered_lines(_blocks(spark, d), _text_lines(spark, d)).groupBy("block_id").agg(F.count("*").alias("n_lines"))


@_query(f"""select b.block_id, sha256(string_agg(l.text, ' ' order by l.line_no)) as reference_hash from {Q.BLOCKS} b join {_TEXT_LINES} l on b.document_id = l.document_id and b.page_no = l.page_no where b.bbox is not null and {Q.covers('b.bbox', 'l.bbox')} group by b.block_id""")
def block_reference(spark: SparkSession, d: str) -> DataFrame:
    refs = audit.block_references(audit.covered_lines(_blocks(spark, d), _text_lines(spark, d)))
    return refs.select("block_id", F.sha2("reference", 256).alias("reference_hash"))


@_query(f"""with t as (select document_id, page_no, block_id as table_id, bbox as t, position from {Q.BLOCKS} where block_type = 'table' and bbox is not null),
p as (select l.document_id, l.page_no, l.line_no, table_id, position, greatest(0, t.y0 - l.bbox.y1, l.bbox.y0 - t.y1) as gap from {_TEXT_LINES} l join t using (document_id, page_no) where least(t.x1, l.bbox.x1) - greatest(t.x0, l.bbox.x0) > 0)
select document_id, page_no, line_no, table_id, cast(gap as double) as gap from p where gap <= 90 qualify row_number() over (partition by document_id, page_no, line_no order by gap, position, table_id) = 1""")
def nearest_table(spark: SparkSession, d: str) -> DataFrame:
    return audit.nearest_table(_blocks(spark, d), _text_lines(spark, d))


_MARGINS = f"""{_LAYER}, edge as (select * from layer where (bbox.y1 <= 110 or bbox.y0 >= 890) and norm <> ''), needed as (select document_id, greatest(3, floor(count(distinct page_no) * 0.35)) as needed from page_layout group by document_id),
margins as (select document_id, norm, count(distinct page_no) as n_pages from edge join needed using (document_id) group by document_id, norm, needed having count(distinct page_no) >= needed)"""


@_query(f"with {_MARGINS} select * from margins")
def repeated_margin(spark: SparkSession, d: str) -> DataFrame:
    return audit.repeated_margins(_text_lines(spark, d), _pages(spark, d))


_RELIABILITY = f"""tx as (select block_id, document_id, page_no, bbox, {Q.normal(Q.flat('content'))} as flat from {_DELIVERED} where block_type not in ('image', 'chart', 'header', 'footer', 'page_number') and not {Q.blank('content')} and bbox is not null),
w as (select document_id, cast(sum(len(list_filter(regexp_split_to_array(trim(text), '\\s+'), lambda x: length(x) > 0))) as bigint) as n_words from layer group by document_id),
m as (select l.document_id, l.page_no, l.line_no, bool_or({Q.alike('norm', 'flat')}) as matched from tx join layer l on tx.document_id = l.document_id and tx.page_no = l.page_no where length(norm) >= 4 and {Q.covers('tx.bbox', 'l.bbox')} group by all),
a as (select document_id, count(*) as n_comparable, count(*) filter (matched) as n_matched from m group by document_id),
reliability as (select document_id, n_words, cast(0 as bigint) as n_invalid, coalesce(n_comparable, 0) as n_comparable, coalesce(n_matched, 0) as n_matched, round(coalesce(n_matched / n_comparable, 0), 6) as agreement,
  n_words >= 20 and coalesce(n_comparable, 0) >= 20 and coalesce(n_matched / n_comparable, 0) >= 0.72 as reliable from w left join a using (document_id))"""


@_query(f"with {_LAYER}, {_RELIABILITY} select * from reliability")
def text_layer_reliability(spark: SparkSession, d: str) -> DataFrame:
    return audit.layer_reliability(_delivered_blocks(spark, d), _text_lines(spark, d))


def _references(spark: SparkSession, d: str) -> DataFrame:
    return audit.block_references(audit.covered_lines(_blocks(spark, d), _text_lines(spark, d)))


@_query()
def text_layer_findings(spark: SparkSession, d: str) -> DataFrame:
    return audit.text_findings(_raw_blocks(spark, d), _references(spark, d))


_SURPLUS = "array_to_string(flatten(list_transform(list_sort(list_distinct({a})), lambda v: list_transform(range(greatest(0, len(list_filter({a}, lambda x: x = v)) - len(list_filter({b}, lambda x: x = v)))), lambda i: v))), ' ')"


@_query(f"""with r as (select block_id, max_by(html, (created_at, result_id)) as html from (select distinct on (result_id) * from vlm_results order by result_id) where length(html) > 0 group by block_id),
p as (select block_id, {Q.numbers(Q.plain('content'))} as ours, {Q.numbers(Q.plain(Q.flat('html')))} as theirs from {_RAW} join r using (block_id) where block_type = 'table' and not {Q.blank('content')} and length({Q.normal(Q.flat('content'))}) > 0 and length({Q.normal(Q.flat('html'))}) > 0),
s as (select block_id, {_SURPLUS.format(a='theirs', b='ours')} as missing, {_SURPLUS.format(a='ours', b='theirs')} as added from p where len(ours) > 0 and len(theirs) > 0 and least(len(ours), len(theirs)) >= 0.85 * greatest(len(ours), len(theirs)))
select * from s where len(list_filter(string_split(missing || ' ' || added, ' '), lambda v: regexp_matches(v, '[.%]') or length(regexp_replace(v, '^[-+0]+', '')) >= 2)) > 0""")
def table_layer_findings(spark: SparkSession, d: str) -> DataFrame:
    """The second readings of tables stand in for a text layer, which has no lines of tables."""
    read = audit.latest_reading(_readings(spark, d).where("length(html) > 0"))
    return audit.table_findings(_raw_blocks(spark, d), read.select("block_id", tables.flat_text("html").alias("reference")))


_UNCOVERED = f"""{_MARGINS}, blk as (select * from {_DELIVERED}), whole as (select document_id, page_no, string_agg({Q.normal(Q.flat('content'))}, '' order by position, block_id) as whole from blk where not {Q.blank('content')} group by all),
todo as (select l.* from layer l left join whole using (document_id, page_no) where length(norm) >= 2 and (document_id, norm) not in (select document_id, norm from margins) and not contains(coalesce(whole, ''), norm)),
seen as (select l.document_id, l.page_no, l.line_no, bool_or(block_type in ('image', 'chart')) as visual, bool_or(block_type not in ('image', 'chart', 'header', 'footer', 'page_number') and not {Q.blank('content')}) as semantic,
  arg_min(case when block_type not in ('image', 'chart', 'header', 'footer', 'page_number') and {Q.blank('content')} then block_id end, case when block_type not in ('image', 'chart', 'header', 'footer', 'page_number') and {Q.blank('content')} then (-{Q.share('l.bbox', 'b.bbox')}, position, block_id) end) as target_id
  from todo l join blk b on b.document_id = l.document_id and b.page_no = l.page_no where b.bbox is not null and {Q.covers('b.bbox', 'l.bbox')} group by all),
uncovered as (select t.*, case when visual then 'visual_covered' when semantic then 'semantic_covered' when target_id is not null then 'fill' else 'gap' end as outcome, target_id from todo t left join seen using (document_id, page_no, line_no))"""


def _uncovered(spark: SparkSession, d: str) -> DataFrame:
    lines = audit.page_lines(_text_lines(spark, d))
    return audit.uncovered_lines(_delivered_blocks(spark, d), lines, audit.repeated_margins(lines, _pages(spark, d)))


@_query(f"with {_UNCOVERED} select document_id, page_no, line_no, text, outcome, case when outcome = 'fill' then target_id end as target_id from uncovered")
def uncovered_lines(spark: SparkSession, d: str) -> DataFrame:
    return _uncovered(spark, d).select("document_id", "page_no", "line_no", "text", "outcome", "target_id")


@_query(f"""with {_UNCOVERED}, {_RELIABILITY} select target_id as block_id, case when coalesce(reliable, false) then string_agg(text, chr(10) order by line_no) else '' end as resolved_content, case when coalesce(reliable, false) then 'repaired' else 'review' end as status
from uncovered left join reliability using (document_id) where outcome = 'fill' group by target_id, reliable""")
def filled_blocks(spark: SparkSession, d: str) -> DataFrame:
    reliability = audit.layer_reliability(_delivered_blocks(spark, d), _text_lines(spark, d))
    return audit.filled_blocks(_uncovered(spark, d), reliability).select("block_id", "resolved_content", "status")


@_query(f"""with {_UNCOVERED}, {_RELIABILITY}, tb as (select document_id, page_no, block_id as table_id, bbox as t, position from blk where block_type = 'table' and bbox is not null),
near as (select u.document_id, u.page_no, u.line_no, table_id, t.y0 as top from uncovered u join tb on tb.document_id = u.document_id and tb.page_no = u.page_no where outcome = 'gap' and least(t.x1, u.bbox.x1) - greatest(t.x0, u.bbox.x0) > 0
  and greatest(0, t.y0 - u.bbox.y1, u.bbox.y0 - t.y1) <= 90 qualify row_number() over (partition by u.document_id, u.page_no, u.line_no order by greatest(0, t.y0 - u.bbox.y1, u.bbox.y0 - t.y1), position, table_id) = 1),
size as (select document_id, page_no, count(*) as n from blk group by all)
select document_id, page_no, case when regexp_matches(text, {Q.lit(audit.SOURCE_NOTE)}) then 'footnote' when regexp_matches(text, {Q.lit(audit.TITLE_WORDS)}) or coalesce(bbox.y1 <= top + 15 and length(norm) <= 40 and greatest(0, bbox.x1 - bbox.x0) <= 650, false) then 'title' else 'text' end as block_type,
case when coalesce(reliable, false) then {Q.strip('text')} else '' end as resolved_content, case when table_id is null then 'TXT-004' else 'TXT-004,TAB-008' end as issue_flags, cast(coalesce(n, 0) as integer) as reading_order, case when coalesce(reliable, false) then 'repaired' else 'review' end as status, table_id as associated_table_id
from uncovered u left join near using (document_id, page_no, line_no) left join size using (document_id, page_no) left join reliability using (document_id) where outcome = 'gap'""")
def gap_blocks(spark: SparkSession, d: str) -> DataFrame:
    b = _delivered_blocks(spark, d)
    made = audit.gap_blocks(b, _uncovered(spark, d), audit.layer_reliability(b, _text_lines(spark, d)))
    return made.select("document_id", "page_no", "block_type", "resolved_content", F.array_join("issue_flags", ",").alias("issue_flags"), "reading_order", "status", "associated_table_id")


@_query()
def completed_blocks(spark: SparkSession, d: str) -> DataFrame:
    done = audit.completed_blocks(_delivered_blocks(spark, d), _text_lines(spark, d), _pages(spark, d))
    return done.select("block_id", "document_id", "page_no", "block_type", "resolved_content", "source", "status", F.array_join("issue_flags", ",").alias("issue_flags"))


@_query("""select block_id, max_by(result_id, (created_at, result_id)) as result_id, epoch_us(max(created_at)) as created_us from vlm_results group by block_id""")
def latest_reading(spark: SparkSession, d: str) -> DataFrame:
    return audit.latest_reading(_readings(spark, d)).select("block_id", "result_id", F.unix_micros("created_at").alias("created_us"))


@_query()
def arbitration(spark: SparkSession, d: str) -> DataFrame:
    b = _raw_blocks(spark, d)
    differing = audit.text_findings(b, _references(spark, d)).select("block_id")
    refs = _references(spark, d).join(differing, "block_id", "left_semi")
    out = audit.arbitrate(b.where("block_type <> 'table'"), audit.latest_reading(_readings(spark, d)), refs)
    return out.select("block_id", "outcome", "new_status", "new_source", "eligible", "flag", F.sha2("new_content", 256).alias("content_hash"))


@_query()
def table_crosscheck(spark: SparkSession, d: str) -> DataFrame:
    got = audit.crosscheck_tables(_blocks(spark, d), audit.latest_reading(_readings(spark, d)))
    return got.select("block_id", "comparable", "agreed", "n_conflicts", "n_format_differences", "new_status", "tag", F.array_join("new_flags", ",").alias("new_flags"))


@_query()
def recovered_tables(spark: SparkSession, d: str) -> DataFrame:
    got = audit.recovered_tables(_blocks(spark, d), _readings(spark, d))
    return got.select("block_id", "agreed", "new_status", F.array_join("new_flags", ",").alias("new_flags"))


@_query(f"""with r as (select distinct on (result_id) * from vlm_results order by result_id), s as (select block_id, 'reading:' || coalesce(task, '') as source, coalesce(nullif(text, ''), nullif(html, ''), nullif(latex, ''), '') as content, created_at as t_at, result_id as tie from r where block_id in (select block_id from blocks)),
f as (select block_id, 'primary' as source, raw_content as content, null::timestamptz as t_at, '' as tie from {Q.BLOCKS} where block_id in (select block_id from s))
select block_id, row_number() over (partition by block_id order by t_at asc nulls first, tie) as revision_no, source, sha256(content) as content_hash from (select * from f union all select * from s)""")
def block_revisions(spark: SparkSession, d: str) -> DataFrame:
    return audit.revisions(_blocks(spark, d), _readings(spark, d)).select("block_id", "revision_no", "source", F.sha2("content", 256).alias("content_hash"))


@_query(f"""with p as (select b.block_id, {Q.compact('b.content')} as a, {Q.compact('r.text')} as b from {Q.BLOCKS} b join (select distinct on (result_id) * from vlm_results order by result_id) r using (block_id) where length(r.text) > 0 and block_type = 'text' qualify row_number() over (partition by b.block_id order by r.created_at desc, r.result_id desc) = 1),
c as (select block_id, a, b, unnest(list_distinct(string_split(a, ''))) as ch from p), m as (select block_id, sum(least(length(a) - length(replace(a, ch, '')), length(b) - length(replace(b, ch, '')))) as matched from c where ch <> '' group by block_id)
select block_id, round(2.0 * matched / (length(a) + length(b)), 6) as f1 from p join m using (block_id) where length(a) > 0 and length(b) > 0""")
def char_f1(spark: SparkSession, d: str) -> DataFrame:
    r = audit.latest_reading(_readings(spark, d).where("length(text) > 0"))
    p = _blocks(spark, d).where("block_type = 'text'").join(r.select("block_id", F.col("text").alias("t")), "block_id").select("block_id", T.compact(F.col("content")).alias("a"), T.compact(F.col("t")).alias("b"))
    return p.where("length(a) > 0 and length(b) > 0").select("block_id", F.round(T.char_f1(F.col("a"), F.col("b")), 6).alias("f1"))


@_query(f"""with p as (select b.block_id, {Q.numbers('b.content')} as a, {Q.numbers('r.text')} as b from {Q.BLOCKS} b join (select block_id, max_by(text, (created_at, result_id)) as text from vlm_results where length(text) > 0 group by block_id) r using (block_id) where block_type = 'text'),
l as (select block_id, unnest(a) as v from p), r as (select block_id, unnest(b) as v from p)
select block_id, v, 'lost' as side, count(*) as n from (select * from l except all select * from r) group by all union all select block_id, v, 'added', count(*) from (select * from r except all select * from l) group by all""")
def number_multiset_diff(spark: SparkSession, d: str) -> DataFrame:
    r = audit.latest_reading(_readings(spark, d).where("length(text) > 0"))
    p = _blocks(spark, d).where("block_type = 'text'").join(r.select("block_id", F.col("text").alias("t")), "block_id").select("block_id", T.number_tokens(F.col("content")).alias("a"), T.number_tokens(F.col("t")).alias("b"))
    a, b = p.select("block_id", F.explode("a").alias("v")), p.select("block_id", F.explode("b").alias("v"))
    side = lambda x, y, s: x.exceptAll(y).groupBy("block_id", "v").agg(F.count("*").alias("n")).select("block_id", "v", F.lit(s).alias("side"), "n")
    return side(a, b, "lost").unionByName(side(b, a, "added"))


@_query()
def text_change_report(spark: SparkSession, d: str) -> DataFrame:
    return reports.text_changes(_blocks(spark, d))


@_query()
def text_change_counts(spark: SparkSession, d: str) -> DataFrame:
    return reports.change_counts(reports.text_changes(_blocks(spark, d)))


@_query()
def line_coverage(spark: SparkSession, d: str) -> DataFrame:
    return reports.line_coverage(_blocks(spark, d), _text_lines(spark, d))


# tables


def _grids(spark: SparkSession, d: str) -> DataFrame:
    return tables.with_grids(_blocks(spark, d).where("block_type = 'table'"), "block_id", "content")


@_query(f"""with t as (select block_id, string_split_regex(regexp_extract(content, '(?is)<table(.*?)(?:</table|$)', 1), '(?i)<tr[\\s>/]')[2:] as rows from {Q.BLOCKS} where block_type = 'table'),
r as (select block_id, unnest(rows) as row from t), c as (select block_id, list_sum(list_transform(regexp_extract_all(row, '(?is)<t[dh](?:\\s[^>]*)?>'), lambda x: coalesce(try_cast(nullif(regexp_extract(x, '(?i)colspan\\s*=\\s*["'']?(\\d+)', 1), '') as bigint), 1))) as n from r)
select t.block_id, cast(coalesce(max(n), 0) as bigint) as n_columns from t left join c using (block_id) group by t.block_id""")
def table_column_counts(spark: SparkSession, d: str) -> DataFrame:
    return _blocks(spark, d).where("block_type = 'table'").select("block_id", tables.column_count(F.col("content")).alias("n_columns"))


@_query()
def table_cells(spark: SparkSession, d: str) -> DataFrame:
    return tables.table_cells(_grids(spark, d), "block_id")


@_query()
def header_paths(spark: SparkSession, d: str) -> DataFrame:
    return tables.table_headers(_grids(spark, d), "block_id")


@_query()
def table_records(spark: SparkSession, d: str) -> DataFrame:
    r = tables.table_records(_grids(spark, d), "block_id")
    return r.select("block_id", "row_index", "source_page", tables.record_text(F.col("headers"), F.col("row"), F.col("source_page")).alias("record"))


@_query()
def table_row_groups(spark: SparkSession, d: str) -> DataFrame:
    return tables.row_groups(tables.table_records(_grids(spark, d), "block_id"), "block_id")


@_query()
def continuation_pairs(spark: SparkSession, d: str) -> DataFrame:
    return tables.continuation_pairs(_blocks(spark, d), _pages(spark, d))


@_query()
def merged_tables(spark: SparkSession, d: str) -> DataFrame:
    b = _blocks(spark, d)
    pairs = tables.continuation_pairs(b, _pages(spark, d))
    answers = _readings(spark, d).where("is_continuation").select(F.col("block_id").alias("current_id")).distinct()
    asked = pairs.join(answers, "current_id", "left_semi").select("previous_id", "current_id", F.lit(True).alias("same"))
    return tables.merged_tables(b, pairs, asked).drop("child_ids")


@_query()
def unsafe_merges(spark: SparkSession, d: str) -> DataFrame:
    pairs = tables.continuation_pairs(_blocks(spark, d), _pages(spark, d))
    merges = pairs.where("edge_continuity or score >= 0.48").select(F.col("previous_id").alias("root_id"), F.col("current_id").alias("child_id"), (F.col("previous_page") + 1).alias("page_no"))
    return tables.unsafe_merges(merges, pairs)


# chunks


def _built(spark: SparkSession, d: str) -> DataFrame:
    b, p = _blocks(spark, d), _pages(spark, d)
    return chunks.build_chunks(b, layout.table_context(b, p), layout.visual_captions(b, p))


@_query()
def text_chunks(spark: SparkSession, d: str) -> DataFrame:
    c = _built(spark, d)
    return c.select("chunk_id", "document_id", "chunk_role", "chunk_index", "parent_id", "block_type", "section_path", "display_text", "embedding_text", F.array_join("source_block_ids", ",").alias("source_block_ids"), "page_start", "page_end", "retrieval_tier")


@_query()
def chunk_links(spark: SparkSession, d: str) -> DataFrame:
    return chunks.link_chunks(cut_lineage(_built(spark, d))).select("chunk_id", "document_order", "local_role_order", "previous_chunk_id", "next_chunk_id", "sibling_index", "previous_sibling_id", "next_sibling_id")


@_query()
def section_block_ids(spark: SparkSession, d: str) -> DataFrame:
    b, s = _blocks(spark, d), _sections(spark, d)
    placed = b.drop("section_path").join(s.select("block_id", F.when(F.length("section_path") > 0, F.split("section_path", " / ")).alias("section_path")), "block_id")
    units = placed.select(F.col("block_id").alias("chunk_id"), "document_id", F.array_join("section_path", " / ").alias("section_path"))
    return chunks.section_block_ids(units, b, s).select(F.col("chunk_id").alias("block_id"), F.array_join("section_block_ids", ",").alias("section_block_ids"))


@_query()
def built_chunk_audit(spark: SparkSession, d: str) -> DataFrame:
    return evaluation.chunk_audit(cut_lineage(_built(spark, d)))


@_query(f"""select chunk_id, row_number() over w - 1 as document_order, lag(chunk_id) over w as previous_chunk_id, lead(chunk_id) over w as next_chunk_id from {Q.CHUNKS} window w as (partition by document_id order by page_start nulls first, page_end nulls first, chunk_id)""")
def stored_chunk_links(spark: SparkSession, d: str) -> DataFrame:
    rows = document_order(_chunks(spark, d).select("chunk_id", "document_id", "page_start", "page_end"), "document_id", "page_start", ["page_end", "chunk_id"])
    return linked(rows, "document_id", "page_start", ["page_end", "chunk_id"], "chunk_id").select("chunk_id", "document_order", "previous_chunk_id", "next_chunk_id")


@_query(f"select chunk_id, row_number() over (partition by parent_id order by page_start, chunk_id) - 1 as sibling_index from {Q.CHUNKS} where parent_id is not null")
def sibling_links(spark: SparkSession, d: str) -> DataFrame:
    w = Window.partitionBy("parent_id").orderBy("page_start", "chunk_id")
    return _chunks(spark, d).where("parent_id is not null").select("chunk_id", (F.row_number().over(w) - 1).cast("long").alias("sibling_index"))


@_query(f"""select case when grouping(chunk_role) = 0 then 'role' when grouping(block_type) = 0 then 'modality' else 'state' end as dimension, coalesce(chunk_role, block_type, embedding_state, 'unknown') as value, count(*) as n
from {Q.CHUNKS} group by grouping sets ((chunk_role), (block_type), (embedding_state))""")
def export_summary(spark: SparkSession, d: str) -> DataFrame:
    return evaluation.export_summary(_chunks(spark, d))


@_query(f"""select count(*) = count(distinct chunk_id) as chunk_ids_unique, bool_and(not {Q.blank('display_text')} and not {Q.blank('embedding_text')}) as all_chunks_nonempty,
bool_and(coalesce(json_array_length(metadata_json, '$.source_block_ids'), 0) > 0) as all_chunks_have_source_blocks from {Q.CHUNKS}""")
def export_validation(spark: SparkSession, d: str) -> DataFrame:
    return evaluation.export_validation(_chunks(spark, d))


@_query(f"select sha256({Q.collapse('display_text')}) as text_hash, count(*) as n_chunks, min(chunk_id) as first_id from {Q.CHUNKS} where length({Q.collapse('display_text')}) > 0 group by 1 having count(*) > 1")
def exact_duplicate_text(spark: SparkSession, d: str) -> DataFrame:
    return evaluation.exact_duplicates(_chunks(spark, d))


@_query(f"""with l as (select chunk_role, length(display_text) as n from {Q.CHUNKS} where display_text is not null), o as (select chunk_role, list_sort(list(n)) as v from l group by chunk_role)
select chunk_role, cast(len(v) as bigint) as n, cast(v[1] as bigint) as least, cast(floor((v[cast(floor((len(v) - 1) / 2) as int) + 1] + v[cast(floor(len(v) / 2) as int) + 1]) / 2) as bigint) as median, cast(v[cast(floor((len(v) - 1) * 0.95) as int) + 1] as bigint) as p95, cast(v[len(v)] as bigint) as most from o""")
def length_profile(spark: SparkSession, d: str) -> DataFrame:
    return evaluation.length_profile(_chunks(spark, d), "chunk_role", F.length("display_text"))


@_query(f"""with r as (select document_id, lag(page_start) over w > page_start as s, lag(page_end) over w > page_end as e from {Q.CHUNKS} window w as (partition by document_id order by chunk_id))
select document_id, count(*) filter (s) as n_start, count(*) filter (e) as n_end from r group by document_id""")
def order_regressions(spark: SparkSession, d: str) -> DataFrame:
    return evaluation.order_regressions(_chunks(spark, d).select("document_id", "page_start", "page_end", "chunk_id"))


_SECTIONS = f"len(list_filter(string_split(coalesce(section_path, ''), ' / '), lambda s: regexp_matches(s, {Q.lit(evaluation.BAD_SECTION)}))) > 0"


@_query(f"""with c as (select * from {Q.CHUNKS}), dup as (select count(*) as n from (select 1 from c where length({Q.collapse('display_text')}) > 0 group by {Q.collapse('display_text')} having count(*) > 1)),
one as (select unnest([{{'check': 'empty_chunk_set', 'severity': 'failure', 'n': (count(*) = 0)::bigint}}, {{'check': 'duplicate_chunk_id', 'severity': 'failure', 'n': count(*) - count(distinct chunk_id)}}, {{'check': 'empty_chunk_text', 'severity': 'failure', 'n': count(*) filter ({Q.blank('display_text')})}},
  {{'check': 'missing_source_blocks', 'severity': 'failure', 'n': count(*) filter (coalesce(json_array_length(metadata_json, '$.source_block_ids'), 0) < 1)}}, {{'check': 'exact_duplicate_text', 'severity': 'failure', 'n': (select n from dup)}},
  {{'check': 'bad_section_path', 'severity': 'failure', 'n': count(*) filter ({_SECTIONS})}}, {{'check': 'model_failure_placeholder', 'severity': 'failure', 'n': count(*) filter (length(coalesce(display_text, '')) <= 240 and coalesce({Q.placeholder("coalesce(display_text, '')")}, false))}},
  {{'check': 'text_chunk_over_target', 'severity': 'failure', 'n': count(*) filter (chunk_role = 'text_segment' and length(coalesce(display_text, '')) > 1200)}}, {{'check': 'short_text_chunk', 'severity': 'warning', 'n': count(*) filter (chunk_role = 'text_segment' and length(coalesce(display_text, '')) < 20)}},
  {{'check': 'long_chunk', 'severity': 'warning', 'n': count(*) filter (length(coalesce(embedding_text, '')) > 2400)}}], recursive := true) from c)
select * from one where n > 0 union all select 'score', 'score', greatest(0, 100 - 20 * count(*) filter (severity = 'failure' and n > 0) - least(20, count(*) filter (severity = 'warning' and n > 0))) from one""")
def chunk_audit(spark: SparkSession, d: str) -> DataFrame:
    return evaluation.chunk_audit(_chunks(spark, d))


@_query(f"""with {_CONTEXT}, rep as (select distinct unnest(from_json(json_extract(metadata_json, '$.source_block_ids'), '["VARCHAR"]')) as block_id from chunks),
x as (select block_id, concat_ws(',', case when skip_chunk then 'skip_chunk' end, case when not chunk_eligible then 'chunk_eligible_false' end, case when not coalesce(status in ('accepted', 'repaired'), false) then 'status_' || coalesce(status, 'unknown') end,
  case when {Q.TEMPLATE} then 'template_' || block_type end, case when {Q.blank('content')} then 'empty_content' end, case when coalesce({Q.placeholder('content')}, false) then 'model_failure_placeholder' end) as reasons, block_type = 'title' or c.context_id is not null as only_context
  from {Q.BLOCKS} b left join context c on c.context_id = b.block_id where block_id not in (select block_id from rep))
select block_id, case when reasons = '' and not only_context then 'eligible_semantic_block_not_emitted' else reasons end as reasons from x where reasons <> '' or not only_context""")
def excluded_blocks(spark: SparkSession, d: str) -> DataFrame:
    b = _blocks(spark, d)
    represented = _chunks(spark, d).select(F.explode("source_block_ids").alias("block_id"))
    return chunks.excluded_blocks(b, represented, layout.table_context(b, _pages(spark, d)))


@_query(f"""with r as (select *, {Q.strip(Q.CHUNK_CONTENT)} as text from {Q.BLOCKS} where not {Q.TEMPLATE})
select document_id, row_number() over (partition by document_id order by page_no, position, block_id) - 1 as article_order, block_id, case when {Q.PROVISIONAL} then 'provisional' else 'verified' end as tier,
case when {Q.PROVISIONAL} and not {Q.blank('raw_content')} then 'raw' else 'resolved' end as content_basis, sha256(text) as content_hash from r where length(text) > 0 and not coalesce({Q.placeholder('text')}, false)""")
def linear_units(spark: SparkSession, d: str) -> DataFrame:
    u = chunks.linear_units(_blocks(spark, d))
    return u.select("document_id", "article_order", "block_id", "tier", "content_basis", F.sha2("content", 256).alias("content_hash"))


@_query(f"""with u as (select block_id, list_filter(list_transform(regexp_extract_all(regexp_replace(content, '\\n\\s*\\n', chr(1), 'g'), '[^。！？!?；;\\x01]*[。！？!?；;]|[^。！？!?；;\\x01]+'), lambda x: {Q.strip('x')}), lambda x: length(x) > 0) as u from {Q.BLOCKS} where block_type = 'text')
select block_id, cast(len(u) as bigint) as n_units, coalesce(cast(list_sum(list_transform(u, lambda x: length(x))) as bigint), 0) as n_chars from u""")
def sentence_units(spark: SparkSession, d: str) -> DataFrame:
    """The chunker's units; with a size that no sentence exceeds."""
    u = _blocks(spark, d).where("block_type = 'text'").select("block_id", chunks.text_units(F.col("content"), 1 << 30, 0).alias("u"))
    return u.select("block_id", F.size("u").cast("long").alias("n_units"), F.aggregate("u", F.lit(0).cast("long"), lambda a, x: a + F.length(x)).alias("n_chars"))


@_query(f"""with u as (select block_id, {Q.strip("regexp_replace(content, '[。！？!?；;，、,:：]|\\n\\s*\\n', '', 'g')")} as t from {Q.BLOCKS} where length(content) > 0),
w as (select block_id, t, unnest(range(0, case when length(t) <= 1200 then 1 else length(t) end, 1080)) as o from u where length(t) > 0)
select block_id, cast(row_number() over (partition by block_id order by o) - 1 as bigint) as window_no, cast(length(substr(t, o + 1, 1200)) as bigint) as n_chars from w""")
def hard_windows(spark: SparkSession, d: str) -> DataFrame:
    """The chunker's fixed windows: of texts without any sign that it could cut at."""
    solid = T.strip(F.regexp_replace("content", r"[。！？!?；;，、,:：]|\n\s*\n", ""))
    w = _blocks(spark, d).where("length(content) > 0").select("block_id", F.posexplode(chunks.text_units(solid, 1200, 120)).alias("k", "w"))
    return w.select("block_id", F.col("k").cast("long").alias("window_no"), F.length("w").cast("long").alias("n_chars"))


@_query(f"""with s as (select block_id, document_id, page_no, position, block_type, {Q.CHUNK_CONTENT} as text, array_to_string(list_filter(coalesce(section_path, []), lambda x: x <> ''), ' / ') as section, {Q.ELIGIBLE} as usable from {Q.BLOCKS}),
n as (select * from s where usable and block_type in ('text', 'formula')),
x as (select block_id, block_type, last_value(case when block_type = 'text' then block_id end ignore nulls) over (w rows between unbounded preceding and 1 preceding) as before_id, first_value(case when block_type = 'text' then block_id end ignore nulls) over (w rows between 1 following and unbounded following) as after_id
  from n window w as (partition by document_id, page_no, section order by position, block_id))
select block_id, before_id, after_id from x where block_type = 'formula'""")
def formula_context(spark: SparkSession, d: str) -> DataFrame:
    b = _blocks(spark, d)
    rows = chunks.prepared(b, layout.table_context(b, _pages(spark, d)))
    return chunks.formula_neighbours(rows).select("block_id", F.col("before.block_id").alias("before_id"), F.col("after.block_id").alias("after_id"))


@_query(f"""with u as (select block_id, unnest(list_filter(list_transform(regexp_extract_all(regexp_replace(content, '\\n\\s*\\n', chr(1), 'g'), '[^。！？!?；;\\x01]*[。！？!?；;]|[^。！？!?；;\\x01]+'), lambda x: {Q.strip('x')}), lambda x: regexp_matches(x, {Q.lit(T.FACT)}))) as fact from {Q.BLOCKS} where block_type = 'chart')
select block_id, count(*) as n_facts from u group by block_id having count(*) > 1""")
def fact_units(spark: SparkSession, d: str) -> DataFrame:
    """The facts of charts; with a size that no sentence exceeds."""
    u = _blocks(spark, d).where("block_type = 'chart'").select("block_id", F.size(chunks.fact_units(F.col("content"), 1 << 30, 0)).cast("long").alias("n_facts"))
    return u.where("n_facts > 1")


@_query("select doc_id, left(sha256(concat_ws(':', source, 'text', cast(doc_id as varchar), coalesce(title, ''))), 32) as stable_id from documents")
def stable_ids(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "documents").select("doc_id", T.stable_id(F.col("source"), F.lit("text"), F.col("doc_id").cast("string"), F.coalesce("title", F.lit(""))).alias("stable_id"))


@_query(f"select doc_id, cast(len(n) as bigint) as n_numbers, sha256(array_to_string(list_sort(n), ' ')) as numbers_hash from (select doc_id, {Q.numbers('text')} as n from documents)")
def number_tokens(spark: SparkSession, d: str) -> DataFrame:
    n = table(spark, d, "documents", "doc_id", "text").select("doc_id", T.number_tokens(F.col("text")).alias("n"))
    return n.select("doc_id", F.size("n").cast("long").alias("n_numbers"), F.sha2(F.array_join(F.array_sort("n"), " "), 256).alias("numbers_hash"))


# stores and events


@_query(f"""with fresh as (select document_id from source_files where updated_at > created_at)
select chunk_id, document_id, embedding_state from {Q.CHUNKS} where document_id not in (select document_id from fresh) union all select block_id, document_id, 'pending' from {Q.BLOCKS} where document_id in (select document_id from fresh) and block_type = 'text'""")
def snapshot_replace(spark: SparkSession, d: str) -> DataFrame:
    """Documents that were updated after their first delivery replace their stored rows."""
    stored = _chunks(spark, d).select("chunk_id", "document_id", "embedding_state")
    updated = table(spark, d, "source_files", "document_id", "created_at", "updated_at").where("updated_at > created_at").select("document_id").distinct()
    new = _blocks(spark, d).join(updated, "document_id", "left_semi").where("block_type = 'text'").select(F.col("block_id").alias("chunk_id"), "document_id", F.lit("pending").alias("embedding_state"))
    return stores.replaced(stored, new, keys=updated)


@_query(f"select chunk_id, case when asset_id is not null then 'embedded' else embedding_state end as embedding_state from {Q.CHUNKS}")
def mark_embedded(spark: SparkSession, d: str) -> DataFrame:
    c = _chunks(spark, d)
    return stores.marked_embedded(c, c.where("asset_id is not null")).select("chunk_id", "embedding_state")


@_query("select event_type, count(*) as n, cast(sum(cast(json_extract_string(props, '$.k') as bigint)) as bigint) as total_k, max(ts) as last_ts from events group by event_type")
def event_json(spark: SparkSession, d: str) -> DataFrame:
    e = table(spark, d, "events").withColumn("k", F.get_json_object("props", "$.k").cast("long"))
    return e.groupBy("event_type").agg(F.count("*").alias("n"), F.sum("k").alias("total_k"), F.max("ts").alias("last_ts"))


@_query("select user_id, max_by(event_id, (ts, event_id)) as event_id, max(ts) as ts from events group by user_id")
def latest_event(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "events").groupBy("user_id").agg(F.max_by("event_id", F.struct("ts", "event_id")).alias("event_id"), F.max("ts").alias("ts"))


@_query("select time_bucket(interval '1 hour', ts) as window_start, event_type, count(*) as n, round(sum(value), 4) as total from events group by all")
def event_windows(spark: SparkSession, d: str) -> DataFrame:
    return windowed_events(table(spark, d, "events"))


@_query("select document_id, status, epoch_us(updated_at) as updated_us from source_files qualify row_number() over (partition by document_id order by updated_at desc, status) = 1")
def file_status(spark: SparkSession, d: str) -> DataFrame:
    f = table(spark, d, "source_files", "document_id", "status", "updated_at")
    return f.groupBy("document_id").agg(F.min_by("status", F.struct(-F.unix_micros("updated_at"), "status")).alias("status"), F.unix_micros(F.max("updated_at")).alias("updated_us"))


# SQL that is put together from that of other queries

SQL["structure_summary"] = f"""select b.document_id, count(distinct b.page_no) as n_pages, count(*) filter (s.is_heading) as n_headings, count(c.context_id) as n_table_context, count(k.block_id) as n_carried
from {Q.BLOCKS} b left join ({SQL['section_paths']}) s on s.block_id = b.block_id left join ({SQL['table_context']}) c on c.context_id = b.block_id left join ({SQL['carry_over_dups']}) k on k.block_id = b.block_id group by b.document_id"""
SQL["line_coverage"] = f"""with {_LAYER}, tx as (select document_id, page_no, block_id, position, bbox as box, block_type in ('header', 'footer', 'page_number') as furniture, block_type not in ('image', 'chart', 'header', 'footer', 'page_number') as semantic,
  {Q.normal(Q.flat("coalesce(raw_content, '')"))} as raw, {Q.normal(Q.flat("coalesce(resolved_content, '')"))} as resolved from {Q.BLOCKS} where bbox is not null),
pairs as (select l.document_id, l.page_no, l.line_no, norm, position, block_id, furniture, semantic, raw, resolved from layer l join tx on tx.document_id = l.document_id and tx.page_no = l.page_no where length(norm) >= 4 and {Q.covers('tx.box', 'l.bbox')}),
one as (select document_id, page_no, line_no, bool_or(furniture) as furniture, bool_or(semantic) as covered, bool_or(semantic and {Q.alike('norm', 'raw')}) or coalesce(contains(string_agg(raw, '' order by position, block_id) filter (semantic), any_value(norm)), false) as in_raw,
  bool_or(semantic and {Q.alike('norm', 'resolved')}) or coalesce(contains(string_agg(resolved, '' order by position, block_id) filter (semantic), any_value(norm)), false) as in_resolved from pairs group by all)
select l.document_id, count(*) as n_lines, count(*) filter (coalesce(furniture, false)) as n_furniture, count(*) filter (not coalesce(furniture, false) and coalesce(covered, false)) as n_covered,
count(*) filter (not coalesce(furniture, false) and coalesce(in_raw, false)) as n_raw_matched, count(*) filter (not coalesce(furniture, false) and coalesce(in_resolved, false)) as n_resolved_matched
from layer l left join one using (document_id, page_no, line_no) where length(norm) >= 4 group by l.document_id"""
