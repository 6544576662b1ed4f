"""Problem 10: template residue, filler text, error pages and script notices in a corpus.

Every text is cut into messages (lines and sentences); in every message addresses, dates and numbers become '#'. The masked messages
are grouped by their hash over all texts and sources: how many texts hold each, of how many sources, and in how many of them it
stands at the end. What recurs widely and nearly always ends its text is classified by phrase rules; a recurring heading or sentence
of prose never ends its texts that regularly, whatever words it uses. Placeholders and filler are known by their syntax, wherever they
stand and how often; so are notices in a strict wording, at the end of a text, that are too rare to recur.

All of it is column expressions: the rules are regular expressions that Java and RE2 read alike (no look-around), so that the same
rules make the SQL.

Null and empty texts have no residue. Texts repeated under several ids are each reported; a text counts a message once, and a null
source counts as one source. A doc_id delivered twice counts twice, and is reported once.
"""

from __future__ import annotations

import functools

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from foliant.session import cut_lineage

MIN_DOCS, MIN_SOURCES = 3, 2
FINAL_CHARS, SHORT_CHARS = 160, 300  # a message is final where it ends within the last FINAL_CHARS, or the whole text has no more than SHORT_CHARS
FINAL_SHARE = 0.9

#: Unfilled placeholders by their syntax, each with a string that every match holds; each is residue wherever it stands. Masked messages have '#' for digits.
PLACEHOLDERS = (
    ("{{", r"\{\{[^{}|\n]{1,60}\}\}"), ("{%", r"\{%[^%{}\n]{1,60}%\}"), ("${", r"\$\{[^{}\n]{1,60}\}"), ("<%", r"<%[^%<>\n]{1,80}%>"), ("<<", r"<<[^<>\n]{1,40}>>"), ("@@", r"@@[A-Za-z0-9#_ 一-鿿]{2,60}@@"),
    ("%", r"%[A-Z][A-Z0-9#]*(?:_[A-Z0-9#]+)*%"), ("%", r"%[一-鿿]{2,12}%"), ("__", r"__[A-Z][A-Z0-9#]*(?:_[A-Z0-9#]+)*__"),
    ("[", r"\[(?:INSERT|DATE|NAME|AMOUNT|YOUR|FIGURE|CLIENT|COMPANY|TITLE|TBD)(?:[ _-][A-Z _-]{0,40})?\]"), ("[", r"\[[A-Z]{2,}(?:[ _][A-Z]{2,})+\]"), ("[insert", r"\[insert [^\]\n]{1,60}\]"),
    ("【", r"【[^】\n]{0,12}(?:填写|插入|输入|待补|待定|待填|占位)[^】\n]{0,20}】"), ("待", r"[（(【\[] ?(?:待补充?|待定|待填)[^）)】\]\n]{0,40}[）)】\]]"), ("_____", r"(?:^|[^0-9A-Za-z_#])_{5,}(?:[^0-9A-Za-z_#]|$)"),
    ("年", r"[X×x]{2,4}年[X×x]{1,2}月"), ("XXXX", r"(?:^|[^A-Za-z])XXXX+(?:[^A-Za-z]|$)"), ("XX.X", r"XX\.X"), ("XX/XX/", r"(?:^|[^A-Za-z])XX/XX/"),
    ("TBD", r"(?:^|[^A-Za-z])TBD ?[:：]"), ("TODO", r"(?:^|[^A-Za-z])TODO ?[:：]"), ("FIXME", r"(?:^|[^A-Za-z])FIXME ?[:：]"),
)
#: Filler text; prose doesn't say it.
FILLER = r"(?i)text goes here|your text here|replace this (?:paragraph|text|sentence)|dummy text|lorem ipsum|此处为示例文[字本]|请替换为正式内容|此处(?:填写|输入)(?:内容|文字)|占位(?:文[字本]|符)"
#: Notices by how a message begins, strict enough to count at the end of a text without recurrence.
STRICT = "(?i)^(?:" + "|".join(
    (
        r"(?:# ?)?(?:error ?#? ?[:-]? ?)?(?:page|file|filing|document|report) not found", r"(?:http ?)?# (?:not found|forbidden|unauthorized|bad gateway|service unavailable|gateway time-?out|internal server error)",
        r"access denied ?(?:[.!:]|$)", r"you (?:do not|don't) have permission", r"session expired", r"your session has (?:expired|timed out)", r"internal (?:server )?error", r"error while (?:loading|opening|rendering|reading)",
        r"service (?:temporarily )?unavailable", r"the [a-z]+ viewer is down", r"(?:an?|the) (?:unexpected )?error (?:has )?occurred", r"something went wrong", r"(?:failed|unable) to load", r"could not load",
        r"please (?:turn on|enable|allow) (?:javascript|scripts|cookies)", r"(?:you must|if nothing happens,) (?:allow|enable) (?:javascript|scripts|cookies)", r"enable javascript", r"your browser does not (?:run|support)",
        r"javascript (?:is|must be) (?:disabled|required|enabled)", r"this (?:viewer|page|site|report) (?:needs|requires) (?:scripts|javascript|cookies)", r"loading ?(?:\.\.+|…)", r"please wait while", r"request # was blocked",
        r"traceback \(most recent call", r"(?:[a-z_]+\.)*[a-z]*(?:error|exception): ", r'file "[^"]+", line #', r"the (?:filing|page|file|document|report) you (?:asked|were looking|requested)",
        r"#? ?(?:页面|网页|文件|报告|该页|该文件)(?:不存在|未找到|已失效|已被移除|无法访问)", r"(?:# ?)?禁止访问", r"(?:抱歉，?|对不起，?)? ?未找到", r"(?:抱歉|对不起)，?(?:您|你)?.{0,12}(?:不存在|未找到|无权|无法)", r"您?无权访问", r"(?:您)?没有权限",
        r"登录已过期", r"访问被拒绝", r"系统繁忙", r"(?:系统|服务器?)(?:内部)?(?:错误|异常|出错)", r"服务暂不可用", r"(?:请|需要?|您需|必须)(?:先)?(?:启用|开启|打开|允许).{0,8}(?:javascript|脚本|cookie)", r"(?:请)?在浏览器中允许脚本",
        r"您?的浏览器(?:不支持|未启用|已禁用)", r"(?:正在)?加载(?:中|失败)? ?(?:…|\.\.)", r"正在加载", r"加载失败", r"请稍[候等]", r"您访问的",
    )
) + ")"
#: Words of notices; prose uses them too, so that they count only for messages that recur and end their texts.
PHRASES = "(?i)" + "|".join(
    (
        r"error|denied|forbidden|unauthori[sz]ed|not found|permission|session|(?:sign|log) ?in\b|javascript|scripts?\b|cookies?\b|browser|loading|reload|refresh|please wait|timed? ?out|time-out|unavailable|maintenance|blocked",
        r"try again|moved or|withdrawn|server|traceback|exception|reference #|request #|captcha|viewer|redirect|go back|cannot be displayed|did not (?:answer|respond)|(?:has|have|been) moved|being updated|coming soon|under construction",
        r"错误|异常|出错|失败|拒绝|禁止|权限|无权|登录|会话|脚本|浏览器|加载|刷新|稍[后候等]|等待|超时|不可用|维护|未找到|不存在|已被移除|已失效|返回列表|请求编号|参考号|重试|敬请期待|建设中|无法访问|无法显示",
    )
)
#: What the dump of an empty record leaves on a line.
EMPTY_VALUE = r"(?:null|undefined|NaN|N/A|None|nil|#REF!|#N/A|#VALUE!|#DIV/0!|#NAME\?|\(null\)|—|空|无数据)"
_DASHES = r"-{1,3}"
#: A text that is, or ends as, two lines or more of empty values; or one after at most one line.
EMPTY_DUMP = rf"(?i)(?:^|\n)[ \t]*(?:{EMPTY_VALUE}|{_DASHES})[ \t]*\n\s*(?:{EMPTY_VALUE}|{_DASHES})\s*$|^\s*(?:[^\n]*\n)?[ \t]*{EMPTY_VALUE}\s*$"

#: What masking replaces by '#': addresses (the part before '@' has at most 64 characters), then dates, numbers and long identifiers. None of these holds the end of a message.
ADDRESSES = (("://", r"https?://[!-~]*[A-Za-z0-9/]"), ("@", r"[A-Za-z0-9_.+-]{1,64}@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+"))
NUMBERS = r"[0-9a-f]{12,}|\d(?:[\d,.:/年月-]*\d)?日?"
MESSAGE_END = r"([。！？])|([.!?])\s+"  # a line feed is put behind the sign
SPACES = r"[ \t\r\f]{2,}|[\t\r\f]"
BETWEEN = r" ?\n[ \n]*"


def lined(text: Column) -> Column:
    """A text with spaces collapsed and a line feed after each message."""
    return F.trim(F.regexp_replace(F.regexp_replace(text, MESSAGE_END, "$1$2\n"), SPACES, " "))


def masked(text: Column) -> Column:
    """A text with addresses, dates and numbers masked."""
    for held, rule in ADDRESSES:
        text = F.when(text.contains(held), F.regexp_replace(text, rule, "#")).otherwise(text)
    return F.regexp_replace(text, NUMBERS, "#")


def _folded(text: Column) -> Column:
    """The two letters that folding of ASCII doesn't take for i and s."""
    return F.when(text.contains("İ") | text.contains("ſ"), F.translate(text, "İſ", "is")).otherwise(text)


def syntax_kind(text: Column) -> Column:
    """placeholder or filler, by what a text or a masked message holds; else null. Each placeholder rule stands behind a search for its string: far cheaper than one large alternation."""
    placeholder = functools.reduce(Column.__or__, [text.contains(held) & text.rlike(rule) for held, rule in PLACEHOLDERS])
    return F.when(placeholder, F.lit("placeholder")).when(_folded(text).rlike(FILLER), F.lit("filler"))


def notice_kind(message: Column) -> Column:
    """notice (a strict wording) or phrase (counts only where the message recurs); else null."""
    return F.when(_folded(message).rlike(STRICT), F.lit("notice")).when(_folded(message).rlike(PHRASES), F.lit("phrase"))


def _cut(documents: DataFrame, *names: str) -> DataFrame:
    """The named columns, lines (see lined) and n_last: how many messages end the text."""
    texts = documents.where("text is not null and text <> ''").select(*names, lined(F.col("text")).alias("lines"))
    return texts.select(*names, "lines", F.when(F.length("lines") <= SHORT_CHARS, SHORT_CHARS).otherwise(F.size(F.split(F.right("lines", F.lit(FINAL_CHARS)), BETWEEN, -1))).alias("n_last"))


def _last(parts: str) -> Column:
    return F.slice(parts, F.greatest(F.size(parts) - F.col("n_last"), F.lit(0)) + 1, F.col("n_last"))


def messages(documents: DataFrame) -> DataFrame:
    """doc_id, source, message (masked), final (it ends its text) of every different message of every text."""
    texts = _cut(documents, "doc_id", "source").select("doc_id", "source", "n_last", F.split(masked(F.col("lines")), BETWEEN, -1).alias("parts"))
    texts = texts.select("doc_id", "source", _last("parts").alias("last"), F.explode(F.array_distinct("parts")).alias("message")).where("message <> ''")
    return texts.select("doc_id", "source", "message", F.array_contains("last", F.col("message")).alias("final"))


def final_messages(documents: DataFrame) -> DataFrame:
    """doc_id, message, kind of the messages that end their text and may be notices; nothing else is masked here."""
    ends = _cut(documents, "doc_id").select("doc_id", "n_last", F.split("lines", BETWEEN, -1).alias("parts")).select("doc_id", _last("parts").alias("last"))
    ends = ends.select("doc_id", F.explode(F.array_distinct(F.transform("last", masked))).alias("message"))
    return ends.select("doc_id", "message", notice_kind(F.col("message")).alias("kind")).where("kind is not null")


def _recurring(rows: DataFrame, min_docs: int, min_sources: int) -> DataFrame:
    """message_hash, n_docs, n_sources, n_final of the messages that recur. Counts are combined before each shuffle, which carries hashes only."""
    by = rows.groupBy(F.xxhash64("message").alias("message_hash"), "source").agg(F.count("*").alias("n"), F.count_if("final").alias("f"))
    counted = by.groupBy("message_hash").agg(F.sum("n").alias("n_docs"), F.count("*").alias("n_sources"), F.sum("f").alias("n_final"))
    return counted.where((F.col("n_docs") >= min_docs) & (F.col("n_sources") >= min_sources))


def _ends_texts() -> Column:
    return F.col("n_final") >= FINAL_SHARE * F.col("n_docs")


def message_groups(documents: DataFrame, min_docs: int = MIN_DOCS, min_sources: int = MIN_SOURCES) -> DataFrame:
    """message, kind, n_docs, n_sources, n_final, residue of every message that recurs over sources; kind is null where no rule classifies it, residue tells whether it is residue."""
    rows = messages(documents)
    wide = cut_lineage(_recurring(rows, min_docs, min_sources))  # few, against all messages
    texts = rows.select(F.xxhash64("message").alias("message_hash"), "message").join(wide.select("message_hash"), "message_hash", "left_semi").groupBy("message_hash").agg(F.min("message").alias("message"))
    out = wide.join(texts, "message_hash").withColumn("kind", F.coalesce(syntax_kind(F.col("message")), notice_kind(F.col("message"))))
    residue = F.coalesce(F.col("kind").isin("placeholder", "filler") | (F.col("kind").isin("notice", "phrase") & _ends_texts()), F.lit(False))
    return out.select("message", "kind", "n_docs", "n_sources", "n_final", residue.alias("residue"))


def notices(documents: DataFrame, min_docs: int = MIN_DOCS, min_sources: int = MIN_SOURCES) -> DataFrame:
    """doc_id, message, kind, recurring of the notices that end their texts: messages that recur over sources, which are counted over all messages, and strict wordings."""
    wide = _recurring(messages(documents), min_docs, min_sources).where(_ends_texts()).select("message_hash", F.lit(True).alias("recurring"))
    known = final_messages(documents).withColumn("message_hash", F.xxhash64("message")).join(wide, "message_hash", "left").fillna(False, ["recurring"])
    return known.where("recurring or kind = 'notice'").select("doc_id", "message", "kind", "recurring")


def syntax_residue(documents: DataFrame) -> DataFrame:
    """doc_id, kind of the texts with unfilled placeholders, filler text, or a dump of empty values."""
    texts = documents.where("text is not null and text <> ''")
    kind = F.coalesce(syntax_kind(F.col("text")), F.when(F.col("text").rlike(EMPTY_DUMP), F.lit("empty values")))
    return texts.select("doc_id", kind.alias("kind")).where("kind is not null")


def residue_documents(documents: DataFrame, min_docs: int = MIN_DOCS, min_sources: int = MIN_SOURCES) -> DataFrame:
    """Distinct doc_id of the texts that are, hold or end as residue."""
    return notices(documents, min_docs, min_sources).select("doc_id").unionByName(syntax_residue(documents).select("doc_id")).distinct()


def clean_corpus(documents: DataFrame) -> DataFrame:
    """The documents without those of residue_documents."""
    return documents.join(residue_documents(documents), "doc_id", "left_anti")


def _sql_text(rule: str) -> str:
    return "'" + rule.replace("'", "''") + "'"


def _sql_rules(column: str) -> str:
    return f"when {' or '.join(f'regexp_matches({column}, {_sql_text(rule)})' for _, rule in PLACEHOLDERS)} then 'placeholder' when regexp_matches({column}, {_sql_text(FILLER)}) then 'filler'"


def _sql_messages() -> str:
    """messages and wide for DuckDB, as the beginning of a statement."""
    lines = f"trim(regexp_replace(regexp_replace(text, {_sql_text(MESSAGE_END)}, '\\1\\2' || chr(10), 'g'), {_sql_text(SPACES)}, ' ', 'g'), ' ')"
    plain = "lines"
    for rule in [rule for _, rule in ADDRESSES] + [NUMBERS]:
        plain = f"regexp_replace({plain}, {_sql_text(rule)}, '#', 'g')"
    kind = f"{_sql_rules('message')} " + " ".join(f"when regexp_matches(message, {_sql_text(rule)}) then '{name}'" for name, rule in (("notice", STRICT), ("phrase", PHRASES)))
    return f"""with whole as (select doc_id, source, {lines} as lines from documents where text <> ''),
cut as (select doc_id, source, case when length(lines) <= {SHORT_CHARS} then {SHORT_CHARS} else len(string_split_regex(right(lines, {FINAL_CHARS}), '{BETWEEN}')) end as n_last, string_split_regex({plain}, '{BETWEEN}') as parts from whole),
each as (select doc_id, source, parts[greatest(len(parts) - n_last, 0) + 1:] as ends, unnest(list_distinct(parts)) as message from cut),
messages as (select doc_id, source, message, list_contains(ends, message) as final, case {kind} end as kind from each where message <> ''),
wide as (select message, count(*) as n_docs, count(distinct coalesce(source, chr(0))) as n_sources, count_if(final) as n_final from messages group by message having count(*) >= {MIN_DOCS} and count(distinct coalesce(source, chr(0))) >= {MIN_SOURCES})"""


def sql_message_groups() -> str:
    return f"""{_sql_messages()} select distinct w.message, m.kind, cast(n_docs as bigint) as n_docs, cast(n_sources as bigint) as n_sources, cast(n_final as bigint) as n_final,
coalesce(m.kind in ('placeholder', 'filler') or (m.kind in ('notice', 'phrase') and n_final >= {FINAL_SHARE} * n_docs), false) as residue from wide w join messages m using (message)"""


def sql_residue_documents() -> str:
    return f"""{_sql_messages()} select distinct doc_id from messages left join wide using (message) where (final and kind = 'notice') or (final and kind = 'phrase' and n_final >= {FINAL_SHARE} * n_docs)
union select doc_id from documents where text <> '' and (case {_sql_rules('text')} end is not null or regexp_matches(text, {_sql_text(EMPTY_DUMP)}))"""
