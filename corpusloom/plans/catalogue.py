"""Queries of the core operators over the driver's tables, with their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusloom.functions import text as T
from corpusloom.operators import assets, dialogue, privacy, providers, quality, records
from corpusloom.operators.clean import ANSWER_BOOK, ANSWER_SHEETS, CleanOptions, clean, drop_answer_sheets, keep_long
from corpusloom.plans import sql as S
from corpusloom.runtime import read_table, scratch_path
from corpusloom.sources import writers
from corpusloom.streaming import clean as streaming

Query = Callable[[SparkSession, str], DataFrame]
_queries: dict[str, Query] = {}
_sql: dict[str, str] = {}


def query(sql: str | None = None) -> Callable[[Query], Query]:
    def add(f: Query) -> Query:
        _queries[f.__name__] = f
        if sql:
            _sql[f.__name__] = sql
        return f

    return add


def _md(spark: SparkSession, d: str) -> DataFrame:
    return read_table(spark, d, "md_info")


# --- cleaners: md_info.text carries links, images, mail addresses, web links, circled numbers and tags of its own

_IPV6 = " node 2001:db8:0:0:0:0:2:1f up, ::1 and 2001:db8:85a3::8a2e:370:7334 ."


def _cleaner(name: str, spark_column: Callable[[Column], Column], sql_text: Callable[[str], str], source: Callable[[], Column] | None = None, sql_source: str = "text") -> None:
    """A query ``clean_<name>`` over every record: id, delivery and the cleaned text."""

    def run(spark: SparkSession, d: str) -> DataFrame:
        text = source() if source else F.col("text")
        return _md(spark, d).select("id", "ingested_at", text.alias("raw")).select("id", "ingested_at", spark_column(F.col("raw")).alias("text"))

    _queries[name] = run
    _sql[name] = f"SELECT id, ingested_at, {sql_text('raw')} AS text FROM (SELECT id, ingested_at, {sql_source} AS raw FROM md_info)"


_cleaner("clean_markdown", T.clean_markdown, S.clean_markdown)
_cleaner("clean_email", T.clean_email, S.clean_email)
_cleaner("clean_links", T.clean_links, S.clean_links)
_cleaner("clean_ipv4", T.clean_ipv4, S.clean_ipv4, lambda: F.concat(F.coalesce("text", F.lit("")), F.lit(" 192.168.0.1; 999.1.1.1 8.8.8.8 end")), "concat(coalesce(text, ''), ' 192.168.0.1; 999.1.1.1 8.8.8.8 end')")
_cleaner("clean_control_chars", T.clean_control, S.clean_control, lambda: F.concat(F.lit("x\0\t\r\x7f"), F.coalesce("text", F.lit("")), F.lit("\x85y")), "concat('x', chr(0), chr(9), chr(13), chr(127), coalesce(text, ''), chr(133), 'y')")
_cleaner("clean_repeat_spaces", T.clean_spaces, S.clean_spaces)
_cleaner("clip_to_punctuation", T.clip_to_end_mark, S.clip_to_end_mark)
_cleaner("clean_circled", T.clean_circled, S.clean_circled)
_cleaner("clean_filenames", T.clean_file_names, S.clean_file_names, lambda: F.concat(F.coalesce("text", F.lit("")), F.lit(" see report.pdf) and a.docx audio.wav b..wav x.tar.gz")), "concat(coalesce(text, ''), ' see report.pdf) and a.docx audio.wav b..wav x.tar.gz')")
_cleaner("clean_symbol_runs", T.clean_symbol_runs, S.clean_symbol_runs, lambda: F.concat(F.substring(F.coalesce("text", F.lit("")), 1, 400), F.lit(" wow!!!!!!!!!! yes ======== a********(b !!!!!!!c")), "concat(substring(coalesce(text, ''), 1, 400), ' wow!!!!!!!!!! yes ======== a********(b !!!!!!!c')")
# the SQL above looks at the first 400 characters; this one is over the whole texts
_cleaner("clean_symbol_runs_whole", T.clean_symbol_runs, S.clean_symbol_runs, lambda: F.concat(F.coalesce("text", F.lit("")), F.lit(" wow!!!!!!!!!! yes ======== a********(b !!!!!!!c")), "concat(coalesce(text, ''), ' wow!!!!!!!!!! yes ======== a********(b !!!!!!!c')")
_cleaner("clean_html_tags", T.clean_html, S.clean_html, lambda: F.concat(F.coalesce("text", F.lit("")), F.when(F.substring("id", 1, 1) == "0", "<<p>div>").otherwise(""), F.lit("</ p ><B>")), "concat(coalesce(text, ''), CASE substring(id, 1, 1) WHEN '0' THEN '<<p>div>' ELSE '' END, '</ p ><B>')")


@query()
def clean_ipv6(spark: SparkSession, d: str) -> DataFrame:
    """Word boundaries around the nine forms have no counterpart in RE2; tested on literal cases."""
    return _md(spark, d).select("id", "ingested_at", T.clean_ips(F.concat(F.coalesce("text", F.lit("")), F.lit(_IPV6))).alias("text"))


def _prune_sql() -> str:
    steps = [S.clean_markdown, S.clean_email, S.clean_links, lambda x: S.strip(S.clean_ipv4(x)), S.clean_control, S.clean_spaces, S.clip_to_end_mark, S.clean_circled, S.clean_file_names, S.clean_symbol_runs, S.clean_html]
    source = f"SELECT doc_id, text AS t0 FROM documents WHERE {S.letter_count('text')} >= 100"
    for k, step in enumerate(steps):
        # materialised, so that no step is inlined twice
        source = f"SELECT doc_id, {step(f't{k}')} AS t{k + 1} FROM ({source})"
    return f"SELECT doc_id, t{len(steps)} AS text FROM ({source})"


@query(_prune_sql())
def prune_all(spark: SparkSession, d: str) -> DataFrame:
    """All cleaners in order over the documents that are long enough."""
    return clean(read_table(spark, d, "documents").select("doc_id", "text"), CleanOptions.everything())


@query(f"SELECT id, ingested_at, {S.letter_count('text')} AS letters FROM md_info WHERE {S.letter_count('text')} >= 100")
def filter_short(spark: SparkSession, d: str) -> DataFrame:
    return keep_long(_md(spark, d)).select("id", "ingested_at", T.letter_count(F.col("text")).alias("letters"))


@query(f"SELECT id, ingested_at, {S.letter_count('text')} AS letters FROM md_info UNION ALL SELECT id, ingested_at, {S.letter_count('text')} FROM all_transcripts")
def letter_count(spark: SparkSession, d: str) -> DataFrame:
    parts = [read_table(spark, d, t).select("id", "ingested_at", T.letter_count(F.col("text")).alias("letters")) for t in ("md_info", "all_transcripts")]
    return parts[0].unionByName(parts[1])


_SHEET_PATH = "CASE length(coalesce(text, '')) % 5 WHEN 0 THEN 'd/答题卡.pdf' WHEN 1 THEN 'd/解答卷.pdf' WHEN 2 THEN '答卷/x.pdf' WHEN 3 THEN path ELSE NULL END"
_SHEETS = " OR ".join(f"contains({S.base_name('p')}, {S.lit(w)})" for w in ANSWER_SHEETS)


@query(f"SELECT id, ingested_at, p AS path FROM (SELECT id, ingested_at, {_SHEET_PATH} AS p FROM md_info) WHERE p IS NULL OR contains({S.base_name('p')}, {S.lit(ANSWER_BOOK)}) OR NOT ({_SHEETS})")
def filter_answer_sheet(spark: SparkSession, d: str) -> DataFrame:
    return drop_answer_sheets(_md(spark, d).select("id", "ingested_at", F.expr(_SHEET_PATH).alias("path")))


# --- record queries

_CONDITIONS = [{"field": "lang", "value": "zh"}, {"field": "source", "value": "exam_bank"}, {"field": "unknown", "value": ""}]


@query("SELECT count(*) AS matches FROM documents WHERE coalesce(lang, '') = 'zh' AND coalesce(source, '') = 'exam_bank'")
def count_by_conditions(spark: SparkSession, d: str) -> DataFrame:
    return records.count_by_conditions(read_table(spark, d, "documents"), _CONDITIONS)


@query("SELECT CAST(doc_id AS VARCHAR) AS id FROM documents WHERE coalesce(discipline, '') = ''")
def extract_ids(spark: SparkSession, d: str) -> DataFrame:
    return records.extract_ids(read_table(spark, d, "documents"), "discipline", "", "doc_id")


@query("SELECT id, md_path, ingested_at FROM md_info WHERE id IN (SELECT id FROM labelled WHERE label = 1)")
def semi_join_by_id(spark: SparkSession, d: str) -> DataFrame:
    ids = read_table(spark, d, "labelled").where("label = 1").select("id")
    return records.semi_join_by_id(_md(spark, d).select("id", "md_path", "ingested_at"), ids)


@query("SELECT id, md_path, ingested_at FROM md_info WHERE coalesce(id, '') <> '' AND id NOT IN (SELECT id FROM classified WHERE id IS NOT NULL)")
def resume_anti_join(spark: SparkSession, d: str) -> DataFrame:
    return records.resume(_md(spark, d).select("id", "md_path", "ingested_at"), read_table(spark, d, "classified").select("id"))


@query("SELECT id, md_path, min(ingested_at) AS ingested_at FROM md_info WHERE coalesce(id, '') <> '' GROUP BY id, md_path")
def checkpoint_dedup(spark: SparkSession, d: str) -> DataFrame:
    return records.append_once(_md(spark, d).select("id", "md_path", "ingested_at"), order_by="ingested_at")


@query(f"SELECT id, classified_at, CASE WHEN grade IN {S.in_list(providers.GRADES)} THEN grade ELSE '无' END AS grade, CASE WHEN discipline IN {S.in_list(providers.DISCIPLINES)} THEN discipline ELSE '其他' END AS discipline FROM classified")
def vocab_validate(spark: SparkSession, d: str) -> DataFrame:
    df = read_table(spark, d, "classified").select("id", "classified_at", "grade", "discipline")
    return records.validate_vocabulary(records.validate_vocabulary(df, "grade", providers.GRADES, "无"), "discipline", providers.DISCIPLINES, "其他")


# --- files

_TARGETS = {k: f"/out/{k}" for k in assets.FILE_CLASSES}
_NAME = "concat('/in/', substring(id, 1, 8), CASE length(md_path) % 6 WHEN 0 THEN '.MP4' WHEN 1 THEN '/a.flac' WHEN 2 THEN '.png' WHEN 3 THEN '.pdf' WHEN 4 THEN '/.docx' ELSE '.DOCX' END)"
_CLASS = "CASE " + " ".join(f"WHEN {S.extension('src')} IN {S.in_list(v)} THEN '{k}'" for k, v in assets.FILE_CLASSES.items()) + " END"


@query(f"SELECT DISTINCT src, concat('/out/', file_class, '/', substring(src, 5)) AS dst, file_class FROM (SELECT src, {_CLASS} AS file_class FROM (SELECT {_NAME} AS src FROM md_info)) WHERE file_class IS NOT NULL")
def route_by_extension(spark: SparkSession, d: str) -> DataFrame:
    paths = _md(spark, d).select(F.expr(_NAME).alias("p"))
    return assets.route(paths, "p", _TARGETS, "/in").select("src", "dst", "file_class").distinct()


_DIR, _STEM = "regexp_extract({p}, '^(.*)/[^/]*$', 1)", "regexp_replace(regexp_extract({p}, '([^/]*)$', 1), '\\.[^.]+$', '')"


@query(
    f"WITH o AS (SELECT {_DIR.format(p='path')} AS odir, {_STEM.format(p='path')} AS ostem, min(path) AS path, min(size_bytes) AS size_bytes FROM md_info WHERE path IS NOT NULL GROUP BY 1, 2), "
    f"r AS (SELECT DISTINCT id, {_DIR.format(p='path')} AS dir, {_STEM.format(p='path')} AS stem FROM md_info) "
    "SELECT r.id, r.dir, r.stem, o.path AS original FROM r LEFT JOIN o ON r.dir = o.odir AND r.stem = o.ostem"
)
def asset_left_join(spark: SparkSession, d: str) -> DataFrame:
    md = _md(spark, d)
    originals = md.where("path IS NOT NULL").select(T.parent(F.col("path")).alias("odir"), T.stem(F.col("path")).alias("ostem"), F.col("path").alias("original"))
    recs = md.select("id", T.parent(F.col("path")).alias("dir"), T.stem(F.col("path")).alias("stem")).distinct()
    return assets.match_originals(recs, originals, "dir", "stem", "odir", "ostem", "original")


@query(
    "WITH s AS (SELECT audio_id AS stem, max(audio_path) AS p FROM all_transcripts GROUP BY 1), r AS (SELECT DISTINCT id, audio_id AS stem FROM all_transcripts) "
    "SELECT r.id, r.stem, regexp_extract(s.p, '^(.*)/[^/]*$', 1) AS target_dir FROM r JOIN s ON r.stem = s.stem"
)
def rehome_by_stem(spark: SparkSession, d: str) -> DataFrame:
    audio = read_table(spark, d, "all_transcripts")
    sources = audio.select(F.col("audio_id").alias("source_stem"), T.parent(F.col("audio_path")).alias("dir"), "audio_path")
    recs = audio.select("id", F.col("audio_id").alias("stem")).distinct()
    return assets.rehome_by_stem(recs, sources, "stem", "source_stem", "dir", "audio_path")[0]


@query("SELECT md_path, sha256(md_path) AS path_id, sha256(md_path) = id AS same FROM md_info")
def path_id_sha256(spark: SparkSession, d: str) -> DataFrame:
    return _md(spark, d).select("md_path", T.path_id(F.col("md_path")).alias("path_id"), (T.path_id(F.col("md_path")) == F.col("id")).alias("same"))


@query(f"SELECT id, ingested_at, {S.human_size('size_bytes')} AS shown, {S.human_size('(size_bytes * size_bytes)')} AS shown_square FROM md_info")
def human_size(spark: SparkSession, d: str) -> DataFrame:
    return _md(spark, d).select("id", "ingested_at", T.human_size(F.col("size_bytes")).alias("shown"), T.human_size(F.col("size_bytes") * F.col("size_bytes")).alias("shown_square"))


@query(f"SELECT path, {S.base_name('path')} AS base_name, {S.extension('path')} AS extension, {_DIR.format(p='path')} AS dir FROM md_info WHERE path IS NOT NULL")
def path_parts(spark: SparkSession, d: str) -> DataFrame:
    p = F.col("path")
    return _md(spark, d).where("path IS NOT NULL").select("path", T.base_name(p).alias("base_name"), T.extension(p).alias("extension"), T.parent(p).alias("dir"))


@query("WITH t AS (SELECT substring(md_path, 1, 0) || regexp_extract(md_path, '([^/]*)$', 1) AS name, max(md_path) AS src FROM md_info GROUP BY 1) SELECT src, '/out/' || name AS dst FROM t")
def copy_plan(spark: SparkSession, d: str) -> DataFrame:
    return assets.flat_copy_plan(_md(spark, d), "md_path", "/out")


@query("SELECT coalesce(archive_name LIKE '%zip' OR archive_name LIKE '%rar' OR archive_name LIKE '%7z', false) AS is_archive, count(*) AS n FROM source_archives GROUP BY 1")
def archive_names(spark: SparkSession, d: str) -> DataFrame:
    return read_table(spark, d, "source_archives").select(F.coalesce(assets.is_archive_name(F.col("archive_name")), F.lit(False)).alias("is_archive")).groupBy("is_archive").agg(F.count(F.lit(1)).alias("n"))


# --- text pieces

@query("SELECT id, ingested_at, i AS chunk_no, substring(text, CAST(i * 400 + 1 AS BIGINT), 400) AS chunk FROM (SELECT id, ingested_at, text, unnest(range(0, CAST(ceil(length(text) / 400.0) AS BIGINT))) AS i FROM md_info WHERE length(text) > 0)")
def chunk_text(spark: SparkSession, d: str) -> DataFrame:
    return _md(spark, d).select("id", "ingested_at", F.posexplode(T.chunks(F.col("text"), 400)).alias("chunk_no", "chunk")).withColumn("chunk_no", F.col("chunk_no").cast("bigint"))


@query("SELECT doc_id, substring(text, 1, 300) AS head FROM documents")
def truncate_text(spark: SparkSession, d: str) -> DataFrame:
    return read_table(spark, d, "documents").select("doc_id", T.truncate(F.col("text"), 300).alias("head"))


_REPLY = "concat('<think>{', coalesce(text, ''), '}</think> ok {\"reason\": \"r\", \"label\": ', doc_id % 2, '} tail')"


@query(f"SELECT doc_id, CAST(json_extract_string(regexp_extract(regexp_replace({_REPLY}, '(?s)<think>.*?</think>', '', 'g'), '(?s)(\\{{.*\\}})', 1), '$.label') AS VARCHAR) AS label FROM documents")
def strip_reasoning_json(spark: SparkSession, d: str) -> DataFrame:
    return read_table(spark, d, "documents").select("doc_id", providers.parse_label(F.expr(_REPLY)).alias("label"))


_LABELLED = "concat('学科：', coalesce(discipline, ''), chr(10), '文件类型：教案', chr(10), '学科：', coalesce(discipline, 'x'))"


@query(f"SELECT id, classified_at, CASE WHEN trim(coalesce(discipline, 'x'), ' ' || chr(9) || chr(12288)) IN {S.in_list(providers.DISCIPLINES)} THEN trim(coalesce(discipline, 'x'), ' ' || chr(9) || chr(12288)) ELSE '其他' END AS discipline, '教案' AS file_type, '其他' AS subcategories FROM classified")
def parse_labelled_lines(spark: SparkSession, d: str) -> DataFrame:
    parsed = providers.parse_classification(F.expr(_LABELLED))
    return read_table(spark, d, "classified").select("id", "classified_at", *(c.alias(k) for k, c in parsed.items()))


@query(
    f"SELECT id, classified_at, CASE WHEN {S.strip('knowledge_point')} = '无' THEN '无' ELSE array_to_string(list_filter(list_transform(string_split(knowledge_point, ';'), lambda x: {S.strip('x')}), lambda x: x <> ''), '; ') END AS knowledge_point FROM classified"
)
def normalise_keywords(spark: SparkSession, d: str) -> DataFrame:
    return read_table(spark, d, "classified").select("id", "classified_at", T.normalise_keywords(F.col("knowledge_point")).alias("knowledge_point"))


_ANSWER = "concat('{\"q\":\"Q', doc_id, '\",\"a\":\"A', doc_id, '\"}', chr(10), chr(10), 'oops', chr(10), '{\"q\":\"\",\"a\":\"x\"}', chr(10), '{\"q\":\" k \",\"a\":\"不合理\"}')"


@query(
    "SELECT doc_id, 0::BIGINT AS pos, 'user' AS role, concat('Q', doc_id) AS content FROM documents UNION ALL SELECT doc_id, 1, 'assistant', concat('A', doc_id) FROM documents "
    "UNION ALL SELECT doc_id, 2, 'user', 'k' FROM documents UNION ALL SELECT doc_id, 3, 'assistant', '不合理' FROM documents"
)
def parse_qa_jsonlines(spark: SparkSession, d: str) -> DataFrame:
    turns = T.parse_qa_lines(F.expr(_ANSWER))
    return read_table(spark, d, "documents").select("doc_id", F.posexplode(turns).alias("pos", "turn")).select("doc_id", F.col("pos").cast("bigint").alias("pos"), "turn.role", "turn.content")


@query("SELECT qa_id, arrived_at, contains(c, '合理') AND NOT contains(c, '不合理') AS approved FROM (SELECT qa_id, arrived_at, coalesce(qa_pairs[2].content, '') || CASE qa_id % 3 WHEN 0 THEN '合理' WHEN 1 THEN '不合理' ELSE '' END AS c FROM qa_pairs)")
def approve_replies(spark: SparkSession, d: str) -> DataFrame:
    reply = F.concat(F.coalesce(F.get("qa_pairs", 1)["content"], F.lit("")), F.when(F.col("qa_id") % 3 == 0, "合理").when(F.col("qa_id") % 3 == 1, "不合理").otherwise(""))
    return read_table(spark, d, "qa_pairs").select("qa_id", "arrived_at", T.approved(reply).alias("approved"))


@query("SELECT doc_id, concat('问：', coalesce(title, ''), chr(10), '答：', coalesce(lang, '')) AS prompt FROM documents")
def fill_prompts(spark: SparkSession, d: str) -> DataFrame:
    return read_table(spark, d, "documents").select("doc_id", T.fill_prompt("问：{question}\n答：{answer}", question=F.col("title"), answer=F.col("lang")).alias("prompt"))


def _first_term(x: str, words: list[str], default: str) -> str:
    return "CASE " + " ".join(f"WHEN contains({x}, {S.lit(w)}) THEN {S.lit(w)}" for w in words) + f" ELSE {S.lit(default)} END"


_YEAR_PATH = "concat(coalesce(path, ''), '/高一/2023-2024学年/语文')"
_SEEN = f"concat({_YEAR_PATH}, chr(10), substring(coalesce(text, ''), 1, 3000))"


@query(
    f"SELECT id, ingested_at, {_first_term(_YEAR_PATH, providers.GRADES, '无')} AS grade, '2023-2024学年' AS school_year, CASE WHEN coalesce(text, '') = '' THEN '无' ELSE {_first_term(_SEEN, [w for w in providers.DISCIPLINES if w != '其他'], '其他')} END AS discipline, "
    f"CASE WHEN coalesce(text, '') = '' THEN '无' ELSE {_first_term(_SEEN, [w for w in providers.FILE_TYPES if w != '其他'], '其他')} END AS file_type FROM md_info"
)
def classify_path_rules(spark: SparkSession, d: str) -> DataFrame:
    path = F.expr(_YEAR_PATH)
    return _md(spark, d).select("id", "ingested_at", providers.grade_from_path(path).alias("grade"), providers.school_year_from_path(path).alias("school_year"), *(c.alias(k) for k, c in providers.classify_document(path, F.col("text")).items()))


# --- dialogues

_PAIRS = (
    "SELECT qa_id, arrived_at, i // 2 AS pair_pos, qa_pairs[i + 1].content AS question, qa_pairs[i + 2].content AS answer FROM (SELECT qa_id, arrived_at, qa_pairs, unnest(range(0, len(qa_pairs), 2)) AS i FROM qa_pairs WHERE len(qa_pairs) > 0) "
    "WHERE i + 2 <= len(qa_pairs) AND qa_pairs[i + 1].role = 'user' AND qa_pairs[i + 2].role = 'assistant'"
)


def _flat(spark: SparkSession, d: str) -> DataFrame:
    return dialogue.flatten_pairs(read_table(spark, d, "qa_pairs"), ["qa_id", "arrived_at"])


@query(_PAIRS)
def qa_flatten(spark: SparkSession, d: str) -> DataFrame:
    pair = _flat(spark, d)
    return pair.select("qa_id", "arrived_at", F.col("pair_pos").cast("bigint").alias("pair_pos"), F.get("qa_pair", 0)["content"].alias("question"), F.get("qa_pair", 1)["content"].alias("answer"))


@query(f"SELECT qa_id, arrived_at, pair_pos, (row_number() OVER (ORDER BY qa_id, arrived_at, pair_pos) - 1) // 500 AS shard FROM ({_PAIRS})")
def qa_shard(spark: SparkSession, d: str) -> DataFrame:
    return dialogue.shard(_flat(spark, d).select("qa_id", "arrived_at", F.col("pair_pos").cast("bigint").alias("pair_pos")), ["qa_id", "arrived_at", "pair_pos"], 500).drop("row_no")


@query("SELECT qa_id, pair_no, 'Question: ' || coalesce(qa_pair[1].content, '') || chr(10) || 'Answer: ' || coalesce(qa_pair[2].content, '') AS line FROM labelled WHERE len(qa_pair) >= 2")
def qa_line(spark: SparkSession, d: str) -> DataFrame:
    return dialogue.model_lines(read_table(spark, d, "labelled")).select("qa_id", "pair_no", "line")


# --- privacy



def _entities(spark: SparkSession, d: str) -> DataFrame:
    found = F.regexp_extract_all(F.col("text"), F.lit(r"在([一-鿿]{2}(?:镇|县|村|乡))"), F.lit(1))
    return privacy.distinct_entities(read_table(spark, d, "documents"), found)


def _mapping(spark: SparkSession, d: str) -> DataFrame:
    return privacy.build_mapping(_entities(spark, d), privacy.fake_person_names(spark, 2200), privacy.longer_person_names)


_PLACES = "SELECT DISTINCT unnest(regexp_extract_all(text, '在([一-鿿]{2}(?:镇|县|村|乡))', 1)) AS real FROM documents"
_POOL_SQL = f"SELECT s || g AS fake, row_number() OVER (ORDER BY k, i, j, l) - 1 AS rn FROM (SELECT s, i, j, 0 AS l, 0 AS k, g FROM (SELECT unnest({privacy.SURNAMES}) AS s, generate_subscripts({privacy.SURNAMES}, 1) AS i), (SELECT unnest({privacy.GIVEN}) AS g, generate_subscripts({privacy.GIVEN}, 1) AS j) UNION ALL SELECT s, i, j, l, 1, a || b FROM (SELECT unnest({privacy.SURNAMES}) AS s, generate_subscripts({privacy.SURNAMES}, 1) AS i), (SELECT unnest({privacy.GIVEN}) AS a, generate_subscripts({privacy.GIVEN}, 1) AS j), (SELECT unnest({privacy.GIVEN}) AS b, generate_subscripts({privacy.GIVEN}, 1) AS l))"


@query(_PLACES)
def entity_distinct(spark: SparkSession, d: str) -> DataFrame:
    return _entities(spark, d)


@query(f"WITH e AS ({_PLACES}), r AS (SELECT real, row_number() OVER (ORDER BY -length(real), real) - 1 AS rn FROM e), p AS ({_POOL_SQL}) SELECT r.real, p.fake, r.rn FROM r JOIN p ON r.rn = p.rn")
def pseudonym_mapping(spark: SparkSession, d: str) -> DataFrame:
    return _mapping(spark, d).select("real", "fake", "rn")


@query(
    f"WITH RECURSIVE e AS ({_PLACES}), m AS (SELECT real, row_number() OVER (ORDER BY -length(real), real) - 1 AS rn FROM e), p AS ({_POOL_SQL}), k AS (SELECT m.real, p.fake, m.rn FROM m JOIN p ON m.rn = p.rn), n AS (SELECT max(rn) AS top FROM k), "
    "s AS (SELECT doc_id, text, 0::BIGINT AS step FROM documents UNION ALL SELECT s.doc_id, replace(s.text, k.real, k.fake), s.step + 1 FROM s JOIN k ON k.rn = s.step) SELECT doc_id, text FROM s, n WHERE s.step = n.top + 1"
)
def pseudonymise(spark: SparkSession, d: str) -> DataFrame:
    return privacy.pseudonymise(read_table(spark, d, "documents").select("doc_id", "text"), _mapping(spark, d))


@query(f"SELECT fake, rn FROM ({_POOL_SQL}) WHERE rn < 500")
def fake_name_pool(spark: SparkSession, d: str) -> DataFrame:
    return privacy.fake_person_names(spark, 500)


@query(
    f"SELECT r || t AS fake, row_number() OVER (ORDER BY i, j) - 1 AS rn FROM (SELECT unnest({privacy.REGIONS}) AS r, generate_subscripts({privacy.REGIONS}, 1) AS i), (SELECT unnest({privacy.SCHOOL_TYPES}) AS t, generate_subscripts({privacy.SCHOOL_TYPES}, 1) AS j)"
)
def fake_school_pool(spark: SparkSession, d: str) -> DataFrame:
    return privacy.fake_school_names(spark, 80)


# --- quality

@query("SELECT doc_id, lang FROM documents ORDER BY sha256(concat_ws('-', CAST(doc_id AS VARCHAR), '42')), doc_id LIMIT 400")
def sample_k(spark: SparkSession, d: str) -> DataFrame:
    return quality.sample_k(read_table(spark, d, "documents"), 400, "doc_id").select("doc_id", "lang")


_RANK = "(row_number() OVER (ORDER BY sha256(concat_ws('-', CAST(doc_id AS VARCHAR), '42')), doc_id)) / CAST(count(*) OVER () AS DOUBLE)"


@query(f"SELECT doc_id, CASE WHEN r <= 0.7 THEN 'train' WHEN r <= 0.85 THEN 'validation' ELSE 'test' END AS part FROM (SELECT doc_id, {_RANK} AS r FROM documents)")
def split_70_15_15(spark: SparkSession, d: str) -> DataFrame:
    return quality.split_sets(read_table(spark, d, "documents").select("doc_id"), "doc_id")


_PRED = "SELECT label, CASE WHEN length(coalesce(qa_pair[2].content, '')) >= 40 THEN 1 ELSE 0 END AS prediction FROM labelled WHERE label IN (0, 1)"


def _predicted(spark: SparkSession, d: str) -> DataFrame:
    answer = F.coalesce(F.get("qa_pair", 1)["content"], F.lit(""))
    return read_table(spark, d, "labelled").where("label IN (0, 1)").select("label", (F.length(answer) >= 40).cast("int").alias("prediction"))


@query(f"SELECT label, prediction, count(*) AS n FROM ({_PRED}) GROUP BY 1, 2")
def confusion_matrix(spark: SparkSession, d: str) -> DataFrame:
    return quality.confusion_matrix(_predicted(spark, d), "label", "prediction")


@query(
    f"WITH p AS ({_PRED}), l AS (SELECT label, count(*) AS support, count(*) FILTER (label = prediction) AS hits FROM p GROUP BY 1), q AS (SELECT prediction AS label, count(*) AS predicted FROM p GROUP BY 1), "
    "m AS (SELECT support, hits, coalesce(hits / nullif(predicted, 0)::DOUBLE, 0.0) AS pr, hits / support::DOUBLE AS re FROM l LEFT JOIN q ON l.label = q.label), f AS (SELECT *, CASE WHEN pr + re > 0 THEN 2 * pr * re / (pr + re) ELSE 0.0 END AS f1 FROM m) "
    "SELECT round(sum(hits) / sum(support)::DOUBLE, 9) AS accuracy, round(sum(support * pr) / sum(support), 9) AS weighted_precision, round(sum(support * re) / sum(support), 9) AS weighted_recall, round(sum(support * f1) / sum(support), 9) AS weighted_f1 FROM f"
)
def weighted_metrics(spark: SparkSession, d: str) -> DataFrame:
    out = quality.weighted_metrics(_predicted(spark, d), "label", "prediction")
    return out.select(*(F.round(c, 9).alias(c) for c in out.columns))


@query("SELECT count(*) AS total, count(*) FILTER (label = 1) AS retained, round(count(*) FILTER (label = 1) * 100.0 / count(*), 9) AS retained_pct FROM labelled")
def retention_rate(spark: SparkSession, d: str) -> DataFrame:
    out = quality.retention(read_table(spark, d, "labelled"), F.coalesce(F.col("label") == 1, F.lit(False)))
    return out.withColumn("retained_pct", F.round("retained_pct", 9))


@query()
def quality_filter_ml(spark: SparkSession, d: str) -> DataFrame:
    """Learned filter over all pairs: trained on the labelled ones, positives kept."""
    model = quality.train_filter(dialogue.model_lines(read_table(spark, d, "labelled")))
    return quality.apply_filter(model, dialogue.model_lines(_flat(spark, d))).select("qa_id", "pair_pos", F.round("score", 6).alias("score"))


@query("SELECT source, count(*) AS documents, sum(n_chars) AS chars, count(DISTINCT lang) AS languages FROM documents GROUP BY source")
def group_by_source_file(spark: SparkSession, d: str) -> DataFrame:
    return read_table(spark, d, "documents").groupBy("source").agg(F.count(F.lit(1)).alias("documents"), F.sum("n_chars").alias("chars"), F.countDistinct("lang").alias("languages"))


@query("SELECT coalesce(kind, 'none') AS status, count(*) AS n FROM source_archives GROUP BY 1")
def archive_status_counts(spark: SparkSession, d: str) -> DataFrame:
    return assets.status_counts(read_table(spark, d, "source_archives").withColumn("status", F.coalesce("kind", F.lit("none"))))


# --- sources, sinks and streams: written to the shared folder and read again


@query(f"SELECT DISTINCT id, {S.clean_email('text')} AS text FROM md_info WHERE {S.letter_count('text')} >= 100")
def stream_clean(spark: SparkSession, d: str) -> DataFrame:
    """The cleaning chain over a stream of files, each id once."""
    out = scratch_path(spark, "stream")
    # as a pattern the table may be one file or a folder of files
    stream = spark.readStream.schema(_md(spark, d).schema).parquet(f"{d}/md_info.parque[t]").select("id", "text")
    streaming.start(streaming.clean_stream(stream, CleanOptions(email=True)), f"{out}/rows", f"{out}/log", once=True).awaitTermination()
    return spark.read.schema("id string, text string").parquet(f"{out}/rows")


@query("SELECT DISTINCT id, audio_id, text, error, archive_name AS src_file FROM all_transcripts")
def jsonl_round_trip(spark: SparkSession, d: str) -> DataFrame:
    """Records written as JSON lines by source file and read again."""
    out = scratch_path(spark, "jsonl")
    df = read_table(spark, d, "all_transcripts").select("id", "audio_id", "text", "error", F.col("archive_name").alias("src_file")).distinct()
    writers.write_by_source(df, out)
    return spark.read.schema("id string, audio_id string, text string, error string, src_file string").json(out)


@query("SELECT DISTINCT doc_id, source FROM documents")
def append_once(spark: SparkSession, d: str) -> DataFrame:
    """The same records appended twice to one output: each id is there once."""
    out = scratch_path(spark, "append")
    df = read_table(spark, d, "documents").select("doc_id", "source")
    for _ in range(2):
        writers.append_new(df, out, "doc_id")
    return spark.read.parquet(out)


def queries() -> dict[str, Query]:
    return dict(_queries)


def oracle_sql() -> dict[str, str]:
    return dict(_sql)
