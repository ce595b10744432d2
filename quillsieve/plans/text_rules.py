"""Queries of the filters and of the text expressions."""

from __future__ import annotations

from pyspark.sql import functions as F

from quillsieve.functions import text as X
from quillsieve.operators.ranks import scalars
from quillsieve.operators.report import first_reason
from quillsieve.session import table


def _docs(spark, folder, *columns):
    return table(spark, folder, "documents").filter(F.col("text").isNotNull()).select("doc_id", "text", *columns)


def _answers(spark, folder):
    """Answers, each once."""
    rows = table(spark, folder, "chosen_rerun_bad").select("id", "prompt", "domain", "category", "thinking", "chosen", "teacher", "finish_reason", "output_tokens")
    return rows.dropDuplicates(["id"])


ANSWERS = "(SELECT DISTINCT ON (id) id, prompt, domain, category, thinking, chosen, teacher, finish_reason, output_tokens FROM chosen_rerun_bad)"


def stripped(c: str) -> str:
    """SQL for a value without white space at its ends."""
    return rf"regexp_replace({c}, '^[\s\p{{Z}}]+|[\s\p{{Z}}]+$', '', 'g')"


def without_think(c: str) -> str:
    """SQL for a text without reasoning blocks."""
    return stripped(rf"regexp_replace(regexp_replace({c}, '(?s)<think>.*?</think>', '', 'g'), '(?s)<think>.*', '', 'g')")


def _n(c, pattern):
    return f"(length({c}) - length(regexp_replace({c}, '{pattern}', '', 'g')))"


HAN = r"[\x{4e00}-\x{9fff}]"


def noise_filter(spark, folder):
    text = F.col("text")
    noisy = (F.length(X.py_strip(text)) < X.NOISE_SIZE) | text.rlike("(?d)" + X.LAZY) | text.rlike(X.NOISE)
    return _docs(spark, folder).filter(~noisy).select("doc_id")


NOISE_SQL = rf"""SELECT doc_id FROM documents WHERE text IS NOT NULL
AND NOT (length({stripped('text')}) < 80 OR regexp_matches(text, '^(很抱歉|抱歉|很不好意思).{{0,30}}(无法|没有提供|没有提到|不能).{{0,200}}\n?$') OR regexp_matches(text, '汉药|东中业|作为人工智能|我是一个AI|我作为AI'))"""


def len_window(spark, folder):
    size = F.length(X.py_strip(F.col("text")))
    return _docs(spark, folder).filter(size.between(20, 500)).select("doc_id", size.alias("size"))


def len_by_cat(spark, folder):
    """Prompts within the sizes of their category; categories without sizes aren't bounded."""
    rows = table(spark, folder, "seed_prompts").select("id", "prompt", F.lower(F.trim("category")).alias("cat")).dropDuplicates(["id"])
    fits = F.lit(True)
    for name, (least, most) in X.PROMPT_SIZES.items():
        fits = F.when(F.col("cat") == name, F.length("prompt").between(least, most)).otherwise(fits)
    return rows.filter(F.col("prompt").isNotNull() & fits).groupBy("cat").agg(F.count("*").alias("kept"))


LEN_BY_CAT_SQL = """SELECT cat, count(*) AS kept FROM (SELECT DISTINCT ON (id) id, prompt, lower(trim(category)) AS cat FROM seed_prompts) WHERE prompt IS NOT NULL AND CASE cat
WHEN 'mcq_gen' THEN length(prompt) BETWEEN 60 AND 800 WHEN 'acute' THEN length(prompt) BETWEEN 30 AND 260 WHEN 'tcm' THEN length(prompt) BETWEEN 20 AND 240 WHEN 'short' THEN length(prompt) BETWEEN 8 AND 130 ELSE true END GROUP BY cat"""


def role_guard(spark, folder):
    rows = table(spark, folder, "chat_samples").filter(F.get("messages", F.lit(0))["role"] == "user")
    return rows.groupBy("src").agg(F.count_distinct("id").alias("samples"))


def _ratio(name, column):
    def query(spark, folder):
        return _docs(spark, folder).select("doc_id", F.round(column(F.col("text")), 9).alias(name))

    return query


LATIN_SQL = f"SELECT doc_id, round({_n('text', '[A-Za-z]')}::DOUBLE / greatest({_n('text', '[A-Za-z]')} + {_n('text', HAN)}, 1), 9) AS latin_ratio FROM documents WHERE text IS NOT NULL"
ALNUM_SQL = rf"SELECT doc_id, round({_n('text', HAN)}::DOUBLE / greatest({_n('text', '[\\p{L}\\p{N}]')}, 1), 9) AS cjk_ratio FROM documents WHERE text IS NOT NULL".replace("\\\\", "\\")
ALL_SQL = f"SELECT doc_id, round({_n('text', HAN)}::DOUBLE / greatest(length(text), 1), 9) AS cjk_ratio FROM documents WHERE text IS NOT NULL"


def evasive_v4(spark, folder):
    return _answers(spark, folder).filter(X.evades(F.col("chosen"), X.EVASIVE_V4)).select("id")


EVASIVE_V4_SQL = rf"SELECT id FROM {ANSWERS} WHERE regexp_matches(left(chosen, 300), '{X.EVASIVE_V4}')"


def evasive_v6(spark, folder):
    return _answers(spark, folder).filter(X.evades(X.final_part(F.col("chosen")), X.EVASIVE_V6)).select("id")


EVASIVE_V6_SQL = rf"SELECT id FROM {ANSWERS} WHERE regexp_matches(left(CASE WHEN contains(chosen, '</think>') THEN regexp_replace(chosen[instr(chosen, '</think>') + 8:], '^\s*', '') ELSE chosen END, 300), '{X.EVASIVE_V6}')"


def min_len(spark, folder):
    final = X.strip_think(F.col("chosen"))
    return _answers(spark, folder).filter(F.length(final) >= 150).select("id", F.length(final).alias("size"))


def marker_required(spark, folder):
    rows = _answers(spark, folder).filter(F.col("chosen").isNotNull())
    literal, fixed = F.col("chosen").rlike(X.MARKER), F.col("chosen").rlike(X.MARKER_FIXED)
    return rows.select("id", literal.alias("as_written"), fixed.alias("fixed")).filter("as_written or fixed")


def keyword_include(spark, folder):
    return _docs(spark, folder, "source").filter(F.col("text").rlike(X.ACUTE)).groupBy("source").agg(F.count("*").alias("documents"))


def latin_phrase(spark, folder):
    return _docs(spark, folder).select("doc_id", F.size(F.regexp_extract_all("text", F.lit(X.LATIN_PHRASE), 0)).cast("bigint").alias("phrases")).filter("phrases > 0")


def approx_tokens(spark, folder):
    return _docs(spark, folder).select("doc_id", X.approx_tokens(F.col("text")).cast("bigint").alias("tokens"))


def truncation_split(spark, folder):
    rows = _answers(spark, folder)
    has_thinking = rows.agg(F.bool_or(F.col("thinking").isNotNull()).alias("has"))
    cap = rows.groupBy("teacher").agg(F.max("output_tokens").alias("cap"))
    marked = rows.select("*", *scalars(has_thinking)).join(cap, "teacher")
    empty = F.col("has") & (F.coalesce(F.trim("thinking"), F.lit("")) == "") & (F.length("chosen") > 500)
    capped = F.col("output_tokens") >= F.col("cap") - 5
    return marked.select("id", "teacher", F.coalesce(first_reason(("A_empty_think_long", empty), ("tokens_capped", capped)), F.lit("clean")).alias("part"))


TRUNCATION_SQL = f"""WITH a AS (SELECT * FROM {ANSWERS}), c AS (SELECT teacher, max(output_tokens) AS cap FROM a GROUP BY teacher)
SELECT id, a.teacher, CASE WHEN (SELECT bool_or(thinking IS NOT NULL) FROM a) AND coalesce(trim(thinking), '') = '' AND length(chosen) > 500 THEN 'A_empty_think_long'
WHEN output_tokens >= cap - 5 THEN 'tokens_capped' ELSE 'clean' END AS part FROM a JOIN c ON a.teacher = c.teacher"""


def drop_reasons(spark, folder):
    rows = _answers(spark, folder)
    final = X.strip_think(F.col("chosen"))
    reason = first_reason(
        ("no_answer", F.coalesce(final, F.lit("")) == ""),
        ("finish_length", F.col("finish_reason").eqNullSafe("length")),
        ("short", F.length(final) < 150),
        ("low_cjk", X.cjk_ratio_all(final) < 0.45),
    )
    return rows.select(F.coalesce(reason, F.lit("kept")).alias("reason")).groupBy("reason").agg(F.count("*").alias("rows"))


DROP_SQL = f"""SELECT reason, count(*) AS rows FROM (SELECT CASE WHEN coalesce(f, '') = '' THEN 'no_answer' WHEN finish_reason IS NOT DISTINCT FROM 'length' THEN 'finish_length'
WHEN length(f) < 150 THEN 'short' WHEN {_n('f', HAN)}::DOUBLE / greatest(length(f), 1) < 0.45 THEN 'low_cjk' ELSE 'kept' END AS reason
FROM (SELECT *, {without_think('chosen')} AS f FROM {ANSWERS})) GROUP BY reason"""


def mcq_valid(spark, folder):
    rows = table(spark, folder, "eval_v2").filter(F.col("type") == "mcq")
    strict = (F.length("answer") == 1) & F.map_contains_key("options", F.col("answer"))
    literal = F.contains(F.lit("ABCDE"), F.col("answer"))
    return rows.select("id", F.coalesce(strict, F.lit(False)).alias("strict"), literal.alias("as_written"))


def json_error_count(spark, folder):
    rows = table(spark, folder, "events").filter(F.col("props").isNotNull())
    bad = F.try_parse_json("props").isNull()
    return rows.groupBy("event_type").agg(F.count_if(bad).alias("bad"), F.count("*").alias("rows"))


def split_think(spark, folder):
    thinking, answer = X.split_think(F.col("chosen"))
    return _answers(spark, folder).filter(F.col("chosen").isNotNull()).select("id", F.md5(thinking).alias("thinking"), F.md5(answer).alias("answer"))


SPLIT_THINK_SQL = rf"""SELECT id, md5(CASE WHEN p > 0 THEN {stripped("replace(chosen[1:p - 1], '<think>', '')")} ELSE '' END) AS thinking,
md5({stripped('CASE WHEN p > 0 THEN chosen[p + 8:] ELSE chosen END')}) AS answer FROM (SELECT *, instr(chosen, '</think>') AS p FROM {ANSWERS} WHERE chosen IS NOT NULL)"""


def strip_think(spark, folder):
    return _answers(spark, folder).filter(F.col("chosen").isNotNull()).select("id", F.md5(X.strip_think(F.col("chosen"))).alias("answer"))


def wrap_response(spark, folder):
    return _answers(spark, folder).select("id", F.md5(X.wrap_response(F.col("thinking"), F.col("chosen"))).alias("response"))


WRAP_SQL = rf"""SELECT id, md5(CASE WHEN coalesce({stripped('thinking')}, '') <> '' THEN '<think>' || chr(10) || thinking || chr(10) || '</think>' || chr(10) || chr(10) || chosen ELSE chosen END) AS response FROM {ANSWERS}"""


def sentence_split(spark, folder):
    rows = _docs(spark, folder).select("doc_id", F.posexplode(X.sentences(F.col("text"))).alias("at", "sentence"))
    return rows.groupBy("doc_id").agg(F.count("*").alias("sentences"), F.max(F.length("sentence")).cast("bigint").alias("longest"))


SENTENCES_SQL = """SELECT doc_id, count(*) AS sentences, max(length(s)) AS longest FROM
(SELECT doc_id, unnest(string_split(regexp_replace(text, '([。！？；;])', '\\1' || chr(1), 'g'), chr(1))) AS s FROM documents WHERE text IS NOT NULL) WHERE s <> '' GROUP BY doc_id"""


def sentence_dedup(spark, folder):
    own = X.sentences(F.col("text"))
    return _docs(spark, folder).select("doc_id", F.md5(F.array_join(F.array_distinct(own), "")).alias("text"), (F.size(own) - F.size(F.array_distinct(own))).cast("bigint").alias("dropped"))


SENTENCE_DEDUP_SQL = """WITH s AS (SELECT doc_id, list_filter(string_split(regexp_replace(text, '([。！？；;])', '\\1' || chr(1), 'g'), chr(1)), lambda x: x <> '') AS l FROM documents WHERE text IS NOT NULL)
SELECT doc_id, md5(array_to_string(list_filter(l, lambda x, i: list_position(l, x) = i), '')) AS text, len(l) - len(list_distinct(l)) AS dropped FROM s"""


def caution_sentences(spark, folder):
    rows = table(spark, folder, "formula_textbook").select("序号", "用法", "方义", "注意/禁忌").distinct()
    own = X.sentences(F.concat_ws("", "用法", "方义", F.col("`注意/禁忌`")))
    hits = F.array_distinct(F.filter(own, lambda s: s.rlike("忌|慎|不宜|禁")))
    return rows.select(F.col("序号").alias("entry_no"), F.left(F.array_join(hits, ""), F.lit(500)).alias("cautions"))


CAUTION_SQL = """WITH s AS (SELECT 序号 AS entry_no, list_filter(string_split(regexp_replace(concat_ws('', 用法, 方义, "注意/禁忌"), '([。！？；;])', '\\1' || chr(1), 'g'), chr(1)), lambda x: regexp_matches(x, '忌|慎|不宜|禁')) AS l
FROM (SELECT DISTINCT 序号, 用法, 方义, "注意/禁忌" FROM formula_textbook))
SELECT entry_no, left(array_to_string(list_filter(l, lambda x, i: list_position(l, x) = i), ''), 500) AS cautions FROM s"""


def between_tags(spark, folder):
    body = X.between_tags(F.col("text"), "【", ["】"])
    return _docs(spark, folder).select("doc_id", body.alias("tag")).filter(F.col("tag").isNotNull())


def clean_field(spark, folder):
    rows = table(spark, folder, "formula_textbook").select("序号", "主治").distinct()
    return rows.select(F.col("序号").alias("entry_no"), X.clean_field(F.col("主治")).alias("indication"))


CLEAN_SQL = rf"""SELECT 序号 AS entry_no, regexp_replace(regexp_replace(replace({stripped("regexp_replace(replace(主治, '　', ' '), '[ \t\r\f\v]+', ' ', 'g')")}, chr(10), ''), '[\s\p{{Z}}]+', ' ', 'g'), '^[ ：:；;，,]+|[ ：:；;，,]+$', '', 'g') AS indication
FROM (SELECT DISTINCT 序号, 主治 FROM formula_textbook)"""


def name_extract(spark, folder):
    name = F.regexp_extract("text", X.FORMULA_NAME, 0)
    return _docs(spark, folder).select(name.alias("name")).filter("name <> ''").groupBy("name").agg(F.count("*").alias("documents"))


def has_section(spark, folder):
    return _docs(spark, folder, "source").groupBy("source").agg(F.count_if(F.contains("text", F.lit("【"))).alias("with_section"), F.count("*").alias("documents"))


def name_stem(spark, folder):
    rows = table(spark, folder, "western_meds").select("序号", "药品通用名").distinct()
    bare = F.regexp_replace("药品通用名", r"[（(][^（）()]*[)）]|[\s\p{Z}ⅠⅡⅢⅣ]", "")
    chain = F.when(bare.endswith("胶囊"), F.left(bare, F.length(bare) - 2))
    for suffix in ("颗粒", "注射液", "缓释片", "片"):
        chain = chain.when(bare.endswith(suffix), F.left(bare, F.length(bare) - len(suffix)))
    return rows.select(F.col("序号").alias("entry_no"), chain.otherwise(bare).alias("stem"))


NAME_STEM_SQL = r"""SELECT 序号 AS entry_no, CASE WHEN b LIKE '%胶囊' THEN left(b, length(b) - 2) WHEN b LIKE '%颗粒' THEN left(b, length(b) - 2) WHEN b LIKE '%注射液' THEN left(b, length(b) - 3)
WHEN b LIKE '%缓释片' THEN left(b, length(b) - 3) WHEN b LIKE '%片' THEN left(b, length(b) - 1) ELSE b END AS stem
FROM (SELECT 序号, regexp_replace(药品通用名, '[（(][^（）()]*[)）]|[\s\p{Z}ⅠⅡⅢⅣ]', '', 'g') AS b FROM (SELECT DISTINCT 序号, 药品通用名 FROM western_meds))"""


def mcq_extract(spark, folder):
    rows = _answers(spark, folder).filter(F.col("chosen").isNotNull())
    return rows.select("id", X.choice_of(F.col("chosen"))[0].alias("choice")).filter(F.col("choice").isNotNull())


def keypoint_hit(spark, folder):
    """Share of an item's key points of which the reference answer holds an alias; brackets split a point into aliases."""
    rows = table(spark, folder, "eval_v2").filter((F.col("type") == "open") & (F.size("key_points") > 0))
    aliases = lambda p: F.filter(F.split(p, "[（）()]"), lambda a: F.trim(a) != "")
    hits = F.filter("key_points", lambda p: F.exists(aliases(p), lambda a: F.contains(F.col("reference_answer"), F.trim(a))))
    return rows.select("id", F.round(F.size(hits) / F.size("key_points"), 6).alias("hit_rate"))


KEYPOINT_SQL = """SELECT id, round(len(list_filter(key_points, lambda p: len(list_filter(string_split_regex(p, '[（）()]'), lambda a: trim(a) <> '' AND contains(reference_answer, trim(a)))) > 0))::DOUBLE / len(key_points), 6) AS hit_rate
FROM eval_v2 WHERE type = 'open' AND len(key_points) > 0"""

D = "documents WHERE text IS NOT NULL"
QUERIES = {
    "noise_filter": (noise_filter, NOISE_SQL),
    "len_window": (len_window, f"SELECT doc_id, length(b) AS size FROM (SELECT doc_id, {stripped('text')} AS b FROM {D}) WHERE length(b) BETWEEN 20 AND 500"),
    "len_by_cat": (len_by_cat, LEN_BY_CAT_SQL),
    "role_guard": (role_guard, "SELECT src, count(DISTINCT id) AS samples FROM chat_samples WHERE messages[1].role = 'user' GROUP BY src"),
    "latin_ratio": (_ratio("latin_ratio", X.latin_ratio), LATIN_SQL),
    "script_ratio_alnum": (_ratio("cjk_ratio", X.cjk_ratio_alnum), ALNUM_SQL),
    "script_ratio_all": (_ratio("cjk_ratio", X.cjk_ratio_all), ALL_SQL),
    "evasive_v4": (evasive_v4, EVASIVE_V4_SQL),
    "evasive_v6": (evasive_v6, EVASIVE_V6_SQL),
    "min_len": (min_len, f"SELECT id, length(f) AS size FROM (SELECT id, {without_think('chosen')} AS f FROM {ANSWERS}) WHERE length(f) >= 150"),
    "marker_required": (marker_required, f"SELECT * FROM (SELECT id, regexp_matches(chosen, '答案[::是为]|Answer[:：]') AS as_written, regexp_matches(chosen, '答案[:：是为]|Answer[:：]') AS fixed FROM {ANSWERS} WHERE chosen IS NOT NULL) WHERE as_written OR fixed"),
    "keyword_include": (keyword_include, f"SELECT source, count(*) AS documents FROM {D} AND regexp_matches(text, '{X.ACUTE}') GROUP BY source"),
    "latin_phrase": (latin_phrase, f"SELECT * FROM (SELECT doc_id, len(regexp_extract_all(text, '{X.LATIN_PHRASE}')) AS phrases FROM {D}) WHERE phrases > 0"),
    "approx_tokens": (approx_tokens, f"SELECT doc_id, trunc({_n('text', HAN)} * 1.5::DOUBLE + (length(text) - {_n('text', HAN)}) * 0.3::DOUBLE)::BIGINT AS tokens FROM {D}"),
    "truncation_split": (truncation_split, TRUNCATION_SQL),
    "drop_reasons": (drop_reasons, DROP_SQL),
    "mcq_valid": (mcq_valid, "SELECT id, coalesce(length(answer) = 1 AND options[answer] IS NOT NULL, false) AS strict, contains('ABCDE', answer) AS as_written FROM eval_v2 WHERE type = 'mcq'"),
    "json_error_count": (json_error_count, "SELECT event_type, count(*) FILTER (NOT json_valid(props)) AS bad, count(*) AS rows FROM events WHERE props IS NOT NULL GROUP BY event_type"),
    "split_think": (split_think, SPLIT_THINK_SQL),
    "strip_think": (strip_think, f"SELECT id, md5({without_think('chosen')}) AS answer FROM {ANSWERS} WHERE chosen IS NOT NULL"),
    "wrap_response": (wrap_response, WRAP_SQL),
    "sentence_split": (sentence_split, SENTENCES_SQL),
    "sentence_dedup": (sentence_dedup, SENTENCE_DEDUP_SQL),
    "caution_sentences": (caution_sentences, CAUTION_SQL),
    "between_tags": (between_tags, f"SELECT doc_id, {stripped('regexp_extract(text, $$(?s)【(.*?)(?:】|$)$$, 1)')} AS tag FROM {D} AND contains(text, '【')"),
    "clean_field": (clean_field, CLEAN_SQL),
    "name_extract": (name_extract, rf"SELECT name, count(*) AS documents FROM (SELECT regexp_extract(text, '[\x{{4e00}}-\x{{9fff}}]{{2,8}}(?:汤|散|丸|饮|膏|丹|片|煎|方)') AS name FROM {D}) WHERE name <> '' GROUP BY name"),
    "has_section": (has_section, f"SELECT source, count(*) FILTER (contains(text, '【')) AS with_section, count(*) AS documents FROM {D} GROUP BY source"),
    "name_stem": (name_stem, NAME_STEM_SQL),
    "mcq_extract": (mcq_extract, rf"SELECT * FROM (SELECT id, upper(coalesce(regexp_extract_all(chosen, '{X.CHOICE}', 1)[-1], regexp_extract_all(right(chosen, 120), '[A-Da-d]')[-1])) AS choice FROM {ANSWERS} WHERE chosen IS NOT NULL) WHERE choice IS NOT NULL"),
    "keypoint_hit": (keypoint_hit, KEYPOINT_SQL),
}
