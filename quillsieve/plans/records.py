"""Queries of normalization, generators, evaluation and streams."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from quillsieve.functions import text as X
from quillsieve.operators import order as O
from quillsieve.operators.normalize import normalize_records, strict_schema
from quillsieve.session import shared_folder, table
from quillsieve.sources.records import read_csv_strings, read_lenient_json, write_json_lines
from quillsieve.streaming.staging import stage

D = "documents WHERE text IS NOT NULL"
SEEDS = "(SELECT DISTINCT ON (id) * FROM seed_prompts)"
ANSWERS = "(SELECT DISTINCT ON (id) * FROM chosen_rerun_bad)"
CHATS = "(SELECT DISTINCT ON (id) * FROM chat_samples)"


def _seeds(spark, folder):
    return table(spark, folder, "seed_prompts").dropDuplicates(["id"])


def _chats(spark, folder):
    return table(spark, folder, "chat_samples").dropDuplicates(["id"])


def _answers(spark, folder):
    return table(spark, folder, "chosen_rerun_bad").dropDuplicates(["id"])


def pick_alias(spark, folder):
    best = X.first_value(F.col("gt_answer"), F.col("category"), F.col("source"))
    return _seeds(spark, folder).select("id", best.alias("value"))


def _sql_strip(c):
    return rf"nullif(regexp_replace({c}, '^[\s\p{{Z}}]+|[\s\p{{Z}}]+$', '', 'g'), '')"


def norm_pair(spark, folder):
    """Instruction and input joined where both are filled and differ, else the one there is; dropped without an answer."""
    a, b = X.first_value(F.col("category")), X.first_value(F.col("prompt"))
    both = a.isNotNull() & b.isNotNull() & (F.lower(a) != F.lower(b))
    user = F.when(both, F.concat(a, F.lit("\n"), b)).otherwise(F.coalesce(a, b))
    rows = _seeds(spark, folder).select("id", F.md5(user).alias("user"), X.first_value(F.col("gt_answer")).alias("answer"))
    return rows.filter(F.col("user").isNotNull() & F.col("answer").isNotNull())


NORM_SQL = f"""SELECT id, md5(CASE WHEN a IS NOT NULL AND b IS NOT NULL AND lower(a) <> lower(b) THEN a || chr(10) || b ELSE coalesce(a, b) END) AS user, g AS answer
FROM (SELECT id, {_sql_strip('category')} AS a, {_sql_strip('prompt')} AS b, {_sql_strip('gt_answer')} AS g FROM {SEEDS}) WHERE coalesce(a, b) IS NOT NULL AND g IS NOT NULL"""


def norm_records(spark, folder):
    """Answers written in three shapes, one for each teacher, and normalized again: pairs, instruction and input, upper case."""
    rows = _answers(spark, folder).filter(F.col("prompt").isNotNull() & F.col("chosen").isNotNull())
    labelled = F.array(F.concat(F.lit("问："), "prompt"), F.concat(F.lit("答: "), "chosen"))
    shape = F.when(F.col("teacher") == "m2_large", F.to_json(F.struct(labelled.alias("data"))))
    asked = F.struct(F.col("prompt").alias("instruction"), F.col("category").alias("input"), F.col("chosen").alias("output"))
    shape = shape.when(F.col("id") % 2 == 0, F.to_json(asked))
    upper = F.struct(F.col("prompt").alias("Question"), F.col("chosen").alias("Answer"), F.col("domain").alias("System"))
    records = rows.select("id", F.try_parse_json(shape.otherwise(F.to_json(upper))).alias("record"))
    done = normalize_records(records, "record", F.lit("default"))
    return done.select("id", "system", F.md5(F.col("messages")[0]["content"]).alias("user"), F.md5(F.col("messages")[1]["content"]).alias("assistant"))


NORM_RECORDS_SQL = f"""SELECT id, CASE WHEN teacher IS DISTINCT FROM 'm2_large' AND id % 2 <> 0 THEN coalesce({_sql_strip('domain')}, 'default') ELSE 'default' END AS system,
md5(CASE WHEN teacher IS DISTINCT FROM 'm2_large' AND id % 2 = 0 AND c IS NOT NULL AND lower(c) <> lower(p) THEN p || chr(10) || c ELSE p END) AS user, md5(a) AS assistant
FROM (SELECT *, {_sql_strip('prompt')} AS p, {_sql_strip('category')} AS c, {_sql_strip('chosen')} AS a FROM {ANSWERS}) WHERE p IS NOT NULL AND a IS NOT NULL"""


def strict_records(spark, folder):
    """Items without ids and prompts with ids in the three fields of the training schema, the first of equal prompts kept."""
    empty = F.lit("").alias("system")
    turn = lambda c: F.array(F.struct(F.lit("user").alias("role"), F.col(c).alias("content"))).alias("messages")
    items = table(spark, folder, "eval_v2").select(F.lit(None).cast("string").alias("id"), empty, turn("question"), F.lit("C").alias("label"), F.col("id").alias("place"))
    seeds = _seeds(spark, folder).filter(F.col("prompt").isNotNull()).select("id", empty, turn("prompt"), F.lit("D").alias("label"), F.col("id").alias("place"))
    once = O.first_wins(items.unionByName(seeds), [F.sha1(F.col("messages")[0]["content"])], ["label", "place"])
    return strict_schema(once, "label", "place").select("id", "system", F.md5(F.col("messages")[0]["content"]).alias("user"))


STRICT_SQL = f"""WITH a AS (SELECT NULL::VARCHAR AS id, question AS q, 'C' AS label, id AS place FROM eval_v2 UNION ALL SELECT id, prompt, 'D', id FROM {SEEDS} WHERE prompt IS NOT NULL),
k AS (SELECT * FROM a WHERE q IS NOT NULL QUALIFY row_number() OVER (PARTITION BY q ORDER BY label, place) = 1)
SELECT coalesce(id, label || '_' || (row_number() OVER (PARTITION BY label ORDER BY place) - 1)) AS id, '' AS system, md5(q) AS user FROM k"""


def norm_multi(spark, folder):
    one = _seeds(spark, folder).select("source", F.lit("seed").alias("track"))
    two = table(spark, folder, "eval_v2").select("source", F.lit("eval").alias("track"))
    three = _answers(spark, folder).select(F.col("teacher").alias("source"), F.lit("answers").alias("track"))
    rows = one.unionByName(two).unionByName(three)
    return rows.groupBy("track", "source").agg(F.count("*").alias("rows"))


def norm_qa_prefix(spark, folder):
    """Texts of messages without a leading question or answer mark, however it is written."""
    rows = _chats(spark, folder).select("id", F.posexplode("messages"))
    bare = F.regexp_replace("col.content", r"^\s*(?:问|答|Q|A)\s*[:：]\s*", "")
    return rows.select("id", F.col("pos").cast("bigint").alias("turn"), F.length(bare).alias("size")).filter(F.col("size").isNotNull())


def label_lines(spark, folder):
    rows = table(spark, folder, "western_meds").select("序号", "适应症", "规格", "用法", "禁忌").distinct()
    line = lambda c: F.when(~F.coalesce(F.trim(c), F.lit("")).isin("", "-", "无", "未列", "未定位"), F.concat(F.lit(f"【{c}】"), F.trim(c)))
    return rows.select(F.col("序号").alias("entry_no"), F.md5(F.concat_ws("\n", *[line(c) for c in ("适应症", "规格", "用法", "禁忌")])).alias("answer"))


LABEL_SQL = "SELECT 序号 AS entry_no, md5(concat_ws(chr(10), " + ", ".join(
    f"CASE WHEN coalesce(trim({c}, ' '), '') NOT IN ('', '-', '无', '未列', '未定位') THEN '【{c}】' || trim({c}, ' ') END" for c in ("适应症", "规格", "用法", "禁忌")
) + ")) AS answer FROM (SELECT DISTINCT 序号, 适应症, 规格, 用法, 禁忌 FROM western_meds)"


def section_answer(spark, folder):
    rows = table(spark, folder, "formula_textbook").select("序号", "功用", "主治").distinct().filter((F.col("功用") != "") | (F.col("主治") != ""))
    return rows.select(F.col("序号").alias("entry_no"), F.md5(F.concat_ws("\n", F.nullif(F.col("功用"), F.lit("")), F.nullif(F.col("主治"), F.lit("")))).alias("answer"))


def mcq_prompt(spark, folder):
    lines = F.transform(F.array_sort(F.map_entries("options")), lambda e: F.concat(e["key"], F.lit(". "), e["value"]))
    rows = table(spark, folder, "eval_v2").filter("type = 'mcq'")
    return rows.select("id", F.md5(F.concat(F.lit("请回答下面的选择题。\n"), F.col("question"), F.lit("\n"), F.array_join(lines, "\n"))).alias("prompt"))


MCQ_SQL = """SELECT id, md5('请回答下面的选择题。' || chr(10) || question || chr(10) || array_to_string(list_transform(list_sort(map_keys(options)), lambda k: k || '. ' || options[k]), chr(10))) AS prompt FROM eval_v2 WHERE type = 'mcq'"""


def mcq_options(spark, folder):
    filled = F.filter(F.array_sort(F.map_entries("options")), lambda e: F.trim(e["value"]) != "")
    rows = table(spark, folder, "eval_v2").filter("type = 'mcq'")
    return rows.select("id", F.size(filled).cast("bigint").alias("options"), F.array_join(F.transform(filled, lambda e: e["key"]), "").alias("letters"))


def gold_letter(spark, folder):
    letter = F.upper(F.left(F.trim("answer"), F.lit(1)))
    rows = table(spark, folder, "eval_v2").select("id", letter.alias("letter"))
    return rows.filter(F.col("letter").isin("A", "B", "C", "D", "E"))


def split_think_tail(spark, folder):
    at = F.instr("chosen", "</think>")
    rest = F.substring(F.col("chosen"), at + 8, F.length("chosen"))
    tail = F.regexp_replace(rest, r"^\s+", "")
    head = F.length("chosen") - F.length(tail)
    rows = _answers(spark, folder).filter(at > 0)
    return rows.select("id", head.alias("head_size"), F.length(tail).alias("tail_size"))


TAIL_SQL = rf"""SELECT id, length(chosen) - length(t) AS head_size, length(t) AS tail_size FROM (SELECT id, chosen, regexp_replace(chosen[instr(chosen, '</think>') + 8:], '^\s+', '') AS t FROM {ANSWERS} WHERE instr(chosen, '</think>') > 0)"""


def map_category(spark, folder):
    names = F.create_map(*[F.lit(x) for x in ("tcm", "TCM", "mcq", "Exam", "mcq_gen", "Exam", "short", "General")])
    key = F.lower(F.trim("category"))
    rows = _seeds(spark, folder).select(F.coalesce(F.try_element_at(names, key), key).alias("domain"))
    return rows.groupBy("domain").agg(F.count("*").alias("rows"))


def classify_first(spark, folder):
    kind = F.when(F.col("prompt").rlike("汤|散|丸|饮|膏|丹|煎"), "formula").when(F.col("prompt").rlike("mg|剂量|漏服"), "drug").when(F.col("prompt").rlike("舌苔|脉"), "pattern")
    return _seeds(spark, folder).filter(F.col("prompt").isNotNull()).groupBy(kind.otherwise("other").alias("kind")).agg(F.count("*").alias("prompts"))


def source_type(spark, folder):
    kind = F.when(F.col("src").startswith("hf_"), "pulled").when(F.col("src").startswith("opus_"), "generated").when(F.col("src").startswith("d1_"), "textbook")
    return _chats(spark, folder).groupBy(kind.otherwise("older").alias("kind")).agg(F.count("*").alias("samples"))


def last_message(spark, folder):
    last = F.element_at("messages", -1)
    return _chats(spark, folder).select("id", last["role"].alias("role"), F.length(last["content"]).alias("size"))


def role_pick(spark, folder):
    said = F.get(F.filter("messages", lambda m: m["role"] == "assistant"), F.lit(0))["content"]
    return _chats(spark, folder).select("id", F.md5(said).alias("answer"))


def route_prompt(spark, folder):
    system = F.when(F.col("track") == "TCM", "中医").when(F.col("track") == "EBM", "循证").otherwise("通用")
    return _chats(spark, folder).groupBy(system.alias("system")).agg(F.count("*").alias("samples"))


def overlay_fix(spark, folder):
    rows = table(spark, folder, "western_meds").select("序号", "QA状态", "QA问题").distinct()
    fixed = F.when(F.col("QA问题") != "", F.concat_ws("；", "QA问题", F.lit("已人工复核"))).otherwise(F.col("QA问题"))
    return rows.select(F.col("序号").alias("entry_no"), F.md5(F.coalesce(fixed, F.lit(""))).alias("issues"))


def blank_bad(spark, folder):
    rows = table(spark, folder, "western_meds").select("序号", "规格", "QA状态").distinct()
    bad = F.coalesce("QA状态", F.lit("")).rlike("待|缺|疑")
    return rows.select(F.col("序号").alias("entry_no"), F.when(bad, "").otherwise(F.col("规格")).alias("spec"))


REQUIRED = ("适应症", "规格", "成人剂量", "用法", "禁忌")


def missing_fields(spark, folder):
    rows = table(spark, folder, "western_meds").select("序号", *REQUIRED).distinct()
    missing = F.array_compact(F.array(*[F.when(F.coalesce(F.trim(c), F.lit("")) == "", c) for c in REQUIRED]))
    return rows.select(F.explode(missing).alias("field")).groupBy("field").agg(F.count("*").alias("entries"))


MISSING_SQL = "SELECT field, count(*) AS entries FROM (SELECT unnest([" + ", ".join(f"CASE WHEN coalesce(trim({c}, ' '), '') = '' THEN '{c}' END" for c in REQUIRED) + "]) AS field FROM (SELECT DISTINCT 序号, 适应症, 规格, 成人剂量, 用法, 禁忌 FROM western_meds)) WHERE field IS NOT NULL GROUP BY field"


def qa_grade(spark, folder):
    rows = table(spark, folder, "western_meds").select("序号", *REQUIRED).distinct()
    missing = F.array_size(F.array_compact(F.array(*[F.when(F.coalesce(F.trim(c), F.lit("")) == "", c) for c in REQUIRED])))
    suspicious = F.concat_ws("", *REQUIRED).rlike("待核|可能|疑似")
    grade = F.when(missing > 0, "incomplete").when(suspicious, "review").otherwise("usable")
    return rows.groupBy(grade.alias("grade")).agg(F.count("*").alias("entries"))


QA_SQL = "SELECT CASE WHEN " + " OR ".join(f"coalesce(trim({c}, ' '), '') = ''" for c in REQUIRED) + " THEN 'incomplete' WHEN regexp_matches(concat_ws('', " + ", ".join(REQUIRED) + "), '待核|可能|疑似') THEN 'review' ELSE 'usable' END AS grade, count(*) AS entries FROM (SELECT DISTINCT 序号, 适应症, 规格, 成人剂量, 用法, 禁忌 FROM western_meds) GROUP BY 1"


def dual_expand(spark, folder):
    tracks = F.when(F.col("track") == "DUAL", F.array(F.lit("EBM"), F.lit("TCM"))).otherwise(F.array("track"))
    return _chats(spark, folder).select(F.explode(tracks).alias("track")).groupBy("track").agg(F.count("*").alias("rows"))


def variant_expand(spark, folder):
    forms = F.array(*[F.lit(f) for f in ("{}的组成是什么？", "{}主治什么？", "{}怎么加减？")])
    names = table(spark, folder, "formula_textbook").select(F.col("方剂名").alias("name")).filter("name <> ''").distinct()
    return names.select("name", F.explode(forms).alias("f")).select(F.replace(F.col("f"), F.lit("{}"), F.col("name")).alias("prompt"))


def sections_map(spark, folder):
    """How often each bracketed section title occurs, and the mean size of what follows it."""
    bodies = F.split("text", r"【[^】]*】")
    pairs = F.arrays_zip(F.regexp_extract_all("text", F.lit(r"【([^】]*)】"), 1).alias("tag"), F.slice(bodies, F.lit(2), F.greatest(F.size(bodies) - 1, F.lit(0))).alias("body"))
    rows = table(spark, folder, "documents").filter(F.col("text").isNotNull()).select(F.explode(pairs).alias("p"))
    return rows.groupBy(F.col("p.tag").alias("tag")).agg(F.count("*").alias("sections"), F.sum(F.length("p.body")).alias("chars"))


SECTIONS_SQL = rf"""SELECT tag, count(*) AS sections, sum(length(body)) AS chars FROM (SELECT unnest(regexp_extract_all(text, '【([^】]*)】', 1)) AS tag, unnest(string_split_regex(text, '【[^】]*】')[2:]) AS body FROM {D}) GROUP BY tag"""


def meta_fields(spark, folder):
    """The typed fields of a JSON column."""
    rows = _seeds(spark, folder).select("id", F.try_parse_json("meta").alias("v")).filter(F.col("v").isNotNull())
    return rows.select("id", F.try_variant_get("v", "$.row", "bigint").alias("row"), F.try_variant_get("v", "$.batch", "bigint").alias("batch"))


def schema_profile(spark, folder):
    """The union schema of a JSON column."""
    rows = table(spark, folder, "events").filter(F.col("props").isNotNull())
    return rows.groupBy("event_type").agg(F.schema_of_variant_agg(F.try_parse_json("props")).alias("schema"), F.count("*").alias("rows"))


def validate_gate(spark, folder):
    rows = _answers(spark, folder).filter(F.col("chosen").isNotNull())
    final = X.strip_think(F.col("chosen"))
    out = rows.agg(F.count_if(F.contains(final, F.lit("<think>"))).alias("residue"), F.count_if(X.latin_ratio(final) > 0.3).alias("latin"), F.count("*").alias("rows"))
    return out.withColumn("passes", (F.col("residue") == 0) & (F.col("latin") <= 0.05 * F.col("rows")))


HAN = r"[\x{4e00}-\x{9fff}]"
FINAL_SQL = r"regexp_replace(regexp_replace(regexp_replace(chosen, '(?s)<think>.*?</think>', '', 'g'), '(?s)<think>.*', '', 'g'), '^[\s\p{Z}]+|[\s\p{Z}]+$', '', 'g')"
GATE_SQL = f"""SELECT *, residue = 0 AND latin <= 0.05 * rows AS passes FROM (SELECT count(*) FILTER (contains(f, '<think>')) AS residue, count(*) FILTER (a::DOUBLE / greatest(b, 1) > 0.3) AS latin, count(*) AS rows
FROM (SELECT f, length(f) - length(regexp_replace(f, '[A-Za-z]', '', 'g')) AS a, length(f) - length(regexp_replace(f, '[A-Za-z]|{HAN}', '', 'g')) AS b FROM (SELECT {FINAL_SQL} AS f FROM {ANSWERS} WHERE chosen IS NOT NULL)))"""


def mcq_reward(spark, folder):
    items = table(spark, folder, "eval_v2").filter("type = 'mcq'").select("question", "answer")
    said, marked = X.choice_of(F.col("chosen"))
    rows = _answers(spark, folder).filter(F.col("chosen").isNotNull()).select("id", "prompt", said.alias("said"), marked.alias("marked"))
    joined = rows.join(items, rows["prompt"] == items["question"], "left")
    return joined.select("id", F.when(F.col("said") == F.upper(F.trim("answer")), 1.0).otherwise(0.0).alias("accuracy"), F.when(F.col("marked"), 1.0).otherwise(0.0).alias("format"))


REWARD_SQL = rf"""SELECT id, CASE WHEN answer IS NOT NULL AND upper(coalesce(m, regexp_extract_all(right(chosen, 120), '[A-Da-d]')[-1])) = upper(trim(answer)) THEN 1.0::DOUBLE ELSE 0.0 END AS accuracy, CASE WHEN m IS NOT NULL THEN 1.0::DOUBLE ELSE 0.0 END AS format
FROM (SELECT id, prompt, chosen, regexp_extract_all(chosen, '{X.CHOICE}', 1)[-1] AS m FROM {ANSWERS} WHERE chosen IS NOT NULL) a LEFT JOIN (SELECT question, answer FROM eval_v2 WHERE type = 'mcq') e ON a.prompt = e.question"""


def eval_union(spark, folder):
    rows = table(spark, folder, "eval_v2").select(F.lower(F.trim("source")).alias("source"), "type")
    return rows.groupBy("source", "type").agg(F.count("*").alias("items"))


def safe_name(spark, folder):
    name = F.regexp_replace("source_file", r'[\\/:*?"<>|\s]+', "_")
    return _seeds(spark, folder).select(name.alias("name")).groupBy("name").agg(F.count("*").alias("rows"))


def route_domain(spark, folder):
    return _answers(spark, folder).groupBy("domain", F.when(F.col("domain") == "TCM", "A").otherwise("B").alias("route")).agg(F.count("*").alias("rows"))


def rewrite_select(spark, folder):
    rows = _answers(spark, folder).filter(X.evades(F.col("chosen"), X.EVASIVE_V4)).select("id")
    return rows.orderBy(F.md5(F.concat(F.lit("42:"), F.col("id").cast("string"))), "id").limit(500)


REWRITE_SQL = rf"SELECT id FROM {ANSWERS} WHERE regexp_matches(left(chosen, 300), '{X.EVASIVE_V4}') ORDER BY md5('42:' || id::VARCHAR), id LIMIT 500"


# -- files and streams, through the shared folder ----------------------------------------------------------------------------


def _fresh(spark, name):
    return f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"


def to_json_line(spark, folder):
    """Seed prompts written as JSON lines and read again."""
    path = _fresh(spark, "json")
    write_json_lines(_seeds(spark, folder).select("id", "prompt", "category"), path)
    return spark.read.schema("id string, prompt string, category string").json(path)


def scan_jsonl(spark, folder):
    """JSON lines read leniently: what doesn't parse is skipped."""
    path = _fresh(spark, "lenient")
    rows = table(spark, folder, "seed_prompts").dropDuplicates(["id"]).select(F.coalesce("meta", F.lit("{broken")).alias("value"))
    rows.write.text(path)
    found = read_lenient_json(spark, path)
    return found.agg(F.count("*").alias("records"))


def csv_roundtrip(spark, folder):
    """A catalogue written as CSV, quotes and line breaks included, and read again."""
    path = _fresh(spark, "csv")
    rows = table(spark, folder, "western_meds").select(F.col("序号").alias("entry_no"), F.coalesce("`别名/商品名`", F.lit("")).alias("alias")).distinct()
    rows.write.csv(path, header=True, quote='"', escape='"', quoteAll=True, emptyValue="", ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False)
    return read_csv_strings(spark, path).select("entry_no", F.length(F.coalesce("alias", F.lit(""))).alias("size"))


def stream_staging(spark, folder):
    """Events streamed into a staging folder in micro-batches, then counted."""
    source, target = f"{folder}/events.parquet", _fresh(spark, "staged")
    start = _fresh(spark, "in")
    spark.read.parquet(source).write.parquet(start)
    stage(spark, start, target, _fresh(spark, "state"), 2)
    return spark.read.parquet(target).groupBy("event_type").agg(F.count("*").alias("events"))


QUERIES = {
    "norm_records": (norm_records, NORM_RECORDS_SQL),
    "strict_records": (strict_records, STRICT_SQL),
    "pick_alias": (pick_alias, f"SELECT id, coalesce({_sql_strip('gt_answer')}, {_sql_strip('category')}, {_sql_strip('source')}) AS value FROM {SEEDS}"),
    "norm_pair": (norm_pair, NORM_SQL),
    "norm_multi": (norm_multi, f"SELECT track, source, count(*) AS rows FROM (SELECT source, 'seed' AS track FROM {SEEDS} UNION ALL SELECT source, 'eval' FROM eval_v2 UNION ALL SELECT teacher, 'answers' FROM {ANSWERS}) GROUP BY 1, 2"),
    "norm_qa_prefix": (norm_qa_prefix, rf"SELECT id, turn, length(regexp_replace(c, '^\s*(?:问|答|Q|A)\s*[:：]\s*', '')) AS size FROM (SELECT id, unnest(messages).content AS c, generate_subscripts(messages, 1) - 1 AS turn FROM {CHATS}) WHERE c IS NOT NULL"),
    "label_lines": (label_lines, LABEL_SQL),
    "section_answer": (section_answer, "SELECT 序号 AS entry_no, md5(concat_ws(chr(10), nullif(功用, ''), nullif(主治, ''))) AS answer FROM (SELECT DISTINCT 序号, 功用, 主治 FROM formula_textbook) WHERE 功用 <> '' OR 主治 <> ''"),
    "mcq_prompt": (mcq_prompt, MCQ_SQL),
    "mcq_options": (mcq_options, "SELECT id, len(k) AS options, array_to_string(k, '') AS letters FROM (SELECT id, list_filter(list_sort(map_keys(options)), lambda x: trim(options[x]) <> '') AS k FROM eval_v2 WHERE type = 'mcq')"),
    "gold_letter": (gold_letter, "SELECT * FROM (SELECT id, upper(left(trim(answer), 1)) AS letter FROM eval_v2) WHERE letter IN ('A', 'B', 'C', 'D', 'E')"),
    "split_think_tail": (split_think_tail, TAIL_SQL),
    "map_category": (map_category, f"SELECT CASE lower(trim(category, ' ')) WHEN 'tcm' THEN 'TCM' WHEN 'mcq' THEN 'Exam' WHEN 'mcq_gen' THEN 'Exam' WHEN 'short' THEN 'General' ELSE lower(trim(category, ' ')) END AS domain, count(*) AS rows FROM {SEEDS} GROUP BY 1"),
    "classify_first": (classify_first, f"SELECT CASE WHEN regexp_matches(prompt, '汤|散|丸|饮|膏|丹|煎') THEN 'formula' WHEN regexp_matches(prompt, 'mg|剂量|漏服') THEN 'drug' WHEN regexp_matches(prompt, '舌苔|脉') THEN 'pattern' ELSE 'other' END AS kind, count(*) AS prompts FROM {SEEDS} WHERE prompt IS NOT NULL GROUP BY 1"),
    "source_type": (source_type, f"SELECT CASE WHEN src LIKE 'hf\\_%' ESCAPE '\\' THEN 'pulled' WHEN src LIKE 'opus\\_%' ESCAPE '\\' THEN 'generated' WHEN src LIKE 'd1\\_%' ESCAPE '\\' THEN 'textbook' ELSE 'older' END AS kind, count(*) AS samples FROM {CHATS} GROUP BY 1"),
    "last_message": (last_message, f"SELECT id, messages[-1].role AS role, length(messages[-1].content) AS size FROM {CHATS}"),
    "role_pick": (role_pick, f"SELECT id, md5(list_filter(messages, lambda m: m.role = 'assistant')[1].content) AS answer FROM {CHATS}"),
    "route_prompt": (route_prompt, f"SELECT CASE track WHEN 'TCM' THEN '中医' WHEN 'EBM' THEN '循证' ELSE '通用' END AS system, count(*) AS samples FROM {CHATS} GROUP BY 1"),
    "overlay_fix": (overlay_fix, "SELECT 序号 AS entry_no, md5(coalesce(CASE WHEN QA问题 <> '' THEN concat_ws('；', QA问题, '已人工复核') ELSE QA问题 END, '')) AS issues FROM (SELECT DISTINCT 序号, QA状态, QA问题 FROM western_meds)"),
    "blank_bad": (blank_bad, "SELECT 序号 AS entry_no, CASE WHEN regexp_matches(coalesce(QA状态, ''), '待|缺|疑') THEN '' ELSE 规格 END AS spec FROM (SELECT DISTINCT 序号, 规格, QA状态 FROM western_meds)"),
    "missing_fields": (missing_fields, MISSING_SQL),
    "qa_grade": (qa_grade, QA_SQL),
    "dual_expand": (dual_expand, f"SELECT track, count(*) AS rows FROM (SELECT unnest(CASE WHEN track = 'DUAL' THEN ['EBM', 'TCM'] ELSE [track] END) AS track FROM {CHATS}) GROUP BY track"),
    "variant_expand": (variant_expand, "SELECT replace(f, '{}', name) AS prompt FROM (SELECT DISTINCT 方剂名 AS name FROM formula_textbook WHERE 方剂名 <> ''), (SELECT unnest(['{}的组成是什么？', '{}主治什么？', '{}怎么加减？']) AS f)"),
    "sections_map": (sections_map, SECTIONS_SQL),
    "meta_fields": (meta_fields, f"SELECT id, (meta->>'$.row')::BIGINT AS row, (meta->>'$.batch')::BIGINT AS batch FROM {SEEDS} WHERE json_valid(meta)"),
    "schema_profile": (schema_profile, None),
    "validate_gate": (validate_gate, GATE_SQL),
    "mcq_reward": (mcq_reward, REWARD_SQL),
    "eval_union": (eval_union, "SELECT lower(trim(source, ' ')) AS source, type, count(*) AS items FROM eval_v2 GROUP BY 1, 2"),
    "safe_name": (safe_name, rf"""SELECT regexp_replace(source_file, '[\\/:*?"<>|\s]+', '_', 'g') AS name, count(*) AS rows FROM {SEEDS} GROUP BY 1"""),
    "route_domain": (route_domain, f"SELECT domain, CASE WHEN domain = 'TCM' THEN 'A' ELSE 'B' END AS route, count(*) AS rows FROM {ANSWERS} GROUP BY 1, 2"),
    "rewrite_select": (rewrite_select, REWRITE_SQL),
    "to_json_line": (to_json_line, f"SELECT id, prompt, category FROM {SEEDS}"),
    "scan_jsonl": (scan_jsonl, f"SELECT count(*) AS records FROM {SEEDS} WHERE json_valid(meta)"),
    "csv_roundtrip": (csv_roundtrip, "SELECT 序号 AS entry_no, length(a) AS size FROM (SELECT DISTINCT 序号, coalesce(\"别名/商品名\", '') AS a FROM western_meds)"),
    "stream_staging": (stream_staging, "SELECT event_type, count(*) AS events FROM events GROUP BY 1"),
}
