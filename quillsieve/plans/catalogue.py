"""Queries of catalogues and books: titles, gates, look-ahead over lines, lists in generated text."""

from __future__ import annotations

from pyspark.sql import functions as F

from quillsieve.functions import text as X
from quillsieve.operators.order import with_index
from quillsieve.operators.report import first_reason
from quillsieve.operators.sample import hash_order
from quillsieve.session import table

D = "documents WHERE text IS NOT NULL"
SEEDS = "(SELECT DISTINCT ON (id) * FROM seed_prompts)"


def title_match(spark, folder):
    """Entries whose located title is their name, or their name before a bracket, blanks aside."""
    rows = table(spark, folder, "formula_textbook").select("序号", "方剂名", "定位标题").distinct()
    bare = lambda c: F.regexp_replace(c, r"[\s\p{Z}]+", "")
    title, name = bare("定位标题"), bare("方剂名")
    same = (title == name) | title.startswith(F.concat(name, F.lit("（"))) | title.startswith(F.concat(name, F.lit("(")))
    return rows.select(F.col("序号").alias("entry_no"), F.coalesce(same, F.lit(False)).alias("matches"))


TITLE_SQL = r"""SELECT 序号 AS entry_no, coalesce(t = n OR starts_with(t, n || '（') OR starts_with(t, n || '('), false) AS matches FROM
(SELECT 序号, regexp_replace(定位标题, '[\s\p{Z}]+', '', 'g') AS t, regexp_replace(方剂名, '[\s\p{Z}]+', '', 'g') AS n FROM (SELECT DISTINCT 序号, 方剂名, 定位标题 FROM formula_textbook))"""


def qa_gate(spark, folder):
    """Why entries are held back, by the first rule that holds."""
    rows = table(spark, folder, "formula_textbook").select("序号", "组成", "主治", "QA问题").distinct()
    empty = lambda c: F.coalesce(X.py_strip(F.col(c)), F.lit("")) == ""
    reason = first_reason(("open_issue", ~empty("QA问题")), ("short_composition", F.coalesce(F.length("组成"), F.lit(0)) < 5), ("no_indication", empty("主治")))
    return rows.groupBy(F.coalesce(reason, F.lit("kept")).alias("reason")).agg(F.count("*").alias("entries"))


GATE_SQL = r"""SELECT CASE WHEN coalesce(regexp_replace(QA问题, '[\s\p{Z}]+', '', 'g'), '') <> '' THEN 'open_issue' WHEN coalesce(length(组成), 0) < 5 THEN 'short_composition' WHEN coalesce(regexp_replace(主治, '[\s\p{Z}]+', '', 'g'), '') = '' THEN 'no_indication' ELSE 'kept' END AS reason,
count(*) AS entries FROM (SELECT DISTINCT 序号, 组成, 主治, QA问题 FROM formula_textbook) GROUP BY 1"""


def textbook_rows(spark, folder):
    """Entries with their pages as numbers and what is missing in them."""
    fields = ("组成", "用法", "功用", "主治")
    rows = table(spark, folder, "formula_textbook").select("序号", "PDF页码", "《方剂学》页码", *fields).distinct()
    page = lambda c: F.regexp_extract(c, r"(\d+)", 1).try_cast("int")
    missing = F.array_compact(F.array(*[F.when(F.coalesce(F.trim(c), F.lit("")) == "", F.lit(c)) for c in fields]))
    return rows.select(F.col("序号").alias("entry_no"), page("PDF页码").alias("pdf_page"), page("《方剂学》页码").alias("book_page"), F.array_join(missing, ",").alias("missing"))


ROWS_SQL = r"""SELECT 序号 AS entry_no, try_cast(regexp_extract(PDF页码, '(\d+)', 1) AS INT) AS pdf_page, try_cast(regexp_extract("《方剂学》页码", '(\d+)', 1) AS INT) AS book_page,
concat_ws(',', CASE WHEN coalesce(trim(组成, ' '), '') = '' THEN '组成' END, CASE WHEN coalesce(trim(用法, ' '), '') = '' THEN '用法' END, CASE WHEN coalesce(trim(功用, ' '), '') = '' THEN '功用' END, CASE WHEN coalesce(trim(主治, ' '), '') = '' THEN '主治' END) AS missing
FROM (SELECT DISTINCT 序号, PDF页码, "《方剂学》页码", 组成, 用法, 功用, 主治 FROM formula_textbook)"""


def index_entries(spark, folder):
    """Index of the book: the pages of each name, as sorted numbers."""
    rows = table(spark, folder, "formula_textbook").select("方剂名", F.regexp_extract("PDF页码", r"(\d+)", 1).try_cast("int").alias("page")).distinct()
    rows = rows.filter((F.col("方剂名") != "") & F.col("page").isNotNull())
    return rows.groupBy(F.col("方剂名").alias("name")).agg(F.array_join(F.transform(F.array_sort(F.collect_set("page")), lambda p: p.cast("string")), ",").alias("pages"))


INDEX_SQL = r"""SELECT 方剂名 AS name, string_agg(page::VARCHAR, ',' ORDER BY page) AS pages FROM (SELECT DISTINCT 方剂名, try_cast(regexp_extract(PDF页码, '(\d+)', 1) AS INT) AS page FROM formula_textbook) WHERE 方剂名 <> '' AND page IS NOT NULL GROUP BY 1"""


def line_lookahead(spark, folder):
    """Documents in which a heading line is followed, within the next two lines, by one with a dose."""
    lines = F.split("text", "\n")
    at = F.sequence(F.lit(1), F.size(lines))
    hit = F.exists(at, lambda i: F.element_at(lines, i).rlike(r"^[【《#]") & F.exists(F.slice(lines, i + 1, F.lit(2)), lambda x: x.rlike(r"\d(?:g|mg)")))
    rows = table(spark, folder, "documents").filter(F.col("text").isNotNull())
    return rows.filter(hit).select("doc_id")


LOOK_SQL = rf"""WITH d AS (SELECT doc_id, string_split(text, chr(10)) AS l FROM {D})
SELECT doc_id FROM d WHERE len(list_filter(range(1, len(l) + 1), lambda i: regexp_matches(l[i], '^[【《#]') AND len(list_filter(l[i + 1:i + 2], lambda x: regexp_matches(x, '\d(?:g|mg)'))) > 0)) > 0"""


def oversample_filter(spark, folder):
    """Rows in random order, filtered, cut at the target."""
    rows = table(spark, folder, "documents").filter(F.col("text").isNotNull())
    kept = rows.filter((F.length("text") >= 100) & (X.cjk_ratio_alnum(F.col("text")) >= 0.5))
    return kept.orderBy(hash_order(F.col("doc_id"), 42), "doc_id").limit(300).select("doc_id")


def _n(pattern):
    return f"(length(text) - length(regexp_replace(text, '{pattern}', '', 'g')))"


HAN, WORDS = r"[\x{4e00}-\x{9fff}]", r"[\p{L}\p{N}]"
OVER_SQL = rf"SELECT doc_id FROM {D} AND length(text) >= 100 AND {_n(HAN)}::DOUBLE / greatest({_n(WORDS)}, 1) >= 0.5 ORDER BY md5('42:' || doc_id::VARCHAR), doc_id LIMIT 300"


def fence_json(spark, folder):
    """Prompts of each source in a fenced JSON list of at most 20, and read back from it."""
    rows = table(spark, folder, "seed_prompts").dropDuplicates(["id"]).filter(F.col("prompt").isNotNull())
    numbered = with_index(rows.select("id", "source", "prompt", "category"), "id", "n", ["source"])
    batches = numbered.groupBy("source", F.floor(F.col("n") / 20).alias("batch")).agg(F.collect_list(F.struct("prompt", "category")).alias("items"))
    fenced = batches.select("source", F.concat(F.lit("```json\n"), F.to_json("items"), F.lit("\n```")).alias("said"))
    body = F.regexp_replace("said", r"^\s*```(?:json)?\s*|\s*```\s*$", "")
    items = fenced.select("source", F.explode(F.from_json(body, "array<struct<prompt string, category string>>")).alias("i"))
    return items.filter(F.trim("i.prompt") != "").groupBy("source").agg(F.count("*").alias("prompts"))


def candidate_rank_tok(spark, folder):
    """For each med the share of its name's characters that its first alias has, the best of each class."""
    rows = table(spark, folder, "western_meds").select(F.col("序号").cast("bigint").alias("n"), "类别", "药品通用名", "别名/商品名").distinct()
    rows = rows.filter((F.col("药品通用名") != "") & (F.col("别名/商品名") != ""))
    own = F.array_distinct(F.filter(F.split("药品通用名", ""), lambda c: c != ""))
    hits = F.size(F.filter(own, lambda c: F.contains(F.col("别名/商品名"), c)))
    scored = rows.select("类别", "n", (hits * 100 + F.length("药品通用名")).alias("score"))
    return scored.groupBy(F.col("类别").alias("kind")).agg(F.max_by("n", F.struct("score", -F.col("n"))).alias("best"), F.max("score").cast("bigint").alias("score"))


TOK_SQL = """SELECT 类别 AS kind, arg_max(n, (score, -n)) AS best, max(score) AS score FROM (SELECT 类别, 序号::BIGINT AS n, len(list_filter(list_distinct(string_split(药品通用名, '')), lambda c: contains("别名/商品名", c))) * 100 + length(药品通用名) AS score
FROM (SELECT DISTINCT 序号, 类别, 药品通用名, "别名/商品名" FROM western_meds) WHERE 药品通用名 <> '' AND "别名/商品名" <> '') GROUP BY 1"""

QUERIES = {
    "title_match": (title_match, TITLE_SQL),
    "qa_gate": (qa_gate, GATE_SQL),
    "textbook_rows": (textbook_rows, ROWS_SQL),
    "index_entries": (index_entries, INDEX_SQL),
    "line_lookahead": (line_lookahead, LOOK_SQL),
    "oversample_filter": (oversample_filter, OVER_SQL),
    "fence_json": (fence_json, rf"SELECT source, count(*) AS prompts FROM {SEEDS} WHERE prompt IS NOT NULL AND trim(prompt, ' ') <> '' GROUP BY source"),
    "candidate_rank_tok": (candidate_rank_tok, TOK_SQL),
}
