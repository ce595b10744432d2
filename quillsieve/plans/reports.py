"""Queries of aggregates, reports, joins and ordered windows."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from quillsieve.functions import text as X
from quillsieve.operators import joins as J
from quillsieve.operators import order as O
from quillsieve.operators.ranks import carry_over, in_ranges, scalars
from quillsieve.operators.report import bucketed, percentiles_by_index
from quillsieve.session import table

D = "documents WHERE text IS NOT NULL"
SEEDS = "(SELECT DISTINCT ON (id) * FROM seed_prompts)"
ANSWERS = "(SELECT DISTINCT ON (id) * FROM chosen_rerun_bad)"


def _docs(spark, folder, *columns):
    return table(spark, folder, "documents").filter(F.col("text").isNotNull()).select("doc_id", "text", *columns)


def _answers(spark, folder):
    return table(spark, folder, "chosen_rerun_bad").dropDuplicates(["id"])


def count_by(spark, folder):
    return _docs(spark, folder, "source").groupBy("source").agg(F.count("*").alias("documents"))


def topn_sources(spark, folder):
    rows = _docs(spark, folder, "source").groupBy("source").agg(F.count("*").alias("documents"), F.min("doc_id").alias("first_seen"))
    return rows.orderBy(F.desc("documents"), "first_seen").limit(10)


def flag_rates(spark, folder):
    rows = _docs(spark, folder, "source")
    flags = (F.length("text") < 100, F.col("text").rlike("仅供参考"), X.latin_ratio(F.col("text")) > 0.15)
    return rows.groupBy("source").agg(F.count("*").alias("documents"), *[F.count_if(f).alias(n) for f, n in zip(flags, ("short", "evasive", "mixed"))])


HAN = r"[\x{4e00}-\x{9fff}]"
LATIN_SQL = f"(length(text) - length(regexp_replace(text, '[A-Za-z]', '', 'g')))::DOUBLE / greatest(length(text) - length(regexp_replace(text, '[A-Za-z]|{HAN}', '', 'g')), 1)"
FLAGS_SQL = f"count(*) AS documents, count(*) FILTER (length(text) < 100) AS short, count(*) FILTER (contains(text, '仅供参考')) AS evasive, count(*) FILTER ({LATIN_SQL} > 0.15) AS mixed"


def flag_rates_rollup(spark, folder):
    rows = _docs(spark, folder, "source")
    return rows.rollup("source").agg(F.count("*").alias("documents"), F.count_if(F.length("text") < 100).alias("short"))


def len_hist(spark, folder):
    return _docs(spark, folder).groupBy(bucketed(F.length("text"), (50, 100, 200, 400, 800, 1600)).alias("size")).agg(F.count("*").alias("documents"))


LEN_HIST_SQL = f"""SELECT CASE WHEN n < 50 THEN '<50' WHEN n < 100 THEN '50-99' WHEN n < 200 THEN '100-199' WHEN n < 400 THEN '200-399' WHEN n < 800 THEN '400-799' WHEN n < 1600 THEN '800-1599' ELSE '>=1600' END AS size,
count(*) AS documents FROM (SELECT length(text) AS n FROM {D}) GROUP BY 1"""


def hit_band(spark, folder):
    ratio = X.cjk_ratio_all(F.col("text"))
    band = F.when(ratio < 0.3, "low").when(ratio < 0.6, "middle").when(ratio < 0.9, "high").otherwise("full")
    return _docs(spark, folder).groupBy(band.alias("band")).agg(F.count("*").alias("documents"))


CJK_SQL = f"(length(text) - length(regexp_replace(text, '{HAN}', '', 'g')))::DOUBLE / greatest(length(text), 1)"


def hit_by_category(spark, folder):
    rows = _docs(spark, folder, "category").groupBy("category").agg(F.round(F.avg(F.length("text")), 6).alias("mean_size"), F.count("*").alias("documents"))
    return rows.orderBy(F.desc("documents"), "category")


def pctl_floor(spark, folder):
    rows = _docs(spark, folder, "source").withColumn("size", F.length("text"))
    return percentiles_by_index(rows, "source", "size", (0.5, 0.9, 0.99))


PCTL_SQL = f"""SELECT source, len(l) AS n, {', '.join(f"l[least(floor(len(l) * {q})::INT, len(l) - 1) + 1] AS p{round(q * 100)}" for q in (0.5, 0.9, 0.99))}
FROM (SELECT source, list(length(text) ORDER BY length(text)) AS l FROM {D} GROUP BY source)"""


def len_stats(spark, folder):
    n = F.length("text")
    rows = _docs(spark, folder, "source").groupBy("source")
    return rows.agg(F.min(n).alias("least"), F.max(n).alias("most"), F.floor(F.sum(n) / F.count("*")).alias("mean"))


def trunc_by_cat(spark, folder):
    rows = _answers(spark, folder).filter(F.col("output_tokens").isNotNull())
    most = percentiles_by_index(rows, "category", "output_tokens", (0.95,))
    cut = rows.groupBy("category").agg(F.max("output_tokens").alias("most"), F.count_if(F.col("finish_reason") == "length").alias("cut"))
    return most.join(cut, "category").withColumn("alarm", F.col("cut") / F.col("n") > 0.02)


TRUNC_SQL = f"""SELECT category, len(l) AS n, l[least(floor(len(l) * 0.95)::INT, len(l) - 1) + 1] AS p95, most, cut, cut::DOUBLE / len(l) > 0.02 AS alarm
FROM (SELECT category, list(output_tokens ORDER BY output_tokens) AS l, max(output_tokens) AS most, count(*) FILTER (finish_reason = 'length') AS cut FROM {ANSWERS} WHERE output_tokens IS NOT NULL AND category IS NOT NULL GROUP BY category)"""


def share_of_total(spark, folder):
    rows = _docs(spark, folder, "category").groupBy("category").agg(F.count("*").alias("documents"))
    whole = rows.agg(F.sum("documents").alias("_all"))
    return rows.select("*", *scalars(whole)).select("category", "documents", F.round(100 * F.col("documents") / F.col("_all"), 6).alias("percent"))


def distinct_names(spark, folder):
    rows = table(spark, folder, "formula_textbook").select("方剂名").filter(F.col("方剂名") != "")
    return rows.agg(F.count_distinct("方剂名").alias("names"))


#: Tokens of a model's context, and those that stay free.
CONTEXT, FREE = 8192, 64


def cap_recommend(spark, folder):
    """A limit above all answers, in steps of 256, that the longest prompt still leaves room for."""
    rows = _answers(spark, folder).filter(F.col("output_tokens").isNotNull())
    p = percentiles_by_index(rows.withColumn("g", F.lit(1)), "g", "output_tokens", (0.99,)).select("p99")
    need = F.greatest(F.floor(F.col("p99") * 1.15), F.col("most") + 256)
    longest = scalars(rows.agg(F.max("output_tokens").alias("most"), F.max(X.approx_tokens(F.col("prompt"))).cast("bigint").alias("asked")))
    return p.select("*", *longest).select(F.least(F.ceil(need / 256) * 256, CONTEXT - F.col("asked") - FREE).alias("cap"))


CAP_SQL = rf"""SELECT least((ceil(greatest(floor(l[least(floor(len(l) * 0.99)::INT, len(l) - 1) + 1] * 1.15::DOUBLE), l[-1] + 256) / 256) * 256)::BIGINT, 8192 - asked - 64) AS cap
FROM (SELECT list(output_tokens ORDER BY output_tokens) AS l, max(trunc(h * 1.5::DOUBLE + (n - h) * 0.3::DOUBLE)::BIGINT) AS asked
FROM (SELECT output_tokens, length(prompt) AS n, length(prompt) - length(regexp_replace(prompt, '[\x{{4e00}}-\x{{9fff}}]', '', 'g')) AS h FROM {ANSWERS} WHERE output_tokens IS NOT NULL))"""


def score_collapse(spark, folder):
    """For each user the first score that isn't the default, else the default."""
    score = F.floor("value").cast("bigint")
    rows = table(spark, folder, "events").filter(F.col("value").isNotNull()).withColumn("score", score)
    first = F.min_by(F.when(F.col("score") != 5, F.col("score")), F.when(F.col("score") != 5, F.struct("ts", "event_id")))
    return rows.groupBy("user_id").agg(F.coalesce(first, F.lit(5)).alias("score"))


SCORE_SQL = """SELECT user_id, coalesce(arg_min(floor(value)::BIGINT, (ts, event_id)) FILTER (floor(value) <> 5), 5) AS score FROM events WHERE value IS NOT NULL GROUP BY user_id"""


def score_join(spark, folder):
    scores = table(spark, folder, "events").filter("event_type = 'purchase'").groupBy("user_id").agg(F.max(F.floor("value").cast("bigint")).alias("score"))
    rows = table(spark, folder, "customer").select(F.col("c_custkey").alias("user_id"))
    return rows.join(scores, "user_id", "left").select("user_id", F.coalesce("score", F.lit(5)).alias("score"))


def review_stats(spark, folder):
    n = F.length("chosen")
    rows = _answers(spark, folder).filter(F.col("chosen").isNotNull()).groupBy("teacher")
    return rows.agg(F.round(F.avg(n), 6).alias("mean_size"), F.round(F.count_if(F.contains("chosen", F.lit("<think>"))) / F.count("*"), 6).alias("with_thinking"))


def quota_need(spark, folder):
    rows = _docs(spark, folder, "category").filter(F.col("category").isNotNull()).groupBy("category").agg(F.count("*").alias("have"))
    return rows.select("category", "have", F.ceil(F.greatest(F.lit(0), F.lit(500) - F.col("have")) * F.lit(1.2)).alias("need"))


def concat_range(spark, folder):
    """Titles of the entries on neighbouring pages, in page order: a window of bounded width."""
    page = F.regexp_extract("PDF页码", r"(\d+)", 1).try_cast("int")
    rows = table(spark, folder, "formula_textbook").select("序号", "方剂名", page.alias("page")).distinct().filter(F.col("page").isNotNull())
    tens = rows.groupBy(F.floor(F.col("page") / 10).alias("tens")).agg(F.array_sort(F.collect_list(F.struct("page", F.col("序号").cast("bigint").alias("n"), "方剂名"))).alias("l"))
    return tens.select("tens", F.array_join(F.transform("l", lambda x: x["方剂名"]), "|").alias("titles"))


CONCAT_SQL = r"""SELECT page // 10 AS tens, string_agg(方剂名, '|' ORDER BY page, n) AS titles FROM
(SELECT DISTINCT 序号::BIGINT AS n, 方剂名, try_cast(regexp_extract(PDF页码, '(\d+)', 1) AS INT) AS page FROM formula_textbook) WHERE page IS NOT NULL GROUP BY 1"""


def fill_counts(spark, folder):
    columns = ("药品通用名", "适应症", "规格", "成人剂量", "禁忌", "不良反应")
    rows = table(spark, folder, "western_meds").select("序号", *columns).distinct()
    return rows.agg(*[F.count_if(F.col(c) != "").alias(f"c{at}") for at, c in enumerate(columns)])


FILL_SQL = "SELECT " + ", ".join(f"count(*) FILTER ({c} <> '') AS c{at}" for at, c in enumerate(("药品通用名", "适应症", "规格", "成人剂量", "禁忌", "不良反应"))) + " FROM (SELECT DISTINCT 序号, 药品通用名, 适应症, 规格, 成人剂量, 禁忌, 不良反应 FROM western_meds)"


def merge_stats(spark, folder):
    rows = table(spark, folder, "seed_prompts").dropDuplicates(["id"]).filter(F.col("prompt").isNotNull())
    return rows.agg(F.count("*").alias("rows"), (F.count("*") - F.count_distinct(F.md5("prompt"))).alias("duplicates"), F.count_distinct("source").alias("sources"))


def audit_compact(spark, folder):
    rows = _answers(spark, folder).filter(F.col("chosen").isNotNull())
    head, tail = F.replace(F.left("chosen", F.lit(30)), F.lit("\n"), F.lit(" ")), F.replace(F.right("chosen", F.lit(20)), F.lit("\n"), F.lit(" "))
    ratio = F.length("chosen") / F.greatest(F.length("prompt"), F.lit(1))
    return rows.select("id", head.alias("head"), tail.alias("tail"), F.round(ratio, 6).alias("length_ratio"))


def topk_len(spark, folder):
    rows = _docs(spark, folder).select("doc_id", F.length("text").alias("size"))
    return rows.orderBy(F.desc("size"), "doc_id").limit(3).unionByName(rows.orderBy("size", "doc_id").limit(5))


def scan_limit(spark, folder):
    return _docs(spark, folder).select("doc_id").orderBy("doc_id").limit(500)


def sort_case(spark, folder):
    rank = F.when(F.col("o_orderpriority") == "1-URGENT", 0).when(F.col("o_orderpriority") == "2-HIGH", 1).otherwise(2)
    rows = table(spark, folder, "orders").orderBy(rank, F.desc("o_totalprice"), "o_orderkey").limit(100)
    return rows.select("o_orderkey", "o_orderpriority")


SORT_SQL = "SELECT o_orderkey, o_orderpriority FROM orders ORDER BY CASE o_orderpriority WHEN '1-URGENT' THEN 0 WHEN '2-HIGH' THEN 1 ELSE 2 END, o_totalprice DESC, o_orderkey LIMIT 100"


# -- joins and windows ---------------------------------------------------------------------------------------------------


def asof_chapter(spark, folder):
    events = table(spark, folder, "events").select("event_id", "user_id", "ts", "event_type", "value")
    starts = events.filter("event_type = 'view'").groupBy("user_id", "ts").agg(F.max("event_id").alias("view_id"))
    buys = events.filter("event_type = 'purchase'").select("event_id", "user_id", "ts")
    return J.asof_backward(buys, starts, "user_id", "ts", "ts", "view_id").select("event_id", "view_id")


ASOF_SQL = """SELECT p.event_id, v.view_id FROM (SELECT * FROM events WHERE event_type = 'purchase') p
ASOF LEFT JOIN (SELECT user_id, ts, max(event_id) AS view_id FROM events WHERE event_type = 'view' GROUP BY 1, 2) v ON p.user_id = v.user_id AND p.ts >= v.ts"""


def band_join(spark, folder):
    meds = table(spark, folder, "part").select(F.col("p_partkey").alias("a"))
    near = table(spark, folder, "supplier").select(F.col("s_suppkey").alias("b"))
    return J.band_join(meds, near, "a", "b", 2).select("a", "b")


def band_join_all(spark, folder):
    """The band join of all parts, whatever their size."""
    parts = table(spark, folder, "part").select(F.col("p_partkey").alias("a"))
    near = table(spark, folder, "supplier").select(F.col("s_suppkey").alias("b"))
    return J.band_join(parts, near, "a", "b", 2).select("a", "b")


def substr_join(spark, folder):
    names = table(spark, folder, "herb_names").select("herb")
    return J.contained_terms(_docs(spark, folder), "doc_id", "text", names, "herb").groupBy("term").agg(F.count("*").alias("documents"))


SUBSTR_SQL = f"SELECT herb AS term, count(*) AS documents FROM (SELECT doc_id, text FROM {D}) d JOIN (SELECT DISTINCT herb FROM herb_names) h ON contains(d.text, h.herb) GROUP BY 1"


def substr_first(spark, folder):
    """For each formula name the first herb in the catalogue's order that it contains or that contains it."""
    names = table(spark, folder, "formula_textbook").select(F.col("方剂名").alias("name")).distinct()
    herbs = table(spark, folder, "herb_names").select("herb", "latin").withColumn("place", F.col("latin"))
    return J.first_contained(names, "name", "name", herbs, "herb", "place").select("name", F.col("term").alias("herb"))


SUBSTR_FIRST_SQL = """SELECT name, arg_min(herb, (latin, herb)) AS herb FROM (SELECT DISTINCT 方剂名 AS name FROM formula_textbook WHERE 方剂名 <> '') n
JOIN herb_names h ON contains(n.name, h.herb) OR contains(h.herb, n.name) GROUP BY name"""


def update_join(spark, folder):
    rows = table(spark, folder, "western_meds").select("序号", "药品通用名", "规格", "用法").distinct()
    better = table(spark, folder, "western_meds").filter(F.col("优先级") == "P0").select("药品通用名", "规格", "用法", F.col("序号").cast("bigint").alias("n"))
    best = O.first_wins(better.filter(F.col("药品通用名") != ""), [F.col("药品通用名")], ["n"])
    done = J.update_join(rows, best, "药品通用名", ["规格", "用法"])
    return done.select(F.col("序号").alias("entry_no"), F.md5(F.concat_ws("|", "规格", "用法")).alias("fields"))


UPDATE_SQL = """WITH r AS (SELECT DISTINCT 序号, 药品通用名, 规格, 用法 FROM western_meds), b AS (SELECT 药品通用名, 规格, 用法 FROM western_meds WHERE 优先级 = 'P0' AND 药品通用名 <> '' QUALIFY row_number() OVER (PARTITION BY 药品通用名 ORDER BY 序号::BIGINT) = 1)
SELECT r.序号 AS entry_no, md5(concat_ws('|', coalesce(nullif(b.规格, ''), r.规格), coalesce(nullif(b.用法, ''), r.用法))) AS fields FROM r LEFT JOIN b ON r.药品通用名 = b.药品通用名"""


def extend_to_n(spark, folder):
    urgent = table(spark, folder, "part").filter("p_size >= 45").select("p_partkey")
    rest = table(spark, folder, "part").join(urgent, "p_partkey", "left_anti").select("p_partkey")
    ranked = urgent.withColumn("r", F.lit(0)).unionByName(rest.withColumn("r", F.lit(1)))
    return ranked.orderBy("r", "p_partkey").limit(400).select("p_partkey")


def candidate_rank(spark, folder):
    """The best alias for each herb: exact, else the longest containing it; ties by text."""
    herbs = table(spark, folder, "herb_names").select("herb")
    names = table(spark, folder, "formula_textbook").select(F.explode(F.split("组成", "[、，,；;|｜/\\s]+")).alias("name")).filter("name <> ''").distinct()
    pairs = J.contained_terms(names.withColumn("key", F.col("name")), "key", "name", herbs, "herb")
    score = F.when(F.col("key") == F.col("term"), 1000).otherwise(500) + F.length("term")
    return pairs.groupBy("term").agg(F.min_by("key", F.struct(-score, "key")).alias("best"), F.count("*").alias("candidates"))


CANDIDATE_SQL = r"""WITH n AS (SELECT DISTINCT unnest(string_split_regex(组成, '[、，,；;|｜/\s]+')) AS name FROM formula_textbook), p AS (SELECT name, herb FROM n JOIN (SELECT DISTINCT herb FROM herb_names) ON name <> '' AND contains(name, herb))
SELECT herb AS term, arg_min(name, (-(CASE WHEN name = herb THEN 1000 ELSE 500 END + length(herb)), name)) AS best, count(*) AS candidates FROM p GROUP BY herb"""


def batch_align(spark, folder):
    rows = O.with_index(table(spark, folder, "orders").select("o_orderkey"), "o_orderkey", "n")
    return rows.select("o_orderkey", F.floor(F.col("n") / 10).alias("batch"), (F.col("n") % 10).alias("place"))


def next_page(spark, folder):
    """The next event of the same user: rows are sorted by time, so the least later one is simply the next."""
    rows = in_ranges(table(spark, folder, "events").select("event_id", "user_id", "ts"), ["user_id", "ts", "event_id"])
    return carry_over(rows, "user_id", F.col("event_id"), "next_event", forward=False).select("event_id", "next_event")


def page_window(spark, folder):
    """For each order day the orders of that day and the two after it, though days are missing."""
    days = table(spark, folder, "orders").groupBy(F.unix_date(F.col("o_orderdate").cast("date")).alias("day")).agg(F.count("*").alias("n"))
    months = days.withColumn("block", F.floor(F.col("day") / 64))
    spread = months.select("day", "n", F.explode(F.array("block", F.floor((F.col("day") - 2) / 64))).alias("block")).distinct()
    near = Window.partitionBy("block").orderBy("day").rangeBetween(0, 2)
    return spread.withColumn("three_days", F.sum("n").over(near)).filter("block = floor(day / 64)").select("day", "three_days")


PAGE_WINDOW_SQL = """SELECT day, sum(n) OVER (ORDER BY day RANGE BETWEEN CURRENT ROW AND 2 FOLLOWING)::BIGINT AS three_days FROM (SELECT (o_orderdate::DATE - DATE '1970-01-01') AS day, count(*) AS n FROM orders GROUP BY 1)"""


def staged_match(spark, folder):
    """Each med's formula by name: equal names first, else a formula in its composition; the stage is kept."""
    names = table(spark, folder, "formula_textbook").select(F.col("方剂名").alias("name")).filter("name <> ''").distinct()
    texts = _docs(spark, folder)
    head = F.regexp_extract("text", r"^[【《#\s]*([\x{4e00}-\x{9fff}]{2,5}?)[】》\n]", 1)
    first = texts.select("doc_id", head.alias("name")).join(names, "name").select("doc_id", "name", F.lit(1).alias("stage"))
    second = J.contained_terms(texts, "doc_id", "text", names, "name").select("doc_id", F.col("term").alias("name"), F.lit(2).alias("stage"))
    return first.unionByName(second).groupBy("doc_id").agg(F.min_by("name", F.struct("stage", "name")).alias("name"), F.min("stage").cast("bigint").alias("stage"))


STAGED_SQL = rf"""WITH n AS (SELECT DISTINCT 方剂名 AS name FROM formula_textbook WHERE 方剂名 <> ''), d AS (SELECT doc_id, text FROM {D}),
s AS (SELECT doc_id, name, 1 AS stage FROM d JOIN n ON regexp_extract(text, '^[【《#\s]*([\x{{4e00}}-\x{{9fff}}]{{2,5}}?)[】》\n]', 1) = name UNION ALL SELECT doc_id, name, 2 FROM d JOIN n ON contains(text, name))
SELECT doc_id, arg_min(name, (stage, name)) AS name, min(stage) AS stage FROM s GROUP BY doc_id"""

QUERIES = {
    "count_by": (count_by, f"SELECT source, count(*) AS documents FROM {D} GROUP BY source"),
    "topn_sources": (topn_sources, f"SELECT source, count(*) AS documents, min(doc_id) AS first_seen FROM {D} GROUP BY source ORDER BY documents DESC, first_seen LIMIT 10"),
    "flag_rates": (flag_rates, f"SELECT source, {FLAGS_SQL} FROM {D} GROUP BY source"),
    "flag_rates_rollup": (flag_rates_rollup, f"SELECT source, count(*) AS documents, count(*) FILTER (length(text) < 100) AS short FROM {D} GROUP BY ROLLUP (source)"),
    "len_hist": (len_hist, LEN_HIST_SQL),
    "hit_band": (hit_band, f"SELECT CASE WHEN r < 0.3 THEN 'low' WHEN r < 0.6 THEN 'middle' WHEN r < 0.9 THEN 'high' ELSE 'full' END AS band, count(*) AS documents FROM (SELECT {CJK_SQL} AS r FROM {D}) GROUP BY 1"),
    "hit_by_category": (hit_by_category, f"SELECT category, round(avg(length(text)), 6) AS mean_size, count(*) AS documents FROM {D} GROUP BY category"),
    "pctl_floor": (pctl_floor, PCTL_SQL),
    "len_stats": (len_stats, f"SELECT source, min(length(text)) AS least, max(length(text)) AS most, sum(length(text)) // count(*) AS mean FROM {D} GROUP BY source"),
    "trunc_by_cat": (trunc_by_cat, TRUNC_SQL),
    "share_of_total": (share_of_total, f"SELECT category, count(*) AS documents, round(100.0::DOUBLE * count(*) / sum(count(*)) OVER (), 6) AS percent FROM {D} GROUP BY category"),
    "distinct_names": (distinct_names, "SELECT count(DISTINCT 方剂名) AS names FROM formula_textbook WHERE 方剂名 <> ''"),
    "cap_recommend": (cap_recommend, CAP_SQL),
    "score_collapse": (score_collapse, SCORE_SQL),
    "score_join": (score_join, "SELECT c_custkey AS user_id, coalesce(score, 5) AS score FROM customer LEFT JOIN (SELECT user_id, max(floor(value)::BIGINT) AS score FROM events WHERE event_type = 'purchase' GROUP BY user_id) e ON c_custkey = e.user_id"),
    "review_stats": (review_stats, f"SELECT teacher, round(avg(length(chosen)), 6) AS mean_size, round(count(*) FILTER (contains(chosen, '<think>'))::DOUBLE / count(*), 6) AS with_thinking FROM {ANSWERS} WHERE chosen IS NOT NULL GROUP BY teacher"),
    "quota_need": (quota_need, f"SELECT category, have, ceil(greatest(0, 500 - have) * 1.2)::BIGINT AS need FROM (SELECT category, count(*) AS have FROM {D} AND category IS NOT NULL GROUP BY category)"),
    "concat_range": (concat_range, CONCAT_SQL),
    "fill_counts": (fill_counts, FILL_SQL),
    "merge_stats": (merge_stats, f"SELECT count(*) AS rows, count(*) - count(DISTINCT prompt) AS duplicates, count(DISTINCT source) AS sources FROM {SEEDS} WHERE prompt IS NOT NULL"),
    "audit_compact": (audit_compact, f"SELECT id, replace(left(chosen, 30), chr(10), ' ') AS head, replace(right(chosen, 20), chr(10), ' ') AS tail, round(length(chosen)::DOUBLE / greatest(length(prompt), 1), 6) AS length_ratio FROM {ANSWERS} WHERE chosen IS NOT NULL"),
    "topk_len": (topk_len, f"(SELECT doc_id, length(text) AS size FROM {D} ORDER BY size DESC, doc_id LIMIT 3) UNION ALL (SELECT doc_id, length(text) AS size FROM {D} ORDER BY size, doc_id LIMIT 5)"),
    "scan_limit": (scan_limit, f"SELECT doc_id FROM {D} ORDER BY doc_id LIMIT 500"),
    "sort_case": (sort_case, SORT_SQL),
    "asof_chapter": (asof_chapter, ASOF_SQL),
    "band_join": (band_join, "SELECT p_partkey AS a, s_suppkey AS b FROM part JOIN supplier ON abs(p_partkey - s_suppkey) <= 2"),
    "band_join_all": (band_join_all, "SELECT p_partkey AS a, s_suppkey AS b FROM part JOIN supplier ON abs(p_partkey - s_suppkey) <= 2"),
    "substr_join": (substr_join, SUBSTR_SQL),
    "substr_first": (substr_first, SUBSTR_FIRST_SQL),
    "update_join": (update_join, UPDATE_SQL),
    "extend_to_n": (extend_to_n, "SELECT p_partkey FROM part ORDER BY p_size < 45, p_partkey LIMIT 400"),
    "candidate_rank": (candidate_rank, CANDIDATE_SQL),
    "batch_align": (batch_align, "SELECT o_orderkey, n // 10 AS batch, n % 10 AS place FROM (SELECT o_orderkey, row_number() OVER (ORDER BY o_orderkey) - 1 AS n FROM orders)"),
    "next_page": (next_page, "SELECT event_id, lead(event_id) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS next_event FROM events"),
    "page_window": (page_window, PAGE_WINDOW_SQL),
    "staged_match": (staged_match, STAGED_SQL),
}
