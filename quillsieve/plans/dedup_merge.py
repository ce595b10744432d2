"""Queries of dedup, merging, sets, samples and ids."""

from __future__ import annotations

from pyspark.sql import functions as F

from quillsieve.functions import text as X
from quillsieve.operators import order as O
from quillsieve.operators import sample as S
from quillsieve.operators.joins import coverage
from quillsieve.operators.report import first_reason
from quillsieve.session import table

HAN = r"[\x{4e00}-\x{9fff}]"
EVASIVE = "仅供参考|文中例子"


def _docs(spark, folder, *columns):
    return table(spark, folder, "documents").filter(F.col("text").isNotNull()).select("doc_id", "text", *columns)


def _seeds(spark, folder):
    rows = table(spark, folder, "seed_prompts").select("id", "prompt", "source", "source_file", "category", "gt_answer")
    return rows.dropDuplicates(["id"])


SEEDS = "(SELECT DISTINCT ON (id) id, prompt, source, source_file, category, gt_answer FROM seed_prompts)"
D = "documents WHERE text IS NOT NULL"
FIRST = "QUALIFY row_number() OVER (PARTITION BY {} ORDER BY {}) = 1"


def _reason():
    return first_reason(
        ("short", F.length("text") < 80), ("script", X.cjk_ratio_all(F.col("text")) < 0.35), ("evasive", F.col("text").rlike(EVASIVE))
    )


REASON_SQL = f"""CASE WHEN length(text) < 80 THEN 'short' WHEN (length(text) - length(regexp_replace(text, '{HAN}', '', 'g')))::DOUBLE / greatest(length(text), 1) < 0.35 THEN 'script'
WHEN regexp_matches(text, '{EVASIVE}') THEN 'evasive' END"""


def dedup_first(spark, folder):
    return O.first_wins(_docs(spark, folder), [F.md5("text")], ["doc_id"], ["doc_id"])


def dedup_then_filter(spark, folder):
    judged = _docs(spark, folder).withColumn("fine", _reason().isNull())
    return O.first_wins(judged, [F.sha1("text")], ["doc_id"], ["doc_id", "fine"]).filter("fine").select("doc_id")


def filter_then_dedup(spark, folder):
    kept = O.first_wins(_docs(spark, folder, "lang").filter(_reason().isNull()), [F.md5("text")], ["doc_id"], ["doc_id", "lang"])
    numbered = O.with_index(kept.withColumn("lang", F.coalesce("lang", F.lit("none"))), "doc_id", "n", ["lang"])
    return numbered.select("doc_id", F.format_string("%s_%05d", "lang", F.col("n")).alias("new_id"))


FTD_SQL = f"""WITH k AS (SELECT doc_id, coalesce(lang, 'none') AS lang FROM {D} AND {REASON_SQL} IS NULL {FIRST.format('md5(text)', 'doc_id')})
SELECT doc_id, printf('%s_%05d', lang, row_number() OVER (PARTITION BY lang ORDER BY doc_id) - 1) AS new_id FROM k"""


def dedup_cross(spark, folder):
    a = _seeds(spark, folder).select("id", "prompt", F.lit("seed").alias("origin"))
    b = table(spark, folder, "eval_v2").select("id", F.col("question").alias("prompt"), F.lit("eval").alias("origin"))
    kept = O.first_wins(a.unionByName(b).filter(F.col("prompt").isNotNull()), [F.md5("prompt")], ["origin", "id"], ["id", "origin"])
    return kept.select("id", "origin")


CROSS_SQL = f"""SELECT id, origin FROM (SELECT id, prompt, 'seed' AS origin FROM {SEEDS} UNION ALL SELECT id, question, 'eval' FROM eval_v2) WHERE prompt IS NOT NULL {FIRST.format('md5(prompt)', 'origin, id')}"""


def dedup_id(spark, folder):
    rows = table(spark, folder, "seed_prompts").select("id", "ingested_at")
    return O.first_wins(rows, [F.col("id")], ["ingested_at"], ["id", "ingested_at"])


def dedup_last(spark, folder):
    rows = table(spark, folder, "chosen_rerun_bad").select("id", "ingested_at")
    return O.last_wins(rows, [F.col("id")], ["ingested_at"], ["id", "ingested_at"])


def template_cap(spark, folder):
    """At most 50 documents that begin with the same 40 characters, copies aside."""
    headed = _docs(spark, folder).withColumn("head", F.left("text", F.lit(40)))
    once = O.first_wins(headed, [F.md5("text")], ["doc_id"], ["doc_id", "head"])
    return O.cap_per_key(once, [F.col("head")], [F.col("doc_id")], 50).select("doc_id")


CAP_SQL = f"""WITH o AS (SELECT doc_id, text FROM {D} {FIRST.format('md5(text)', 'doc_id')})
SELECT doc_id FROM o QUALIFY row_number() OVER (PARTITION BY left(text, 40) ORDER BY doc_id) <= 50"""


def dedup_composite(spark, folder):
    rows = table(spark, folder, "formula_textbook").select("序号", "方剂名", "《方剂学》页码").distinct()
    number = F.col("序号").cast("bigint")
    kept = O.first_wins(rows.withColumn("n", number), [F.col("方剂名"), F.col("《方剂学》页码")], ["n"])
    return kept.select(F.col("n").alias("entry_no"))


COMPOSITE_SQL = """WITH r AS (SELECT DISTINCT 序号, 方剂名, "《方剂学》页码" FROM formula_textbook)
SELECT 序号::BIGINT AS entry_no FROM r QUALIFY row_number() OVER (PARTITION BY 方剂名, "《方剂学》页码" ORDER BY 序号::BIGINT) = 1"""


def dup_report(spark, folder):
    once = _docs(spark, folder, "source").groupBy("source", F.md5("text").alias("h")).agg(F.count("*").alias("n"))
    return once.groupBy("source").agg(F.sum("n").alias("rows"), F.count("*").alias("distinct_rows"), F.max("n").alias("most_copies"))


DUP_SQL = f"SELECT source, sum(n) AS rows, count(*) AS distinct_rows, max(n) AS most_copies FROM (SELECT source, md5(text), count(*) AS n FROM {D} GROUP BY 1, 2) GROUP BY source"


def merge_priority(spark, folder):
    new = _seeds(spark, folder).select(F.col("prompt").alias("k"), F.col("id"))
    answers = table(spark, folder, "chosen_rerun_bad").select(F.col("prompt").alias("k"), F.col("id").cast("string").alias("id")).distinct()
    tests = table(spark, folder, "eval_v2").select(F.col("question").alias("k"), "id")
    merged = O.priority_merge([s.filter(F.col("k").isNotNull()) for s in (answers, new, tests)], "k", "id")
    return merged.select("id", F.col("priority").cast("bigint").alias("priority"))


MERGE_SQL = f"""SELECT id, priority FROM (SELECT DISTINCT prompt AS k, id::VARCHAR AS id, 0 AS priority FROM chosen_rerun_bad UNION ALL SELECT prompt, id, 1 FROM {SEEDS} UNION ALL SELECT question, id, 2 FROM eval_v2)
WHERE k IS NOT NULL {FIRST.format('k', 'priority, id')}"""


def sft_ids(spark, folder):
    kept = _docs(spark, folder).filter(F.length("text") >= 200).select("doc_id")
    return O.with_index(kept, "doc_id", "n").select("doc_id", F.format_string("v4_A_%06d", "n").alias("new_id"))


def sft_ids_by_cat(spark, folder):
    kept = _docs(spark, folder, "category").filter(F.col("category").isNotNull()).select("doc_id", "category")
    numbered = O.with_index(kept, "doc_id", "n", ["category"])
    return numbered.select("doc_id", F.format_string("v6_%s_%05d", "category", F.col("n")).alias("new_id"))


def renumber(spark, folder):
    rows = table(spark, folder, "western_meds").select(F.col("序号").cast("bigint").alias("old")).distinct()
    return O.with_index(rows, "old", "n").select("old", (F.col("n") + 1).alias("new"))


def template_rotate(spark, folder):
    forms = F.array(*[F.lit(f) for f in ("请介绍{}", "{}怎么用？", "{}的适应症是什么？", "说明{}的禁忌", "{}有哪些别名？")])
    rows = table(spark, folder, "western_meds").select(F.col("序号").cast("bigint").alias("n0"), F.col("药品通用名").alias("name")).distinct()
    kept = O.with_index(rows.filter(F.coalesce("name", F.lit("")) != ""), "n0", "n")
    return kept.select(F.col("n0").alias("entry_no"), F.replace(F.element_at(forms, (F.col("n") % 5 + 1).cast("int")), F.lit("{}"), F.col("name")).alias("prompt"))


ROTATE_SQL = """WITH r AS (SELECT DISTINCT 序号::BIGINT AS n0, 药品通用名 AS name FROM western_meds), k AS (SELECT *, row_number() OVER (ORDER BY n0) - 1 AS n FROM r WHERE coalesce(name, '') <> '')
SELECT n0 AS entry_no, replace(['请介绍{}', '{}怎么用？', '{}的适应症是什么？', '说明{}的禁忌', '{}有哪些别名？'][n % 5 + 1], '{}', name) AS prompt FROM k"""


def union_sources(spark, folder):
    a = _seeds(spark, folder).select(F.lit("seed").alias("origin"))
    b = table(spark, folder, "eval_v2").select(F.lit("eval").alias("origin"))
    return a.unionByName(b).groupBy("origin").agg(F.count("*").alias("rows"))


def union_ids(spark, folder):
    a = table(spark, folder, "orders").select(F.col("o_custkey").alias("k"))
    return a.union(table(spark, folder, "customer").select("c_custkey")).distinct().select("k")


def coverage_gap(spark, folder):
    wanted = table(spark, folder, "customer").select(F.col("c_custkey").alias("k"), "c_mktsegment")
    done = table(spark, folder, "orders").select(F.col("o_custkey").alias("k"))
    return coverage(wanted, done, "k").groupBy("c_mktsegment").agg(F.count("*").alias("missing"))


def ids_intersect(spark, folder):
    a = table(spark, folder, "lineitem").filter("l_quantity > 49").select(F.col("l_orderkey").alias("k"))
    return a.intersect(table(spark, folder, "orders").filter("o_orderpriority = '1-URGENT'").select("o_orderkey"))


def resume_anti(spark, folder):
    done = table(spark, folder, "chosen_rerun_bad").select("prompt")
    return _seeds(spark, folder).filter(F.col("prompt").isNotNull()).join(done, "prompt", "left_anti").select("id")


def missing_ids(spark, folder):
    urgent = table(spark, folder, "lineitem").filter("l_returnflag = 'R'").select(F.col("l_orderkey").alias("o_orderkey"))
    late = table(spark, folder, "lineitem").filter("l_shipdate > date '1998-01-01'").select(F.col("l_orderkey").alias("o_orderkey"))
    return table(spark, folder, "orders").join(urgent.union(late), "o_orderkey", "left_anti").select("o_orderkey")


def rerun_bad(spark, folder):
    bad = table(spark, folder, "lineitem").filter("l_discount > 0.09").select(F.col("l_orderkey").alias("o_orderkey"))
    done = table(spark, folder, "lineitem").filter("l_linestatus = 'F'").select(F.col("l_orderkey").alias("o_orderkey"))
    return table(spark, folder, "orders").join(bad, "o_orderkey", "left_semi").join(done, "o_orderkey", "left_anti").select("o_orderkey")


def pair_by_id(spark, folder):
    answers = table(spark, folder, "chosen_rerun_bad").dropDuplicates(["id"]).filter(~F.col("finish_reason").eqNullSafe("length"))
    good = answers.filter("teacher = 'm2_large'").select("prompt", F.col("id").alias("chosen_id"), "chosen")
    poor = answers.filter("teacher <> 'm2_large'").select("prompt", F.col("id").alias("rejected_id"), F.col("chosen").alias("rejected"))
    filled = lambda c: F.coalesce(F.trim(c), F.lit("")) != ""
    return good.filter(filled("chosen")).join(poor.filter(filled("rejected")), "prompt").select("chosen_id", "rejected_id")


PAIR_SQL = """WITH a AS (SELECT DISTINCT ON (id) * FROM chosen_rerun_bad), f AS (SELECT * FROM a WHERE finish_reason IS DISTINCT FROM 'length' AND coalesce(trim(chosen, ' '), '') <> '')
SELECT g.id AS chosen_id, p.id AS rejected_id FROM f g JOIN f p ON g.prompt = p.prompt WHERE g.teacher = 'm2_large' AND p.teacher <> 'm2_large'"""


def hash_quota(spark, folder):
    rows = _docs(spark, folder, "source")
    return S.hash_quota(rows, F.concat_ws("::", "source", F.col("doc_id").cast("string")), 0.3).select("doc_id")


def _rank_key(seed, key):
    return f"md5('{seed}:' || {key}::VARCHAR)"


def hash_sample_k(spark, folder):
    return S.sample_k(_docs(spark, folder), "doc_id", 200, 42).select("doc_id")


def stratified_k(spark, folder):
    return S.stratified_k(_docs(spark, folder, "source"), "source", "doc_id", 5, 42).select("doc_id", "source")


def stratified_prop(spark, folder):
    return S.stratified_share(_docs(spark, folder, "source").drop("text"), "source", "doc_id", 300, 42).select("doc_id", "source")


PROP_SQL = f"""WITH d AS (SELECT doc_id, source FROM {D}), q AS (SELECT source, round_even(300.0::DOUBLE * count(*) / (SELECT count(*) FROM d), 0) AS quota FROM d GROUP BY source)
SELECT doc_id, d.source FROM d JOIN q ON d.source IS NOT DISTINCT FROM q.source QUALIFY row_number() OVER (PARTITION BY d.source ORDER BY {_rank_key(42, 'doc_id')}, doc_id) <= any_value(quota) OVER (PARTITION BY d.source)"""


def holdout_split(spark, folder):
    rank = S.hash_order(F.col("id"), 42)
    rows = table(spark, folder, "eval_v2").filter("type = 'mcq'").select("id", rank.alias("r"))
    held = rows.orderBy("r", "id").limit(250).select("id", F.lit("held_out").alias("part"))
    return rows.join(held, "id", "left").select("id", F.coalesce("part", F.lit("train")).alias("part"))


HOLDOUT_SQL = f"SELECT id, CASE WHEN row_number() OVER (ORDER BY {_rank_key(42, 'id')}, id) <= 250 THEN 'held_out' ELSE 'train' END AS part FROM eval_v2 WHERE type = 'mcq'"


def drop_bottom_pct(spark, folder):
    rows = table(spark, folder, "events").filter(F.col("value").isNotNull()).select("event_id", F.floor("value").alias("score"))
    return S.drop_bottom(rows, "score", "event_id", 0.1).select("event_id")


BOTTOM_SQL = """WITH r AS (SELECT event_id, floor(value) AS score FROM events WHERE value IS NOT NULL)
SELECT event_id FROM r QUALIFY row_number() OVER (ORDER BY score, event_id) > (SELECT floor(count(*) * 0.1) FROM r)"""


def shuffle_hash(spark, folder):
    return table(spark, folder, "part").select("p_partkey", S.hash_order(F.col("p_partkey"), 42).alias("shuffled_by"))


def shard_skew(spark, folder):
    rows = table(spark, folder, "orders").select(F.pmod("o_orderkey", F.lit(8)).alias("shard"))
    return rows.groupBy("shard").agg(F.count("*").alias("rows"))


def first_n_per_group(spark, folder):
    rows = _docs(spark, folder, "source")
    return O.cap_per_key(rows, [F.col("source")], [F.col("doc_id")], 3).select("doc_id", "source")


def one_per_group(spark, folder):
    return O.first_wins(_docs(spark, folder, "category"), [F.col("category")], ["doc_id"], ["doc_id", "category"])


def cat_quota(spark, folder):
    rows = _seeds(spark, folder).withColumn("cat", F.lower(F.trim("category")))
    return O.cap_per_key(rows, [F.col("cat")], [F.col("id")], 50).select("id", "cat")


QUERIES = {
    "dedup_first": (dedup_first, f"SELECT doc_id FROM {D} {FIRST.format('md5(text)', 'doc_id')}"),
    "dedup_then_filter": (dedup_then_filter, f"SELECT doc_id FROM (SELECT doc_id, text FROM {D} {FIRST.format('sha1(text)', 'doc_id')}) WHERE {REASON_SQL} IS NULL"),
    "filter_then_dedup": (filter_then_dedup, FTD_SQL),
    "dedup_cross": (dedup_cross, CROSS_SQL),
    "dedup_id": (dedup_id, "SELECT id, min(ingested_at) AS ingested_at FROM seed_prompts GROUP BY id"),
    "dedup_last": (dedup_last, "SELECT id, max(ingested_at) AS ingested_at FROM chosen_rerun_bad GROUP BY id"),
    "template_cap": (template_cap, CAP_SQL),
    "dedup_composite": (dedup_composite, COMPOSITE_SQL),
    "dup_report": (dup_report, DUP_SQL),
    "merge_priority": (merge_priority, MERGE_SQL),
    "sft_ids": (sft_ids, f"SELECT doc_id, printf('v4_A_%06d', row_number() OVER (ORDER BY doc_id) - 1) AS new_id FROM {D} AND length(text) >= 200"),
    "sft_ids_by_cat": (sft_ids_by_cat, f"SELECT doc_id, printf('v6_%s_%05d', category, row_number() OVER (PARTITION BY category ORDER BY doc_id) - 1) AS new_id FROM {D} AND category IS NOT NULL"),
    "renumber": (renumber, "SELECT old, row_number() OVER (ORDER BY old) AS new FROM (SELECT DISTINCT 序号::BIGINT AS old FROM western_meds)"),
    "template_rotate": (template_rotate, ROTATE_SQL),
    "union_sources": (union_sources, f"SELECT origin, count(*) AS rows FROM (SELECT 'seed' AS origin FROM {SEEDS} UNION ALL SELECT 'eval' FROM eval_v2) GROUP BY origin"),
    "union_ids": (union_ids, "SELECT o_custkey AS k FROM orders UNION SELECT c_custkey FROM customer"),
    "coverage_gap": (coverage_gap, "SELECT c_mktsegment, count(*) AS missing FROM customer WHERE c_custkey NOT IN (SELECT o_custkey FROM orders) GROUP BY 1"),
    "ids_intersect": (ids_intersect, "SELECT l_orderkey AS k FROM lineitem WHERE l_quantity > 49 INTERSECT SELECT o_orderkey FROM orders WHERE o_orderpriority = '1-URGENT'"),
    "resume_anti": (resume_anti, f"SELECT id FROM {SEEDS} s WHERE prompt IS NOT NULL AND NOT EXISTS (SELECT 1 FROM chosen_rerun_bad c WHERE c.prompt = s.prompt)"),
    "missing_ids": (missing_ids, "SELECT o_orderkey FROM orders WHERE o_orderkey NOT IN (SELECT l_orderkey FROM lineitem WHERE l_returnflag = 'R' OR l_shipdate > DATE '1998-01-01')"),
    "rerun_bad": (rerun_bad, "SELECT o_orderkey FROM orders WHERE o_orderkey IN (SELECT l_orderkey FROM lineitem WHERE l_discount > 0.09) AND o_orderkey NOT IN (SELECT l_orderkey FROM lineitem WHERE l_linestatus = 'F')"),
    "pair_by_id": (pair_by_id, PAIR_SQL),
    "hash_quota": (hash_quota, f"SELECT doc_id FROM {D} AND ('0x' || left(sha256(concat_ws('::', source, doc_id)), 16))::UBIGINT::DOUBLE / 18446744073709551616.0 < 0.3"),
    "hash_sample_k": (hash_sample_k, f"SELECT doc_id FROM {D} ORDER BY {_rank_key(42, 'doc_id')}, doc_id LIMIT 200"),
    "stratified_k": (stratified_k, f"SELECT doc_id, source FROM {D} QUALIFY row_number() OVER (PARTITION BY source ORDER BY {_rank_key(42, 'doc_id')}, doc_id) <= 5"),
    "stratified_prop": (stratified_prop, PROP_SQL),
    "holdout_split": (holdout_split, HOLDOUT_SQL),
    "drop_bottom_pct": (drop_bottom_pct, BOTTOM_SQL),
    "shuffle_hash": (shuffle_hash, f"SELECT p_partkey, {_rank_key(42, 'p_partkey')} AS shuffled_by FROM part"),
    "shard_skew": (shard_skew, "SELECT o_orderkey % 8 AS shard, count(*) AS rows FROM orders GROUP BY 1"),
    "first_n_per_group": (first_n_per_group, f"SELECT doc_id, source FROM {D} QUALIFY row_number() OVER (PARTITION BY source ORDER BY doc_id) <= 3"),
    "one_per_group": (one_per_group, f"SELECT doc_id, category FROM {D} {FIRST.format('category', 'doc_id')}"),
    "cat_quota": (cat_quota, f"SELECT id, lower(trim(category, ' ')) AS cat FROM {SEEDS} QUALIFY row_number() OVER (PARTITION BY lower(trim(category, ' ')) ORDER BY id) <= 50"),
}
