import random

from pyspark.sql import functions as F

from quillsieve.operators import joins, order, sample
from quillsieve.operators.ranks import running_sum
from quillsieve.operators.report import bucketed, first_reason, percentiles_by_index


def _rows(n=300, seed=1):
    rng = random.Random(seed)
    # one key holds a third of the rows
    return [(i, "hot" if rng.random() < 0.33 else f"k{rng.randrange(20)}", rng.randrange(50)) for i in range(n)]


def test_first_and_last_wins(spark):
    rows = _rows()
    df = spark.createDataFrame(rows, "id int, k string, v int").repartition(7)
    first = {r.k: r.id for r in order.first_wins(df, [F.col("k")], ["id"]).collect()}
    last = {r.k: r.id for r in order.last_wins(df, [F.col("k")], ["id"]).collect()}
    assert first == {k: min(i for i, x, _ in rows if x == k) for _, k, _ in rows}
    assert last == {k: max(i for i, x, _ in rows if x == k) for _, k, _ in rows}
    again = order.first_wins(order.first_wins(df, [F.col("k")], ["id"]), [F.col("k")], ["id"])
    assert again.count() == len(first)


def test_cap_and_index(spark):
    rows = _rows()
    df = spark.createDataFrame(rows, "id int, k string, v int")
    capped = order.cap_per_key(df, [F.col("k")], [F.col("id")], 3).groupBy("k").count().collect()
    assert all(r["count"] <= 3 for r in capped)
    places = {r.id: r.n for r in order.with_index(df.repartition(5), "id", "n", ["k"]).collect()}
    for key in {k for _, k, _ in rows}:
        own = sorted(i for i, k, _ in rows if k == key)
        assert [places[i] for i in own] == list(range(len(own)))
    alone = {r.id: r.n for r in order.with_index(df, "id", "n").collect()}
    assert alone == {i: i for i, _, _ in rows}
    assert order.with_index(df.limit(0), "id", "n").count() == 0


def test_priority_merge_keeps_the_first_source(spark):
    a = spark.createDataFrame([("x", 1), ("y", 2)], "k string, id int")
    b = spark.createDataFrame([("y", 3), ("z", 4)], "k string, id int")
    assert {(r.k, r.id) for r in order.priority_merge([a, b], "k", "id").collect()} == {("x", 1), ("y", 2), ("z", 4)}


def test_running_sum(spark):
    rows = [(g, b, i, i % 7) for g in "ab" for i, b in enumerate([0, 0, 1, 2, 2, 2, 5])]
    df = spark.createDataFrame(rows, "g string, b int, i int, s int").repartition(3)
    got = {(r.g, r.i): r.t for r in running_sum(df, ["g"], "b", ["i"], F.col("s"), "t").collect()}
    for g in "ab":
        total = 0
        for _, _, i, s in sorted(r for r in rows if r[0] == g):
            total += s
            assert got[g, i] == total


def test_samples(spark):
    df = spark.createDataFrame([(i, "hot" if i % 3 else "cold", i % 10) for i in range(900)], "id int, s string, v int")
    small = {r.id for r in sample.hash_quota(df, F.col("id").cast("string"), 0.2).collect()}
    large = {r.id for r in sample.hash_quota(df.repartition(5), F.col("id").cast("string"), 0.5).collect()}
    assert small <= large and 120 < len(small) < 240
    assert sample.stratified_k(df, "s", "id", 7, 1).count() == 14
    assert {r["count"] for r in sample.stratified_share(df, "s", "id", 90, 1).groupBy("s").count().collect()} == {30, 60}
    kept = {r.id for r in sample.drop_bottom(df, "v", "id", 0.15).collect()}
    assert kept == {i for _, i in sorted((i % 10, i) for i in range(900))[135:]}


def test_asof_matches_brute_force(spark):
    rng = random.Random(2)
    left = [(i, rng.randrange(3), rng.randrange(100)) for i in range(60)]
    right = [(k, t, k * 1000 + t) for k in range(3) for t in rng.sample(range(100), 9)]
    a = spark.createDataFrame(left, "id int, k int, t int")
    b = spark.createDataFrame(right, "k int, u int, v int")
    got = {r.id: r.v for r in joins.asof_backward(a, b, "k", "t", "u", "v").collect()}
    for i, k, t in left:
        before = [(u, v) for q, u, v in right if q == k and u <= t]
        assert got[i] == (max(before)[1] if before else None)


def test_band_and_containment_match_brute_force(spark):
    a = spark.createDataFrame([(x,) for x in (-5, 0, 3, 9, 14)], "x int")
    b = spark.createDataFrame([(y,) for y in range(-8, 20)], "y int")
    got = {(r.x, r.y) for r in joins.band_join(a, b, "x", "y", 3).collect()}
    assert got == {(x, y) for x in (-5, 0, 3, 9, 14) for y in range(-8, 20) if abs(x - y) <= 3}
    texts = [(1, "甲乙丙甲乙"), (2, "丙"), (3, ""), (4, "乙丙丁")]
    terms = ["甲乙", "乙丙", "丙丁戊", "丙"]
    found = joins.contained_terms(spark.createDataFrame(texts, "id int, t string"), "id", "t", spark.createDataFrame([(x,) for x in terms], "w string"), "w")
    assert {(r.id, r.term) for r in found.collect()} == {(i, w) for i, t in texts for w in terms if w in t}


def test_percentiles_and_labels(spark):
    values = [("a", v) for v in (5, 1, 9, 3, 3, 3, 8, 2, 10, 7)] + [("b", 4)]
    df = spark.createDataFrame(values, "g string, v int")
    got = {r.g: (r.n, r.p50, r.p90) for r in percentiles_by_index(df, "g", "v", (0.5, 0.9)).collect()}
    own = sorted(v for g, v in values if g == "a")
    assert got == {"a": (10, own[5], own[9]), "b": (1, 4, 4)}
    labels = df.select(bucketed(F.col("v"), (3, 8)).alias("l"), first_reason(("low", F.col("v") < 3), ("odd", F.col("v") % 2 == 1)).alias("r")).collect()
    assert {(r.l, r.r) for r in labels} == {("3-7", "odd"), ("<3", "low"), (">=8", "odd"), (">=8", None), ("3-7", None)}


def test_bounded_rows(spark):
    from quillsieve.operators.sample import bounded_rows

    df = spark.createDataFrame([(f"t{k % 500}" if k % 3 else "hot",) for k in range(3000)] + [(None,)], "t string")
    picked = sorted(r.t for r in bounded_rows(df, "t", 40, 3001).collect())
    assert 0 < len(picked) == len(set(picked)) <= 40 and None not in picked
    assert picked == sorted(r.t for r in bounded_rows(df.repartition(9), "t", 40, 3001).collect())
    assert bounded_rows(df, "t", 5000, 3001).count() == df.filter("t is not null").distinct().count()
    assert bounded_rows(df.limit(0), "t", 5, 0).count() == 0


def test_hot_keys_and_outliers_are_split(spark, request):
    """A key with a third of all rows, and one id far from all others, spread over ranges."""
    from quillsieve.operators import joins, sample
    from quillsieve.operators.ranks import in_ranges

    rows = [(i if i else 10**15, "hot" if i % 3 == 0 else f"k{i % 50}", i % 7) for i in range(3000)]
    df = spark.createDataFrame(rows, "id bigint, k string, score int")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")  # so that few rows have several ranges
    request.addfinalizer(lambda: spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled"))
    parts = in_ranges(df, ["k", "id"]).groupBy("_part").count().collect()
    assert len(parts) > 1 and max(p["count"] for p in parts) < 1500
    ranked = sorted((k, i) for i, k, _ in rows)
    places, seen = {}, {}
    for k, i in ranked:
        places[i] = seen[k] = seen.get(k, -1) + 1
    assert {r.id: r.n for r in order.with_index(df, "id", "n", ["k"]).collect()} == places
    assert {r.id: r.n for r in order.with_index(df, "id", "n").collect()} == {i: n for n, i in enumerate(sorted(i for i, _, _ in rows))}
    kept = {r.id for r in sample.drop_bottom(df, "score", "id", 0.25).collect()}
    assert kept == {i for i, _, _ in sorted(rows, key=lambda r: (r[2], r[0]))[750:]}
    picked = sample.stratified_share(df, "k", "id", 300, 1).groupBy("k").count().collect()
    assert {r.k: r["count"] for r in picked}["hot"] == 100
    views = spark.createDataFrame([("hot", t, t * 10) for t in range(5, 3000, 400)], "k string, at bigint, v bigint")
    found = joins.asof_backward(df.filter("id < 1000000"), views, "k", "id", "at", "v").collect()
    times = list(range(5, 3000, 400))
    for r in found:
        before = [t for t in times if t <= r.id]
        assert r.v == (before[-1] * 10 if r.k == "hot" and before else None)


def test_first_contained_and_short_terms(spark):
    from quillsieve.operators import joins

    names = spark.createDataFrame([("桂枝汤",), ("枝",), ("白术散",), (None,), ("",), ("无关",)], "name string")
    terms = spark.createDataFrame([("桂枝", 2), ("枝", 3), ("白术", 1), ("汤", 0), (None, 4), ("", 5)], "w string, o int")
    found = {r.name: r.term for r in joins.first_contained(names, "name", "name", terms, "w", "o").collect()}
    assert found == {"桂枝汤": "汤", "枝": "桂枝", "白术散": "白术"}
    pairs = {(r.name, r.term) for r in joins.contained_terms(names, "name", "name", terms, "w").collect()}
    assert pairs == {("桂枝汤", "桂枝"), ("桂枝汤", "枝"), ("桂枝汤", "汤"), ("枝", "枝"), ("白术散", "白术")}


def test_winners_ship_only_what_is_asked_for(spark):
    df = spark.createDataFrame([(i, f"t{i % 3}", "x" * 50) for i in range(20)], "id bigint, k string, body string")
    plan = order.first_wins(df, [F.md5("k")], ["id"], ["id"])
    shown = plan._jdf.queryExecution().executedPlan().toString()
    shuffled = shown[: shown.index("Exchange")]
    assert "body" not in shuffled and "SortAggregate" not in shown and "HashAggregate" in shown
    assert sorted(r.id for r in plan.collect()) == [0, 1, 2]
