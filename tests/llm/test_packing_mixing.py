import math
import random
from collections import Counter

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from quillsieve.llm.mixing import mix, queue, schedule, shares, unmet
from quillsieve.llm.packing import fill_report, pack, plan_bins


@settings(max_examples=100, deadline=None)
@given(st.integers(2, 60).flatmap(lambda c: st.tuples(st.just(c), st.dictionaries(st.integers(1, c - 1), st.integers(1, 500), max_size=30))))
def test_plan_places_every_item_once(case):
    capacity, counts = case
    placed = Counter()
    for bins, content in plan_bins(counts, capacity):
        assert bins > 0 and sum(content) <= capacity
        for size in content:
            placed[size] += bins
    assert placed == Counter(counts)


def test_pack(spark):
    rng = random.Random(1)
    rows = [(i, 7 if i % 3 == 0 else rng.randrange(0, 260)) for i in range(600)] + [(600, None), (601, 100), (602, 1000)]
    df = spark.createDataFrame(rows, "id int, size int").withColumn("piece", F.lit("clash"))
    packed = pack(df.repartition(9), "id", F.col("size"), 100)
    got = packed.collect()
    assert {r.id for r in got} == {i for i, s in rows if s is not None}
    by_doc = Counter()
    for r in got:
        by_doc[r.id] += r.size
        assert r.pieces == max(1, math.ceil(dict(rows)[r.id] / 100))
    assert by_doc == Counter({i: s for i, s in rows if s is not None})
    room = Counter()
    for r in got:
        if r.bin is not None and r.bin >= 0:
            room[r.bin] += r.size
    assert max(room.values()) <= 100
    places = [(r.bin, r.place) for r in got if r.bin is not None and r.bin >= 0]
    assert len(places) == len(set(places))
    report = fill_report(packed, 100).first()
    assert report.tokens == sum(s for _, s in rows if s) and report.bins <= 1.03 * report.least_bins + 1
    assert sorted(map(tuple, pack(df, "id", F.col("size"), 100).collect()), key=str) == sorted(map(tuple, got), key=str)
    assert pack(df.limit(0), "id", F.col("size"), 100).count() == 0


def _mixing(spark):
    pool = [("m", "big", f"b{i}", 10 + i % 5) for i in range(900)] + [("m", "small", f"s{i}", 20) for i in range(10)]
    pool += [("m", "other", "o", 500), ("m", "big", "null", None)]
    targets = [("m", "big", 0.5, 1, 0.2), ("m", "small", 0.5, 3, 0.2), ("m", "absent", 0.1, 2, 0.2)]
    return (
        spark.createDataFrame(pool, "mix_id string, label string, rec_id string, size int").withColumn("budget", F.lit("clash")),
        spark.createDataFrame(targets, "mix_id string, label string, target_share double, max_repeats int, budget_ratio double"),
        pool,
    )


def test_mix(spark):
    pool, targets, rows = _mixing(spark)
    total = sum(s or 0 for *_, s in rows)
    served = mix(pool.repartition(7), targets).collect()
    used = Counter()
    for r in served:
        used[r.label] += r.size
        assert r.copy <= (3 if r.label == "small" else 1)
    assert sum(used.values()) <= 0.2 * total
    assert used["small"] == 600  # all repeats, although its share was larger
    assert sum(used.values()) > 0.2 * total - 40
    assert len({(r.rec_id, r.copy) for r in served}) == len(served)
    state = queue(pool, targets)[1]
    assert {r.label for r in unmet(*schedule(pool, targets)).collect()} == {"small", "absent"}
    report = {r.label: r for r in shares(mix(pool, targets), state).collect()}
    assert report["small"].most_copies == 3 and report["absent"].used_chars == 0


def test_mix_keeps_weights_at_any_moment(spark):
    pool = [("m", x, f"{x}{i}", 5) for x in "ab" for i in range(400)]
    targets = [("m", "a", 0.75, 1, 0.5), ("m", "b", 0.25, 1, 0.5)]
    served = mix(
        spark.createDataFrame(pool, "mix_id string, label string, rec_id string, size int"),
        spark.createDataFrame(targets, "mix_id string, label string, target_share double, max_repeats int, budget_ratio double"),
    )
    order = [r.label for r in served.orderBy("total").collect()]
    for at in range(40, len(order), 40):
        assert abs(order[:at].count("a") / at - 0.75) < 0.05


def test_the_order_does_not_depend_on_the_buckets(spark, monkeypatch):
    from quillsieve.llm import mixing, packing

    pool, targets, _ = _mixing(spark)
    docs = spark.createDataFrame([(i, 30 if i % 3 else 70) for i in range(500)], "id int, size int")
    rows = lambda df: sorted(map(str, df.collect()))
    mixed, packed = rows(mix(pool, targets)), rows(pack(docs, "id", F.col("size"), 100))
    for module in (mixing, packing):
        monkeypatch.setattr(module, "BUCKET_ROWS", 3)
    assert rows(mix(pool, targets)) == mixed and rows(pack(docs, "id", F.col("size"), 100)) == packed


def test_found_rows_come_through_the_operators(spark, monkeypatch):
    """The queries fail if the schedule and the plan are stubbed."""
    import pytest

    from quillsieve.llm import q_mixing, q_packing

    def stub(*_, **__):
        raise RuntimeError("stub")

    monkeypatch.setattr(q_mixing, "schedule", stub)
    monkeypatch.setattr(q_packing, "pack", stub)
    for query in (q_mixing.p2_found, q_packing.p7_found):
        with pytest.raises(RuntimeError, match="stub"):
            query(spark, "/root/testdata/sf0.001")


def test_mix_of_nothing(spark):
    pool, targets, _ = _mixing(spark)
    assert mix(pool.limit(0), targets).count() == 0
