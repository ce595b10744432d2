"""Mixing sources to target weights: weighted fair queueing.

Each document of a source, in hashed order, gets a virtual finish time: the tokens of its source up to and including it,
divided by the source's weight.  Serving documents by virtual finish time gives every source its weight at any moment;
a source that runs dry starts over, at most ``max_repeats`` times in all.  The mix is that order cut at the budget.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillsieve.operators.ranks import running_sum
from quillsieve.session import cut_lineage

#: Documents of one bucket of a source's order, and of one slice of the merged order, about; and the fewest of either.
BUCKET_ROWS, LEAST_BUCKETS = 200_000, 64
SEED = 42


def _buckets(rows: int) -> int:
    """A power of two: as many ranges as keep each at about ``BUCKET_ROWS``; the order doesn't depend on it."""
    return 1 << max(LEAST_BUCKETS - 1, rows // BUCKET_ROWS).bit_length()


def _horizon(labels: list[dict], budget: float) -> float:
    """The virtual time at which the served total reaches the budget: sources serve at their weight until exhausted."""
    ends = sorted({label["available"] / label["weight"] for label in labels})
    served = lambda now: sum(min(label["weight"] * now, label["available"]) for label in labels)
    start = 0.0
    for end in ends:
        if served(end) >= budget:
            rate = sum(label["weight"] for label in labels if label["available"] / label["weight"] > start)
            return start + (budget - served(start)) / rate
        start = end
    return start


def queue(pool: DataFrame, targets: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Virtual finish times and the state of each source.

    ``pool``: ``(mix_id, label, rec_id, size)``, a record once in each mix.  ``targets``: ``(mix_id, label,
    target_share, max_repeats, budget_ratio)``; labels without a target count in the pool's total but aren't mixed, null
    sizes are 0, other columns are ignored.  Returns the documents with ``finished``, the running total of their source in hashed order, and one
    row per target: ``chars`` and ``available`` of its source, ``pool_chars``, ``budget`` and ``demanded``.  Targets
    without documents have 0 characters.
    """
    sized = pool.select("mix_id", "label", "rec_id", F.coalesce(F.col("size").cast("bigint"), F.lit(0)).alias("size"))
    targets = targets.select("mix_id", "label", "target_share", "max_repeats", "budget_ratio")
    totals = sized.groupBy("mix_id").agg(F.sum("size").alias("pool_chars"))
    mixed = sized.join(F.broadcast(targets.select("mix_id", "label")), ["mix_id", "label"], "left_semi")
    mixed = mixed.withColumn("_hash", F.xxhash64(F.lit(SEED), "mix_id", "label", "rec_id"))
    # buckets are ranges of the hash
    mixed = mixed.withColumn("_bucket", F.shiftrightunsigned("_hash", 65 - _buckets(pool.count()).bit_length()))
    documents = running_sum(mixed, ["mix_id", "label"], "_bucket", ["_hash", "rec_id"], F.col("size"), "finished")
    documents = cut_lineage(documents.drop("_bucket"))  # read again for the state of the sources, the mix and its order
    whole = documents.groupBy("mix_id", "label").agg(F.max("finished").alias("chars"), F.count("*").alias("records"))
    state = targets.join(whole, ["mix_id", "label"], "left").join(totals, "mix_id", "left")
    state = state.na.fill(0, ["chars", "records", "pool_chars"])
    state = state.withColumn("available", F.col("max_repeats") * F.col("chars"))
    state = state.withColumn("budget", F.col("budget_ratio") * F.col("pool_chars"))
    return documents, state.withColumn("demanded", F.col("target_share") * F.col("budget_ratio") * F.col("pool_chars"))


def unmet(mixed: DataFrame, state: DataFrame) -> DataFrame:
    """Targets that the schedule can't meet: all repeats of a source are served and it is still below its share of the budget.

    Sources without documents are exhausted from the start.
    """
    served = mixed.groupBy("mix_id", "label").agg(F.sum("size").alias("served"))
    ends = state.join(served, ["mix_id", "label"], "left").na.fill(0, ["served"])
    return ends.filter((F.col("served") >= F.col("available")) & (F.col("served") < F.col("demanded"))).select("mix_id", "label")


def mix(pool: DataFrame, targets: DataFrame) -> DataFrame:
    """The mix alone; see ``schedule``."""
    return schedule(pool, targets)[0]


def schedule(pool: DataFrame, targets: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The mix and the state of each source.  The mix has rows ``(mix_id, label, rec_id, copy, size, virtual_finish, total)`` in the mix; ``total`` runs to the budget.

    Ties in virtual finish time are broken by label, record and copy.  Records of size 0 come at most once.  The table
    of sources is collected to the driver to find the horizon; it has one row per target.
    """
    documents, state = queue(pool, targets)
    rows = [r.asDict() for r in state.collect()]  # one row per target
    state = documents.sparkSession.createDataFrame(rows, state.schema)
    plan = []
    for mix_id in sorted({r["mix_id"] for r in rows}):
        own = [r for r in rows if r["mix_id"] == mix_id and r["available"] > 0 and r["target_share"] > 0]
        for r in own:
            r["weight"] = r["target_share"]
        end = _horizon(own, own[0]["budget"]) if own else 0.0
        plan += [(mix_id, r["label"], float(r["weight"]), int(r["chars"]), int(r["max_repeats"]), float(r["budget"]), end) for r in own]
    schema = "mix_id string, label string, weight double, chars bigint, repeats int, budget double, horizon double"
    known = F.broadcast(documents.sparkSession.createDataFrame(plan, schema))
    queued = documents.join(known, ["mix_id", "label"])
    rounds = F.least(F.col("repeats"), F.ceil(F.col("horizon") * F.col("weight") / F.col("chars")).cast("int") + 1)
    rounds = F.when(F.col("size") == 0, F.lit(1)).otherwise(F.greatest(rounds, F.lit(1)))
    queued = queued.withColumn("copy", F.explode(F.sequence(F.lit(1), rounds)))
    finish = ((F.col("copy") - 1) * F.col("chars") + F.col("finished")) / F.col("weight")
    queued = queued.withColumn("virtual_finish", finish)
    # of each source at most one document is being served at the horizon; whatever starts later can't be in the mix
    queued = queued.filter(F.col("virtual_finish") - F.col("size") / F.col("weight") <= F.col("horizon"))
    slices = F.floor(F.col("virtual_finish") / F.col("horizon") * _buckets(sum(r["records"] for r in rows)))
    queued = queued.withColumn("_slice", F.coalesce(slices, F.lit(0)))
    order = ["virtual_finish", "label", "rec_id", "copy"]
    served = running_sum(queued, ["mix_id"], "_slice", order, F.col("size"), "total")
    served = served.filter(F.col("total") <= F.col("budget"))
    return served.select("mix_id", "label", "rec_id", "copy", "size", "virtual_finish", "total"), state


def shares(mixed: DataFrame, state: DataFrame) -> DataFrame:
    """For each target the share reached, beside the share asked for, and how often its records were used."""
    used = mixed.groupBy("mix_id", "label").agg(F.sum("size").alias("used"), F.max("copy").alias("most_copies"))
    whole = used.groupBy("mix_id").agg(F.sum("used").alias("_mixed"))
    out = state.join(used, ["mix_id", "label"], "left").join(whole, "mix_id", "left").na.fill(0, ["used", "most_copies"])
    return out.select(
        "mix_id",
        "label",
        "target_share",
        "records",
        "chars",
        F.col("used").alias("used_chars"),
        "most_copies",
        F.round(F.col("used") / F.col("_mixed"), 6).alias("reached_share"),
        (F.col("available") >= F.col("demanded")).alias("can_be_met"),
    )
