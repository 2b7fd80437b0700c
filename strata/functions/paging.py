"""Pages and counts of sorted names, for many probes at once.

Names with a common prefix are one run of the sorted names, so a probe needs only
how many names stand before the run and before its cursor.  Names and probes are
sorted together and counted in one pass (``ordered.running_sum``, safe for hot
groups); a page is then a range of ranks.  No probe meets all names of its group.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.functions.ordered import row_number_within, running_sum

# Fixed: ranks per block of the page join, and what follows every string with a prefix.
RANK_BLOCK = 1024
LAST_CHAR = "\U0010ffff"


def _counted(items: DataFrame, probes: DataFrame, group: Sequence[str], points: dict[str, tuple]) -> DataFrame:
    """Items (kind 1) and probe points with ``rank``, the number of items up to them.
    ``points``: name -> (column, whether items that equal it count too)."""
    rows = items.select(*group, F.col("key"), F.lit(1).alias("kind"), F.lit(None).cast("string").alias("point"),
                        F.lit(None).cast("long").alias("seq"), F.lit(1).alias("w"))
    for name, (key, equal) in points.items():
        rows = rows.unionByName(probes.select(*group, key.alias("key"), F.lit(2 if equal else 0).alias("kind"),
                                              F.lit(name).alias("point"), "seq", F.lit(0).alias("w")))
    return running_sum(rows, group, ["key", "kind", "point", "seq"], "w", "rank")


def pages(items: DataFrame, probes: DataFrame, group: Sequence[str]) -> DataFrame:
    """seq, key, position (from 1), has_more, next_after: for each probe (seq,
    ``group``, prefix, after, amount) the first ``amount`` of its group's ``key``s that
    begin with ``prefix`` and are greater than ``after``.  Keys are distinct in
    a group; a probe with an empty page has no row."""
    group = list(group)
    ranked = _counted(items, probes, group, {"prefix": (F.col("prefix"), False), "after": (F.col("after"), True)})
    ranks = ranked.where("kind = 1").select(*group, "rank", "key")
    lo = ranked.where("kind <> 1").groupBy("seq").agg(F.max("rank").alias("lo"))
    total = ranks.groupBy(*group).agg(F.max("rank").alias("_total"))
    blocks = ranks.withColumn("_block", F.floor(F.col("rank") / RANK_BLOCK).cast("long"))
    want = (probes.join(lo, "seq").join(total, group)
            .withColumn("_hi", F.least(F.col("lo") + F.col("amount").cast("long") + 1, F.col("_total")))
            .where(F.col("_hi") > F.col("lo")))
    page = (want.select("seq", *group, "prefix", "amount", "lo", "_hi",
                        F.explode(F.sequence(F.floor((F.col("lo") + 1) / RANK_BLOCK).cast("long"),
                                             F.floor(F.col("_hi") / RANK_BLOCK).cast("long"))).alias("_block"))
            .join(blocks, [*group, "_block"])
            .where((F.col("rank") > F.col("lo")) & (F.col("rank") <= F.col("_hi")) & F.col("key").startswith(F.col("prefix")))
            .withColumn("position", (F.col("rank") - F.col("lo")).cast("long")))
    summary = page.groupBy("seq").agg((F.max("position") > F.max("amount")).alias("has_more"),
                                      F.max(F.when(F.col("position") == F.col("amount"), F.col("key"))).alias("_last"))
    return (page.where(F.col("position") <= F.col("amount")).join(summary, "seq")
            .select("seq", "key", "position", "has_more", F.when(F.col("has_more"), F.col("_last")).alias("next_after")))


def overlaid_pages(items: DataFrame, probes: DataFrame, group: Sequence[str], own: Sequence[str],
                   hidden: DataFrame, more: DataFrame) -> DataFrame:
    """``pages`` where the probes of an ``own`` group see its base ``group``'s items
    without its ``hidden`` ones (``own``, ``group``, key: keys of items) and with
    ``more`` (``own``, key).

    The n-th item that is left is found by counting the hidden ones before it, so a
    probe costs its page and a base its items, whatever is hidden; a probe without a
    base (null) sees ``more`` only."""
    group, own = list(group), list(own)
    probes = probes.checkpoint(eager=True)
    both = [*own, *[c for c in group if c not in own]]
    ranked = _counted(items, probes, group, {"prefix": (F.col("prefix"), False), "after": (F.col("after"), True)})
    ranks = ranked.where("kind = 1").select(*group, "rank", "key")
    lo = ranked.where("kind <> 1").groupBy("seq").agg(F.max("rank").alias("lo"))
    gone = hidden.join(ranks, [*group, "key"]).select(*own, F.col("rank").alias("at"), F.lit(None).cast("long").alias("seq")).checkpoint(eager=True)

    def before(points: DataFrame, out: str) -> DataFrame:
        """Points (``own``, at, seq) with the number of hidden items up to them."""
        rows = gone_at.select(*own, "at", "seq", F.lit(0).alias("kind"), F.lit(1).alias("w")).unionByName(
            points.select(*own, "at", "seq", F.lit(1).alias("kind"), F.lit(0).alias("w")))
        return running_sum(rows, own, ["at", "kind", "seq"], "w", out)

    gone_at = gone
    counted = before(probes.join(lo, "seq").select(*own, F.col("lo").alias("at"), "seq"), "i")
    # places among the items that are left: after ``lo`` less the hidden ones up to there
    left = (items.groupBy(*group).agg(F.count(F.lit(1)).alias("_total")))
    lost = gone.groupBy(*own).agg(F.count(F.lit(1)).alias("_lost"))
    want = (probes.join(counted.where("kind = 1").select("seq", (F.col("at") - F.col("i")).alias("_lo")), "seq")
            .join(left, group).join(lost, own, "left")
            .withColumn("_hi", F.least(F.col("_lo") + F.col("amount").cast("long") + 1, F.col("_total") - F.coalesce("_lost", F.lit(0))))
            .where("_hi > _lo"))
    places = want.select(*both, "seq", F.explode(F.sequence(F.col("_lo") + 1, F.col("_hi"))).alias("at"))
    # a hidden item stands before the n-th one left if fewer than n of those left stand before it
    gone_at = counted.where("kind = 0").select(*own, (F.col("at") - F.col("i") + 1).alias("at"), "seq")
    ranks_of = before(places, "j").where("kind = 1").select("seq", *own, (F.col("at") + F.col("j")).alias("rank"))
    kept = (ranks_of.join(want.select("seq", "prefix", *[c for c in group if c not in own]), "seq")
            .join(ranks, [*group, "rank"]).where(F.col("key").startswith(F.col("prefix"))).select("seq", "key"))
    added = pages(more, probes.withColumn("amount", F.col("amount").cast("long") + 1), own).select("seq", "key")
    page = (row_number_within(kept.unionByName(added), ["seq"], ["key"], "position")
            .join(probes.select("seq", "amount"), "seq").where("position <= amount + 1"))
    summary = page.groupBy("seq").agg((F.max("position") > F.max("amount")).alias("has_more"),
                                      F.max(F.when(F.col("position") == F.col("amount"), F.col("key"))).alias("_last"))
    return (page.where("position <= amount").join(summary, "seq")
            .select("seq", "key", "position", "has_more", F.when(F.col("has_more"), F.col("_last")).alias("next_after")))


def prefix_counts(items: DataFrame, probes: DataFrame, group: Sequence[str], out: str) -> DataFrame:
    """seq and ``out``: how many of its group's ``key``s begin with each probe's
    ``prefix``.  Keys may repeat and are counted each."""
    counted = items.groupBy(*group, "key").agg(F.count(F.lit(1)).alias("_n"))
    rows = counted.select(*group, "key", F.lit(1).alias("kind"), F.lit(None).cast("long").alias("seq"), F.col("_n").alias("w"))
    for key, kind in ((F.col("prefix"), 0), (F.concat("prefix", F.lit(LAST_CHAR)), 2)):
        rows = rows.unionByName(probes.select(*group, key.alias("key"), F.lit(kind).alias("kind"), "seq", F.lit(0).cast("long").alias("w")))
    ranked = running_sum(rows, list(group), ["key", "kind", "seq"], "w", "rank")
    return (ranked.where("kind <> 1").groupBy("seq")
            .agg((F.max(F.when(F.col("kind") == 2, F.col("rank"))) - F.max(F.when(F.col("kind") == 0, F.col("rank")))).alias(out)))
