"""Operator 2, mixing sources to target weights: Sainte-Laguë apportionment of
equal-token blocks.  Built-in functions only.

1. A document's size is its number of words.  Each source gets a target
   (``source_targets``) or the caller's.
2. The house of ``target / block_words`` blocks (of fewer words, where the smallest
   target is not ``LEAST_BLOCKS`` of them) is shared out to the sources by
   highest quotients ``target / (2k - 1)``, and each source's seats to its
   shards (parts of about ``shard_words`` words, dealt by a seeded hash) in the
   same way, so each shard has an integer quota (``apportion``).
3. A shard's documents lie in seeded order on a ring of words that is cut into
   blocks from its start; the first ``quota`` blocks are taken, round the ring
   again where the quota exceeds it.  As the order is seeded, these blocks are
   a random choice.  A document's share is the overlap of its range of words
   with the taken ones, so no block is ever made as a row.

Only (id, source, size) moves, never a text.  A hot source has many shards; no
window spans more than one shard, but for those over the (shard) votes, which
use range-partitioned running sums.

Results for odd input: null text has size 0; sources are ordered by code point,
null last; a null id is hashed as an empty string; repeated rows count as
documents of their own; a table without words, or an empty one, gives targets
and ``taken`` of 0.  Extra columns are left alone.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strata.functions.ordered import running_sum
from strata.llm.common import KEY, WORD, row_key, stored, with_key

BLOCK_WORDS = 16
SHARD_WORDS = 1 << 16
LEAST_BLOCKS = 8  # blocks of the smallest target, unless a block is one word


def seeded(id_col: str, seed: int) -> Column:
    """The seeded order of documents: 32 hexadecimal digits."""
    return F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(id_col).cast("string"), F.lit(""))))


def with_row(df: DataFrame, row: DataFrame) -> DataFrame:
    """Every row of ``df`` with the columns of the one-row aggregate ``row``."""
    return (df.withColumn("_one", F.lit(1)).join(F.broadcast(row.withColumn("_one", F.lit(1))), "_one")
            .drop("_one"))


def source_targets(sizes: DataFrame, weights: tuple[int, ...] = (5, 2, 1),
                   share: float = 1.5, most: float = 2.0) -> DataFrame:
    """source, source_size, target: the sources' shares of ``share`` times all
    words by weights that repeat in the order of the sources, none above
    ``most`` times its size; the excess goes to the others by weight.

    With sources ordered by ``size / weight``, the first ones reach their
    limit, and all others get the same level per weight."""
    per = (sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
           .withColumn("_null", F.col("source").isNull().cast("int")))
    per = running_sum(per, [], ["_null", "source"], F.lit(1), "_at")
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]),
                          ((F.col("_at") - 1) % len(weights)).cast("int") + 1)
    per = (per.withColumn("weight", weight)
           .withColumn("_limit", F.col("source_size") * F.lit(most)))
    per = per.withColumn("_ratio", F.col("_limit") / F.col("weight"))
    # running sums of whole numbers, so they are exact
    before = running_sum(per, [], ["_ratio", "_at"], "source_size", "_before", inclusive=False)
    before = running_sum(before, [], ["_ratio", "_at"], F.col("weight").cast("long"), "_weights", inclusive=False)
    totals = per.agg(F.sum("source_size").alias("_all"), F.sum("weight").alias("_w"))
    level = ((F.col("_all") * F.lit(share) - F.col("_before") * F.lit(most)) / (F.col("_w") - F.col("_weights")))
    before = with_row(before, totals).withColumn("_level", level)
    # a single row: the level of the first source that does not reach its limit
    found = before.filter("_level <= _ratio").agg(F.min_by("_level", F.struct("_ratio", "_at")).alias("_found"))
    return (with_row(per, found)
            .select("source", "source_size",
                    F.least("_limit", F.coalesce(F.col("weight") * F.col("_found"), F.col("_limit"))).alias("target")))


def apportion(votes: DataFrame, keys: list[str], order: list[str], out: str = "seats") -> DataFrame:
    """Sainte-Laguë: shares ``house`` seats (a column, equal within ``keys``)
    out by the highest quotients ``votes / (2k - 1)``; ties go to the smaller
    ``order``.

    With S parties, the divisor at which the house is full lies between
    V / (house + S/2) and V / (house - S/2).  All seats above the quotient of
    the larger divisor are safe; only the few between the two (at most about
    4 S in all) are made as rows and ranked."""
    by = [F.col(k) for k in keys]
    totals = votes.groupBy(*by).agg(F.sum("votes").alias("_v"), F.count("*").alias("_s"), F.max("house").alias("_house"))
    v = votes.join(totals, keys) if keys else with_row(votes, totals)
    low = F.col("_house") - F.col("_s") / 2
    high = F.col("_house") + F.col("_s") / 2
    safe = F.when((low > 0) & (F.col("_v") > 0), F.greatest(F.lit(0), F.floor(F.col("votes") * low / F.col("_v") + 0.5) - 2))
    upto = F.when(F.col("_v") > 0, F.floor(F.col("votes") * high / F.col("_v") + 0.5) + 2)
    v = stored(v.withColumn("_safe", F.coalesce(safe, F.lit(0)).cast("long"))
               .withColumn("_upto", F.when(F.col("votes") > 0, F.coalesce(upto, F.lit(0))).otherwise(0).cast("long")), "votes")
    left = v.groupBy(*by).agg((F.max("_house") - F.sum("_safe")).alias("_left"))
    open_seats = (v.filter("_upto > _safe")
                  .select(*keys, *order, "votes", "_safe", F.explode(F.sequence(F.col("_safe") + 1, F.col("_upto"))).alias("_k"))
                  .withColumn("_q", -(F.col("votes") / (2 * F.col("_k") - 1))))
    ranked = running_sum(open_seats, keys, ["_q", *order, "_k"], F.lit(1), "_rank")
    ranked = ranked.join(left, keys) if keys else with_row(ranked, left)
    won = ranked.filter("_rank <= _left").groupBy(*by, *[F.col(c) for c in order if c not in keys]).agg(F.count("*").alias("_won"))
    on = [*keys, *[c for c in order if c not in keys]]
    return (v.join(won, on, "left").withColumn(out, F.col("_safe") + F.coalesce("_won", F.lit(0)))
            .drop("_v", "_s", "_house", "_safe", "_upto", "_won"))


def mix(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
        targets=source_targets, block_words: int = BLOCK_WORDS, shard_words: int = SHARD_WORDS,
        seed: int = 7) -> DataFrame:
    """One row per document: doc_id, source, size, source_size, target, taken
    (and ``KEY``, the hash of id and text)."""
    sizes = stored(docs.select(
        F.col(id_col).alias("doc_id"), F.col(source_col).alias("source"),
        F.coalesce(F.regexp_count(F.col(text_col), F.lit(WORD)), F.lit(0)).cast("long").alias("size"),
        row_key(id_col, text_col).alias(KEY)), "mix-sizes")
    per = targets(sizes)
    # null sources join as a number: the sources' order
    per = running_sum(per.withColumn("_null", F.col("source").isNull().cast("int")),
                      [], ["_null", "source"], F.lit(1), "_source")
    per = per.withColumn("_shards", F.greatest(F.lit(1), F.ceil(F.col("source_size") / shard_words)).cast("long"))
    # blocks are smaller where the smallest target would be few of them
    fine = F.floor(F.min(F.when(F.col("target") > 0, F.col("target"))) / LEAST_BLOCKS)
    block = F.greatest(F.lit(1), F.least(F.lit(block_words), F.coalesce(fine, F.lit(1)))).cast("long")
    house = per.agg(block.alias("_block"), F.floor(F.sum("target") / block).cast("long").alias("house"))
    seats = apportion(with_row(per.withColumn("votes", F.col("target").cast("double")), house), [], ["_source"])
    per = stored(seats.select("source", "_source", "source_size", "target", "_shards", "seats", "_block"), "mix-sources")
    spot = seeded("doc_id", seed)
    rows = (sizes.join(per, sizes["source"].eqNullSafe(per["source"])).drop(per["source"])
            .withColumn("_spot", spot)
            .withColumn("_shard", F.pmod(F.conv(F.substring("_spot", 1, 8), 16, 10).cast("long"), F.col("_shards"))))
    shards = (rows.groupBy("_source", "_shard").agg(F.sum("size").alias("_ring"), F.max("seats").alias("house"), F.max("_block").alias("_block"))
              .withColumn("votes", F.col("_ring").cast("double")))
    quotas = (apportion(shards, ["_source"], ["_shard"], "_quota")
              .withColumn("_blocks", F.least("_quota", F.floor(F.col("_ring") * 2 / F.col("_block"))) * F.col("_block"))
              .select("_source", "_shard", "_ring", "_blocks"))
    frame = (Window.partitionBy("_source", "_shard").orderBy("_spot", "doc_id", "size")
             .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    # texts without words take nothing, and however many there are they sort nowhere
    empty = rows.filter("size = 0").select("doc_id", "source", "size", "source_size", "target", F.lit(0).cast("long").alias("taken"), KEY)
    rows = (rows.filter("size > 0").withColumn("_end", F.sum("size").over(frame))
            .join(quotas, ["_source", "_shard"]))
    rounds = F.when(F.col("_ring") > 0, F.floor(F.col("_blocks") / F.col("_ring"))).otherwise(0)
    rest = F.col("_blocks") - rounds * F.col("_ring")
    part = F.greatest(F.lit(0), F.least("_end", rest) - (F.col("_end") - F.col("size")))
    return rows.select("doc_id", "source", "size", "source_size", "target",
                       (rounds * F.col("size") + part).cast("long").alias("taken"), KEY).unionByName(empty)


def mixed_rows(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", **options) -> DataFrame:
    """The rows of ``docs`` as the mix takes them: each as many times as its
    taken words make up its size, rounded (0, 1 or 2 times; rows equal in id
    and text share their mean)."""
    taken = (mix(docs, id_col, text_col, source_col, **options).filter("size > 0")
             .groupBy(KEY).agg((F.floor(F.sum("taken") / F.sum("size") + 0.5)).cast("int").alias(KEY + "_times"))
             .filter(F.col(KEY + "_times") > 0))
    rows = with_key(docs, id_col, text_col).join(taken, KEY)
    return rows.withColumn(KEY + "_copy", F.explode(F.sequence(F.lit(1), F.col(KEY + "_times")))).select(*docs.columns)
