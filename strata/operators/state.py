"""State deltas: what a batch changes, and the state after it.

A delta is a dictionary of tables.  ``commits``, ``parents``, ``entries``,
``listings``, ``contents`` and ``staged`` hold rows to add; ``refs`` and
``pull_requests`` hold rows that replace those of the same key, or, where their
column ``deleted`` is true, remove it (tombstones).  ``dropped`` names branches whose
staging goes; ``staging``, if there, is all staging that is left.  ``apply_deltas`` makes the next state, which
the next batch reads, so a commit finds the listing, the parents and the
statistics that an earlier one made.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.functions import hashing as H
from strata.operators.listing import listing_identity, listing_stats

KEYS = {"commits": ["repository", "commit_id"], "parents": ["repository", "commit_id", "pos"],
        "entries": ["repository", "meta_range_id", "path"], "listings": ["repository", "meta_range_id"],
        "refs": ["repository", "branch"], "pull_requests": ["repository", "id"], "contents": ["checksum"]}
REPLACED = ("refs", "pull_requests")


def naive_time(seconds: Column) -> Column:
    return F.timestamp_add("SECOND", seconds, F.lit("1970-01-01 00:00:00").cast("timestamp_ntz"))


def commit_delta(done: DataFrame, branch: str, parents: Column, entries: DataFrame) -> dict[str, DataFrame]:
    """Deltas of new commits: ``done`` has their columns (with ``metadata`` and
    ``hidden``, the branch's flag), ``parents`` is the array of parent ids, ``entries``
    the rows of listings that are not stored yet.  A new listing's row is made
    from its entries; one without entries has a row of zeros."""
    commits = done.select(
        "repository", "commit_id", "committer", "message", "meta_range_id", "metadata",
        naive_time(F.col("creation_seconds")).alias("creation_date"), F.lit(1).alias("version"), "generation",
        parents.alias("parents"))
    edges = commits.select("repository", "commit_id", F.posexplode("parents").alias("pos", "parent_id"))
    refs = done.select("repository", F.col(branch).alias("branch"), "commit_id", "hidden")
    key = KEYS["listings"]
    zero = F.lit(0).cast(H.DEC)
    stats = (done.select(*key).distinct().join(listing_stats(entries), key, "left")
             .withColumns({c: F.coalesce(F.col(c), F.lit(0).cast("long")) for c in ("n_entries", "total_bytes")})
             .withColumns({c: F.coalesce(F.col(c), zero) for c in ("lane0", "lane1")}))
    # a row whose identity is not the announced one belongs to a listing that was stored before
    listings = listing_identity(stats).where(F.col("listing_id") == F.col("meta_range_id"))
    return {"commits": commits, "parents": edges, "refs": refs, "entries": entries, "listings": listings}


def apply_deltas(state: dict[str, DataFrame], *deltas: dict[str, DataFrame]) -> dict[str, DataFrame]:
    """The state after the deltas.  Applying the same delta twice changes
    nothing; columns that a delta lacks are null."""
    from strata.operators.refs import staging_after_delete
    out = dict(state)
    for delta in deltas:
        if "dropped" in delta and "staging" in out:  # before rows that the delta stages
            out["staging"] = staging_after_delete(out["staging"], delta["dropped"])
        for name, rows in delta.items():
            if name == "dropped":
                continue
            if name == "staging":
                out[name] = rows
            elif name == "staged":
                out["staging"] = out["staging"].unionByName(rows, allowMissingColumns=True)
            else:
                old, key = out[name], KEYS[name]
                new = rows.select(*[c for c in rows.columns if c in old.columns])
                if name in REPLACED:
                    live = new if "deleted" not in rows.columns else (
                        rows.where(~F.coalesce("deleted", F.lit(False))).select(*new.columns))
                    out[name] = old.join(new.select(*key), key, "left_anti").unionByName(live, allowMissingColumns=True)
                else:
                    add = new.dropDuplicates(key).join(old.select(*key), key, "left_anti")
                    out[name] = old.unionByName(add, allowMissingColumns=True)
    return out
