"""strata: version-control operators over Spark tables.

Branches, commits, object listings, staged changes and pull requests are
ordinary DataFrames; every operator takes a DataFrame of requests plus the
state DataFrames and returns a DataFrame of outcomes (and state deltas).
"""

__version__ = "0.1.0"
