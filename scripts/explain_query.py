"""Print the formatted physical plan of a registered query after running it
(so AQE's final plan is shown).  Usage: python scripts/explain_query.py <query> [sf_dir]"""

from __future__ import annotations

import os
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from strata.plans.queries import QUERIES  # noqa: E402
from strata.session import build_session  # noqa: E402


def main() -> None:
    name = sys.argv[1]
    sf = sys.argv[2] if len(sys.argv) > 2 else "/root/testdata/sf0.01"
    spark = build_session()
    df = QUERIES[name](spark, sf)
    df.write.format("noop").mode("overwrite").save()
    df.explain("formatted")


if __name__ == "__main__":
    main()
