"""Print ``explain("formatted")`` of catalog queries and a one-line summary
of each plan's shape (exchanges, sorts, window operators, partial top-n,
reused exchanges).  Usage: python tools/explain.py [sf_dir] [name-prefix ...]
(``--summary`` prints only the summaries)."""

import os
import re
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

from marketlens.plans.catalog import entries  # noqa: E402
from marketlens.session import build_session  # noqa: E402


def shape(plan: str) -> dict:
    return {
        "exchanges": len(re.findall(r"Exchange (hashpartitioning|rangepartitioning|SinglePartition)", plan)),
        "broadcasts": plan.count("BroadcastExchange"),
        "sorts": len(re.findall(r"\bSort \[", plan)),
        "windows": len(re.findall(r"\bWindow \[", plan)),
        "partial_top_n": len(re.findall(r"WindowGroupLimit .*Partial", plan)),
        "reused": plan.count("ReusedExchange"),
    }


def main() -> None:
    args = [a for a in sys.argv[1:] if not a.startswith("--")]
    sf = args[0] if args else "/root/testdata/sf0.01"
    names = args[1:]
    only_summary = "--summary" in sys.argv
    spark = build_session("local[4]")
    for n, e in entries().items():
        if names and not any(n.startswith(x) for x in names):
            continue
        df = e.fn(spark, sf)
        plan = df._jdf.queryExecution().executedPlan().toString()
        print(f"== {n}: {shape(plan)}")
        if not only_summary:
            df.explain("formatted")


if __name__ == "__main__":
    main()
