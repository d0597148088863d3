"""Write PLANS.md: the final adaptive plans of headline queries.

    python tests/write_plans.py [sf_dir]
"""

from __future__ import annotations

import os
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

NOTES = {
    "toll_notifications_keyed": "T1. The lines are parsed once into a staged table; reports, per-vehicle aggregate, hot-vehicle "
    "threshold (a row count) and segment statistics read only their columns of it. The per-vehicle join is split: vehicles above "
    "the threshold are broadcast (fewer than twice the partitions), the others are joined on (vid, salt). `toll <> 0` is pushed "
    "into the history side.",
    "toll_notifications_global": "T2. As T1; the history of all segments has one row a minute and is broadcast.",
    "toll_notifications_arrival": "T1 in arrival order: the last step of the parallel scan. Reports and states meet by chunk of the "
    "arrival order (`FlatMapCoGroupsInPandas`); the windows run over sums per chunk, key and minute.",
    "segment_minute_stats": "A1. Two-level aggregate, both levels combined before their shuffle.",
    "vehicle_new_segment": "V1 over the staged reports.",
    "replay_prefix": "T5. A scalar subquery (one partial row a task) and a filter on the scan.",
}


def final_plan(df) -> str:
    df.write.format("noop").mode("overwrite").save()
    df.collect()
    lines = df._jdf.queryExecution().executedPlan().toString().splitlines()
    out, skip = [], None
    for line in lines:
        depth = len(line) - len(line.lstrip(" :+-"))
        if skip is not None and depth > skip:
            continue
        skip = None
        if "== Initial Plan ==" in line:
            skip = depth
            continue
        out.append(line if len(line) <= 240 else line[:237] + "...")
    return "\n".join(out)


def main() -> None:
    from tollstream.plans.catalog import QUERIES
    from tollstream.session import build_session, drop_scratch

    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    spark = build_session()
    parts = ["# PLANS\n", f"Final adaptive plans of headline queries ({os.path.basename(sf_dir)}, local[8], AQE on), written by "
             "`tests/write_plans.py`.\n"]
    for name, note in NOTES.items():
        parts.append(f"## {name}\n\n{note}\n\n```\n{final_plan(QUERIES[name](spark, sf_dir))}\n```\n")
    with open(os.path.join(ROOT, "PLANS.md"), "w") as f:
        f.write("\n".join(parts))
    drop_scratch(spark)
    spark.stop()


if __name__ == "__main__":
    main()
