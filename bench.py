"""Headline queries on local[$BENCH_CPUS] over $BENCH_SF_DIR; prints one JSON line."""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from rimsight.plans import catalog  # noqa: E402
from rimsight.session import local_session  # noqa: E402

HEADLINE = [
    "a1_official_profile",
    "a4_pair_profile",
    "a4_pair_profile_by_season",
    "a8_pair_trend",
    "a9_pair_chemistry",
    "a10_pair_network",
    "m4_adjusted_residuals",
    "m7_icc",
    "m12_team_archetypes",
    "m17_weighted_variation",
    "m19_combined_versatility",
    "m24_mixture_gain",
    "a19_head_coach_production",
    "j6_mentor_overlap",
    "a27_conference_retention",
    "a33_promotion_rates",
    "j9_cascading_lookup",
    "g1_all_plays",
    "a15_outcome_pivot",
    "u7_snapshot_diff",
    "k3_keyed_upsert",
    "f40_standard_title",
    "l1_pronoun_class",
    "h3_table_rows",
    "h13_player_cards",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    spark = local_session(int(os.environ.get("BENCH_CPUS", "8")), "bench")
    # the first scan pays for the JVM, not for a query
    spark.read.parquet(f"{sf_dir}/nation.parquet").count()
    times = {}
    for name in HEADLINE:
        start = time.time()
        catalog.QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        times[name] = round(time.time() - start, 3)
        print(name, times[name], file=sys.stderr, flush=True)
    out = {
        "metric": "headline_total_seconds",
        "value": round(sum(times.values()), 3),
        "unit": "sec",
        "queries": times,
        "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
    }
    print(json.dumps(out))


if __name__ == "__main__":
    main()
