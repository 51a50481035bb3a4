"""Times the headline queries once each, in one warm session; prints one JSON line."""

from __future__ import annotations

import json
import os
import sys
import time

from virotide.plans.catalog import QUERIES
from virotide.session import build_session

HEADLINE = (
    "long_table_ivar", "codon_merge_consensus", "codon_merge_all_haplotypes", "variant_strand_filter",
    "variant_decode", "effects_one_per_row", "interval_merge", "mask_merged", "primer_collapse",
    "depth_windows", "depth_regions", "pileup_counts", "call_variants", "consensus_from_pileup",
    "consensus_apply_variants", "mark_duplicates", "trim_primers", "base_composition", "letter_runs",
    "assembly_stats", "mask_fasta", "reads_quality_trim", "kmer_counts", "metrics_short_read_variants",
    "coverage_heatmap", "hit_filter", "reconcile_barcodes", "gate_mapped_reads", "channel_match_all",
)


def run(spark, name: str, sf_dir: str) -> float:
    """Seconds for planning and a full run; rows go to the no-op sink, not to the driver."""
    start = time.perf_counter()
    QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session(
        "bench",
        f"local[{cpus}]",
        **{
            "spark.sql.shuffle.partitions": cpus,
            "spark.driver.memory": os.environ.get("BENCH_MEMORY", "16g"),
            "spark.ui.showConsoleProgress": "false",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    names = sys.argv[1:] or list(HEADLINE)
    run(spark, "gate_barcode_reads", sf_dir)  # JVM warm-up, not counted
    times = {}
    for name in names:
        times[name] = round(run(spark, name, sf_dir), 3)
        print(f"{name} {times[name]}", file=sys.stderr, flush=True)
    line = {
        "metric": "total wall time of the headline queries",
        "value": round(sum(times.values()), 3),
        "unit": "sec",
        "queries": times,
        "sf": os.path.basename(os.path.normpath(sf_dir)).removeprefix("sf"),
    }
    print(json.dumps(line))
    spark.stop()


if __name__ == "__main__":
    main()
