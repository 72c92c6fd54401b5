"""Bench: run the headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS]; print one JSON line.

Each query is executed in full through the ``noop`` sink (nothing is collected
to the driver); the time is wall-clock seconds per query.
"""

from __future__ import annotations

import json
import os
import re
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINE = [
    "build_corpus",
    "stream_corpus",
    "ocr_fallback",
    "markdown_tables",
    "page_text",
    "split_columns",
    "detect_columns",
    "annotation_layout",
    "find_cells",
    "extract_tables",
    "number_regions",
    "find_text_regions",
    "listing_order",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    keys = sys.argv[1:] or HEADLINE

    from folio.plans.catalog import REGISTRY
    from folio.session import local_session

    spark = local_session(cpus, app="folio-bench", extra={"spark.checkpoint.dir": os.environ.get("FOLIO_CHECKPOINT_DIR") or tempfile.mkdtemp(prefix="folio-bench-")})
    # warm the JVM and the session (not timed), so the first query is not charged for start-up
    spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id").write.format("noop").mode("overwrite").save()
    times: dict[str, float] = {}
    rows_per_sec = None
    for k in keys:
        t0 = time.time()
        REGISTRY[k].build(spark, sf_dir).write.format("noop").mode("overwrite").save()
        times[k] = round(time.time() - t0, 3)
    if "build_corpus" in times:
        n_pages = spark.read.parquet(f"{sf_dir}/documents.parquet").selectExpr("sum(cast(ceil(length(text) / 1800) as bigint))").first()[0]
        rows_per_sec = round(n_pages / times["build_corpus"], 1)
    m = re.search(r"sf([0-9.]+)", sf_dir)
    print(
        json.dumps(
            {
                "metric": "headline_total",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "sf": float(m.group(1)) if m else sf_dir,
                "build_corpus_pages_per_sec": rows_per_sec,
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
