"""Time the headline queries: one JSON line on standard output.

BENCH_SF_DIR names the folder of tables, BENCH_CPUS the number of cores,
BENCH_RUNS how often each query runs (the median counts), BENCH_QUERIES a
comma-separated choice of queries.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import tempfile
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from tokenloom.plans import QUERIES
from tokenloom.session import build_session

HEADLINE = [
    "supervised_tokens",
    "document_tokens",
    "document_ids",
    "padded_batches",
    "packed_tokens",
    "counted_vocabulary",
    "next_token_model",
    "batch_perplexity",
    "greedy_continuation",
    "embedded_tokens",
    "label_mask",
    "row_positions",
    "convolved_and_pooled",
    "gated_sequences",
    "causal_attention",
    "whole_group_attention",
    "wide_convolution",
    "standardized_columns",
    "quantized_vectors",
    "perceptron_scores",
    "first_write_cache",
    "streamed_turns",
]


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    chosen = os.environ.get("BENCH_QUERIES")
    conf = {
        "spark.sql.shuffle.partitions": cpus if cpus.isdigit() else "8",
        "spark.driver.memory": "16g",
        "spark.driver.host": "127.0.0.1",
        "spark.driver.bindAddress": "127.0.0.1",
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
    }
    if "spark.checkpoint.dir" not in os.environ.get("PYSPARK_SUBMIT_ARGS", ""):
        conf["spark.checkpoint.dir"] = tempfile.mkdtemp(prefix="tokenloom-bench-")
    spark = build_session("bench", f"local[{cpus}]", **conf)
    spark.sparkContext.setLogLevel("ERROR")
    for name in ("corpus_read", "custom_tokenizer"):  # starting the JVM and the Python workers is not counted
        QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
    seconds = {}
    for name in chosen.split(",") if chosen else HEADLINE:
        taken = []
        for _ in range(runs):
            start = time.perf_counter()
            QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
            taken.append(time.perf_counter() - start)
        seconds[name] = round(statistics.median(taken), 3)
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "headline_seconds",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": Path(folder).name.removeprefix("sf"),
            }
        )
    )


if __name__ == "__main__":
    main()
