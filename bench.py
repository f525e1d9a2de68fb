"""Time the headline queries and print one JSON line.

Inputs that stand for files (the vocabulary; encoded documents for the operators that start from them) are made
before the clock starts; the corpus build and the encoders are timed from raw documents.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from corpusloom.catalog import QUERIES, inputs  # noqa: E402
from corpusloom.session import local_session  # noqa: E402

HEADLINE = (
    "wordpiece_encode",
    "pack_sequences",
    "repack_sequences",
    "mlm_mask",
    "pretrain_corpus",
    "pretrain_corpus_sorted",
    "lines_to_documents",
    "val_split",
    "pad_batches",
    "qa_span_labels",
    "qa_best_span",
    "running_progress",
    "plateau_switch",
)


def run(spark, name: str, sf_dir: str) -> tuple[float, int]:
    started = time.perf_counter()
    df = QUERIES[name].run(spark, sf_dir)
    df.write.format("noop").mode("overwrite").save()
    return time.perf_counter() - started, df.count() if os.environ.get("BENCH_ROWS") else 0


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    spark = local_session(os.environ.get("BENCH_CPUS", "8"))
    spark.sparkContext.setLogLevel("ERROR")
    started = time.perf_counter()
    inputs.tokenizer(spark, sf_dir)
    inputs.encoded(spark, sf_dir)
    inputs.packed(spark, sf_dir, 128)
    prepared = time.perf_counter() - started
    seconds = {name: round(run(spark, name, sf_dir)[0], 3) for name in HEADLINE}
    tokens = inputs.encoded(spark, sf_dir).selectExpr("sum(size(input_ids))").first()[0]
    print(
        json.dumps(
            {
                "metric": "headline_total",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(os.path.normpath(sf_dir)).removeprefix("sf"),
                "prepare_sec": round(prepared, 3),
                "tokens": tokens,
                "tokens_per_sec": {n: round(tokens / seconds[n]) for n in ("wordpiece_encode", "pack_sequences", "mlm_mask", "pretrain_corpus")},
            }
        )
    )


if __name__ == "__main__":
    main()
