"""Headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS]; prints one JSON line.

Every query runs to the end into a sink that keeps nothing; the time is the median of
$BENCH_RUNS runs (1 by default) after one warm-up query.  $BENCH_SPREAD=0 leaves small tables
in the tasks they are read in, as large input must be.
"""

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from promptmill.plans.catalog import QUERIES  # noqa: E402
from promptmill.plans.kit import table  # noqa: E402
from promptmill.plans.registry import prepare_and_pack  # noqa: E402
from promptmill.session import SPREAD, local_session, spread  # noqa: E402

HEADLINES = ["p02_instruction_styles", "p24_chat_templates", "p28_preference_flat", "t01_tokenize", "t02_prompt_mask",
             "t05_turn_mask", "t08_completion_chunks", "t21_label_weights", "f01_length_band", "f09_request_validation",
             "f11_drop_report", "d01_exact_dedup", "d02_cross_split", "r01_seeded_shuffle", "r03_ordered_split",
             "r13_dictionary", "k01_concat_pad", "k02_constant_length", "k03_multipack", "k05_packed_rows", "k06_pad_batch", "k08_unpack",
             "k09_budget_batches", "u01_strategy_registry", "s08_prepared_cache", "t18_query_encode", "a18_prediction_table", "j06_snapshot_compare",
             "a02_token_totals", "a07_test_case_score", "a11_perplexity", "a12_latency_table", "a15_load_run", "w01_consecutive_violations"]


def finish(df) -> None:
    df.write.format("noop").mode("overwrite").save()


def main() -> None:
    sf = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "1"))
    chosen = sys.argv[1:] or ["prepare_and_pack", *HEADLINES]
    deal = os.environ.get("BENCH_SPREAD", cpus)
    spark = local_session(cpus, "bench", **({SPREAD: deal} if deal != "0" else {}))
    finish(table(spark, sf, "documents").limit(10))
    finish(table(spark, sf, "documents").groupBy("lang").count())

    def flagship(spark, sf):
        return prepare_and_pack(spread(table(spark, sf, "documents")))

    known = {"prepare_and_pack": flagship, **QUERIES}
    times = {}
    for name in chosen:
        took = []
        for _ in range(runs):
            start = time.perf_counter()
            finish(known[name](spark, sf))
            took.append(time.perf_counter() - start)
        times[name] = round(statistics.median(took), 3)
        print(name, times[name], file=sys.stderr, flush=True)
    print(json.dumps({"metric": "headline queries, total", "value": round(sum(times.values()), 3), "unit": "sec",
                      "queries": times, "sf": os.path.basename(sf.rstrip("/")).removeprefix("sf")}))


if __name__ == "__main__":
    main()
