"""Time the headline queries at ``$BENCH_SF_DIR`` on ``local[$BENCH_CPUS]``; prints one JSON line."""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from turnwarden.queries import QUERIES  # noqa: E402
from turnwarden.session import local_session  # noqa: E402
from turnwarden.sources.turns import PARALLELISM  # noqa: E402

HEADLINE = [
    "pii_redact", "pii_counts_by_lang", "pii_mask_documents", "secrets_screen_documents", "secrets_redact_documents",
    "gibberish_screen", "profanity_mask", "brand_scrub_documents", "url_screen_pages", "url_redact_pages",
    "indirect_scan_pages", "dangerous_code_filter_documents", "invisible_text_block", "keyword_hits",
    "token_budget_by_source", "rate_limit", "tool_call_cap", "screen_tools", "approval_reconcile", "schema_validate",
    "kb_match_documents", "article_lookup", "history_context", "conversation_pairs", "language_scores",
    "grounding_check", "relevance_labels", "toxicity_eval", "screen_input", "screen_output", "rule_overlap",
    "firing_counts", "verdict_share", "recent_turns", "screen_stream", "rate_limit_stream", "firing_counts_stream",
]


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    chosen = sys.argv[1:] or HEADLINE
    spark = local_session(os.environ.get("BENCH_CPUS"))
    spark.sparkContext.setLogLevel("ERROR")
    spark.read.parquet(f"{folder}/documents.parquet").selectExpr("sum(length(text))").collect()  # start the executor
    # The tables have one row group each, which one task would read whatever the number of cores.
    spark.conf.set(PARALLELISM, spark.sparkContext.defaultParallelism)
    times = {}
    for name in chosen:
        started = time.perf_counter()
        QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
        times[name] = round(time.perf_counter() - started, 3)
        print(name, times[name], file=sys.stderr, flush=True)
    print(json.dumps({"metric": "total_seconds_headline_queries", "value": round(sum(times.values()), 3), "unit": "sec",
                      "queries": times, "sf": os.path.basename(folder.rstrip("/"))}))
    spark.stop()


if __name__ == "__main__":
    main()
