"""Seconds of headline queries, as one JSON line. BENCH_SF_DIR and BENCH_CPUS set the tables and the cores."""

from __future__ import annotations

import json
import os
import time

from leadloom import queries
from leadloom.session import local_session

HEADLINES = ("text_folds", "host_rules", "websites", "phone_values", "companies", "validation_flags", "candidate_pairs", "normalized", "pair_scores", "survivors", "hygiene_run", "invariant_violations", "cell_diff", "company_keys")


def main() -> None:
    sf_dir, cpus = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1"), int(os.environ.get("BENCH_CPUS", "8"))
    spark = local_session(cpus, partitions=cpus)
    found = queries.queries()
    chosen = {k: found[k] for k in HEADLINES}
    try:
        from leadloom.llm import queries as llm
    except ImportError:
        pass
    else:
        import corpus_pipeline

        chosen |= llm.queries() | {"pipeline": corpus_pipeline.run}
    took, until = {}, time.perf_counter() + float(os.environ.get("BENCH_SECONDS", "900"))
    for name, f in chosen.items():
        if time.perf_counter() > until:  # what is left isn't measured; the line names what is
            break
        began = time.perf_counter()
        f(spark, sf_dir).write.format("noop").mode("overwrite").save()
        took[name] = round(time.perf_counter() - began, 3)
    sf = os.path.basename(sf_dir.rstrip("/")).removeprefix("sf")
    print(json.dumps({"metric": "total_query_seconds", "value": round(sum(took.values()), 3), "unit": "sec", "queries": took, "sf": float(sf) if sf.replace(".", "").isdigit() else sf}))


if __name__ == "__main__":
    main()
