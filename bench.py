"""Times the headline queries and prints one line of JSON."""

from __future__ import annotations

import json
import os
import statistics
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from natalis.plans.catalogue import QUERIES  # noqa: E402
from natalis.session import session  # noqa: E402

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")
RUNS = int(os.environ.get("BENCH_RUNS", "3"))

HEADLINE = (
    "code_map_union",
    "numbered_events",
    "candidate_dedupe",
    "revise_abortion",
    "spacing_conflicts",
    "accept_all_as_written",
    "accept_all_forward",
    "all_starts",
    "refined_start",
    "episodes_eligible",
    "episodes_final",
    "episodes_final_intended",
    "mother_table",
    "length_histogram",
    "outcome_counts",
)


def main() -> None:
    spark = session(
        "bench",
        f"local[{CPUS}]",
        spark__sql__shuffle__partitions=str(2 * int(CPUS)),
        # The small tables would else end up in fewer partitions than there are cores.
        spark__sql__adaptive__advisoryPartitionSizeInBytes="8m",
        spark__driver__memory=os.environ.get("BENCH_MEMORY", "16g"),
        spark__ui__showConsoleProgress="false",
    )
    spark.sparkContext.setLogLevel("ERROR")

    def once(name: str) -> float:
        begin = time.perf_counter()
        QUERIES[name](spark, SF_DIR).write.format("noop").mode("overwrite").save()
        return time.perf_counter() - begin

    for name in HEADLINE:
        once(name)
    seconds = {name: round(statistics.median(once(name) for _ in range(RUNS)), 3) for name in HEADLINE}
    result = {
        "metric": f"sum of the median times of {len(HEADLINE)} headline queries, warm, plan building included",
        "value": round(sum(seconds.values()), 3),
        "unit": "sec",
        "queries": seconds,
        "sf": Path(SF_DIR).name.removeprefix("sf"),
    }
    print(json.dumps(result))


if __name__ == "__main__":
    main()
