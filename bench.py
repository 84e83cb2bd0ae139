"""Time the headline queries and print one JSON line.

``BENCH_SF_DIR`` names the tables (default sf0.1) and ``BENCH_CPUS`` the local cores. Each query is
built and fully computed into the no-op sink; a short warm-up on the same tables comes first so
that class loading and code generation are not charged to the first query.
"""

import json
import os
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from sparkmon.plans.catalog import PLANS
from sparkmon.session import get_session


def measure(spark, name: str, folder: str) -> float:
    start = time.perf_counter()
    PLANS[name](spark, folder).write.format("noop").mode("overwrite").save()
    return round(time.perf_counter() - start, 3)


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = os.environ.get("BENCH_CPUS", str(os.cpu_count()))
    chosen = sys.argv[1:] or list(PLANS)
    spark = get_session("bench", master=f"local[{cpus}]", conf={"spark.driver.memory": "16g"})
    measure(spark, "drift_summary", folder)
    times = {name: measure(spark, name, folder) for name in chosen}
    print(
        json.dumps(
            {
                "metric": "total query time",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "sf": folder.rsplit("sf", 1)[-1],
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
