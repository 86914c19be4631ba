"""Headline queries at ``$BENCH_SF_DIR`` on ``local[$BENCH_CPUS]``; prints one JSON line.

Inputs that stand for files or loaded tables (raw report files, normalised files, staged payments) are
written first and timed apart as ``setup``. Every query is then run twice, results discarded by the
noop sink: ``queries`` holds the second, warm time and ``cold`` the first. The load of all 18 tables
runs once; it is the one step the baseline has a time for.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from catalog import files, formats, load, standins  # noqa: E402
from tripledger.schemas import TABLES  # noqa: E402
from tripledger.session import local_session  # noqa: E402
from tripledger.sources import loader  # noqa: E402

REPORTS = ["recon_summary", "recon_gaps", "unmatched_contributions", "union_contributions"]
VIEWS = [
    "prod_settlement",
    "prod_kredivo",
    "issuer_mandiri",
    "file_bank_mandiri",
    "bank_kredivo",
    "desc_route",
    "traffic_distinct",
    "group_by_rate",
    "dedupe_rows",
]
CELLS = ["datetime_bca", "time_btn"]
FILES = ["fmt_mandiri", "fmt_bank_bca"]


def timed(run) -> float:
    began = time.time()
    run()
    return round(time.time() - began, 3)


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = local_session(cpus)
    registered, _ = load()

    def prepare() -> None:
        standins.staged_payments(spark, folder)
        for name in FILES:
            formats.raw_path(spark, folder, name.removeprefix("fmt_"))
        for table in TABLES:
            files.normalised(spark, folder, table)

    setup = timed(prepare)

    def sink(name):
        return lambda: registered[name](spark, folder).write.format("noop").mode("overwrite").save()

    cold, warm = {}, {}
    for name in REPORTS + VIEWS + CELLS + FILES:
        cold[name] = timed(sink(name))
        warm[name] = timed(sink(name))

    project = files.normalised(spark, folder, "recon_mdr_master").removesuffix("/master/mdr")
    warehouse = project.replace("normalised", "bench-warehouse")
    warm["load_18_tables"] = timed(lambda: loader.load_all(spark, project, warehouse))
    print(
        json.dumps(
            {
                "metric": "headline_queries_total",
                "value": round(sum(warm.values()), 3),
                "unit": "sec",
                "queries": warm,
                "cold": cold,
                "setup": setup,
                "cpus": cpus,
                "sf": os.path.basename(folder.rstrip("/")).removeprefix("sf"),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
