"""Times the headline queries and prints one JSON line.

Each query is run once to warm up and then BENCH_RUNS times (default 3); its median counts. Results go
to a sink that discards rows, so all of them are computed and none reaches the driver.
"""

from __future__ import annotations

import json
import os
import statistics
import time

from cofre.registry.queries import queries
from cofre.session import build_session

HEADLINE = (
    "scan_transacoes",
    "normalize_timestamp",
    "normalize_money",
    "dedupe_latest",
    "duplicated_cpf",
    "orphans_transacoes",
    "join_many_to_one",
    "silver_clientes",
    "silver_emprestimos",
    "silver_transacoes",
    "daily_transaction_volume",
    "daily_pix_transaction_volume",
    "financial_volume_by_agency",
    "transactions_per_customer",
    "average_balance_by_agency",
    "customers_with_loans",
    "loan_volume",
    "dim_cliente",
    "dim_data",
    "fato_transacao",
    "fato_emprestimo",
    "report_03_by_type",
    "report_04_monthly_transactions",
    "report_06_loans_by_year",
    "report_08_top10_customers",
    "contract_unique",
    "contract_not_null",
    "contract_relationships",
    "reject_summary",
)


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    chosen = os.environ.get("BENCH_QUERIES")
    spark = build_session(
        "bench", f"local[{cpus}]", **{"spark.sql.shuffle.partitions": cpus, "spark.driver.memory": "8g"}
    )
    spark.sparkContext.setLogLevel("ERROR")
    known = queries()
    names = list(known) if chosen == "all" else chosen.split(",") if chosen else HEADLINE
    seconds = {}
    for name in names:
        times = []
        for _ in range(runs + 1):
            start = time.perf_counter()
            known[name](spark, folder).write.format("noop").mode("overwrite").save()
            times.append(time.perf_counter() - start)
        seconds[name] = round(statistics.median(times[1:] or times), 3)
    spark.stop()
    print(json.dumps({
        "metric": "total seconds of the headline queries",
        "value": round(sum(seconds.values()), 3),
        "unit": "sec",
        "queries": seconds,
        "sf": folder.rstrip("/").rsplit("/sf", 1)[-1],
    }))


if __name__ == "__main__":
    main()
