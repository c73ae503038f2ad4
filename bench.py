"""Times the stages and the headline queries; prints one JSON line.

Stages run once and in order, each reading the tables the one before has written.
Queries run to completion into a no-op sink; the best of two runs counts.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from verdejo.plans import catalog  # noqa: E402
from verdejo.plans.warehouse import Warehouse, open_warehouse  # noqa: E402
from verdejo.session import build_session  # noqa: E402
from verdejo.sources import landing  # noqa: E402

FOLDER = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")
HEADLINE = (
    "delivered_value_by_month", "clean_orders", "clean_items", "clean_payments", "clean_reviews", "clean_products", "geo_prefixes",
    "text_keys", "customer_places", "item_distances", "pair_distances", "dim_product", "fact_orders", "fact_items",
    "landed_content_checks", "star_reconciliation_checks", "star_preservation_checks", "star_signatures", "distance_profile",
    "panel_summary", "panel_categorias", "panel_export", "kpi_ven_002", "kpi_log_005", "kpi_cli_002", "analysis_sellers",
    "analysis_distance", "split_value_quarter",
)


def drain(df) -> None:
    df.write.format("noop").mode("overwrite").save()


def extracts(w: Warehouse) -> list[landing.Source]:
    """CSV files of every landed table, written before the clock starts."""
    for name, df in w.raw.items():
        df.coalesce(1).write.option("header", True).option("quoteAll", True).csv(f"{w.ws.root}/raw/{name}")
    return [landing.Source(n, f"{w.ws.root}/raw/{n}", "loja", "bench", multi_line=n in landing.FREE_TEXT) for n in w.raw]


def main() -> None:
    only = sys.argv[1:]
    spark = build_session("bench", f"local[{CPUS}]", **{
        "spark.sql.shuffle.partitions": CPUS, "spark.ui.enabled": "false", "spark.driver.memory": "12g",
        "spark.ui.showConsoleProgress": "false", "spark.log.level": "ERROR"})
    times: dict[str, float] = {}

    def timed(name: str, fn) -> None:
        start = time.perf_counter()
        fn()
        times[name] = round(time.perf_counter() - start, 3)

    drain(catalog.testbed.source(spark, FOLDER, "nation"))  # session warm-up
    w: Warehouse = open_warehouse(spark, FOLDER)
    sources = extracts(w)
    landed: list[dict] = []
    timed("stage_land_csv", lambda: landed.extend(landing.land(spark, sources, f"{w.ws.root}/bronze", w.ws)))
    timed("stage_clean", lambda: w.silver.all())
    timed("stage_places", lambda: w.places.all())
    timed("stage_distances", lambda: w.integrated.all())
    timed("stage_star", lambda: w.gold.all())
    for name in HEADLINE:
        if only and name not in only:
            continue
        best = None
        for _ in range(2):
            timed(name, lambda: drain(catalog.QUERIES[name](spark, FOLDER)))
            best = times[name] if best is None else min(best, times[name])
        times[name] = best
    rows = sum(r["linhas_saida"] for r in landed)
    print(json.dumps({"metric": "total_time", "value": round(sum(times.values()), 3), "unit": "sec", "queries": times,
                      "sf": os.path.basename(FOLDER.rstrip("/")).removeprefix("sf"),
                      "landed_rows": rows, "landed_rows_per_sec": round(rows / times["stage_land_csv"])}))
    spark.stop()


if __name__ == "__main__":
    main()
