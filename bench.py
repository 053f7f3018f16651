"""Times every registered query and prints one JSON line.

Each time covers planning and running to the last row, better of two runs.
Layers that several queries read (bronze and checked rows, dimensions, fact)
are written first and timed as ``build_*``; together they are one full build
from the raw tables. All queries run once on small tables before, so that no
time includes starting up. ``csv_to_catalog`` is a whole run as the command
line does it: CSV files to bronze, silver, audit and gold tables.
"""

from __future__ import annotations

import json
import os
import tempfile
import time

from claimloom.plans.layers import AS_OF, CONFIG, Layers, layers
from claimloom.plans.refresh import run_pipeline
from claimloom.plans.registry import QUERIES
from claimloom.session import build_session
from claimloom.sources import driver_tables
from claimloom.sources.config import Config, config_from_dict, load_config


RUNS = 2


def run(df) -> None:
    df.write.format("noop").mode("overwrite").save()


def timed(action) -> float:
    start = time.perf_counter()
    action()
    return round(time.perf_counter() - start, 3)


def steps(built: Layers) -> dict:
    """What a full build writes, in order."""
    return {
        "build_bronze_members": lambda: built.bronze("members"),
        "build_bronze_providers": lambda: built.bronze("providers"),
        "build_bronze_claims": lambda: built.bronze("claims"),
        "build_checked_members": lambda: built.stored_outcome("members"),
        "build_checked_providers": lambda: built.stored_outcome("providers"),
        "build_checked_claims": lambda: built.stored_outcome("claims"),
        "build_dim_member": built.stored_dim_member,
        "build_dim_provider": built.stored_dim_provider,
        "build_fact_claims": built.stored_fact,
    }


def csv_files(spark, folder: str) -> Config:
    """The datasets as CSV files in a folder of their own, and a config that names it."""
    scratch = tempfile.mkdtemp(prefix="claimloom-bench-")
    declared = json.loads(CONFIG.read_text())
    declared["paths"] = {name: f"{scratch}/{name}" for name in declared["paths"]}
    declared["database_prefix"] = "bench_"
    config = config_from_dict(declared)
    for name, extract in driver_tables.extracts(spark, folder).items():
        path = f"{config.raw_zone}/{config.datasets[name].file}"
        extract().drop(driver_tables.ORDER).write.option("header", True).csv(path)
    return config


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session(
        "claimloom-bench",
        master=f"local[{cpus}]",
        **{
            "spark.sql.shuffle.partitions": cpus,
            "spark.ui.enabled": "false",
            "spark.driver.memory": "16g",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")

    warm = os.environ.get("BENCH_WARM_DIR", "/root/testdata/sf0.01")
    if os.path.isdir(warm) and warm != folder:
        for query in QUERIES.values():
            run(query(spark, warm))

    seconds: dict[str, float] = {}
    for _ in range(RUNS):
        built = Layers(spark, folder, load_config(CONFIG))
        for name, build in steps(built).items():
            seconds[name] = min(timed(build), seconds.get(name, float("inf")))
    build = round(sum(seconds.values()), 3)
    layers(spark, folder).stored_fact()
    for name, query in QUERIES.items():
        seconds[name] = min(timed(lambda: run(query(spark, folder))) for _ in range(RUNS))
    claims = built.bronze("claims").count()
    config = csv_files(spark, folder)
    seconds["csv_to_catalog"] = min(
        timed(lambda: run_pipeline(spark, config, as_of=AS_OF)) for _ in range(RUNS)
    )
    print(
        json.dumps(
            {
                "metric": "total_seconds",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(folder.rstrip("/")),
                "cpus": int(cpus),
                "claims": claims,
                "full_build_sec": build,
                "claims_per_sec_full_build": round(claims / build),
                "claims_per_sec_csv_to_catalog": round(claims / seconds["csv_to_catalog"]),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
