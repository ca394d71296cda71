"""Time every query of the catalogue and the model fits; print one JSON line.

``BENCH_SF_DIR`` names the tables, ``BENCH_CPUS`` the local cores. Every query is fully evaluated
without collecting rows and runs twice; the second time counts, the first is kept beside it. Fits
are also reported as training rows per second, the unit of the published baseline, per core, and
with the time that preparing their vectors takes.
"""

from __future__ import annotations

import json
import os
import time

from pyspark.sql import SparkSession

from rolescope.operators import train
from rolescope.operators.anomalies import threshold_ladder
from rolescope.operators.summary import flag_prevalence, numeric_summary
from rolescope.plans import catalog, views

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")

def run(df) -> None:
    df.write.format("noop").mode("overwrite").save()


def timed(f) -> float:
    started = time.perf_counter()
    f()
    return round(time.perf_counter() - started, 3)


def per_column_forms(spark) -> dict[str, float]:
    """The one-pass reports against one scan per column, same results."""
    lines = views.lines(spark, SF_DIR)
    flags, numeric = views.LINES.flags, views.LINES.numeric
    rules = catalog.LADDER
    pairs = {
        "flag_prevalence": (lambda: run(flag_prevalence(lines, flags)),
                            lambda: [run(flag_prevalence(lines, (f,))) for f in flags]),
        "numeric_summary_approx": (lambda: run(numeric_summary(lines, numeric)),
                                   lambda: [run(numeric_summary(lines, (c,))) for c in numeric]),
        "threshold_ladder": (lambda: run(threshold_ladder(lines, rules)),
                             lambda: [run(threshold_ladder(lines, [r])) for r in rules]),
    }
    speedup = {}
    for name, (one_pass, by_column) in pairs.items():
        by_column()
        speedup[name] = round(timed(by_column) / timed(one_pass), 2)
    return speedup


def fits(spark) -> tuple[dict[str, float], dict]:
    spec = views.WIDE_MODEL
    started = time.perf_counter()
    result = train.train_and_evaluate(views.wide_model_rows(spark, SF_DIR), spec, spec.roles.id)
    total = time.perf_counter() - started
    width = next(iter(result.models.values())).stages[-1].numFeatures
    result.release()
    seconds = {f"fit {m}": round(s, 3) for m, s in result.seconds.items()}
    rates = {m: round(result.train_rows / s) for m, s in result.seconds.items()}
    return seconds, {"rows": result.train_rows, "features": width, "rows_per_sec": rates,
                     "rows_per_sec_core": {m: round(r / int(CPUS)) for m, r in rates.items()},
                     "prepare_and_evaluate": round(total - sum(result.seconds.values()), 3)}


def main() -> None:
    spark = (SparkSession.builder.master(f"local[{CPUS}]").appName("rolescope-bench")
             .config("spark.sql.shuffle.partitions", CPUS)
             .config("spark.sql.session.timeZone", "UTC")
             .config("spark.driver.memory", "16g").config("spark.ui.enabled", "false")
             .config("spark.ui.showConsoleProgress", "false").getOrCreate())
    spark.sparkContext.setLogLevel("ERROR")
    first, warm = {}, {}
    for name, query in catalog.QUERIES.items():
        first[name] = timed(lambda: run(query(spark, SF_DIR)))
        warm[name] = timed(lambda: run(query(spark, SF_DIR)))
    fit_seconds, fit_info = fits(spark)
    warm.update(fit_seconds)
    speedup = per_column_forms(spark)
    print(json.dumps({
        "metric": "total_warm_seconds", "value": round(sum(warm.values()), 3), "unit": "sec",
        "queries": warm, "sf": os.path.basename(SF_DIR.rstrip("/")).removeprefix("sf"),
        "cpus": int(CPUS), "first_run": first, "fit": fit_info,
        "one_pass_speedup": speedup}))
    spark.stop()


if __name__ == "__main__":
    main()
