"""The training table built from stored versions, and runs of several batches."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from hourloom.config import Columns
from hourloom.operators import clean, reports
from hourloom.sources import sinks


def stored_versions(spark: SparkSession, root: str, cols: Columns = Columns()) -> DataFrame:
    """The rows of every version under root (folders version=N, found by Spark); of equal keys that of the largest version
    stays."""
    table = spark.read.option("mergeSchema", True).parquet(root)
    if "version" not in table.columns:
        raise ValueError(f"no versions under {root}")
    return clean.dedupe(table, cols.key, "version").drop("version")


def training_table(spark: SparkSession, root: str, out: str, columns: list[str], strict: bool = False, cols: Columns = Columns()) -> DataFrame:
    """Finds the versions, checks them, cleans them and writes table, quality report and statistics under out. strict makes
    a report with issues an error, before anything is written."""
    found = stored_versions(spark, root, cols)
    report = reports.quality_report(found, columns, cols)
    if strict and not (seen := report.first()).is_clean:
        raise ValueError(seen.issues)
    clean.canonicalise(found, cols).write.mode("overwrite").parquet(f"{out}/table")
    table = spark.read.parquet(f"{out}/table")
    sinks.save_report(report, f"{out}/quality")
    sinks.save_report(reports.statistics(table, columns), f"{out}/statistics")
    return table


def run_batches(batches: list, job: Callable, before: Callable | None = None, after: Callable | None = None) -> list[tuple[object, str | None]]:
    """Runs job on each batch between the hooks; an error ends its batch alone and is given to `after`, the outcome is told
    by batch."""
    out = []
    for batch in batches:
        problem = None
        try:
            if before:
                before(batch)
            job(batch)
        except Exception as e:
            problem = f"{type(e).__name__}: {e}"
        if after:
            after(batch, problem)
        out.append((batch, problem))
    return out
