"""Export of the accuracy report as data."""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame

from wardline.operators import scoring


def report_parts(det: DataFrame, counts: DataFrame) -> dict[str, DataFrame]:
    return {
        "window": scoring.batch_window(counts),
        "overall": scoring.overall_metrics(det, counts),
        "by_label": scoring.label_metrics(det, counts),
        "latency": scoring.latency_summary(det),
        "malformed": scoring.malformed_totals(counts),
        "malformed_rate": scoring.malformed_rate(counts),
        "integrity": scoring.integrity(det, counts),
    }


def export_report(det: DataFrame, counts: DataFrame, folder: str, at_once: int = 4) -> list[str]:
    """Write every part as JSON lines below ``folder``; returns the part names.

    The parts are small independent jobs, so a few of them run side by side.
    """
    parts = report_parts(det, counts)

    def write(name: str) -> str:
        parts[name].write.mode("overwrite").json(f"{folder.rstrip('/')}/{name}")
        return name

    with ThreadPoolExecutor(at_once) as pool:
        return list(pool.map(inheritable_thread_target(det.sparkSession)(write), parts))
