"""Named measures over readings, shared by the batch operators and their streaming twins."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .. import config as C

#: What a measure's name calls a signal, and its column.
SIGNAL_COLUMNS = {"vibration": "vibration_rms", "temperature": "temperature_c",
                  "pressure": "pressure_bar", "current": "current_amp"}


def signal_stats(spread: str, **functions: str) -> list[Column]:
    """``avg_vibration``, ``max_vibration``, ... for e.g. ``vibration="avg max"``; ``spread`` names the
    sample deviation of vibration; ``reading_count`` counts the rows."""
    named = [getattr(F, fn)(SIGNAL_COLUMNS[signal]).alias(f"{fn}_{signal}")
             for signal, wanted in functions.items() for fn in wanted.split()]
    return [*named, F.stddev(SIGNAL_COLUMNS["vibration"]).alias(spread), F.count(F.lit(1)).alias("reading_count")]


def recent_stats() -> list[Column]:
    """Measures of the recent window per machine."""
    return signal_stats("vibration_volatility", vibration="avg max", temperature="avg max", pressure="avg")


def day_stats() -> list[Column]:
    """Measures of the gold layer per machine and day (D6, T2): signals, and rows per status."""
    def rows_at(level: str, name: str) -> Column:
        return F.sum(F.when(F.col("vibration_status") == level, 1).otherwise(0)).alias(name)

    return [*signal_stats("vibration_std", vibration="avg max", temperature="avg max", pressure="avg"),
            rows_at(C.STATUS_CRITICAL, "critical_count"), rows_at(C.STATUS_DANGER, "warning_count")]
