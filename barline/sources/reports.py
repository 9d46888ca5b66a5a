"""Written results: run records and symbol listings."""

from __future__ import annotations

from pyspark.sql import DataFrame

from barline.operators.universe import universe_listing


def write_run_record(record: DataFrame, path: str) -> None:
    """A run record, or batch rows, as JSON lines. Files appear when the write commits, never half-done."""
    record.write.mode("overwrite").json(path)


def write_listing(universe: DataFrame, path: str) -> None:
    """symbol,base,quote,status lines."""
    universe_listing(universe).write.mode("overwrite").text(path)
