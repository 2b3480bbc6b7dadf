"""The load job: records into a keyed table or a catalog table."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import DataFrame

from kinweave.sinks.merge import KeyedTable
from kinweave.sinks.tables import append_rows, overwrite_rows

# Outcomes of a load.
SUCCESS, PARTIAL, SKIPPED, ERROR = "success", "partial", "skipped", "error"


@dataclass(frozen=True)
class LoadResult:
    status: str
    processed: int = 0
    loaded: int = 0
    failed: int = 0
    inserted: int = 0
    updated: int = 0
    message: str = ""


def load(
    records: DataFrame | None, target: KeyedTable | str, mode: str = "merge",
    as_of: datetime | str | None = None, on_error: str = "abort", rejects: DataFrame | None = None,
    order_by: str | None = None, dry_run: bool = False, version: int | None = None,
) -> LoadResult:
    """Merge into a keyed table, or append to / overwrite a catalog table.

    `rejects` are rows an earlier step already refused; they count as failed.  With
    `on_error="abort"` a failed write raises, with "continue" it is an error result.
    Nothing to load or a dry run is skipped, writes nothing and loads 0.
    """
    if mode not in ("merge", "append", "overwrite"):
        raise ValueError(f"unknown load mode {mode!r}")
    if records is None or dry_run:
        return LoadResult(SKIPPED, message="dry run" if dry_run else "no records")
    try:
        refused = rejects.count() if rejects is not None else 0
        if mode == "merge":
            counts = target.merge(records, as_of or datetime.now(), order_by, version)
            inserted, updated = counts["inserted"], counts["updated"]
            refused += counts["rejected"]
        else:
            inserted = (append_rows if mode == "append" else overwrite_rows)(records, target)
            updated = 0
    except Exception as error:
        if on_error == "abort":
            raise
        return LoadResult(ERROR, message=str(error))
    loaded = inserted + updated
    status = SUCCESS if not refused else (PARTIAL if loaded else ERROR)
    return LoadResult(status, loaded + refused, loaded, refused, inserted, updated)
