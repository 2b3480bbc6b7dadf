"""The job of an arriving batch: match it with what is loaded, merge, record the changes."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from datetime import datetime

from pyspark.sql import DataFrame

from kinweave.plans.rules import Rule
from kinweave.session import cut
from kinweave.sinks.merge import KeyedTable
from kinweave.streaming.files import append_changes
from kinweave.streaming.incremental import IndexedState, match_with
from kinweave.streaming.index import SignatureIndex


def arrival_job(
    loaded: KeyedTable, rules: Sequence[Rule], feed: str, as_of: datetime | str, first_version: int = 1, keep: int | None = None,
    index: SignatureIndex | None = None,
) -> Callable[[DataFrame, int], None]:
    """What to do with each batch of normalized records, one per id, for `on_arrival`.

    Batch n makes version `first_version` + n + 1 of the table and of its index, so a batch that is repeated
    after a failure repeats its result.  `keep` is the number of versions that stay.  The index lies beside the
    table unless given, and is made from the first version where there is none.
    """
    key = loaded.key
    index = index or SignatureIndex(loaded.spark, f"{loaded.root}-index", key, rules)

    def arrive(batch: DataFrame, batch_id: int) -> None:
        old = first_version + batch_id
        if not index.versions():
            index.start(loaded.read(old), old)
        batch = cut(batch)
        found = match_with(batch, IndexedState(loaded, index, old), key, rules)
        rows = cut(found.rows)
        fields = [c for c in loaded.read(old).columns if c in batch.columns]
        others = loaded.lookup(rows.where("not is_new").select(rows["id"].alias(key)), fields, old)
        merged = others.unionByName(batch.select(*fields)).join(rows.drop("is_new").withColumnRenamed("id", key), key)
        index.add(found.entries, old + 1)
        loaded.merge(merged, as_of, version=old + 1)
        append_changes(loaded, old, old + 1, feed, batch_id)
        if keep is not None:
            loaded.prune(keep)
            index.prune(keep)

    return arrive
