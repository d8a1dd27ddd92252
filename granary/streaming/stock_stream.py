"""Streaming stock: floored state per item over an unbounded event stream.

An addition: the domain itself keeps only current state.  Events are ordered by
(ts, event_id) inside a micro-batch; one that arrives in a later batch than
events after it is applied when it arrives, since the floor cannot be undone.
No watermark is set, and an item's state is kept for good."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout


def floored_stock(events: DataFrame, key: str = "item") -> DataFrame:
    """(item, qty) after each micro-batch, for events (item, ts, event_id,
    delta, is_set); the item keeps its type."""
    kind = dict(events.dtypes)[key]

    def step(keys: tuple, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        qty = state.get[0] if state.exists else 0.0
        rows = pd.concat(list(frames)).sort_values(["ts", "event_id"])
        for delta, is_set in zip(rows["delta"], rows["is_set"]):
            qty = max(0.0, float(delta) if is_set else qty + float(delta))
        state.update((qty,))
        yield pd.DataFrame({key: [keys[0]], "qty": [qty]})

    return events.groupBy(key).applyInPandasWithState(step, f"{key} {kind}, qty double", "qty double", "update", GroupStateTimeout.NoTimeout)
