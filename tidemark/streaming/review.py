"""The review queue as state: what waits for a decision, kept by key and given up in the end.

A batch is one run. Its observations of a key either all say the same (wait with this entry, or wait no longer) or
contradict each other; then the key's state stays and an error row is given out. A key that waits no longer has no state,
and an entry that no run has touched for ``keep`` is given out as expired and leaves the state.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

CHANGE = "key string, change string, entry string, previous string"


def queue_changes(stream: DataFrame, key: str, entry: str, at: str, keep: dt.timedelta = dt.timedelta(days=365), late: str = "14 days") -> DataFrame:
    """key, change (added, replaced, removed, expired or conflict), entry and previous for each key that a run changes.

    ``entry`` is what a reviewer would see, null once nothing waits; ``at`` is when that was observed, by which entries
    expire: once observations ``keep`` later than the key's last one, less ``late``, have come in. Rows without a key or a
    time are left out.
    """
    patience = int(keep.total_seconds() * 1000)

    def step(names: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        before = state.get[0] if state.exists else None
        if state.hasTimedOut:
            state.remove()
            change, entry = "expired", None
        else:
            told = pd.concat(batches)
            said, seen = {None if pd.isna(e) else e for e in told["entry"]}, int(told["at"].max().timestamp() * 1000)
            change, entry = "conflict", before
            if len(said) == 1:
                entry = said.pop()
                change = None if entry == before else "removed" if entry is None else "added" if before is None else "replaced"
                if entry is None:
                    state.remove()
                else:
                    state.update((entry,))
            if entry is not None:
                state.setTimeoutTimestamp(max(seen, state.getCurrentWatermarkMs()) + patience)  # anew with each run that sees the key
        yield pd.DataFrame([(names[0], change, entry, before)] if change else [], columns=["key", "change", "entry", "previous"])

    rows = stream.where(F.col(key).isNotNull() & F.col(at).isNotNull())
    rows = rows.select(F.col(key).cast("string").alias("key"), F.col(entry).cast("string").alias("entry"), F.col(at).cast("timestamp").alias("at")).withWatermark("at", late)
    return rows.groupBy("key").applyInPandasWithState(step, CHANGE, "entry string", "append", GroupStateTimeout.EventTimeTimeout)
