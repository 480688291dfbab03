"""Row functions with a life cycle: opened once per partition, closed after
its last row, whatever ends it."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame


def map_with_setup(df: DataFrame, open_: Callable[[], object], fn: Callable[[object, pd.DataFrame], pd.DataFrame],
                   schema: str, close: Callable[[object], None] | None = None) -> DataFrame:
    """``open_()`` makes a resource (a connection, a compiled pattern) per
    partition, ``fn(resource, batch)`` maps each Arrow batch, ``close``
    releases the resource, also if a batch fails."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        resource = open_()
        try:
            for pdf in batches:
                yield fn(resource, pdf)
        finally:
            if close is not None:
                close(resource)

    return df.mapInPandas(run, schema)
