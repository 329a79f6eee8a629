"""The user's step between source and sink."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from typing import TypeVar

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import types as T


R = TypeVar("R")


def map_rows(
    df: DataFrame,
    fn: Callable[[DataFrame], DataFrame] | Callable[[pd.DataFrame], pd.DataFrame] | Callable[[R, pd.DataFrame], pd.DataFrame],
    schema: T.StructType | str | None = None,
    *,
    open: Callable[[], R] | None = None,
    close: Callable[[R], None] | None = None,
) -> DataFrame:
    """Apply a user function to every row.

    Without ``schema``, ``fn`` maps DataFrame to DataFrame with ordinary expressions, which Spark compiles and can
    push filters and column lists through; prefer it. With ``schema``, ``fn`` maps Arrow batches as pandas frames
    and must return one row for each it gets, for code that expressions cannot say.

    ``open`` makes what the rows of a task need, such as a client or a model, once before its first row; ``fn`` then gets it
    before each batch. ``close`` gets it after the last row, also where the task fails or stops early. A task that is
    tried again opens again; what one task holds no other sees.
    """
    if schema is None:
        if open or close:
            raise ValueError("open and close are for functions over batches, which need a schema")
        return df.transform(fn)
    if close and not open:
        raise ValueError("close needs what open makes")

    def one_to_one(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held = (open(),) if open else ()
        try:
            for batch in batches:
                mapped = fn(*held, batch)
                if len(mapped) != len(batch):
                    raise ValueError(f"a row map returned {len(mapped)} rows for {len(batch)}")
                yield mapped
        finally:
            if close:
                close(*held)

    return df.mapInPandas(one_to_one, schema)
