"""An aggregate of the user's own (U1): zero, add, merge, finish.

Each task folds its rows into one partial state a key (``add`` sees a pandas frame of one
key's rows at a time) and holds at most ``held_keys`` of them; beyond that it sends what it
has and begins anew. One shuffle brings the partial states of a key together, where they are
merged one after the other. A key with a third of all rows thus sends one state a task, and
no group of rows is ever collected. Built-in aggregates stay faster where they suffice.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import TYPE_CHECKING, Protocol

from pyspark.sql import DataFrame
from pyspark.sql.types import StructType

from tidepool.functions.keys import NULLS, null_free, with_nulls

if TYPE_CHECKING:
    import pandas as pd

HELD_KEYS = 50_000


class Aggregator(Protocol):
    """States and results are tuples in the order of their schemas; ``merge`` must not depend on order."""

    def zero(self) -> tuple: ...

    def add(self, state: tuple, rows: pd.DataFrame) -> tuple: ...

    def merge(self, one: tuple, other: tuple) -> tuple: ...

    def finish(self, state: tuple) -> tuple: ...


def _schema(schema: StructType | str) -> StructType:
    return schema if isinstance(schema, StructType) else StructType.fromDDL(schema)


def _plain(row: tuple) -> tuple:
    """Numpy numbers as Python's, missing values as None."""
    return tuple(None if v is None or v != v else v.item() if hasattr(v, "item") else v for v in row)


def aggregate(df: DataFrame, key_cols: str | list[str], input_cols: list[str], aggregator: Aggregator,
              state_schema: StructType | str, output_schema: StructType | str, held_keys: int = HELD_KEYS) -> DataFrame:
    """The key columns and ``finish``'s columns, one row per key; a NULL key is a key."""
    keys = [key_cols] if isinstance(key_cols, str) else list(key_cols)
    state, out = _schema(state_schema), _schema(output_schema)
    rows = null_free(df.select(*keys, *(c for c in input_cols if c not in keys)), keys)
    grouped = [*keys, NULLS]
    key_fields = [rows.schema[k] for k in grouped]

    def frame(held: dict[tuple, tuple], fields: StructType) -> pd.DataFrame:
        import pandas as pd
        names = [*grouped, *fields.fieldNames()]
        columns = list(zip(*((*k, *s) for k, s in held.items()), strict=True)) or [()] * len(names)
        return pd.DataFrame({n: pd.Series(list(c), dtype=object) for n, c in zip(names, columns, strict=True)})

    def partial(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: dict[tuple, tuple] = {}
        for whole in frames:
            for key, part in whole.groupby(grouped, sort=False, dropna=False):
                held[key] = aggregator.add(held.get(key) or aggregator.zero(), part)
                if len(held) >= held_keys:
                    yield frame(held, state)
                    held = {}
        yield frame(held, state)

    def final(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        last, total = None, None
        for part in frames:
            done = {}
            for row in part.itertuples(index=False, name=None):
                key, value = row[:len(grouped)], _plain(row[len(grouped):])
                if key == last:
                    total = aggregator.merge(total, value)
                    continue
                if last is not None:
                    done[last] = aggregator.finish(total)
                last, total = key, value
            yield frame(done, out)
        if last is not None:
            yield frame({last: aggregator.finish(total)}, out)

    partials = rows.mapInPandas(partial, StructType([*key_fields, *state.fields]))
    merged = (partials.repartition(*grouped).sortWithinPartitions(*grouped)
              .mapInPandas(final, StructType([*key_fields, *out.fields])))
    return merged.select(*with_nulls(keys), *out.fieldNames())


class TagStatistics:
    """The reference's array function as an aggregate: tags, their total UTF-16 length and the longest one's."""

    STATE = "n_tags bigint, total bigint, longest bigint"

    def __init__(self, tag_col: str = "tag"):
        self.tag_col = tag_col

    def zero(self) -> tuple:
        return 0, 0, None

    def add(self, state: tuple, rows: pd.DataFrame) -> tuple:
        sizes = [len(t.encode("utf-16-le")) // 2 for t in rows[self.tag_col] if t is not None]
        return self.merge(state, (len(sizes), sum(sizes), max(sizes, default=None)))

    def merge(self, one: tuple, other: tuple) -> tuple:
        tops = [s[2] for s in (one, other) if s[2] is not None]
        return one[0] + other[0], one[1] + other[1], max(tops, default=None)

    def finish(self, state: tuple) -> tuple:
        return state
