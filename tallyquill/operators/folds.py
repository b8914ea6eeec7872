"""Ordered folds: a state is carried along the rows of a group, in order, in one pass over sorted partitions.

Groups are dealt to partitions and sorted there by Spark, which spills what memory doesn't hold.  The pass reads Arrow
batches and keeps nothing but the state of the group it is in, also where a group goes on in the next batch, so that a
group of any length takes the memory of its state.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from typing import Any

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

_ARROW = {"string": pa.string(), "int": pa.int32(), "bigint": pa.int64(), "boolean": pa.bool_()}
_NONE = object()


def _steps(batches: Iterator[pa.RecordBatch], by: list[str], seen: str, fold: Callable) -> Iterator[tuple[pa.RecordBatch, list]]:
    """Each batch with what the fold makes of its rows; a new group begins with a new fold."""
    key, state = _NONE, None
    for batch in batches:
        keys, rows, made = zip(*(batch.column(c).to_pylist() for c in by)), batch.column(seen).to_pylist(), []
        for k, row in zip(keys, rows):
            if k != key:
                key, state = k, fold()
            made.append(state(row))
        yield batch, made


def folded(rows: DataFrame, by: list[str], order: list[str], seen: dict[str, Column], fold: Callable[[], Callable[[dict], tuple]], made: dict[str, str]) -> DataFrame:
    """Rows with the columns `made` (name to type): what a group's fold returns for each row, one after the other by `order`.

    `fold()` makes the state of a new group, which is called with the values `seen` of each row and returns a tuple.
    """
    own = rows.withColumn("_seen", F.struct(*(v.alias(n) for n, v in seen.items()))).repartition(*by).sortWithinPartitions(*by, *order)
    kept = [c for c in rows.columns if c not in made]
    schema = T.StructType([*(rows.schema[c] for c in kept), *(T.StructField(n, T._parse_datatype_string(t)) for n, t in made.items())])
    types = [_ARROW[f.dataType.simpleString()] for f in schema.fields[len(kept) :]]

    def run(batches):
        for batch, values in _steps(batches, by, "_seen", fold):
            columns = [pa.array([v[i] for v in values], t) for i, t in enumerate(types)]
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in kept), *columns], names=[*kept, *made])

    return own.mapInArrow(run, schema)


def emitted(rows: DataFrame, key: list[str], row: str, seen: list[str], fold: Callable[[], Any], column: str, also: tuple[str, str, Callable[[pa.Array], pa.Array]]) -> DataFrame:
    """(key, entry_no, column, also): the texts that a fold tells of the rows that an exploded row (named by `row`) became.

    `also` is a column's name and type, and what makes it of an array of these texts, in the same pass.

    Such rows follow one another in their partition already: nothing is shuffled, sorted or gathered.  A fold has
    step(**seen) and rest(), which give texts once they are certain.
    """
    schema = T.StructType([*(rows.schema[c] for c in key), T.StructField("entry_no", T.IntegerType()), T.StructField(column, T.StringType()), T.StructField(also[0], T._parse_datatype_string(also[1]))])

    def run(batches):
        now, state, of, n = _NONE, None, None, 0

        def batch_of(found: list) -> pa.RecordBatch:
            own = [pa.array([k[i] for k, _, _ in found], t) for i, t in enumerate(kinds)]
            texts = pa.array([x for _, _, x in found], pa.string())
            return pa.RecordBatch.from_arrays([*own, pa.array([n for _, n, _ in found], pa.int32()), texts, also[2](texts)], names=[*key, "entry_no", column, also[0]])

        kinds = None
        for batch in batches:
            kinds = kinds or [batch.schema.field(c).type for c in key]
            found = []
            for r, k, *values in zip(batch.column(row).to_pylist(), zip(*(batch.column(c).to_pylist() for c in key)), *(batch.column(c).to_pylist() for c in seen)):
                if r != now:
                    if state is not None:
                        found += [(of, n + i, x) for i, x in enumerate(state.rest())]
                    now, state, of, n = r, fold(), k, 0
                for text in state.step(*values):
                    found.append((of, n, text))
                    n += 1
            yield batch_of(found)
        if state is not None:
            yield batch_of([(of, n + i, x) for i, x in enumerate(state.rest())])

    return rows.select(*key, row, *seen).mapInArrow(run, schema)
