"""Order-dependent folds over groups: rows are brought together by key, sorted in their partition and folded as
they stream by, so that many small groups cost no call each and no group is built as a table of its own."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType, _parse_datatype_string


def fold_groups(df: DataFrame, keys: list[str], order: list, fold: Callable[[tuple, list[tuple]], list[tuple]], schema: str, flush: int = 20_000) -> DataFrame:
    """fold(key, rows) for each group, rows in order without their keys; its tuples are the result's rows.

    A group is held in one task, as its fold depends on the order of all its rows."""
    k = len(keys)
    rest = [c for c in df.columns if c not in keys]
    kind: StructType = _parse_datatype_string(schema)
    arrow = to_arrow_schema(kind)

    def out(rows: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), arrow)], schema=arrow)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, held, done = None, [], []
        for b in batches:
            for row in zip(*[c.to_pylist() for c in b.columns]):
                if row[:k] != key:
                    if held:
                        done += fold(key, held)
                    key, held = row[:k], []
                held.append(row[k:])
            if len(done) >= flush:
                yield out(done)
                done = []
        if held:
            done += fold(key, held)
        if done:
            yield out(done)

    x = df.select(*keys, *rest).repartition(*keys).sortWithinPartitions(*[F.col(c) for c in keys], *order)
    return x.mapInArrow(run, schema)
