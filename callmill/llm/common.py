"""Helpers of this subpackage."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from callmill.common import stored

#: Characters of text that a Python step holds at once, besides a single longer text.
TEXTS_AT_ONCE = 8_000_000


def in_slices(batches: Iterable[pa.RecordBatch], column: str) -> Iterator[pa.RecordBatch]:
    """The batches in slices of bounded text, so that long texts don't pile up in a worker."""
    for batch in batches:
        sizes = batch.column(column).nbytes
        steps = max(1, -(-sizes // TEXTS_AT_ONCE))
        rows = max(1, batch.num_rows // steps)
        for start in range(0, batch.num_rows, rows):
            yield batch.slice(start, rows)


def map_texts(df: DataFrame, column: str, schema: str, f: Callable[[pa.RecordBatch], pa.RecordBatch | None]) -> DataFrame:
    """f over slices of df's batches; f returns a batch of the schema or None."""

    def run(batches):
        for part in in_slices(batches, column):
            out = f(part)
            if out is not None and out.num_rows:
                yield out

    return df.mapInArrow(run, schema)


def components(edges: DataFrame, nodes: DataFrame) -> DataFrame:
    """nodes(node) -> node, component: the least node that edges(a, b) connect it with.

    Each round takes the least label of the neighbours, then the label's own label, and is written to the shared
    folder; the number of rounds follows the logarithm of the longest path, not the data.
    """
    both = stored(edges.select("a", "b").where("a <> b").union(edges.select("b", "a").where("a <> b")).distinct(), "edges")
    labels = stored(nodes.select("node", F.col("node").alias("component")), "labels")
    while True:
        least = both.join(labels, both.b == labels.node).groupBy("a").agg(F.min("component").alias("least"))
        step = labels.join(least, labels.node == least.a, "left").select("node", F.least("component", F.coalesce("least", "component")).alias("next"), "component")
        step = stored(step, "labels")
        own = step.select(F.col("node").alias("_n"), F.col("next").alias("_next"))
        new = stored(step.join(own, step.next == own._n, "left").select("node", F.least("next", F.coalesce("_next", "next")).alias("component"), F.col("component").alias("old")), "labels")
        if new.where("component <> old").isEmpty():
            return new.select("node", "component")
        labels = new.select("node", "component")
