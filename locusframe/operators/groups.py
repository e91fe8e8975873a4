"""Groups whose bounds depend on the order in which rows come."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from locusframe.operators.intervals import islands
from locusframe.shared import dealt, stored


def _in_order(rows: DataFrame, keys: list[str], order: str, place: Callable[[list, object, int, int], None], bounds: Callable[[list], list[tuple]], n: int | None) -> DataFrame:
    """Runs `place` over the rows of each overlap component in order, with its groups so far; `bounds` gives a component's groups as (order, s, e, n).

    Rows that don't overlap can't come into one group through each other, so each component is a task's own."""
    labelled = islands(rows.select(*keys, order, "s", "e"), keys, name="_part", rows=n)
    schema = rows.select(*keys, order, "s", "e").schema.add("n", "long")
    kinds = {"bigint": pa.int64(), "int": pa.int32(), "string": pa.string()}
    types = [kinds[f.dataType.simpleString()] for f in schema]

    def table(out: list[tuple]) -> pa.RecordBatch:
        cols = list(zip(*out, strict=True)) or [()] * len(types)
        return pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(cols, types, strict=True)], schema.names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at: tuple = ()
        groups: list = []
        for b in batches:
            out: list[tuple] = []
            for *key, o, s, e in zip(*(b[c].to_pylist() for c in (*keys, "_part", order, "s", "e")), strict=True):
                if tuple(key) != at:
                    out += [(*at[:-1], *g) for g in bounds(groups)]
                    at, groups = tuple(key), []
                place(groups, o, s, e)
            yield table(out)
        yield table([(*at[:-1], *g) for g in bounds(groups)])

    ordered = labelled.select(*keys, "_part", order, F.col("s").cast("long").alias("s"), F.col("e").cast("long").alias("e"))
    at = [*keys, "_part"]
    return dealt(ordered.repartition(*at), at, n).sortWithinPartitions(*keys, "_part", order).mapInArrow(run, schema)


def _alike(s: int, e: int, p: int, q: int, share: float) -> bool:
    """Whether one of two intervals has more than `share` of itself in the other."""
    return min(e, q) - max(s, p) + 1 > share * min(e - s + 1, q - p + 1)


def joined(rows: DataFrame, keys: list[str], order: str, share: float = 0.5, n: int | None = None) -> DataFrame:
    """C14, first: in order, each row joins the first group of which a member is alike (see share), or opens one.

    rows: keys, order (unique within keys), s, e (whole numbers). Returns per group keys, order (its first row's), s, e, n. A component's distinct intervals are held."""

    def place(groups: list, o: object, s: int, e: int) -> None:
        for g in groups:
            if any(_alike(s, e, p, q, share) for p, q in g[1]):
                g[1].add((s, e))
                g[2] += 1
                return
        groups.append([o, {(s, e)}, 1])

    return _in_order(rows, keys, order, place, lambda groups: [(o, min(s for s, _ in m), max(e for _, e in m), k) for o, m, k in groups], n)


def absorbed(rows: DataFrame, keys: list[str], order: str, share: float = 0.5, n: int | None = None) -> DataFrame:
    """C14, then: in order, each row that nothing has taken in yet opens a group and takes in all later ones that are alike.

    Rows are held against openers, not against groups, whose bounds move. Arguments and result as for joined; a component's openers are held."""

    def place(groups: list, o: object, s: int, e: int) -> None:
        for g in groups:
            if _alike(s, e, g[1], g[2], share):
                g[3], g[4], g[5] = min(g[3], s), max(g[4], e), g[5] + 1
                return
        groups.append([o, s, e, s, e, 1])

    return _in_order(rows, keys, order, place, lambda groups: [(o, s, e, k) for o, _, _, s, e, k in groups], n)


def domain_groups(rows: DataFrame, keys: list[str], order: str, n: int | None = None) -> DataFrame:
    """C14: domain hits (keys, order, s, e in residues) as groups in bases of the coding sequence: joined, then absorbed; the column n counts what was absorbed. n: how many rows, as for merge."""
    # written, as its components and its rows are both asked for
    first = stored(joined(rows, keys, order, n=n).withColumns({"s": F.col("s") * 3 - 2, "e": F.col("e") * 3}))
    return absorbed(first, keys, order, n=n)
