"""Column functions that compare hits by their blocks: arrays of structs with s and e, in order.

Codes are those of `intervals.classify`; a block's code against several blocks is the first that tells
most (1, then A, B, a or b), and 0 where none of these occurs."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from locusframe.operators.intervals import classify, code_value


def codes(blocks: Column, against: Column, slack: int = 0) -> Column:
    """One code for each block."""

    def best(p: Column) -> Column:
        def better(found: Column, q: Column) -> Column:
            code = classify(p["s"], p["e"], q["s"], q["e"], slack)
            return F.when(code_value(code) > code_value(found), code).otherwise(found)

        return F.aggregate(against, F.lit("0"), better)

    return F.array_join(F.transform(blocks, best), "")


def pieces(a: Column, b: Column) -> Column:
    """The merged pieces of two lists of blocks; touching blocks join."""
    spans = F.array_sort(F.transform(F.concat(a, b), lambda x: F.struct(x["s"].alias("s"), x["e"].alias("e"))))

    def step(done: Column, x: Column) -> Column:
        last = F.element_at(done, -1)
        longer = F.concat(F.slice(done, 1, F.size(done) - 1), F.array(F.struct(last["s"].alias("s"), F.greatest(last["e"], x["e"]).alias("e"))))
        return F.when((F.size(done) > 0) & (x["s"] <= F.try_element_at(done, F.lit(-1))["e"] + 1), longer).otherwise(F.concat(done, F.array(x)))

    return F.aggregate(spans, F.expr("cast(array() as array<struct<s: bigint, e: bigint>>)"), step)


def shadows(a: Column, b: Column, slack: int = 0) -> tuple[Column, Column]:
    """C0d, C0e: the codes of both hits' merged pieces against each hit."""
    p = pieces(a, b)
    return codes(p, a, slack), codes(p, b, slack)


def same_codes(of_a: Column, of_b: Column, own: Column) -> Column:
    """C0f of hits with equally many blocks: whether they are one alternative form, by their shadows and a's codes against b."""
    hole = "[^0]0+[^0]"
    return F.when((of_a == of_b) & ~own.rlike("^0+$"), True).when(of_a.rlike(hole) | of_b.rlike(hole) | own.rlike("^0+$"), False).otherwise(True)


def redundant_codes(of_a: Column, of_b: Column, ab: Column, ba: Column) -> Column:
    """C0g: whether hit a says nothing that b doesn't, by their shadows and their codes against each other."""
    return ((of_a == of_b) & ~ab.rlike("^0*$")) | (ba.rlike("^B?1+b?$") & ab.rlike("^0*A?1+a?0*$"))


def same_form(a: Column, b: Column, of_a: Column, of_b: Column, slack: int = 0) -> Column:
    """C0f: whether two hits are one alternative form; of_a and of_b are their shadows."""
    return F.when(F.size(a) != F.size(b), False).otherwise(same_codes(of_a, of_b, codes(a, b, slack)))


def redundant_form(a: Column, b: Column, of_a: Column, of_b: Column, slack: int = 0) -> Column:
    """C0g: whether hit a says nothing that b doesn't."""
    return redundant_codes(of_a, of_b, codes(a, b, slack), codes(b, a, slack))


def _flat(blocks: pa.ListArray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Blocks of all rows: where each row's begin (and the last end), starts, ends. A block without a start or an end meets nothing: it ends before it starts."""
    at = blocks.offsets.to_numpy().astype(np.int64)
    x = blocks.values.slice(at[0], at[-1] - at[0])
    s, e = (x.field(c).to_numpy(zero_copy_only=False) for c in ("s", "e"))
    known = np.asarray(x.field("s").is_valid()) & np.asarray(x.field("e").is_valid())
    return at - at[0], np.where(known, s, 0).astype(np.int64), np.where(known, e, -1).astype(np.int64)


def _pieces(rows: int, a: tuple, b: tuple) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The merged pieces of each row's blocks in a and b, as _flat."""
    row = np.concatenate([np.repeat(np.arange(rows), np.diff(x[0])) for x in (a, b)])
    s, e = np.concatenate([a[1], b[1]]), np.concatenate([a[2], b[2]])
    order = np.lexsort((e, s, row))
    row, s, e = row[order], s[order], e[order]
    if not len(s):
        return np.zeros(rows + 1, np.int64), s, e
    # rows lie behind one another, so that one running maximum serves all
    low = min(int(s.min()), int(e.min()))
    wide = int(e.max()) - low + 3
    before = np.maximum.accumulate(np.concatenate([[-1], (e - low + row * wide)[:-1]]))
    new = s - low + row * wide > before + 1
    new |= np.concatenate([[True], row[1:] != row[:-1]]) | (e < s)
    at = np.flatnonzero(new)
    return np.concatenate([[0], np.cumsum(np.bincount(row[at], minlength=rows))]), s[at], np.maximum.reduceat(e, at)


#: Fixed value: the codes that count, by number.
_LETTERS = np.frombuffer(b"01BAba", np.uint8)


def _codes(p: tuple, q: tuple) -> pa.StringArray:
    """`codes` of each row's blocks in p against its blocks in q."""
    (at, s, e), (qat, qs, qe) = p, q
    times = np.repeat(np.diff(qat), np.diff(at))
    first = np.repeat(qat[:-1], np.diff(at))
    ends = np.cumsum(times)
    i = np.repeat(np.arange(len(s)), times)
    j = np.arange(len(i)) - np.repeat(ends - times, times) + np.repeat(first, times)
    x, y, u, v = s[i], e[i], qs[j], qe[j]
    met = (v >= x) & (u <= y) & (x <= y) & (u <= v)
    # only codes that count: the same ends, then one end in common
    code = np.select([~met, (x == u) & (y == v), (u < x) & (y == v), (x < u) & (y == v), (x == u) & (y < v), (x == u) & (y > v)], [0, 1, 2, 3, 4, 5], 0)
    value = np.where(code == 1, 2, np.where(code > 0, 1, 0))
    out = np.zeros(len(s), np.int64)
    some = np.flatnonzero(times)
    if len(some):
        # the first of the highest value
        n = len(i)
        best = np.maximum.reduceat(value * (n + 1) + n - np.arange(n), (ends - times)[some])
        out[some] = code[n - best % (n + 1)]
    return pa.StringArray.from_buffers(len(at) - 1, pa.py_buffer(at.astype(np.int32)), pa.py_buffer(_LETTERS[out].tobytes()))


def compared(pairs: DataFrame, keep: list[str]) -> DataFrame:
    """Pairs of hits (a and b: blocks in order, 1-based, starts not behind ends) with all codes that they have to each other: keep, sx and sy (shadows),
    xy and yx (codes of a against b, and of b against a). The blocks of an Arrow batch are compared at once."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t in batches:
            if t.num_rows:
                a, b = _flat(t["a"]), _flat(t["b"])
                both = _pieces(t.num_rows, a, b)
                yield pa.RecordBatch.from_arrays([*(t[c] for c in keep), _codes(both, a), _codes(both, b), _codes(a, b), _codes(b, a)], [*keep, "sx", "sy", "xy", "yx"])

    schema = pairs.select(*keep).schema
    for c in ("sx", "sy", "xy", "yx"):
        schema = schema.add(c, "string")
    return pairs.select(*keep, *(c for c in ("a", "b") if c not in keep)).mapInArrow(run, schema)
