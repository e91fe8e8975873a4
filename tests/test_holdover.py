"""Clusters from a stream of chunks equal those of the whole table, over a restart too."""

import os
import random

import pyarrow as pa
import pyarrow.parquet as pq
import pytest

from locusframe.session import ship
from locusframe.streaming import holdover

SCHEMA = pa.schema([("seqid", pa.int64()), ("strand", pa.int32()), ("chunk", pa.int64()), ("upto", pa.int64()), ("id", pa.string()), ("s", pa.int64()), ("e", pa.int64()), ("score", pa.float64())])
STORE = "spark.sql.streaming.stateStore.providerClass"


@pytest.fixture()
def rocks(spark):
    ship(spark)
    spark.conf.set(STORE, "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
    yield spark
    spark.conf.unset(STORE)


def chunked_hits(n, size, contigs):
    r = random.Random(4)
    rows = [(c, st, (s - 1) // size, ((s - 1) // size + 1) * size, f"h{i}", s, s + r.randrange(1, 60), float(r.randrange(0, 9))) for i in range(n) for c, st, s in [(r.choice(contigs), r.choice([1, -1]), r.randrange(1, 1500))]]
    rows += [(9, 1, k, (k + 1) * size, f"long{k}", k * size + 1, (k + 1) * size + 5, 1.0) for k in range(1500 // size)]  # one cluster over all chunks
    rows += [(9, 1, 0, size, f"hot{i}", 1 + i % 7, 30 + i % 11, float(i % 13)) for i in range(400)]
    last = max(x[2] for x in rows)
    rows += [(c, st, last + 1, (last + 2) * size, None, None, None, None) for c, st in {x[:2] for x in rows}]
    return rows


@pytest.mark.parametrize("flank", [0, 7])
def test_stream_equals_batch(rocks, tmp_path, flank):
    columns = [x.split()[0] for x in holdover.HITS.split(", ")]
    rows = chunked_hits(500, 100, [1, 2])
    folder, out, state = (str(tmp_path / x) for x in ("in", "out", "state"))
    os.makedirs(folder)
    chunks = sorted({x[2] for x in rows})

    def put(k):
        part = pa.Table.from_pylist([dict(zip(columns, x, strict=True)) for x in rows if x[2] == k], schema=SCHEMA)
        path = f"{folder}/chunk-{k:05d}.parquet"
        pq.write_table(part, path + ".tmp")
        os.utime(path + ".tmp", (1_700_000_000 + k, 1_700_000_000 + k))
        os.rename(path + ".tmp", path)

    def run():
        stream = holdover.clusters_stream(rocks, folder, 3, flank)
        stream.writeStream.format("parquet").option("checkpointLocation", state).trigger(availableNow=True).start(out).awaitTermination(240)

    for some in (chunks[:6], chunks[6:]):  # the second run is a restart from the checkpoint
        for k in some:
            put(k)
        run()
    whole = rocks.createDataFrame(rows, holdover.HITS)
    want = sorted(tuple(x) for x in holdover.clusters_of(whole, 3, flank).collect())
    got = sorted(tuple(x) for x in rocks.read.schema(holdover.OUT).parquet(out).collect())
    assert len(want) > 20
    assert got == want
