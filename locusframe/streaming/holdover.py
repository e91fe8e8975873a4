"""Clusters from a stream of hits, chunk after chunk; what may still grow is held over to the next chunk.

Hits come as files of chunks, in order of chunks. A cluster is a merged piece of a key's hits (touching ones, widened by flank, are one),
and of each only the first `depth` hits by score are kept, trimmed while they come in. A cluster is given out once a
chunk shows that nothing more can reach it: the state of a key is one open cluster, of `depth` hits at most. Every chunk tells how far it goes
(`upto`) to all keys that it has hits of; a key's last cluster is given out at the contig's end, which is told by a row
without a hit. The state is kept between micro-batches and restarts by Spark's checkpoint. A task holds the hits
that one chunk has of a key, to sort them. A chunk that comes after a later one is an error.

The rows are those of the batch form `clusters_of` over all hits, whatever the files.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from locusframe.operators.intervals import islands

#: Rows of chunks: id is null where a contig ends.
HITS = "seqid long, strand int, chunk long, upto long, id string, s long, e long, score double"
OUT = "seqid long, strand int, cluster_s long, cluster_e long, n long, id string, s long, e long, score double"
HELD = "first long, last long, n long, upto long, ids array<string>, ss array<long>, es array<long>, scores array<double>"


def clusters_of(hits: DataFrame, depth: int, flank: int = 0) -> DataFrame:
    """The same of a whole table."""
    keys = ["seqid", "strand"]
    labelled = islands(hits.where("id is not null"), keys, flank, "_piece")
    whole = Window.partitionBy(*keys, "_piece")
    ranked = labelled.withColumns({"cluster_s": F.min("s").over(whole), "cluster_e": F.max("e").over(whole), "n": F.count("*").over(whole), "_rank": F.row_number().over(whole.orderBy(F.desc("score"), "id"))})
    return ranked.where(F.col("_rank") <= depth).select("seqid", "strand", "cluster_s", "cluster_e", "n", "id", "s", "e", "score")


class HoldOver(StatefulProcessor):
    """One key's open cluster: its bounds, its count, and its first hits."""

    def __init__(self, depth: int, flank: int):
        self.depth, self.flank = depth, flank

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.held = handle.getValueState("open", HELD)

    def handleInputRows(self, key: tuple, rows: Iterator[pd.DataFrame], timerValues: object) -> Iterator[pd.DataFrame]:
        seqid, strand = key
        got = pd.concat(list(rows), ignore_index=True)
        open_: dict | None = None
        done = -1
        if self.held.exists():
            first, last, n, done, *lists = self.held.get()
            best = list(zip(*(list(x) for x in lists), strict=True))
            open_ = {"first": first, "last": last, "n": n, "best": best} if n else None
        hits = got[got["id"].notna()].sort_values(["s", "e", "id"])
        if len(hits) and int(hits["chunk"].min()) <= done:
            raise ValueError("a chunk has come after a later one")
        out: list[tuple] = []

        def close() -> None:
            if open_:
                best = sorted(open_["best"], key=lambda x: (-x[3], x[0]))[:self.depth]
                out.extend((seqid, strand, open_["first"], open_["last"], open_["n"], i, s, e, score) for i, s, e, score in best)

        for i, s, e, score in zip(hits["id"], hits["s"].tolist(), hits["e"].tolist(), hits["score"].tolist(), strict=True):
            if open_ and s - self.flank <= open_["last"] + self.flank + 1:
                open_["last"], open_["n"] = max(open_["last"], e), open_["n"] + 1
                open_["best"].append((i, s, e, score))
            else:
                close()
                open_ = {"first": s, "last": e, "n": 1, "best": [(i, s, e, score)]}
            if len(open_["best"]) >= 20 * self.depth:
                open_["best"] = sorted(open_["best"], key=lambda x: (-x[3], x[0]))[:self.depth]
        over = bool(got["id"].isna().any())
        reach = int(got["upto"].max())
        if open_ and (over or open_["last"] + 2 * self.flank + 1 <= reach):  # no later hit begins early enough
            close()
            open_ = None
        if over:
            self.held.clear()
        else:
            best = sorted(open_["best"], key=lambda x: (-x[3], x[0]))[:self.depth] if open_ else []
            lists = [list(x) for x in zip(*best, strict=True)] if best else [[], [], [], []]
            self.held.update((open_["first"] if open_ else 0, open_["last"] if open_ else 0, open_["n"] if open_ else 0, max(done, int(got["chunk"].max())), *lists))
        yield pd.DataFrame(out, columns=["seqid", "strand", "cluster_s", "cluster_e", "n", "id", "s", "e", "score"])

    def close(self) -> None:
        pass


def clusters_stream(spark: SparkSession, folder: str, depth: int, flank: int = 0) -> DataFrame:
    """Finished clusters from a folder of Parquet files in the form HITS, a chunk a file, taken in order of arrival. Needs the RocksDB state store."""
    rows = spark.readStream.schema(HITS).option("maxFilesPerTrigger", 1).parquet(folder)
    return rows.groupBy("seqid", "strand").transformWithStateInPandas(HoldOver(depth, flank), OUT, "Append", "None")
