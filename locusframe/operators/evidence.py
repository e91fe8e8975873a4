"""Evidence by algorithm and cluster, and as hints for predictors."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def selected(algorithm: Column, names: list[str]) -> Column:
    """Whether an algorithm is one of the names: itself, with parameters behind a colon, masked, or run by exonerate."""
    any_ = "|".join(re.escape(n.lower()) for n in names)
    return F.lower(algorithm).rlike(f"^({any_})(:.*|_masked)?$|exonerate::({any_})$")


def purged(rows: DataFrame, cluster: list[str], bad: Column, prediction: Column) -> DataFrame:
    """F8: rows without bad ones; predictions stay only in clusters in which other evidence is left."""
    good = rows.where(~bad)
    left = good.where(~prediction).select(*cluster).distinct()
    return good.where(~prediction).unionByName(good.where(prediction).join(left, cluster, "left_semi").select(*good.columns))


def hints(coding: DataFrame, introns: DataFrame, exons: DataFrame, keys: list[str], shortest: int = 25) -> DataFrame:
    """Text lines for a predictor. Coding parts have priority 2, introns 3 (short ones go), exon parts 1; these need introns on their keys."""
    strand = F.when(F.col("strand") > 0, "+").otherwise("-")

    def lines(df: DataFrame, source: str, kind: str, priority: str) -> DataFrame:
        return df.select(F.concat_ws("\t", F.col("seqid").cast("string"), F.lit(source), F.lit(kind), F.col("s").cast("string"), F.col("e").cast("string"), F.lit("0"), strand, F.lit("."), F.lit(priority)).alias("value"))

    known = introns.select(*keys).distinct()
    return (
        lines(coding, "PROTEIN", "CDSpart", "source=P;pri=2").union(lines(introns.where(F.col("e") - F.col("s") >= shortest), "EST-INTRON", "intron", "source=E;pri=3"))
        .union(lines(exons.join(known, keys, "left_semi"), "EST-EXON", "exonpart", "source=E;pri=1"))
    )
