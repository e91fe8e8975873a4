"""Views of the driver's tables in the shapes of the interval engine.

Every view is a projection or a key join of its table, so it is as large as the table and is
split as the table is. Ids are text built from the row's key columns, the same in any engine.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: The same views for DuckDB, as common table expressions by name; later ones may use earlier ones.
CTES = {
    "feat": """feat AS (SELECT concat_ws('-', l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity::BIGINT, round(l_extendedprice * 100)::BIGINT, date_diff('day', DATE '1992-01-01', l_shipdate::DATE)) AS id,
      l_partkey AS seqid, l_suppkey AS sup, l_orderkey AS okey, (date_diff('day', DATE '1992-01-01', l_shipdate::DATE) + 1)::BIGINT AS s, (date_diff('day', DATE '1992-01-01', l_shipdate::DATE) + l_quantity::BIGINT)::BIGINT AS e,
      CASE WHEN l_linestatus = 'O' THEN 1 ELSE -1 END AS strand, l_returnflag AS source, l_extendedprice AS score FROM lineitem)""",
    "feat_q": "feat_q AS (SELECT id, seqid, sup, okey, 30 * ((s - 1) // 30) + 1 AS s, 30 * ((e - 1) // 30) + 30 AS e, strand, source, score FROM feat)",
    "hsps": "hsps AS (SELECT seqid * 5 + sup % 5 AS hit, seqid, strand, id, s, e, source, score FROM feat)",
    "hsps_q": "hsps_q AS (SELECT seqid * 5 + sup % 5 AS hit, seqid, strand, id, s, e, source, score FROM feat_q)",
    "hits": "hits AS (SELECT hit, seqid, strand, min(s) AS s, max(e) AS e, count(*) AS n, max(score) AS score, sum(e - s + 1)::BIGINT AS bases FROM hsps GROUP BY hit, seqid, strand)",
    "seqs": "seqs AS (SELECT doc_id AS seqid, source, translate(upper(regexp_replace(text, '[^A-Za-z]', '', 'g')), 'BDEFHIJKLMNOPQRSUVWXYZ', 'ACGTACGTACGTACGTACGTAC') AS seq FROM documents)",
    "attrs": "attrs AS (SELECT o_orderkey AS id, concat('ID=', o_orderkey, ';Parent=', o_custkey, ',', o_custkey + 1, ';Note=', o_orderpriority) AS attr FROM orders)",
    "idmap": "idmap AS (SELECT p_partkey AS old_id, concat('P', lpad(row_number() OVER (ORDER BY p_size DESC, p_partkey)::VARCHAR, 8, '0')) AS new_id FROM part)",
    "edges": """edges AS (SELECT concat('n', n_nationkey) AS subject, concat('r', n_regionkey) AS object FROM nation
      UNION ALL SELECT concat('c', c_custkey), concat('n', c_nationkey) FROM customer UNION ALL SELECT concat('s', s_suppkey), concat('n', s_nationkey) FROM supplier)""",
}


def with_views(names: str, sql: str) -> str:
    """The SQL after the named views; it may go on with a comma and further common table expressions."""
    return "WITH RECURSIVE " + ",\n".join(CTES[n] for n in names.split()) + "\n" + sql if names else sql


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def feat(spark: SparkSession, sf_dir: str, parts: bool = False) -> DataFrame:
    """parts: with the line's number in place of the id. feat_id makes that of the other columns, which take less than the text where rows are shuffled."""
    day = F.datediff(F.to_date("l_shipdate"), F.lit("1992-01-01").cast("date"))
    whole = F.concat_ws("-", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", F.col("l_quantity").cast("long"), F.round(F.col("l_extendedprice") * 100).cast("long"), day).alias("id")
    return _table(spark, sf_dir, "lineitem").select(
        F.col("l_linenumber").alias("line") if parts else whole,
        F.col("l_partkey").alias("seqid"), F.col("l_suppkey").alias("sup"), F.col("l_orderkey").alias("okey"),
        (day + 1).cast("long").alias("s"), (day + F.col("l_quantity").cast("long")).cast("long").alias("e"),
        F.when(F.col("l_linestatus") == "O", 1).otherwise(-1).alias("strand"), F.col("l_returnflag").alias("source"), F.col("l_extendedprice").alias("score"),
    )


def feat_id() -> Column:
    """The id of rows of feat(parts=True) that have s and e."""
    return F.concat_ws("-", "okey", "line", "seqid", "sup", F.col("e") - F.col("s") + 1, F.round(F.col("score") * 100).cast("long"), F.col("s") - 1)


def n_feat(spark: SparkSession, sf_dir: str) -> int:
    """Rows of feat and the views made of it, counted from the files' footers."""
    return _table(spark, sf_dir, "lineitem").count()


def snapped(df: DataFrame, cell: int = 30) -> DataFrame:
    """Starts and ends moved out to the ends of their cells."""
    return df.withColumns({"s": F.expr(f"{cell} * ((s - 1) div {cell}) + 1"), "e": F.expr(f"{cell} * ((e - 1) div {cell}) + {cell}")})


def feat_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    return snapped(feat(spark, sf_dir))


def hsps(spark: SparkSession, sf_dir: str, exact: bool = False) -> DataFrame:
    f = (feat_q if exact else feat)(spark, sf_dir)
    return f.select((F.col("seqid") * 5 + F.col("sup") % 5).alias("hit"), "seqid", "strand", "id", "s", "e", "source", "score")


def hits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per hit and strand with its span."""
    return hsps(spark, sf_dir).groupBy("hit", "seqid", "strand").agg(F.min("s").alias("s"), F.max("e").alias("e"), F.count("*").alias("n"), F.max("score").alias("score"), F.sum(F.col("e") - F.col("s") + 1).alias("bases"))


def seqs(spark: SparkSession, sf_dir: str) -> DataFrame:
    letters = F.upper(F.regexp_replace("text", "[^A-Za-z]+", ""))
    return _table(spark, sf_dir, "documents").select(F.col("doc_id").alias("seqid"), "source", F.translate(letters, "BDEFHIJKLMNOPQRSUVWXYZ", "ACGTACGTACGTACGTACGTAC").alias("seq"))


def attrs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("id"), F.concat(F.lit("ID="), "o_orderkey", F.lit(";Parent="), "o_custkey", F.lit(","), F.col("o_custkey") + 1, F.lit(";Note="), "o_orderpriority").alias("attr"))


def edges(spark: SparkSession, sf_dir: str) -> DataFrame:
    def two(name: str, a: str, key: str, b: str, to: str) -> DataFrame:
        return _table(spark, sf_dir, name).select(F.concat(F.lit(a), key).alias("subject"), F.concat(F.lit(b), to).alias("object"))

    return two("nation", "n", "n_nationkey", "r", "n_regionkey").union(two("customer", "c", "c_custkey", "n", "c_nationkey")).union(two("supplier", "s", "s_suppkey", "n", "s_nationkey"))
