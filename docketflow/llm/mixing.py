"""Operator 6, mixing sources to target weights: weighted fair queueing in virtual time.

Every source is a queue. A source's documents are shuffled by the md5 of their id and served in
that order, twice at most; the virtual finish time of what is served is the words of its source
served up to its end, divided by the source's target. All sources' queues are put into one order of
virtual finish times and the order is cut where the words before reach the total budget.

What is served at a time is a packet. A document's copy is one packet, but where it lies across
virtual time 1, about which the budget ends, it is two, parted after its last word that finishes by
then. So sources meet their targets to the word, however long their documents.

Targets: sources in code-point order, null last, weigh 5, 2, 1, repeating, and share 150 % of all
words; none exceeds twice its source's words, the excess is shared by weight again. That is
water-filling, solved in closed form over one row per source. The budget is the sum of the targets
in whole words.

Both running sums are two-level: sums by range, a window over those few rows, then a window inside
each range. Within a source, ranges are of the md5, as many as the source's rows need; in the one
order, they are of virtual time, so that a task gets a stretch of the schedule. A source with a
third of all rows is spread over all tasks. Only ids and sizes are shuffled, never text. DataFrame
functions only.

A null text has size 0. Documents of size 0 are never taken and have no virtual finish time.
Repeated rows count as rows of their own. An empty table gives an empty result. Other columns of
the input are ignored by `schedule`.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from docketflow.llm.common import WORD, measured_small, small_enough, written

WEIGHTS = (5.0, 2.0, 1.0)
SHARE = 1.5
MOST = 2
RANGE_ROWS = 500


def sized(docs: DataFrame, id_col: str = "doc_id", source_col: str = "source", text_col: str = "text", row: Column | None = None) -> DataFrame:
    """doc_id, source, size and the shuffle position of every row, and a key `row` if given."""
    key = F.md5(F.coalesce(F.col(id_col).cast("string"), F.lit("")).cast("binary"))
    size = F.coalesce(F.regexp_count(F.col(text_col), F.lit(WORD)), F.lit(0)).cast("long")
    return docs.select(F.col(id_col).alias("doc_id"), F.col(source_col).alias("source"), size.alias("size"), key.alias("at"), *([] if row is None else [row.alias("row")]))


def targets(rows: DataFrame) -> DataFrame:
    """One row per source: src, none (whether the source is null), rows, source_size, target, budget (of all sources)."""
    src = rows.groupBy(F.coalesce("source", F.lit("")).alias("src"), F.col("source").isNull().alias("none")).agg(F.sum("size").alias("source_size"), F.count("*").alias("rows"))
    # One row per source from here on, as code-point rank and water level concern all sources at once.
    rank = F.row_number().over(W.orderBy("none", "src")) - 1
    weight = F.when(rank % 3 == 0, WEIGHTS[0]).when(rank % 3 == 1, WEIGHTS[1]).otherwise(WEIGHTS[2])
    src = src.withColumn("w", weight).withColumn("cap", MOST * F.col("source_size").cast("double")).withColumn("r", F.col("cap") / F.col("w"))
    before = W.orderBy("r", "none", "src").rowsBetween(W.unboundedPreceding, -1)
    capped, lighter = F.coalesce(F.sum("cap").over(before), F.lit(0.0)), F.coalesce(F.sum("w").over(before), F.lit(0.0))
    words, weights = F.sum("source_size").over(W.partitionBy()).cast("double"), F.sum("w").over(W.partitionBy())
    src = src.withColumn("level", (SHARE * words - capped) / (weights - lighter))
    level = F.max(F.when(F.col("level") <= F.col("r"), F.col("level"))).over(W.partitionBy())
    src = src.select("src", "none", "rows", "source_size", F.coalesce(F.least(F.col("cap"), level * F.col("w")), F.col("cap")).alias("target"))
    return src.withColumn("budget", F.sum(F.floor("target")).over(W.partitionBy()))


def schedule(docs: DataFrame, id_col: str = "doc_id", source_col: str = "source", text_col: str = "text", row: Column | None = None) -> DataFrame:
    """doc_id, (row,) source, size, source_size, target, served (words of its source before it in a pass),
    taken (words the mix takes) and virtual_finish (of its first copy)."""
    own = [] if row is None else ["row"]
    rows = written(sized(docs, id_col, source_col, text_col, row), "mix").withColumns({"src": F.coalesce("source", F.lit("")), "none": F.col("source").isNull()})
    sources = written(targets(rows), "mix-targets")
    rows = rows.join(F.broadcast(sources) if measured_small(sources) else sources, ["src", "none"])

    keys = ["doc_id", *own, "source", "size", "source_size", "target"]
    empty = rows.filter("size = 0").select(*keys, F.lit(None).cast("long").alias("served"), F.lit(0).cast("long").alias("taken"), F.lit(None).cast("double").alias("virtual_finish"))

    # Each source's queue.
    share = F.conv(F.substring("at", 1, 8), 16, 10).cast("double") / 2**32
    rows = rows.filter("size > 0").withColumn("range", F.floor(share * (1 + F.floor(F.col("rows") / RANGE_ROWS))))
    queue = ["src", "none", "range"]
    sums = rows.groupBy(*queue).agg(F.sum("size").alias("s"))
    earlier = sums.withColumn("earlier", F.coalesce(F.sum("s").over(W.partitionBy("src", "none").orderBy("range").rowsBetween(W.unboundedPreceding, -1)), F.lit(0))).drop("s")
    inner = W.partitionBy(*queue).orderBy("at", "doc_id", "size", *own).rowsBetween(W.unboundedPreceding, -1)
    rows = rows.join(earlier, queue).withColumn("served", F.col("earlier") + F.coalesce(F.sum("size").over(inner), F.lit(0)))
    rows = rows.select(*keys, "budget", "served")

    # The one order of all packets.
    start = F.col("served") + F.col("pass") * F.col("source_size")
    end, border = start + F.col("size"), F.floor("target")
    across = (start < border) & (end > border)
    whole = F.struct(end.alias("end"), F.col("size").alias("words"))
    parts = F.array(F.struct(border.alias("end"), (border - start).alias("words")), F.struct(end.alias("end"), (end - border).alias("words")))
    packets = rows.withColumn("pass", F.explode(F.sequence(F.lit(0), F.lit(MOST - 1))))
    packets = packets.withColumn("x", F.explode(F.when(across, parts).otherwise(F.array(whole)))).select("*", "x.*").drop("x", "pass")
    packets = packets.withColumn("finish", F.col("end") / F.col("target"))
    packets = written(packets.withColumn("range", F.floor(_ranges(sources) * (F.col("finish") / (1 + F.col("finish"))))), "mix-packets")
    sums = packets.groupBy("range").agg(F.sum("words").alias("s"))
    earlier = sums.withColumn("earlier", F.coalesce(F.sum("s").over(W.orderBy("range").rowsBetween(W.unboundedPreceding, -1)), F.lit(0))).drop("s")
    inner = W.partitionBy("range").orderBy("finish", "source", "end").rowsBetween(W.unboundedPreceding, -1)
    packets = packets.join(F.broadcast(earlier) if small_enough(earlier, 16) else earlier, "range").withColumn("before", F.col("earlier") + F.coalesce(F.sum("words").over(inner), F.lit(0)))
    packets = packets.withColumn("part", F.greatest(F.lit(0), F.least(F.col("words"), F.col("budget") - F.col("before"))))

    # From packets to documents: `served` tells the rows of a source apart, as all have words.
    out = packets.groupBy(*keys, "served").agg(F.sum("part").alias("taken"))
    return out.withColumn("virtual_finish", (F.col("served") + F.col("size")) / F.col("target")).union(empty)


def _ranges(sources: DataFrame) -> int:
    """An even number of virtual-time ranges, by the number of rows."""
    return 2 + 2 * (int(sources.agg(F.sum("rows")).first()[0] or 0) // RANGE_ROWS)


def op6_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the mix takes of each document."""
    return schedule(spark.read.parquet(f"{sf_dir}/documents.parquet")).select("doc_id", "size", "source_size", "target", "taken")


OP6 = r"""
WITH d AS (SELECT doc_id, coalesce(source, '') AS src, source IS NULL AS no_source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size, md5(coalesce(doc_id::VARCHAR, '')) AS at FROM documents),
s AS (SELECT src, no_source, sum(size)::BIGINT AS source_size FROM d GROUP BY ALL),
w AS (SELECT *, CASE (row_number() OVER (ORDER BY no_source, src) - 1) % 3 WHEN 0 THEN 5.0::DOUBLE WHEN 1 THEN 2.0::DOUBLE ELSE 1.0::DOUBLE END AS w, 2 * source_size::DOUBLE AS cap FROM s),
l AS (SELECT *, cap / w AS r, (1.5::DOUBLE * (sum(source_size) OVER ())::DOUBLE - coalesce(sum(cap) OVER (ORDER BY cap / w, no_source, src ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0::DOUBLE)) / sum(w) OVER (ORDER BY cap / w, no_source, src ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level FROM w),
t AS (SELECT src, no_source, source_size, coalesce(least(cap, (max(CASE WHEN level <= r THEN level END) OVER ()) * w), cap) AS target FROM l),
b AS (SELECT sum(floor(target))::BIGINT AS budget FROM t),
q AS (SELECT row_number() OVER () AS n, d.doc_id, d.src, d.size, t.source_size, t.target, coalesce(sum(d.size) OVER (PARTITION BY d.src, d.no_source ORDER BY d.at, d.doc_id, d.size ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS served FROM d JOIN t ON d.src = t.src AND d.no_source = t.no_source),
c AS (SELECT *, served + pass * source_size AS start FROM q, (VALUES (0), (1)) x(pass) WHERE size > 0),
p AS (SELECT *, CASE WHEN start < target AND start + size > target THEN 1 ELSE size END AS words, unnest(CASE WHEN start < target AND start + size > target THEN generate_series(start + 1, start + size) ELSE [start + size] END) AS stop FROM c),
o AS (SELECT *, coalesce(sum(words) OVER (ORDER BY stop / target, src, stop ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before FROM p),
k AS (SELECT n, sum(greatest(0, least(words, budget - before)))::BIGINT AS taken FROM o, b GROUP BY n)
SELECT doc_id, size, source_size, target, coalesce(taken, 0)::BIGINT AS taken FROM q LEFT JOIN k USING (n)
"""

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {"op6_mixing": op6_mixing}
ORACLE = {"op6_mixing": OP6}
