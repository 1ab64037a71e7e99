"""Operator 13, conversation prefix trie: family-first merging.

A family is a base conversation and those that branch from it. Turns come together by family, the
conversations are rebuilt and the family's own small trie is built in its task; what is shuffled
from there are the trie's nodes, one a family instead of one a conversation, and no text: a turn is
its length in bytes and a 128-bit hash, a node the hash of its parent's and its last turn's.

Nodes are merged by hash. A node of one family has all of its subtree in that family, so its figures
are final as the family states them. For the others, children are counted and what hangs below them
in single families is summed by parent; each then gives its figures to the family of its smallest
member, which passes them up its own path, and the paths' sums are added by node. Members that end
at a node are written out by ranges of ids (at most `SPAN` each) and digested in order, as a stream.

The one join by parent, which would put all children of the root in one task, looks up nodes with
many members in a broadcast table of proven size (at most `HOT` nodes have so many).

Turns are ordered by number, null first, then by role and by the hash of their text. Null roles and
texts are empty. Rows without a conv_id belong to no conversation and make no node. A turn that
occurs twice is two turns. An empty table has no root. Other columns are ignored. A family is the
work of one task, without its texts.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from docketflow.llm.common import forget, written

SPAN = 8192
HOT = 100_000
ROOT = bytes(16)


def turns(conversations: DataFrame, base: Column, shared: Column) -> DataFrame:
    """One row per turn: its family, conversation, place, and mark (128 bits of its role and text)."""
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    mark = F.unhex(F.substring(F.sha2(F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text), 256), 1, 32))
    rows = conversations.filter("conv_id IS NOT NULL")
    return rows.select(base.cast("long").alias("family"), F.col("conv_id").cast("long").alias("conv_id"), shared.cast("long").alias("shared"), F.col("turn").alias("turn"), role.alias("role"), mark.alias("mark"), F.octet_length(text).cast("long").alias("bytes"))


def _family(t: pa.Table) -> pa.Table:
    """The trie of one family; its children, leaves and saved bytes count this family alone."""
    by = [("conv_id", "ascending"), ("turn", "ascending"), ("role", "ascending"), ("mark", "ascending")]
    t = t.take(pc.sort_indices(t, sort_keys=by, null_placement="at_start"))
    family = t["family"][0].as_py()
    own: dict[int, list[tuple[bytes, int]]] = {}
    branch: dict[int, int] = {}
    for conv, shared, mark, size in zip(*(t[c].to_pylist() for c in ("conv_id", "shared", "mark", "bytes")), strict=True):
        own.setdefault(conv, []).append((mark, size))
        branch[conv] = shared
    nodes: dict[bytes, list] = {}  # parent, depth, smallest member, members, bytes, children, leaves, saved, ends
    for conv, mine in own.items():  # in ascending order
        key, parent, size, h = ROOT, None, 0, branch[conv]
        rebuilt = own.get(family, [])[:h] + mine[h:]
        for depth in range(len(rebuilt) + 1):
            if depth:
                mark, size = rebuilt[depth - 1]
                parent, key = key, hashlib.blake2b(key + mark, digest_size=16).digest()
            nodes.setdefault(key, [parent, depth, conv, 0, size, 0, 0, 0, []])[3] += 1
        nodes[key][8].append(conv)
    for node in reversed(nodes.values()):  # children come after their parents
        node[6] = node[6] or 1
        node[7] += (node[3] - 1) * node[4]
        if node[0] is not None:
            above = nodes[node[0]]
            above[5] += 1
            above[6] += node[6]
            above[7] += node[7]
    columns = list(zip(*nodes.values(), strict=True))
    parents = [None if p is None else nodes[p][2] for p in columns[0]]
    kinds = [pa.binary(), *[pa.int64()] * 7, pa.list_(pa.int64())]
    arrays = [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)]
    return pa.Table.from_arrays([pa.array([family] * len(nodes), pa.int64()), pa.array(list(nodes), pa.binary()), pa.array(parents, pa.int64()), *arrays], names=["family", "key", "parent_conv_id", "parent", "depth", "conv_id", "n", "bytes", "children", "leaves", "saved", "ends"])


def families(rows: DataFrame) -> DataFrame:
    """The nodes of every family's trie."""
    shape = "family long, key binary, parent_conv_id long, parent binary, depth long, conv_id long, n long, bytes long, children long, leaves long, saved long, ends array<long>"
    return rows.groupBy("family").applyInArrow(_family, shape)


def _upwards(path: pa.Table, given: pa.Table) -> pa.Table:
    """What the nodes given to a family add to each node above them and to themselves."""
    sums = {k: (x, y) for k, x, y in zip(*(given[c].to_pylist() for c in ("key", "leaves", "saved")), strict=True)}
    if sums:
        at = sorted(zip(*(path[c].to_pylist() for c in ("depth", "key", "parent")), strict=True), key=lambda x: -x[0])
        for _, key, parent in at:
            if key in sums and parent is not None:
                x, y = sums.get(parent, (0, 0))
                sums[parent] = x + sums[key][0], y + sums[key][1]
    return pa.table({"key": pa.array(list(sums), pa.binary()), "leaves": pa.array([x for x, _ in sums.values()], pa.int64()), "saved": pa.array([y for _, y in sums.values()], pa.int64())})


def digests(ends: DataFrame) -> DataFrame:
    """SHA-256 of the comma-joined ids of each key, ascending: joined by ranges of ids, then digested as a stream."""
    ranges = ends.groupBy("key", F.floor(F.col("conv_id") / SPAN).alias("range")).agg(F.array_join(F.transform(F.sort_array(F.collect_list("conv_id")), lambda x: x.cast("string")), ",").alias("ids"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, state = None, None

        def made(keys: list, shas: list) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(keys, pa.binary()), pa.array(shas, pa.string())], ["key", "ends_sha256"])

        for b in batches:
            keys, shas = [], []
            for key, ids in zip(b.column(0).to_pylist(), b.column(2).to_pylist(), strict=True):
                if key == last:
                    state.update(b",")
                else:
                    if last is not None:
                        keys.append(last)
                        shas.append(state.hexdigest())
                    last, state = key, hashlib.sha256()
                state.update(ids.encode())
            yield made(keys, shas)
        if last is not None:
            yield made([last], [state.hexdigest()])

    return ranges.repartition("key").sortWithinPartitions("key", "range").mapInArrow(run, "key binary, ends_sha256 string")


def trie(conversations: DataFrame, base: Column, shared: Column) -> DataFrame:
    """Nodes of the trie of all conversations, each rebuilt as the first `shared` turns of `base` and its own later ones."""
    nodes = written(families(turns(conversations, base, shared)), "trie-families")
    first = [F.first(c).alias(c) for c in ("parent", "parent_conv_id", "depth", "bytes", "children", "leaves", "saved")]
    merged = nodes.groupBy("key").agg(F.min("conv_id").alias("conv_id"), F.sum("n").alias("n"), (F.count("*") > 1).alias("common"), F.min_by("family", "conv_id").alias("family"), *first)
    merged = written(merged, "trie-nodes")

    # Nodes of several families: their children, what hangs below them in single families, and their own.
    below = merged.filter("parent IS NOT NULL").groupBy(F.col("parent").alias("key")).agg(F.count("*").alias("children"), F.sum(F.when(~F.col("common"), F.col("leaves"))).alias("leaves"), F.sum(F.when(~F.col("common"), F.col("saved"))).alias("saved"))
    zero = F.lit(0).cast("long")
    common = merged.filter("common").drop("children", "leaves", "saved").join(below, "key", "left").withColumn("children", F.coalesce("children", zero))
    leaves = F.when(F.col("children") == 0, F.lit(1).cast("long")).otherwise(F.coalesce("leaves", zero))
    common = written(common.withColumns({"leaves": leaves, "saved": F.coalesce("saved", zero) + (F.col("n") - 1) * F.col("bytes")}), "trie-common")
    paths = nodes.select("family", "key", "parent", "depth").groupBy("family")
    sums = paths.cogroup(common.select("family", "key", "leaves", "saved").groupBy("family")).applyInArrow(_upwards, "key binary, leaves long, saved long")
    sums = sums.groupBy("key").agg(F.sum("leaves").alias("leaves"), F.sum("saved").alias("saved"))
    common = written(common.drop("leaves", "saved").join(sums, "key"), "trie-summed")

    # The smallest member of each parent: its family's, unless the parent is a node of several.
    out = ["key", "conv_id", "depth", "parent", "parent_conv_id", "n", "children", "leaves", "saved"]
    rows = merged.filter("NOT common").select(*out).union(common.select(*out))
    members = merged.agg(F.sum("n")).first()[0] or 0
    upper = common.select(F.col("key").alias("parent"), F.col("conv_id").alias("upper"), (F.col("n") > members // HOT).alias("hot"))
    hot = F.broadcast(upper.filter("hot").select("parent", F.col("upper").alias("hot_upper")))  # fewer than HOT nodes have so many members
    rows = rows.join(hot, "parent", "left")
    cold = rows.filter("hot_upper IS NULL").join(upper.filter("NOT hot").select("parent", "upper"), "parent", "left")
    rows = rows.filter("hot_upper IS NOT NULL").withColumn("upper", F.col("hot_upper")).unionByName(cold)
    shas = digests(nodes.select("key", F.explode("ends").alias("conv_id")))
    rows = rows.join(shas, "key", "left")
    above = F.when(F.col("depth") > 0, F.coalesce("upper", "parent_conv_id"))
    rows = rows.select("conv_id", "depth", above.alias("parent_conv_id"), F.col("n").alias("n_convs"), F.col("children").alias("n_children"), F.col("leaves").alias("n_leaves"), F.col("saved").alias("saved_tokens"), F.coalesce("ends_sha256", F.lit(hashlib.sha256().hexdigest())).alias("ends_sha256"))
    rows = written(rows, "trie")
    forget(nodes, merged, common)
    return rows


def op13_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The prefix trie of all conversations, each branching from the one at the multiple of five before it."""
    conv = F.col("conv_id")
    return trie(spark.read.parquet(f"{sf_dir}/conversations.parquet"), conv - conv % 5, F.crc32(conv.cast("string")) % 9)


OP13 = """
WITH crc AS (SELECT list_transform(range(256), lambda i: list_reduce(list_concat([i], [0, 0, 0, 0, 0, 0, 0, 0]), lambda c, z: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)) AS t),
o AS (SELECT conv_id AS c, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) AS i, md5(coalesce(role, '')) || md5(coalesce(text, '')) AS mark, strlen(coalesce(text, '')) AS b FROM conversations WHERE conv_id IS NOT NULL),
ids AS (SELECT c, len, xor(list_reduce(list_concat([4294967295], list_transform(string_split(c::VARCHAR, ''), lambda x: ascii(x)::BIGINT)), lambda a, b: xor(a >> 8, t[1 + (xor(a, b) & 255)])), 4294967295) % 9 AS h FROM (SELECT c, max(i) AS len FROM o GROUP BY c), crc),
r AS (SELECT ids.c, o.i AS d, o.mark, o.b FROM ids JOIN o ON o.c = ids.c - ids.c % 5 AND o.i <= ids.h
      UNION ALL SELECT ids.c, least(ids.h, coalesce(base.len, 0)) + o.i - ids.h, o.mark, o.b FROM ids JOIN o ON o.c = ids.c AND o.i > ids.h LEFT JOIN ids base ON base.c = ids.c - ids.c % 5),
p AS (SELECT c, d, md5(string_agg(mark, '') OVER (PARTITION BY c ORDER BY d)) AS k, b FROM r UNION ALL SELECT c, 0, '', 0 FROM ids),
q AS (SELECT *, lag(k) OVER (PARTITION BY c ORDER BY d) AS up, d = max(d) OVER (PARTITION BY c) AS stops FROM p),
n AS (SELECT k, d, min(c) AS c, any_value(up) AS up, count(*) AS n, any_value(b) AS b, coalesce(string_agg(c::VARCHAR, ',' ORDER BY c) FILTER (WHERE stops), '') AS ends FROM q GROUP BY k, d),
kids AS (SELECT up AS k, count(*) AS kids FROM n WHERE d > 0 GROUP BY up),
f AS (SELECT n.*, coalesce(kids, 0) AS kids FROM n LEFT JOIN kids USING (k)),
s AS (SELECT q.k, sum((f.n - 1) * f.b) AS saved, count(*) FILTER (WHERE f.kids = 0) AS leaves FROM f JOIN q ON q.c = f.c AND q.d <= f.d GROUP BY q.k)
SELECT f.c AS conv_id, f.d AS depth, above.c AS parent_conv_id, f.n AS n_convs, f.kids AS n_children, s.leaves AS n_leaves, s.saved::BIGINT AS saved_tokens, sha256(f.ends) AS ends_sha256
FROM f JOIN s USING (k) LEFT JOIN n above ON f.d > 0 AND above.k = f.up
"""

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {"op13_trie": op13_trie}
ORACLE = {"op13_trie": OP13}
