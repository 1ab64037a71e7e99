"""Operator 4, n-gram Jaccard join: universe partition, pigeonhole, cost-based allocation, exact check.

Two shingle sets of sizes a, b have Jaccard similarity of 0.8 or more exactly when they differ in at
most H = (a + b) / 9 elements. For pairs whose larger set has a size in [2^c, 2^(c+1)) the universe
is hashed into M segments, M > H for the largest such pair. A set's segments are indexed by
content; for small sets (c <= SMALL) so are the one-deletion neighbourhoods of each segment. If a
set spends e+1 steps on a segment (e = 0: equal content, e = 1: at most one element apart, -1: not
looked at) and all its steps number H + 1, then every partner agrees in one of the segments it
looked at. Each set therefore spends its steps where the fewest other sets are: segments nobody
else has cost nothing, and a set that can spend all its steps there has no partner and is left.
What remains is looked up and verified exactly on whole sets.

Equal sets are one node from the start, so groups of copies cost one. Near copies are checked in
rounds, as long as these find links, in each against a few hubs only: every shared segment names one hub, another one each
round, and a node takes those it meets at most segments. The components of the links found leave
only segments where several components meet, and no link between components is lost there: where
few nodes meet, pairs of different components are verified; where many do, the nodes connected by
such segments form a crowd, which is cut by size and hash into blocks, and each pair of blocks whose
sizes can be similar is compared in a task of its own, by an index of tokens. Only links that merge
components leave those tasks. The work of a crowd is quadratic in the texts that the hubs left
unlinked, in the number of comparisons, never in rows.

The index is shuffled as packed arrays, one for each bucket of keys. The rows of a segment that one
task sees often are dealt over the buckets; a marker row tells the others, and such segments are
counted in a second step.

Sets are compared by 64-bit shingle hashes and named by a 64-bit hash of the set. Only segment
hashes are shuffled for all documents; whole sets only for documents with candidates.

Null and empty texts and texts without words have the empty set, linked with nothing, and are
components of their own. Texts are read whole. Repeated rows and repeated ids are kept, one output
row each. A null doc_id is never the smallest of a component unless alone. An empty table gives an
empty result. Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from docketflow.llm.common import SEED, buffers, forget, give_back, mix64, shingle_hashes, small_enough, sub_batches, tidy, unshuffled, word_hashes, written

WIDTH = 5
SMALL = 5
CLASSES = 40
ROUNDS = 2
HUBS = 4  # rounds against hubs, at most
USEFUL = 0.05  # of a round's checks that must be links for another round
MET = 3  # hubs that a node is checked against in a round
CROWD = 16  # nodes at a segment above which they are compared in blocks
BLOCK = 1 << 18  # tokens
OFTEN = 64  # rows of a segment from one task above which its rows are dealt over the buckets
DEALT = 1 << 62
BUCKET = 1 << 19  # rows of the index in a bucket
HELD = 1 << 18  # rows of the index that a task packs at a time


def _segments(c: int) -> int:
    """Segments of the universe for pairs whose larger set has 2^c to 2^(c+1) - 1 elements."""
    h = 2 * ((1 << (c + 1)) - 1) // 9
    return h + 1 + (max(2, h // 8) if c <= SMALL else h // 7 + 4)


M = np.array([_segments(c) for c in range(CLASSES)], np.int64)


def differ(n: np.ndarray, c: np.ndarray) -> np.ndarray:
    """The most elements that a set of size n may differ in from a partner in class c."""
    return (n + np.minimum(n * 5 // 4, (np.int64(1) << (c + 1)) - 1)) // 9


def token_sets(raw: np.ndarray, off: np.ndarray, width: int = WIDTH) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingle hashes of each value, ascending, and offsets."""
    words, woff, _, _ = word_hashes(raw, off)
    sh, soff = shingle_hashes(words, woff, width)
    owner = np.repeat(np.arange(len(off) - 1), np.diff(soff))
    for lo, hi in zip(soff[:-1].tolist(), soff[1:].tolist(), strict=True):  # faster than one sort by value and hash
        sh[lo:hi].sort()
    keep = np.ones(len(sh), bool)
    keep[1:] = (sh[1:] != sh[:-1]) | (owner[1:] != owner[:-1])
    sh, owner = sh[keep], owner[keep]
    return sh, np.searchsorted(owner, np.arange(len(off)))


def nodes(sh: np.ndarray, soff: np.ndarray) -> np.ndarray:
    """A 64-bit name of each set (0 for the empty one)."""
    n = np.diff(soff)
    with np.errstate(over="ignore"):
        total = np.concatenate([[np.uint64(0)], np.cumsum(mix64(sh + np.uint64(SEED)), dtype=np.uint64)])
        name = mix64(total[soff[1:]] - total[soff[:-1]] + n.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    return np.where(n > 0, name, 0).astype(np.uint64).view(np.int64)


def segment_rows(sh: np.ndarray, soff: np.ndarray, which: np.ndarray, c: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Index rows of sets `which` in classes c: key, position in `which`, and tag (role, class, segment, size)."""
    n = np.diff(soff)[which]
    m = M[c]
    base = np.concatenate([[0], np.cumsum(m)])
    owner = np.repeat(np.arange(len(which)), n)
    at = np.repeat(soff[:-1][which] - np.concatenate([[0], np.cumsum(n)[:-1]]), n) + np.arange(n.sum())
    t = sh[at]
    with np.errstate(over="ignore"):
        seg = ((t * np.uint64(0xC2B2AE3D27D4EB4F)) >> np.uint64(24)).astype(np.int64) % m[owner]
        h = mix64(t ^ np.uint64(0x5851F42D4C957F2D))
        content = np.zeros(base[-1], np.uint64)
        np.add.at(content, base[owner] + seg, h)
        slot = np.repeat(np.arange(len(which)), m)
        number = np.arange(base[-1]) - base[slot]
        place = (number.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) ^ (c[slot].astype(np.uint64) << np.uint64(56))
        key = mix64(content + mix64(place))
        tag = (c[slot] << 1) | (number << 7) | (n[slot] << 31)
        small = np.flatnonzero(c[owner] <= SMALL)
        mine = base[owner[small]] + seg[small]
        key1 = mix64(content[mine] - h[small] + mix64(place[mine]))
    return np.concatenate([key, key1]).view(np.int64), np.concatenate([slot, owner[small]]), np.concatenate([tag, tag[mine] | 1])


def _set_table(docs: DataFrame, width: int) -> DataFrame:
    """doc_id, row, n_shingles, node of every row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for big in batches:
            for b in sub_batches(big, "text", 1 << 20):
                sh, soff = token_sets(*buffers(b.column(1)), width)
                yield pa.RecordBatch.from_arrays([b.column(0), b.column(2), pa.array(np.diff(soff)), pa.array(nodes(sh, soff))], ["doc_id", "row", "n_shingles", "node"])

    return docs.mapInArrow(tidy(run), f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, row long, n_shingles long, node long")


def _index_rows(docs: DataFrame, width: int, buckets: int, remember: int = 50_000) -> DataFrame:
    """bucket, keys, nodes, tags: the index of every set, equal sets once a task as far as it remembers them, packed by
    buckets of keys as arrays of 64-bit numbers.

    A row whose segment this task has seen often is marked `DEALT` and goes to a bucket by its node; the segment's own bucket gets a row with tag -1.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        counted = np.zeros(1 << 20, np.int32)  # rows by a hash of the segment
        held: list[tuple[np.ndarray, ...]] = []
        for big in batches:
            for b in sub_batches(big, "text", 1 << 20):
                sh, soff = token_sets(*buffers(b.column(0)), width)
                node, n = nodes(sh, soff), np.diff(soff).astype(np.int64)
                _, first = np.unique(node, return_index=True)
                first = np.array([i for i in first if n[i] and int(node[i]) not in seen], np.int64)
                if len(seen) < remember:
                    seen.update(node[first].tolist())
                c = np.frexp(np.maximum(n, 1).astype(float))[1].astype(np.int64) - 1
                up = first[n[first] * 5 // 4 >= (np.int64(1) << (c[first] + 1))]
                which, cls = np.concatenate([first, up]), np.concatenate([c[first], c[up] + 1])
                some = differ(n[which], cls) > 0
                which, cls = which[some], cls[some]
                if not len(which):
                    continue
                key, slot, tag = segment_rows(sh, soff, which, cls)
                cell = key & (len(counted) - 1)
                np.add.at(counted, cell, 1)
                often = counted[cell] > OFTEN
                who = node[which][slot]
                marks = np.unique(key[often])
                by = np.concatenate([np.where(often, key ^ who, key), marks])
                key, who = np.concatenate([key, marks]), np.concatenate([who, np.zeros(len(marks), np.int64)])
                tag = np.concatenate([np.where(often, tag | DEALT, tag), np.full(len(marks), -1)])
                held.append((bucket_of(by, buckets), key, who, tag))
                if sum(len(x[0]) for x in held) >= HELD:
                    yield _packed(held)
                    held = []
        if held:
            yield _packed(held)

    return docs.select("text").mapInArrow(tidy(run), "bucket int, keys binary, nodes binary, tags binary")


def bucket_of(key: np.ndarray, buckets: int) -> np.ndarray:
    return ((mix64(key.view(np.uint64) ^ np.uint64(SEED)) >> np.uint64(32)) * np.uint64(buckets) >> np.uint64(32)).astype(np.int32)


def _packed(held: list[tuple[np.ndarray, ...]]) -> pa.RecordBatch:
    """One row for each bucket of the rows (bucket, key, node, tag)."""
    bucket, *numbers = (np.concatenate(x) for x in zip(*held, strict=True))
    order = np.argsort(bucket, kind="stable")
    bucket = bucket[order]
    first = np.flatnonzero(np.diff(bucket, prepend=-1))
    off = pa.py_buffer((np.append(first, len(bucket)) * 8).astype(np.int32).tobytes())
    data = [pa.Array.from_buffers(pa.binary(), len(first), [None, off, pa.py_buffer(x[order].tobytes())]) for x in numbers]
    return pa.RecordBatch.from_arrays([pa.array(bucket[first]), *data], ["bucket", "keys", "nodes", "tags"])


def shared_rows(key: np.ndarray, node: np.ndarray, tag: np.ndarray) -> tuple[np.ndarray, ...]:
    """Of a bucket's rows, each once, those whose key another node has too: key, node, tag, the number of whole segments and
    of neighbourhoods at the key, and whether the key is to be counted over all buckets (then these numbers are 0)."""
    apart = (tag >= 0) & (tag & DEALT != 0)
    far = key[apart], node[apart], tag[apart] & ~np.int64(DEALT)
    order = np.argsort(key[~apart])
    key, node, tag = (x[~apart][order] for x in (key, node, tag))
    border = np.ones(len(key) + 1, bool)
    border[1:-1] = key[1:] != key[:-1]
    some = np.flatnonzero(~(border[:-1] & border[1:]) & (tag >= 0) | (tag < 0))  # a key with one row is nobody else's
    key, node, tag = key[some], node[some], tag[some]
    order = np.lexsort((tag, node, key))
    key, node, tag = key[order], node[order], tag[order]
    new = np.ones(len(key), bool)
    new[1:] = (key[1:] != key[:-1]) | (node[1:] != node[:-1]) | (tag[1:] != tag[:-1])
    key, node, tag = key[new], node[new], tag[new]
    start = np.flatnonzero(np.diff(key, prepend=~key[:1])) if len(key) else np.zeros(0, np.int64)
    group = np.repeat(np.arange(len(start)), np.diff(np.append(start, len(key))))
    real = tag >= 0
    n0 = np.bincount(group[real & (tag & 1 == 0)], minlength=len(start))
    n1 = np.bincount(group[real & (tag & 1 == 1)], minlength=len(start))
    part = np.bincount(group[~real], minlength=len(start)) > 0
    change = np.zeros(len(key), bool)
    change[1:] = (key[1:] != key[:-1]) | (node[1:] != node[:-1])
    change[start] = False
    several = np.bincount(group[change], minlength=len(start)) > 0
    stay = real & (part | (several & (n0 > 0)))[group]
    n0, n1, part = (np.where(part, 0, n0)[group][stay], np.where(part, 0, n1)[group][stay], part[group][stay])
    zero = np.zeros(len(far[0]), np.int64)
    return *(np.concatenate([x[stay], y]) for x, y in zip((key, node, tag), far, strict=True)), np.concatenate([n0, zero]), np.concatenate([n1, zero]), np.concatenate([part, zero == 0])


def _shared(packed: DataFrame) -> list[DataFrame]:
    """Written tables of the rows whose key another node has too, with the number of whole segments (n0) and neighbourhoods (n1) at the key."""

    def run(t: pa.Table) -> pa.Table:
        numbers = [np.frombuffer(b"".join(t[x].to_pylist()), np.int64) for x in ("keys", "nodes", "tags")]
        give_back()  # what the bucket before took
        return pa.table(dict(zip(("key", "node", "tag", "n0", "n1", "part"), map(pa.array, shared_rows(*numbers)), strict=True)))

    out = written(packed.groupBy("bucket").applyInArrow(run, "key long, node long, tag long, n0 long, n1 long, part boolean"), "jaccard-dealt")
    unshuffled(packed.sparkSession)
    return [out, written(_counted(out.filter("part").select("key", "node", "tag").dropDuplicates()), "jaccard-counted")]


def _counted(rows: DataFrame) -> DataFrame:
    """Of rows key, node, tag those whose key another node has too, with n0 and n1; keys are counted in tasks before they are shuffled."""
    role = F.col("tag").bitwiseAND(1)
    keys = rows.groupBy("key").agg(F.min("node").alias("lo"), F.max("node").alias("hi"), F.sum(1 - role).alias("n0"), F.sum(role).alias("n1"))
    return rows.join(keys.filter("lo <> hi AND n0 > 0").select("key", "n0", "n1"), "key")


def _field(name: str) -> Column:
    tag = F.col("tag")
    return {"role": tag.bitwiseAND(1), "c": F.shiftright(tag, 1).bitwiseAND(63).cast("int"), "seg": F.shiftright(tag, 7).bitwiseAND(0xFFFFFF).cast("int"), "n": F.shiftright(tag, 31)}[name]


def _allocated(rows: DataFrame) -> DataFrame:
    """node, c, seg, e: where the nodes that may have a partner look."""
    r = rows.select("node", "n0", "n1", *[_field(x).alias(x) for x in ("role", "c", "seg", "n")])
    whole = F.col("role") == 0
    seg = r.groupBy("node", "c", "n", "seg").agg(F.coalesce(F.max(F.when(whole, F.col("n0") - 1)), F.lit(0)).alias("c0"), F.sum(F.when(whole, F.col("n1")).otherwise(F.col("n0"))).alias("c1"))
    small = F.col("c") <= SMALL
    segments = F.element_at(F.array(*[F.lit(int(x)) for x in M]), F.col("c") + 1)
    most = F.floor((F.col("n") + F.least(F.floor(F.col("n") * 5 / 4), F.pow(F.lit(2), F.col("c") + 1).cast("long") - 1)) / 9)
    seg = seg.withColumn("present", F.count("*").over(W.partitionBy("node", "c")))
    seg = seg.withColumn("need", most + 1 - (segments - F.col("present")) * F.when(small, 2).otherwise(1)).filter("need > 0")
    first = F.struct(F.lit(0).alias("e"), F.col("c0").alias("cost"))
    second = F.struct(F.lit(1).alias("e"), F.greatest("c0", "c1").alias("cost"))
    steps = seg.withColumn("s", F.explode(F.when(small, F.array(first, second)).otherwise(F.array(first)))).select("node", "c", "seg", "need", "s.e", "s.cost")
    steps = steps.withColumn("k", F.row_number().over(W.partitionBy("node", "c").orderBy("cost", "e", "seg"))).filter("k <= need and cost > 0")
    return steps.groupBy("node", "c", "seg").agg(F.max("e").alias("e"))


def _verified(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The pairs (a, b) whose sets are similar."""
    x = sets.select(F.col("node").alias("a"), F.col("s").alias("sa"))
    y = sets.select(F.col("node").alias("b"), F.col("s").alias("sb"))
    both = pairs.join(y, "b").join(x, "a")
    o = F.size(F.array_intersect("sa", "sb"))
    return both.filter(100 * o >= 80 * (F.size("sa") + F.size("sb") - o)).select("a", "b")


def components(links: DataFrame, name: str = "components") -> DataFrame:
    """node, root: the smallest node reachable over links (a, b), for every node of a link.

    Each round every node takes its smallest neighbour's neighbour, links are drawn between what was taken, and
    loops and repeated links go, so that fewer are left for the next round. A lost executor costs one round.
    """
    edges = written(links.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).filter("a <> b").distinct(), name)
    part, used = None, []
    while part is None or not edges.isEmpty():
        ends = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        hook = ends.groupBy(F.col("a").alias("node")).agg(F.least(F.min("b"), F.first("a")).alias("root"))
        step = written(hook.join(hook.select(F.col("node").alias("root"), F.col("root").alias("top")), "root").select("node", "top"), name)
        moved = step.select(F.col("node").alias("root"), "top")
        part = moved.toDF("node", "root") if part is None else part.join(moved, "root", "left").select("node", F.coalesce("top", "root").alias("root"))
        ends = edges.join(step.toDF("a", "x"), "a").join(step.toDF("b", "y"), "b").filter("x <> y")
        fewer = written(ends.select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).distinct(), name)
        used += [edges, step]
        edges = fewer
    out = written(part, name) if len(used) > 2 else part
    forget(edges, *(used if len(used) > 2 else used[:1]), shuffles=False)
    return out


def _merging(nodes_: np.ndarray, roots: np.ndarray, left: np.ndarray, right: np.ndarray, off: np.ndarray, tokens: np.ndarray) -> list[tuple[int, int]]:
    """Similar pairs of a node in `left` and one in `right` that join two components so far apart.

    An index from tokens to the nodes of `right` counts the overlap of each node of `left` with all of them at once.
    """
    size = np.diff(off)
    _, token = np.unique(tokens, return_inverse=True)
    owner = np.repeat(np.arange(len(size)), size)
    place = np.full(len(size), -1)
    place[right] = np.arange(len(right))
    mine = np.flatnonzero(place[owner] >= 0)
    mine = mine[np.argsort(token[mine], kind="stable")]
    posting = place[owner[mine]].astype(np.int32)
    start = np.searchsorted(token[mine], np.arange(int(token.max()) + 2 if len(token) else 1))
    up: dict[int, int] = {}

    def find(r: int) -> int:
        while up.get(r, r) != r:
            up[r] = up.get(up[r], up[r])
            r = up[r]
        return r

    out = []
    for i in left.tolist():
        t = token[off[i] : off[i + 1]]
        n = start[t + 1] - start[t]
        o = np.zeros(len(right), np.int64)
        before = np.concatenate([[0], np.cumsum(n)])
        lo = 0
        while lo < len(t):  # some half a million postings at a time
            hi = max(lo + 1, int(np.searchsorted(before, before[lo] + (1 << 19), side="right")) - 1)
            at = np.repeat(start[t[lo:hi]] - (before[lo:hi] - before[lo]), n[lo:hi]) + np.arange(before[hi] - before[lo])
            o += np.bincount(posting[at], minlength=len(right))
            lo = hi
        for k in np.flatnonzero((180 * o >= 80 * (size[i] + size[right])) & (roots[right] != roots[i])).tolist():
            a, b = find(int(roots[i])), find(int(roots[right[k]]))
            if a != b:
                up[max(a, b)] = min(a, b)
                out.append((int(nodes_[i]), int(nodes_[right[k]])))
    return out


def _crowds(hot: DataFrame, sets: DataFrame, block: int) -> DataFrame:
    """Merging links (a, b) among nodes that meet at crowded segments.

    Components connected over crowded segments form a crowd. Its nodes are banded by size, so that similar ones are at
    most one band apart, and a band is dealt into blocks of about `block` tokens. Every two blocks of a band or of
    neighbouring bands are compared in a task of their own, in place: only links that merge components leave it.
    """
    low = hot.groupBy("key").agg(F.min("root").alias("a"))
    crowd = components(hot.select("key", F.col("root").alias("b")).distinct().join(low, "key").select("a", "b"), "jaccard-crowd").select(F.col("node").alias("root"), F.col("root").alias("crowd"))
    band = F.floor(F.log(F.col("n").cast("double")) / F.log(F.lit(1.25)) - 1e-9).cast("int")
    who = written(hot.select("node", "root", "n").distinct().join(crowd, "root").withColumn("band", band), "jaccard-who")
    blocks = written(who.groupBy("crowd", "band").agg(F.ceil(F.sum("n") / block).cast("int").alias("blocks")), "jaccard-blocks")
    shifted = lambda by, name: blocks.select("crowd", (F.col("band") + by).alias("band"), F.col("blocks").alias(name))
    dealt = who.join(blocks, ["crowd", "band"]).join(shifted(-1, "above"), ["crowd", "band"], "left").join(shifted(1, "below"), ["crowd", "band"], "left")
    dealt = dealt.withColumn("mine", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int"))
    upto = lambda k: F.when(F.col(k) > 0, F.sequence(F.lit(0), F.col(k) - 1)).otherwise(F.array().cast("array<int>"))
    mine = F.col("mine")
    # a task is (crowd, band, i, j): blocks i <= j of a band, or block i of a band and block -2 - j of the next
    same = F.transform(upto("blocks"), lambda o: F.struct(F.col("band").alias("band"), F.least(mine, o).alias("i"), F.greatest(mine, o).alias("j"), F.when(o == mine, 2).when(mine < o, 0).otherwise(1).alias("side")))
    over = F.transform(upto("above"), lambda o: F.struct(F.col("band").alias("band"), mine.alias("i"), (-2 - o).alias("j"), F.lit(0).alias("side")))
    under = F.transform(upto("below"), lambda o: F.struct((F.col("band") - 1).alias("band"), o.alias("i"), (-2 - mine).alias("j"), F.lit(1).alias("side")))
    dealt = dealt.withColumn("t", F.explode(F.concat(same, over, under))).select("crowd", "t.*", "node", "root").join(sets, "node")

    def compare(t: pa.Table) -> pa.Table:
        t = t.combine_chunks()
        side = t["side"].to_numpy()
        lists = t["s"].combine_chunks()
        lists = lists.chunk(0) if isinstance(lists, pa.ChunkedArray) else lists
        size = np.asarray(lists.value_lengths())
        off = np.concatenate([[0], np.cumsum(size)])
        left, right = np.flatnonzero(side != 1), np.flatnonzero(side != 0)
        found = _merging(t["node"].to_numpy(), t["root"].to_numpy(), left, right, off, lists.flatten().to_numpy()) if len(left) and len(right) else []
        if len(off) and off[-1] >= BLOCK // 8:
            give_back()
        return pa.table({"a": pa.array([x for x, _ in found], pa.int64()), "b": pa.array([y for _, y in found], pa.int64())})

    return dealt.groupBy("crowd", "band", "i", "j").applyInArrow(compare, "a long, b long")


def join(docs: DataFrame, width: int = WIDTH, id_col: str = "doc_id", text_col: str = "text", crowd: int = CROWD, block: int = BLOCK) -> DataFrame:
    """doc_id, n_shingles, component_id of every row."""
    return rows(docs, width, id_col, text_col, crowd, block).select("doc_id", "n_shingles", "component_id")


def rows(docs: DataFrame, width: int = WIDTH, id_col: str = "doc_id", text_col: str = "text", crowd: int = CROWD, block: int = BLOCK) -> DataFrame:
    """doc_id, row, n_shingles, component_id, root of every row; `row` is the text's xxhash64, which tells rows without an
    id or with a shared one apart, and `root` names the component, null for the empty set."""
    docs = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    meta = written(_set_table(docs.withColumn("row", F.xxhash64("text")), width), "jaccard-sets")
    # A set has under one row of the index for each shingle, and some more if it is small.
    much = meta.agg(F.sum(F.col("n_shingles") + F.when(F.col("n_shingles") < 2 << SMALL, F.col("n_shingles") + 40).otherwise(0))).first()[0] or 0
    buckets = max(int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-much // BUCKET))
    near, far = _shared(_index_rows(docs, width, buckets))
    rows, olds = near.filter("NOT part").select(far.columns).union(far), [near, far]
    for _ in range(ROUNDS):
        look = written(_allocated(rows), "jaccard-look")
        kept = look.select("node", "c").distinct()
        rows = written(_counted(rows.drop("n0", "n1").withColumn("c", _field("c")).join(kept, ["node", "c"]).select("key", "node", "tag")), "jaccard-shared")
        forget(*olds, look)
        olds = [rows]
    look = written(_allocated(rows), "jaccard-look")
    members = rows.withColumns({"role": _field("role"), "c": _field("c"), "seg": _field("seg"), "n": _field("n")}).join(look, ["node", "c", "seg"], "left").select("key", "node", "role", "n", F.coalesce("e", F.lit(-1)).alias("e"))
    members = written(members, "jaccard-members")
    forget(rows, look)

    # Whole sets, of one document for each node with candidates.
    first = meta.filter("n_shingles > 0").groupBy("node").agg(F.min("doc_id").alias("doc_id"), F.min("row").alias("row"))
    wanted = written(first.join(members.select("node").distinct(), "node").select("doc_id", "row"), "jaccard-wanted")
    bare = wanted.filter("doc_id IS NULL").select("row")  # no row of these sets has an id, so they are met by their text's hash
    picked = wanted.filter("doc_id IS NOT NULL").select("doc_id")
    picked = docs.join(F.broadcast(picked) if small_enough(wanted, 16) else picked, "doc_id", "left_semi").select("text")
    if not bare.isEmpty():
        bare = F.broadcast(bare) if small_enough(bare, 16) else bare
        picked = picked.union(docs.filter("doc_id IS NULL").withColumn("row", F.xxhash64("text")).join(bare, "row", "left_semi").select("text"))

    def sets_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for big in batches:
            for b in sub_batches(big, "text", 1 << 20):
                sh, soff = token_sets(*buffers(b.column(0)), width)
                yield pa.RecordBatch.from_arrays([pa.array(nodes(sh, soff)), pa.ListArray.from_arrays(pa.array(soff.astype(np.int32)), pa.array(sh.view(np.int64)))], ["node", "s"])

    sets = written(picked.mapInArrow(tidy(sets_of), "node long, s array<long>").dropDuplicates(["node"]), "jaccard-whole")

    # Rounds against hubs; after each, what is left are segments where components meet and one of them looks.
    here = members.withColumn("root", F.col("node"))
    links = part = None
    useful = True
    for r in range(HUBS + 1):
        keys = here.groupBy("key").agg(F.min("root").alias("lo"), F.max("root").alias("hi"), F.max("e").alias("look"), F.count("*").alias("nodes"), F.min_by(F.struct(F.col("node").alias("hub"), F.col("root").alias("hub_root")), F.xxhash64("node", F.lit(r))).alias("h"))
        keys = keys.filter("lo <> hi AND look >= 0").select("key", "nodes", "h.*")
        open_ = written(here.join(keys, "key"), "jaccard-open")
        forget(members)
        members = open_
        if r == HUBS or not useful or open_.isEmpty():
            break
        met = open_.filter("root <> hub_root").groupBy("node", "hub").agg(F.count("*").alias("k"))
        met = met.withColumn("r", F.row_number().over(W.partitionBy("node").orderBy(F.desc("k"), "hub"))).filter(F.col("r") <= MET)
        star = written(met.select(F.col("hub").alias("a"), F.col("node").alias("b")), "jaccard-star")
        found = written(_verified(star, sets), "jaccard-links")
        n = found.count()
        useful = n > 0 and n >= USEFUL * star.count()
        forget(star, shuffles=False)
        links = found if links is None else links.union(found)
        part = components(links) if n or part is None else part
        here = open_.drop("root", "nodes", "hub", "hub_root").join(part, "node", "left").withColumn("root", F.coalesce("root", "node"))

    cold, hot = open_.filter(F.col("nodes") <= crowd), open_.filter(F.col("nodes") > crowd)
    y = cold.select("key", F.col("node").alias("b"), F.col("root").alias("root_b"), F.col("role").alias("role_b"), F.col("n").alias("n_b"), F.col("e").alias("e_b"))
    pairs = cold.join(y, "key").filter("node < b and root <> root_b and 100 * least(n, n_b) >= 80 * greatest(n, n_b)")
    pairs = pairs.filter("(role = 0 and role_b = 0 and greatest(e, e_b) >= 0) or (role <> role_b and greatest(e, e_b) = 1)")
    rest = written(pairs.select(F.col("node").alias("a"), "b").distinct(), "jaccard-rest")
    more = _verified(rest, sets)
    more = written(more if hot.isEmpty() else more.union(_crowds(hot, sets, block)), "jaccard-links")
    forget(rest, open_, sets, shuffles=False)
    part = components(more if links is None else links.union(more))

    # From nodes to documents.
    named = written(first, "jaccard-first").join(part, "node", "left")
    named = written(named.select("node", "doc_id", F.coalesce("root", "node").alias("root")), "jaccard-named")
    lowest = named.groupBy("root").agg(F.min("doc_id").alias("component_id"))
    lowest = written(named.join(written(lowest, "jaccard-lowest"), "root").select("node", "component_id", "root"), "jaccard-component")
    some = meta.filter("n_shingles > 0").join(lowest, "node").select("doc_id", "row", "n_shingles", "component_id", "root")
    return some.union(meta.filter("n_shingles = 0").select("doc_id", "row", "n_shingles", F.col("doc_id").alias("component_id"), F.lit(None).cast("long")))


def op4_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate components of all documents."""
    return join(spark.read.parquet(f"{sf_dir}/documents.parquet"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {"op4_jaccard": op4_jaccard}
