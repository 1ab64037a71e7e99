"""Operator 1, document fingerprints: randomised edit embedding.

All documents walk over their characters with the same random bits: at step j a walk on character
x stays or advances by one, as bit j of x's class says, and emits x. Walks over texts at a small
edit distance meet again soon after each edit, so edit distance becomes Hamming distance of the
emitted strings. A fingerprint samples the emitted string at steps fixed for all documents,
`PER_OCTAVE` in each range [64 * 2^(o-1), 64 * 2^o); its likeness to another weighs each sample by
the steps it stands for. `near_duplicates` bands sampled positions of several independent walks, so
that similar texts share a band's key, and verifies the pairs by their likeness on the best walk. Long
texts are also cut at content-defined places into blocks of bounded length, whose prints are banded
alike, so that recall doesn't fall with length.

`edited` pairs every document with the next one in descending doc_id order without a global
window: rows are dealt by doc_id ranges, each range also gets the first row of the next, and a
task streams over its sorted rows. Text is shuffled once.

Null texts count as empty; an empty text has the empty fingerprint, whose likeness to another
empty one is 1. Texts are walked whole. Rows with equal doc_id follow each other by text; null
doc_id comes last. An only row is its own next one. An empty table gives an empty result. Other
columns are ignored.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Callable, Iterator, Sequence
from functools import reduce

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.types import DoubleType

from docketflow.llm.common import SEED, buffers, codepoints, forget, mix64, sub_batches, unshuffled, written
from docketflow.llm.jaccard import components

CLASSES = 64
PER_OCTAVE = 64
FIRST = 64
ALPHABET = np.frombuffer(b"0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz-_.", np.uint8)  # the last: no character
BLOCK = 4096
BATCH = 3 << 20  # bytes of text that a task walks at a time
WALKED = 16 << 20  # where several walks are gone, for which it keeps a byte for a character
_BITS: dict[tuple[int, int], np.ndarray] = {}
_STEPS: list[np.ndarray] = []


def _bits(block: int, walk_: int = 0) -> np.ndarray:
    """Advance or stay, by step of the block and character class; the end mark stays."""
    if (walk_, block) not in _BITS:
        with np.errstate(over="ignore"):
            r = mix64(np.arange(block * BLOCK, (block + 1) * BLOCK, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15) + np.uint64(SEED + 1_000_003 * walk_))
        t = np.zeros((BLOCK, CLASSES + 1), np.uint8)
        t[:, :CLASSES] = (r[:, None] >> np.arange(CLASSES, dtype=np.uint64)) & np.uint64(1)
        if len(_BITS) > 100:
            _BITS.clear()
        _BITS[walk_, block] = t
    return _BITS[walk_, block]


def steps(octave: int) -> np.ndarray:
    """The sampled steps of an octave, ascending."""
    while len(_STEPS) <= octave:
        o = len(_STEPS)
        lo, width = (0, FIRST) if o == 0 else (FIRST << (o - 1), FIRST << (o - 1))
        with np.errstate(over="ignore"):
            r = mix64(np.arange(PER_OCTAVE, dtype=np.uint64) + np.uint64(SEED * (o + 7)))
        cell = np.arange(PER_OCTAVE) * width // PER_OCTAVE
        _STEPS.append(lo + cell + (r % np.uint64(max(1, width // PER_OCTAVE))).astype(np.int64))
    return _STEPS[octave]


def classes(points: np.ndarray) -> np.ndarray:
    return ((points * np.uint32(0x9E3779B1)) >> np.uint32(26)).astype(np.uint8)


def walk(codes: np.ndarray, starts: np.ndarray, numbers: Sequence[int] = (0,)) -> np.ndarray:
    """Samples by (sample, walker) of walks from each start to its end mark (class CLASSES), those of the first of `numbers`,
    which number the random bits, before those of the next. A step costs the same calls for one walker and for thousands,
    and the longest text has the most steps, so all walks are gone at once."""
    n, rows = len(starts) * len(numbers), []
    who = np.arange(n)
    pos = np.tile(starts.astype(np.int64), len(numbers))
    row = np.repeat(np.arange(len(numbers), dtype=np.uint16) * np.uint16(CLASSES + 1), len(starts))  # where a walk's bits begin
    step = octave = 0
    while len(who):
        out = np.full((PER_OCTAVE, n), CLASSES, np.uint8)
        end, at = FIRST << octave, steps(octave)
        k = 0
        while step < end and len(who):
            stop = min(step + 64, end)
            if step % BLOCK == 0:
                table = np.concatenate([_bits(step // BLOCK, w) for w in numbers], axis=1)
            c = np.empty(len(who), np.uint8)
            b = np.empty(len(who), np.uint8)
            place = np.empty(len(who), np.uint16) if len(numbers) > 1 else c
            for j in range(step, stop):
                np.take(codes, pos, out=c, mode="clip")
                while k < PER_OCTAVE and at[k] == j:
                    out[k, who] = c
                    k += 1
                if place is not c:
                    np.add(c, row, out=place)
                np.take(table[j % BLOCK], place, out=b, mode="clip")
                np.add(pos, b, out=pos)
            step = stop
            going = codes[pos] != CLASSES
            if not going.all():
                who, pos, row = who[going], pos[going], row[going]
        rows.append(out)
        octave += 1
    return np.concatenate(rows) if rows else np.zeros((0, n), np.uint8)


def weights(samples: int) -> np.ndarray:
    """The number of steps each sample stands for."""
    o = np.arange(samples) // PER_OCTAVE
    return np.where(o == 0, FIRST, FIRST << np.maximum(o - 1, 0)) / PER_OCTAVE


def likeness(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Weighted share of equal samples, by walker, over samples that either has; 1 where neither has any."""
    w = weights(len(a))[:, None]
    either = (w * ((a != CLASSES) | (b != CLASSES))).sum(axis=0)
    equal = (w * ((a == b) & (a != CLASSES))).sum(axis=0)
    return np.where(either > 0, equal / np.where(either > 0, either, 1), 1.0)


def strings(samples: np.ndarray) -> list[str]:
    """Fingerprints as text: one character a sample, up to the last sample that the walk reached."""
    data = ALPHABET[np.ascontiguousarray(samples.T)]
    length = (samples != CLASSES).sum(axis=0)
    return [row[:n].tobytes().decode() for row, n in zip(data, length, strict=True)]


def marked(points: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Class codes with an end mark after each value, and the values' starts in them."""
    n = len(off) - 1
    codes = np.full(len(points) + n, CLASSES, np.uint8)
    starts = off[:-1] + np.arange(n)
    keep = np.ones(len(codes), bool)
    keep[off[1:] + np.arange(n)] = False
    codes[keep] = classes(points)
    return codes, starts


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_chars and fingerprint of every row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for big in batches:
            for b in sub_batches(big, text_col, BATCH):
                points, off = codepoints(*buffers(b.column(1)))
                got = strings(walk(*marked(points, off)))
                yield pa.RecordBatch.from_arrays([b.column(0), pa.array(np.diff(off)), pa.array(got, pa.string())], ["doc_id", "n_chars", "fingerprint"])

    kind = docs.schema[id_col].dataType.simpleString()
    return docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias(text_col)).mapInArrow(run, f"doc_id {kind}, n_chars long, fingerprint string")


def prints_of(codes: np.ndarray, starts: np.ndarray, walks: int) -> pa.Array:
    """A list of the fingerprints by several walks, for each start."""
    samples = walk(codes, starts, range(walks))
    got = zip(*(strings(samples[:, w * len(starts) : (w + 1) * len(starts)]) for w in range(walks)), strict=True)
    return pa.array(list(map(list, got)), pa.list_(pa.string()))


def several(docs: DataFrame, walks: int, keep: list[str], text_col: str = "text") -> DataFrame:
    """The kept columns and `prints`, a fingerprint of each of several walks, of every row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for big in batches:
            for b in sub_batches(big, text_col, WALKED):
                codes, starts, n = [], [], 0
                for some in sub_batches(b, text_col, 1 << 20):  # code points take four times the room of their classes
                    c, at = marked(*codepoints(*buffers(some.column(len(keep)))))
                    codes.append(c)
                    starts.append(at + n)
                    n += len(c)
                prints = prints_of(np.concatenate(codes), np.concatenate(starts), walks)
                yield pa.RecordBatch.from_arrays([*b.columns[: len(keep)], prints], [*keep, "prints"])

    out = T.StructType([*(docs.schema[c] for c in keep), T.StructField("prints", T.ArrayType(T.StringType()))])
    return docs.select(*keep, text_col).mapInArrow(run, out)


def in_ranges(docs: DataFrame, id_col: str, blocks: int) -> DataFrame:
    """Rows with `block` (a range of ids, descending inside) and `ghost`: each block also holds, as
    ghost, the first row of the next block in descending order; the last block, that of the first."""
    ids = docs.select(F.col(id_col).cast("double").alias("k"))
    cuts = np.array(sorted({float(x) for x in ids.approxQuantile("k", [i / blocks for i in range(1, blocks)], 0.25 / blocks)} if blocks > 1 else []))

    @F.pandas_udf("int")
    def block_of(k: pd.Series) -> pd.Series:
        found = np.searchsorted(cuts, k.to_numpy(float, na_value=-np.inf), side="left")
        return pd.Series(found.astype("int32"))

    dealt = docs.withColumn("block", block_of(F.col(id_col).cast("double")))
    top = dealt.groupBy("block").agg(F.max(id_col).alias("m")).orderBy(F.desc("block")).collect()  # a row for each block
    ends = {top[(i - 1) % len(top)].block: r.m for i, r in enumerate(top)}  # what each block is followed by
    source = {r.m: top[(i - 1) % len(top)].block for i, r in enumerate(top)}
    if not ends:
        return dealt.withColumn("ghost", F.lit(0))
    goes = F.create_map(*[F.lit(x) for m, b in source.items() if m is not None for x in (m, b)]) if any(m is not None for m in source) else None
    first = F.col(id_col).isin([m for m in source if m is not None])
    own = F.struct(F.col("block").alias("block"), F.lit(0).alias("ghost"))
    copy = F.struct(F.element_at(goes, F.col(id_col)).alias("block"), F.lit(1).alias("ghost")) if goes is not None else None
    places = F.when(first, F.array(own, copy)).otherwise(F.array(own)) if copy is not None else F.array(own)
    if None in source:  # only null ids in the lowest block: every such row may be its first
        places = F.when(F.col(id_col).isNull(), F.array(own, F.struct(F.lit(source[None]).alias("block"), F.lit(1).alias("ghost")))).otherwise(places)
    return dealt.withColumn("place", F.explode(places)).withColumn("block", F.col("place.block")).withColumn("ghost", F.col("place.ghost")).drop("place")


def edited(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", blocks: int | None = None) -> DataFrame:
    """Fingerprints of every text and of its edited text, whose last half is replaced by the start of
    the next document, and the likeness of the text's to the edited text's and the next document's."""
    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows = in_ranges(docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias(text_col)), "doc_id", blocks or 4 * parts)
    rows = rows.repartition(parts, "block").sortWithinPartitions("block", "ghost", F.desc_nulls_last("doc_id"), F.asc_nulls_first(text_col))

    def emit(b: pa.RecordBatch) -> pa.RecordBatch | None:
        """The rows that another row of their block follows here; the last row waits for the next call."""
        block, ghost = b.column(2).to_numpy(), b.column(3).to_numpy()
        mine = np.flatnonzero((ghost[:-1] == 0) & (block[:-1] == block[1:]))
        if not len(mine):
            return None
        raw, boff = buffers(b.column(1))
        points, off = codepoints(raw, boff)
        at = np.append(np.flatnonzero((raw & 0xC0) != 0x80), len(raw))  # the first byte of each code point
        n = np.diff(off)
        half = n[mine] // 2
        keep = n[mine] - half
        more = np.minimum(half, n[mine + 1])
        pieces, sha, total = [], [], np.zeros(len(mine) + 1, np.int64)
        total[1:] = np.cumsum(keep + more)
        for i, k, m in zip(mine, keep, more, strict=True):
            a, c = off[i], off[i + 1]
            pieces += [points[a : a + k], points[c : c + m]]
            h = hashlib.sha256(raw[at[a] : at[a + k]])
            h.update(raw[at[c] : at[c + m]])
            sha.append(h.hexdigest())
        codes, starts = marked(points, off)
        codes2, starts2 = marked(np.concatenate(pieces), total)
        s = walk(np.concatenate([codes, codes2]), np.concatenate([starts, starts2 + len(codes)]))
        own, new = s[:, : len(n)], s[:, len(n) :]
        return pa.RecordBatch.from_arrays(
            [b.column(0).take(pa.array(mine)), pa.array(n[mine]), pa.array(sha), pa.array(strings(own[:, mine])), pa.array(strings(new)), pa.array(likeness(own[:, mine], new)), pa.array(likeness(own[:, mine], own[:, mine + 1]))],
            ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"],
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last = None
        for big in batches:
            for b in sub_batches(big, text_col, BATCH):
                whole = pa.Table.from_batches([last, b] if last is not None else [b]).combine_chunks().to_batches()[0]
                got = emit(whole)
                if got is not None:
                    yield got
                last = whole.slice(whole.num_rows - 1)

    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.select("doc_id", text_col, "block", "ghost").mapInArrow(run, f"doc_id {kind}, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double")


WALKS = 4
LEAST = 0.6
SHORT = 0.8
BANDS, ROWS = 32, 6
#: Sampled places of each band inside two neighbouring octaves, all different.
_PLACES = [[int(x) for x in np.argsort(mix64(np.arange(2 * PER_OCTAVE, dtype=np.uint64) + np.uint64(SEED + 1009 * b)))[:ROWS]] for b in range(BANDS)]
STEP = 1.1  # between the length classes of short fingerprints
FEW = 24  # nodes of a bucket above which it is compared in blocks
BLOCK_NODES = 2048
MANY = 1 << 24  # rows of shared keys that wait to be settled together
PAIRS = 50_000  # of prints that are met at a time, or two for each node if these are more
MET = 1 << 20  # nodes met at a key that a task looks at together


def _key(*parts: object) -> int:
    return int.from_bytes(hashlib.blake2b("\0".join(map(str, parts)).encode(), digest_size=8).digest(), "little", signed=True) >> 4 << 4


def short_keys(fingerprint: str, least: float) -> set[int]:
    """Band keys of a short fingerprint, as a partner may have under one octave: if the longer of two has n samples, they differ
    in (1 - least) * n places at most, so of one more groups of places one is equal: no pair of that likeness, SHORT at
    least, is missed."""
    n, out = len(fingerprint), set()
    least = max(least, SHORT)
    if n and n * least < PER_OCTAVE:
        first, last = (math.floor(math.log(x) / math.log(STEP) + 1e-9) for x in (n, n / least))
        for c in range(first, last + 1):  # of the longer one's length, which is n to n / least
            lo, hi = math.ceil(STEP**c - 1e-6), math.ceil(STEP ** (c + 1) + 1e-6)
            groups = min(math.floor((1 - least) * hi + 1e-9) + 1, lo)
            out.update(_key("short", c, g, fingerprint[g:lo:groups]) for g in range(groups))
    return out if n else {_key("equal", fingerprint)}


def octave_keys(samples: np.ndarray, top: int) -> np.ndarray:
    """By (fingerprint, band), keys of samples by (sample, fingerprint) in the two octaves that end with octave `top`."""
    lo, span = max(top - 2, 0) * PER_OCTAVE, min(top, 2) * PER_OCTAVE
    places = lo + np.array(_PLACES) % span
    key = np.zeros((samples.shape[1], BANDS), np.uint64)
    for k in range(ROWS):
        key = key * np.uint64(CLASSES + 1) + samples.T[:, places[:, k]]
    with np.errstate(over="ignore"):
        key = mix64(mix64(key + np.uint64(SEED)) + np.uint64(top * BANDS) + np.arange(BANDS, dtype=np.uint64))
    return (key & ~np.uint64(15)).view(np.int64)


def band_keys(samples: np.ndarray, length: np.ndarray, text_of: Callable[[int], str], least: float) -> tuple[np.ndarray, np.ndarray]:
    """Every key of fingerprints by their samples by (sample, fingerprint), lengths and, of short ones, text, and whose it is.

    Long fingerprints have keys of sampled places in the last two whole octaves and, as a like text may end an octave
    earlier, in the two before; those of little over one octave and less have `short_keys`.
    """
    whole = length // PER_OCTAVE
    short = [(k, i) for i in np.flatnonzero(length * SHORT < PER_OCTAVE).tolist() for k in short_keys(text_of(i), least)]
    key, who = [np.array([k for k, _ in short], np.int64)], [np.array([i for _, i in short], np.int64)]
    for n in np.unique(whole[whole > 0]).tolist():
        at = np.flatnonzero(whole == n)
        these = samples.T[at].T
        for top in range(max(n - 1, 1), n + 1):
            key.append(octave_keys(these, top).ravel())
            who.append(np.repeat(at, BANDS))
    return np.concatenate(key), np.concatenate(who)


def bands(prints: DataFrame, least: float, walk_: int) -> DataFrame:
    """band, node of every key that prints (node, prints) have by one of their walks."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for big in batches:
            for lo in range(0, big.num_rows, 1000):
                b = big.slice(lo, 1000)
                texts = b.column(1).to_pylist()
                key, who = band_keys(matrix(texts), np.array(list(map(len, texts))), texts.__getitem__, least)
                yield pa.RecordBatch.from_arrays([pa.array(key + walk_), b.column(0).take(pa.array(who))], ["band", "node"])

    return prints.select("node", F.col("prints")[walk_].alias("print")).mapInArrow(run, "band long, node long")


def shared_keys(keyed: DataFrame, name: str) -> DataFrame:
    """The rows (band, node) whose band another row has too, written: most bands are one node's alone."""
    often = keyed.groupBy("band").agg(F.count("*").alias("n")).filter("n > 1").select("band")
    kept = written(keyed.join(often, "band"), f"{name}-shared")
    unshuffled(keyed.sparkSession)
    return kept


def matrix(prints: list[str]) -> np.ndarray:
    """Samples by (sample, fingerprint) of fingerprints as text, up to whole octaves."""
    n = max(map(len, prints), default=0)
    n += -n % PER_OCTAVE
    at = np.full(128, CLASSES, np.uint8)
    at[ALPHABET] = np.arange(len(ALPHABET))
    return at[np.frombuffer("".join(t.ljust(n, ".") for t in prints).encode(), np.uint8)].reshape(len(prints), n).T


def alike(a: str, b: str) -> float:
    """Likeness of two fingerprints as text."""
    m = matrix([a, b])
    return float(likeness(m[:, :1], m[:, 1:])[0])


class ByWalks:
    """Likeness of prints: the best walk's."""

    @staticmethod
    def pairs(a: list, b: list) -> list[float]:
        out: list[float] = []
        for lo in range(0, len(a), 256):
            x, y = a[lo : lo + 256], b[lo : lo + 256]
            best = np.zeros(len(x))
            for w in range(max(map(len, x), default=0)):
                both = matrix([t[w] for t in x] + [t[w] for t in y])
                best = np.maximum(best, likeness(both[:, : len(x)], both[:, len(x) :]))
            out += best.tolist()
        return out

    @staticmethod
    def among(prints: list) -> Callable[[int, np.ndarray], np.ndarray]:
        each = [matrix(list(p)) for p in zip(*prints, strict=True)]
        return lambda x, far: np.max([likeness(m[:, [x]], m[:, far]) for m in each], axis=0)


class ByBlocks:
    """Likeness of lists of block classes with their characters (one number after the other): the characters in classes that
    both have, of the longer one's."""

    @staticmethod
    def pairs(a: list, b: list) -> list[float]:
        out = []
        for x, y in zip(a, b, strict=True):
            x, y = dict(zip(x[::2], x[1::2], strict=True)), dict(zip(y[::2], y[1::2], strict=True))
            out.append(sum(min(n, y[k]) for k, n in x.items() if k in y) / max(sum(x.values()), sum(y.values()), 1))
        return out

    @staticmethod
    def among(lists: list) -> Callable[[int, np.ndarray], np.ndarray]:
        return lambda x, far: np.array(ByBlocks.pairs([lists[x]] * len(far), [lists[k] for k in far]))


def _in_blocks(crowded: DataFrame, text: DataFrame, least: float, block: int, by: type) -> DataFrame:
    """Links (a, b) between components (band, node, root, n) of the same bucket: a bucket is cut into blocks of about
    `block` nodes, every two of which are compared in a task; only links that merge components leave it."""
    dealt = crowded.withColumn("blocks", F.ceil(F.col("n") / block).cast("int")).withColumn("mine", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int"))
    dealt = dealt.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    dealt = dealt.select("band", F.least("mine", "other").alias("i"), F.greatest("mine", "other").alias("j"), "mine", "node", "root").join(text, "node")

    def compare(t: pa.Table) -> pa.Table:
        mine, i, j, node, root = (t[x].to_numpy().copy() for x in ("mine", "i", "j", "node", "root"))
        like = by.among(t["prints"].to_pylist())
        left, right = np.flatnonzero(mine == i[0]), np.flatnonzero(mine == j[0])
        found = []
        for x in left:
            far = right[root[right] != root[x]]
            if not len(far):
                continue
            for y in far[like(x, far) >= least]:
                if root[x] != root[y]:
                    root[root == max(root[x], root[y])] = min(root[x], root[y])
                    found.append((int(node[x]), int(node[y])))
        return pa.table({"a": pa.array([x for x, _ in found], pa.int64()), "b": pa.array([y for _, y in found], pa.int64())})

    return dealt.groupBy("band", "i", "j").applyInArrow(compare, "a long, b long")


def verified(pairs: DataFrame, text: DataFrame, least: float, by: type, name: str, most: int) -> list[DataFrame]:
    """The pairs (a, b) that are alike, in written tables. A pair meets two prints, far larger than itself, so about `most`
    pairs are met at a time, and their shuffles dropped after."""

    @F.pandas_udf(DoubleType())
    def likeness_of(a: pd.Series, b: pd.Series) -> pd.Series:
        return pd.Series(by.pairs(list(a), list(b)), dtype=float)

    slices, out = max(1, math.ceil(pairs.count() / most)), []
    for k in range(slices):
        some = pairs.filter(F.pmod(F.xxhash64("a", "b"), F.lit(slices)) == k) if slices > 1 else pairs
        both = some.join(text.select(F.col("node").alias("b"), F.col("prints").alias("fb")), "b").join(text.select(F.col("node").alias("a"), F.col("prints").alias("fa")), "a")
        out.append(written(both.filter(likeness_of("fa", "fb") >= least).select("a", "b"), f"{name}-links"))
        if slices > 1:
            unshuffled(pairs.sparkSession)
    return out


def linked(text: DataFrame, parts: list[DataFrame], least: float, few: int, block: int, by: type, name: str) -> DataFrame:
    """Links (a, b), written, that join all nodes of text (node, prints) which share a key of parts (band, node) and are
    alike. No band is in two parts; keys are shuffled by part, and what is shared is settled once it is MANY rows."""
    kept: list[DataFrame] = []
    links: list[DataFrame] = []
    most = max(PAIRS, 2 * text.count())
    for k, part in enumerate(parts, 1):
        kept.append(shared_keys(part, name))
        if k == len(parts) or sum(x.count() for x in kept) > MANY:
            links += _settled(text, reduce(DataFrame.union, kept), links, least, few, block, by, name, most)
            forget(*kept)
            kept = []
    out = written(reduce(DataFrame.union, links), f"{name}-links")
    forget(*links)
    return out


def _settled(text: DataFrame, keyed: DataFrame, links: list[DataFrame], least: float, few: int, block: int, by: type, name: str, most: int) -> list[DataFrame]:
    """Written links (a, b) beside those known: each key's nodes are checked against its smallest one, and those of
    different components that still meet at a key are all compared, in pairs or, in buckets of more than `few` nodes, in
    blocks."""

    def rooted(links: list[DataFrame], as_: str) -> DataFrame:
        return keyed.join(components(reduce(DataFrame.union, links), as_), "node", "left").withColumn("root", F.coalesce("root", "node"))

    before = rooted(links, f"{name}-before") if links else keyed.withColumn("root", F.col("node"))
    hubs = before.groupBy("band").agg(F.min(F.struct("node", "root")).alias("hub"))
    pairs = written(before.join(hubs, "band").filter("root <> hub.root").select(F.col("hub.node").alias("a"), F.col("node").alias("b")).distinct(), f"{name}-pairs")
    found = verified(pairs, text, least, by, name, most)
    here = written(rooted(links + found, f"{name}-classes"), f"{name}-here")
    meeting = here.groupBy("band").agg(F.count("*").alias("n"), F.min("root").alias("lo"), F.max("root").alias("hi")).filter("lo <> hi").select("band", "n")
    left = written(here.join(meeting, "band"), f"{name}-left")
    forget(here)
    cold = left.filter(F.col("n") <= few)
    x, y = cold.select("band", F.col("node").alias("a"), F.col("root").alias("ra")), cold.select("band", F.col("node").alias("b"), F.col("root").alias("rb"))
    rest = x.join(y, "band").filter("a < b and ra <> rb").select("a", "b").distinct()
    rest = written(rest.join(pairs, ["a", "b"], "left_anti"), f"{name}-rest")  # pairs begin with the smaller node too, and those alike are linked
    found += verified(rest, text, least, by, name, most)
    found.append(written(_in_blocks(left.filter(F.col("n") > few), text, least, block, by), f"{name}-links"))
    forget(pairs, left, rest)
    return found


# --- prints by tiles ---

TILE = 48 << 20  # bytes of samples in a block of nodes; a task holds two
FEWEST = 2048  # nodes of a block that is made smaller so that all tasks have work
COPIES = 2  # of the prints that are shuffled together


class Prints:
    """Fingerprints by several walks, with their samples in rows."""

    def __init__(self, prints: pa.ChunkedArray, least: float):
        self.least, self.prints, self.walks = least, prints, []
        at = np.full(128, CLASSES, np.uint8)
        at[ALPHABET] = np.arange(len(ALPHABET))
        for w in range(len(prints[0])):
            raw, off = buffers(pc.list_element(prints, w))
            length = np.diff(off)
            width = -(-int(length.max()) // PER_OCTAVE) * PER_OCTAVE
            samples = np.full((len(length), width), CLASSES, np.uint8)
            samples[np.arange(width) < length[:, None]] = at[raw]
            self.walks.append((samples, length, np.concatenate([[0], np.cumsum(weights(width))])))

    def keys(self, w: int) -> tuple[np.ndarray, np.ndarray]:
        samples, length, _ = self.walks[w]
        return band_keys(samples.T, length, lambda i: self.prints[i][w].as_py(), self.least)

    def alike(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Whether the rows of each pair have a likeness of `least` on one walk."""
        out = np.zeros(len(a), bool)
        for samples, length, upto in self.walks:
            left = np.flatnonzero(~out)
            out[left] = self._alike(samples, length, upto, a[left], b[left])
        return out

    def _alike(self, samples: np.ndarray, length: np.ndarray, upto: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        longer = np.maximum(length[a], length[b])
        out = longer == 0
        octaves = -(-np.minimum(length[a], length[b]) // PER_OCTAVE)  # beyond the shorter one nothing is equal
        for n in np.unique(octaves[octaves > 0]).tolist():
            every, low = np.flatnonzero(octaves == n), max(n - 3, 0)
            for lo in range(0, len(every), 4096):
                some, equal = every[lo : lo + 4096], 0.0
                for first, last in ((low, n), (0, low)):  # most pairs are too far apart in the last three octaves for the others to make up
                    x, y = first * PER_OCTAVE, last * PER_OCTAVE
                    same = (samples[a[some], x:y] == samples[b[some], x:y]).view(np.uint64).reshape(len(some), last - first, PER_OCTAVE // 8)
                    count = same.sum(axis=2, dtype=np.uint64) * np.uint64(0x0101010101010101) >> np.uint64(56)  # the bytes' sum
                    neither = upto[y] - upto[np.clip(longer[some], x, y)]  # the ends of rows, which are equal too
                    equal = equal + count @ weights(y)[x::PER_OCTAVE] - neither
                    near = equal + upto[x] >= self.least * upto[longer[some]] * (1 - 1e-9)
                    some, equal = some[near], equal[near]
                out[some[equal / upto[longer[some]] >= self.least]] = True
        return out


def _in_tile(least: float) -> Callable[[pa.Table], pa.Table]:
    """Links (a, b) between the nodes of two blocks (mine is i or j), or inside of one, that share a key and are alike: as many
    as join what all of these join."""

    def compare(t: pa.Table) -> pa.Table:
        prints, rows, one = Prints(t["prints"], least), t.num_rows, t["i"][0] == t["j"][0]
        order = np.argsort(t["mine"].to_numpy(), kind="stable")  # nodes go by their place in it, block i ahead of block j
        node, rank = t["node"].to_numpy()[order], np.empty(rows, np.uint64)
        rank[order] = np.arange(rows, dtype=np.uint64)
        ahead = rows if one else int((t["mine"].to_numpy() == t["i"][0].as_py()).sum())
        bits = np.uint64(rows.bit_length())
        left, low, many, right, base = [], [], [], [], 0
        for w in range(len(prints.walks)):
            key, who = prints.keys(w)
            key = np.sort(key.view(np.uint64) >> bits << bits | rank[who])  # a key's node in the room of its last bits
            who = (key & ((np.uint64(1) << bits) - np.uint64(1))).astype(np.int32)
            key >>= bits
            same = np.concatenate([[False], key[1:] == key[:-1], [False]])
            who, same = who[same[1:] | same[:-1]], same[:-1][same[1:] | same[:-1]]
            start = np.flatnonzero(~same)  # of a key's nodes
            end = np.append(start[1:], len(who))
            if one or not len(who):
                first = np.arange(1, len(who) + 1)  # that each node meets, and so all that follow it
            else:
                first = np.repeat(start + np.add.reduceat(who < ahead, start, dtype=np.int64), end - start)
            n = np.repeat(end, end - start) - first
            met = (n > 0) & (who < ahead)
            left.append(who[met])
            low.append((first[met] + base).astype(np.int32))
            many.append(n[met].astype(np.int32))
            right.append(who)
            base += len(who)
        left, low, many, right = map(np.concatenate, (left, low, many, right))
        turn = np.argsort(left, kind="stable")  # a pair's keys follow each other, so that it is compared once
        left, low, many = left[turn], low[turn], many[turn]
        upto = np.concatenate([[0], np.cumsum(many, dtype=np.int64)])
        root, found = np.arange(rows), []

        def join(a: np.ndarray, b: np.ndarray) -> None:
            nonlocal root
            near = prints.alike(order[a], order[b])
            for x, y in zip(a[near].tolist(), b[near].tolist(), strict=True):
                rx, ry = x, y
                while root[rx] != rx:
                    rx = root[rx]
                while root[ry] != ry:
                    ry = root[ry]
                if rx != ry:
                    root[max(rx, ry)] = min(rx, ry)
                    found.append((x, y))
            while (root[root] != root).any():
                root = root[root]

        at = 0
        while at < len(left):
            to = max(at + 1, int(np.searchsorted(upto, upto[at] + MET, "right")) - 1)
            n = many[at:to]
            a = np.repeat(left[at:to].astype(np.int64), n)
            b = right[np.arange(len(a)) + np.repeat(low[at:to] - (upto[at:to] - upto[at]), n)]
            far = root[a] != root[b]
            a, b = np.divmod(np.unique(a[far] * rows + b[far]), rows)
            first = np.unique(a * rows + root[b], return_index=True)[1]
            if 2 * len(first) < len(a):  # in a crowd, one of each component goes ahead
                join(a[first], b[first])
                far = root[a] != root[b]
                far[first] = False
                a, b = a[far], b[far]
            join(a, b)
            at = to
        a, b = np.array(found, np.int64).reshape(-1, 2).T
        return pa.table({"a": pa.array(node[a]), "b": pa.array(node[b])})

    return compare


def by_tiles(text: DataFrame, least: float, name: str) -> DataFrame:
    """Links (a, b), written, that join all nodes of text (node, prints) which share a key by one of their walks and are alike
    on one.

    Nodes that meet at a key by chance are the more the larger the table, and their pairs grow with its square; so no table
    holds pairs or keys. Nodes are dealt into blocks, and a task finds and compares the pairs of two of these in its memory.
    About COPIES of the prints are shuffled at a time.
    """
    spark = text.sparkSession
    n, longest, walks = text.agg(F.count("*"), F.max(F.length(F.col("prints")[0])), F.max(F.size("prints"))).first()
    blocks = math.ceil(n * (longest or 0) * (walks or 0) / TILE)
    blocks = max(1, blocks, min(spark.sparkContext.defaultParallelism - 1, n // FEWEST))  # a round has a tile for each task or more
    dealt = text.withColumn("mine", F.pmod(F.xxhash64("node"), F.lit(blocks)).cast("int")).withColumn("other", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))
    dealt = dealt.select(F.least("mine", "other").alias("i"), F.greatest("mine", "other").alias("j"), "mine", "node", "prints")
    rounds, out = math.ceil(blocks / COPIES), []
    for k in range(rounds):
        some = dealt.filter((F.col("i") + F.col("j")) % rounds == k)
        tasks = 4 * blocks * (blocks + 1) // 2 // rounds + 1  # few tiles share one
        out.append(written(some.repartition(tasks, "i", "j").groupBy("i", "j").applyInArrow(_in_tile(least), "a long, b long"), f"{name}-links"))
        unshuffled(spark)
    if len(out) == 1:
        return out[0]
    links = written(reduce(DataFrame.union, out), f"{name}-links")
    forget(*out)
    return links


# --- long texts by blocks ---------------------------------------------------------------------

SHARED = 0.55  # of the characters of the longer of two texts, in blocks that both have
LONG = 3000  # code points from which texts are compared by their blocks too
SHORTEST, LONGEST, MARK, ONE_IN = 512, 2048, 6, 600  # of blocks; a cut follows a MARK-gram that one in ONE_IN is


def cuts(codes: np.ndarray) -> list[int]:
    """Ends of the blocks of a text, from its character classes: after marked grams, so an edit moves no other cut than those
    near it; blocks have SHORTEST to LONGEST characters, but for the last."""
    n = len(codes)
    h = np.zeros(max(n - MARK + 1, 0), np.uint64)
    with np.errstate(over="ignore"):
        for k in range(MARK if n >= MARK else 0):
            h = mix64(h * np.uint64(31) + codes[k : n - MARK + 1 + k].astype(np.uint64) + np.uint64(1))
    marks = np.flatnonzero(h % np.uint64(ONE_IN) == 0) + MARK
    out, at = [], 0
    while n - at > LONGEST:
        k = int(np.searchsorted(marks, at + SHORTEST))
        at = int(marks[k]) if k < len(marks) and marks[k] <= at + LONGEST else at + LONGEST
        out.append(at)
    return [*out, n]


def blocks(docs: DataFrame, walks: int, text_col: str = "text") -> DataFrame:
    """doc, characters and prints of every block of texts (doc, text) of LONG code points or more."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for big in batches:
            for b in sub_batches(big, text_col, 2 << 20):
                points, off = codepoints(*buffers(b.column(1)))
                codes = classes(points)
                ends = [[int(lo) + e for e in cuts(codes[lo:hi])] for lo, hi in zip(off[:-1], off[1:], strict=True)]
                edges = np.concatenate([[0], *ends]).astype(np.int64)  # texts follow each other, and so do their blocks
                prints = prints_of(*marked(points, edges), walks)
                doc = b.column(0).take(pa.array(np.repeat(np.arange(len(ends)), list(map(len, ends)))))
                yield pa.RecordBatch.from_arrays([doc, pa.array(np.diff(edges)), prints], ["doc", "n", "prints"])

    long = docs.filter(F.length(text_col) >= LONG).select("doc", text_col)
    return long.mapInArrow(run, "doc long, n long, prints array<string>")


def by_blocks(docs: DataFrame, least: float, walks: int, few: int, block: int, shared: float = SHARED) -> DataFrame:
    """Links (a, b), written, between long texts (doc, text) that share blocks: `shared` of the longer one's characters or
    more are in blocks whose like the other has. Blocks are classed as texts are; a text is looked up under its rarest
    block classes, as many as leave less than that share in the others."""
    prints = written(blocks(docs.distinct(), walks).withColumn("node", F.xxhash64("prints")), "blocks")
    text = written(prints.groupBy("node").agg(F.first("prints").alias("prints")), "blocks-once")
    whole, prints = prints, written(prints.select("doc", "n", "node"), "blocks-of")
    forget(whole)
    links = by_tiles(text, least, "blocks")
    part = components(links, "blocks-classes")
    held = prints.join(part, "node", "left").groupBy("doc", F.coalesce("root", "node").alias("band")).agg(F.sum("n").alias("n"))
    held = written(held, "blocks-held")
    forget(text, prints)
    counts = held.groupBy("band").agg(F.count("*").alias("df"))
    order = W.partitionBy("doc").orderBy("df", "band")
    sums = {"rest": F.sum("n").over(order.rowsBetween(0, W.unboundedFollowing)), "all": F.sum("n").over(W.partitionBy("doc"))}
    probes = held.join(counts, "band").withColumns(sums).filter(F.col("rest") >= shared * F.col("all"))
    probes = written(probes.select("band", F.col("doc").alias("node")), "blocks-probes")
    lists = held.groupBy(F.col("doc").alias("node")).agg(F.flatten(F.collect_list(F.array("band", "n"))).alias("prints"))
    lists = written(lists, "blocks-lists")
    out = linked(lists, [probes], shared, few, block, ByBlocks, "blocks-docs")
    forget(links, held, probes, lists)
    return out


def near_duplicates(docs: DataFrame, least: float = LEAST, walks: int = WALKS, id_col: str = "doc_id", text_col: str = "text", few: int = FEW, block: int = BLOCK_NODES) -> DataFrame:
    """doc_id, class_id of every row: the smallest doc_id among texts linked by a likeness of `least` on one of `walks` walks,
    or, of texts of LONG code points or more, by the share SHARED of their characters in like blocks.

    Equal texts are one node. Every pair that shares a band's key is linked if alike. A pair whose likeness over the
    sampled octaves is p shares one with probability 1 - (1 - p^ROWS)^BANDS or more; under one octave a pair of likeness
    SHORT always does. Edits move a walk off its twin's way for a while, so likeness falls with the number of edits, not
    only their rate; walks are independent, so several find what one loses, and blocks are short, so that the edits of
    one cost one.
    """
    rows = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text")).withColumn("doc", F.xxhash64("text"))
    prints = several(rows, walks, ["doc_id", "doc"])
    one = written(prints.groupBy(F.col("doc").alias("node")).agg(F.min("doc_id").alias("low"), F.first("prints").alias("prints")), "prints-once")
    unshuffled(docs.sparkSession)
    text = one.select("node", "prints")
    links = by_tiles(text, least, "prints")
    low = written(one.select("node", "low"), "prints-low")
    forget(one)
    long = by_blocks(rows.select("doc", "text"), least, walks, few, block)
    part = components(links.union(long), "prints-classes")
    named = low.join(part, "node", "left").select("node", "low", F.coalesce("root", "node").alias("root"))
    lowest = named.groupBy("root").agg(F.min("low").alias("class_id"))
    named = named.join(lowest, "root").select(F.col("node").alias("doc"), "class_id")
    out = written(rows.select("doc_id", "doc").join(named, "doc").select("doc_id", "class_id"), "prints-named")
    forget(low, links, long)
    return out


def op1_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprints of every document and its edited text."""
    return edited(spark.read.parquet(f"{sf_dir}/documents.parquet"))


def fingerprint_classes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate classes of all documents by banding and verification of their fingerprints."""
    return near_duplicates(spark.read.parquet(f"{sf_dir}/documents.parquet"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {"op1_fingerprints": op1_fingerprints, "fingerprint_classes": fingerprint_classes}
