"""Operator 12, language-model scoring: Katz backoff over word bigrams and unigrams.

Tokens are words, A-Z lower-cased, and one end token a text. P(w | h) is the Good-Turing discounted
share of h's continuations that w has, where the bigram was seen in training, else alpha(h) P(w);
P(w) is the discounted share of all tokens, and what that leaves belongs to one unknown word.
alpha(h) is what the continuations of h leave, divided by what their unigrams leave, so that every
context sums to one exactly. A text's first context is a start mark; an unknown context has P(w).
Counts up to `K` are discounted by Good-Turing with Katz's renormalisation (for the largest k up to
K that gives discounts between 0 and 1, else half a count is taken off); larger ones give up `DELTA`
of a count, so that no context is left without mass for what it hasn't shown.

Counts are kept in tables that are partitioned by hash, and texts ask them in batches:
1. a task turns each batch of texts into word numbers and asks for each different word once;
2. parts of the vocabulary sum their words' counts over all batches, number them, and answer;
3. a batch asks for each different bigram once, with the unigram count of its word; requests go to
   parts by context, those of a context with `hot` tokens or more by context and a salt of the word;
4. parts of the bigrams sum counts and answer with them and, for contexts of unseen bigrams, with
   what makes up alpha; salted contexts are summed by one more small aggregation;
5. a batch evaluates its tokens and sums by text.
What is shuffled are packed arrays, once a different word or bigram of a batch, and word numbers
twice; no text is. A part holds about 6 MB of text's bigrams at any input size. Only counts of
counts reach the driver.

Words are told apart by 64-bit hashes. Null and empty texts have the end token alone. Repeated rows
count as rows of their own. Rows whose `training` is null (those without an id, in the query) are
scored and not learnt from, and their held_out is null. Without training rows every token is the
unknown word, of probability one. An empty table gives an empty result. Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from docketflow.llm.common import buffers, fold, forget, mix64, sub_batches, word_hashes, written

K = 5
DELTA = 0.02
HOT = 250_000
BATCH = 4 << 20
END = np.uint64(0x5EED0FE17D0C5E7D)
#: Numbers of the unknown word and of the start mark; words have higher ones.
UNKNOWN, START = 0, 1


# --- packed arrays --------------------------------------------------------------------------


def bundle(*arrays: np.ndarray) -> bytes:
    """Arrays of non-negative integers as one value: their sizes and widths, then bytes of equal weight beside each other, compressed."""
    head, planes = [len(arrays).to_bytes(1, "little")], []
    for a in arrays:
        a = np.ascontiguousarray(a).astype(np.uint64, copy=False)
        width = max(1, (int(a.max()).bit_length() + 7) // 8) if len(a) else 0
        head.append(width.to_bytes(1, "little") + len(a).to_bytes(4, "little"))
        planes.append(np.ascontiguousarray(a.view(np.uint8).reshape(-1, 8)[:, :width].T).tobytes())
    return b"".join(head) + zstandard.ZstdCompressor(level=1).compress(b"".join(planes))


def unbundle(data: bytes) -> list[np.ndarray]:
    """The arrays of `bundle`, as int64 (higher numbers wrap)."""
    number, out, at = data[0], [], 0
    raw = np.frombuffer(zstandard.ZstdDecompressor().decompress(data[1 + 5 * number :]), np.uint8)
    for k in range(number):
        width, size = data[1 + 5 * k], int.from_bytes(data[2 + 5 * k : 6 + 5 * k], "little")
        full = np.zeros((size, 8), np.uint8)
        full[:, :width] = raw[at : at + width * size].reshape(width, size).T
        at += width * size
        out.append(full.view(np.int64).reshape(-1))
    return out


def steps(ascending: np.ndarray) -> np.ndarray:
    """Differences of an ascending array, the first from zero."""
    return np.diff(ascending.astype(np.uint64), prepend=np.uint64(0))


# --- the model's arithmetic -----------------------------------------------------------------


def discounts(n: list[int]) -> np.ndarray:
    """What counts 1 to K become, from the numbers n[r - 1] of things seen r times, r up to K + 1."""
    for k in range(K, 0, -1):
        if all(n[: k + 1]):
            common = (k + 1) * n[k] / n[0]
            r = np.arange(1, k + 1)
            if common < 1:
                d = ((r + 1) * np.array(n[1 : k + 1]) / (r * np.array(n[:k])) - common) / (1 - common)
                if ((d > 0) & (d < 1)).all():
                    return np.concatenate([d * r, np.arange(k + 1, K + 1) - DELTA])
    return np.arange(1, K + 1) - 0.5


def discounted(counts: np.ndarray, table: np.ndarray) -> np.ndarray:
    """Counts (of 1 or more) less their discount."""
    return np.where(counts <= K, table[np.clip(counts, 1, K).astype(np.int64) - 1], counts - DELTA)


def freed(seen: np.ndarray, table: np.ndarray) -> np.ndarray:
    """What discounting takes off, from numbers of things seen 1 to K times and oftener (last axis)."""
    return seen @ np.concatenate([np.arange(1, K + 1) - table, [DELTA]])


class Unigrams:
    """The discounted unigram distribution, by a word's count."""

    def __init__(self, stats: list[int]):
        *self.n, self.words, self.tokens = (int(x or 0) for x in stats)  # n: seen 1 to K + 1 times
        self.table = discounts(self.n)
        oftener = self.words - sum(self.n[:K])
        self.unknown = float(freed(np.array([*self.n[:K], oftener]), self.table)) / self.tokens if self.tokens else 1.0

    def share(self, counts: np.ndarray) -> np.ndarray:
        return np.where(counts > 0, discounted(counts, self.table) / max(self.tokens, 1), self.unknown)

    def base(self, counts: np.ndarray) -> np.ndarray:
        """log10 of the add-half estimate."""
        return np.log10((counts + 0.5) / (self.tokens + 0.5 * (self.words + 1)))


# --- the passes -----------------------------------------------------------------------------


def tokenised(docs: DataFrame, training: Column, id_col: str, text_col: str, parts: int) -> DataFrame:
    """Per batch of texts one row with its word numbers (part null), and one with its words for each part asked."""
    kind = docs.schema[id_col].dataType.simpleString()
    held = F.when(training, 0).when(~training, 1).otherwise(2).cast("int")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, number = TaskContext.get().partitionId(), 0
        for big in batches:
            for b in sub_batches(big, "text", BATCH):
                pieces = [word_hashes(*buffers(x.column(1))) for x in sub_batches(b, "text", BATCH // 8)]
                h = np.concatenate([x[0] for x in pieces])
                n = np.concatenate([np.diff(x[1]) for x in pieces]) + 1
                ends = np.cumsum(n) - 1
                tokens = np.empty(int(n.sum()), np.uint64)
                tokens[ends] = END
                inner = np.ones(len(tokens), bool)
                inner[ends] = False
                tokens[inner] = h
                held_out = np.asarray(b.column(2)).astype(np.int64)
                words, which, often = np.unique(tokens, return_inverse=True, return_counts=True)
                learnt = np.bincount(which, np.repeat(held_out == 0, n), len(words)).astype(np.int64)
                rank = np.empty(len(words), np.int64)  # frequent words have small numbers
                rank[np.argsort(-often, kind="stable")] = np.arange(len(words))
                part = ((words >> np.uint64(32)) % np.uint64(parts)).astype(np.int64)
                order = np.argsort(part, kind="stable")
                asked, bounds = np.unique(part[order], return_index=True)
                bounds = [*bounds.tolist(), len(words)]
                batch = (task << 32) + number
                number += 1
                payload = [bundle(rank[which], n, held_out, rank[order])]
                payload += [bundle(steps(words[order[lo:hi]]), learnt[order[lo:hi]]) for lo, hi in zip(bounds, bounds[1:], strict=False)]
                rows = len(payload)
                none = [None] * (rows - 1)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([batch] * rows, pa.int64()), pa.array([None, *asked.tolist()], pa.int32()), pa.array([int((held_out == 0).sum()), *none], pa.int64()),
                        pa.concat_arrays([pa.ListArray.from_arrays(pa.array([0, b.num_rows], pa.int32()), b.column(0)), pa.nulls(rows - 1, pa.list_(b.column(0).type))]), pa.array(payload, pa.binary()),
                    ],
                    ["batch", "part", "learnt", "ids", "payload"],
                )

    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"), held.alias("held"))
    return rows.mapInArrow(run, f"batch long, part int, learnt long, ids array<{kind}>, payload binary")


#: Rows of answers: `kind` 0 counts of counts, 1 vocabulary, 2 bigrams, 3 a salted context that a batch asks for, 4 a share of one.
ANSWERS = "batch long, kind int, part int, context long, stats array<long>, mass double, payload binary"
_FIELDS = pa.schema([("batch", pa.int64()), ("kind", pa.int32()), ("part", pa.int32()), ("context", pa.int64()), ("stats", pa.list_(pa.int64())), ("mass", pa.float64()), ("payload", pa.binary())])


def table_of(rows: list[tuple]) -> pa.Table:
    return pa.Table.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), _FIELDS, strict=True)], schema=_FIELDS) if rows else _FIELDS.empty_table()


def vocabulary(asked: DataFrame, parts: int) -> DataFrame:
    """Counts and numbers of all words that batches ask for, by part."""

    def run(t: pa.Table) -> pa.Table:
        part, batches = t["part"][0].as_py(), t["batch"].to_pylist()
        blocks = [unbundle(x.as_py()) for x in t["payload"]]
        hashes = [np.cumsum(x[0].view(np.uint64)) for x in blocks]
        words, which = np.unique(np.concatenate(hashes), return_inverse=True)
        counts = np.bincount(which, np.concatenate([x[1] for x in blocks]).astype(float), len(words)).astype(np.int64)
        place = np.empty(len(words), np.int64)
        place[np.argsort(-counts, kind="stable")] = np.arange(len(words))
        number = np.where(counts > 0, place * parts + part + START + 1, UNKNOWN)
        cuts = np.cumsum([0, *map(len, hashes)])
        rows = [(b, 1, part, None, None, None, bundle(counts[w], number[w])) for b, w in ((b, which[lo:hi]) for b, lo, hi in zip(batches, cuts[:-1], cuts[1:], strict=True))]
        often = np.bincount(np.minimum(counts, K + 2), minlength=K + 3)[1 : K + 2].tolist()
        return table_of([*rows, (None, 0, part, None, [*often, int((counts > 0).sum()), int(counts.sum())], None, None)])

    return asked.groupBy("part").applyInArrow(run, ANSWERS)


class Batch:
    """A batch's tokens with the counts of their words, and its different bigrams in the order in which parts are asked."""

    def __init__(self, main: pa.Table, answers: pa.Table, texts: int, parts: int, hot: int):
        self.tokens, self.lengths, self.held, slots = unbundle(main["payload"][0].as_py())
        got = [(p, unbundle(x.as_py())) for k, p, x in zip(answers["kind"].to_pylist(), answers["part"].to_pylist(), answers["payload"], strict=True) if k == 1]
        got.sort(key=lambda x: x[0])
        # by rank, the start mark behind them
        self.count, number = np.zeros(len(slots) + 1, np.int64), np.zeros(len(slots) + 1, np.int64)
        self.count[slots] = np.concatenate([x[0] for _, x in got])
        number[slots] = np.concatenate([x[1] for _, x in got])
        start = len(slots)
        self.count[start], number[start] = texts, START
        before = np.empty_like(self.tokens)
        before[1:] = self.tokens[:-1]
        self.first = np.cumsum(self.lengths) - self.lengths
        before[self.first] = start
        unknown = int(np.flatnonzero(self.count[:start] == 0)[0]) if (self.count[:start] == 0).any() else 0
        after = np.where(self.count[self.tokens] == 0, unknown, self.tokens)
        pairs, self.which = np.unique((before.astype(np.uint64) << np.uint64(32)) | after.astype(np.uint64), return_inverse=True)
        context, word = (pairs >> np.uint64(32)).astype(np.int64), (pairs & np.uint64(0xFFFFFFFF)).astype(np.int64)
        self.context_count, self.word_count = self.count[context], self.count[word]
        self.learnt = np.bincount(self.which, np.repeat(self.held == 0, self.lengths), len(pairs)).astype(np.int64)
        self.context, self.word = number[context], number[word]
        self.hot = self.context_count >= hot
        salt = mix64(self.word.astype(np.uint64)) % (1 + self.context_count // hot).astype(np.uint64)
        with np.errstate(over="ignore"):
            part = mix64(mix64(self.context.astype(np.uint64)) + salt) % np.uint64(parts)
        asked = np.flatnonzero(self.context_count > 0)
        self.asked = asked[np.lexsort((self.word[asked], self.context[asked], part[asked]))]
        self.parts, bounds = np.unique(part[self.asked], return_index=True)
        self.bounds = [*bounds.tolist(), len(self.asked)]

    def slices(self) -> Iterator[tuple[int, np.ndarray]]:
        """Each part asked, with the pairs it is asked for."""
        for p, lo, hi in zip(self.parts.tolist(), self.bounds, self.bounds[1:], strict=False):
            yield p, self.asked[lo:hi]


def requests(main: DataFrame, answers: DataFrame, texts: int, parts: int, hot: int) -> DataFrame:
    """What each batch asks the parts of the bigrams for."""

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        b = Batch(left, right, texts, parts, hot)
        rows = [(p, bundle(steps(b.context[i]), b.word[i], b.learnt[i], b.word_count[i], b.context_count[i])) for p, i in b.slices()]
        return pa.table({"batch": pa.array([left["batch"][0].as_py()] * len(rows), pa.int64()), "part": pa.array([p for p, _ in rows], pa.int32()), "payload": pa.array([x for _, x in rows], pa.binary())})

    return main.groupBy("batch").cogroup(answers.groupBy("batch")).applyInArrow(run, "batch long, part int, payload binary")


def bigrams(asked: DataFrame, unigrams: Unigrams, hot: int) -> DataFrame:
    """Counts of all bigrams that batches ask for, and what makes up alpha for the contexts of unseen ones, by part."""

    def run(t: pa.Table) -> pa.Table:
        part, batches = t["part"][0].as_py(), t["batch"].to_pylist()
        blocks = [unbundle(x.as_py()) for x in t["payload"]]
        cuts = np.cumsum([0, *(len(x[0]) for x in blocks)])
        columns = [np.concatenate([np.cumsum(x[0]) for x in blocks]), *(np.concatenate([x[k] for x in blocks]) for k in range(1, 5))]
        del blocks
        contexts, c = np.unique(columns[0], return_inverse=True)
        words, w = np.unique(columns[1], return_inverse=True)
        word_count, total = np.zeros(len(words), np.int64), np.zeros(len(contexts), np.int64)
        word_count[w], total[c] = columns[3], columns[4]
        pairs, which = np.unique(c * len(words) + w, return_inverse=True)
        counts = np.bincount(which, columns[2], len(pairs)).astype(np.int64)
        del columns, w
        seen = np.flatnonzero(counts)
        of = pairs[seen] // len(words)
        kinds = np.bincount(of * (K + 1) + np.minimum(counts[seen], K + 1) - 1, minlength=len(contexts) * (K + 1)).reshape(-1, K + 1)
        mass = np.bincount(of, unigrams.share(word_count[pairs[seen] % len(words)]), len(contexts))
        salted = total >= hot
        rows: list[tuple] = []
        for b, lo, hi in zip(batches, cuts[:-1], cuts[1:], strict=True):
            here = counts[which[lo:hi]]
            open_ = np.unique(c[lo:hi][here == 0])
            cold = open_[~salted[open_]]
            rows.append((b, 2, part, None, None, None, bundle(here, kinds[cold].ravel(), mass[cold].view(np.uint64))))
            rows += [(b, 3, part, x, None, None, None) for x in contexts[open_[salted[open_]]].tolist()]
        rows += [(None, 4, part, int(contexts[i]), kinds[i].tolist(), float(mass[i]), None) for i in np.flatnonzero(salted).tolist()]
        often = np.bincount(np.minimum(counts, K + 2), minlength=K + 3)[1 : K + 2].tolist()
        return table_of([*rows, (None, 0, part, None, often, None, None)])

    return asked.groupBy("part").applyInArrow(run, ANSWERS)


def salted_contexts(answers: DataFrame) -> DataFrame:
    """For each batch and salted context it asks for, the sums over all salts."""
    shares = answers.filter("kind = 4").groupBy("context").agg(*(F.sum(F.get("stats", F.lit(i))).alias(f"s{i}") for i in range(K + 1)), F.sum("mass").alias("mass"))
    shares = shares.select("context", F.array(*(f"s{i}" for i in range(K + 1))).alias("stats"), "mass")
    asked = answers.filter("kind = 3").select("batch", "kind", "part", "context").dropDuplicates(["batch", "context"])
    return asked.join(shares, "context").select("batch", "kind", "part", "context", "stats", "mass", F.lit(None).cast("binary").alias("payload"))


def evaluated(main: DataFrame, answers: DataFrame, texts: int, parts: int, hot: int, unigrams: Unigrams, table: np.ndarray, kind: str) -> DataFrame:
    """Scores of all texts of each batch."""

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        b = Batch(left, right, texts, parts, hot)
        rows = right.filter(pc.not_equal(right["kind"], 1)).to_pylist()
        got = {r["part"]: unbundle(r["payload"]) for r in rows if r["kind"] == 2}
        salted = sorted((r["context"], r["stats"], r["mass"]) for r in rows if r["kind"] == 3)
        p = unigrams.share(b.word_count)  # of contexts never seen, the whole answer

        def alpha(kinds: np.ndarray, mass: np.ndarray, total: np.ndarray) -> np.ndarray:
            return freed(kinds, table) / total / (1 - mass)

        for part, i in b.slices():
            counts, kinds, mass = got[part]
            met = i[counts > 0]
            p[met] = discounted(counts[counts > 0], table) / b.context_count[met]
            open_ = i[(counts == 0) & ~b.hot[i]]
            _, which = np.unique(b.context[open_], return_inverse=True)
            kinds, mass = kinds.reshape(-1, K + 1), mass.view(np.float64)
            p[open_] *= alpha(kinds[which], mass[which], b.context_count[open_])
            open_ = i[(counts == 0) & b.hot[i]]
            if len(open_):
                at = np.searchsorted(np.array([x[0] for x in salted]), b.context[open_])
                p[open_] *= alpha(np.array([x[1] for x in salted])[at], np.array([x[2] for x in salted])[at], b.context_count[open_])
        count = b.count[b.tokens]
        sums = [np.add.reduceat(x, b.first) for x in (count > 0, unigrams.base(count), np.log10(p)[b.which])]
        held = pa.array(b.held == 1, pa.bool_(), mask=b.held == 2)
        return pa.table([left["ids"].combine_chunks().flatten(), held, pa.array(b.lengths), pa.array(sums[0].astype(np.int64)), pa.array(sums[1]), pa.array(sums[2])], ["doc_id", "held_out", "n_tokens", "n_known", "base_score", "score"])

    out = main.groupBy("batch").cogroup(answers.groupBy("batch"))
    return out.applyInArrow(run, f"doc_id {kind}, held_out boolean, n_tokens long, n_known long, base_score double, score double")


def counted(answers: DataFrame, n: int) -> list[int]:
    """Sums of the counts of counts that parts report: n numbers."""
    return list(answers.filter("kind = 0").agg(*(F.sum(F.get("stats", F.lit(i))).alias(f"s{i}") for i in range(n))).first())


def score(docs: DataFrame, training: Column, id_col: str = "doc_id", text_col: str = "text", hot: int = HOT, parts: tuple[int, int] | None = None) -> DataFrame:
    """doc_id, held_out (not training), n_tokens, n_known, train_tokens, base_score and score of every row.

    `parts` are the numbers of parts of vocabulary and bigrams; by default they follow the bytes of all texts."""
    kind = docs.schema[id_col].dataType.simpleString()
    if parts is None:
        size = docs.agg(F.sum(F.octet_length(F.col(text_col)))).first()[0] or 0
        parts = 1 + size // (64 << 20), 1 + size // (6 << 20)
    rows = written(tokenised(docs, training, id_col, text_col, parts[0]), "katz-tokens")
    main = rows.filter("part IS NULL")
    words = written(vocabulary(rows.filter("part IS NOT NULL").select("batch", "part", "payload"), parts[0]), "katz-words")
    unigrams = Unigrams(counted(words, K + 3))
    texts = int(main.agg(F.sum("learnt")).first()[0] or 0)
    main, first = main.select("batch", "ids", "payload"), words.filter("kind = 1")
    pairs = written(bigrams(requests(main, first, texts, parts[1], hot), unigrams, hot), "katz-bigrams")
    table = discounts([x or 0 for x in counted(pairs, K + 1)])
    answers = first.union(pairs.filter("kind = 2")).union(salted_contexts(pairs))
    out = written(evaluated(main, answers, texts, parts[1], hot, unigrams, table, kind), "katz-scores")
    forget(rows, words, pairs)
    return out.withColumn("train_tokens", F.lit(unigrams.tokens).cast("long"))


def op12_katz(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scores of all documents under the model of those whose fold of five is not 1."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return score(docs, fold("doc_id", 5) != 1).select("doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {"op12_katz": op12_katz}
