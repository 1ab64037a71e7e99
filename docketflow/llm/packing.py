"""Operator 3, packing: cutting-stock column generation over length-histogram patterns.

Every document becomes token ids plus an end id. Its ids are cut into whole sequences of the
limit, one grid piece (a multiple of `grid` ids) and a crumb shorter than `grid`. A histogram of
grid-piece lengths feeds a linear program whose columns are patterns of pieces filling one
sequence; a knapsack dynamic program prices new columns. Rounded-down pattern counts are then
given to the documents by rank inside their length class, in closed form. Pieces that no rounded
pattern takes, and crumbs, follow each other in a stream cut at the limit; the stream's last part
is cut into powers of two, so that no sequence needs padding.

Cost: one tokenising pass over the text, one written table of compact ids, no shuffle of ids: the
pass numbers pieces inside each task, and only counts for (task, class) are summed globally. Ids are
cut by column functions; a worker keeps no pieces from one task to the next.

Nulls and empty texts have the end id alone. Repeated rows and repeated ids are packed as they
are, each row on its own. An empty table gives an empty result. Other columns are ignored.
"""

from __future__ import annotations

import json
import os
import re
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from docketflow.llm.common import mix64, small_enough, sub_batches, tidy, written

LIMIT = 2048
GRID = 16
END_ID = 1

# Letters below U+0250 after lower-casing; text beyond that goes to the tokenizer whole.
_LETTER = re.compile("[a-z\xaa\xb5\xba\xdf-\xf6\xf8-ɏ]").match
BLOCK = 3 << 18  # bytes of text taken apart at a time
BATCH_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch"
KEPT = 16 << 20  # bytes of pieces that are kept
_SPACE, _LETTERS, _OTHER, _QUOTED = range(4)
_TOKENIZERS: dict[str, tuple] = {}


def default_tokenizer() -> str:
    """Path of the public vocabulary file that the query uses; a parameter everywhere else."""
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def by_pieces(path: str) -> bool:
    """Whether a vocabulary file states the normaliser and splits that `encode` may take texts apart by."""
    with open(path, encoding="utf-8") as f:
        said = json.load(f)
    normal = said.get("normalizer") or {}
    steps = [x.get("type") for x in normal.get("normalizers", [normal])]
    before = said.get("pre_tokenizer") or {}
    splits = [x.get("pattern", {}).get("Regex", "") for x in before.get("pretokenizers", [before]) if x.get("type") == "Split"]
    model = said.get("model") or {}
    return steps == ["NFC", "Replace", "Lowercase"] and len(splits) == 1 and splits[0].endswith(r"[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+") and model.get("type") == "BPE" and model.get("end_of_word_suffix") == "</w>"


def kinds(raw: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Of each byte of lower-cased UTF-8 whether it is white space, of a letter, of another character, or of a word with an
    apostrophe, and the places of what can't be taken apart: letters beyond U+024F and marks of special tokens."""
    table = np.full(256, _OTHER, np.uint8)
    table[[32, 9, 10, 13]] = _SPACE
    table[ord("a") : ord("z") + 1] = _LETTERS
    kind = table[raw]
    lead = np.flatnonzero(raw >= 0xC0)
    odd = lead[:0]
    if len(lead):
        point = (raw[lead].astype(np.int32) & 31) << 6 | raw[lead + 1] & 63
        far = (raw[lead] >= 0xE0) | (point > 0x24F)
        odd, lead, point = lead[far], lead[~far], point[~far]
        latin = np.array([_LETTERS if _LETTER(chr(c)) else _OTHER for c in range(0x250)], np.uint8)
        kind[lead] = kind[lead + 1] = latin[point]
    marks = np.flatnonzero((raw[:-1] == ord("<")) & (raw[1:] == ord("|")))
    quotes = np.flatnonzero(raw == ord("'"))
    if len(quotes):  # an apostrophe may belong to what follows it, so the word between white space is one piece
        space = np.concatenate([[-1], np.flatnonzero(kind == _SPACE), [len(raw)]])
        word = np.unique(np.searchsorted(space, quotes))
        n = space[word] - space[word - 1] - 1
        kind[np.repeat(space[word - 1] + 1 - (np.cumsum(n) - n), n) + np.arange(n.sum())] = _QUOTED
    return kind, np.concatenate([odd, marks])


class Pieces:
    """Token ids of the pieces met of late, in flat arrays with an open hash table: some 40 bytes a piece and its own bytes.

    A piece is found by a 64-bit hash and then compared by its bytes.
    """

    def __init__(self, tok, ends: np.ndarray, most: int):
        self.tok, self.ends, self.most, self.now = tok, ends, most, 0
        self.byte_hash = mix64(np.arange(1, 257, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)) | np.uint64(1)
        self.powers(BLOCK)
        self.clear()

    def clear(self) -> None:
        self.key, self.first, self.size = np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int32)
        self.id_first, self.id_count, self.used = np.zeros(0, np.int64), np.zeros(0, np.int32), np.zeros(0, np.int32)
        self.bytes, self.ids = np.zeros(0, np.uint8), np.zeros(0, np.uint32)
        self.table = np.full(1 << 12, -1, np.int32)

    def powers(self, n: int) -> None:
        base = 0xD6E8FEB86659FD93
        with np.errstate(over="ignore"):
            self.power, self.back = np.full(n + 1, base, np.uint64), np.full(n + 1, pow(base, -1, 1 << 64), np.uint64)
            for x in (self.power, self.back):
                x[0] = 1
                np.multiply.accumulate(x, out=x)

    def find(self, h: np.ndarray) -> np.ndarray:
        """The number of the piece with each hash, or -1."""
        mask = np.uint64(len(self.table) - 1)
        if not len(self.key):
            return np.full(len(h), -1, np.int32)
        at = (h & mask).astype(np.int64)
        found = self.table[at]
        open_ = np.flatnonzero((found >= 0) & (self.key[found] != h))
        while len(open_):
            at[open_] = (at[open_] + 1) & int(mask)
            found[open_] = self.table[at[open_]]
            open_ = open_[(found[open_] >= 0) & (self.key[found[open_]] != h[open_])]
        return found

    def place(self, numbers: np.ndarray) -> None:
        mask = len(self.table) - 1
        at = (self.key[numbers] & np.uint64(mask)).astype(np.int64)
        while len(numbers):
            free = self.table[at] < 0
            self.table[at[free]] = numbers[free]
            left = self.table[at] != numbers
            numbers, at = numbers[left], (at[left] + 1) & mask

    def add(self, key: np.ndarray, words: list[bytes], letters: np.ndarray) -> None:
        """Encodes new pieces, different ones with different keys; `letters` marks those of letters alone."""
        order, got, counts = [], [], []
        plain, rest = np.flatnonzero(letters).tolist(), np.flatnonzero(~letters).tolist()
        for lo in range(0, len(plain), 2000):
            some = plain[lo : lo + 2000]
            ids = np.array(self.tok.encode_batch_fast([b" ".join([words[k] for k in some]).decode()], add_special_tokens=False)[0].ids, np.uint32)
            cuts = np.flatnonzero(self.ends[ids]) + 1  # a word of letters alone ends at its one word-end token
            if len(cuts) == len(some):
                order += some
                got.append(ids)
                counts.append(np.diff(cuts, prepend=0))
            else:
                rest += some
        for lo in range(0, len(rest), 2000):  # an encoding takes far more memory than its ids
            some = rest[lo : lo + 2000]
            found = [e.ids for e in self.tok.encode_batch_fast([words[k].decode() for k in some], add_special_tokens=False)]
            order += some
            got += [np.array(x, np.uint32) for x in found]
            counts.append(np.array([len(x) for x in found]))
        key, words, count = key[order], [words[k] for k in order], np.concatenate(counts).astype(np.int32)
        size = np.array([len(w) for w in words], np.int32)
        old = len(self.key)
        self.first = np.concatenate([self.first, len(self.bytes) + np.cumsum(size, dtype=np.int64) - size])
        self.id_first = np.concatenate([self.id_first, len(self.ids) + np.cumsum(count, dtype=np.int64) - count])
        self.key, self.size, self.id_count = np.concatenate([self.key, key]), np.concatenate([self.size, size]), np.concatenate([self.id_count, count])
        self.used = np.concatenate([self.used, np.full(len(key), self.now, np.int32)])
        self.bytes, self.ids = np.concatenate([self.bytes, np.frombuffer(b"".join(words), np.uint8)]), np.concatenate([self.ids, *got])
        if 2 * len(self.key) > len(self.table):
            self.table = np.full(1 << int(4 * len(self.key)).bit_length(), -1, np.int32)
            old = 0
        self.place(np.arange(old, len(self.key), dtype=np.int32))

    def thin(self) -> None:
        """Half of the pieces, those met of late, stay."""
        order = np.argsort(-self.used, kind="stable")[: self.most // 2]
        stay = order[np.cumsum(self.size[order], dtype=np.int64) <= KEPT // 2]
        kept = [x[stay] for x in (self.key, self.size, self.id_count, self.used)]
        data, ids = self.bytes[stretches(self.first[stay], kept[1])], self.ids[stretches(self.id_first[stay], kept[2])]
        self.clear()
        self.key, self.size, self.id_count, self.used = kept
        self.first, self.id_first = np.cumsum(self.size, dtype=np.int64) - self.size, np.cumsum(self.id_count, dtype=np.int64) - self.id_count
        self.bytes, self.ids = data, ids
        self.table = np.full(1 << int(4 * len(stay) + 1).bit_length(), -1, np.int32)
        self.place(np.arange(len(stay), dtype=np.int32))

    def encode(self, parts: list[bytes]) -> list[bytes | None]:
        """Ids of each part as bytes; None for those that the tokenizer must take whole."""
        raw = np.frombuffer(b"\n".join(parts) + b"\n", np.uint8)
        size = np.array([len(x) + 1 for x in parts], np.int64)
        begin = np.cumsum(size) - size
        kind, odd = kinds(raw)
        good = np.ones(len(parts), bool)
        good[np.searchsorted(begin, odd, side="right") - 1] = False
        turn = np.flatnonzero(np.diff(kind, prepend=np.uint8(_SPACE)))  # a part ends with white space
        turn_kind = kind[turn]
        start = turn[turn_kind != _SPACE]
        end = turn[1:][turn_kind[:-1] != _SPACE] if len(turn) else turn
        if not good.all():
            mine = good[np.searchsorted(begin, start, side="right") - 1]
            start, end = start[mine], end[mine]
        if len(raw) >= len(self.power):
            self.powers(len(raw))
        with np.errstate(over="ignore"):
            total = np.zeros(len(raw) + 1, np.uint64)
            np.cumsum(self.byte_hash[raw] * self.power[: len(raw)], out=total[1:])
            h = mix64((total[end] - total[start]) * self.back[start] + (end - start).astype(np.uint64))
        del total
        self.now += 1
        if len(self.key) > self.most or len(self.bytes) > KEPT:
            self.thin()
        found = self.find(h)
        new = np.flatnonzero(found < 0)
        if len(new):
            key, at = np.unique(h[new], return_index=True)
            at = new[at]
            data = raw.tobytes()
            self.add(key, [data[x:y] for x, y in zip(start[at].tolist(), end[at].tolist(), strict=True)], kind[start[at]] == _LETTERS)
            found[new] = self.find(h[new])
        self.used[found] = self.now
        n = (end - start).astype(np.int32)
        same = n == self.size[found]  # unless two pieces have one hash
        k = np.minimum(n, self.size[found])
        differ = np.flatnonzero(raw[stretches(start, k)] != self.bytes[stretches(self.first[found], k)])
        same[np.searchsorted(np.cumsum(k), differ, side="right")] = False
        good[np.searchsorted(begin, start[~same], side="right") - 1] = False
        count = self.id_count[found]
        ids = self.ids[stretches(self.id_first[found], count)].astype("<u4", copy=False).tobytes()
        upto = 4 * np.concatenate([[0], np.cumsum(count, dtype=np.int64)])
        cut = upto[np.searchsorted(start, np.concatenate([begin, [len(raw)]]))].tolist()
        return [ids[x:y] if g else None for g, x, y in zip(good.tolist(), cut[:-1], cut[1:], strict=True)]


def stretches(first: np.ndarray, size: np.ndarray) -> np.ndarray:
    """The places first, first + 1, ... of each stretch of some size, one stretch after the other."""
    upto = np.cumsum(size, dtype=np.int64)
    return np.repeat(first - (upto - size), size) + np.arange(upto[-1] if len(upto) else 0)


def split(text: bytes) -> Iterator[bytes]:
    """A text in parts of some `BLOCK` bytes, cut at white space."""
    lo = 0
    while len(text) - lo > BLOCK:
        at = text.rfind(b" ", lo + 1, lo + BLOCK)
        if at < 0:
            at = text.find(b" ", lo + BLOCK)
            if at < 0:
                break
        yield text[lo:at]
        lo = at
    yield text[lo:]


def encode(texts: list[str | None], path: str, most: int = 400_000) -> list[bytes]:
    """Token ids of each text as little-endian 32-bit bytes.

    A vocabulary that lower-cases, drops white space and splits at every border between letters and
    other characters (its file says so) has pieces between such borders encoded once and kept (about
    `most` of them, those met of late). Texts with letters beyond U+024F or with special-token marks, and all texts under
    any other vocabulary, are encoded whole.
    """
    os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a forked worker must not start threads
    from tokenizers import Tokenizer

    if path not in _TOKENIZERS:
        tok = Tokenizer.from_file(path)
        vocab = tok.get_vocab()
        word_end = np.zeros(max(vocab.values()) + 1, bool)
        word_end[[i for w, i in vocab.items() if w.endswith("</w>")]] = True
        _TOKENIZERS[path] = tok, Pieces(tok, word_end, most) if by_pieces(path) else None
    tok, pieces = _TOKENIZERS[path]
    if pieces is None:
        return [np.array(e.ids, "<u4").tobytes() for e in tok.encode_batch_fast([x or "" for x in texts], add_special_tokens=False)]
    pieces.most = most
    out: list[list[bytes | None]] = [[] for _ in texts]
    owner: list[int] = []
    parts: list[bytes] = []
    bytes_ = 0
    for i, x in enumerate(texts):
        for part in split(x.lower().encode()) if x else ():
            if parts and bytes_ + len(part) > BLOCK:
                for k, ids in zip(owner, pieces.encode(parts), strict=True):
                    out[k].append(ids)
                owner, parts, bytes_ = [], [], 0
            owner.append(i)
            parts.append(part)
            bytes_ += len(part) + 1
    if parts:
        for k, ids in zip(owner, pieces.encode(parts), strict=True):
            out[k].append(ids)
    return [np.array(tok.encode(x, add_special_tokens=False).ids, "<u4").tobytes() if None in v else v[0] if len(v) == 1 else b"".join(v) for x, v in zip(texts, out, strict=True)]


def drop_pieces() -> None:
    """Pieces are kept no longer than a task: its worker stays, idle, beside those at work."""
    for _, pieces in _TOKENIZERS.values():
        if pieces is not None:
            pieces.clear()


def tokenised(docs: DataFrame, path: str, limit: int = LIMIT, grid: int = GRID, end_id: int = END_ID, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: ids as bytes and their number, the task that made it, and how many whole pieces,
    pieces of its class and crumb ids that task made before it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task = TaskContext.get().partitionId()
        seen = np.zeros(limit // grid + 1, np.int64)
        wholes = crumbs = 0
        tail = np.array([end_id], "<u4").tobytes()
        for big in batches:
            for b in sub_batches(big, text_col, 1 << 19):
                ids = [x + tail for x in encode(b.column(1).to_pylist(), path)]
                n = np.array([len(x) // 4 for x in ids], np.int64)
                cls = n % limit // grid
                before_whole = wholes + np.concatenate([[0], np.cumsum(n // limit)])
                before_crumb = crumbs + np.concatenate([[0], np.cumsum(n % grid)])
                wholes, crumbs = int(before_whole[-1]), int(before_crumb[-1])
                rank = np.zeros(len(n), np.int64)
                order = np.argsort(cls, kind="stable")
                first = np.searchsorted(cls[order], cls[order])
                rank[order] = np.arange(len(n)) - first
                rank += seen[cls]
                seen += np.bincount(cls, minlength=len(seen))
                yield pa.RecordBatch.from_arrays(
                    [b.column(0), pa.array(np.full(len(n), task, np.int32)), pa.array(n), pa.array(cls.astype(np.int32)), pa.array(rank), pa.array(before_whole[:-1]), pa.array(before_crumb[:-1]), pa.array(ids, pa.binary())],
                    ["doc_id", "task", "n", "cls", "rank", "wholes", "crumbs", "ids"],
                )
        drop_pieces()

    kind = docs.schema[id_col].dataType.simpleString()
    return docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias(text_col)).mapInArrow(tidy(run), f"doc_id {kind}, task int, n long, cls int, rank long, wholes long, crumbs long, ids binary")


# --- the linear program ---------------------------------------------------------------------


def price(values: np.ndarray, sizes: np.ndarray, capacity: int) -> tuple[float, np.ndarray]:
    """Unbounded knapsack by dynamic programming: the best value of sizes within capacity, and its counts."""
    best = np.zeros(capacity + 1)
    take = np.full(capacity + 1, -1, np.int64)
    for c in range(1, capacity + 1):
        best[c] = best[c - 1]
        fits = np.flatnonzero(sizes <= c)
        if len(fits):
            got = best[c - sizes[fits]] + values[fits]
            k = int(np.argmax(got))
            if got[k] > best[c] + 1e-12:
                best[c], take[c] = got[k], fits[k]
    counts = np.zeros(len(sizes), np.int64)
    c = capacity
    while c > 0:
        if take[c] < 0:
            c -= 1
        else:
            counts[take[c]] += 1
            c -= int(sizes[take[c]])
    return float(best[capacity]), counts


def solve(demand: np.ndarray, capacity: int, rounds: int = 2000) -> tuple[np.ndarray, np.ndarray]:
    """Fewest sequences for demand[k] pieces of size k+1, by column generation with a revised simplex.

    Returns patterns (rows: counts by class) and the number of times each is used (fractional).
    The master has a row for each class in use, so its size is bounded by the grid, not by the data.
    """
    used = np.flatnonzero(demand > 0)
    if not len(used):
        return np.zeros((0, len(demand)), np.int64), np.zeros(0)
    sizes = used + 1
    need = demand[used].astype(float)
    basis = np.diag(capacity // sizes).astype(float)  # columns are patterns, or -1 for more pieces than needed
    cost = np.ones(len(used))
    inverse = np.diag(1.0 / (capacity // sizes))
    x = inverse @ need
    for _ in range(rounds):
        duals = cost @ inverse
        worst = int(np.argmin(duals))
        if duals[worst] < -1e-7:
            column, price_of = np.zeros(len(used)), 0.0
            column[worst] = -1
        else:
            value, column = price(np.maximum(duals, 0), sizes, capacity)
            price_of = 1.0
            if value <= 1 + 1e-7:
                break
        d = inverse @ column
        up = d > 1e-9
        if not up.any():
            break
        ratio = np.full(len(x), np.inf)
        ratio[up] = x[up] / d[up]
        r = int(np.argmin(ratio))
        t = ratio[r]
        x = np.maximum(x - t * d, 0)
        x[r] = t
        basis[:, r], cost[r] = column, price_of
        row = inverse[r] / d[r]
        inverse = inverse - np.outer(d, row)
        inverse[r] = row
    x, basis = x[cost > 0], basis[:, cost > 0]
    patterns = np.zeros((len(x), len(demand)), np.int64)
    patterns[:, used] = basis.T.round().astype(np.int64)
    return patterns, x


class Layout:
    """Where the k-th piece of each class lies: rounded patterns first, then the stream."""

    def __init__(self, demand: np.ndarray, wholes: int, crumbs: int, limit: int = LIMIT, grid: int = GRID):
        capacity = limit // grid
        patterns, x = solve(demand, capacity)
        uses = np.floor(x + 1e-6).astype(np.int64)
        full = (patterns * np.arange(1, len(demand) + 1)).sum(axis=1) == capacity
        left = demand.copy()
        self.runs: list[list[tuple[int, int, int, int, int]]] = [[] for _ in demand]  # by class: first rank, end, each, first sequence, offset
        sequence = wholes
        taken = np.zeros(len(demand), np.int64)
        for p in np.argsort(-uses, kind="stable"):
            each = patterns[p]
            n = int(min([uses[p], *(left[each > 0] // each[each > 0])])) if full[p] else 0
            if n <= 0:
                continue
            offset = 0
            for c in np.flatnonzero(each):
                k = int(each[c])
                self.runs[c].append((int(taken[c]), int(taken[c]) + n * k, k, sequence, offset))
                taken[c] += n * k
                left[c] -= n * k
                offset += k * (int(c) + 1) * grid
            sequence += n
        self.taken, self.limit, self.grid = taken, limit, grid
        self.first_stream = sequence
        self.class_base = np.concatenate([[0], np.cumsum(left * (np.arange(len(demand)) + 1) * grid)])
        self.crumb_base = int(self.class_base[-1])
        self.total = self.crumb_base + crumbs
        chunks, rest = divmod(self.total, limit)
        # the tail's power-of-two sequences: starts in the stream, largest first
        starts, at = [chunks * limit], chunks * limit
        for bit in reversed(range(limit.bit_length())):
            if rest >> bit & 1:
                at += 1 << bit
                starts.append(at)
        self.tail, self.chunks = np.array(starts, np.int64), chunks

    def classes(self) -> pa.Table:
        """By class: the pieces that patterns take, where its other pieces begin in the stream, and its runs."""
        run = pa.struct([(x, pa.int64()) for x in ("first", "end", "each", "sequence", "offset")])
        runs = [[dict(zip(("first", "end", "each", "sequence", "offset"), r, strict=True)) for r in rs] for rs in self.runs]
        return pa.table({"cls": pa.array(range(1, len(runs) + 1), pa.int32()), "taken": pa.array(self.taken), "base": pa.array(self.class_base[:-1]), "runs": pa.array(runs, pa.list_(run))})

    def stream(self, start: Column, at: Column, length: Column) -> Column:
        """Pieces of a stretch of the stream shorter than a sequence, which begins at `at` there and at `start` in its document."""
        last, after = at + length, at - at % self.limit + self.limit
        tail = F.array(*[F.lit(int(x)) for x in self.tail])
        inside = F.when((after < last) & (after < self.chunks * self.limit), F.array(after)).otherwise(F.array().cast("array<long>"))
        begin = F.concat(F.array(at), inside, F.filter(tail, lambda t: (t > at) & (t < last)))

        def cut(b: Column, i: Column) -> Column:
            before = F.filter(tail, lambda t: t <= b)
            whole = b < self.chunks * self.limit
            sequence = self.first_stream + F.when(whole, quotient(b, self.limit)).otherwise(self.chunks + F.size(before) - 1)
            return piece(start + b - at, F.coalesce(F.get(begin, i + 1), last) - b, sequence, F.when(whole, b % self.limit).otherwise(b - F.get(before, F.size(before) - 1)))

        return F.transform(begin, cut)


def quotient(n: Column, by: Column | int) -> Column:
    return ((n - n % by) / by).cast("long")


def piece(start: Column, length: Column, sequence: Column, offset: Column) -> Column:
    return F.struct(*[x.cast("long").alias(name) for x, name in ((start, "start"), (length, "length"), (sequence, "sequence_id"), (offset, "offset"))])


def pack(docs: DataFrame, path: str, limit: int = LIMIT, grid: int = GRID, end_id: int = END_ID, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Pieces of every document: doc_id, start, length, ids (little-endian 32-bit), doc_tokens, sequence_id, offset."""
    spark = docs.sparkSession
    whole = spark.conf.get(BATCH_BYTES)
    spark.conf.set(BATCH_BYTES, "4m")  # else Spark, its socket and the task each hold 10,000 texts at once
    try:
        rows = written(tokenised(docs, path, limit, grid, end_id, id_col, text_col), "pack")
    finally:
        spark.conf.set(BATCH_BYTES, whole)
    classes = limit // grid
    # What each task made, by class; class -1 stands for whole pieces and -2 for crumb ids.
    made = rows.groupBy("task", F.col("cls").alias("c")).agg(F.count("*").alias("k"), F.sum(F.floor(F.col("n") / limit)).alias("w"), F.sum(F.col("n") % grid).alias("t"))
    made = made.select("task", F.explode(F.array(F.struct(F.col("c"), F.col("k")), F.struct(F.lit(-1).alias("c"), F.col("w").alias("k")), F.struct(F.lit(-2).alias("c"), F.col("t").alias("k")))).alias("x")).groupBy("task", F.col("x.c").alias("c")).agg(F.sum("x.k").alias("k"))
    before = made.withColumn("b", F.coalesce(F.sum("k").over(W.partitionBy("c").orderBy("task").rowsBetween(W.unboundedPreceding, -1)), F.lit(0)))
    before = written(before, "pack-before")
    total = {r.c: r.k for r in before.groupBy("c").agg(F.sum("k").alias("k")).collect()}  # at most limit / grid + 2 rows
    demand = np.array([total.get(c, 0) for c in range(1, classes)], np.int64)
    layout = Layout(demand, int(total.get(-1, 0)), int(total.get(-2, 0)), limit, grid)
    by_task = before.groupBy("task").agg(F.map_from_entries(F.collect_list(F.struct("c", "b"))).alias("base"))  # at most limit / grid + 2 entries each
    if small_enough(by_task, 16 * (classes + 2)):
        by_task = F.broadcast(by_task)
    joined = rows.join(by_task, "task").select("doc_id", "n", "cls", "ids", (F.col("rank") + F.coalesce(F.element_at("base", F.col("cls")), F.lit(0))).alias("rank"), (F.col("wholes") + F.coalesce(F.element_at("base", F.lit(-1)), F.lit(0))).alias("wholes"), (F.col("crumbs") + F.coalesce(F.element_at("base", F.lit(-2)), F.lit(0))).alias("crumbs"))

    # Cuts are found and ids sliced by Spark, so that no ids go to Python again.
    joined = joined.join(F.broadcast(spark.createDataFrame(layout.classes())), "cls", "left")  # at most limit / grid rows
    n, rank, size = F.col("n"), F.col("rank"), F.col("cls").cast("long") * grid
    at, none = n - n % limit, F.array().cast("array<struct<start:long,length:long,sequence_id:long,offset:long>>")
    joined = joined.withColumn("run", F.get(F.filter("runs", lambda r: (rank >= r["first"]) & (rank < r["end"])), F.lit(0)))
    k = rank - F.col("run.first")
    each = F.col("run.each")
    wholes = F.when(n >= limit, F.transform(F.sequence(F.lit(0).cast("long"), quotient(n, limit) - 1), lambda i: piece(i * limit, F.lit(limit), F.col("wholes") + i, F.lit(0)))).otherwise(none)
    fit = F.when(F.col("run").isNotNull(), F.array(piece(at, size, F.col("run.sequence") + quotient(k, each), F.col("run.offset") + k % each * size))).when(size > 0, layout.stream(at, F.col("base") + (rank - F.col("taken")) * size, size)).otherwise(none)
    crumb = F.when(n % grid > 0, layout.stream(n - n % grid, layout.crumb_base + F.col("crumbs"), n % grid)).otherwise(none)
    pieces = joined.select("doc_id", "ids", n.alias("doc_tokens"), F.explode(F.concat(wholes, fit, crumb)).alias("p"))
    ids = F.substring("ids", (4 * F.col("p.start") + 1).cast("int"), (4 * F.col("p.length")).cast("int"))
    return pieces.select("doc_id", "p.start", "p.length", ids.alias("ids"), "doc_tokens", "p.sequence_id", "p.offset")


def op3_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents packed into sequences of at most 2048 tokens, with a checksum of each piece's ids."""
    return digest(pack(spark.read.parquet(f"{sf_dir}/documents.parquet"), default_tokenizer()))


def digest(pieces: DataFrame) -> DataFrame:
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {"op3_packing": op3_packing}
