"""Operator 9, toxicity: weak supervision by many lexicon and pattern voters.

Voters are a fixed insult lexicon, text patterns, and words and word beginnings mined from labelled
learning rows. A generative label model (latent class, fitted by expectation-maximisation) estimates
each voter's accuracy in both classes, and the correlations of voters given the class, by which
correlated voters share one voice. Known labels set the prior and the first accuracies, and vote too:
a label is one more voter, whose error rate (`LABEL_ERROR` at first) the model estimates like the
others', between 0.5 % and 20 %. A linear classifier trained on the posteriors of labelled and
unlabelled rows then scores every document; a row counts by how sure its posterior is, and one without
a label `UNLABELLED_WEIGHT` as much.

Fitting uses at most `sample` labelled rows (a documented bound; rows with the smallest hash of
their id) and about `unlabelled` rows without a used label (a documented parameter; rows whose hash of
id and text is below a threshold, rows alike once, outside the held-out fold); scoring covers every
whole text without a shuffle. Labels of held-out rows are never looked at.

A row without an id is scored and not learnt from, and its held_out is null.
Null and empty texts get the score of a text without any vote. Repeated rows score alike. Without
any positive or negative labelled row the score is the share of positive labels (0 without labels).
An empty table gives an empty result. Label rows with a null id or a null label are ignored. Other
columns are ignored.
"""

from __future__ import annotations

import math
import re
from collections.abc import Callable, Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from docketflow.llm.common import fold, sub_batches, tidy

SAMPLE = 8000
UNLABELLED = 8000
LABEL_ERROR = 0.02
UNLABELLED_WEIGHT = 0.3
MINED = 160
#: Common insults, by language. The mined voters carry what these miss.
LEXICON = {
    "en": "idiot moron stupid dumb loser scum trash garbage clown fool jerk pathetic worthless disgusting filthy vermin bastard imbecile ugly hate".split(),
    "de": "idiot trottel dumm arschloch abschaum dreckig ekelhaft widerlich wertlos".split(),
    "fr": "idiot imbécile stupide connard ordure crétin dégoûtant minable".split(),
    "es": "idiota imbécil estúpido basura escoria asqueroso inútil payaso".split(),
}
#: Pattern voters over the raw text.
PATTERNS = (r"!{3,}", r"\b(?:[A-ZÀ-Þ]{3,}\W+){5}", r"(?i)\byou(?:'re| are)\b", r"(?i)\bshut up\b", r"(?i)\bgo (?:away|to hell|die)\b", r"\*{2,}")
_LETTERS = re.compile(r"[\W\d_]+")


def normal(text: str | None) -> str:
    """Lower case, each run of other characters than letters one space, spaces at both ends."""
    return f" {_LETTERS.sub(' ', (text or '').lower())} "


def _features(text: str) -> set[str]:
    words = set(normal(text).split())
    out = {f" {w} " for w in words}
    for w in words:
        out.update(" " + w[:k] for k in range(4, min(len(w), 7) + 1))
    return out


class Voters:
    """Counts votes of every voter in a text."""

    def __init__(self, marks: list[str]):
        self.marks = marks
        self.patterns = [re.compile(p) for p in PATTERNS]
        self.automaton = ahocorasick.Automaton()
        for i, m in enumerate(marks):
            self.automaton.add_word(m, i)
        self.automaton.make_automaton()

    def counts(self, texts: list[str | None]) -> np.ndarray:
        n = len(self.marks)
        out = np.zeros((len(texts), n + len(self.patterns)), np.int32)
        for r, t in enumerate(texts):
            if not t:
                continue
            for _, k in self.automaton.iter(normal(t)):
                out[r, k] += 1
            for k, p in enumerate(self.patterns):
                out[r, n + k] = p.search(t) is not None
        return out


def label_model(votes: np.ndarray, known: np.ndarray, rounds: int = 25) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Posterior of the positive class by row, accuracies (P(vote | class), by class) and each voter's
    share of a voice. votes: 0/1 by (row, voter). known: 1, 0 or -1 (unknown)."""
    v = votes.astype(float)
    seen = known >= 0
    wrong = LABEL_ERROR
    p = np.where(seen, known, known[seen].mean() if seen.any() else 0.1).astype(float)
    voice = np.ones(v.shape[1])
    rates = np.zeros((2, v.shape[1]))
    for step in range(rounds):
        prior = np.clip(p.mean(), 1e-3, 1 - 1e-3)
        for c, w in ((1, p), (0, 1 - p)):
            rates[c] = ((v * w[:, None]).sum(0) + 0.05) / (w.sum() + 1.0)
        if step in (3, 12):  # correlations given the class, over centred votes
            corr = np.zeros((v.shape[1],) * 2)
            for c, w in ((1, p), (0, 1 - p)):
                z = (v - rates[c]) * np.sqrt(w)[:, None]
                cov = np.einsum("ij,ik->jk", z, z, optimize=False)
                sd = np.sqrt(np.maximum(np.diag(cov), 1e-9))
                corr = np.maximum(corr, cov / sd[:, None] / sd[None, :] * (w.sum() > 20))
            corr[corr < 0.3] = 0
            np.fill_diagonal(corr, 0)
            voice = 1 / (1 + corr.sum(0))
        on = np.log(rates[1] / rates[0]) * voice
        off = np.log((1 - rates[1]) / (1 - rates[0])) * voice
        odds = math.log(prior / (1 - prior)) + (v * on + (1 - v) * off).sum(1)
        odds += np.where(seen, np.where(known == 1, 1, -1) * math.log((1 - wrong) / wrong), 0.0)
        p = 1 / (1 + np.exp(-np.clip(odds, -30, 30)))
        if seen.any():
            wrong = float(np.clip((np.abs(p - known)[seen].sum() + LABEL_ERROR) / (seen.sum() + 1), 0.005, 0.2))
    return p, rates, voice


def _design(counts: np.ndarray, voice: np.ndarray) -> np.ndarray:
    x = np.log1p(counts)
    n = counts.shape[1] - len(PATTERNS)
    fired = (counts[:, :n] > 0) * voice[:n]
    total = fired.sum(1)
    return np.column_stack([np.ones(len(x)), x, total, np.minimum(total, 1), np.minimum(total, 2)])


def linear(x: np.ndarray, y: np.ndarray, steps: int = 1000, l2: float = 1e-4, weight: np.ndarray | None = None) -> np.ndarray:
    """Logistic regression by Adam over soft labels, rows weighted."""
    share = np.full(len(x), 1 / max(len(x), 1)) if weight is None else weight / max(weight.sum(), 1e-9)
    w, m, s = np.zeros(x.shape[1]), np.zeros(x.shape[1]), np.zeros(x.shape[1])
    for t in range(1, steps + 1):
        p = 1 / (1 + np.exp(-np.clip((x * w).sum(1), -30, 30)))
        g = (x * ((p - y) * share)[:, None]).sum(0) + l2 * w
        m, s = 0.9 * m + 0.1 * g, 0.999 * s + 0.001 * g * g
        w = w - 0.05 * (m / (1 - 0.9**t)) / (np.sqrt(s / (1 - 0.999**t)) + 1e-8)
    return w


def learning_rows(docs: DataFrame, labels: DataFrame, label: str, parts: int, held: int, sample: int, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """At most `sample` labelled rows outside the held-out fold: text, y. The ids are a bounded set, so broadcast."""
    ids = labels.filter(F.col("doc_id").isNotNull() & F.col(label).isNotNull() & (fold("doc_id", parts) != held)).groupBy("doc_id").agg(F.max(label).alias("y"))
    ids = ids.orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample)
    return docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")).join(F.broadcast(ids), "doc_id").select("doc_id", "text", "y").orderBy(F.xxhash64("doc_id"), "doc_id", "text").limit(sample)


def fit(docs: DataFrame, labels: DataFrame, label: str = "toxic", parts: int = 4, held: int = 2, sample: int = SAMPLE, unlabelled: int = UNLABELLED, id_col: str = "doc_id", text_col: str = "text") -> dict:
    """Voters, label model and classifier, all small."""
    rows = learning_rows(docs, labels, label, parts, held, sample, id_col, text_col).cache()
    base = rows.agg(F.count("*").alias("n"), F.sum("y").alias("p")).first()
    n, pos = base.n, int(base.p or 0)
    if not pos or pos == n:
        rows.unpersist()
        return {"marks": [], "voice": np.ones(len(PATTERNS)), "w": None, "share": pos / n if n else 0.0}

    def features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for t, y in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                f = sorted(_features(t or ""))
                yield pa.RecordBatch.from_arrays([pa.array(f, pa.string()), pa.array(np.full(len(f), y, np.int32))], ["f", "y"])

    found = rows.select("text", F.col("y").cast("int").alias("y")).repartition(8).mapInArrow(tidy(features), "f string, y int").groupBy("f").agg(F.sum("y").alias("p"), F.count("*").alias("n"))
    least = max(4, pos // 80)
    # a cautious log odds ratio: the positive count less 1.3 of its deviations, the negative one more than seen
    odds = F.log(((F.col("p") - 1.3 * F.sqrt("p")) / pos) / ((F.col("n") - F.col("p") + 1.5) / (n - pos)))
    mined = found.filter((F.col("p") >= least) & (odds > math.log(4))).orderBy(F.desc(F.col("p") * odds), "f").limit(MINED).collect()
    marks = list(dict.fromkeys([f" {w} " for words in LEXICON.values() for w in words] + [r.f for r in mined]))
    ids, texts = F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")
    draw = F.xxhash64(F.col(id_col).cast("string"), text_col)
    share = min(1.0, unlabelled / max(docs.count(), 1))
    other = docs.filter(((fold(id_col, parts) != held) | F.col(id_col).isNull()) & (draw.cast("double") / 2.0**63 <= 2 * share - 1)).select(ids, texts, draw.alias("draw"))
    other = other.join(F.broadcast(rows.select("doc_id")), "doc_id", "left_anti").groupBy("draw").agg(F.min("text").alias("text")).select("text", F.lit(-1).alias("y"))

    def vote(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Vote counts in the tasks: the driver gets numbers, never texts."""
        mine = Voters(marks)
        for big in batches:
            for b in sub_batches(big, "text", 1 << 20):
                c = mine.counts(b.column(0).to_pylist())
                flat = pa.ListArray.from_arrays(pa.array(np.arange(len(c) + 1, dtype=np.int32) * c.shape[1]), pa.array(c.ravel().astype(np.int32)))
                yield pa.RecordBatch.from_arrays([b.column(1), flat], ["y", "c"])

    got = rows.select("text", F.col("y").cast("int").alias("y")).unionByName(other).mapInArrow(tidy(vote), "y int, c array<int>").toArrow()  # at most `sample` and about `unlabelled` rows
    rows.unpersist()
    y = got["y"].to_numpy()
    counts = got["c"].combine_chunks().flatten().to_numpy().reshape(len(y), -1)
    posterior, rates, voice = label_model(counts > 0, y)
    x = _design(counts, voice)
    sure = np.abs(2 * posterior - 1) * np.where(y < 0, UNLABELLED_WEIGHT, 1.0)
    return {"marks": marks, "voice": voice, "rates": rates, "w": linear(x, posterior, weight=sure), "share": pos / n}


def score(docs: DataFrame, model: dict, text_col: str = "text", out: str = "score") -> DataFrame:
    """docs with the score added as column `out`; a column of that name is replaced."""
    docs = docs.drop(out)
    at = docs.columns.index(text_col)
    marks, voice, w, share = model["marks"], model["voice"], model["w"], model["share"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        voters = Voters(marks) if w is not None else None
        for big in batches:
            for b in sub_batches(big, text_col, 1 << 20):
                if voters is None:
                    s = np.full(b.num_rows, share)
                else:
                    x = _design(voters.counts(b.column(at).to_pylist()), voice)
                    s = 1 / (1 + np.exp(-np.clip((x * w).sum(1), -30, 30)))
                yield pa.RecordBatch.from_arrays([*b.columns, pa.array(s)], names=[*names, out])

    names = docs.columns
    return docs.mapInArrow(tidy(run), StructType([*docs.schema.fields, StructField(out, DoubleType())]))


THRESHOLD = 0.3


def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The toxicity score of every document."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    model = fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    out = score(docs, model)
    return out.select("doc_id", (fold("doc_id", 4) == 2).alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {"op9_toxicity": op9_toxicity}
