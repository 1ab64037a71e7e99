"""Term gates (J7-J11, D17, D18): banned terms outside official strings, citations, correction ladder."""

from __future__ import annotations

import re
from collections.abc import Iterator, Sequence

import ahocorasick
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from docketflow.operators import overlap

#: Terms that generated prose may not use.
BANNED_TERMS = ("landmark", "controversial", "historic", "unprecedented", "sweeping", "radical", "extreme", "momentous", "alarming", "in an attempt to", "aims to appease", "red tape", "crackdown", "cracks down", "slams", "loophole")
MOST_CORRECTIONS = 2


def term_pattern(terms: Sequence[str] = BANNED_TERMS) -> str:
    """One alternation, whole words, any white space between words; Java and Python read it alike."""
    return r"(?iu)\b(?:" + "|".join(r"\s+".join(re.escape(w) for w in t.split()) for t in terms) + r")\b"


def without_targets(s: Column) -> Column:
    """Markdown link targets taken out; the link's text stays."""
    return F.regexp_replace(s, r"\]\([^)\s]*\)", "]")


FEW = 8 << 20  # characters of official strings that every task may hold


def contained(docs: DataFrame, officials: DataFrame, text: str = "text", official: str = "official") -> DataFrame:
    """Docs joined with the official strings that they contain, each text read once.

    A list counted short is searched for by an automaton of all strings. Of a long one, strings are found through winnowed
    fingerprints, whatever their words; those too short for a fingerprint (under SHORTEST bytes) go through the automaton,
    in as many rounds as their length needs. Null and empty strings are in no document.
    """
    o = officials.filter(F.col(official) != "").select(official).distinct()
    total = o.agg(F.coalesce(F.sum(F.length(official)), F.lit(0)).alias("n")).first().n
    if total <= FEW:
        found = _searched(docs, o, text, official)
    else:
        found = overlap.contained(docs, o.filter(F.octet_length(official) >= overlap.SHORTEST), text, official)
        short = o.filter(F.octet_length(official) < overlap.SHORTEST)
        size = short.agg(F.coalesce(F.sum(F.length(official)), F.lit(0)).alias("n")).first().n
        for k in range(rounds := -(-size // max(FEW, 1))):
            found = found.unionByName(_searched(docs, short.filter(F.pmod(F.xxhash64(official), F.lit(rounds)) == k), text, official))
    return found if officials.columns == [official] else found.join(officials, official)


def _searched(docs: DataFrame, officials: DataFrame, text: str, official: str) -> DataFrame:
    """docs with each official string that they contain, by one automaton a task. The strings are a counted, bounded list."""
    strings = [r[0] for r in officials.collect()]
    sent, at, names = docs.sparkSession.sparkContext.broadcast(strings), docs.columns.index(text), [*docs.columns, official]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        find = ahocorasick.Automaton()
        for s in sent.value:
            find.add_word(s, s)
        find.make_automaton()
        for b in batches:
            rows, hits = [], []
            for k, t in enumerate(b.column(at).to_pylist() if sent.value else ()):
                here = dict.fromkeys(s for _, s in find.iter(t)) if t else ()
                rows += [k] * len(here)
                hits += here
            yield pa.RecordBatch.from_arrays([*b.take(pa.array(rows, pa.int64())).columns, pa.array(hits, pa.string())], names=names)

    return docs.mapInArrow(run, StructType([*docs.schema.fields, StructField(official, StringType())]))


def violations(items: DataFrame, officials: DataFrame, key: str, text: str = "text", official: str = "official", terms: Sequence[str] = BANNED_TERMS) -> DataFrame:
    """Key, at, term of every banned term that stands outside the item's official strings.

    officials: (key, official) rows. Only official strings that hold a banned term themselves can exempt
    one, so the others are left before the join; each item meets its own strings only.
    """
    pattern = term_pattern(terms)
    able = officials.filter(F.col(official).rlike(pattern)).groupBy(key).agg(F.collect_set(official).alias("_officials"))
    rows = items.filter(F.col(text).rlike(pattern)).select(key, without_targets(F.col(text)).alias("_text")).join(able, key, "left")
    kind = rows.schema[key].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        find = re.compile(pattern)
        for b in batches:
            keys, at, term = [], [], []
            for row, (t, off) in enumerate(zip(b.column(1).to_pylist(), b.column(2).to_pylist(), strict=True)):
                spans = []
                for o in off or []:
                    for form in {o, " ".join(o.split()), o.title(), o.upper()}:
                        p = t.find(form)
                        while form and p >= 0:
                            spans.append((p, p + len(form)))
                            p = t.find(form, p + 1)
                for m in find.finditer(t):
                    if not any(a <= m.start() and m.end() <= z for a, z in spans):
                        keys.append(row)
                        at.append(m.start())
                        term.append(" ".join(m[0].lower().split()))
            yield pa.RecordBatch.from_arrays([b.column(0).take(pa.array(keys, pa.int64())), pa.array(at, pa.int32()), pa.array(term, pa.string())], names=[key, "at", "term"])

    return rows.select(key, "_text", "_officials").mapInArrow(run, f"{key} {kind}, at int, term string")


def first_violation(found: DataFrame, order: list[str]) -> DataFrame:
    """The first violation over items in order."""
    return found.orderBy(*order).limit(1)


def uncited(bodies: DataFrame, text: str, pattern: str, known: DataFrame, key: str) -> DataFrame:
    """Citations of packages that don't exist; must be empty."""
    cited = bodies.select(F.explode(F.regexp_extract_all(F.col(text), F.lit(pattern), F.lit(1))).alias(key)).distinct()
    return cited.join(known.select(key), key, "left_anti")


def unexplained(lines: DataFrame, doc: str, number: str, line: str, heading: str = r"^### ", reason: str = r"^Included: ") -> DataFrame:
    """Item headings without an inclusion line before the next heading; must be empty."""
    w = W.partitionBy(doc).orderBy(number).rowsBetween(W.unboundedPreceding, 0)
    item = F.sum(F.col(line).rlike(heading).cast("int")).over(w)
    g = lines.withColumn("_item", item).filter("_item > 0").groupBy(doc, "_item").agg(F.min(number).alias(number), F.min_by(line, number).alias(line), F.count_if(F.col(line).rlike(reason)).alias("_reasons"))
    return g.filter("_reasons = 0").select(doc, number, line)


def correction_step(attempts: Column, clean: Column) -> Column:
    """What happens to an item's layer after an attempt: kept, corrected again, or withdrawn (its dependent layer with it)."""
    return F.when(clean, "keep").when(attempts < MOST_CORRECTIONS, "correct").otherwise("withdraw")
