"""The digest as a document (B15): nine sections, coverage and glossary, gated, and then published whole or not at all.

Lines are a table; `published` stages them as files, looks at the gates, and commits by one manifest that names the
files. Readers go by the newest manifest, so what a failed gate, a lost executor or a stopped driver leaves behind is
never read, and the digest before stays what readers get.
"""

from __future__ import annotations

import json
import re
import uuid
from collections.abc import Sequence
from urllib.parse import unquote, urlsplit

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from docketflow.functions import text
from docketflow.operators import lexicon, rules

#: The sections in order, with their headings.
SECTIONS = {
    "senate": "Senate floor", "house": "House floor", "legislation": "Legislation", "laws": "Public laws", "rules": "Final rules", "proposed": "Proposed rules",
    "presidential": "Presidential documents", "judicial": "Opinions", "agency": "Agency releases",
}
ROWS = 100_000  # of one staged file


class Rejected(Exception):
    """A digest that a gate holds back; nothing of it is to be read."""


# --- the document ---------------------------------------------------------------------------


def body(items: DataFrame) -> DataFrame:
    """Lines of the nine sections: a heading for each section that has items, a block for each item with its reason.

    items: section, title, summary, plain, rule, link; items of other sections are not in the document. Lines are
    (part, section, a, b, line), to be read in the order of part, a and b."""
    names = F.array(*map(F.lit, SECTIONS))
    part = F.array_position(names, F.col("section")).cast("int")
    heading = F.element_at(F.array(*map(F.lit, SECTIONS.values())), F.col("part"))
    block = F.concat_ws("\n", F.concat(F.lit("### "), text.one_line("title")), F.col("summary"), F.concat(F.lit("> "), "plain"), F.concat(F.lit("Included: "), "rule"), F.concat(F.lit("Source: "), "link"))
    blocks = items.withColumn("part", part).filter("part > 0").select("part", "section", F.coalesce(text.one_line("title"), F.lit("")).alias("a"), F.coalesce("link", F.lit("")).alias("b"), block.alias("line"))
    heads = blocks.select("part", "section").distinct().select("part", "section", F.lit("").alias("a"), F.lit("").alias("b"), F.concat(F.lit("## "), heading).alias("line"))
    return heads.unionByName(blocks)


def coverage_lines(cover: DataFrame, key: str) -> DataFrame:
    """The coverage table as lines, one a class; a missing class is `?`."""
    part = F.lit(len(SECTIONS) + 1)
    cells = F.concat_ws(" | ", text.table_cell(F.coalesce(key, F.lit("?"))), *(F.col(c).cast("string") for c in ("packages", "summarised", "counted", "excluded")))
    rows = cover.select(part.alias("part"), F.lit("coverage").alias("section"), F.coalesce(key, F.lit("?")).alias("a"), F.lit("row").alias("b"), F.concat(F.lit("| "), cells, F.lit(" |")).alias("line"))
    head = cover.sparkSession.range(1).select(part.alias("part"), F.lit("coverage").alias("section"), F.lit("").alias("a"), F.lit("").alias("b"), F.lit("## Coverage\n\n| Class | Packages | Summarised | Counted | Excluded |\n|---|---|---|---|---|").alias("line"))
    return head.unionByName(rows)


def glossary_lines(lines: DataFrame, terms: dict[str, str]) -> DataFrame:
    """The terms that the document uses as whole words, alphabetical, with what they mean. One pass over the lines."""
    part, spark = F.lit(len(SECTIONS) + 2), lines.sparkSession
    used = F.regexp_extract_all(F.lower("line"), F.lit(r"\b(" + "|".join(sorted((re.escape(t.lower()) for t in terms), key=len, reverse=True)) + r")\b"), F.lit(1))
    found = lines.select(F.explode(F.array_distinct(used)).alias("a")).distinct()
    meanings = spark.createDataFrame([(t.lower(), f"- **{t}**: {m}") for t, m in terms.items()], "a string, line string")
    rows = found.join(F.broadcast(meanings), "a")  # as many rows as the list of terms has
    rows = rows.select(part.alias("part"), F.lit("glossary").alias("section"), "a", F.lit("row").alias("b"), "line")
    head = rows.limit(1).select("part", "section", F.lit("").alias("a"), F.lit("").alias("b"), F.lit("## Glossary").alias("line"))
    return head.unionByName(rows)


def document(items: DataFrame, cover: DataFrame, key: str, terms: dict[str, str]) -> DataFrame:
    """All lines of a digest."""
    lines = body(items)
    return lines.unionByName(coverage_lines(cover, key)).unionByName(glossary_lines(lines, terms))


# --- the gates ------------------------------------------------------------------------------


def findings(lines: DataFrame, items: DataFrame, facts: DataFrame, cover: DataFrame, keys: Sequence[str], known: DataFrame, pattern: str, officials: DataFrame) -> DataFrame:
    """What holds a digest back, one row (gate, finding) each; must be empty.

    coverage (J6): a class that doesn't add up, or differs from the facts. citation (J7): a cited link (by `pattern`,
    whose group is the key) that is none of the `known` packages (one column). term (J8): a banned term in prose, outside
    the item's own official strings (link, official). reason (J10): an item without its inclusion line.
    """
    row = lambda gate, *parts: (F.lit(gate).alias("gate"), F.concat_ws(" ", *parts).alias("finding"))
    classes = [F.coalesce(F.col(k).cast("string"), F.lit("?")) for k in keys]
    (key,) = known.columns
    wrong = rules.unreconciled(cover, facts, keys).select(*row("coverage", *classes))
    uncited = lexicon.uncited(lines, "line", pattern, known.select(F.col(key).cast("string").alias(key)), key).select(*row("citation", F.col(key)))
    prose = items.select("link", F.concat_ws("\n", "summary", "plain").alias("text"))
    terms = lexicon.violations(prose, officials, "link").select(*row("term", F.col("link"), F.col("term")))
    blocks = lines.filter(F.col("line").startswith("### ") & ~F.col("line").rlike(r"(?m)^Included: \S")).select(*row("reason", F.substring_index("line", "\n", 1)))
    return wrong.unionByName(uncited).unionByName(terms).unionByName(blocks)


# --- staging and commit ---------------------------------------------------------------------


def _store(spark: SparkSession, folder: str):  # noqa: ANN202
    path = spark._jvm.org.apache.hadoop.fs.Path
    return path(folder).getFileSystem(spark._jsc.hadoopConfiguration()), path


def manifests(spark: SparkSession, folder: str, name: str) -> list[str]:
    """Paths of the committed manifests of a digest, oldest first."""
    store, path = _store(spark, folder)
    at = path(f"{folder}/manifests/{name}")
    if not store.exists(at):
        return []
    return sorted(str(x.getPath()) for x in store.listStatus(at) if re.fullmatch(r"\d{8}\.json", x.getPath().getName()))


def staged(lines: DataFrame, folder: str, name: str) -> list[tuple[str, int]]:
    """Write lines in their order as text, many tasks at once; the files in order, each with its number of lines."""
    spark = lines.sparkSession
    stage = f"{folder}/data/{name}/{uuid.uuid4().hex}"
    order = ["part", "a", "b"]
    lines.repartitionByRange(*order, "line").sortWithinPartitions(*order, "line").select(F.col("line").alias("value")).write.option("maxRecordsPerFile", ROWS).text(stage)
    counted = spark.read.text(stage).groupBy(F.col("_metadata.file_path").alias("path")).agg(F.count("*").alias("n"))  # a row a file
    return sorted((r.path, r.n) for r in counted.collect())


def published(lines: DataFrame, found: DataFrame, folder: str, name: str) -> str:
    """Stage a digest's lines and, if no gate has found anything, make them the digest; the path of its manifest.

    With findings nothing is committed and `Rejected` names some of them. The commit is one rename of a written file to
    the next free number: whoever finds that number taken has lost the race and is rejected too.
    """
    spark = lines.sparkSession
    files = staged(lines, folder, name)
    if held := found.limit(5).collect():
        raise Rejected("; ".join(f"{r.gate}: {r.finding}" for r in held))
    before = manifests(spark, folder, name)
    number = 1 + (int(before[-1][-13:-5]) if before else 0)
    store, path = _store(spark, folder)
    draft, target = path(f"{folder}/data/{name}/{uuid.uuid4().hex}.json"), path(f"{folder}/manifests/{name}/{number:08}.json")
    out = store.create(draft, False)
    out.write(bytearray(json.dumps({"name": name, "files": files}, sort_keys=True).encode()))
    out.close()
    store.mkdirs(target.getParent())
    if store.exists(target) or not store.rename(draft, target):
        raise Rejected(f"another digest was committed as number {number}")
    return str(target)


def read(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """The lines of the digest that was committed last: n (from 1) and line. No rows before the first commit."""
    have = manifests(spark, folder, name)
    if not have:
        return spark.createDataFrame([], "n long, line string")
    files = json.loads("\n".join(r.value for r in spark.read.text(have[-1]).collect()))["files"]  # one short entry a file
    if not files:
        return spark.createDataFrame([], "n long, line string")
    bases, base = [], 0
    for file, n in files:
        bases.append((_plain(file), base))
        base += n
    first = F.broadcast(spark.createDataFrame(bases, "path string, base long"))
    whole = spark.read.text([p for p, _ in files], wholetext=True).select(F.col("_metadata.file_path").alias("path"), "value")  # at most ROWS records each
    whole = whole.withColumn("path", plain_path("path")).join(first, "path")
    return whole.select("base", F.posexplode(F.split(F.regexp_replace("value", r"\n$", ""), "\n"))).select((F.col("base") + F.col("pos") + 1).alias("n"), F.col("col").alias("line"))


def _plain(path: str) -> str:
    return re.sub(r"^/+", "/", unquote(urlsplit(path).path))


def plain_path(path: Column | str) -> Column:
    """A file's path without scheme and host, as stores write these in several ways."""
    return F.regexp_replace(F.url_decode(F.regexp_replace(F.regexp_replace(path, r"^[a-zA-Z][a-zA-Z0-9+.-]*:(//[^/]*)?", ""), r"\+", "%2B")), "^/+", "/")
