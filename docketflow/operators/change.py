"""Change detection and evidence."""

from __future__ import annotations

import hashlib
import json
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F


def change_kind(captures: DataFrame, document: str = "document_id", order: str = "id", content: str = "content_sha", text: str = "text_sha", version: str = "version") -> DataFrame:
    """`kind` and the previous content row's id for every capture.

    Rows without content have no kind and never become the previous row. No earlier content: new. The
    same bytes: unchanged. The same text under the same normaliser: bytes_changed. Else modified.
    """
    has = F.col(content).isNotNull()
    row = F.struct(F.col(order).alias("id"), F.col(content).alias("c"), F.col(text).alias("t"), F.col(version).alias("v"))
    w = W.partitionBy(document).orderBy(order).rowsBetween(W.unboundedPreceding, -1)
    out = captures.withColumn("_prev", F.last(F.when(has, row), ignorenulls=True).over(w))
    kind = (
        F.when(~has, None).when(F.col("_prev").isNull(), "new").when(F.col("_prev.c") == F.col(content), "unchanged")
        .when(F.col("_prev.t").eqNullSafe(F.col(text)) & F.col("_prev.v").eqNullSafe(F.col(version)), "bytes_changed").otherwise("modified")
    )
    return out.withColumn("kind", kind).withColumn("prev_id", F.col("_prev.id")).drop("_prev")


def store_by_hash(rows: DataFrame, body: str) -> DataFrame:
    """One row for each content, named by its hash; `path` fans out over the hash's first two digits."""
    out = rows.withColumn("sha", F.sha2(F.col(body), 256)).dropDuplicates(["sha"])
    return out.withColumn("path", F.concat(F.substring("sha", 1, 2), F.lit("/"), "sha", F.lit(".bin")))


def mismatched(stored: DataFrame, body: str, sha: str = "sha") -> DataFrame:
    """Stored rows whose content no longer has its hash; must be empty."""
    return stored.filter(F.sha2(F.col(body), 256) != F.col(sha))


def day_digests(attempts: DataFrame, day: str, order: list[str], fields: list[str]) -> DataFrame:
    """One line count and hash a day. Lines are JSON with fields in order, hashed each; a day's lines are dealt by
    the first byte of their hash to 256 bins, a bin's hash covers its line hashes in order, and the day's the bins'.

    A hash is sequential, so a task reads the line hashes of its bins in order as a stream and holds one hash state;
    a day of any size is spread over 256 tasks, and at most 256 hashes a day meet."""
    line = F.sha2(F.to_json(F.struct(*[F.col(f) for f in sorted(fields)]), {"ignoreNullFields": "false"}), 256)
    rows = attempts.select(F.col(day).alias("day"), F.struct(*order).alias("o"), line.alias("sha")).withColumn("bin", F.substring("sha", 1, 2))
    rows = rows.repartition("day", "bin").sortWithinPartitions("day", "bin", "o", "sha").select("day", "bin", "sha")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, n, state = None, 0, None
        out = lambda: pa.RecordBatch.from_arrays([pa.array([now[0]], kind), pa.array([now[1]]), pa.array([n]), pa.array([state.hexdigest()])], ["day", "bin", "rows", "sha"])
        for b in batches:
            kind = b.schema.field(0).type
            for d, k, sha in zip(*(b.column(c).to_pylist() for c in range(3)), strict=True):
                if state is None or (d, k) != now:
                    if state is not None:
                        yield out()
                    now, n, state = (d, k), 0, hashlib.sha256()
                state.update(f"\n{sha}".encode() if n else sha.encode())
                n += 1
        if state is not None:
            yield out()

    bins = rows.mapInArrow(run, f"day {rows.schema['day'].dataType.simpleString()}, bin string, rows long, sha string")
    inner = F.transform(F.array_sort(F.collect_list(F.struct("bin", "sha"))), lambda x: F.concat(x["bin"], F.lit(":"), x["sha"]))
    return bins.groupBy("day").agg(F.sum("rows").alias("rows"), F.sha2(F.array_join(inner, "\n"), 256).alias("body_sha"))


def chain(days: Iterable[tuple[str, int, str]]) -> list[tuple[str, int, str, str | None, str]]:
    """the hash chain over days, in order: each header names the one before. One short row a day, so on the driver."""
    out, prev = [], None
    for day, rows, body in sorted(days):
        header = json.dumps({"body_sha": body, "day": day, "prev": prev, "rows": rows}, sort_keys=True, separators=(",", ":"))
        sha = hashlib.sha256(header.encode()).hexdigest()
        out.append((day, rows, body, prev, sha))
        prev = sha
    return out


def checked_chain(attempts: DataFrame, headers: DataFrame, day: str, order: list[str], fields: list[str]) -> DataFrame:
    """What is wrong with stored headers (day, rows, body_sha, prev, sha), one row (day, problem) each.

    Every day is digested again from the attempts. `missing`: a day with attempts has no header. `extra`: a header's day
    has no attempts. `rows`, `body`: the header says another number or hash than the attempts give. `header`: its own hash
    isn't that of its fields. `link`: it doesn't name the hash of the header before it. Days are text.
    """
    again = day_digests(attempts, day, order, fields).select("day", F.col("rows").alias("_rows"), F.col("body_sha").alias("_body"))
    own = F.sha2(F.to_json(F.struct("body_sha", "day", "prev", "rows"), {"ignoreNullFields": "false"}), 256)
    before = F.lag("sha").over(W.orderBy("day"))  # one short row a day
    stored = headers.select("day", "rows", "body_sha", "prev", "sha", (~own.eqNullSafe(F.col("sha"))).alias("_forged"), (~F.col("prev").eqNullSafe(before)).alias("_cut"))
    both = stored.join(again, "day", "full")
    there, made = F.col("sha").isNotNull(), F.col("_body").isNotNull()
    found = [
        F.when(~there, "missing"), F.when(~made, "extra"), F.when(there & made & ~F.col("rows").eqNullSafe(F.col("_rows")), "rows"),
        F.when(there & made & ~F.col("body_sha").eqNullSafe(F.col("_body")), "body"), F.when(there & F.col("_forged"), "header"), F.when(there & F.col("_cut"), "link"),
    ]
    return both.select("day", F.explode(F.filter(F.array(*found), lambda x: x.isNotNull())).alias("problem"))


def first_broken(problems: DataFrame) -> DataFrame:
    """The first day from which the chain proves nothing, and what is wrong there; no row for a whole chain."""
    return problems.groupBy("day").agg(F.array_sort(F.collect_set("problem")).alias("problems")).orderBy("day").limit(1)
