"""The reader contract (L1, L2, K17): a pure function from one body to records, run over a column of bodies."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type
from pyspark.sql.types import StructField, StructType, StringType, _parse_datatype_string

Parser = Callable[[bytes | str], Iterable[dict]]


def parsed(rows: DataFrame, body: str, keep: list[str], schema: str, parser: Parser) -> DataFrame:
    """One row for each record of each body, with the kept columns, `pos` (order in the body) and `error`.

    A body that can't be parsed gives one row with its error and nulls, and never stops the job; a null body
    gives no row. Records lack what they don't have.
    """
    fields = _parse_datatype_string(schema).fields
    out = StructType([*[rows.schema[k] for k in keep], *fields, *_parse_datatype_string("pos int").fields, StructField("error", StringType())])
    kinds = [to_arrow_type(f.dataType) for f in fields]
    names = [*keep, *[f.name for f in fields], "pos", "error"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for lo in range(0, b.num_rows, 256):
                part = b.slice(lo, 256)
                at, found, pos, errors = [], [], [], []
                for i, x in enumerate(part.column(len(keep)).to_pylist()):
                    if x is None:
                        continue
                    try:
                        got = list(parser(x))
                        at += [i] * len(got)
                        found += got
                        pos += range(len(got))
                        errors += [None] * len(got)
                    except Exception as e:  # the record of a poison body, not a stop
                        at.append(i)
                        found.append({})
                        pos.append(None)
                        errors.append(f"{type(e).__name__}: {e}"[:300])
                take = pa.array(at, pa.int64())
                cols = [part.column(k).take(take) for k in range(len(keep))]
                cols += [pa.array([r.get(f.name) for r in found], k) for f, k in zip(fields, kinds, strict=True)]
                yield pa.RecordBatch.from_arrays([*cols, pa.array(pos, pa.int32()), pa.array(errors, pa.string())], names=names)

    return rows.select(*keep, F.col(body)).mapInArrow(run, out)


def files(spark, path: str, glob: str = "*") -> DataFrame:
    """Captured files as rows: path, content, and their time."""
    return spark.read.format("binaryFile").option("pathGlobFilter", glob).option("recursiveFileLookup", "true").load(path).select("path", "content", "modificationTime", "length")


def first_offered(links: dict[str, str], preference: list[str]) -> F.Column:
    """A2: format and link of the first offered format in order of preference. links: format to column name."""
    return F.coalesce(*[F.when(F.col(links[p]).isNotNull(), F.struct(F.lit(p).alias("format"), F.col(links[p]).alias("link"))) for p in preference])


def conditions(etag: F.Column, modified: F.Column) -> F.Column:
    """K3: headers of a conditional request, from what the last good answer said; an empty map without either."""
    given = lambda v, name: F.when(F.coalesce(v, F.lit("")) != "", F.create_map(F.lit(name), v)).otherwise(F.map_from_arrays(F.array().cast("array<string>"), F.array().cast("array<string>")))
    return F.map_concat(given(etag, "If-None-Match"), given(modified, "If-Modified-Since"))


def polled(state: DataFrame, answers: DataFrame, key: str = "source_id") -> DataFrame:
    """K3: validators and times after a poll, and whether there is `work`. state: key, etag, modified, checked_at, changed_at;
    answers: key, status, etag, modified, at; one row a key each.

    A 304 has no work and keeps the validators; a good answer has work and brings its own, be they none; any other
    answer, or none, keeps all as it was. Sources without a row in either table are kept.
    """
    s, a = state.alias("s"), answers.alias("a")
    good = F.coalesce(F.col("a.status").between(200, 299), F.lit(False))
    same = F.coalesce(F.col("a.status") == 304, F.lit(False))
    took = lambda c: F.when(good, F.col(f"a.{c}")).otherwise(F.col(f"s.{c}")).alias(c)
    return s.join(a, F.col(f"s.{key}") == F.col(f"a.{key}"), "full").select(
        F.coalesce(f"s.{key}", f"a.{key}").alias(key), took("etag"), took("modified"), F.when(good | same, F.col("a.at")).otherwise(F.col("s.checked_at")).alias("checked_at"),
        F.when(good, F.col("a.at")).otherwise(F.col("s.changed_at")).alias("changed_at"), good.alias("work"),
    )
