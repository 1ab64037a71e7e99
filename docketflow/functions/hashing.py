"""Hashes, identities, JSON and rounding."""

from __future__ import annotations

import hashlib
import json

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import StringType


def _c(x: Column | str) -> Column:
    return F.col(x) if isinstance(x, str) else x


def sha256(x: Column | str) -> Column:
    """I38."""
    return F.sha2(_c(x), 256)


def package_id(source: Column | str, stable_id: Column | str, prefix: str = "PR") -> Column:
    """PREFIX-source-first eight digits of the identity's hash."""
    return F.concat_ws("-", F.lit(prefix), _c(source), F.substring(sha256(stable_id), 1, 8))


@F.pandas_udf(StringType())
def canonical_json_hash(s: pd.Series) -> pd.Series:
    """Hash of a JSON text with sorted keys and compact separators. A pandas UDF: escaping must be Python's."""

    def one(x: str | None) -> str | None:
        if x is None:
            return None
        return hashlib.sha256(json.dumps(json.loads(x), sort_keys=True, separators=(",", ":")).encode()).hexdigest()

    return s.map(one)


def sorted_json(**fields: Column) -> Column:
    """A JSON object with its keys in order."""
    return F.to_json(F.struct(*[fields[k].alias(k) for k in sorted(fields)]))


def percent(part: Column, whole: Column, digits: int = 1) -> Column:
    """A half-even rounded percentage; 0 where the whole is 0."""
    return F.when(whole > 0, F.bround(100.0 * part / whole, digits)).otherwise(F.lit(0.0))


def split_evenly(total: Column, parts: Column) -> Column:
    """The whole share of each part, the remainder dropped; null for no parts."""
    return F.when(parts > 0, F.floor(total / parts))
