"""The registered queries of this subpackage, and their SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from docketflow.llm import fingerprints, html, jaccard, katz, language, licences, media, mixing, packing, quality, runs, toxicity, trie

MODULES = (fingerprints, licences, packing, jaccard, quality, mixing, language, media, toxicity, html, runs, katz, trie)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {k: f for m in MODULES for k, f in m.QUERIES.items()}


def oracle_sql() -> dict[str, str]:
    return {k: f for m in MODULES for k, f in getattr(m, "ORACLE", {}).items()}
