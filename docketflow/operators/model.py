"""Model work as batches (L4, J28, I17): prompts go out in groups, replies come back as JSON objects by key.

The backend is any picklable function from a list of prompts to a list of replies, called in tasks; `echo` is a
deterministic stand-in. Rounds are driven outside: what a round leaves unanswered goes into smaller batches.
"""

from __future__ import annotations

import json
import re
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docketflow.operators.journal import batches

#: Items a batch in the first round, in a retry, and how many single retries at most.
FIRST, RETRY, SINGLES = 6, 5, 12
_FENCE = re.compile(r"^\s*```[a-z]*\s*$", re.M)


def echo(prompts: list[str]) -> list[str]:
    """The first ten words of every item, as a JSON object by key."""
    return [json.dumps({k: " ".join(v.split()[:10]) for k, v in json.loads(p).items()}) for p in prompts]


def reply_keys(reply: str) -> dict[str, str]:
    """A reply's object, fences tolerated; {} for anything else."""
    m = re.search(r"\{.*\}", _FENCE.sub("", reply or ""), re.S)
    try:
        got = json.loads(m[0]) if m else {}
    except json.JSONDecodeError:
        return {}
    return {str(k): v for k, v in got.items() if isinstance(v, str) and v.strip()}


def answered(items: DataFrame, backend: Callable[[list[str]], list[str]] = echo, size: int = FIRST, *within: str) -> DataFrame:
    """Key, answer for the items (key, text) that the model answers; keys it wasn't asked for are ignored."""
    rows = batches(items, ["key"], size, *within).withColumn("group", F.concat_ws("/", *[F.col(w).cast("string") for w in within], F.col("batch").cast("string")))
    grouped = rows.groupBy("group").agg(F.collect_list(F.struct("key", "text")).alias("asked"))  # at most `size` items each

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            prompts = [json.dumps({str(r["key"]): r["text"] or "" for r in asked}) for asked in f["asked"]]
            out = []
            for asked, reply in zip(f["asked"], backend(prompts), strict=True):
                got = reply_keys(reply)
                out += [(str(r["key"]), got[str(r["key"])]) for r in asked if str(r["key"]) in got]
            yield pd.DataFrame(out, columns=["key", "answer"])

    return grouped.mapInPandas(run, "key string, answer string")


def unanswered(items: DataFrame, answers: DataFrame) -> DataFrame:
    """H1: the items without an answer."""
    return items.join(answers.select(F.col("key")), items["key"].cast("string") == answers["key"], "left_anti")
