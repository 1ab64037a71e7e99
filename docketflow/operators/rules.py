"""Ordered selection rules, exclusions, stages, sections and coverage."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: The length from which floor text is listed, and the printed form of recorded votes.
FLOOR_CHARS = 15000
RECORDED_VOTE = r"\[Roll No\. \d+\]|\[Rollcall Vote No\. \d+|YEAS--\d+[\s\S]{1,20000}?NAYS--\d+"
STAGE_WORDS = ("Enrolled", "Reported", "Placed-on-Calendar")
STAGE_CODES = ("enr", "rh", "rs", "pcs")

Rule = tuple[str, Column]


def publication_rules(vote: str = RECORDED_VOTE, floor_chars: int = FLOOR_CHARS) -> list[Rule]:
    """The thirteen rules over collection, doc_type, char_count and text; order is precedence."""
    c, t = F.col("collection"), F.coalesce("doc_type", F.lit(""))
    floor = (c == "CREC") & t.isin("HOUSE", "SENATE")
    stage = t.isin(*STAGE_CODES) | F.lower(t).isin(*STAGE_CODES)
    for w in STAGE_WORDS:
        stage = stage | t.contains(w)
    return [
        ("CREC-SEL-01", floor & (F.col("char_count") >= floor_chars)),
        ("CREC-SEL-02", floor & F.col("text").rlike(vote)),
        ("PLAW-SEL-01", c == "PLAW"),
        ("BILLS-SEL-01", (c == "BILLS") & stage),
        *[(f"FR-SEL-0{k}", (c == "FR") & (t == x)) for k, x in enumerate(("RULE", "PRORULE", "PRESDOCU"), 1)],
        *[(f"USCOURTS-SEL-0{k}", (c == "USCOURTS") & (t == x)) for k, x in enumerate(("APPELLATE", "NATIONAL"), 1)],
        *[(f"PRESACT-SEL-0{k}", (c == "PRESACT") & (t == x)) for k, x in enumerate(("EO", "PROCLAMATION", "MEMORANDUM"), 1)],
        ("PRESACT-SEL-04", c == "PRESACT"),
    ]


def publication_exclusions() -> list[Rule]:
    """The exclusions over rows that no rule selects."""
    c, t = F.col("collection"), F.coalesce("doc_type", F.lit(""))
    return [
        ("FR-EX-01", (c == "FR") & (t == "NOTICE")),
        ("CREC-EX-01", (c == "CREC") & t.isin("HOUSE", "SENATE")),
        ("CREC-EX-02", (c == "CREC") & t.isin("EXTENSIONS", "DAILYDIGEST")),
        ("BILLS-EX-01", c == "BILLS"),
        ("USCOURTS-EX-01", c == "USCOURTS"),
    ]


def first_match(rules: Sequence[Rule]) -> Column:
    """the name of the first rule that holds; null if none does. One CASE, so one pass over the row."""
    out = None
    for name, holds in rules:
        out = F.when(holds, name) if out is None else out.when(holds, name)
    return out if out is not None else F.lit(None).cast("string")


def select_items(rows: DataFrame, rules: Sequence[Rule], exclusions: Sequence[Rule] = ()) -> DataFrame:
    """Rows with `rule` and, for those without one, `exclusion`."""
    out = rows.withColumn("rule", first_match(rules))
    return out.withColumn("exclusion", F.when(F.col("rule").isNull(), first_match(exclusions)))


def zero_filled(spark: SparkSession, counted: DataFrame, key: str, names: Sequence[str]) -> DataFrame:
    """A count for every name, 0 where there is none."""
    every = spark.createDataFrame([(n,) for n in names], f"{key} string")
    return every.join(counted.groupBy(key).agg(F.count("*").alias("n")), key, "left").select(key, F.coalesce("n", F.lit(0)).alias("n"))


def coverage(rows: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Packages, summarised, counted (selected, not summarised) and excluded (by remainder) by keys.

    rows: one package each, with `rule` (null if none) and `summarised` (boolean).
    """
    g = rows.groupBy(*keys).agg(
        F.count("*").alias("packages"), F.count_if("summarised").alias("summarised"),
        F.count_if(~F.col("summarised") & F.col("rule").isNotNull()).alias("counted"),
    )
    return g.withColumn("excluded", F.col("packages") - F.col("summarised") - F.col("counted"))


def unreconciled(cover: DataFrame, facts: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows of a coverage table that don't add up or differ from the facts (a missing class is one); must be empty."""
    again = facts.groupBy(*[F.col(k).alias(f"_{k}") for k in keys]).agg(F.count("*").alias("again"))
    both = cover.join(again, reduce(and_, [F.col(k).eqNullSafe(F.col(f"_{k}")) for k in keys]), "full")
    both = both.withColumns({k: F.coalesce(k, f"_{k}") for k in keys}).drop(*[f"_{k}" for k in keys])
    bad = (F.col("summarised") + F.col("counted") + F.col("excluded") != F.col("packages")) | ~F.col("packages").eqNullSafe(F.col("again"))
    return both.filter(bad)


def excluded_floor(rule: Column, chars: Column, summarised: Column) -> tuple[Column, Column]:
    """Q1: whether a floor item counts as excluded, in two ways: no rule chose it (the default of coverage), and it is short
    and has no summary. They differ for a short item that a rule chose and whose summary failed, and for a long one that
    no rule chose."""
    return rule.isNull(), (F.coalesce(chars, F.lit(0)) < FLOOR_CHARS) & ~F.coalesce(summarised, F.lit(False))


def bill_stage(doc_type: Column) -> Column:
    """The stage bucket of a bill's class, case-insensitively."""
    t = F.lower(F.coalesce(doc_type, F.lit("")))
    return (
        F.when(t.isin("ih", "is") | t.startswith("introduced"), "Introduced")
        .when(t.isin("rh", "rs") | t.contains("reported"), "Reported")
        .when(t.isin("eh", "es") | t.contains("engrossed"), "Engrossed")
        .when((t == "enr") | t.contains("enrolled"), "Enrolled")
        .otherwise("Other")
    )


#: Section, rule prefix, class (None: any).
SECTIONS = (("senate", "CREC-SEL", "SENATE"), ("house", "CREC-SEL", "HOUSE"), ("legislation", "BILLS-SEL", None), ("rules", "FR-SEL-01", None), ("proposed", "FR-SEL-02", None), ("presidential", "FR-SEL-03", None), ("laws", "PLAW-SEL", None), ("judicial", "USCOURTS-SEL", None))


def section(rule: Column, doc_type: Column, sections: Sequence[tuple[str, str, str | None]] = SECTIONS, vote_rule: str = "CREC-SEL-02") -> Column:
    """The first section whose rule prefix and class match; items chosen for a recorded vote alone stay out of floor sections."""
    rules = [(name, rule.startswith(prefix) & (F.lit(True) if cls is None else doc_type == cls) & ~(F.lit(prefix == "CREC-SEL") & (rule == vote_rule))) for name, prefix, cls in sections]
    return first_match(rules)
