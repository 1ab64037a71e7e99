"""The digest of the bound tables, gated, published and read back."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docketflow.operators import digest, rules
from docketflow.plans import bind, domain
from docketflow.session import shared_dir

Q: dict = {}
#: Sections of the stand-in rules, and a small glossary.
ROUTE = {"SEL-LONG": "house", "SEL-VOTE": "senate", "SEL-DE": "rules", "SEL-FR": "legislation", "SEL-ALL": "agency"}
TERMS = {"characters": "letters, digits and signs of a text", "document": "one text of the corpus", "cloture": "an end to debate", "quorum": "members enough to act"}


def query(name: str, sql: str | None = None):
    def put(f):
        Q[name] = (f, sql)
        return f

    return put


def items(spark: SparkSession, d: str) -> DataFrame:
    """Selected documents as digest items, with summaries where a label stands for one."""
    facts = domain._facts(spark, d)
    plain = bind.summaries(spark, d).filter("plain AND NOT withdrawn").select("doc_id").distinct().withColumn("_p", F.lit(True))
    route = F.create_map(*(F.lit(x) for kv in ROUTE.items() for x in kv))
    chosen = facts.filter("rule IS NOT NULL").join(plain, "doc_id", "left")
    size = F.concat(F.col("char_count").cast("string"), F.lit(" characters"))
    return chosen.select(
        F.element_at(route, F.col("rule")).alias("section"), F.concat(F.lit("Document "), F.col("doc_id").cast("string")).alias("title"), F.when(F.col("summarised"), F.concat(F.lit("A text of "), size, F.lit("."))).alias("summary"),
        F.when(F.col("_p"), F.concat(F.lit("In short: "), size, F.lit("."))).alias("plain"), "rule", F.concat(F.lit("https://example.gov/doc/"), F.col("doc_id").cast("string")).alias("link"),
    )


PUBLISHED = f"""
WITH {domain.COVER.removeprefix("WITH ")}, done AS (SELECT DISTINCT doc_id FROM summaries WHERE NOT withdrawn), short AS (SELECT DISTINCT doc_id FROM summaries WHERE plain AND NOT withdrawn),
i AS (SELECT CASE rule WHEN 'SEL-LONG' THEN 2 WHEN 'SEL-VOTE' THEN 1 WHEN 'SEL-DE' THEN 5 WHEN 'SEL-FR' THEN 3 ELSE 9 END AS part, 'Document ' || doc_id::VARCHAR AS a, 'https://example.gov/doc/' || doc_id::VARCHAR AS b,
  rule, char_count::VARCHAR || ' characters.' AS size, doc_id IN (SELECT doc_id FROM done) AS summed, doc_id IN (SELECT doc_id FROM short) AS short FROM sel WHERE rule IS NOT NULL),
body AS (SELECT part, a, b, '### ' || a || chr(10) || CASE WHEN summed THEN 'A text of ' || size || chr(10) ELSE '' END || CASE WHEN short THEN '> In short: ' || size || chr(10) ELSE '' END || 'Included: ' || rule || chr(10) || 'Source: ' || b AS line FROM i
  UNION ALL SELECT DISTINCT part, '', '', '## ' || CASE part WHEN 1 THEN 'Senate floor' WHEN 2 THEN 'House floor' WHEN 3 THEN 'Legislation' WHEN 5 THEN 'Final rules' ELSE 'Agency releases' END FROM i),
terms AS (SELECT 11 AS part, t AS a, 'row' AS b, '- **' || t || '**: ' || m AS line FROM (VALUES ('characters', 'letters, digits and signs of a text'), ('document', 'one text of the corpus'), ('cloture', 'an end to debate'), ('quorum', 'members enough to act')) v(t, m) WHERE EXISTS (SELECT 1 FROM body WHERE regexp_matches(lower(body.line), '\\b' || t || '\\b'))),
x AS (SELECT *, row_number() OVER (ORDER BY part, a, b, line) AS r FROM (SELECT * FROM body
  UNION ALL SELECT 10, '', '', '## Coverage' || chr(10) || chr(10) || '| Class | Packages | Summarised | Counted | Excluded |' || chr(10) || '|---|---|---|---|---|'
  UNION ALL SELECT 10, coalesce(collection, '?'), 'row', '| ' || concat_ws(' | ', coalesce(collection, '?'), packages, summarised, counted, packages - summarised - counted) || ' |' FROM c
  UNION ALL SELECT * FROM terms UNION ALL SELECT DISTINCT 11, '', '', '## Glossary' FROM terms)),
p AS (SELECT r, unnest(string_split(line, chr(10))) AS line, generate_subscripts(string_split(line, chr(10)), 1) AS k FROM x)
SELECT row_number() OVER (ORDER BY r, k) AS n, line FROM p
"""


@query("published_digest", PUBLISHED)
def published_digest(spark: SparkSession, d: str) -> DataFrame:
    """A digest with coverage and glossary, published after its gates found nothing, and read by its manifest."""
    chosen, facts = items(spark, d), domain._facts(spark, d)
    cover = rules.coverage(facts, ["collection"])
    lines = digest.document(chosen, cover, "collection", TERMS)
    found = digest.findings(lines, chosen, facts, cover, ["collection"], bind.texts(spark, d).select("doc_id"), r"https://example\.gov/doc/(\d+)", chosen.select("link", F.col("title").alias("official")))
    folder = f"{shared_dir(spark)}/docketflow/digest-{uuid.uuid4().hex}"
    digest.published(lines, found, folder, "2024-01-01")
    return digest.read(spark, folder, "2024-01-01")
