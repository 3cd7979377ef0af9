"""What five filters remove from all documents, in every order."""

from pyspark.sql import functions as F

from loomframe.llm.filter_audit import audit_filters
from loomframe.llm.registry import query, table

# By definition: every order is walked, and a filter's share is the sum of what it removes.
SQL = r"""
WITH d AS (SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS t FROM documents),
w AS (SELECT *, regexp_extract_all(t, '[^\x20\x09-\x0D]+') AS words FROM d),
low AS (SELECT t, min(doc_id) AS low FROM d GROUP BY t),
g AS (SELECT doc_id, max((quality = 1)::INT) AS good, max((toxic = 1)::INT) AS toxic FROM labels GROUP BY doc_id),
f AS (SELECT w.part, [len(words) < 200, 100 * len(list_distinct(words)) < 50 * len(words),
                      100 * length(regexp_replace(w.t, '[^A-Z]', '', 'g')) > 3 * length(w.t), regexp_matches(w.t, '[#$%&*|]'),
                      coalesce(w.doc_id > low.low, FALSE)] AS fails, coalesce(g.good, 0) AS good, coalesce(g.toxic, 0) AS toxic
      FROM w JOIN low USING (t) LEFT JOIN g ON w.doc_id = g.doc_id),
m AS (SELECT part, fails, count(*) AS n, sum(good) AS good, sum(toxic) AS toxic FROM f GROUP BY part, fails),
l AS (SELECT unnest([1, 2, 3, 4, 5]) AS i),
o AS (SELECT [a.i, b.i, c.i, d.i, e.i] AS seq FROM l a, l b, l c, l d, l e WHERE len(list_distinct([a.i, b.i, c.i, d.i, e.i])) = 5),
s AS (SELECT seq, unnest([1, 2, 3, 4, 5]) AS step FROM o),
x AS (SELECT m.*, s.seq, s.step, fails[seq[step]] AS own, list_bool_or(list_transform(seq[1:step - 1], lambda i: fails[i])) AS gone,
             len(list_filter(fails, lambda y: y)) AS n_fails FROM m, s),
r AS (SELECT part, seq, step, sum(CASE WHEN NOT own AND NOT coalesce(gone, FALSE) THEN n ELSE 0 END)::BIGINT AS kept,
             sum(CASE WHEN own AND NOT coalesce(gone, FALSE) THEN n ELSE 0 END)::BIGINT AS removed,
             sum(CASE WHEN own AND gone THEN n ELSE 0 END)::BIGINT AS redundant,
             sum(CASE WHEN own AND n_fails = 1 THEN n ELSE 0 END)::BIGINT AS unique_fails,
             sum(CASE WHEN own AND NOT coalesce(gone, FALSE) THEN good ELSE 0 END)::BIGINT AS good_lost,
             sum(CASE WHEN own AND NOT coalesce(gone, FALSE) THEN toxic ELSE 0 END)::BIGINT AS toxic_lost
      FROM x GROUP BY part, seq, step)
SELECT part, array_to_string(list_transform(seq, lambda i: substr('ABCDE', i, 1)), '') AS filter_order, step::INTEGER AS step, kept, removed, redundant,
       unique_fails, good_lost, toxic_lost, (sum(removed) OVER (PARTITION BY part, seq[step]))::BIGINT AS shapley
FROM r
"""


@query("op13_filter_audit", SQL)
def op13(spark, sf):
    docs = table(spark, sf, "documents").select("doc_id", "text", "lang")
    return audit_filters(docs, table(spark, sf, "labels").select("doc_id", "quality", "toxic"), F.coalesce("lang", F.lit("")))
