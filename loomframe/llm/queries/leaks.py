"""Documents that hold passages of the benchmark."""

from loomframe.llm.decontaminate import contaminated
from loomframe.llm.registry import query, table

WORDS = r"regexp_extract_all(lower(coalesce(text, '')), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"

# Every window of an item's length that starts at a shared shingle, by plain joins.
SQL = rf"""
WITH i0 AS (SELECT min(item_id) AS item_id, w FROM (SELECT item_id, {WORDS} AS w FROM benchmark) WHERE len(w) > 0 GROUP BY w),
it AS (SELECT item_id, len(w) AS length, least(5, len(w)) AS k, w FROM i0),
d AS (SELECT doc_id, {WORDS} AS w FROM documents),
si AS (SELECT item_id, length, k, array_to_string(w[p:p + k - 1], ' ') AS s FROM (SELECT *, unnest(range(1, length - k + 2)) AS p FROM it)),
ci AS (SELECT item_id, length, k, s, count(*) AS c FROM si GROUP BY ALL),
sd AS (SELECT doc_id, n, k, p - 1 AS place, array_to_string(w[p:p + k - 1], ' ') AS s
       FROM (SELECT doc_id, len(w) AS n, w, k, unnest(range(1, len(w) - k + 2)) AS p FROM d, (SELECT DISTINCT k FROM it))),
h AS (SELECT doc_id, n, item_id, length, k, c, place, s FROM sd JOIN ci USING (k, s)),
st AS (SELECT DISTINCT doc_id, n, item_id, length, k, least(place, greatest(0, n - length)) AS start FROM h),
sh AS (SELECT st.doc_id, st.item_id, st.length, st.k, st.n, st.start, h.s, least(count(*), min(h.c)) AS m
       FROM st JOIN h ON st.doc_id = h.doc_id AND st.item_id = h.item_id AND h.place BETWEEN st.start AND st.start + st.length - st.k
       GROUP BY ALL),
sim AS (SELECT doc_id, item_id, length, start, sum(m) AS shared, least(n, length) - k + 1 + length - k + 1 AS total FROM sh GROUP BY doc_id, item_id, length, start, n, k),
r AS (SELECT *, shared / (total - shared)::DOUBLE AS similarity FROM sim WHERE shared / (total - shared)::DOUBLE >= 0.8)
SELECT doc_id, item_id, arg_min(start, (-similarity, start))::INTEGER AS start, min(length)::INTEGER AS words, round(max(similarity), 6) AS similarity FROM r GROUP BY doc_id, item_id
"""


@query("op1_benchmark_decontamination", SQL)
def op1(spark, sf):
    from pyspark.sql import functions as F

    found = contaminated(table(spark, sf, "documents"), table(spark, sf, "benchmark"))
    return found.select("doc_id", "item_id", "start", "words", F.round("similarity", 6).alias("similarity"))
