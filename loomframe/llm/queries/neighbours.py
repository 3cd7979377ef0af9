"""Nearest neighbours of every twentieth embedding among all."""

from pyspark.sql import functions as F

from loomframe.llm.ann import nearest
from loomframe.llm.registry import query, table


@query("op6_approximate_neighbours")
def op6(spark, sf):
    rows = table(spark, sf, "embeddings")
    out = nearest(rows, F.col("vec_id") % 20 == 0, 20)
    return out.withColumnRenamed("id", "vec_id")
