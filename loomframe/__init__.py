"""Feature engineering, model fitting and evaluation as PySpark DataFrame jobs.

Fitting is a distributed aggregation that yields a small parameter table;
transforming and scoring are projections or joins.
"""
