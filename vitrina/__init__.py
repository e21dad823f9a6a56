"""vitrina: retail customer analytics and next-best-action on Spark.

Every operator is a ``DataFrame -> DataFrame`` function meant to be chained with
``DataFrame.transform``. The heavy lifting is Catalyst/Tungsten work (joins,
aggregates, windows); Spark ML does the model fitting; Structured Streaming
scores arriving visits.
"""

__version__ = "0.1.0"
