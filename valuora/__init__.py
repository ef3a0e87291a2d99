"""valuora: a Spark-native tabular valuation and monitoring library.

Every operator is a ``DataFrame -> DataFrame`` function, a Spark SQL column
expression, a ``pyspark.ml`` Estimator/Transformer, or a Structured Streaming
job.  Column names, years, bounds and lists are parameters; nothing is tied to
one dataset.

Sub-packages
------------
``sources``    scans, sinks, the derived ``sales`` table, persistence, manifests
``functions``  column expressions (feature arithmetic, contract checks, pricing)
``operators``  table operators: validation, splits, aggregates, encoders,
               metrics, drift, selection signals, importance
``plans``      composed jobs: preprocessing pipelines, model comparison,
               production training, scoring, holdout evaluation, profiling
``streaming``  Structured Streaming twins of the scoring/telemetry/drift jobs
"""

__version__ = "0.1.0"
