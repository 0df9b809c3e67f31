"""spendlens: campaign-funnel analytics on Spark DataFrames.

Layers: ``functions`` (Column expressions), ``sources`` (schemas, readers,
writers, catalog, fixtures), ``operators`` (DataFrame -> DataFrame),
``plans`` (composite jobs: mart, imputation, BI extract, incremental) and
``streaming`` (the incremental mart as a Structured Streaming job).
"""

__version__ = "0.1.0"
