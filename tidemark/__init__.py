"""tidemark: quality-gated, incremental table enrichment written as Spark jobs.

Every public function takes and returns DataFrames (or writes them with the
DataFrameWriter); nothing creates or stops the caller's SparkSession.
"""

__version__ = "0.1.0"
