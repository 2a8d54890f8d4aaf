"""statflow: distributed statistics on tables and text, written as Spark DataFrame
plans and Spark ML pipelines."""

__version__ = "0.1.0"
