"""dq_mart: data profiling, cleaning, star-schema load and report analytics
as Spark DataFrame operators."""

__version__ = "0.1.0"
