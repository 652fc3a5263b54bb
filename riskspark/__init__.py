"""riskspark: credit-risk scoring and monitoring as Spark DataFrame jobs."""

__version__ = "0.1.0"
