"""Usage-telemetry analytics on Spark: parse log batches, build a star schema, aggregate it."""

from usagelens.schemas import Star

__all__ = ["Star"]
