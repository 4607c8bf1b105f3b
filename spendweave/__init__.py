"""Purchase-order enrichment as Spark DataFrame operators and plans."""

__all__ = ["functions", "operators", "plans", "sources", "streaming"]
