"""Usage, cost and risk analytics over data-warehouse audit logs, as Spark DataFrame jobs."""

from auditlens.settings import CustomClient, Settings

__all__ = ["CustomClient", "Settings"]
