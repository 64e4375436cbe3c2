"""All registered queries with the SQL they are checked against."""

from stayline.plans.catalog import features, ingest, models, reports, retention, value  # noqa: F401
from stayline.plans.catalog.base import oracle_sql, queries

__all__ = ["queries", "oracle_sql"]
