from . import checks, ingestion, lifecycle, relational, streams, views
from .registry import QUERIES, SQL

__all__ = ["QUERIES", "SQL", "checks", "ingestion", "lifecycle", "relational", "streams", "views"]
