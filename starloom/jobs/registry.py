"""All registered queries over timestreams and maps, and their SQL."""

from __future__ import annotations

from starloom.jobs import map_queries, sky_queries, stream_queries
from starloom.jobs.base import QUERIES, SQL

__all__ = ["QUERIES", "SQL", "map_queries", "sky_queries", "stream_queries"]
