"""Registered queries over the supplied tables, each with the SQL that checks it."""

from __future__ import annotations


def registered() -> dict[str, tuple]:
    """name -> (query, checking SQL or None)."""
    from crawlframe.catalog import content_queries, metric_queries, status_queries, stream_queries, url_queries

    return {**url_queries.QUERIES, **status_queries.QUERIES, **content_queries.QUERIES, **metric_queries.QUERIES, **stream_queries.QUERIES}
