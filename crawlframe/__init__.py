"""Crawl frontier and news-link analytics on Spark."""
