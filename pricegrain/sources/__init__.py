"""Readers, writers, the asset store and the feed parsers."""
