"""Whole plans: registered queries, the merge of a capture, period closing, discovery, alerts, site data."""
