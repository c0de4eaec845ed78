"""Price-history analytics on Spark: sources, operators, plans and streaming helpers."""
