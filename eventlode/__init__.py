"""Event analytics on Spark: layered event tables, a star schema, marts, KPIs and quality checks."""
