"""The models: staging, enrichment, star schema, marts, analyses, dashboard frames."""
