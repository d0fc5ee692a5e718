"""strata: layered tables, document retrieval and answer scoring as Spark jobs."""
