"""DataFrame -> DataFrame steps: flatten, validate, deduplicate, merge, enrich, aggregate, audit."""
