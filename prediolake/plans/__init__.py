"""Named queries, portal pipelines and orchestration."""
