"""Run plans: configuration, orchestration and the query registry."""
