"""The warehouse: dimension and fact loads, reports, read views, orchestration."""
