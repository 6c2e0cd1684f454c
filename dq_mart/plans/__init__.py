"""Jobs, table specs, the report and the query registry."""
