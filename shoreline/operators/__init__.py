"""DataFrame operators: reads, versioned tables, change capture, merge,
quality rules, assets, vector search, export and catalog."""
