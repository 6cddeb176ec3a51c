"""Writers: partitioned files, typed and keyed tables, and connectors."""
