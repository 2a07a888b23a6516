"""Stand-in inputs built from the driver tables, and the query catalog."""
