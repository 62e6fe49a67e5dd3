"""Build order of the warehouse and the registry of checkable queries."""
