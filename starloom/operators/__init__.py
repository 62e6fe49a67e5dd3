"""DataFrame -> DataFrame operators of the warehouse."""
