"""SQL a second engine runs over the same tables, to check every query's result."""
