"""Driver-table stand-ins and the registered query catalogue."""
