"""Plans: end-to-end cleaning chains and the registered query catalogue."""
