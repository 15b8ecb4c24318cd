"""Layer jobs, the command line, and the registered queries with their SQL."""
