"""Sources, dimension tables and sinks."""
