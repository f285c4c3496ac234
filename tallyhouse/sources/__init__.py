"""Sources, sinks and incremental loads."""
