"""The star: staging, dimensions, facts, marts, reconciliation, measures."""
