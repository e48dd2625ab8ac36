"""Writers: partitioned table writes and the run-log."""
