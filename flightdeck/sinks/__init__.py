"""Writers: stored tables, partitioned monthly export, snapshots, publish."""
