"""Where results go: hour-partitioned lake tables."""
