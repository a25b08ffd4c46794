"""Table schemas, readers, writers and the adapter for the driver's tables."""
