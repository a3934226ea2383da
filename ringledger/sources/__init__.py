"""Source tables: expected columns, readers, and test-data stand-ins."""
