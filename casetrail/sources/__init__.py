"""Reading and writing: tables, configuration, replication, JSON lines."""
