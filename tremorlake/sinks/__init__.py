"""Writers for queues, page archives and the relational table."""
