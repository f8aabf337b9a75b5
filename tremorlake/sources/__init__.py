"""Readers for queues, landing folders, the lake and the relational table."""
