"""Readers and writers: landed responses, the event log, tables, test data."""
