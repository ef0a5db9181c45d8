"""Readers, table writers, the test-data adapter and the data generator."""
