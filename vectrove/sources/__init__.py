"""Readers and writers: raw float matrices, vector tables, training logs."""
