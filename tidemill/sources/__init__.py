"""Readers, writers, table DDL and the shared working folder."""
