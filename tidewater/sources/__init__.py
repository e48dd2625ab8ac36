"""Readers: landing files, lakehouse tables, zone lookup, test fixtures."""
