"""Readers: nested documents, slice files, star-schema tables and run-result files."""
