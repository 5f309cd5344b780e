"""Readers and writers: lake tables, HR sheets, parameters, the CDC stream, test fixtures."""
