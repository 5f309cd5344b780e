"""Pipeline stages as DataFrame -> DataFrame functions (batch and, where marked, streaming)."""
