"""File-format scans and sinks."""
