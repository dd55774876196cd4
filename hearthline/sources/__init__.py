"""Table specifications, CSV scans and sinks."""
