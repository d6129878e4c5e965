"""End-to-end jobs that chain sources, operators and sinks."""
