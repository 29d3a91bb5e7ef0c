"""User-level jobs, composed of sources, operators and sinks."""
