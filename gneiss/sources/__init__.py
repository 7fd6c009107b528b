"""Sources, mappers and sinks."""
