"""Table refreshes composed from sources, operators and sinks."""
