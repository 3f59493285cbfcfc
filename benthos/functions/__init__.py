"""Part of benthos; see the README for the map."""
