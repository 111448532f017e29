"""Column builders: URLs, file names, keys and plain text."""
