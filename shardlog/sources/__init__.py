"""Where events, rows and metadata come from."""
