"""streaming of edgeloom."""
