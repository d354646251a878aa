"""sources of edgeloom."""
