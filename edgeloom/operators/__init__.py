"""operators of edgeloom."""
