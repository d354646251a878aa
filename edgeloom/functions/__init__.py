"""functions of edgeloom."""
