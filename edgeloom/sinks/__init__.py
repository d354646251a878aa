"""sinks of edgeloom."""
