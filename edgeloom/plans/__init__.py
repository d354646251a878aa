"""plans of edgeloom."""
