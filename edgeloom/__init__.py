"""edgeloom: property graphs kept as Spark tables.

Parse exported vertex/edge text, find conflicting names, assign dense ids,
resolve edges, fold vertices with their edges into adjacency records (and
read them back), append or upsert deltas, and answer neighbourhood queries,
all as DataFrame plans.
"""

__version__ = "0.1.0"
