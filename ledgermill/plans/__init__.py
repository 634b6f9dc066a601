"""End-to-end plans: the warehouse, serving queries, statistics."""
