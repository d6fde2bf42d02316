"""End-to-end plans, fixtures, and the registered queries with their SQL."""
