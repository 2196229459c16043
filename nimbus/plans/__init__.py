"""Compositions users run: the fetch and process jobs, the marts, the
dashboard datasets, and the registered driver queries with their oracles."""
