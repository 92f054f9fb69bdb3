"""Operators put together: the whole motion job, lookups and the registered queries."""
