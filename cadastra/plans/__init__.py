"""Operators put together: the whole run, and the named queries with their SQL."""
