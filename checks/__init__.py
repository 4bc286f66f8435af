"""Registered queries, their SQL twins, and the test inputs both read."""
