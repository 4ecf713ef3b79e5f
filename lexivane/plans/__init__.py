"""Registered queries, their SQL, and the command facade."""
