"""Registered queries, their SQL counterparts and the stand-in tables both read."""
