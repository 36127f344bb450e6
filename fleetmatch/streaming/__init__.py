"""Deliberately empty.

Coverage is defined on whole exports: a device is stale when the newest export
does not list it, and every import rebuilds the match. No operator in scope has
a watermark, a window over time or incremental state.
"""
