"""Streaming entry points.

The reference has no streams: every input is a whole-file read and there
are no windows, watermarks or stateful operators to rebuild. What it does
have is an *idempotent load* of node tables keyed by a unique id (K1). That
load is offered here as an incremental Structured Streaming job, so new
bronze files can be appended to a node table as they arrive.
"""

from mercato.streaming.upsert import start_keyed_append  # noqa: F401
