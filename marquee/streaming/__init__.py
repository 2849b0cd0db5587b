"""Incremental usage tracking with Structured Streaming.

The original front end appended one history record per question and bumped
a per-model counter in memory.  Here usage records land as files; a stream
appends them to the history table and keeps the per-model counts as
streaming state.  Both queries checkpoint under the session's shared
checkpoint directory, so a restarted job resumes where it stopped.
"""

from marquee.streaming.history import (  # noqa: F401
    QUESTION_RECORD_SCHEMA, USAGE_RECORD_SCHEMA, stream_history, stream_model_counts)
from marquee.streaming.publish import (  # noqa: F401
    prune_versions, publish, read_published, versions)
