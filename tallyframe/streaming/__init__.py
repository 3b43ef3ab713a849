from tallyframe.streaming.keyed import (
    publish_stream,
    stream_duplicate_keys,
    stream_key_counts,
    stream_only_in_source,
    stream_only_in_target,
)
from tallyframe.streaming.monitor import check_stream, stream_totals

__all__ = [
    "check_stream",
    "publish_stream",
    "stream_duplicate_keys",
    "stream_key_counts",
    "stream_only_in_source",
    "stream_only_in_target",
    "stream_totals",
]
