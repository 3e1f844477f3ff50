from pulsekit.streaming.stream_ops import (
    anonymize_stream,
    bucket_means_stream,
    quarantine_stream,
    read_stream,
    start,
)

__all__ = ["anonymize_stream", "bucket_means_stream", "quarantine_stream", "read_stream", "start"]
