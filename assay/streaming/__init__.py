"""Per-micro-batch data-quality checks for Structured Streaming sources."""

from assay.streaming.micro_batch import check_stream, validate_stream

__all__ = ["check_stream", "validate_stream"]
