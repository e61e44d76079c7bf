"""Batch sinks (the streaming sinks live in ``agora.streaming``)."""
