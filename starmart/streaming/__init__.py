"""Structured Streaming entry points: incremental fact loads."""

from starmart.streaming.increments import merge_fact_batch, start_fact_increments

__all__ = ["merge_fact_batch", "start_fact_increments"]
