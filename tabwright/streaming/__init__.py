"""Scoring on Structured Streaming."""

from tabwright.streaming.score import score_stream

__all__ = ["score_stream"]
