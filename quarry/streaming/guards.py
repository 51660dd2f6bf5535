"""Streaming refusal (T1, T2).

Extract and load move whole tables in batch; both refuse a streaming
DataFrame up front, before any other check, so the error names the real
cause. ``execute_sql`` has no such check: SQL text is batch by nature.
"""

from __future__ import annotations

from pyspark.sql import DataFrame


class StreamingNotSupported(RuntimeError):
    pass


def refuse_streaming(df: DataFrame, stage: str, what: str) -> None:
    if df.isStreaming:
        raise StreamingNotSupported(f"{stage} does not support streaming input ({what} is streaming)")
