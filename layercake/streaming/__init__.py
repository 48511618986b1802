"""Structured Streaming intake."""

from layercake.streaming.ingest import ingest_increment, read_sink, stream_raw_csv
