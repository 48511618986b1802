"""Batch sources and sinks."""

from layercake.sources.csv import discover_tables, ingest_sources, read_raw_csv
from layercake.sources.sinks import LOSSLESS_CSV, publish_table, read_batches, write_batches
from layercake.sources.tables import load_tables, release_batch
