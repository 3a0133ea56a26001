"""Incremental loading of landed files with Structured Streaming.

The source system has no streams: it lands CSV files under a dated folder
every day and reloads each table in full.  ``load_landed`` re-expresses that
daily job as a file-stream run with ``availableNow``: the stream checkpoint
remembers which landed files were already loaded, so each run picks up
exactly the new days and stops.
"""

from traitmatch.streaming.ingest import load_landed

__all__ = ["load_landed"]
