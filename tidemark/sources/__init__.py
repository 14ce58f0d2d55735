"""Sources: NDJSON landings, the date-partitioned archive, SQLite spools."""
from .archive import archive_spool, archived_messages, archived_structures, damaged, write_archive
from .ndjson import read_ndjson, stream_ndjson, validated
from .spool import SpoolDataSource, note_failed, note_uploaded, read_spool, register, tables

__all__ = ["SpoolDataSource", "archive_spool", "archived_messages", "archived_structures", "damaged", "note_failed", "note_uploaded", "read_ndjson", "read_spool", "register", "stream_ndjson", "tables", "validated", "write_archive"]
