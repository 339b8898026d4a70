from chronofold.maintenance.chunks import (
    compress_chunks,
    decompress,
    disable_chunk_skipping,
    drop_chunks,
    enable_chunk_skipping,
    purge,
    reorder,
)
from chronofold.maintenance.tables import alter, checksum, convert, rebuild, to_plain

__all__ = [
    "alter",
    "checksum",
    "compress_chunks",
    "convert",
    "decompress",
    "disable_chunk_skipping",
    "drop_chunks",
    "enable_chunk_skipping",
    "purge",
    "rebuild",
    "reorder",
    "to_plain",
]
