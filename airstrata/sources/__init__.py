from airstrata.sources.documents import (
    file_checksums,
    file_inventory,
    parse_documents,
    read_documents,
    with_file_checksums,
    with_row_ids,
)
from airstrata.sources.lake import Lake
from airstrata.sources.split import SplitDocuments, split_documents

__all__ = [
    "Lake",
    "SplitDocuments",
    "file_checksums",
    "file_inventory",
    "parse_documents",
    "read_documents",
    "split_documents",
    "with_file_checksums",
    "with_row_ids",
]
