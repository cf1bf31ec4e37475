"""A streaming source that tells when the files below a folder have changed."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from urllib.parse import urlsplit

from pyspark.sql.datasource import DataSource, DataSourceStreamReader, InputPartition

NAME = "landing_listing"


def listed(root: str) -> tuple[int, str]:
    """Number and digest of the files below a folder: their paths, times and sizes."""
    from pyarrow import fs

    parts = urlsplit(root)
    if parts.scheme in ("", "file"):
        files, base = fs.LocalFileSystem(), parts.path
    else:
        scheme = "s3" if parts.scheme in ("s3a", "s3n") else parts.scheme
        files, base = fs.FileSystem.from_uri(parts._replace(scheme=scheme).geturl())
    selector = fs.FileSelector(base, allow_not_found=True, recursive=True)
    # Order-free, so that the listing needs no sort: a sum of hashes, one for each version.
    count, total = 0, 0
    for info in files.get_file_info(selector):
        if info.type == fs.FileType.File and info.base_name[:1] not in "._":
            version = f"{info.path}\n{info.mtime_ns}\n{info.size}".encode()
            count, total = count + 1, total + int.from_bytes(hashlib.sha256(version).digest())
    return count, format(total % (1 << 256), "064x")


class ListingReader(DataSourceStreamReader):
    def __init__(self, options: dict[str, str]):
        self.root = options["path"]

    def initialOffset(self) -> dict:
        return {"files": 0, "digest": format(0, "064x")}

    def latestOffset(self) -> dict:
        files, digest = listed(self.root)
        return {"files": files, "digest": digest}

    def partitions(self, start: dict, end: dict) -> list[InputPartition]:
        return [InputPartition((end["files"], end["digest"]))]

    def read(self, partition: InputPartition) -> Iterator[tuple]:
        yield partition.value


class LandingListing(DataSource):
    """A row for each change of what is listed below ``path``, hidden files aside.

    The offset is a digest of all paths, times and sizes. So a batch starts when a file has
    come, was rewritten under its name, or has gone, whatever its time; a newest time as the
    offset would miss files that appear with an older one. No file is opened, and
    which versions are new is for the batch to find out. The listing is made by the driver,
    with the file systems that pyarrow knows: local folders, HDFS, S3 and GCS.
    """

    @classmethod
    def name(cls) -> str:
        return NAME

    def schema(self) -> str:
        return "files long, digest string"

    def streamReader(self, schema) -> DataSourceStreamReader:
        return ListingReader(dict(self.options))
