"""Spark data source of archive members: one partition an archive.

    spark.dataSource.register(ArchiveMembers)
    spark.read.format("archive_members").option("kind", "tar").option("root", dir).option("paths", "a.tar,b.tar").load()
"""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from .ranges import FileClient
from .tar import TarArchive
from .zips import ZipArchive

SCHEMA = "archive_key string, member_name string, typeflag string, member_size bigint, crc32 bigint, header_offset bigint, data_offset bigint, next_header_offset bigint"


class ArchivePart(InputPartition):
    def __init__(self, path: str):
        self.path = path


def tar_rows(client, path: str, start: int = 0, most: int | None = None) -> Iterator[tuple]:
    for m in TarArchive(client, path).members(start, most):
        yield path, m.name, m.typeflag, m.size, None, m.header_offset, m.data_offset, m.next_header_offset


def zip_rows(client, path: str) -> Iterator[tuple]:
    for m in ZipArchive(client, path).members():
        yield path, m.name, "0", m.size, m.crc32, m.header_offset, None, None


class _Reader(DataSourceReader):
    def __init__(self, options):
        self.kind, self.root, self.paths = options.get("kind", "tar"), options["root"], [p for p in options["paths"].split(",") if p]

    def partitions(self):
        return [ArchivePart(p) for p in self.paths]

    def read(self, part):
        yield from (zip_rows if self.kind == "zip" else tar_rows)(FileClient(self.root), part.path)


class ArchiveMembers(DataSource):
    @classmethod
    def name(cls):
        return "archive_members"

    def schema(self):
        return SCHEMA

    def reader(self, schema):
        return _Reader(self.options)


def walk_on(progress, root: str, most: int):
    """Up to ``most`` further members of each archive of (archive_key, next_header_offset), one task an archive."""

    def walk(batches):
        import pandas as pd

        names = [c.split()[0] for c in SCHEMA.split(", ")]
        for batch in batches:
            for path, start in zip(batch["archive_key"], batch["next_header_offset"]):
                yield pd.DataFrame(tar_rows(FileClient(root), path, int(start), most), columns=names).astype({"crc32": "Int64"})

    return progress.select("archive_key", "next_header_offset").mapInPandas(walk, SCHEMA)


def read_payloads(members, root: str):
    """Adds ``content``: the member's bytes.  Archives are read where their rows are, a row at a time."""

    def fetch(batches):
        import pandas as pd

        client = FileClient(root)
        for batch in batches:
            for k in range(0, len(batch), 16):
                part = batch.iloc[k : k + 16]
                data = [client.fetch(r.archive_key, r.data_offset, r.data_offset + r.member_size - 1).data if r.member_size else b"" for r in part.itertuples()]
                yield pd.DataFrame({**{c: part[c] for c in batch.columns}, "content": data})

    columns = ["archive_key", "member_name", "member_size", "header_offset", "data_offset"]
    return members.select(*columns).mapInPandas(fetch, "archive_key string, member_name string, member_size bigint, header_offset bigint, data_offset bigint, content binary")


