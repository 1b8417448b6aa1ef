"""Archives of primitives: a zip file for each document with a member for each page, read by page."""

from __future__ import annotations

import io
import json
import zipfile
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from urllib.parse import unquote

import pandas as pd
from pyarrow.fs import FileSelector, FileSystem, FileType
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, EqualTo, Filter, GreaterThan, GreaterThanOrEqual, In, InputPartition, LessThan, LessThanOrEqual
from pyspark.sql.types import StructType

from quire.sources.files import FOLDERS, write_files

SCHEMA = "doc_id string, page_no int, prim_id long, kind string, ch string, x0 double, top double, x1 double, bottom double"
#: Bytes of archives that one partition reads, about.
PARTITION_BYTES = 64 << 20


def write_archives(prims: DataFrame, path: str, folders: int = FOLDERS) -> None:
    """Primitives (columns of SCHEMA) -> `path`/<folder>/<doc_id>.zip, a member of JSON lines for each page, in order of prim_id.

    Files and folders are written as by write_html(): a run that fails leaves nothing, a second one gives the same bytes. Null doc_ids and
    pages are left out; a document's primitives meet in one row.
    """
    line = F.to_json(F.struct(*[c for c in prims.columns if c not in ("doc_id", "page_no")]))
    pages = prims.filter("doc_id is not null and page_no is not null").groupBy("doc_id", "page_no").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("prim_id", line.alias("line")))), lambda x: x["line"]), "\n").alias("text"))
    each = pages.groupBy("doc_id").agg(F.array_sort(F.collect_list(F.struct("page_no", "text"))).alias("pages"))

    @F.pandas_udf("binary")
    def packed(documents: pd.Series) -> pd.Series:
        return documents.map(_packed)

    write_files(each.select("doc_id", packed("pages").alias("content")), path, "zip", folders)


def _packed(pages: Iterable[dict]) -> bytes:
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as z:
        for p in pages:
            z.writestr(zipfile.ZipInfo(f"{p['page_no']}.jsonl", (1980, 1, 1, 0, 0, 0)), p["text"], zipfile.ZIP_DEFLATED)
    return out.getvalue()


def read_archives(spark: SparkSession, path: str) -> DataFrame:
    """All primitives of the archives below `path`, as SCHEMA. Filters on page_no are pushed down: of other pages no byte is read.

    Planning lists names and sizes only; archives are opened by the tasks, each of which reads about PARTITION_BYTES of them.
    """
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    spark.dataSource.register(PrimitiveArchives)
    return spark.read.format("primitive_archives").load(path)


class PrimitiveArchives(DataSource):
    @classmethod
    def name(cls) -> str:
        return "primitive_archives"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema: StructType) -> ArchiveReader:
        return ArchiveReader(self.options["path"])


@dataclass
class _Archives(InputPartition):
    paths: list[str]


#: Tests of a page number by the kind of a filter.
_TESTS = {EqualTo: lambda p, v: p == v, In: lambda p, v: p in v, GreaterThan: lambda p, v: p > v, GreaterThanOrEqual: lambda p, v: p >= v, LessThan: lambda p, v: p < v, LessThanOrEqual: lambda p, v: p <= v}


class ArchiveReader(DataSourceReader):
    def __init__(self, path: str):
        self.path, self.filters = path, []

    def _files(self) -> tuple[FileSystem, str]:
        return FileSystem.from_uri(self.path if "://" in self.path else self.path.removeprefix("file:"))

    def pushFilters(self, filters: list[Filter]) -> Iterable[Filter]:
        """Keeps tests of page_no; all others are Spark's."""
        for f in filters:
            if type(f) in _TESTS and f.attribute == ("page_no",):
                self.filters.append((type(f), f.value))
            else:
                yield f

    def partitions(self) -> list[_Archives]:
        files, root = self._files()
        found = sorted((f for f in files.get_file_info(FileSelector(root, recursive=True)) if f.type == FileType.File and f.path.endswith(".zip")), key=lambda f: f.path)
        out, size = [], PARTITION_BYTES
        for f in found:
            if size + f.size > PARTITION_BYTES:
                out.append(_Archives([]))
                size = 0
            out[-1].paths.append(f.path)
            size += f.size
        return out or [_Archives([])]

    def opened(self, files: FileSystem, path: str) -> io.IOBase:
        return files.open_input_file(path)

    def read(self, partition: _Archives) -> Iterator[tuple]:
        files, _ = self._files()
        for path in partition.paths:
            doc_id = unquote(path.rpartition("/")[2].removesuffix(".zip"))
            with self.opened(files, path) as f, zipfile.ZipFile(f) as z:
                for name in z.namelist():  # from the directory at the archive's end
                    page = int(name.removesuffix(".jsonl"))
                    if all(_TESTS[kind](page, value) for kind, value in self.filters):
                        for line in z.read(name).decode().splitlines():
                            p = json.loads(line)
                            yield doc_id, page, p.get("prim_id"), p.get("kind"), p.get("ch"), p.get("x0"), p.get("top"), p.get("x1"), p.get("bottom")
