"""Sources and sinks: raw files, Parquet tables, JSON and HTML."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from dataclasses import dataclass
from urllib.parse import quote

from pyarrow.fs import FileSystem, FileType
from pyspark.sql import DataFrame, Row, SparkSession, functions as F
from pyspark.sql.datasource import DataSource, DataSourceWriter, WriterCommitMessage
from pyspark.sql.types import StructType

#: Folders that documents are written to.
FOLDERS = 1024


def raw_documents(spark: SparkSession, path: str, pattern: str = "*.pdf") -> DataFrame:
    """doc_id (a hash of the path), path, length and content of files; content is read only where it is selected."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", pattern).option("recursiveFileLookup", "true").load(path)
    return files.select(F.xxhash64("path").alias("doc_id"), "path", "length", "content")


def write_questions(questions: DataFrame, path: str) -> None:
    """doc_id, q_no, json -> one JSON line for each question; those of a document stand in one file, in order of their numbers."""
    questions.repartition("doc_id").sortWithinPartitions("doc_id", "q_no").select("json").write.mode("overwrite").text(path)


def write_html(documents: DataFrame, path: str, folders: int = FOLDERS) -> None:
    """doc_id, html -> one file for each document, `path`/<folder>/<doc_id>.html; see write_files(). A null html is an empty file."""
    write_files(documents.select("doc_id", F.coalesce("html", F.lit("")).cast("binary").alias("content")), path, "html", folders)


def write_files(documents: DataFrame, path: str, extension: str, folders: int = FOLDERS) -> None:
    """doc_id, content (binary) -> one file for each document, `path`/<folder>/<doc_id>.<extension>, in `folders` folders by a hash of the id.

    Each folder is written by one task, to a place of its own, and moved where it belongs when all tasks are done; a job that fails
    leaves nothing. A folder that was there before is replaced, so a second run of the same documents gives the same files. Of repeated
    ids the first content in byte order stays; null ids are left out.
    """
    documents.sparkSession.dataSource.register(DocumentFiles)
    name = F.col("doc_id").cast("string")
    rows = documents.filter("doc_id is not null").select(F.format_string("%04x", F.pmod(F.xxhash64(name), F.lit(folders)).cast("int")).alias("folder"), name.alias("name"), "content")
    rows.repartition("folder").sortWithinPartitions("folder", "name", "content").write.format("document_files").option("extension", extension).mode("append").save(path)


class DocumentFiles(DataSource):
    """Sink of rows (folder, name, content), sorted by these and each folder in one task."""

    @classmethod
    def name(cls) -> str:
        return "document_files"

    def writer(self, schema: StructType, overwrite: bool) -> DataSourceWriter:
        return _FileWriter(self.options["path"], self.options["extension"])


@dataclass
class _Written(WriterCommitMessage):
    place: str
    folders: list[str]


class _FileWriter(DataSourceWriter):
    """Tasks write below a folder of the job; commit() moves whole folders, whose number is bounded, and abort() deletes the job's."""

    def __init__(self, path: str, extension: str):
        self.path, self.extension, self.job = path, extension, f"_job-{uuid.uuid4().hex}"

    def _at(self) -> tuple[FileSystem, str]:
        return FileSystem.from_uri(self.path if "://" in self.path else self.path.removeprefix("file:"))

    def write(self, rows: Iterator[Row]) -> _Written:
        files, root = self._at()
        place, folders, last = f"{self.job}/{uuid.uuid4().hex}", [], None
        for r in rows:
            if not folders or folders[-1] != r.folder:
                folders.append(r.folder)
                files.create_dir(f"{root}/{place}/{r.folder}", recursive=True)
            if (r.folder, r.name) != last:
                with files.open_output_stream(f"{root}/{place}/{r.folder}/{quote(r.name, safe='')}.{self.extension}") as out:
                    out.write(r.content)
            last = r.folder, r.name
        return _Written(place, folders)

    def commit(self, messages: list[_Written | None]) -> None:
        files, root = self._at()
        for m in filter(None, messages):
            for folder in m.folders:
                if files.get_file_info(f"{root}/{folder}").type != FileType.NotFound:
                    files.delete_dir(f"{root}/{folder}")
                files.move(f"{root}/{m.place}/{folder}", f"{root}/{folder}")
        self.abort(messages)

    def abort(self, messages: list[_Written | None]) -> None:
        files, root = self._at()
        if files.get_file_info(f"{root}/{self.job}").type != FileType.NotFound:
            files.delete_dir(f"{root}/{self.job}")
