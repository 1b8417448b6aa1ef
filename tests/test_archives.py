"""Archives of primitives: pages that no filter asks for are not read."""

from pyspark.sql import functions as F
from pyspark.sql.datasource import EqualTo, GreaterThan, In

from quire.sources.archives import SCHEMA, ArchiveReader, read_archives, write_archives


def prims(spark):
    rows = spark.range(6_000).select((F.col("id") % 3).cast("string").alias("doc_id"), (F.col("id") % 20).cast("int").alias("page_no"), F.col("id").alias("prim_id"), F.lit("char").alias("kind"), F.sha2(F.col("id").cast("string"), 256).alias("ch"), *[F.lit(1.5).alias(c) for c in ("x0", "top", "x1", "bottom")])
    odd = spark.createDataFrame([("a/b", 0, None, None, "é\n", None, 0.0, 0.0, 0.0), (None, 0, 1, "char", "x", 0.0, 0.0, 0.0, 0.0), ("c", None, 1, "char", "x", 0.0, 0.0, 0.0, 0.0)], SCHEMA)
    return rows.unionByName(odd)


def test_what_is_written_is_read(spark, tmp_path):
    for _ in range(2):
        write_archives(prims(spark), f"{tmp_path}/a", folders=4)
    assert sorted(f.name for f in (tmp_path / "a").glob("*/*")) == ["0.zip", "1.zip", "2.zip", "a%2Fb.zip"]
    back, want = read_archives(spark, f"{tmp_path}/a"), prims(spark).filter("doc_id is not null and page_no is not null")
    assert sorted(map(tuple, back.collect()), key=repr) == sorted(map(tuple, want.collect()), key=repr)
    for condition in ("page_no = 3", "page_no in (3, 5) and prim_id > 100", "page_no >= 18", "page_no < 2 and doc_id = '1'", "page_no = 99"):
        assert sorted(map(tuple, back.filter(condition).collect()), key=repr) == sorted(map(tuple, want.filter(condition).collect()), key=repr)
    write_archives(prims(spark).limit(0), f"{tmp_path}/none")
    (tmp_path / "none").mkdir(exist_ok=True)
    assert read_archives(spark, f"{tmp_path}/none").count() == 0


class Counting:
    """A file that counts the bytes read from it."""

    read_bytes = 0

    def __init__(self, file):
        self.file = file

    def __getattr__(self, name):
        return getattr(self.file, name)

    def __enter__(self):
        return self

    def __exit__(self, *_):
        self.file.close()

    def read(self, *n):
        data = self.file.read(*n)
        Counting.read_bytes += len(data)
        return data


def test_a_filter_on_a_page_reads_its_bytes_only(spark, tmp_path):
    write_archives(prims(spark).filter("page_no is not null"), f"{tmp_path}/a", folders=1)

    def read(*filters):
        reader = ArchiveReader(f"{tmp_path}/a")
        left = list(reader.pushFilters(list(filters)))
        reader.opened = lambda files, path: Counting(files.open_input_file(path))
        Counting.read_bytes = 0
        return sum(1 for p in reader.partitions() for _ in reader.read(p)), Counting.read_bytes, left

    all_, every, _ = read()
    some, few, left = read(EqualTo(("page_no",), 7), GreaterThan(("prim_id",), 5))
    assert all_ == 6_001 and some == 300 and few < every / 6 and [type(f) for f in left] == [GreaterThan]
    assert read(In(("page_no",), (7, 8)))[0] == 600 and read(EqualTo(("page_no",), 99))[1] < few


def test_partitions_are_planned_by_bytes(spark, tmp_path, monkeypatch):
    write_archives(prims(spark), f"{tmp_path}/a", folders=4)
    monkeypatch.setattr("quire.sources.archives.PARTITION_BYTES", 1_000)
    assert len(ArchiveReader(f"{tmp_path}/a").partitions()) == 4 and len(ArchiveReader(f"file:{tmp_path}/a").partitions()) == 4
