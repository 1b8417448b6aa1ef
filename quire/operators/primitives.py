"""S1: characters, rules and images; their store."""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from quire.functions.glyphs import Glyphs, laid_out

#: Stand-in layout of plain text: points of a character and a line, lines of a page.
STEP, LEADING, PAGE_LINES = 6.0, 12.0, 40
KINDS = ("chars", "rules", "images")


def glyphs(docs: DataFrame) -> DataFrame:
    """Characters of plain texts laid out in a fixed grid: doc_id, page_no, line_no, col, ch, x0, top, x1, bottom.

    Lines are exploded first and characters inside them, so that a character's line is known without a window: the
    whole layout is one map over the documents. Line feeds end lines and are no glyphs.
    """
    lines = docs.select("doc_id", F.posexplode(F.split("text", "\n")).alias("line_no", "line"))
    chars = lines.filter("line <> ''").select("doc_id", "line_no", F.posexplode(F.split("line", "")).alias("col", "ch"))
    return chars.select(
        "doc_id", F.floor(F.col("line_no") / PAGE_LINES).cast("int").alias("page_no"), "line_no", "col", "ch",
        (F.col("col") * STEP).alias("x0"), ((F.col("line_no") % PAGE_LINES) * LEADING).alias("top"),
        ((F.col("col") + 1) * STEP).alias("x1"), ((F.col("line_no") % PAGE_LINES + 1) * LEADING).alias("bottom"),
    )


def glyph_pages(docs: DataFrame, keep: Callable[[dict[str, Column]], list[Column]] | None = None) -> DataFrame:
    """The characters of glyphs() as a parser hands them over, page by page: doc_id, page_no, glyphs, an array of line_no, col, ch and box.

    One map over the documents, without a shuffle: a page's characters are never apart. Pages without a glyph have no row; a doc_id has to be one
    row. `keep` makes other fields from the columns of a glyph, so that nothing is made that nobody reads.
    """
    lines = docs.select("doc_id", F.split("text", "\n").alias("lines"))
    own = lambda lines, p: F.struct(p.alias("page_no"), F.slice(lines, p * PAGE_LINES + 1, PAGE_LINES).alias("lines"))
    pages = F.transform(F.sequence(F.lit(0), F.floor((F.size("lines") - 1) / PAGE_LINES).cast("int")), lambda p: own(F.col("lines"), p))
    rows = lines.filter("lines is not null").select("doc_id", F.explode(pages).alias("p")).select("doc_id", "p.page_no", "p.lines")

    def glyph(ch: Column, col: Column, i: Column) -> Column:
        made = {"line_no": F.col("page_no") * PAGE_LINES + i, "col": col, "ch": ch, "x0": col * STEP, "top": i * LEADING, "x1": (col + 1) * STEP, "bottom": (i + 1) * LEADING}
        return F.struct(*(keep(made) if keep else [v.alias(k) for k, v in made.items()]))

    made = F.flatten(F.transform("lines", lambda line, i: F.transform(F.when(line != "", F.split(line, "")).otherwise(F.array().cast("array<string>")), lambda ch, col: glyph(ch, col, i))))
    return rows.filter(F.exists("lines", lambda line: line != "")).select("doc_id", "page_no", made.alias("glyphs"))


def texts_of(docs: DataFrame) -> DataFrame:
    """Plain texts as pages that are laid out where they are read (see grid()): doc_id, texts. Documents that share a doc_id share its pages, so they are one row; others are not shuffled."""
    if docs.groupBy("doc_id").count().filter("count > 1").isEmpty():
        return docs.select("doc_id", F.array("text").alias("texts"))
    return docs.groupBy("doc_id").agg(F.collect_list("text").alias("texts"))


def grid(texts: pa.ListArray) -> Iterator[Glyphs]:
    """The characters of glyphs() in numpy, some pages at a time; they are 12 points in size."""
    return laid_out(texts, STEP, LEADING, PAGE_LINES)


def by_page(chars: DataFrame) -> DataFrame:
    """Characters as pages (doc_id, page_no, glyphs), dealt out once; pages stay as they are."""
    if "glyphs" in chars.columns:
        return chars
    page = ["doc_id", "page_no"]
    own = F.struct(*[F.col(f"`{c}`") for c in chars.columns if c not in page])
    return chars.repartition(*page).groupBy(*page).agg(F.collect_list(own).alias("glyphs"))


def deduplicated(prims: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """One row for each key, the first in `order`, which has to be total: the choice never depends on partitioning.

    A minimum over structs is combined before the shuffle, which a window is not.
    """
    rest = [c for c in prims.columns if c not in keys]
    first = F.min_by(F.struct(*rest), F.struct(*order)) if rest else F.lit(1)
    return prims.groupBy(*keys).agg(first.alias("row__")).select(*keys, "row__.*").select(*prims.columns)


def duplicates(prims: DataFrame, keys: list[str]) -> DataFrame:
    """Keys that occur more than once, with their number of rows."""
    return prims.groupBy(*keys).agg(F.count("*").alias("n")).filter("n > 1")


def write_store(tables: dict[str, DataFrame], path: str, version: int) -> bool:
    """Write one version of the primitive store, all its kinds or nothing; False if that version is there already, which then stays.

    Kinds are written to folders of their own, which nobody reads until a manifest names them; the manifest is moved into its place in one
    step that fails where another one stands. So a version that is written twice, at the same time or after a crash, is read
    once and whole. Folders that no manifest names are left by writers that died: see cleaned().
    """
    spark = next(iter(tables.values())).sparkSession
    if version in versions(spark, path):
        return False
    run = uuid.uuid4().hex
    entries = {}
    for kind in KINDS:
        if kind in tables:
            entries[kind] = f"data/{kind}-{version}-{run}"
            tables[kind].write.parquet(f"{path}/{entries[kind]}")
    staged, final = (_path(spark, f"{path}/manifests/{name}") for name in (f"_{run}", f"{version}.json"))
    files = final.getFileSystem(spark._jsc.hadoopConfiguration())
    files.mkdirs(final.getParent())
    out = files.create(staged)
    out.write(json.dumps({"version": version, "kinds": entries}).encode())
    out.close()
    jvm = spark._jvm
    try:
        context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(final.toUri(), spark._jsc.hadoopConfiguration())
        context.rename(staged, final, spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 0))
    except Py4JJavaError:
        if not files.exists(final):
            raise
        files.delete(staged, False)
        for folder in entries.values():
            files.delete(_path(spark, f"{path}/{folder}"), True)
        return False
    return True


def _path(spark: SparkSession, path: str):
    return spark._jvm.org.apache.hadoop.fs.Path(path)


def _manifest(spark: SparkSession, path: str, version: int) -> dict[str, str]:
    return json.loads(spark.read.text(f"{path}/manifests/{version}.json", wholetext=True).first().value)["kinds"]


def versions(spark: SparkSession, path: str) -> list[int]:
    """Versions of a store, in order."""
    at = _path(spark, f"{path}/manifests/*.json")
    found = at.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(at)
    return sorted(int(f.getPath().getName().removesuffix(".json")) for f in found or [])


def read_store(spark: SparkSession, path: str, kind: str, version: int | None = None) -> DataFrame:
    """One kind of primitives of one version, the newest by default, with store_version; no other version's files are touched."""
    if version is None:
        version = max(versions(spark, path))
    return spark.read.parquet(f"{path}/{_manifest(spark, path, version)[kind]}").withColumn("store_version", F.lit(version))


def cleaned(spark: SparkSession, path: str) -> int:
    """Delete folders that no manifest names and manifests that were never moved; their number. Only while nobody writes."""
    named = {f.rpartition("/")[2] for v in versions(spark, path) for f in _manifest(spark, path, v).values()}
    files = _path(spark, path).getFileSystem(spark._jsc.hadoopConfiguration())
    lost = [f.getPath() for f in files.globStatus(_path(spark, f"{path}/data/*")) or [] if f.getPath().getName() not in named]
    lost += [f.getPath() for f in files.globStatus(_path(spark, f"{path}/manifests/_*")) or []]
    for f in lost:
        files.delete(f, True)
    return len(lost)


def primitives(chars: DataFrame, rules: DataFrame, images: DataFrame) -> DataFrame:
    """The union of all kinds: doc_id, page_no, kind, prim_id, box."""
    box = ["doc_id", "page_no", "prim_id", "x0", "top", "x1", "bottom"]
    parts = [df.select(F.lit(kind).alias("kind"), *box) for kind, df in (("char", chars), ("rule", rules), ("image", images))]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


def styled(glyphs: DataFrame) -> DataFrame:
    """Glyphs as a page draws them -> characters with colour and box; fill, space and transform stay.

    A glyph has width and height in its own space, `fill` (array<double>) in the colour `space` gray, rgb or cmyk, and `transform`, the
    six numbers a, b, c, d, e, f of its matrix; y grows upwards from the bottom of a page of `page_height`. `colour` is the
    fill as red, green and blue from 0 to 1, black where it is null; the box is that of the four moved corners, from the top down.
    """
    f, m = F.col("fill"), F.col("transform")
    least = lambda k: (1 - F.least(F.lit(1.0), f[k] + f[3]))
    colour = F.when(F.col("space") == "gray", F.array(f[0], f[0], f[0])).when(F.col("space") == "rgb", f).when(F.col("space") == "cmyk", F.array(least(0), least(1), least(2)))
    xs = [m[0] * x + m[2] * y + m[4] for x in (F.lit(0.0), F.col("width")) for y in (F.lit(0.0), F.col("height"))]
    ys = [m[1] * x + m[3] * y + m[5] for x in (F.lit(0.0), F.col("width")) for y in (F.lit(0.0), F.col("height"))]
    box = {"x0": F.least(*xs), "top": F.col("page_height") - F.greatest(*ys), "x1": F.greatest(*xs), "bottom": F.col("page_height") - F.least(*ys)}
    return glyphs.withColumns({"colour": F.coalesce(colour, F.array(*[F.lit(0.0)] * 3)), **box}).drop("width", "height", "page_height")
