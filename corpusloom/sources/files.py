"""File sources: labelled CSV and TSV collections into ``text, label, source``.

Headers and encodings differ between the files of one collection.  All of them are read
in one scan without a header: what each file's first record says about its columns is
joined back by file, so neither the number of plans nor the driver grows with the files.
"""

from __future__ import annotations

import pathlib
import posixpath
from collections.abc import Sequence

from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.corpus import combine, drop_blank, fold_label, normalise_header, normalise_labels
from ..operators.sampling import sample_exact
from ..schemas import CORPUS, STATEMENTS
from ..session import settle

# --- fixed values: collection folders, files, and their text columns ------------
HEALTH = ("covid19-fakenews", {"content", "title", "abstract", "newstitle"})
OUTLETS = ("fakenewsnet", ["BuzzFeed", "PolitiFact"], {"text", "title", "content", "headline"})
NEWS = ("isotfakenews", {"Fake.csv": "fake", "True.csv": "real"}, {"text", "title", "subject"})
STATEMENT_FILES = ("liar-dataset", ["train.tsv", "valid.tsv", "test.tsv"])
GENERATED = ("generated_fakenews", "fake_news_dataset.csv")

def label_from_file_name(name: Column) -> Column:
    """``fake`` is tested before ``real``; other names give null."""
    lower = F.lower(name)
    return F.when(lower.contains("fake"), "fake").when(lower.contains("real"), "real")


def _path(spark: SparkSession, path: str):
    return spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)


def exists(spark: SparkSession, path: str) -> bool:
    """True if the file or folder exists, on any Hadoop file system."""
    p = _path(spark, path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(p)


def create_once(spark: SparkSession, path: str, content: str) -> bool:
    """Writes a new file; False, and nothing written, if there is one already.

    Of writers that meet, one creates the file: Hadoop file systems decide it where they
    create without overwriting, the local one by its exclusive mode.
    """
    p = _path(spark, path)
    fs = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if fs.getScheme() == "file":
        local = pathlib.Path(p.toUri().getPath())
        local.parent.mkdir(parents=True, exist_ok=True)
        try:
            with open(local, "x", encoding="utf-8") as out:
                out.write(content)
        except FileExistsError:
            return False
        return True
    try:
        out = fs.create(p, False)
    except Py4JJavaError:
        if fs.exists(p):
            return False
        raise
    out.write(bytearray(content.encode()))
    out.close()
    return True


def list_files(spark: SparkSession, folder: str, pattern: str) -> list[str]:
    """Sorted paths below ``folder`` whose file name matches a glob."""
    if not exists(spark, folder):
        return []
    found = (spark.read.format("binaryFile").option("recursiveFileLookup", "true")
             .option("pathGlobFilter", pattern).load(folder).select("path"))
    return sorted(r.path for r in found.collect())  # names only, one per file


def resolve(spark: SparkSession, root: str, name: str) -> str:
    inner = posixpath.join(root, "datasets", name)
    return inner if exists(spark, inner) else posixpath.join(root, name)


def read_csv(spark: SparkSession, path: str, encoding: str | None = None) -> DataFrame:
    """All columns as strings; UTF-8, or Latin-1 if the file is not valid UTF-8."""
    def load(charset: str) -> DataFrame:
        return (spark.read.option("header", True).option("multiLine", True).option("escape", '"')
                .option("encoding", charset).csv(path))

    if encoding:
        return load(encoding)
    text = spark.read.text(path)
    broken = not text.filter(~F.is_valid_utf8("value")).isEmpty()
    return load("ISO-8859-1" if broken else "UTF-8")


def read_statements(spark: SparkSession, path: str) -> DataFrame:
    """Headerless 14-column TSV; quotes are ordinary characters."""
    return spark.read.schema(STATEMENTS).option("sep", "\t").option("quote", "").csv(path)


def write_csv(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("header", True).option("escape", '"').csv(path)


def manifest(spark: SparkSession, paths: str | list[str], glob: str = "*") -> DataFrame:
    """``path, valid, whole, width``, one row a file below ``paths`` whose name matches ``glob``.

    ``valid``: it is UTF-8.  ``whole``: no line has an open quote, so the file can be split
    at any line.  ``width``: columns at most.  One job over the lines of all files.
    """
    lines = spark.read.option("recursiveFileLookup", "true").option("pathGlobFilter", glob).text(paths)
    quotes = F.octet_length("value") - F.octet_length(F.replace("value", F.lit('"'), F.lit("")))
    commas = F.octet_length("value") - F.octet_length(F.replace("value", F.lit(","), F.lit("")))
    return lines.select(F.col("_metadata.file_path").alias("path"), "value").groupBy("path").agg(
        F.bool_and(F.is_valid_utf8("value")).alias("valid"), F.bool_and(quotes % 2 == 0).alias("whole"), F.max(commas + 1).alias("width"))


def read_tables(spark: SparkSession, paths: str | list[str], columns: set[str], glob: str = "*") -> DataFrame:
    """``file, names, text`` of every record of the CSV files below ``paths``.

    ``text`` joins the file's columns named in ``columns``, in file order, without nulls;
    ``names`` are all its column names, trimmed and lowered.  UTF-8, or Latin-1 where a
    file is not valid UTF-8.  Files whose quotes close within their lines are split like
    any text; others are read by one task each, record by record.  Only a count and the
    largest width reach the driver.
    """
    known = settle(manifest(spark, paths, glob))
    size = known.agg(F.max("width").alias("width"), F.bool_or("whole").alias("split"), F.bool_or(~F.col("whole")).alias("unsplit")).first()
    if size.width is None:
        return spark.createDataFrame([], "file string, names array<string>, text string")
    names = [f"c{i}" for i in range(size.width)]

    def scan(lines: bool) -> DataFrame:
        # bytes as characters: what they mean is known by file
        rows = (spark.read.schema(", ".join(f"{c} string" for c in names)).option("recursiveFileLookup", "true").option("pathGlobFilter", glob)
                .option("multiLine", not lines).option("escape", '"').option("encoding", "ISO-8859-1").csv(paths))
        at = F.struct(F.col("_metadata.file_block_start"), F.monotonically_increasing_id())
        file = F.url_decode(F.replace(F.col("_metadata.file_name"), F.lit("+"), F.lit("%2B")))  # as in a URI, where + is a plus
        rows = rows.select(F.col("_metadata.file_path").alias("path"), file.alias("file"), at.alias("at"), F.array(*names).alias("cells"))
        return rows.join(known.filter(F.col("whole") == lines).select("path", "valid"), "path")

    rows = combine([scan(lines) for lines, some in ((True, size.split), (False, size.unsplit)) if some])
    decoded = F.when(F.col("valid"), F.transform("cells", lambda c: F.decode(F.encode(c, "ISO-8859-1"), "UTF-8"))).otherwise(F.col("cells"))
    rows = rows.select("path", "file", "at", decoded.alias("cells"))
    heads = rows.groupBy("path").agg(F.min_by("cells", "at").alias("head"), F.min("at").alias("first"))
    heads = heads.select("path", "first", F.transform("head", lambda c: F.lower(F.trim(c))).alias("names"))
    cells = F.transform(F.arrays_zip("names", "cells"), lambda z: F.when(z["names"].isin(*sorted(columns)), z["cells"]))
    return rows.join(heads, "path").filter(F.col("at") != F.col("first")).select("file", F.array_compact("names").alias("names"), F.array_join(cells, " ").alias("text"))


def _empty(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([], CORPUS)


def _sampled(df: DataFrame, n: int | None) -> DataFrame:
    """Fixed-size sample by a hash of the row itself (rows carry no id here)."""
    if n is None:
        return df
    keyed = df.withColumn("_id", F.concat_ws("\u0001", "source", "label", "text"))
    return sample_exact(keyed, n, key="_id").drop("_id")


def load_health(spark: SparkSession, root: str, sample: int | None = None) -> DataFrame:
    folder, columns = HEALTH
    base = resolve(spark, root, folder)
    if not exists(spark, base):
        return _empty(spark)
    rows = read_tables(spark, base, columns, "*COVID-19*.csv").select("text", label_from_file_name(F.col("file")).alias("label"), F.col("file").alias("source"))
    return _sampled(drop_blank(rows.filter(F.col("label").isNotNull()), "text"), sample)


def _named(spark: SparkSession, found: dict[str, tuple[str, str]], columns: set[str], sample: int | None) -> DataFrame:
    """Texts of a few files by path, each with the label and source of its name."""
    paths = [p for p in found if exists(spark, p)]
    if not paths:
        return _empty(spark)
    tags = F.create_map(*[F.lit(x) for p in paths for x in (posixpath.basename(p), "\u0001".join(found[p]))])
    tag = F.split(tags[F.col("file")], "\u0001")
    rows = read_tables(spark, paths, columns).select("text", tag[0].alias("label"), tag[1].alias("source"))
    return _sampled(drop_blank(rows, "text"), sample)


def load_outlets(spark: SparkSession, root: str, sample: int | None = None) -> DataFrame:
    folder, outlets, columns = OUTLETS
    base = resolve(spark, root, folder)
    return _named(spark, {posixpath.join(base, f"{o}_{label}_news_content.csv"): (label, f"fakenewsnet-{o}")
                          for o in outlets for label in ("fake", "real")}, columns, sample)


def load_news(spark: SparkSession, root: str, sample: int | None = None) -> DataFrame:
    folder, names, columns = NEWS
    base = resolve(spark, root, folder)
    return _named(spark, {posixpath.join(base, f): (label, folder) for f, label in names.items()}, columns, sample)


def load_statements(spark: SparkSession, root: str, sample: int | None = None) -> DataFrame:
    folder, files = STATEMENT_FILES
    base = resolve(spark, root, folder)
    paths = [p for p in (posixpath.join(base, f) for f in files) if exists(spark, p)]
    if not paths:
        return _empty(spark)
    raw = combine([read_statements(spark, p) for p in paths])
    rows = raw.select(F.trim("statement").alias("text"), fold_label(F.col("label")).alias("label"),
                      F.lit(folder).alias("source")).filter(F.col("label").isNotNull())
    return _sampled(drop_blank(rows, "text"), sample)


def load_generated(spark: SparkSession, root: str, sample: int | None = None) -> DataFrame:
    folder, name = GENERATED
    path = posixpath.join(resolve(spark, root, folder), name)
    if not exists(spark, path):
        return _empty(spark)
    df = normalise_header(read_csv(spark, path))
    if not {"text", "label"} <= set(df.columns):
        return _empty(spark)
    rows = normalise_labels(df.select(F.trim("text").alias("text"), "label", F.lit(folder).alias("source")))
    return _sampled(drop_blank(rows, "text"), sample)


def load_all(spark: SparkSession, root: str, sample: int | None = None,
             include_generated: bool = False) -> DataFrame:
    """Every collection found below ``root``; an empty table when there is none."""
    loaders = [load_health, load_outlets, load_news, load_statements]
    if include_generated:
        loaders.append(load_generated)
    return _sampled(combine([load(spark, root) for load in loaders]), sample)


def with_ids(df: DataFrame) -> DataFrame:
    """Adds a stable ``doc_id`` from the row's content.

    Equal rows get equal ids; drop duplicates first where that matters.
    """
    return df.withColumn("doc_id", F.xxhash64("source", "label", "text"))
