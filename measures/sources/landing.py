"""Landing-folder scan: many CSV files, one job per file.

Files are matched to columns by header *name*, as the reference's per-file
reader does, while Spark's CSV reader maps an explicit schema by position.
So the scan (1) lists the files, (2) reads each file's first line in a
distributed task, (3) reads all files in one CSV scan by position and (4) picks
each row's columns through the positions of its file's header.  File facts are
DataFrames throughout.

Job identity: the file name is `<job uuid>_<original name>`; for folders
written by Spark (one directory per job, part files inside) the uuid prefix of
the directory name is used.  Files without a uuid get a deterministic one
derived from their path.
"""

from __future__ import annotations

import csv
import io
import re
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.utils import AnalysisException

from measures.functions.ids import uuid_layout
from measures.schema import LOADED_COLUMNS, OPTIONAL_COLUMNS, REQUIRED_COLUMNS
from measures.session import scratch_dir, ship_package
from measures.sources import headers
from measures.sources.files import listed

UUID_PATTERN = r"[0-9a-f]{8}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{12}"
# `<uuid>_<name>` as the last path component, or as the parent directory.
_JOB_IN_TAIL = rf"({UUID_PATTERN})_"
CORRUPT = "_corrupt_record"
PATH = "_landing_path"


def normalise_name(name: str) -> str:
    """Header text -> column name (lower case, stripped, spaces -> `_`)."""
    return name.lower().strip().replace(" ", "_")


def canonical_path(path_col, encoded: bool = False) -> F.Column:
    """One text form for a file path: `file:/x` rather than `file:///x`, and
    percent-escapes decoded when the input is a URI (`_metadata.file_path`)."""
    # A plus sign stands for itself in a path; without a percent sign nothing is escaped.
    p = F.when(F.contains(path_col, F.lit("%")), F.coalesce(F.try_url_decode(F.replace(
        path_col, F.lit("+"), F.lit("%2B"))), path_col)).otherwise(path_col) \
        if encoded else path_col
    return F.when(F.startswith(p, F.lit("file:///")), F.concat(
        F.lit("file:/"), F.substring(p, 9, 1 << 30))).otherwise(p)


def job_id_of(path_col, encoded: bool = False) -> F.Column:
    """Job id of a file: the uuid in its name (or its folder's name), else one
    derived from its canonical path, so listing and rows agree."""
    path = canonical_path(path_col, encoded)
    return _job_id(path, _uuid_in(path))


def _uuid_in(path: F.Column) -> F.Column:
    """The first uuid with `_` after it in the last two components of a path, or ''."""
    return F.regexp_extract(F.substring_index(path, "/", -2), _JOB_IN_TAIL, 1)


def _job_id(path: F.Column, found: F.Column) -> F.Column:
    return F.when(found != "", found).otherwise(uuid_layout(F.md5(path)))


def file_name_of(path_col) -> F.Column:
    """Stored job file name: `<uuid>_<name>` component, else the base name."""
    found = F.regexp_extract(path_col, rf"({UUID_PATTERN}_[^/]*)(/[^/]*)?$", 1)
    return F.when(found != "", found).otherwise(F.regexp_extract(path_col, r"([^/]*)$", 1))


LISTING_SCHEMA = "path string, length bigint, modified timestamp_ntz"


def list_files(spark: SparkSession, root: str | list[str], glob: str = "*.csv") -> DataFrame:
    """File listing as a DataFrame (path, length, modified).  The binaryFile
    source only reads contents when the `content` column is selected.  A
    landing folder that does not exist lists no files."""
    roots = [root] if isinstance(root, str) else list(root)
    try:
        listing = (spark.read.format("binaryFile")
                   .option("recursiveFileLookup", "true").option("pathGlobFilter", glob)
                   .load(roots))
        listing.schema  # noqa: B018  resolve now so a missing path raises here
    except AnalysisException as e:
        if "PATH_NOT_FOUND" not in str(e) and "Path does not exist" not in str(e):
            raise
        return spark.createDataFrame([], LISTING_SCHEMA)
    return listing.select("path", "length",
                          F.col("modificationTime").cast("timestamp_ntz").alias("modified"))


def empty_files(listing: DataFrame, others: DataFrame) -> DataFrame:
    """(path) of the listed files that are not among `others`: zero-length
    ones yield no scan split, but the file index still names them."""
    named = listed(listing).select(canonical_path(F.col("path"), encoded=True).alias("path"))
    return named.join(others.select(canonical_path(F.col("path")).alias("path")), "path",
                      "left_anti")


def read_headers(files: DataFrame) -> DataFrame:
    """(path, modified, header) per listed file; one line read per file, in tasks."""
    ship_package(files.sparkSession)
    return files.select("path", "modified").mapInPandas(
        headers.header_lines, "path string, modified timestamp_ntz, header string")


def literal_path(path: str) -> str:
    """A listed path as the readers take it literally: glob characters escaped."""
    return re.sub(r"([\[\]{}*?\\])", r"\\\1", path)


def parse_header(line: str) -> list[str]:
    return next(csv.reader(io.StringIO(line))) if line else []


COLUMNS = (*LOADED_COLUMNS, *OPTIONAL_COLUMNS)


def positions(header: str | None) -> tuple[int, list[int]]:
    """Fields of a header line, and the place of each of COLUMNS in it (-1
    where it lacks one; the first of a repeated name)."""
    names = [normalise_name(c) for c in parse_header(header or "")]
    return len(names), [names.index(c) if c in names else -1 for c in COLUMNS]


def missing_names(at) -> F.Column:
    """V1: loaded columns whose place is -1 -- the required five in their
    declared order, then unit, site_id, quality_score."""
    order = (*REQUIRED_COLUMNS, *[c for c in LOADED_COLUMNS if c not in REQUIRED_COLUMNS])
    return F.filter(F.array(*[F.when(F.get(at, F.lit(COLUMNS.index(c))) < 0, F.lit(c))
                              for c in order]), lambda c: c.isNotNull())


@dataclass
class LandingScan:
    """Rows of all files (all columns text, names normalised) plus per-file facts."""
    rows: DataFrame
    files: DataFrame  # job_id, filename, path, modified, header, empty, missing


def first_lines(spark: SparkSession, root, glob: str) -> DataFrame:
    """(path, header) through Spark's text source, for storage that the
    task-side reader has no client for.  Only the first split of each file is
    kept, and its earliest line is chosen with a partial aggregate (`min_by`
    over the read order), so no task gathers a file."""
    return (spark.read.option("recursiveFileLookup", "true").option("pathGlobFilter", glob)
            .text(root)
            .select(canonical_path(F.col("_metadata.file_path"), encoded=True).alias("place"),
                    F.col("_metadata.file_block_start").alias("start"),
                    F.regexp_replace("value", "^\uFEFF", "").alias("line"),
                    F.monotonically_increasing_id().alias("pos"))
            .where(F.col("start") == 0)
            .groupBy("place").agg(F.min_by("line", "pos").alias("found")))


def _with_positions(batches):
    for pdf in batches:
        found = [positions(h) for h in pdf["header"]]
        pdf["width"] = [w for w, _ in found]
        pdf["at"] = [a for _, a in found]
        yield pdf


HEADS = "path string, modified timestamp_ntz, header string, width int, at array<int>"
# File facts joined to rows by broadcast up to here (some 20 MB); more by a shuffle.
BROADCAST_FILES = 50_000


def scan(spark: SparkSession, root: str | list[str], glob: str = "*.csv",
         header_reader: str = "auto", multiline: bool = False) -> LandingScan:
    """One CSV scan over all files, whatever their headers: fields are read by
    position (as many as the widest header has), and each row picks its columns
    through the positions of its own file's header, joined by path.

    `header_reader`: "auto" reads first lines in tasks through Arrow file
    systems and falls back to Spark's text source for files it cannot open;
    "jvm" uses the text source for every file.  `multiline` reads quoted
    fields that contain line breaks (as a general CSV reader does) at the
    cost of reading each file in one task; off by default, so large files
    are split across tasks."""
    roots = [root] if isinstance(root, str) else list(root)
    files = list_files(spark, roots, glob)
    if header_reader == "jvm":
        heads = files.select("path", "modified", F.lit(headers.UNREADABLE).alias("header"))
    else:
        heads = read_headers(files)
    # Per-file facts stay in the shared scratch folder: headers are read once.
    heads = written(heads.mapInPandas(_with_positions, HEADS), "heads")
    facts = header_facts(heads)
    if facts["unread"]:
        heads = written(
            heads.withColumn("place", canonical_path(F.col("path")))
            .join(first_lines(spark, roots, glob), "place", "left")
            .select("path", "modified", F.when(F.col("header") == headers.UNREADABLE, F.nullif(
                "found", F.lit(""))).otherwise(F.col("header")).alias("header"))
            .mapInPandas(_with_positions, HEADS), "heads")
        facts = header_facts(heads)
    rows = _rows(spark, roots, glob, heads, facts, multiline)
    every = heads.unionByName(empty_files(files, heads), allowMissingColumns=True)
    info = every.select(job_id_of(F.col("path")).alias("job_id"),
                        file_name_of(F.col("path")).alias("filename"), "path", "modified",
                        "header", F.col("header").isNull().alias("empty"),
                        F.coalesce(missing_names(F.col("at")), F.array().cast("array<string>"))
                        .alias("missing"))
    return LandingScan(rows=rows, files=info)


def header_facts(heads: DataFrame):
    """How many headers there are, how wide, and the least and greatest layout
    (the same when all files share one): what reaches the driver of them."""
    return heads.where("header IS NOT NULL").agg(
        F.max("width").alias("width"), F.max_by("header", F.struct("width", "header")).alias(
            "widest"), F.count("*").alias("n"), F.min("at").alias("least"),
        F.max("at").alias("most"), F.min("width").alias("narrowest"),
        F.max(F.col("header") == headers.UNREADABLE).alias("unread")).head()


def written(df: DataFrame, label: str) -> DataFrame:
    path = scratch_dir(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _rows(spark: SparkSession, roots: list[str], glob: str, heads: DataFrame, facts,
          multiline: bool) -> DataFrame:
    flags = [T.StructField("_has_id", T.BooleanType()), T.StructField("_too_long", T.BooleanType()),
             T.StructField("path", T.StringType()), T.StructField("job_id", T.StringType())]
    if not facts["n"]:
        return spark.createDataFrame([], T.StructType(
            [T.StructField(c, T.StringType()) for c in COLUMNS] + flags))
    width = facts["width"]
    # The widest header's own names, so that Spark's header check agrees with
    # most files, or positional ones where that header repeats a name.
    cells = parse_header(facts["widest"])
    if len({c.lower() for c in cells}) < width or not all(cells) or any(
            c.startswith("_") or "`" in c for c in cells):
        cells = [f"c{i}" for i in range(width)]
    schema = T.StructType([T.StructField(c, T.StringType()) for c in (*cells, CORRUPT)])
    raw = (spark.read.schema(schema)
           .option("recursiveFileLookup", "true").option("pathGlobFilter", glob)
           .option("header", True).option("enforceSchema", True)
           .option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", CORRUPT)
           .option("escape", '"').option("encoding", "UTF-8").option("multiLine", multiline)
           .option("maxColumns", max(20480, width + 1))
           .csv(roots).select(*[F.col(f"`{c}`") for c in schema.names],
                              F.col("_metadata.file_path").alias(PATH)))
    if facts["least"] == facts["most"] and facts["narrowest"] == width:
        # One layout: no join, and only the named cells are kept.
        pick = lambda i: F.col(f"`{cells[facts['least'][i]]}`") if facts["least"][i] >= 0 \
            else F.lit(None).cast("string")
        rows, own = raw, F.lit(width)
        has_id = F.lit(facts["least"][COLUMNS.index("id")] >= 0)
    else:
        by_path = heads.select(canonical_path(F.col("path")).alias("_place"),
                               F.col("width").alias("_own"), F.col("at").alias("_at"))
        raw = raw.withColumn("_place", canonical_path(F.col(PATH), encoded=True))
        small = facts["n"] <= BROADCAST_FILES
        rows = raw.join(F.broadcast(by_path) if small else by_path, "_place", "left")
        row = F.array(*[F.col(f"`{c}`") for c in cells])
        pick = lambda i: F.get(row, F.get("_at", F.lit(i)))
        own = F.col("_own")
        has_id = F.coalesce(F.get("_at", F.lit(COLUMNS.index("id"))) >= 0, F.lit(False))
    # A row longer than its header fails the file; shorter rows are padded.
    fields = F.when(F.col(CORRUPT).isNull(), F.lit(width)).otherwise(_field_count(F.col(CORRUPT)))
    # `job_id_of` in steps, so that each is taken once a row.
    picked = rows.select(
        *[pick(i).alias(c) for i, c in enumerate(COLUMNS)], has_id.alias("_has_id"),
        F.coalesce(fields > own, F.lit(False)).alias("_too_long"), F.col(PATH).alias("path"),
        canonical_path(F.col(PATH), encoded=True).alias("_canonical"))
    found = picked.withColumn("_uuid", _uuid_in(F.col("_canonical")))
    return found.select(*[c for c in picked.columns if c != "_canonical"],
                        _job_id(F.col("_canonical"), F.col("_uuid")).alias("job_id"))


def _field_count(line: F.Column) -> F.Column:
    """Fields in a CSV line: commas outside quoted sections, plus one."""
    unquoted = F.regexp_replace(line, r'"[^"]*+"', "")  # possessive: no recursion per character
    return F.length(unquoted) - F.length(F.regexp_replace(unquoted, ",", "")) + 1

