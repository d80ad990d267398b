"""Hadoop file system calls made on the driver: listing, small text files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


class AlreadyThere(Exception):
    """The file to be created exists."""


def _jvm(spark: SparkSession):
    jvm = spark.sparkContext._jvm
    return jvm, spark._jsparkSession.sessionState().newHadoopConf()


def _fs(spark: SparkSession, path: str):
    jvm, conf = _jvm(spark)
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(conf), p


def exists(spark: SparkSession, path: str) -> bool:
    fs, p = _fs(spark, path)
    return bool(fs.exists(p))


def names_in(spark: SparkSession, path: str) -> list[str]:
    """Names directly inside a folder; none when it does not exist."""
    fs, p = _fs(spark, path)
    if not fs.exists(p):
        return []
    return sorted(s.getPath().getName() for s in fs.listStatus(p))


def read_text(spark: SparkSession, path: str) -> str:
    fs, p = _fs(spark, path)
    jvm, _ = _jvm(spark)
    stream = fs.open(p)
    try:
        return jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def create_text(spark: SparkSession, path: str, text: str) -> None:
    """Write a file that does not exist yet, whole or not at all: written
    beside its place, then renamed without overwriting."""
    jvm, conf = _jvm(spark)
    fs, target = _fs(spark, path)
    beside = jvm.org.apache.hadoop.fs.Path(target.getParent(), f".{target.getName()}.part")
    stream = fs.create(beside, True)
    try:
        stream.write(bytearray(text.encode("utf-8")))
    finally:
        stream.close()
    options = jvm.org.apache.hadoop.fs.Options
    none = spark.sparkContext._gateway.new_array(getattr(options, "Rename"), 1)
    none[0] = getattr(options, "Rename").NONE
    try:
        jvm.org.apache.hadoop.fs.FileContext.getFileContext(target.toUri(), conf).rename(
            fs.makeQualified(beside), fs.makeQualified(target), none)
    except Exception as e:  # py4j wraps the Java exception
        if "FileAlreadyExists" in str(e):
            raise AlreadyThere(path) from e
        raise


def delete(spark: SparkSession, path: str) -> None:
    fs, p = _fs(spark, path)
    fs.delete(p, True)


def listed(df: DataFrame) -> DataFrame:
    """(path) of every file a file-based DataFrame lists, empty ones too, which
    no scan yields.  The names go from Spark's file index straight into a
    DataFrame, not through Python."""
    spark = df.sparkSession
    jvm, _ = _jvm(spark)
    names = jvm.scala.jdk.javaapi.CollectionConverters.asJava(
        jvm.scala.collection.immutable.ArraySeq.unsafeWrapArray(df._jdf.inputFiles()))
    rows = spark._jsparkSession.createDataset(names, jvm.org.apache.spark.sql.Encoders.STRING())
    return DataFrame(rows.toDF(), spark).toDF("path")
