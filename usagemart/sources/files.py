"""Small files and folders through Spark's own file system, wherever the tables live."""

from __future__ import annotations

from pyspark.sql import SparkSession


def _at(spark: SparkSession, path: str):
    jvm = spark._jvm
    where = jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()), where


def exists(spark: SparkSession, path: str) -> bool:
    system, where = _at(spark, path)
    return system.exists(where)


def read_text(spark: SparkSession, path: str) -> str:
    system, where = _at(spark, path)
    stream = system.open(where)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def write_text(spark: SparkSession, path: str, text: str, replace: bool = False) -> bool:
    """Write a small file. Unless ``replace``, only if it is absent; says whether it was written.

    The text is written beside and then moved: a file of this name is always complete, and of several
    writers one moves first. The store must refuse to move onto an existing file, as HDFS does.
    """
    system, where = _at(spark, path)
    jvm = spark._jvm
    options = jvm.org.apache.hadoop.fs.Options.Rename
    beside = jvm.org.apache.hadoop.fs.Path(f"{path}.{jvm.java.util.UUID.randomUUID()}")
    stream = system.create(beside, True)
    stream.write(bytearray(text.encode()))
    stream.close()
    context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(
        where.toUri(), spark._jsparkSession.sessionState().newHadoopConf())
    modes = spark.sparkContext._gateway.new_array(options, 1)
    modes[0] = options.OVERWRITE if replace else options.NONE
    try:
        context.rename(context.makeQualified(beside), context.makeQualified(where), modes)
    except Exception as failure:
        if "FileAlreadyExistsException" not in _kind(failure):
            raise
        system.delete(beside, False)
        return False
    return True


def _kind(failure: Exception) -> str:
    java = getattr(failure, "java_exception", None)
    return java.getClass().getName() if java is not None else str(failure)


def names(spark: SparkSession, path: str) -> list[str]:
    system, where = _at(spark, path)
    return [entry.getPath().getName() for entry in system.listStatus(where)] if system.exists(where) else []


def remove(spark: SparkSession, path: str) -> None:
    system, where = _at(spark, path)
    system.delete(where, True)
