"""One ordered file from many tasks, on any file system that Spark can write to.

Tasks sort and write their ranges of the rows as parts (Spark's own commit makes repeated attempts harmless). The parts are
then composed in order behind the head: by the file system alone where it can join files, otherwise as a stream of bytes
through a buffer of bounded size. The result appears under its name only when it is whole: its length must be the sum of
the lengths of its parts.
"""

import uuid

from pyspark.sql import DataFrame, SparkSession

BUFFER = 1 << 20


def _at(spark: SparkSession, path: str):
    """Hadoop path and its file system."""
    made = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return made, made.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def compose(spark: SparkSession, head: bytes, parts: list[str], target: str, skip: int = 0) -> int:
    """Write head and the parts, the first from byte `skip` on, as one file; its length is returned."""
    java = spark.sparkContext._jvm
    goal, system = _at(spark, target)
    staged, _ = _at(spark, f"{target}.{uuid.uuid4().hex}")
    wanted = len(head) + sum(system.getFileStatus(_at(spark, p)[0]).getLen() for p in parts) - skip
    out = system.create(staged)
    try:
        out.write(head)
        for k, part in enumerate(parts):
            source = system.open(_at(spark, part)[0])
            try:
                source.seek(skip if k == 0 else 0)
                java.org.apache.hadoop.io.IOUtils.copyBytes(source, out, BUFFER, False)
            finally:
                source.close()
    finally:
        out.close()
    if system.getFileStatus(staged).getLen() != wanted:
        system.delete(staged, False)
        raise OSError(f"{target} would not be whole")
    if system.exists(goal):
        # a folder of an earlier layout, or a file that a rename does not replace
        system.delete(goal, True)
    if not system.rename(staged, goal):
        raise OSError(f"cannot write {target}")
    return wanted


def write_single(rows: DataFrame, order: list[str], head: str, target: str, form: str = "text", **options: str) -> int:
    """rows as one file at target in the order of `order`, behind head; columns of order that rows keep are written too."""
    spark = rows.sparkSession
    target = target.rstrip("/")
    folder = f"{target}.parts-{uuid.uuid4().hex}"
    ranged = rows.repartitionByRange(*order).sortWithinPartitions(*order)
    ranged = ranged.select("value") if form == "text" else ranged
    ranged.write.options(**options).format(form).save(folder)
    path, system = _at(spark, folder)
    try:
        names = sorted(s.getPath().toString() for s in system.listStatus(path) if s.getPath().getName().startswith("part-"))
        return compose(spark, head.encode(), names, target)
    finally:
        system.delete(path, True)


def read_head(spark: SparkSession, target: str, end: bytes) -> bytes | None:
    """The bytes of a file up to and with the first `end`; None where there is no such file. Only the head is read."""
    path, system = _at(spark, target)
    if not system.exists(path) or system.getFileStatus(path).isDirectory():
        return None
    length, size = system.getFileStatus(path).getLen(), BUFFER >> 4
    while True:
        source = system.open(path)
        try:
            text = bytes(spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toByteArray(source, min(size, length)))
        finally:
            source.close()
        if end in text:
            return text[: text.index(end) + len(end)]
        if size >= length:
            raise ValueError(f"{target} has no head that ends in {end!r}")
        size *= 16


def replace_head(spark: SparkSession, target: str, old: bytes, new: bytes) -> int:
    """The same file with another head; everything behind it is copied as it is."""
    return compose(spark, new, [target], target, skip=len(old))
