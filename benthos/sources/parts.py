"""Reading and unifying report parts whose schemas differ."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ByteType, DataType, DecimalType, DoubleType, FloatType, IntegerType, LongType, ShortType, StringType

_WIDTH = {ByteType(): 0, ShortType(): 1, IntegerType(): 2, LongType(): 3, FloatType(): 4, DoubleType(): 5}


def wider(a: DataType, b: DataType) -> DataType:
    """The type that holds both; text if nothing else does. Whole numbers and fractions meet in DOUBLE."""
    if a == b:
        return a
    if isinstance(a, DecimalType) or isinstance(b, DecimalType):
        return DoubleType()
    if a in _WIDTH and b in _WIDTH:
        mixed = {type(a), type(b)} & {FloatType, DoubleType}
        return DoubleType() if mixed and {type(a), type(b)} != {FloatType} else max(a, b, key=_WIDTH.get)
    return a if b.typeName() == "void" else b if a.typeName() == "void" else StringType()


def unify(parts: list[DataFrame]) -> DataFrame:
    """All rows of all parts under one schema: missing columns are null, numbers widen. No shuffle."""
    schema: dict[str, DataType] = {}
    for p in parts:
        for f in p.schema:
            schema[f.name] = wider(schema[f.name], f.dataType) if f.name in schema else f.dataType
    out = None
    for p in parts:
        x = p.select(*[(F.col(f"`{n}`") if n in p.columns else F.lit(None)).cast(t).alias(n) for n, t in schema.items()])
        out = x if out is None else out.unionAll(x)
    return out


def read_parts(spark: SparkSession, root: str, skip_corrupt: bool = True, glob: str = "*.parquet") -> DataFrame:
    """Every readable report under a folder but those in sightings/ and whatever begins with an underscore; empty and cut-off files are passed over."""
    x = spark.read.option("recursiveFileLookup", "true").option("pathGlobFilter", glob).option("ignoreCorruptFiles", str(skip_corrupt).lower()).parquet(root)
    return x.where(~F.col("_metadata.file_path").contains("/sightings/"))


def not_null(report: DataFrame, columns: list[str]) -> DataFrame:
    """One row: how many rows have each column; only those columns are read."""
    return report.agg(*[F.count(F.col(f"`{c}`") if c in report.columns else F.lit(None)).alias(c) for c in columns])


MAGIC = b"PAR1"


def unreadable(spark: SparkSession, root: str) -> DataFrame:
    """(path, why) of files that don't begin and end as parquet does; empty files are passed over by every reader.

    Eight bytes of each file are read, by range, as the folder is listed.
    """
    sc = spark.sparkContext
    at = sc._jvm.org.apache.hadoop.fs.Path(root)
    fs = at.getFileSystem(sc._jsc.hadoopConfiguration())
    files, found = fs.listFiles(at, True), []
    while files.hasNext():
        f = files.next()
        name, size = f.getPath().toString(), f.getLen()
        if not name.endswith(".parquet") or not size:
            continue
        stream = fs.open(f.getPath())
        try:
            head = bytes(stream.readNBytes(4))
            stream.seek(max(0, size - 4))
            tail = bytes(stream.readNBytes(4))
        finally:
            stream.close()
        if head != MAGIC:
            found.append((name, "not a parquet file"))
        elif tail != MAGIC:
            found.append((name, "cut off: the end is missing"))
    return spark.createDataFrame(found, "path string, why string")
