"""Zip archives, many at a time, with one task per member.

Spark lists the archives and spreads their members; a task opens only the member
it owns and streams it, so memory use does not depend on archive or member size.
Reading whole archives as binary rows would need each in memory several times and
end at 2 GB. A member is a compressed stream and cannot be split further.

The worker functions are nested and import what they need, so executors run them
without this package installed. Paths are opened through ``pyarrow.fs``, which
must know their scheme (local, hdfs, s3, gs).
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..errors import ContractError
from ..session import scratch_dir

_MEMBERS = "archive string, member string, bytes bigint, safe boolean"
_LINES = "archive string, member string, line_no bigint, line string"
_MANIFEST = "archive string, member string, target string, bytes bigint"
#: A member weighs at least this much, for opening it costs something too.
OPEN_BYTES = 4096
#: What became of a member, as the manifest says.
WRITTEN, UNSAFE = "written", "unsafe"


def archive_members(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """One row per member, from the directory at the end of each archive.

    ``safe`` is false for absolute names and names that climb out with ``..``:
    those are listed but never read or written.
    """
    archives = spark.read.format("binaryFile").load(path).select("path")
    return archives.mapInArrow(_list_members(), _MEMBERS)


def archive_lines(spark: SparkSession, path: str | list[str], encoding: str = "utf-8",
                  parallelism: int | None = None, errors: str = "strict") -> DataFrame:
    """All lines of all safe members: ``archive``, ``member``, ``line_no``, ``line``.

    A byte that the encoding does not know fails the read; with ``errors="replace"`` it
    becomes U+FFFD. ``archive_members`` tells which members are not safe. Their list is
    stored first, so every archive is opened once for it.
    """
    listed = scratch_dir(spark, "members")
    archive_members(spark, path).write.parquet(listed)
    members = spark.read.parquet(listed).where("safe")
    return dealt(members, parallelism).select("archive", "member").mapInArrow(
        _read_lines(encoding, errors), _LINES)


def extract_archives(spark: SparkSession, path: str | list[str], out_dir: str,
                     folder_per_archive: bool = False,
                     parallelism: int | None = None) -> DataFrame:
    """Write every safe member under ``out_dir`` and return the list of files.

    Without a scheme ``out_dir`` is on the default filesystem of the cluster, as Spark's own paths
    are; where that is the local one, it must be a folder that all executors mount.
    With ``folder_per_archive`` each archive gets a folder of its own name, which
    many archives with equal member names need; two members for one target are an
    error before anything is written. A member appears under its name only once
    it is complete, so a task that runs again replaces it whole.

    The stored manifest (``read_manifest``) also lists the members left out as unsafe, by
    ``status``.
    """
    out_dir = placed(spark, out_dir)
    name = F.concat(F.regexp_extract("archive", r"([^/]+?)(\.[^./]*)?$", 1), F.lit("/"))
    target = F.concat(F.lit(out_dir.rstrip("/") + "/"),
                      name if folder_per_archive else F.lit(""), F.col("member"))
    # The list is stored, so every archive is opened once for it.
    listed = f"{out_dir.rstrip('/')}/_members"
    (archive_members(spark, path).withColumn("target", target)
     .write.mode("overwrite").parquet(listed))
    found = spark.read.parquet(listed)
    members = found.where("safe")
    clash = members.groupBy("target").count().where("count > 1").take(3)
    if clash:
        raise ContractError("several members for " + ", ".join(r["target"] for r in clash))
    done = (dealt(members, parallelism).select("archive", "member", "target")
            .mapInArrow(_write_members(), _MANIFEST).withColumn("status", F.lit(WRITTEN)))
    left = found.where("not safe").select(
        "archive", "member", F.lit(None).cast("string").alias("target"), "bytes",
        F.lit(UNSAFE).alias("status"))
    done.unionByName(left).write.mode("overwrite").parquet(_manifest(out_dir))
    return read_manifest(spark, out_dir).where(F.col("status") == WRITTEN).drop("status")


def placed(spark: SparkSession, path: str) -> str:
    """The path with the scheme of the default filesystem, unless it has one or that is the local one.

    Executors open it without Spark's settings, so they cannot tell.
    """
    default = spark.sparkContext._jsc.hadoopConfiguration().get("fs.defaultFS") or "file:///"
    if re.match(r"[A-Za-z][A-Za-z0-9+.-]*:", path) or default.startswith("file:"):
        return path
    if not path.startswith("/"):
        raise ContractError(f"{path}: give the whole path, it is on {default}")
    return default.rstrip("/") + path


def _manifest(out_dir: str) -> str:
    return f"{out_dir.rstrip('/')}/_manifest"


def read_manifest(spark: SparkSession, out_dir: str) -> DataFrame:
    """One row per member that ``extract_archives`` found: ``archive``, ``member``, ``target``,
    ``bytes``, ``status``; an unsafe member has no target."""
    return spark.read.parquet(_manifest(out_dir))


def dealt(members: DataFrame, parallelism: int | None = None) -> DataFrame:
    """The members dealt to tasks by bytes: no task holds more than twice the mean, or it holds one member.

    A member of at least the mean share has a task of its own; there are at most as many as tasks. The
    others are cut into ranges of equal weight by running sums in two levels, inside hash buckets and
    over the sums of the buckets, one for each task: no window spans all members. ``members`` is read
    several times, so it should be stored.
    """
    n = parallelism or int(members.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    weighed = members.withColumn("__w", F.greatest("bytes", F.lit(OPEN_BYTES)))
    total = weighed.agg(F.sum("__w")).first()[0] or 0
    is_large = F.col("__w") * n >= total
    n_large, rest = weighed.agg(F.count_if(is_large),
                                F.coalesce(F.sum(F.when(~is_large, F.col("__w"))), F.lit(0))).first()
    bins = max(1, n - n_large)
    numbered = Window.orderBy(F.col("__w").desc(), "archive", "member")
    large = weighed.where(is_large).withColumn("__task", F.row_number().over(numbered) - 1)
    small = weighed.where(~is_large).withColumn(
        "__bucket", F.pmod(F.xxhash64("archive", "member"), F.lit(n)))
    over = Window.orderBy("__bucket").rowsBetween(Window.unboundedPreceding, -1)
    before = small.groupBy("__bucket").agg(F.sum("__w").alias("__sum")).select(
        "__bucket", F.coalesce(F.sum("__sum").over(over), F.lit(0)).alias("__before"))
    inside = (Window.partitionBy("__bucket").orderBy("archive", "member")
              .rowsBetween(Window.unboundedPreceding, -1))
    reached = F.col("__before") + F.coalesce(F.sum("__w").over(inside), F.lit(0))
    # In doubles: bytes times tasks may not fit 64 bits. The last bin takes what rounding leaves.
    place = F.least(F.floor(reached.cast("double") * bins / max(1, rest)), F.lit(bins - 1))
    packed = small.join(before, "__bucket").withColumn("__task", F.lit(min(n_large, n - 1)) + place)
    columns = [*members.columns, F.col("__task").cast("int").alias("__task")]
    return (large.select(*columns).unionByName(packed.select(*columns))
            .repartitionById(n, "__task").drop("__task"))


def _zip_opener() -> Callable:
    """A worker function that opens an archive anywhere and closes it after use."""
    import contextlib

    @contextlib.contextmanager
    def open_zip(path):
        import io
        import zipfile

        from pyarrow import fs

        class Source(io.RawIOBase):
            """An Arrow file whose failed seek is an OSError, as ``zipfile`` expects."""

            def __init__(self, file):
                self.file, self.size = file, file.size()

            def readable(self):
                return True

            def seekable(self):
                return True

            def seek(self, offset, whence=0):
                position = offset + (0, self.file.tell(), self.size)[whence]
                if position < 0:
                    raise OSError("seek before the start")
                self.file.seek(position)
                return position

            def readinto(self, buffer):
                return self.file.readinto(buffer)

        system, inner = fs.FileSystem.from_uri(path.replace("s3a://", "s3://", 1))
        with (system.open_input_file(inner) as file,
              zipfile.ZipFile(io.BufferedReader(Source(file), 1 << 20)) as archive):
            yield archive
    return open_zip


def _list_members() -> Callable[[Iterator], Iterator]:
    open_zip = _zip_opener()

    def run(batches):
        import pyarrow as pa

        def is_safe(name):
            parts = name.replace("\\", "/").split("/")
            return bool(parts[0]) and ":" not in parts[0] and ".." not in parts

        for batch in batches:
            for path in batch.column(0).to_pylist():
                with open_zip(path) as archive:
                    found = [i for i in archive.infolist() if not i.is_dir()]
                yield pa.RecordBatch.from_pydict({
                    "archive": pa.array([path] * len(found), pa.string()),
                    "member": pa.array([i.filename for i in found], pa.string()),
                    "bytes": pa.array([i.file_size for i in found], pa.int64()),
                    "safe": pa.array([is_safe(i.filename) for i in found], pa.bool_()),
                })
    return run


def _read_lines(encoding: str, errors: str) -> Callable[[Iterator], Iterator]:
    open_zip = _zip_opener()

    def run(batches):
        import io

        import pyarrow as pa

        def emit(path, member, first, lines):
            n = len(lines)
            return pa.RecordBatch.from_pydict({
                "archive": pa.array([path] * n, pa.string()),
                "member": pa.array([member] * n, pa.string()),
                "line_no": pa.array(range(first, first + n), pa.int64()),
                "line": pa.array(lines, pa.string()),
            })

        for batch in batches:
            for path, member in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(),
                                    strict=True):
                with open_zip(path) as archive, archive.open(member) as stream:
                    first, held, lines = 1, 0, []
                    for line in io.TextIOWrapper(stream, encoding=encoding, errors=errors):
                        lines.append(line.removesuffix("\n"))
                        held += len(line)
                        if held >= 1 << 20:
                            yield emit(path, member, first, lines)
                            first, held, lines = first + len(lines), 0, []
                    if lines:
                        yield emit(path, member, first, lines)
    return run


def _write_members() -> Callable[[Iterator], Iterator]:
    open_zip = _zip_opener()

    def run(batches):
        import shutil
        import uuid

        import pyarrow as pa
        from pyarrow import fs

        for batch in batches:
            for path, member, target in zip(*[c.to_pylist() for c in batch.columns], strict=True):
                if ":" in target.split("/", 1)[0]:
                    to_system, to = fs.FileSystem.from_uri(
                        target.replace("s3a://", "s3://", 1))
                else:
                    to_system, to = fs.LocalFileSystem(), target
                folder, _, name = to.rpartition("/")
                to_system.create_dir(folder, recursive=True)
                partial = f"{folder}/.{name}.{uuid.uuid4().hex}"
                with (open_zip(path) as archive, archive.open(member) as stream,
                      to_system.open_output_stream(partial) as out):
                    shutil.copyfileobj(stream, out, 1 << 20)
                    size = archive.getinfo(member).file_size
                to_system.move(partial, to)
                yield pa.RecordBatch.from_pydict({
                    "archive": pa.array([path], pa.string()),
                    "member": pa.array([member], pa.string()),
                    "target": pa.array([target], pa.string()),
                    "bytes": pa.array([size], pa.int64()),
                })
    return run
