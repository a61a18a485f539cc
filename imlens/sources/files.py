"""File scans: raw bytes and their digests (S1), decoded images (S2), stored results (S3, S4) and items.

Listing and glob filtering happen in Spark's file sources, decoding in its image source or, for plain bitmaps, in tasks. Object stores are plain
paths (``s3a://bucket/prefix``); credentials belong in the Hadoop configuration, not in code.
"""

from __future__ import annotations

import hashlib
import re
import struct
from urllib.parse import unquote

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from imlens.functions.paths import decode_path, label_from_parent, label_from_set, set_name
from imlens.session import session_conf, ship_package

IMAGE = "image struct<origin:string,height:int,width:int,nChannels:int,mode:int,data:binary>"
OPEN_COST = 256 * 1024  # small files of a task that only looks at them
FEW_FILES = 1_000  # files that are read by name
WHOLE_BYTES = 32 << 20  # of a file that is read in one piece, at most
PIECE_BYTES = 256 << 10  # of the pieces of larger files, about
LINE_END = b"\n"  # larger files of a store that only Spark opens are read in lines
BYTE_ORDER_MARK = b"\xef\xbb\xbf"  # Spark's text source leaves it out at the start of a file
PACKED = r"\.(gz|gzip|bz2|deflate|snappy|lz4|lzo|zst|zstd|passthrough)$"  # names whose files that source would unpack


def scan_binary(
    spark: SparkSession,
    path: str,
    glob: str | None = None,
    recursive: bool = True,
    modified_after: str | None = None,
) -> DataFrame:
    """(path, modificationTime, length, content), one row per file.

    ``content`` is read only when selected: a projection of path and length reads no bytes, and
    filters on length / modificationTime are pushed into the listing.
    """
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", str(recursive).lower())
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    if modified_after:
        reader = reader.option("modifiedAfter", modified_after)
    return reader.load(path)


def scan_digests(spark: SparkSession, path: str, glob: str | None = None, recursive: bool = True) -> DataFrame:
    """(path, length, md5), one row per file (S1): the MD5 of its bytes, without holding a large file in memory.

    Files of the scheme ``file`` are read by the tasks themselves, a piece at a time. In other stores, which only Spark
    opens, files of more than ``WHOLE_BYTES`` are read by Spark's text source, whose lines are exchanged in pieces (the
    longest line must fit a task); smaller ones, and those that this source would unpack, by the binary source.
    """
    files = scan_binary(spark, path, glob, recursive)
    ship_package(spark)
    of_path = spark._jvm.org.apache.hadoop.fs.Path(path).getFileSystem(spark._jsc.hadoopConfiguration())
    if of_path.getUri().getScheme() == "file":
        return files.select("path", "length").mapInArrow(_local_digests, "path string, length long, md5 string")
    columns = ["path", "length", F.md5("content").alias("md5")]
    out = files.filter(F.col("length") <= WHOLE_BYTES).select(*columns)
    large = files.filter(F.col("length") > WHOLE_BYTES).select("path", F.col("path").rlike(PACKED).alias("packed")).collect()  # from the listing
    if packed := [re.sub(r"([*?\[\]{}\\])", r"\\\1", r["path"]) for r in large if r["packed"]]:
        out = out.unionByName(scan_binary(spark, packed).select(*columns))
    if len(packed) == len(large):
        return out
    reader = spark.read.format("text").option("lineSep", LINE_END.decode()).option("recursiveFileLookup", str(recursive).lower())
    lines = (reader.option("pathGlobFilter", glob) if glob else reader).load(path)
    lines = lines.select("_metadata.file_path", "_metadata.file_size", "_metadata.file_block_start", F.col("value").cast("binary"))
    lines = lines.filter(F.col("file_size") > WHOLE_BYTES).filter(~F.col("file_path").rlike(PACKED))
    pieces = lines.mapInArrow(_pieces, "path string, length long, start long, at long, bytes binary")
    pieces = pieces.repartition("path").sortWithinPartitions("path", "start", "at")
    return out.unionByName(pieces.mapInArrow(_joined_digests, "path string, length long, md5 string"))


def _local(path: str) -> str:
    """Python's name of a file of the scheme ``file``; Spark's listing does not encode it."""
    path = path.removeprefix("file:")
    return "/" + path[2:].partition("/")[2] if path.startswith("//") else path


def _local_digests(batches):
    """(path, length, md5) of (path, length)."""
    for batch in batches:
        md5 = []
        for path in batch.column(0).to_pylist():
            with open(_local(path), "rb", buffering=0) as file:
                md5.append(hashlib.file_digest(file, "md5").hexdigest())
        yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(md5, pa.string())], ["path", "length", "md5"])


def _pieces(batches):
    """(path, length, start, at, bytes) of the lines (path, length, start, line) of splits: some lines together, in the order ``at`` of their split."""
    now, at, held, size = None, 0, [], 0

    def out():
        columns = [pa.array([now[0]]), *(pa.array([v], pa.int64()) for v in (now[1], now[2], at)), pa.array([LINE_END.join(held)], pa.binary())]
        return pa.RecordBatch.from_arrays(columns, ["path", "length", "start", "at", "bytes"])

    for batch in batches:
        for *split, line in zip(*(c.to_pylist() for c in batch.columns)):
            if held and (split != now or size >= PIECE_BYTES):
                yield out()
                at, held, size = at + 1 if split == now else 0, [], 0
            now = split
            held.append(line)
            size += len(line) + 1
    if held:
        yield out()


def _joined_digests(batches):
    """(path, length, md5) of sorted pieces of encoded paths. The length tells whether a byte order mark was left out and whether the last line has an end."""
    now, n, hashes = None, 0, []

    def out():
        left = now[1] - n
        if left not in (0, 1, 3, 4):
            raise ValueError(f"{now[0]} was read as {n} bytes of {now[1]}")
        md5 = hashes[left >= len(BYTE_ORDER_MARK)]
        if left % len(BYTE_ORDER_MARK):
            md5.update(LINE_END)
        return pa.RecordBatch.from_arrays([pa.array([unquote(now[0])]), pa.array([now[1]], pa.int64()), pa.array([md5.hexdigest()])], ["path", "length", "md5"])

    for batch in batches:
        for path, length, _, _, piece in zip(*(c.to_pylist() for c in batch.columns)):
            if now == (path, length):
                piece = LINE_END + piece
            else:
                if now:
                    yield out()
                now, n, hashes = (path, length), 0, [hashlib.md5(), hashlib.md5(BYTE_ORDER_MARK)]
            n += len(piece)
            for md5 in hashes:
                md5.update(piece)
    if now:
        yield out()


def plain_bitmap(content: bytes) -> tuple[int, int, bytes] | None:
    """(height, width, BGR bytes from the top row down) of a whole bitmap of three bytes a pixel without a colour table, else None."""
    if content is None or len(content) < 54:
        return None
    magic, _, _, _, start, header, width, height, planes, bits, packing, _, _, _, colours, _ = struct.unpack_from("<2sIHHIIiiHHIIiiII", content)
    if (magic, start, header, planes, bits, packing, colours) != (b"BM", 54, 40, 1, 24, 0, 0) or width < 1 or height < 1:
        return None
    line = (3 * width + 3) // 4 * 4  # rows end at a multiple of four bytes
    if 3 * width * height >= 1_000_000_000 or len(content) < start + line * height:
        return None
    rows = np.frombuffer(content, np.uint8, line * height, start).reshape(height, line)
    return height, width, rows[::-1, :3 * width].tobytes()


def _bitmaps(batches):
    """(image) of the plain bitmaps among (origin, content)."""
    for batch in batches:
        images = []
        for origin, content in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            if (found := plain_bitmap(content)) is not None:
                images.append({"origin": origin, "height": found[0], "width": found[1], "nChannels": 3, "mode": 16, "data": found[2]})
        kind = pa.struct([("origin", pa.string()), *((k, pa.int32()) for k in ("height", "width", "nChannels", "mode")), ("data", pa.binary())])
        yield pa.RecordBatch.from_arrays([pa.array(images, kind)], ["image"])


def _others(batches):
    """The paths of the other files among (path, content)."""
    for batch in batches:
        other = [plain_bitmap(content) is None for content in batch.column(1).to_pylist()]
        yield pa.RecordBatch.from_arrays([batch.column(0).filter(pa.array(other, pa.bool_()))], ["path"])


def scan_images(
    spark: SparkSession,
    path: str,
    glob: str | None = None,
    recursive: bool = True,
    drop_invalid: bool = False,
) -> DataFrame:
    """``image`` struct per file (S2): origin, height, width, nChannels, mode, data (BGR bytes).

    Files that cannot be decoded keep height = width = -1 unless ``drop_invalid``; the featuriser routes them to
    quarantine. Spark's image source takes some 6 ms a file to set up its row writer, so the files are looked through
    first, up to ``FEW_FILES`` that are no plain bitmaps: these alone go through it, or all files if there are more.
    """
    files = scan_binary(spark, path, glob=glob, recursive=recursive)
    ship_package(spark)
    with session_conf(spark, {"spark.sql.files.openCostInBytes": OPEN_COST}):
        others = [r["path"] for r in files.select("path", "content").mapInArrow(_others, "path string").limit(FEW_FILES + 1).collect()]
    named = len(others) <= FEW_FILES and not any(ch in name for name in others for ch in "*?[]{}\\")
    if not named:
        return _decoded(spark, path, drop_invalid, glob, recursive)
    images = files.select(F.input_file_name(), "content").mapInArrow(_bitmaps, IMAGE)
    return images.unionByName(_decoded(spark, others, drop_invalid)) if others else images


def _decoded(spark: SparkSession, path: str | list[str], drop_invalid: bool, glob: str | None = None, recursive: bool = True) -> DataFrame:
    """Files decoded by the JVM: Spark's image source."""
    reader = (
        spark.read.format("image")
        .option("recursiveFileLookup", str(recursive).lower())
        .option("dropInvalid", str(drop_invalid).lower())
    )
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    return reader.load(path)


def task_bytes(files: list[DataFrame], tasks: int, open_cost: int) -> int:
    """Bytes of files for each of about ``tasks`` tasks, from the listings alone (path and length; no file is opened).

    Spark packs a scan's files into tasks by length, the longest first, up to ``spark.sql.files.maxPartitionBytes``, each
    file counting ``open_cost`` more: with this value (and ``minPartitionNum`` = 1) tasks are balanced before any pixel is read.
    """
    total = 0
    for listing in files:
        row = listing.agg(F.sum("length"), F.count("*")).first()
        total += (row[0] or 0) + row[1] * open_cost
    return max(1, -(-total // max(tasks, 1)))


def image_items(images: DataFrame, rule: str = "parent", set_label: str | None = None, root: str = "images") -> DataFrame:
    """Adds decoded ``path`` and ``label`` (and ``split``) to an image scan.

    The path is ``image.origin`` (tied to the row, unlike ``input_file_name()`` next to a Python
    UDF) and is percent-decoded exactly once.

    rule='parent'  label = folder holding the file, at any depth.
    rule='set'     label = folder directly under ``<root>/<set_label>``; null for other layouts.
    """
    origin = F.col("image.origin")
    path = decode_path(origin)
    if rule == "parent":
        label = decode_path(label_from_parent(origin))  # an encoded slash stays within its segment
    elif rule == "set":
        if not set_label:
            raise ValueError("rule='set' needs set_label (e.g. 'train')")
        label = decode_path(F.nullif(label_from_set(origin, set_label, root), F.lit("")))
    else:
        raise ValueError("rule must be 'parent' or 'set'")
    return images.select(
        "image",
        path.alias("path"),
        label.alias("label"),
        F.nullif(decode_path(set_name(origin, root)), F.lit("")).alias("split"),
    )


def binary_items(files: DataFrame) -> DataFrame:
    """(path, label, content) from a binary scan; ``path`` is already decoded by that source.

    For checksums and copies: ``featurize`` takes decoded images or arrays, not file bytes.
    """
    return files.select("path", label_from_parent(F.col("path")).alias("label"), "content")


def read_features(spark: SparkSession, path: str) -> DataFrame:
    """Stored results (S3, S4); vectors come back as ``VectorUDT`` from Spark-written Parquet."""
    return spark.read.parquet(path)
