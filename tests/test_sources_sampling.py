import gzip
import hashlib
import os
import struct

import numpy as np
import pytest
from pyspark.sql import functions as F

from imlens.functions.vectors import length_summary, long_form, split_valid
from imlens.operators import sampling
from imlens.plans import queries
from imlens.session import session_conf
from imlens.sources import files
from imlens.sources.files import scan_binary, scan_digests
from imlens.sources.sinks import guard_overlap, write_csv

from conftest import SF001
from png_images import png_bytes


def test_stable_sample_is_partition_independent(spark):
    e = spark.read.parquet(f"{SF001}/embeddings.parquet")
    a = {r.vec_id for r in sampling.stable_sample(e, "vec_id", 0.2).collect()}
    b = {r.vec_id for r in sampling.stable_sample(e.repartition(7), "vec_id", 0.2).collect()}
    assert a == b and 0 < len(a) < e.count()
    assert sampling.stable_sample(e, "vec_id", 1.0).count() == e.count()
    assert sampling.stable_sample(e, "vec_id", 0.0).count() == 0


def test_random_n_and_bernoulli(spark):
    e = spark.read.parquet(f"{SF001}/embeddings.parquet")
    assert sampling.random_n(e, 10).count() == 10
    assert sampling.sample_capped(e, 0.5, 5).count() <= 5
    plan = sampling.random_n(e, 10)._jdf.queryExecution().executedPlan().toString()
    assert "TakeOrderedAndProject" in plan


def test_binary_scan_prunes_content(spark):
    files = scan_binary(spark, SF001, glob="*.parquet").select("path", "length")
    plan = files._jdf.queryExecution().executedPlan().toString()
    assert "content" not in plan.split("ReadSchema")[-1].split("\n")[0]
    assert files.count() == len([f for f in os.listdir(SF001) if f.endswith(".parquet")])


@pytest.fixture()
def odd_files(tmp_path):
    """Files of odd names, ends and bytes, some of a megabyte; {name: MD5}."""
    rng = np.random.default_rng(4)
    noise = rng.integers(0, 256, 1_000_000).astype(np.uint8).tobytes()
    many = {
        "empty": b"", "end": noise + b"\n", "ends": noise + b"\n\n", "no end": noise + b"x", "ends only": b"\n" * 5000, "mark": b"\xef\xbb\xbf" + noise + b"x",
        "mark, end": b"\xef\xbb\xbf" * 2 + b"a\r\n" * 90_000, "50%25 [é] {x} #+": noise[::-1], "small": b"abc", "zeros": bytes(1_000_000), "one line.gz": gzip.compress(noise),
    }
    (tmp_path / "in" / "below").mkdir(parents=True)
    for k, (name, data) in enumerate(many.items()):
        (tmp_path / "in" / ("below" if k % 2 else "") / name).write_bytes(data)
    (tmp_path / "in" / "_hidden").write_bytes(b"not listed")
    return str(tmp_path / "in"), {name: (len(data), hashlib.md5(data).hexdigest()) for name, data in many.items() if data}  # Spark lists no empty file


def digests(files):
    rows = [(r["path"].rsplit("/", 1)[1], (r["length"], r["md5"])) for r in files.collect()]
    assert len(dict(rows)) == len(rows)
    return dict(rows)


def test_digests_hold_no_file_in_memory(spark, odd_files):
    """No plan node reads ``content``: the tasks read files a piece at a time."""
    folder, want = odd_files
    files = scan_digests(spark, folder)
    assert "content" not in files._jdf.queryExecution().executedPlan().toString()
    assert digests(files) == want
    assert digests(scan_digests(spark, f"file://{folder}", glob="en*", recursive=False)) == {"ends": want["ends"]} | {k: v for k, v in want.items() if k == "ends only"}
    assert "content" not in queries.q_scan_content(spark, SF001)._jdf.queryExecution().executedPlan().toString()


def test_digests_of_a_store_that_only_spark_opens(spark, odd_files, monkeypatch):
    """Files over WHOLE_BYTES come in lines of splits, whatever their ends; smaller and packed ones in one piece."""
    folder, want = odd_files
    monkeypatch.setattr("imlens.sources.files.WHOLE_BYTES", 4_000)
    spark._jsc.hadoopConfiguration().set("fs.viewfs.mounttable.odd.link./in", f"file://{folder}")
    with session_conf(spark, {"spark.sql.files.maxPartitionBytes": 300_000, "spark.sql.files.openCostInBytes": 1_000}):
        assert digests(scan_digests(spark, "viewfs://odd/in")) == want
        assert digests(scan_digests(spark, "viewfs://odd/in", glob="e*")) == {k: v for k, v in want.items() if k[0] == "e"}


def test_parquet_scan_prunes_and_pushes(spark):
    docs = spark.read.parquet(f"{SF001}/documents.parquet").filter(F.col("doc_id") > 10).select("doc_id", "lang")
    plan = docs._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull(doc_id), GreaterThan(doc_id,10)]" in plan
    assert "ReadSchema: struct<doc_id:bigint,lang:string>" in plan


def test_vector_checks(spark):
    df = spark.createDataFrame(
        [(1, [1.0, 2.0]), (2, [1.0]), (3, None), (4, [float("nan"), 1.0])], "id int, v array<double>"
    )
    good, bad = split_valid(df, "v", dim=2)
    assert [r.id for r in good.collect()] == [1]
    errs = {r.id: r.error for r in bad.collect()}
    assert errs == {2: "length 1 != 2", 3: "null vector", 4: "non-finite value"}
    s = length_summary(df, "v").first()
    assert (s.n_rows, s.min_size, s.max_size, s.n_null) == (4, 1, 2, 1)
    assert long_form(df.filter("id = 1"), ["id"], "v").count() == 2


def test_csv_sink_flattens_arrays(spark, tmp_path):
    df = spark.createDataFrame([("p", "l", [1.5, 2.0])], "path string, label string, f array<double>")
    out = str(tmp_path / "csv")
    write_csv(df, out)
    back = spark.read.option("header", "true").csv(out).first()
    assert back.f == "1.5 2.0"


@pytest.mark.parametrize(
    "out,source",
    [
        ("/d/images", "file:///d/images"), ("/d/images/out", "file:///d/images"), ("s3://b/x", "s3a://b/x"), ("/d/a/../images", "/d/images"),
        ("/d//images", "/d/images"), ("/data/images/out", "/data/images"), ("/data", "/data/images/"), ("s3n://b/x/y", "s3://b//x/"), ("/d/im*", "/e"),
        ("/e", "/d/{a,b}"),
    ],
)
def test_overlapping_outputs_are_refused(spark, out, source):
    with pytest.raises(ValueError):
        guard_overlap(spark, out, [source])


def test_separate_outputs_pass(spark):
    guard_overlap(spark, "/data/out", ["/data/images", "s3a://b/x", "file:///data/outer"])
    guard_overlap(spark, "s3a://b/xy", ["s3a://b/x", "s3a://c/xy"])


def test_session_conf_restores(spark):
    from imlens.session import session_conf

    key = "spark.sql.files.openCostInBytes"
    before = spark.conf.get(key)
    with session_conf(spark, {key: 1234}):
        assert spark.conf.get(key) in ("1234", "1234b")
    assert spark.conf.get(key) == before


def test_ship_package_through_shared_folder(tmp_path):
    """The cluster branch: zip written via the Hadoop FS API into the checkpoint folder, then shipped."""
    import subprocess
    import sys

    code = (
        "import sys; sys.path.insert(0, %r)\n"
        "from pyspark.sql import SparkSession\n"
        "s = SparkSession.builder.master('local[2]').config('spark.ui.enabled','false').getOrCreate()\n"
        "s.sparkContext.setCheckpointDir(%r)\n"
        "from imlens.session import ship_package\n"
        "ship_package(s, shared=True)\n"
        "import glob; print(len(glob.glob(%r + '/*/imlens-pyfiles-*/imlens.zip')))\n"
        "f = s.sparkContext.parallelize([1], 1).map(lambda _: __import__('imlens.functions.paths').__name__).collect()\n"
        "print(f[0])\n"
    ) % (os.path.dirname(os.path.dirname(os.path.abspath(__file__))), str(tmp_path), str(tmp_path))
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    out = subprocess.run([sys.executable, "-c", code], capture_output=True, text=True, timeout=240, cwd="/tmp", env=env)
    lines = [l for l in out.stdout.splitlines() if l.strip()]
    assert lines[-2:] == ["1", "imlens"], out.stdout + out.stderr[-2000:]


def test_legacy_parquet_write_round_trips(spark, tmp_path):
    import pyarrow.parquet as pq

    from imlens.sources.sinks import write_parquet

    df = spark.createDataFrame([(1, [1.0, 2.0])], "id int, v array<double>")
    write_parquet(df, str(tmp_path / "legacy"), legacy_format=True)
    assert spark.conf.get("spark.sql.parquet.writeLegacyFormat") == "false"
    back = spark.read.parquet(str(tmp_path / "legacy")).first()
    assert list(back.v) == [1.0, 2.0]
    files = [f for f in os.listdir(tmp_path / "legacy") if f.endswith(".parquet")]
    schema = str(pq.read_schema(str(tmp_path / "legacy" / files[0])))
    assert "bag" in schema or "array" in schema  # legacy list layout


def bitmap(width: int, height: int, seed: int = 0, bits: int = 24) -> bytes:
    line = (width * bits // 8 + 3) // 4 * 4
    body = np.random.default_rng(seed).integers(0, 256, line * abs(height), np.uint8).tobytes()
    return struct.pack("<2sIHHIIiiHHIIiiII", b"BM", 54 + len(body), 0, 0, 54, 40, width, height, 1, bits, 0, 0, 0, 0, 0, 0) + body


def rows_of(df):
    return sorted((r["origin"], r["height"], r["width"], r["nChannels"], r["mode"], bytes(r["data"])) for r in df.select("image.*").collect())


def test_plain_bitmaps_are_read_as_by_the_image_source(spark, tmp_path):
    """They went through Spark's image source, 10 ms of a core each; sizes with padded rows, odd names, bytes after the pixels."""
    for k, (w, h) in enumerate([(1, 1), (2, 3), (3, 2), (4, 1), (5, 7), (8, 9)]):
        folder = tmp_path / f"a b%20+ü{k % 2}"
        folder.mkdir(exist_ok=True)
        (folder / f"x y%25#{k}.txt").write_bytes(bitmap(w, h, k) + b"\n" * (k % 2))
    scan = files.scan_images(spark, str(tmp_path), glob="*.txt")
    plan = scan._jdf.queryExecution().executedPlan().toString()
    assert "FileScan binaryFile" in plan and "FileScan image" not in plan
    assert rows_of(scan) == rows_of(files._decoded(spark, str(tmp_path), False)) and scan.count() == 6
    assert scan.schema == files._decoded(spark, str(tmp_path), False).schema


@pytest.mark.parametrize("few", [1_000, 2])
@pytest.mark.parametrize("drop", [False, True])
def test_other_images_go_through_the_image_source(spark, tmp_path, monkeypatch, few, drop):
    """Beside plain bitmaps: top row first, four bytes a pixel, cut off, a colour table, a PNG file, no image, nothing."""
    monkeypatch.setattr(files, "FEW_FILES", few)
    table = bytearray(bitmap(3, 2, 5))
    table[46] = 2
    png = png_bytes(np.arange(24, dtype=np.uint8).reshape(2, 4, 3))
    contents = [bitmap(3, 2), bitmap(3, 2, 1), bitmap(3, -2, 2), bitmap(2, 2, 3, 32), bitmap(3, 2, 4)[:-5], bytes(table), png, b"no image", b"", bitmap(5, 5, 6)]
    for k, content in enumerate(contents):
        (tmp_path / f"{k} %.img").write_bytes(content)
    got = rows_of(files.scan_images(spark, str(tmp_path), drop_invalid=drop))
    assert got == rows_of(files._decoded(spark, str(tmp_path), drop))
    assert len(got) == 9 or drop and 3 <= len(got) < 9  # Spark leaves out empty files


def test_names_that_look_like_patterns(spark, tmp_path):
    for name in ("a[1].bmp", "a1.bmp", "b{x}.bmp", "c*.bmp"):
        (tmp_path / name).write_bytes(bitmap(2, 2) if "1" in name else b"no image")
    assert rows_of(files.scan_images(spark, str(tmp_path))) == rows_of(files._decoded(spark, str(tmp_path), False))


def test_no_files(spark, tmp_path):
    assert files.scan_images(spark, str(tmp_path)).count() == 0


def test_tasks_take_the_folders_in_their_own_order(spark, tmp_path, monkeypatch):
    """All tasks wrote into the same folder at a time, which makes one file after the other."""
    rows = [(bytes([i]), f"s{i % 2}", str(i % 5)) for i in range(200)]
    df = spark.createDataFrame(rows, "value binary, images string, label string").repartition(6)
    queries.write_small_files(df, str(tmp_path))
    found = sorted((p.parts[-3], p.parts[-2], p.read_bytes()[:-1], p.name) for p in tmp_path.rglob("part-*"))
    assert sorted(f[:3] for f in found) == sorted((f"images={b}", f"label={c}", a) for a, b, c in rows)
    firsts = {min((name, folder, label) for folder, label, _, name in found if name.startswith(f"part-{t:05d}"))[1:] for t in range(6)}
    assert len(firsts) > 1
