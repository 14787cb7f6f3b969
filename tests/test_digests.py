"""Digests of files as streams."""

import hashlib
import random

from jobtide.sources import io


def test_equal_digests(spark, tmp_path):
    rng = random.Random(1)
    contents = [b"", b"\n", b"\n\n", b"a", b"a\n", b"a\nb", b"\r\n", b"\xff\xfe\n\x00", "é\n日本".encode(), rng.randbytes(300_000), b"x" * 200_000 + b"\n" + b"y" * 70_000, b"line\n" * 50_000, b"line\n" * 50_000 + b"end"]
    (tmp_path / "sub").mkdir()
    for i, c in enumerate(contents):
        (tmp_path / ("sub" if i % 3 == 0 else ".") / f"f{i:02d}").write_bytes(c)
    kept = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "1000")
    got = {r.path.rsplit("/", 1)[1]: (r.bytes, r.sha256) for r in io.file_digests(spark, str(tmp_path)).collect()}
    assert spark.conf.get("spark.sql.files.maxPartitionBytes") == "1000"
    spark.conf.set("spark.sql.files.maxPartitionBytes", kept)
    assert got == {f"f{i:02d}": (len(c), hashlib.sha256(c).hexdigest()) for i, c in enumerate(contents)}
    marks = {r.path.rsplit("/", 1)[1]: r.fingerprint for r in io.fingerprint_files(spark, str(tmp_path)).collect()}
    assert marks["f03"] == hashlib.sha256(b"a").hexdigest()[:16]
