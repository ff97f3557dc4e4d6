"""Documents as text files: the files, and the scan against Spark's reader."""

import hashlib
import os

import pytest
from pyspark.sql import functions as F

from staylytics.plans import index
from staylytics.session import scratch_path


def test_a_folder_is_scanned_as_by_spark(spark, monkeypatch, tmp_path):
    found = [("a b", "x y.txt", b"hi"), ("ü%20", "ü%41+#.txt", b"one\r\ntwo\n"), ("_h", "z.txt", b"no"), ("_h=1", "z.txt", b"yes"), (".k", "z.txt", b"no"),
             ("s", "empty.txt", b""), ("s", "_u.txt", b"no"), ("s", "_u=1.txt", b"\xff"), ("s", "b.md", b"no"), *(("many", f"{i}.txt", b"%d" % i) for i in range(30))]
    for folder, name, text in found:
        os.makedirs(tmp_path / folder, exist_ok=True)
        (tmp_path / folder / name).write_bytes(text)
    monkeypatch.setattr(index, "FILES_READ", 4)
    rows = lambda: sorted(map(str, index.scan_text_files(spark, str(tmp_path)).select("path", "metadata", F.hex("text"), "hash").collect()))
    got = rows()
    monkeypatch.setattr(index, "local_folder", lambda *_: None)
    assert got == rows() and len(got) == 34


@pytest.mark.parametrize("local", [True, False])
def test_each_row_is_one_file(spark, monkeypatch, local):
    if not local:
        monkeypatch.setattr(index, "local_folder", lambda *_: None)
    monkeypatch.setattr(index, "FILES_READ", 4)
    folder, texts = scratch_path(spark, "texts"), ["one\r\ntwo", "", None, "é\n", *map(str, range(20))]
    index.write_text_files(spark.createDataFrame([(f"{i}-7", t) for i, t in enumerate(texts)], "file string, text string").repartition(3), folder)
    files = [os.path.join(d, n) for d, _, names in os.walk(folder.removeprefix("file:")) for n in names if n.endswith(".txt")]
    assert len(files) == 23 and len({os.path.dirname(f) for f in files}) == (5 if local else 23)
    got = sorted(r["hash"] for r in index.scan_text_files(spark, folder).collect())
    assert got == sorted(hashlib.sha256((t + "\n").encode()).hexdigest() for t in texts if t is not None)
