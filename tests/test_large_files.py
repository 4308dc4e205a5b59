"""One large JSON array or binary file: split or streamed, with the results of a whole read."""

import hashlib
import json
import random

import pytest

from cartloom.sources import files, schemas, snapshot
from cartloom.sources.json_array import read_json_array

DDL = "id bigint, name string, tags array<struct<k:string,v:string>>, meta struct<deep:struct<n:int>>"


def records(n, seed=1):
    """Strings with braces, quotes, escapes and line ends; nesting; some empty objects and long ones."""
    rnd = random.Random(seed)
    bits = ["{", "}", '"', "\\", "},{", "]", "[", "a", "é", "\n", "\t", "漢", "\\\"", '"}', "{\"id\":7}", "\u2028"]
    text = lambda: "".join(rnd.choice(bits) for _ in range(rnd.randrange(30)))
    rows = []
    for i in range(n):
        row = {"id": i, "name": text(), "tags": [{"k": text(), "v": text()} for _ in range(rnd.randrange(4))], "meta": {"deep": {"n": i}}}
        rows.append({} if i % 50 == 7 else {**row, "name": "}{\"" * 3000} if i % 97 == 3 else row)
    return rows


@pytest.fixture
def small_splits(spark):
    spark.conf.set("spark.sql.files.maxPartitionBytes", "2000")
    yield
    spark.conf.unset("spark.sql.files.maxPartitionBytes")


@pytest.mark.parametrize("style", [{}, {"indent": 2}, {"separators": (",", ":")}, {"ensure_ascii": False, "indent": 1}])
def test_array_by_many_tasks(spark, tmp_path, small_splits, style):
    rows = records(300)
    path = tmp_path / "a.json"
    path.write_text(json.dumps(rows, **style) + "\n", encoding="utf-8")
    assert spark.read.text(str(path), lineSep="}").rdd.getNumPartitions() > 10
    want = spark.read.schema(DDL).json(str(path), multiLine=True).collect()
    got = read_json_array(spark, str(path), DDL).collect()
    key = lambda r: (r.id is None, r.id)
    assert sorted(got, key=key) == sorted(want, key=key) and len(got) == 300


def test_empty_arrays_and_several_files(spark, tmp_path, small_splits):
    for name, text in [("a", "[]"), ("b", " [ \n ]\n"), ("c", '[{"id":1}]'), ("d", '\ufeff[\n{"id":2} ,\n{"id":3}\n]')]:
        (tmp_path / f"{name}.json").write_text(text, encoding="utf-8")
    assert sorted(r.id for r in read_json_array(spark, str(tmp_path), DDL).collect()) == [1, 2, 3]


@pytest.mark.parametrize("text", ['[{"id":1},{"id":2', '[{"id":1},', '[{"id":1}', '[{"id":1,"name":"]', '[{"tags":[]'])
def test_cut_off_array_is_an_error(spark, tmp_path, text):
    (tmp_path / "a.json").write_text(text)
    with pytest.raises(Exception, match="not a whole JSON array"):
        read_json_array(spark, str(tmp_path / "a.json"), DDL).collect()


def test_snapshot_splits_large_arrays(spark, tmp_path, small_splits):
    import shopdata

    folder = shopdata.write(tmp_path)
    whole = snapshot.load_snapshot(spark, folder, schemas.CATALOG_REQUIRED)
    split = snapshot.load_snapshot(spark, folder, schemas.CATALOG_REQUIRED, split_bytes=0)
    for entity in schemas.CATALOG_REQUIRED:
        assert split[entity].schema == whole[entity].schema
        assert sorted(map(repr, split[entity].collect())) == sorted(map(repr, whole[entity].collect())), entity


def test_manifest_reads_in_chunks(spark, tmp_path):
    data = {"t/part-0": b"", "t/part-1": bytes(range(256)) * 1000, "u+v (1)/part-%20": b"x" * 70_001}
    for name, content in data.items():
        (tmp_path / name).parent.mkdir(exist_ok=True)
        (tmp_path / name).write_bytes(content)

    class Counted:
        def __init__(self, path):
            self.stream = open(path.removeprefix("file:"), "rb")

        def read(self, n):
            assert n == 1000
            return self.stream.read(n)

        def __enter__(self):
            return self

        def __exit__(self, *_):
            self.stream.close()

    want = {(n, len(c), hashlib.sha256(c).hexdigest()) for n, c in data.items()}
    for rows in (files.file_manifest(spark, str(tmp_path)), files.file_manifest(spark, str(tmp_path), opener=Counted, chunk=1000)):
        assert {(r.file, r.bytes, r.sha256) for r in rows.collect()} == want
