"""Documents appear all together or not at all."""

import json
from pathlib import Path
from types import SimpleNamespace

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tessera.operators import document_sink as sink
from tessera.operators import sinks


def visible(root):
    return {str(p.relative_to(root)): p.read_bytes() for p in Path(root).rglob("*") if p.is_file()}


def hidden(root):
    return Path(sink.hidden_folder(str(root)))


def rows(spark, n=40):
    return spark.range(n).select(F.concat(F.lit("d"), (F.col("id") % 3).cast("string"), F.lit("/"), F.col("id").cast("string"), F.lit(".txt")).alias("name"), F.concat(F.lit("é "), F.col("id").cast("string")).alias("content")).repartition(4)


def test_all_rows_become_documents(spark, tmp_path):
    got = sink.write_documents(rows(spark), f"file://{tmp_path}")
    want = {f"d{k % 3}/{k}.txt": f"é {k}".encode() for k in range(40)}
    assert visible(tmp_path) == want and {(r.name, r.bytes) for r in got.collect()} == {(n, len(c)) for n, c in want.items()}
    assert not list((hidden(tmp_path) / "staging").glob("*")) and not list(hidden(tmp_path).glob("*.committed"))
    assert spark.read.text(str(tmp_path), recursiveFileLookup=True).count() == 40
    # another job replaces the documents of its names and leaves the others; bytes are written as they are
    more = spark.createDataFrame([("d0/0.txt", bytearray(b"\x00\xff")), ("new", bytearray(b""))], "name string, content binary")
    sink.write_documents(more, f"file://{tmp_path}")
    assert visible(tmp_path) == {**want, "d0/0.txt": b"\x00\xff", "new": b""}
    assert sink.write_documents(rows(spark, 0), f"file://{tmp_path}").count() == 0


def test_a_failed_job_leaves_nothing(spark, tmp_path):
    broken = rows(spark).withColumn("content", F.when(F.col("name") == "d0/39.txt", F.raise_error(F.lit("broken"))).otherwise(F.col("content")))
    with pytest.raises(Exception, match="broken"):
        sink.write_documents(broken, f"file://{tmp_path}")
    assert visible(tmp_path) == {} and not list((hidden(tmp_path) / "staging").glob("*"))
    assert not list(hidden(tmp_path).glob("*.committed"))


@pytest.mark.parametrize("name", [None, "", "../out", "/abs", "a//b", "a/", "a/./b", "a\\b"])
def test_unsafe_names_are_errors(spark, tmp_path, name):
    bad = spark.createDataFrame([("good", "x"), (name, "y")], "name string, content string")
    with pytest.raises(Exception, match="not a name"):
        sink.write_documents(bad, f"file://{tmp_path}")
    assert visible(tmp_path) == {}


def test_other_errors(spark, tmp_path):
    twice = spark.createDataFrame([("a", "x"), ("a", "y")], "name string, content string").coalesce(1)
    with pytest.raises(Exception, match="two documents"):
        sink.write_documents(twice, f"file://{tmp_path}")
    with pytest.raises(ValueError, match="several rows"):
        sinks.unique_names(twice, "name")
    with pytest.raises(Exception, match="without content"):
        sink.write_documents(spark.createDataFrame([("a", None)], "name string, content string"), f"file://{tmp_path}")
    sink.register(spark)
    with pytest.raises(Exception, match="have the columns"):
        spark.range(3).write.format(sink.NAME).mode("append").save(str(tmp_path))
    with pytest.raises(Exception, match="mode append"):
        rows(spark).write.format(sink.NAME).mode("overwrite").save(str(tmp_path))
    assert visible(tmp_path) == {}


def test_a_job_run_again_changes_nothing(spark, tmp_path):
    root = f"file://{tmp_path}"
    sink.write_documents(rows(spark, 5), root, job="nightly")
    other = spark.createDataFrame([("d0/0.txt", "changed")], "name string, content string")
    got = sink.write_documents(other, root, job="nightly")
    assert visible(tmp_path)["d0/0.txt"] == "é 0".encode() and got.count() == 5


def test_a_commit_that_broke_off_goes_forward(tmp_path):
    """The record is there and some documents have moved; the next job ends what is left."""
    root = f"file://{tmp_path}"
    batch = pa.RecordBatch.from_pydict({"name": ["a", "b/c", "d"], "content": ["1", "2", "3"]})
    writer = sink.BatchWriter(root, "job")
    message = writer.write(iter([batch]))
    assert visible(tmp_path) == {} and message.documents == 3
    (tmp_path / "b").write_text("in the way")  # b/c can't be made
    with pytest.raises(OSError):
        writer.commit([message, None])
    assert (hidden(tmp_path) / "job.committed").exists()
    (tmp_path / "b").unlink()
    assert sink.recover(root) == ["job"] and sink.recover(root) == []
    assert visible(tmp_path) == {"a": b"1", "b/c": b"2", "d": b"3"}
    assert not (hidden(tmp_path) / "job.committed").exists()


def test_a_repeated_task_counts_once(tmp_path):
    root, writer = f"file://{tmp_path}", sink.BatchWriter(f"file://{tmp_path}", "job")
    lost = sink.BatchWriter(root, "job")
    first = lost.stage("job", iter([pa.RecordBatch.from_pydict({"name": ["a", "x"], "content": ["old", "old"]})]))
    (hidden(tmp_path) / "staging/job" / first.task).rename(hidden(tmp_path) / "staging/job/000000-9")
    message = writer.write(iter([pa.RecordBatch.from_pydict({"name": ["a"], "content": ["new"]})]))
    writer.commit([message])
    assert visible(tmp_path) == {"a": b"new"} and not list((hidden(tmp_path) / "staging").glob("*"))


def test_a_stream_writes_each_batch_once(spark, tmp_path):
    source, root, state = tmp_path / "in", tmp_path / "out", tmp_path / "state"
    source.mkdir()
    sink.register(spark)

    def run():
        stream = spark.readStream.schema("name string, content string").json(str(source))
        stream.writeStream.format(sink.NAME).option("checkpointLocation", str(state)).trigger(availableNow=True).start(str(root)).awaitTermination()

    (source / "1.json").write_text(json.dumps({"name": "a", "content": "1"}))
    run()
    (source / "2.json").write_text(json.dumps({"name": "b", "content": "2"}))
    run()
    assert visible(root) == {"a": b"1", "b": b"2"}
    # a batch whose commit is repeated has nothing left to do
    again = sink.StreamWriter(f"file://{root}", "stream")
    again.commit([again.write(iter([pa.RecordBatch.from_pydict({"name": ["a"], "content": ["9"]})]))], 0)
    assert visible(root) == {"a": b"1", "b": b"2"}


def test_bare_roots_need_one_machine(spark):
    assert sinks.rooted(spark, "/tmp/x") == "file:///tmp/x" and sinks.rooted(spark, "hdfs://h/x") == "hdfs://h/x"


def test_the_checkpoint_folder_needs_no_scheme(spark, tmp_path):
    for given in (str(tmp_path), f"file:{tmp_path}", f"file://{tmp_path}"):
        # the setting is one that a running session can't change
        conf = SimpleNamespace(get=lambda name, default=None, given=given: given)
        root = sinks.workspace(SimpleNamespace(conf=conf, _jvm=spark._jvm, sparkContext=spark.sparkContext))
        assert root.startswith(f"file://{tmp_path}/workspace-"), (given, root)
        rows = spark.createDataFrame([("a", "x")], "name string, content string")
        assert [tuple(r) for r in sinks.write_files(rows, root).collect()] == [("a", 1)]
