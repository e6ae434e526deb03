import threading

import pytest

from provenant.sources import commits, ledger
from provenant.sources.commits import ConflictError, Files, commit, compact, fresh, history, read, state, unreferenced


def rows(spark, *keys):
    return spark.createDataFrame([(k, f"v{k}") for k in keys], "k int, v string").withColumn("_bucket", commits.bucket(["k"], 4))


def keys(frame):
    return sorted(r.k for r in frame.collect())


def test_tables_of_a_commit_become_visible_together(spark, tmp_path, monkeypatch):
    """A writer that stops at any step before the manifest leaves nothing to see; the retry leaves all, once."""
    root = f"file://{tmp_path}/log"
    both = {"versions": rows(spark, 1, 2), "locations": rows(spark, 3)}
    commit(spark, root, "first", {"versions": rows(spark, 0)}, {"versions": "_bucket"})
    written = Files.publish
    for step in ("after the first table", "before the manifest"):
        with monkeypatch.context() as m:
            if step == "before the manifest":
                m.setattr(Files, "publish", lambda *_: (_ for _ in ()).throw(OSError("the driver is gone")))
            else:
                m.setattr(Files, "names", lambda self, folder, real=Files.names: (_ for _ in ()).throw(OSError("gone")) if folder.startswith("versions") else real(self, folder))
            with pytest.raises(OSError):
                commit(spark, root, "both", both, {"versions": "_bucket"})
        assert keys(read(spark, root, "versions")) == [0] and "locations" not in state(spark, root).folders
    assert Files.publish is written and len(unreferenced(spark, root)) == 3
    for _ in range(2):
        assert commit(spark, root, "both", both, {"versions": "_bucket"}) == 2
    assert keys(read(spark, root, "versions")) == [0, 1, 2] and keys(read(spark, root, "locations")) == [3]
    assert sorted(map(tuple, history(spark, root).collect())) == [(1, "first", "versions", 1, 0), (2, "both", "locations", 1, 0), (2, "both", "versions", 2, 0)]


def test_one_of_two_writers_is_refused(spark, tmp_path):
    root = f"file://{tmp_path}/log"
    commit(spark, root, "a", {"t": rows(spark, 1)})
    with pytest.raises(ConflictError):
        commit(spark, root, "b", {"t": rows(spark, 2)}, expected=0)
    files, won = Files(spark, root), []
    threads = [threading.Thread(target=lambda i=i: won.append(i) if files.publish(commits.manifest_name(2), {"version": 2, "token": str(i), "tables": {}}) else None) for i in range(4)]
    for t in threads:
        t.start()
    for t in threads:
        t.join()
    assert len(won) >= 1 and state(spark, root).version == 2 and not files.publish(commits.manifest_name(2), {})
    assert commit(spark, root, "c", {"t": rows(spark, 2)}, expected=2) == 3 and keys(read(spark, root, "t")) == [1, 2]


def test_earlier_versions_checkpoints_and_compaction(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(commits, "CHECKPOINT_EVERY", 3)
    monkeypatch.setattr(commits, "TOKENS", 4)
    root = f"file://{tmp_path}/log"
    for i in range(1, 8):
        assert commit(spark, root, f"t{i}", {"t": rows(spark, i)}, {"t": "_bucket"}) == i
    assert [n for n in Files(spark, root).names("_commits") if n.endswith("checkpoint")] == [f"{n:020d}.checkpoint" for n in (3, 6)]
    assert keys(read(spark, root, "t")) == [*range(1, 8)] and keys(read(spark, root, "t", 5)) == [*range(1, 6)] and keys(read(spark, root, "t", 2)) == [1, 2]
    assert commit(spark, root, "t6", {"t": rows(spark, 99)}) == 6
    assert compact(spark, root, "t", "_bucket") == 8 and len(state(spark, root).folders["t"]) == 1
    assert keys(read(spark, root, "t")) == [*range(1, 8)] == keys(read(spark, root, "t", 7)) and len(unreferenced(spark, root)) == 7
    with pytest.raises(ValueError):
        state(spark, root, 20)


def test_appends_read_only_the_partitions_of_their_keys(spark, tmp_path):
    root = f"file://{tmp_path}/log"
    commit(spark, root, "a", {"t": rows(spark, *range(200))}, {"t": "_bucket"})
    batch = rows(spark, 5, 5, 999)
    plan = fresh(spark, root, "t", batch, ["k"], "_bucket")
    assert keys(plan) == [999]
    one = rows(spark, 5)
    where = one.first()["_bucket"]
    files = read(spark, root, "t", values=[where]).inputFiles()
    assert files and all(f"_bucket={where}" in f for f in files) and len(files) < len(read(spark, root, "t").inputFiles())


def test_ledger_append_by_batch(spark, tmp_path):
    root = f"file://{tmp_path}/t"
    frame = spark.createDataFrame([(1, None, "x"), (1, None, "y"), (2, "b", "z")], "a int, b string, v string")
    assert sorted(map(tuple, ledger.append(spark, root, frame, ["a", "b"], 1, "v").collect())) == [(1, None, "x"), (2, "b", "z")]
    assert ledger.append(spark, root, frame, ["a", "b"], 1, "v").count() == 2 and ledger.append(spark, root, frame, ["a", "b"], 2, "v").count() == 0
    assert ledger.append(spark, root, frame.limit(0), ["a", "b"], 3, "v").count() == 0 and ledger.read_table(spark, root, frame.schema).count() == 2
    assert ledger.read_table(spark, f"file://{tmp_path}/none", frame.schema).count() == 0
