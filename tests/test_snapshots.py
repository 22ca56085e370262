"""Versions of a snapshot: what a run reads, what it changes, and what a run that stops leaves."""

import json
from collections import Counter

import __spark_entry__ as entry
import pytest
from conftest import SF_DIR
from lodestone.operators import diff as D
from lodestone.plans.extraction import EntityStreams
from lodestone.sinks.commits import CommitLog, ConcurrentRunError
from lodestone.sinks.snapshots import SnapshotStore, changed_only
from test_extracts import table


def entities(make_catalog, **connections):
    """Table entities: connection -> {name: rows}."""
    rows = [{"connection_qn": c, **table(n, table_rows=r)} for c, names in connections.items() for n, r in names.items()]
    return EntityStreams(make_catalog(tables=rows))["table"]


def changes(df):
    return {(r.connection_qn, r.qualifiedName.rsplit("/", 1)[1]): r.change for r in df.collect()}


def all_rows(store, version):
    return Counter(tuple(r) for r in store.keys(version).select("connection_qn", "qualifiedName", "h1", "h2").collect())


def test_a_log_shows_whole_records_in_order_and_gives_a_number_once(spark, tmp_path):
    log = CommitLog(spark, str(tmp_path / "log"))
    assert log.latest() is None
    log.commit(1, {"a": "é"})
    log.commit(2, {"a": [1]})
    (tmp_path / "log" / ".half").write_text("{")
    assert log.latest() == (2, {"a": [1]}) and log.read(1) == {"a": "é"}
    with pytest.raises(ConcurrentRunError):
        log.commit(2, {"a": "other"})
    assert log.read(2) == {"a": [1]} and log.numbers() == [1, 2]


def test_versions_have_the_changes_of_whole_diffs(spark, make_catalog, tmp_path):
    store = SnapshotStore(spark, str(tmp_path), leaf_rows=8, shard_rows=40)
    big = {f"t{i}": i for i in range(200)}
    runs = [
        {"c1": big, "c2": {"a": 1, "b": 2}, "c3": {"z": 1}},
        {"c1": {**big, "t7": -1, "new": 0}, "c2": {"a": 1}},
        # Few rows left: leaves of another size than before.
        {"c1": {"t1": 1, "t2": 3}, "c3": {"z": 1, "y": 1}},
        {"c4": {f"u{i}": i for i in range(100)}},
    ]
    before, state = None, {}
    for run in runs:
        version = store.publish([entities(make_catalog, **run)])
        assert store.current() == version
        state = {**state, **run}
        expected = changes(D.incremental_changes(before, entities(make_catalog, **run))) if before is not None else dict.fromkeys(((c, n) for c in run for n in run[c]), "insert")
        assert changes(store.changes(version)) == expected
        # What a version holds is what its connections had last, also those not delivered.
        before = entities(make_catalog, **state)
        assert all_rows(store, version) == Counter(tuple(r) for r in D.fingerprints(before).select("connection_qn", "qualifiedName", "h1", "h2").collect())
    again = store.publish([entities(make_catalog, **state)])
    assert store.changes(again).isEmpty() and again.number == len(runs) + 1


def test_nothing_delivered_is_refused_and_changes_nothing(spark, make_catalog, tmp_path):
    store = SnapshotStore(spark, str(tmp_path))
    nothing = entities(make_catalog, c1={"a": 1}).limit(0)
    empty = store.publish([nothing])
    assert store.keys(empty).isEmpty()
    store.publish([entities(make_catalog, c1={"a": 1})])
    with pytest.raises(D.EmptySnapshotError):
        store.publish([nothing])
    assert store.current().number == 2


def test_a_run_that_stops_before_its_rename_leaves_the_last_version(spark, make_catalog, tmp_path, monkeypatch):
    store = SnapshotStore(spark, str(tmp_path))
    first = store.publish([entities(make_catalog, c1={"a": 1, "b": 1})])
    held = all_rows(store, first)
    commit = CommitLog.commit

    def lost(self, number, record):
        raise OSError("the driver is gone")

    monkeypatch.setattr(CommitLog, "commit", lost)
    with pytest.raises(OSError, match="gone"):
        store.publish([entities(make_catalog, c1={"a": 2})])
    assert SnapshotStore(spark, str(tmp_path)).current() == first and all_rows(store, first) == held

    def beaten(self, number, record):
        commit(self, number, record)
        commit(self, number, record)

    monkeypatch.setattr(CommitLog, "commit", beaten)
    with pytest.raises(ConcurrentRunError):
        store.publish([entities(make_catalog, c1={"a": 2})])
    monkeypatch.setattr(CommitLog, "commit", commit)
    assert changes(store.changes(store.publish([entities(make_catalog, c1={"a": 3})]))) == {("c1", "a"): "update"}


def scanned_files(df):
    """Files read by each scan of the keys in the plan that ran."""
    plan = df._jdf.queryExecution().executedPlan()
    plan.execute().count()
    found, open_nodes = [], [plan]
    while open_nodes:
        node = open_nodes.pop()
        name = node.getClass().getSimpleName()
        if name == "AdaptiveSparkPlanExec":
            open_nodes.append(node.executedPlan())
        elif name.endswith("QueryStageExec"):
            open_nodes.append(node.plan())
        else:
            if name == "FileSourceScanExec" and "h1" in node.toString():
                found.append(node.metrics().apply("numFiles").value())
            children = node.children()
            open_nodes += [children.apply(i) for i in range(children.size())]
    return found


def test_a_small_change_reads_few_files(spark, make_catalog, tmp_path):
    store = SnapshotStore(spark, str(tmp_path), leaf_rows=16, shard_rows=32)
    names = {f"t{i}": i for i in range(1_000)}
    first = store.publish([entities(make_catalog, c1=names)])
    second = store.publish([entities(make_catalog, c1={**names, "t5": -5})])
    shards = len(list(tmp_path.glob("versions/*1-*/keys/shard=*")))
    assert shards >= 16
    nodes = spark.read.parquet(f"{second.folder}/nodes")
    assert nodes.count() == 1
    files = scanned_files(store.changes_between(first, second, nodes))
    assert len(files) == 2 and max(files) == 1
    assert changes(store.changes(second)) == {("c1", "t5"): "update"}


def test_changed_entities_are_whole(spark, make_catalog, tmp_path):
    store = SnapshotStore(spark, str(tmp_path))
    store.publish([entities(make_catalog, c1={"a": 1, "b": 1})])
    new = entities(make_catalog, c1={"a": 2, "c": 1})
    found = changed_only(new, store.changes(store.publish([new])))
    assert found.columns == new.columns and {r.attributes.name for r in found.collect()} == {"a", "c"}


def test_equal_digests_need_equal_rows(spark, make_catalog, tmp_path):
    """Contents that change places between two entities are changes, though the set of contents is the same."""
    store = SnapshotStore(spark, str(tmp_path))
    first = entities(make_catalog, c1={"a": 1, "b": 2})
    rows = D.fingerprints(first).collect()
    assert len({r.h1 for r in rows}) == 2
    store.publish([first])
    assert set(changes(store.changes(store.publish([entities(make_catalog, c1={"a": 2, "b": 1})]))).values()) == {"update"}
    record = json.loads(next((tmp_path / "log").glob("*2.json")).read_text())
    assert record["entities"] == 2


def test_two_runs_extract_their_tables_once(spark):
    _, tables = entry._two_runs(spark, SF_DIR)
    files = tables.inputFiles()
    assert files and all("/extract-" in file for file in files)
    _, plain = entry._table_snapshots(EntityStreams(entry._catalog(spark, SF_DIR)))
    assert tables.dtypes == plain.dtypes and tables.exceptAll(plain).isEmpty() and plain.exceptAll(tables).isEmpty()
