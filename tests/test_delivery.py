"""JSON-lines delivery, completeness, run summary, and catalogs read back from storage."""

import json
import os
import re
import time
from pathlib import Path

import pytest
from conftest import CONNECTION, SF_DIR
from test_extracts import table

from lodestone.plans import extraction
from lodestone.plans.extraction import EntityStreams, extract
from lodestone.operators.feed import lineage_parse_feed, lineage_parse_feed_from_json
from lodestone.operators.entities import Stamp
from lodestone.sinks import jsonl as J
from lodestone.sources import catalog as C
from lodestone.sources.derived import DerivedCatalog
from pyspark.sql import functions as F


@pytest.fixture(scope="module")
def delivered(spark, tmp_path_factory):
    prefix = str(tmp_path_factory.mktemp("out"))
    catalog = DerivedCatalog(spark, SF_DIR, 3)
    return catalog, extract(spark, catalog, prefix)


def test_all_streams_are_delivered(spark, delivered):
    catalog, delivery = delivered
    assert delivery.prefix
    assert {k: v for k, v in delivery.lines.items()} == {
        name: df.count() for name, df in EntityStreams(catalog).items()
    }
    assert set(delivery.lines) == {"database", "schema", "table", "column", "procedure"}


def test_lines_are_entities_in_their_connection(spark, delivered):
    _, delivery = delivered
    rows = J.read_stream(spark, f"{delivery.prefix}/table").collect()
    for row in rows:
        entity = json.loads(row.value)
        assert entity["typeName"] in ("Table", "View")
        assert entity["attributes"]["connectionQualifiedName"] == row.connection_id
    assert len({r.connection_id for r in rows}) == 3


def test_feed_from_delivered_lines_equals_feed_from_entities(spark, delivered):
    catalog, delivery = delivered
    streams = EntityStreams(catalog)
    lines = J.read_stream(spark, f"{delivery.prefix}/table").union(J.read_stream(spark, f"{delivery.prefix}/procedure"))
    from_json = lineage_parse_feed_from_json(lines)
    direct = lineage_parse_feed(streams["table"], streams["procedure"])
    assert from_json.exceptAll(direct).isEmpty() and direct.exceptAll(from_json).isEmpty()
    assert direct.count() > 100


def test_a_missing_stream_is_refused(spark, delivered, tmp_path):
    catalog, _ = delivered
    streams = dict(EntityStreams(catalog))
    del streams["procedure"]
    with pytest.raises(J.IncompleteDeliveryError, match="procedure"):
        J.deliver(spark, streams, str(tmp_path))


def test_lost_lines_are_noticed(spark, delivered, tmp_path, monkeypatch):
    catalog, _ = delivered
    write = J.write_stream
    monkeypatch.setattr(J, "write_stream", lambda df, target: write(df, target) + 1)
    with pytest.raises(J.IncompleteDeliveryError, match="database"):
        J.deliver(spark, EntityStreams(catalog), str(tmp_path))


def test_connections_that_differ_in_a_mark_stay_apart(spark, make_catalog, tmp_path):
    names = ["default/mysql/1", "default/mysql_1", "default_mysql/1", "default mysql=1%2F"]
    for n, name in enumerate(names):
        rows = make_catalog(name, connections=[{}], schemata=[{"schema_name": "s"}] * (n + 1))
        entities = EntityStreams(rows)["schema"]
        both = entities if n == 0 else both.unionByName(entities)
    J.write_stream(both, str(tmp_path))
    assert J.landed_lines(spark, str(tmp_path))[0] == {name: n + 1 for n, name in enumerate(names)}


def test_an_emptied_stream_is_noticed(spark, delivered, tmp_path):
    catalog, _ = delivered
    streams = dict(EntityStreams(catalog))
    for name in ("column", "table", "schema", "database"):
        emptied = {**streams, name: streams[name].limit(0)}
        with pytest.raises(J.IncompleteDeliveryError, match=f"{name} of default/mysql/1"):
            J.deliver(spark, emptied, str(tmp_path / name))
    one_lost = {**streams, "column": streams["column"].where("connection_qn <> 'default/mysql/2'")}
    with pytest.raises(J.IncompleteDeliveryError, match="column of default/mysql/2$"):
        J.deliver(spark, one_lost, str(tmp_path / "one"))
    no_procedures = {**streams, "procedure": streams["procedure"].limit(0)}
    delivery = J.deliver(spark, no_procedures, str(tmp_path / "some"))
    assert delivery.prefix and delivery.stream_prefix("procedure") == "" and delivery.stream_prefix("table")
    assert set(delivery.by_connection["table"]) == {"default/mysql/1", "default/mysql/2", "default/mysql/3"}


def test_nothing_delivered_gives_an_empty_prefix(spark, make_catalog, tmp_path):
    delivery = extract(spark, make_catalog(connections=[]), str(tmp_path))
    assert delivery.prefix == "" and set(delivery.lines.values()) == {0}
    summary = J.run_summary(CONNECTION, "base", delivery)
    assert summary.transformed_data_prefix == "" and summary.view_lineage_output_prefix == "base/view_lineage"


def test_summary_is_one_row_of_nine_texts(spark):
    df = J.summary_frame(spark, J.run_summary(CONNECTION, "base", J.Delivery("p", {"table": 1}), "bucket"))
    assert len(df.columns) == 9 and {t for _, t in df.dtypes} == {"string"}
    row = df.first()
    assert (row.connection_qualified_name, row.transformed_data_prefix, row.storage_bucket) == (CONNECTION, "p", "bucket")


@pytest.mark.parametrize(("advisory", "split"), [("2KB", True), ("64MB", False)])
def test_large_connections_are_split_small_ones_are_not_and_rows_are_in_order(spark, conf, tmp_path, advisory, split):
    conf(
        spark__sql__adaptive__advisoryPartitionSizeInBytes=advisory,
        spark__sql__adaptive__coalescePartitions__enabled="false",
    )
    stamp = Stamp(connection_name=F.concat(F.lit("name of "), "connection_qn"))
    column = EntityStreams(DerivedCatalog(spark, SF_DIR, 3), stamp=stamp, for_writing=True)["column"]
    assert J.write_stream(column, str(tmp_path)) == 3301
    for n in (1, 2, 3):
        parts = list(tmp_path.glob(f"connection_id=default%2Fmysql%2F{n}/*.txt"))
        assert (len(parts) > 1) is split
        for part in parts:
            attributes = [json.loads(line)["attributes"] for line in part.read_text().splitlines()]
            places = [(a["schemaName"], a.get("tableName") or a["viewName"], a["order"]) for a in attributes]
            assert places == sorted(places)
            assert {a["connectionName"] for a in attributes} == {f"name of default/mysql/{n}"}


def test_parquet_catalog_round_trip(spark, delivered, tmp_path):
    catalog, _ = delivered
    C.write_parquet_catalog(catalog, str(tmp_path))
    again = C.read_parquet_catalog(spark, str(tmp_path))
    for name, schema in C.RELATION_SCHEMAS.items():
        df = getattr(again, name)
        assert df.schema.fieldNames() == schema.fieldNames() and df.dtypes == getattr(catalog, name).dtypes
        assert df.count() == getattr(catalog, name).count()


def test_a_missing_relation_is_named(make_catalog):
    with pytest.raises(ValueError, match="columns"):
        C.catalog_from({"tables": None})


def test_jdbc_options():
    settings = {"username": "u", "password": "p", "host": "h", "port": "3306"}
    options = C.jdbc_options(settings)
    assert options["url"] == "jdbc:mysql://h:3306/"
    assert (options["connectTimeout"], options["user"]) == ("5000", "u")
    with pytest.raises(ValueError, match="host"):
        C.jdbc_options({**settings, "host": ""})
    assert C.schema_predicates(["a", "o'b"]) == ["TABLE_SCHEMA = 'a'", "TABLE_SCHEMA = 'o''b'"]


# ---- a delivery as one commit -------------------------------------------------------------------------------


def test_a_delivery_that_fails_leaves_the_last_one_whole(spark, delivered, tmp_path, monkeypatch):
    catalog, _ = delivered
    streams = dict(EntityStreams(catalog))
    first = J.deliver(spark, streams, str(tmp_path))
    write, written = J.write_stream, []

    def failing(df, target):
        if len(written) == after:
            raise OSError("the disk is gone")
        written.append(target)
        return write(df, target)

    monkeypatch.setattr(J, "write_stream", failing)
    for after in range(len(streams)):
        written.clear()
        with pytest.raises(OSError, match="gone"):
            J.deliver(spark, {**streams, "schema": streams["schema"].limit(3)}, str(tmp_path))
        assert len(written) == after
        assert J.current_delivery(spark, str(tmp_path)) == first
    assert J.damaged_files(spark, first).isEmpty()
    monkeypatch.setattr(J, "write_stream", write)
    second = J.deliver(spark, {**streams, "procedure": streams["procedure"].limit(2)}, str(tmp_path))
    assert J.current_delivery(spark, str(tmp_path)) == second != first and second.lines["procedure"] == 2
    assert J.damaged_files(spark, first).isEmpty()


def local(name):
    """The path of a file as Spark names it; what is escaped in a directory's name stays so."""
    return re.sub("^file:/+", "/", name).replace("%25", "%")


def test_files_tell_what_was_done_to_them(spark, delivered, tmp_path):
    catalog, _ = delivered
    delivery = J.deliver(spark, EntityStreams(catalog), str(tmp_path))
    files = {r.file: r for r in J.delivered_files(spark, delivery).collect()}
    for name, row in files.items():
        text = open(local(name)).read()
        assert (row.lines, row.bytes) == (text.count("\n"), len(text.encode()))
    by_stream = {}
    for row in files.values():
        by_stream.setdefault(row.stream, []).append(local(row.file))
    changed, lost, copied = by_stream["table"][0], by_stream["schema"][0], by_stream["column"][0]
    lines = open(changed).read().splitlines()
    # The same number of bytes, and as many lines: the first two have changed places, one has another letter.
    lines[0], lines[1], lines[2] = lines[1], lines[0], lines[2].replace("ACTIVE", "ACTIVF")
    open(changed, "w").write("\n".join(lines) + "\n")
    text = open(lost).read()
    os.remove(lost)
    # What a task that ran twice would leave.
    open(copied.replace("part-", "part-9"), "w").write(open(copied).read())
    for folder in {os.path.dirname(f) for f in (changed, lost, copied)}:
        for name in os.listdir(folder):
            if name.endswith(".crc"):
                os.remove(f"{folder}/{name}")
    found = {(r.stream, r.damage) for r in J.damaged_files(spark, delivery).collect()}
    assert text and found == {("table", "changed"), ("schema", "lost"), ("column", "added")}


def test_an_empty_delivery_is_not_published(spark, make_catalog, delivered, tmp_path):
    catalog, _ = delivered
    first = extract(spark, catalog, str(tmp_path))
    assert extract(spark, make_catalog(connections=[]), str(tmp_path)).prefix == ""
    assert J.current_delivery(spark, str(tmp_path)).prefix == first.prefix
    assert J.current_delivery(spark, str(tmp_path / "none")) is None


def test_only_the_table_stream_is_searched(spark, delivered):
    _, delivery = delivered
    plans = {name: J.landed_files(spark, f"{delivery.prefix}/{name}")._jdf.queryExecution().optimizedPlan().toString() for name in delivery.lines}
    assert not any("get_json_object" in plan for plan in plans.values())
    assert J.landed_lines(spark, f"{delivery.prefix}/table")[1] == {f"default/mysql/{n}" for n in (1, 2, 3)}


def test_a_faulty_delivery_is_not_published(spark, make_catalog, tmp_path):
    catalog = make_catalog("default/mysql/1", schemata=[{"schema_name": "s"}], tables=[table("t", schema="s")])
    streams = dict(EntityStreams(catalog))
    sound = J.deliver(spark, streams, str(tmp_path), checked_as=("mysql", "default"))
    assert sound.lines == {"database": 1, "schema": 1, "table": 1, "column": 0, "procedure": 0}
    faulty = streams["table"].withColumn("attributes", F.col("attributes").withField("description", F.lit(None).cast("string")))
    with pytest.raises(J.FaultyDeliveryError, match="1 things wrong in stream table"):
        J.deliver(spark, {**streams, "table": faulty}, str(tmp_path), checked_as=("mysql", "default"))
    with pytest.raises(J.FaultyDeliveryError, match="database, .* schema, .* table"):
        J.deliver(spark, streams, str(tmp_path), checked_as=("mysql", "other"))
    assert J.current_delivery(spark, str(tmp_path)) == sound


# ---- compressed deliveries ----------------------------------------------------------------------------------


def test_an_extraction_is_stored_compressed_and_its_list_tells_the_bytes_of_its_lines(spark, make_catalog, tmp_path):
    tables = [table(f"t{n}", schema="s", table_comment="é" * 20) for n in range(300)]
    catalog = make_catalog("default/mysql/1", schemata=[{"schema_name": "s"}], tables=tables)
    plain = J.deliver(spark, EntityStreams(catalog), str(tmp_path / "plain"))
    packed = extract(spark, catalog, str(tmp_path / "packed"))
    assert packed.lines == plain.lines and packed.lines["table"] == 300
    lines = [sorted(r.value for r in J.read_stream(spark, f"{d.prefix}/table").collect()) for d in (plain, packed)]
    assert lines[0] == lines[1]
    told = {
        r.stream: r for r in J.delivered_files(spark, packed).groupBy("stream").agg(F.sum("bytes").alias("bytes"), F.sum("stored_bytes").alias("stored")).collect()
    }
    assert told["table"].bytes == sum(len(line.encode()) + 1 for line in lines[0])
    assert told["table"].stored * 5 < told["table"].bytes
    assert not list((tmp_path / "packed").rglob("part-*.txt")) and list((tmp_path / "packed").rglob("part-*.txt.gz"))
    assert J.damaged_files(spark, packed).isEmpty() and J.damaged_files(spark, plain).isEmpty()


# ---- deliveries in parts ------------------------------------------------------------------------------------


def shuffle_files(spark):
    folders = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirsString()
    return {path.name for folder in folders for path in Path(folder).rglob("shuffle_*.data")}


def test_a_large_extraction_is_made_in_parts_whose_shuffle_files_go(spark, delivered, tmp_path, monkeypatch):
    catalog, whole = delivered
    monkeypatch.setattr(extraction, "PART_COLUMNS", catalog.columns.count() // 3 + 1)
    write, wrote, setting = J.write_stream, [], spark.conf.get("spark.sql.classic.shuffleDependency.fileCleanup.enabled", None)

    def watched(entities, target, *how, **more):
        before = shuffle_files(spark)
        n = write(entities, target, *how, **more)
        until = time.time() + 10
        while (left := shuffle_files(spark) - before) and time.time() < until:
            time.sleep(0.1)
        wrote.append((target.rsplit("/", 1)[1], n))
        assert not left, target
        return n

    monkeypatch.setattr(J, "write_stream", watched)
    delivery = extract(spark, catalog, str(tmp_path))
    assert [name for name, _ in wrote] == ["database", "schema", *["table"] * 3, *["column"] * 3, "procedure"]
    assert max(n for name, n in wrote if name == "column") < whole.lines["column"] / 2
    assert spark.conf.get("spark.sql.classic.shuffleDependency.fileCleanup.enabled", None) == setting
    assert (delivery.lines, delivery.by_connection) == (whole.lines, whole.by_connection)
    for name in whole.lines:
        lines = [sorted((r.connection_id, r.value) for r in J.read_stream(spark, f"{d.prefix}/{name}").collect()) for d in (whole, delivery)]
        assert lines[0] == lines[1]
    assert J.damaged_files(spark, delivery).isEmpty()


@pytest.mark.parametrize("own", [True, False])
def test_the_parts_of_a_catalog_hold_each_of_its_rows_once(spark, own):
    catalog = DerivedCatalog(spark, SF_DIR, 3)
    whole = catalog if own else C.catalog_from({name: getattr(catalog, name) for name in C.RELATION_SCHEMAS})
    parts = [C.part_of(whole, n, 4) for n in range(4)]
    names = [{r.table_name for r in part.tables.select("table_name").collect()} for part in parts]
    assert all(names) and sum(map(len, names)) == catalog.tables.select("table_name").distinct().count()
    for name, schema in C.RELATION_SCHEMAS.items():
        row = F.xxhash64(*schema.fieldNames()).cast("decimal(38,0)")
        found = [part.agg(F.count("*"), F.coalesce(F.sum(row), F.lit(0))).first() for part in (*(getattr(p, name) for p in parts), getattr(whole, name))]
        if "table_name" in schema.fieldNames():
            assert tuple(map(sum, zip(*found[:-1]))) == found[-1], name
        else:
            assert all(part == found[-1] for part in found), name


def test_rows_without_a_table_name_are_in_one_part(make_catalog):
    catalog = make_catalog(columns=[{"column_name": c, "table_name": t} for c, t in (("a", None), ("b", None), ("c", "t"))])
    counts = [C.part_of(catalog, n, 3).columns.where("table_name is null").count() for n in range(3)]
    assert sorted(counts) == [0, 0, 2]
    assert C.part_of(catalog, 0, 1) is catalog


def test_checks_of_a_stream_in_parts_are_added_up(spark, make_catalog, tmp_path):
    catalog = make_catalog("default/mysql/1", schemata=[{"schema_name": "s"}], tables=[table(t, schema="s") for t in "abc"])
    streams = dict(EntityStreams(catalog))
    name = F.col("attributes.name")
    parts = [streams["table"].where(name == "a"), streams["table"].where(name == "z"), streams["table"].where(name > "a")]
    sound = J.deliver(spark, {**streams, "table": parts}, str(tmp_path), checked_as=("mysql", "default"))
    assert sound.lines["table"] == 3 and sound.by_connection["table"] == {"default/mysql/1": 3}
    faulty = [p.withColumn("attributes", F.col("attributes").withField("description", F.lit(None).cast("string"))) for p in parts]
    with pytest.raises(J.FaultyDeliveryError, match="3 things wrong in stream table"):
        J.deliver(spark, {**streams, "table": faulty}, str(tmp_path), checked_as=("mysql", "default"))
