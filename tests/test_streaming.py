"""Change feeds as streams."""

import datetime as dt
import os
import shutil
from pathlib import Path

import pytest
from pyspark.errors import AnalysisException, StreamingQueryException
from pyspark.sql import functions as F
from store import change, feed, keys_at, line
from test_parts import small_store

from sitewise.operators import fragments as FR
from sitewise.operators.changes import route_changes
from sitewise.operators.maintain import apply_batch
from sitewise.rules import by_query
from sitewise.sources import snapshots
from sitewise.sources.snapshots import last_version
from sitewise.streaming import feed as ST
from sitewise.streaming import ordered as OR

RULE = by_query()


def rows():
    return [
        change(1, "U", line(1, 1, 1, 150, "0.10"), line(1, 1, 1, 160, "0.10")),
        change(2, "D", line(2, 1, 2, 60, "0.50"), None),
        change(3, "I", None, line(8, 3, 2, 75, "0.00")),
        change(4, "U", line(4, 3, 1, 150, "0.10"), line(4, 3, 2, 150, "0.10")),
        change(5, "I", None, line(9, 4, 1, 150, "-0.10")),  # refused
        change(6, "U", line(7, 4, 1, 101, "0.00"), line(7, 4, 1, 100, "0.00")),
        change(7, "D", line(5, 4, 3, 150, "0.10"), None),
    ]


@pytest.fixture()
def feed_dir(spark, tmp_path):
    path = str(tmp_path / "feed")
    for part in (rows()[:3], rows()[3:5], rows()[5:]):
        feed(spark, part).coalesce(1).write.mode("append").parquet(path)
    return path


def test_routed_stream_equals_batch(spark, tmp_path, feed_dir):
    products = small_store(spark)["produits"]
    sink = str(tmp_path / "actions")
    for _ in range(2):  # a second run of a finished stream adds nothing
        ST.drain(ST.stream_route(ST.read_feed(spark, feed_dir), products, RULE, sink, str(tmp_path / "cp")))
    expected = route_changes(feed(spark, rows()), products, RULE)
    got = spark.read.parquet(sink)
    assert got.count() == expected.count() > 0
    assert got.exceptAll(expected.select(*got.columns)).isEmpty()


def test_applied_stream_equals_batch(spark, tmp_path, feed_dir):
    tables = small_store(spark)
    root, checkpoint = str(tmp_path / "store"), str(tmp_path / "cp")
    ST.begin(root, tables, RULE)
    for _ in range(2):
        ST.drain(ST.stream_apply(ST.read_feed(spark, feed_dir), root, tables, RULE, checkpoint))
    after, frags, rejected = apply_batch(tables, FR.derive(tables, RULE), feed(spark, rows()), RULE)
    streamed, sites = ST.state(spark, root, tables)
    end = keys_at(sites)
    assert end == keys_at(frags)
    assert streamed["lignes_commandes"].exceptAll(after["lignes_commandes"]).isEmpty()
    assert streamed["lignes_commandes"].count() == after["lignes_commandes"].count()
    refused = [(r.seq, r.error_code) for r in ST.rejected_changes(spark, root).collect()]
    assert refused == [(r.seq, r.error_code) for r in rejected.collect()] == [(5, -20001)]

    # A batch that is run again gives the same version again.
    before = keys_at(ST.state(spark, root, tables, 1)[1])
    ST.apply_version(spark.read.schema(feed(spark, []).schema).parquet(feed_dir).where("seq <= 3"), root, tables, RULE, 0)
    assert keys_at(ST.state(spark, root, tables, 1)[1]) == before

    # A whole version in between changes nothing, and a new stream goes on from it.
    version = ST.make_whole(spark, root, tables)
    assert keys_at(ST.state(spark, root, tables, version)[1]) == end
    more = str(tmp_path / "more")
    feed(spark, [change(8, "I", None, line(10, 2, 1, 120, "0.00"))]).write.parquet(more)
    ST.drain(ST.stream_apply(ST.read_feed(spark, more), root, tables, RULE, str(tmp_path / "cp2")))
    assert (1, 10) in {row[:2] for row in keys_at(ST.state(spark, root, tables)[1])["lignes_commandes"]}

    # So does the first stream itself, on its own checkpoint: nothing is skipped.
    version = ST.make_whole(spark, root, tables)
    feed(spark, [change(9, "I", None, line(11, 2, 1, 130, "0.00"))]).coalesce(1).write.mode("append").parquet(feed_dir)
    for _ in range(2):
        ST.drain(ST.stream_apply(ST.read_feed(spark, feed_dir), root, tables, RULE, checkpoint))
    assert last_version(spark, f"{root}/sites") == version + 1
    assert (1, 11) in {row[:2] for row in keys_at(ST.state(spark, root, tables)[1])["lignes_commandes"]}

    # A part of a version that is gone is an error, not an older table.
    shutil.rmtree(f"{root}/sites/added/lignes_commandes/v={version + 1}")
    with pytest.raises(AnalysisException):
        ST.state(spark, root, tables)


def test_a_feed_out_of_order_fails(spark, tmp_path, feed_dir):
    files = sorted(Path(feed_dir).glob("*.parquet"), key=lambda f: f.stat().st_mtime)
    for age, file in enumerate(files):
        os.utime(file, (1_700_000_000 - 60 * age,) * 2)
    tables, root = small_store(spark), str(tmp_path / "store")
    ST.begin(root, tables, RULE)
    with pytest.raises(StreamingQueryException, match="has been applied"):
        ST.drain(ST.stream_apply(ST.read_feed(spark, feed_dir), root, tables, RULE, str(tmp_path / "cp")))


def test_a_new_checkpoint_at_an_old_path_is_a_new_stream(spark, tmp_path):
    """Its batch 0 is not the batch 0 of the stream before: nothing is taken for applied."""
    tables, root, checkpoint = small_store(spark), str(tmp_path / "store"), str(tmp_path / "cp")
    ST.begin(root, tables, RULE)
    for seq, i in ((1, 21), (5, 25)):
        path = str(tmp_path / f"feed{seq}")
        feed(spark, [change(seq, "I", None, line(i, 2, 1, 130, "0.00"))]).coalesce(1).write.parquet(path)
        ST.drain(ST.stream_apply(ST.read_feed(spark, path), root, tables, RULE, checkpoint))
        assert (1, i) in {row[:2] for row in keys_at(ST.state(spark, root, tables)[1])["lignes_commandes"]}
        shutil.rmtree(checkpoint)
    # The same changes under a new stream reach below what has been applied.
    with pytest.raises(StreamingQueryException, match="has been applied"):
        ST.drain(ST.stream_apply(ST.read_feed(spark, path), root, tables, RULE, checkpoint))


def test_a_version_has_one_writer(spark, tmp_path):
    tables, root = small_store(spark), str(tmp_path / "store")
    ST.begin(root, tables, RULE)
    one = feed(spark, [change(1, "I", None, line(21, 2, 1, 130, "0.00"))])
    for note in (snapshots.Note("a", 0, 1, 1), snapshots.Note("a", 0, 1, 1)):
        ST.apply_version(one, root, tables, RULE, 0, note=note)
    with pytest.raises(ValueError, match="another writer"):
        ST.apply_version(one, root, tables, RULE, 0, note=snapshots.Note("b", 0, 1, 1))
    with pytest.raises(ValueError, match="was applied with seq 1 to 1"):
        snapshots.applied(spark, f"{root}/sites", snapshots.Note("a", 0, 2, 1))


def test_whole_versions_in_between(spark, tmp_path, feed_dir):
    tables = small_store(spark)
    ends = []
    for every in (1, 50):
        root = str(tmp_path / f"store{every}")
        ST.begin(root, tables, RULE)
        ST.drain(ST.stream_apply(ST.read_feed(spark, feed_dir), root, tables, RULE, str(tmp_path / f"cp{every}"), whole_every=every))
        ends.append(keys_at(ST.state(spark, root, tables)[1]))
    assert ends[0] == ends[1]


def timed(spark, path, changes, age):
    """A file of changes made one minute apart, by seq, that the source takes ``age`` files after the first."""
    start = dt.datetime(2026, 3, 1, tzinfo=dt.timezone.utc)
    at = F.timestamp_seconds(F.lit(int(start.timestamp())) + 60 * F.col("seq"))
    rows = feed(spark, changes).withColumn("at", at) if changes else OR.clock_rows(spark, start + dt.timedelta(days=30))
    before = set(Path(path).glob("*.parquet"))
    rows.coalesce(1).write.mode("append").parquet(path)
    (new,) = set(Path(path).glob("*.parquet")) - before
    os.utime(new, (1_700_000_000 + 60 * age,) * 2)


def test_changes_out_of_order_find_their_place(spark, tmp_path):
    path, root = str(tmp_path / "feed"), str(tmp_path / "store")
    late = [change(2, "U", None, line(3, 2, 1, 77, "0.10"))]
    # Reversed files; then a change that comes long after the clock has passed it, then the end.
    for age, part in enumerate((rows()[5:], rows()[3:5], [c for c in rows()[:3] if c["seq"] != 2], [change(40, "I", None, line(12, 2, 1, 120, "0"))], [], late)):
        timed(spark, path, part, age)
    tables = small_store(spark)
    ST.begin(root, tables, RULE)
    for _ in range(2):
        query = OR.stream_apply_ordered(OR.read_timed_feed(spark, path), root, tables, RULE, str(tmp_path / "cp"), dt.timedelta(minutes=10))
        ST.drain(query)
    in_time = [c for c in rows() if c["seq"] != 2] + [change(40, "I", None, line(12, 2, 1, 120, "0"))]
    after, frags, rejected = apply_batch(tables, FR.derive(tables, RULE), feed(spark, in_time), RULE)
    streamed, sites = ST.state(spark, root, tables)
    assert keys_at(sites) == keys_at(frags)
    assert sorted(map(tuple, streamed["lignes_commandes"].collect())) == sorted(map(tuple, after["lignes_commandes"].collect()))
    assert [r.seq for r in ST.rejected_changes(spark, root).collect()] == [r.seq for r in rejected.collect()]
    assert [(r.seq, r.new_quantite) for r in OR.late_changes(spark, root).collect()] == [(2, 77)]
