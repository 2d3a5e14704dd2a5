"""Sequences that go on: ranges of keys leased to loads, kept with the data.

``root/<sequence>/<n>`` is the n-th lease: which load it was given to, its first key and how many.
A lease is taken before a load is numbered, by making its file where none may be yet: of two loads at a
time one makes it, the other tries the next. So no key is given twice, and a load that is run again finds its
lease and numbers its rows as before. Keys of a load that fails for good stay unused.
"""

from __future__ import annotations

import json
import threading
import time
from collections.abc import Sequence
from dataclasses import dataclass

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession

from sitewise.functions.prefix import HOT_ROWS
from sitewise.session import settle
from sitewise.sources.keys import assign_surrogate_key


WAIT = 30.0  # seconds that another load's lease may take to be written
# Shared stores make a file where there is none in one step; a local folder, as in tests, does not.
_one_at_a_time = threading.Lock()


@dataclass(frozen=True)
class Lease:
    """``rows`` keys from ``first`` on, ``step`` apart."""

    load: str
    first: int
    rows: int
    step: int = 1

    @property
    def after(self) -> int:
        return self.first + self.rows * self.step


class Unfinished(ValueError):
    """A lease whose file has been made, but not written yet."""


def _folder(spark: SparkSession, root: str, name: str):
    path = spark._jvm.org.apache.hadoop.fs.Path(f"{root}/{name}")
    return path.getFileSystem(spark._jsc.hadoopConfiguration()), path


def leases(spark: SparkSession, root: str, name: str) -> list[Lease]:
    """All leases of a sequence, in order: one for each load."""
    files, path = _folder(spark, root, name)
    if not files.exists(path):
        return []
    found = {}
    for status in files.listStatus(path):
        place = status.getPath()
        if not place.getName().isdigit():
            continue
        stream = files.open(place)
        try:
            text = bytes(stream.readNBytes(1 << 16)).decode()
        finally:
            stream.close()
        if not text.endswith("}"):
            raise Unfinished(f"lease {place} is being written, or was left so by a load that failed: then remove it")
        found[int(place.getName())] = Lease(**json.loads(text))
    return [found[n] for n in sorted(found)]


def lease(spark: SparkSession, root: str, name: str, load: str, rows: int, start: int = 1, step: int = 1) -> Lease:
    """The load's range of keys: the one it has, or the next. A load that comes again must have as many rows."""
    files, path = _folder(spark, root, name)
    until = time.monotonic() + WAIT
    while True:
        try:
            given = leases(spark, root, name)
        except Unfinished:
            if time.monotonic() > until:
                raise
            time.sleep(0.1)
            continue
        for held in given:
            if held.load == load:
                if held.rows != rows:
                    raise ValueError(f"load {load} was given {held.rows} keys of {name} and now has {rows} rows")
                return held
        mine = Lease(load, given[-1].after if given else start, rows, given[-1].step if given else step)
        try:
            with _one_at_a_time:
                stream = files.create(spark._jvm.org.apache.hadoop.fs.Path(path, f"{len(given):09d}"), False)
        except Py4JJavaError as taken:  # another load was faster
            if "AlreadyExists" not in taken.java_exception.getClass().getName():
                raise
            continue
        try:
            stream.write(bytearray(json.dumps(vars(mine)).encode()))
        finally:
            stream.close()
        return mine


def number_load(
    df: DataFrame, root: str, name: str, load: str, order_by: Sequence[str], key: str, start: int = 1, step: int = 1, hot_rows: int = HOT_ROWS
) -> DataFrame:
    """The rows with ``key`` from the sequence, in order. ``order_by`` must rank the rows fully, so that a load that
    is run again numbers them alike. The keys go on after all loads before, whichever those were."""
    rows = settle(df)
    given = lease(df.sparkSession, root, name, load, rows.count(), start, step)
    numbered = assign_surrogate_key(rows, [], order_by, key, start=0, hot_rows=hot_rows)
    return numbered.withColumn(key, numbered[key] * given.step + given.first)
