"""Line dedup against a plain count, however the rows are cut into batches."""

import random
from collections import defaultdict

import pytest

from sitewise.llm import lines

BLANKS = " \t\n\x0b\x0c\r"
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def plain(rows, min_docs, min_chars):
    """Kept text of each row."""
    holders = defaultdict(set)
    for i, (_, text) in enumerate(rows):
        for line in (text or "").split("\n"):
            holders[line.strip(BLANKS).translate(LOWER)].add(i)
    order = lambda d: (d is not None, d or 0)
    last = {k: max((rows[i][0] for i in v), key=order) for k, v in holders.items() if len(v) >= min_docs and len(k) >= min_chars}
    out = []
    for doc_id, text in rows:
        own = (text or "").split("\n")
        keys = [line.strip(BLANKS).translate(LOWER) for line in own]
        stay = [line for line, k in zip(own, keys, strict=True) if k not in last or last[k] == doc_id]
        out.append((doc_id, len(own), len(own) - len(stay), "\n".join(stay)))
    return sorted(out, key=repr)


def kept(docs, **options):
    return sorted((tuple(r) for r in lines.drop_repeated_lines(docs, **options).collect()), key=repr)


@pytest.fixture(scope="module")
def rows():
    rnd = random.Random(4)
    pool = [f"{'Ä' * (i % 3)} Shared line number {i} Of The Site {'x' * (i % 5)}" for i in range(30)]
    out = []
    for i in range(120):
        own = [rnd.choice(["", " ", "\t", "\r"]) + rnd.choice([str.upper, str])(rnd.choice(pool)) + rnd.choice(["", "  ", "\x0b"]) for _ in range(rnd.randint(0, 6))]
        own += [f"own line {i} {rnd.random()}", "short", "", own[0] if own else "é" * 39]
        rnd.shuffle(own)
        out.append((i // 2 if rnd.random() < 0.9 else None, "\n".join(own)))
    return [*out, *out[:7], (3, None), (None, None), (4, ""), (500, "\n\n"), (501, "É" * 40 + "\n" + "É" * 39)] + [(510 + i, "É" * 40) for i in range(6)]


@pytest.mark.parametrize("batches", [1, 4, 11])
def test_against_a_plain_count(spark, rows, batches, monkeypatch):
    monkeypatch.setattr(lines, "FANOUT", 2 if batches == 11 else 3)
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    want = plain(rows, 5, 25)
    assert kept(docs, min_chars=25, batches=batches) == want
    assert sum(r[2] for r in want) > 100


def test_hard_cases(docs, none, texts):
    assert kept(docs) == plain(texts, 5, 40)
    assert kept(docs, min_docs=2, min_chars=1) == plain(texts, 2, 1)
    assert kept(none) == []


def test_runs_share_no_hash_and_lie_sorted_in_their_buckets(spark):
    h = spark.range(3_000).selectExpr("id % 100 AS doc", "unhex(md5(string(id % 700))) AS h", "id % 5 AS batch")
    index = lines.LineIndex(spark, buckets=4)
    for k in range(5):
        index.add(h.where(f"batch = {k}").select("doc", "h"))
        assert [len(level) for level in index.runs] == [[1], [2], [0, 1], [1, 1], [2, 1]][k]
        seen = [r.h for name in index.names() for r in spark.table(name).collect()]
        assert len(seen) == len(set(seen)) == h.where(f"batch <= {k}").select("h").distinct().count()
    with index._as_they_lie():
        name = index.names()[0]
        joined = spark.table(name).join(spark.table(index.names()[1]).hint("merge"), "h", "left_anti")
        plan = joined._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Sort [" not in plan and "SortMergeJoin" in plan
    assert index.frequent(5).count() == h.groupBy("h").count().where("count >= 5").count()
    index.drop()
    assert not spark.sql("SHOW TABLES").where("tableName LIKE 'sitewise_run_%'").count()
