"""Chats and archives: exact round trips."""

import gzip
import hashlib
import io

import pytest

from sitewise.llm import chat, warc
from sitewise.session import workdir


def test_fold_of_deltas_edits_and_regenerations(spark):
    log = [
        (1, 0, 1, "user", 0, "delta", "Hel"), (1, 0, 1, "user", 1, "delta", "lo"), (1, 0, 1, "user", 600, "edit", "Hi"),
        (1, 0, 1, "user", 1200, "delta", " there"), (1, 1, 1, "assistant", 2, "delta", "no"), (1, 1, 1, "assistant", 3, "regenerate", None),
        (1, 1, 1, "assistant", 4, "delta", "a <|im_end|> b"), (1, 1, 1, "assistant", 5, "delta", None), (None, None, 1, None, 0, "delta", "x"),
    ]
    events = spark.createDataFrame([(*r, "x") for r in log], "conv_id long, position long, message int, role string, seq long, kind string, text string, turns string")
    blocks = {r.conv_id: r for r in chat.read_back(chat.format_chats(events)).collect()}
    assert [tuple(t) for t in blocks[1].turns] == [("user", "Hi there"), ("assistant", "a <|im_end|> b")]
    assert blocks[1].loss_text == "a <|im_end|> b" and blocks[1].formatted.count("<|im_end|>") == 2
    assert [tuple(t) for t in blocks[None].turns] == [("", "x")]
    assert chat.format_chats(events.limit(0)).count() == 0


@pytest.mark.parametrize("text", ["<|", "<\\|", "<\\\\|x<|", "<|im_start|>user\nhi<|im_end|>\n", "", "\\n", "<<||"])
def test_chat_round_trip(spark, text):
    rows = [(1, i, role, text) for i, role in enumerate(["sys\ntem\\n\\", "assistant", None, "assistant", "assistant"])] + [(1, 300, "user", None), (1, 4, "assistant", text)]
    chats = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    blocks = sorted(chat.read_back(chat.format_chats(chat.as_events(chats))).collect(), key=lambda r: r.block)
    turns = [tuple(t) for b in blocks for t in b.turns]
    assert sorted(turns) == sorted((role or "", t or "") for _, _, role, t in rows)
    assert "".join(b.loss_text for b in blocks) == text * 4


@pytest.mark.parametrize("role", ["a\0\1b", "a\\", "\\n", "\\\\n\n\\", "<|\\|<\\|\n", "<\\n|"])
def test_roles_round_trip(spark, role):
    chats = spark.createDataFrame([(1, 0, role, "x")], "conv_id long, turn long, role string, text string")
    (block,) = chat.read_back(chat.format_chats(chat.as_events(chats))).collect()
    assert [tuple(t) for t in block.turns] == [(role, "x")]


def test_archives_keep_large_ids(spark):
    big, ids = "p" * 1_000, [2**60 + 3, 2**60 + 1, None, 2**53 + 1, -(2**60) - 1]
    pages = spark.createDataFrame([(i, "u", big) for i in ids], "page_id long, url string, html string")
    rows = warc.read_archives(warc.write_archives(warc.with_revisits(pages), workdir(spark, "warc"))).collect()
    assert {(r.page_id, r.refers_to) for r in rows} == {(i, 2**60 + 3 if k else None) for k, i in enumerate(ids)}


def test_archives(spark, tmp_path):
    big = "é<p>" * 400
    rows = [(1, "http://a/\r\nx y", big), (5, "u", big), (3, None, big), (None, "u", big), (7, "u", "small"), (8, "u", "small"), (9, "u", None), (-4, "é", "")]
    pages = spark.createDataFrame([(*r, "x") for r in rows], "page_id long, url string, html string, payload string")
    archives = warc.write_archives(warc.with_revisits(pages), workdir(spark, "warc"))
    got = {r.page_id: r for r in warc.read_archives(archives).collect()}
    assert len(got) == len(rows)
    for page, _, html in rows:
        data = (html or "").encode()
        r = got[page]
        assert (r.payload_bytes, r.payload_digest) == (len(data), hashlib.sha1(data).hexdigest())
        revisit = page in (1, 3, None)
        assert (r.record_type, r.refers_to) == (("revisit", 5) if revisit else ("response", None))
        assert r.payload == (None if revisit else data)
    assert warc.read_archives(warc.write_archives(warc.with_revisits(pages.limit(0)), workdir(spark, "warc"))).count() == 0


def test_reader_checks():
    one, two = warc.record(1, "u", b"x" * 200_000, None), warc.record(2, "u", b"\r\n\r\n", None)
    assert [r["page_id"] for r in warc.read_records(io.BytesIO(one + two))] == [1, 2]
    plain = gzip.decompress(two)
    for broken in (plain.replace(b"\r\n\r\n\r\n\r\n", b"\r\nx\n\r\n\r\n"), plain[:-2], plain + b"x"):
        with pytest.raises(ValueError):
            list(warc.read_records(io.BytesIO(gzip.compress(broken))))
    with pytest.raises(ValueError):
        list(warc.read_records(io.BytesIO(one[:-20])))
