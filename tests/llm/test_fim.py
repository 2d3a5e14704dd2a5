"""The learned rank index against a plain scan, and the forms of fill-in-middle."""

import hashlib
import random
import re

import numpy as np
import pytest

from sitewise.llm import fim

UNIT = re.compile("[A-Za-z]+|[^A-Za-z]")
BITS = ["a", "Zq", "word", " ", "\n", "é", "😀", "1", "<", "P>", "@", "[", "`", "{", "x" * 300, "..." * 200]


def random_texts(n):
    rnd = random.Random(1)
    return ["".join(rnd.choice(BITS) for _ in range(rnd.choice([0, 0, 1, 2, 5, 40, 1500]))) for _ in range(n)]


@pytest.mark.parametrize("error", [0, 1, 7, 127])
def test_every_offset_is_found_and_every_chord_is_close(error):
    texts = random_texts(80)
    want = [[0] + [m.end() for m in UNIT.finditer(t)] for t in texts]
    index = fim.fit(texts, error, first_ranks=64)
    assert index.units.tolist() == [len(w) - 1 for w in want]
    for i, offsets in enumerate(want):
        assert index.offsets(np.full(len(offsets), i), np.arange(len(offsets))).tolist() == offsets
    assert np.abs(index.residuals.astype(int)).max() <= error


def plain(doc_id, text):
    units = UNIT.findall(text)
    digest = hashlib.sha256(f"1:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h = [int(digest[i : i + 8], 16) for i in (0, 8, 16, 24)]
    low, high = sorted(x % (len(units) + 1) for x in h[:2])
    prefix, middle, suffix = ("".join(x) for x in (units[:low], units[low:high], units[high:]))
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")) or h[2] % 100 >= 90:
        return len(units), "plain", None, None, text
    if h[3] % 100 < 20:
        return len(units), "spm", len(prefix), len(prefix + middle), f"<S>{suffix}<P>{prefix}<M>{middle}"
    return len(units), "psm", len(prefix), len(prefix + middle), f"<P>{prefix}<S>{suffix}<M>{middle}"


def test_forms_and_the_way_back(docs, none, texts, spark):
    rows = fim.restored(fim.fill_in_middle(docs)).collect()
    assert sorted(map(repr, (tuple(r) for r in rows))) == sorted(repr((d, *plain(d, t or ""), t or "")) for d, t in texts)
    assert fim.restored(fim.fill_in_middle(none)).count() == 0
    odd = [(i, t) for i, t in enumerate(["<", "<S", "a<P>b", "<P", "S><P", "<M", *random_texts(60)] * 6)]
    rows = fim.restored(fim.fill_in_middle(spark.createDataFrame(odd, "doc_id long, text string"))).collect()
    assert {(r.doc_id, r.restored) for r in rows} == set(odd) and {r.form for r in rows} == {"plain", "psm", "spm"}
