r"""Personal data: four exact patterns, and a conditional random field over word shapes.

The patterns are the base and always stay. The field labels words (runs without blanks) as
email, ip, card, phone or nothing from the shapes of the word and its neighbours, and is decoded by
Viterbi in batches. It is trained on a small labelled table (``labelled_rows``): the four kinds in
notations of and beyond the patterns, and near misses that are none of them; the corpus is not
read for it. It runs on windows of words around each word with a digit or an @ (no other word can be
labelled). A span it adds overlaps no base span.

* Null or empty text: no spans. Null ids and repeated rows: results of their own. Empty
  table: no rows; an untrained field adds nothing.
* Long runs of digits or dots cost no more than their length, except that a phone match is
  sought from every ``+``.
* Other columns are ignored by ``find``; ``redact`` carries them through.
"""

from __future__ import annotations

import hashlib
import random
import re
from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sitewise.llm.common import table
from sitewise.llm.crf import Chain

KINDS = ("email", "ip", "card", "phone")
COLUMNS = 10
AROUND = 3
REACH = 160  # code points left and right of a word in which its neighbours are sought
SHAPES = 4_096
BATCH_ROWS = 256

LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
DOMAIN = re.compile(r"[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
# A match that fails at the start of a run of digits fails in the run too: no need to look there.
IP = re.compile(r"(?<![0-9])[0-9]++(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
HINT = re.compile(r"[0-9@]+")
DIGITS = re.compile(r"[0-9]+")
RUN = regex.compile(r"([0-9]+)|(\p{Lu}+)|\p{L}+?(?=\p{Lu}|\P{L}|$)")
SAME = re.compile(r"([^\w\s])\1{3,}")
HEXES = re.compile(r"(?:[0-9A-Fa-f]{0,4}:){3,7}[0-9A-Fa-f]{0,4}")
AT = re.compile(r"\w[^\w\s]?@[^\w\s]?\w[^@\s]*\.")
BLANK = " \t\n\x0b\f\r"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def luhn(digits: str) -> bool:
    odd = sum(map(int, digits[-1::-2]))
    return (odd + sum(sum(divmod(2 * int(d), 10)) for d in digits[-2::-2])) % 10 == 0


def _emails(text: str) -> Iterator[tuple[int, int]]:
    upto, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > upto and text[start - 1] in LOCAL:
            start -= 1
        domain = DOMAIN.match(text, at + 1) if start < at else None
        if domain:
            yield start, domain.end()
            upto = domain.end()
        # After a failure the next try starts behind this @ at the earliest.
        at = text.find("@", max(at + 1, upto))


def base_spans(text: str) -> list[tuple[str, int, int]]:
    """(kind, start, stop) by start, then kind as listed."""
    found = [(a, 0, b) for a, b in _emails(text)] if "@" in text else []
    if HINT.search(text):
        found += [(m.start(), 1, m.end()) for m in IP.finditer(text) if all(len(p.lstrip("0")) <= 3 and int(p) <= 255 for p in m[0].split("."))]
        for m in CARD.finditer(text):
            digits = m[0].replace(" ", "").replace("-", "")
            if 12 <= len(digits) <= 19 and luhn(digits):
                found.append((m.start(), 2, m.end()))
        if "+" in text:
            found += [(m.start(), 3, m.end()) for m in PHONE.finditer(text) if 9 <= sum("0" <= c <= "9" for c in m[0]) <= 15]
    return [(KINDS[k], a, b) for a, k, b in sorted(found)]


def shape(word: str, longest: int = 3) -> str:
    """The whole word with letters as a or A and digits as 9, runs shortened; other characters stay."""
    out = RUN.sub(lambda m: ("9" if m[1] else "A" if m[2] else "a") * min(longest, m.end() - m.start()), word)
    return SAME.sub(lambda m: m[1] * longest, out) if len(out) > longest else out


def measure(word: str) -> str:
    """What digits and marks say apart from their notation: how many digits in how many groups, whether a card's check
    digit holds, whether four groups are octets; of a word with an @, whether letters stand around it and a dot follows."""
    if "@" in word:
        return "@." if AT.search(word) else "@"
    groups = DIGITS.findall(word)
    digits = "".join(groups)
    n = len(digits)
    check = "/ok" if 12 <= n <= 19 and luhn(digits) else ""
    octets = ("/octets" if all(len(g) <= 3 and int(g) <= 255 for g in groups) else "/no octets") if len(groups) == 4 else ""
    hexes = "/hex" if word.count(":") >= 3 and HEXES.fullmatch(word) else ""
    return f"{min(n, 20)}/{min(len(groups), 8)}{'+' * word.startswith('+')}{check}{octets}{hexes}"


_slots: dict[str, int] = {}


def _slot(form: str) -> int:
    """A slot from 1 on by a stable hash."""
    at = _slots.get(form)
    if at is None:
        if len(_slots) > 100_000:
            _slots.clear()
        at = _slots[form] = 1 + int.from_bytes(hashlib.blake2b(form.encode("utf-8", "surrogatepass"), digest_size=8).digest()) % (SHAPES - 1)
    return at


EDGE = ".,;:!?\"'<>#*%$&|"
CLOSING, OPENING = {"(": ")", "[": "]"}, {")": "(", "]": "["}


def _core(word: str) -> str:
    return word.strip(EDGE) or word


def windows(text: str) -> list[list[tuple[int, int]]]:
    """Places of the words in windows around words with a digit or @."""
    out: list[list[tuple[int, int]]] = []
    last = -1
    for hit in HINT.finditer(text):
        if hit.start() < last:
            continue
        start, stop = hit.span()
        while start > 0 and text[start - 1] not in BLANK:
            start -= 1
        more = WORD.match(text, start)
        stop = more.end() if more else stop
        last = stop
        left_from = max(0, start - REACH)
        left = [(m.start() + left_from, m.end() + left_from) for m in WORD.finditer(text[left_from:start])][-AROUND:]
        right = [(m.start() + stop, m.end() + stop) for m in WORD.finditer(text[stop : stop + REACH])][:AROUND]
        span = [*left, (start, stop), *right]
        if out and out[-1][-1][0] >= span[0][0]:
            # Both windows' words, each once; the later one has seen the shared words whole.
            own = {a for a, _ in span}
            out[-1] = [w for w in out[-1] if w[0] not in own and w[0] < start] + [w for w in span if w[0] >= out[-1][0][0]]
            out[-1].sort()
        else:
            out.append(span)
    return out


def features(text: str, places: Sequence[tuple[int, int]]) -> np.ndarray:
    """Shapes of the word, of its core and of its frame (runs as one character), what its digits say, and
    the neighbours' cores and digits."""
    words = [text[a:b] for a, b in places]
    cores = [_core(w) for w in words]
    own = [_slot(shape(w)) for w in words]
    core = np.array([_slot(shape(c)) for c in cores])
    frame = [_slot(shape(c, 1)) for c in cores]
    says = np.array([_slot(measure(c)) for c in cores])
    ids = np.zeros((len(own), COLUMNS), dtype=np.int64)
    for column, (values, ahead) in enumerate([(own, 0), (core, 0), (frame, 0), (says, 0), (core, -1), (core, 1), (core, -2), (core, 2), (says, -1), (says, 1)]):
        at = np.arange(max(0, -ahead), len(own) - max(0, ahead))
        ids[at, column] = np.asarray(values)[at + ahead] + column * SHAPES
    return ids


def word_labels(places: Sequence[tuple[int, int]], spans: Sequence[tuple[str, int, int]]) -> np.ndarray:
    labels = np.zeros(len(places), dtype=np.int64)
    for i, (a, b) in enumerate(places):
        for kind, start, stop in spans:
            if start < b and a < stop:
                labels[i] = KINDS.index(kind) + 1
    return labels


Labelled = tuple[str, Sequence[tuple[str, int, int]]]


def train(rows: Sequence[Labelled]) -> Chain | None:
    """A field from a small table of texts with labelled spans (kind, start, stop), in any order."""
    sequences, labels = [], []
    for text, spans in sorted((t or "", sorted(s)) for t, s in rows):
        for places in windows(text):
            sequences.append(features(text, places))
            labels.append(word_labels(places, [s for s in spans if s[1] < places[-1][1] and s[2] > places[0][0]]))
    return Chain.fit(sequences, labels, COLUMNS * SHAPES, len(KINDS) + 1, decay=1e-4) if sequences else None


def _card(rnd: random.Random, good: bool = True) -> str:
    while True:
        digits = str(rnd.randint(2, 6)) + "".join(str(rnd.randint(0, 9)) for _ in range(15))
        if luhn(digits) == good:
            return digits


def _word(rnd: random.Random, n: int = 3) -> str:
    return "".join(rnd.choice(SYLLABLES) for _ in range(rnd.randint(1, n)))


def _digits(rnd: random.Random, n: int) -> str:
    return "".join(str(rnd.randint(0, 9)) for _ in range(n))


def _octets(rnd: random.Random, dot: str) -> str:
    return dot.join(str(rnd.randint(0, 255)) for _ in range(4))


def _fours(digits: str, between: str) -> str:
    return between.join(digits[i : i + 4] for i in range(0, 16, 4))


SYLLABLES = "th er an in ou re de la st ion mar ko bel us ta ri ven lo".split()
# How the kinds are written: the notations of the base patterns, and others. Each makes one instance.
NOTATIONS: dict[str, dict[str, Callable[[random.Random], str]]] = {
    "email": {
        "plain": lambda r: f"{_word(r)}.{_digits(r, 2)}@{_word(r)}.org",
        "brackets": lambda r: f"{_word(r)}.{_word(r)}[@]{_word(r)}.com",
        "parentheses": lambda r: f"{_word(r)}{_digits(r, 1)}(@){_word(r)}.{_word(r, 1)}.net",
        "blanks": lambda r: f"{_word(r)}.{_word(r)} @ {_word(r)}.com",
        "accents": lambda r: f"{_word(r)}é@{_word(r)}ö.de",
    },
    "ip": {
        "plain": lambda r: _octets(r, "."),
        "brackets": lambda r: _octets(r, "[.]"),
        "parentheses": lambda r: _octets(r, "(.)"),
        "host": lambda r: f"ip-{_octets(r, '-')}",
        "version 6": lambda r: ":".join(f"{r.randint(0, 65_535):x}" for _ in range(8)),
    },
    "card": {
        "plain": _card,
        "dashes": lambda r: _fours(_card(r), "-"),
        "dots": lambda r: _fours(_card(r), "."),
        "slashes": lambda r: _fours(_card(r), "/"),
        "underscores": lambda r: _fours(_card(r), "_"),
    },
    "phone": {
        "plain": lambda r: f"+{r.randint(1, 99)} ({_digits(r, 3)}) {_digits(r, 3)}-{_digits(r, 4)}",
        "area": lambda r: f"({_digits(r, 3)}) {_digits(r, 3)}-{_digits(r, 4)}",
        "dashes": lambda r: f"0{_digits(r, 2)}-{_digits(r, 3)}-{_digits(r, 4)}",
        "dots": lambda r: f"0{_digits(r, 2)}.{_digits(r, 3)}.{_digits(r, 4)}",
        "slash": lambda r: f"0{_digits(r, 2)}/{_digits(r, 7)}",
        "prefix": lambda r: f"00{r.randint(10, 99)} {_digits(r, 3)} {_digits(r, 7)}",
    },
}
# What looks like one of the kinds and is none.
NEAR_MISSES: list[Callable[[random.Random], str]] = [
    lambda r: _card(r, good=False),
    lambda r: _fours(_card(r, good=False), r.choice("-./_ ")),
    lambda r: f"{r.randint(256, 999)}.{r.randint(0, 255)}.{r.randint(0, 255)}.{r.randint(0, 255)}",
    lambda r: f"{r.randint(1900, 2099)}-{r.randint(10, 12)}-{r.randint(10, 28)}",
    lambda r: f"{r.randint(10, 28)}.{r.randint(10, 12)}.{r.randint(1900, 2099)}",
    lambda r: f"{r.randint(10, 23)}:{r.randint(10, 59)}:{r.randint(10, 59)}",
    lambda r: f"{r.randint(0, 9)}.{r.randint(0, 9)}",
    lambda r: f"version {r.randint(0, 9)}.{r.randint(0, 20)}.{r.randint(0, 9)}",
    lambda r: f"978-{r.randint(0, 9)}-{_digits(r, 2)}-{_digits(r, 6)}-{r.randint(0, 9)}",
    lambda r: f"{r.randint(1, 999)},{_digits(r, 3)}.{_digits(r, 2)}",
    lambda r: f"token = \"{r.getrandbits(160):040x}\"",
    lambda r: f"{r.randint(1900, 1999)}-{r.randint(1900, 2099)}",
    lambda r: f"{r.randint(1, 100)}%",
    lambda r: f"@{_word(r)}",
    lambda r: f"{r.randint(1, 99)} @ {r.randint(1, 99)}.00",
    lambda r: f"no. {_digits(r, r.randint(4, 9))}",
    lambda r: f"{r.randint(1, 400)}/{r.randint(1, 400)}",
    lambda r: f"{_word(r)}{r.randint(1, 999)}",
    lambda r: str(r.randint(0, 99_999)),
]


def labelled_rows(seed: int = 0, each: int = 40, without: frozenset[tuple[str, str]] = frozenset(), notations=None) -> list[Labelled]:
    """The small labelled table the field is trained on: ``each`` texts for every notation and near miss, with the
    place of the instance among plain words. ``without`` leaves (kind, notation) pairs out."""
    rnd = random.Random(seed)
    chosen = NOTATIONS if notations is None else notations
    makers = [(kind, make) for kind, forms in chosen.items() for name, make in forms.items() if (kind, name) not in without]
    rows: list[Labelled] = []
    for kind, make in [*makers, *((None, make) for make in NEAR_MISSES)]:
        for _ in range(each):
            lead = " ".join(_word(rnd) for _ in range(rnd.randint(0, 6)))
            head = lead + " " * bool(lead) + rnd.choice(["", "", "(", '"', "<"])
            one = make(rnd)
            tail = rnd.choice(["", "", ".", ",", "!!", "***", ")", "###"]) + "".join(" " + _word(rnd) for _ in range(rnd.randint(0, 6)))
            if rnd.random() < 0.1:
                head, tail = head.upper(), tail.upper()
            rows.append((head + one + tail, [(kind, len(head), len(head) + len(one))] if kind else []))
    return rows


def _trimmed(text: str, a: int, b: int) -> tuple[int, int]:
    """The span without the marks around it; a parenthesis or bracket that has its partner inside stays."""
    while a < b and (text[a] in EDGE or (text[a] in "([" and CLOSING[text[a]] not in text[a:b])):
        a += 1
    while a < b and (text[b - 1] in EDGE or (text[b - 1] in ")]" and OPENING[text[b - 1]] not in text[a:b])):
        b -= 1
    return a, b


def find_spans(texts: Sequence[str], chain: Chain | None) -> list[tuple[list[tuple[str, int, int]], list[tuple[str, int, int]]]]:
    """(base spans, all spans) of each text."""
    base = [base_spans(t) for t in texts]
    if chain is None:
        return [(b, b) for b in base]
    places = [windows(t) for t in texts]
    owner = [(i, p) for i, all_places in enumerate(places) for p in all_places]
    paths = chain.viterbi([features(texts[i], p) for i, p in owner]) if owner else []
    added: list[list[tuple[int, int, int]]] = [[] for _ in texts]
    for (i, p), path in zip(owner, paths, strict=True):
        start = 0
        while start < len(p):
            stop = start
            while stop + 1 < len(p) and path[stop + 1] == path[start]:
                stop += 1
            words = [w for w in p[start : stop + 1] if path[start]]
            if words and HINT.search(texts[i], words[0][0], words[-1][1]):
                a, b = _trimmed(texts[i], words[0][0], words[-1][1])
                added[i].append((a, int(path[start]) - 1, b))
            start = stop + 1
    out = []
    for own, more in zip(base, added, strict=True):
        spans, k = list(own), 0
        ordered = sorted((a, b) for _, a, b in own)
        reach = []  # of base spans by start: how far the ones so far extend
        for a, b in ordered:
            reach.append(max(b, reach[-1] if reach else b))
        for a, kind, b in more:
            while k < len(ordered) and ordered[k][0] < b:
                k += 1
            if b > a and not (k and reach[k - 1] > a):
                spans.append((KINDS[kind], a, b))
        out.append((own, sorted(spans, key=lambda s: (s[1], KINDS.index(s[0])))))
    return out


def find(docs: DataFrame, chain: Chain | None, column: str = "text") -> DataFrame:
    """doc_id, base and spans (kind, start, stop in code points) of every row."""
    span = T.ArrayType(T.StructType([T.StructField("kind", T.StringType()), T.StructField("start", T.LongType()), T.StructField("stop", T.LongType())]))
    schema = T.StructType([T.StructField("doc_id", docs.schema["doc_id"].dataType), T.StructField("base", span), T.StructField("spans", span)])
    kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("stop", pa.int64())]))
    shared = docs.sparkSession.sparkContext.broadcast(chain)  # bounded: SHAPES x slots x labels

    def arrays(spans) -> pa.Array:
        return pa.array([[dict(zip(("kind", "start", "stop"), s, strict=True)) for s in row] for row in spans], kind)

    def seek(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in frames:
            for at in range(0, whole.num_rows, BATCH_ROWS):
                batch = whole.slice(at, BATCH_ROWS)
                found = find_spans([t or "" for t in batch.column(1).to_pylist()], shared.value)
                yield pa.RecordBatch.from_arrays([batch.column(0), arrays(f[0] for f in found), arrays(f[1] for f in found)], ["doc_id", "base", "spans"])

    return docs.select("doc_id", F.col(column).alias("text")).mapInArrow(seek, schema)


def redact(docs: DataFrame, chain: Chain | None) -> DataFrame:
    """The rows with every span in text replaced by its kind in brackets: one span, or
    overlapping spans together, by the kind that starts first. Null texts stay null."""
    shared = docs.sparkSession.sparkContext.broadcast(chain)
    place = docs.columns.index("text")

    def cover(frames: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in frames:
            for at in range(0, whole.num_rows, BATCH_ROWS):
                batch = whole.slice(at, BATCH_ROWS)
                texts = batch.column(place).to_pylist()
                spans = [s for _, s in find_spans([t or "" for t in texts], shared.value)]
                clean = pa.array([t if t is None else covered(t, s) for t, s in zip(texts, spans, strict=True)], pa.string())
                yield batch.set_column(place, whole.schema.field(place).with_type(pa.string()), clean)

    return docs.mapInArrow(cover, docs.schema)


def covered(text: str, spans: Sequence[tuple[str, int, int]]) -> str:
    out, upto = [], 0
    for kind, start, stop in spans:
        if start >= upto:
            out += [text[upto:start], f"[{kind.upper()}]"]
        upto = max(upto, stop)
    return "".join([*out, text[upto:]])


def _is(kind: str):
    return lambda x: x == kind


def _joined(spans: str) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["stop"].cast("string"))), ",")


def op8_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    found = find(docs, train(labelled_rows()))
    kinds = F.transform("base", lambda s: s["kind"])
    counts = [F.size(F.filter(kinds, _is(kind))).cast("long").alias(f"n_{kind}") for kind in KINDS]
    return found.select("doc_id", *counts, F.sha2(_joined("base"), 256).alias("base_sha256"), _joined("spans").alias("spans"))
