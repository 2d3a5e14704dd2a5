"""Operators on documents against plain versions."""

import hashlib
import random
import re
import zlib
from collections import Counter

import numpy as np
import xxhash
from tests.llm.conftest import CLASH
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sitewise.llm import decontaminate, packing, pii, quality, sharding, simhash, suffixes, toxicity
from sitewise.llm.components import components
from sitewise.session import settle


def by_id(df, *columns):
    return sorted((tuple(r) for r in df.select("doc_id", *columns).collect()), key=repr)


def plain_removed(texts, length):
    data = [(t or "").encode() for t in texts]
    seen = Counter(b[i : i + length] for b in data for i in range(len(b) - length + 1))
    for b in data:
        gone = [False] * len(b)
        for i in range(len(b) - length + 1):
            if seen[b[i : i + length]] > 1:
                gone[i : i + length] = [True] * length
        spans = sum(g and not (k and gone[k - 1]) for k, g in enumerate(gone))
        yield len(b), sum(gone), spans, hashlib.sha256(bytes(x for x, g in zip(b, gone, strict=True) if not g)).hexdigest()


def test_suffixes(docs, none, texts, monkeypatch):
    want = sorted(((d, *r) for (d, _), r in zip(texts, plain_removed([t for _, t in texts], 200), strict=True)), key=repr)
    columns = ("n_bytes", "n_removed", "n_spans", "kept_sha256")
    assert by_id(suffixes.remove_repeats(docs), *columns) == want
    monkeypatch.setattr(suffixes, "HOT_NAME", 1)  # the path of very common names
    assert by_id(suffixes.remove_repeats(docs), *columns) == want
    assert suffixes.remove_repeats(none).count() == 0


def test_suffix_steps_meet(monkeypatch):
    rnd = random.Random(3)
    data = bytes(rnd.choice(b"ab") for _ in range(3000))
    one = [x.tolist() for x in suffixes.sampled(data, 40, 12)]
    assert one[0][0] == 0 and one[1][-1] == len(data) - 40
    assert all(a + 1 == b for a, b in zip(one[1], one[0][1:], strict=False))
    monkeypatch.setattr(suffixes, "STEP", 500)
    starts = [(s, len(d)) for s, d in suffixes._steps(data, 40)]
    assert sum(n - 39 for _, n in starts) == len(data) - 39


def plain_fingerprint(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    shingles = [" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))] if words else []
    count = [0] * 64
    for s in shingles:
        h = xxhash.xxh64(s.encode(), seed=42).intdigest()
        for i in range(64):
            count[i] += h >> i & 1
    return sum(1 << i for i in range(64) if 2 * count[i] > len(shingles))


def plain_components(marks):
    root = {}

    def find(x):
        while root.setdefault(x, x) != x:
            x = root[x]
        return x

    values = sorted(set(marks))
    for i, a in enumerate(values):
        for b in values[i + 1 :]:
            if bin(a ^ b).count("1") <= 3:
                root[find(a)] = find(b)
    return {v: find(v) for v in values}


def test_simhash(docs, none, texts):
    marks = [plain_fingerprint(t) for _, t in texts]
    root = plain_components(marks)
    least = {}
    for (d, _), m in zip(texts, marks, strict=True):
        if d is not None:
            least[root[m]] = min(d, least.get(root[m], d))
    want = sorted(((d, m, least.get(root[m])) for (d, _), m in zip(texts, marks, strict=True)), key=repr)
    got = [(d, fp % 2**64, c) for d, fp, c in by_id(simhash.near_groups(docs), "fp", "component_id")]
    assert sorted(got, key=repr) == want
    assert simhash.near_groups(none).count() == 0


def test_near_links_in_large_buckets(spark):
    rnd = np.random.default_rng(4)
    values = rnd.integers(0, 2**63, 40, dtype=np.uint64)
    values = np.unique(np.concatenate([values ^ np.uint64(1 << int(b)) for b in rnd.integers(0, 64, 12)] + [values]))
    rows = spark.createDataFrame([(int(v),) for v in values.view(np.int64)], "fp long")
    root = plain_components(values.tolist())
    for bucket_rows in (4_096, 4):
        found = components(simhash.near_links(rows, bucket_rows=bucket_rows)).collect()
        own = {int(v): int(v) for v in values.view(np.int64)} | {r.u: r.root for r in found}
        groups = {frozenset(k for k in own if own[k] == v) for v in own.values()}
        assert groups == {frozenset(int(np.uint64(k).view(np.int64)) for k in root if root[k] == v) for v in root.values()}


def test_components_of_chains(spark):
    links = [(i, i + 1) for i in range(0, 40)] + [(100, 101), (101, 100), (7, 7), (None, 3), (102, 100)]
    found = {r.u: r.root for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert found == {i: 0 for i in range(1, 41)} | {101: 100, 102: 100}


def test_near_copies_of_the_pipeline(docs, none, texts):
    kept = simhash.drop_near_copies(docs)
    assert kept.columns == docs.columns
    ids = [r.doc_id for r in kept.collect()]
    # 3, 4, 5 (twice) and the first null row are near copies; 6, 7 and the last null row are empty.
    assert sorted(i for i in ids if i is not None) == [0, 1, 2, 3, 6, 8, 9, 10, 11, 12, 13] and None not in ids
    assert simhash.drop_near_copies(none).count() == 0


def test_near_copies_against_all_pairs(spark):
    rnd = random.Random(11)
    rows, pairs, twins = [], [], 0
    for n in (40, 120, 500):
        for similarity in np.linspace(0.75, 0.9, 60):
            # n shingles each (n + 4 words); the first ``own`` of them differ.
            own = round(n * (1 - similarity) / (1 + similarity))
            base = [f"w{rnd.randrange(10**9)}" for _ in range(n + 4)]
            other = [f"w{rnd.randrange(10**9)}" for _ in range(own)] + base[own:]
            rows += [(len(rows), " ".join(base)), (len(rows) + 1, " ".join(other))]
            a, b = ({tuple(w[i : i + 5]) for i in range(n)} for w in (base, other))
            pairs.append(len(a & b) / len(a | b))
    want = sorted([2 * k for k in range(len(pairs))] + [2 * k + 1 for k, s in enumerate(pairs) if s < 0.8])
    assert 40 < sum(s < 0.8 for s in pairs) < len(pairs) - 40
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    assert sorted(r.doc_id for r in simhash.drop_near_copies(docs).collect()) == want


def test_sets_in_large_groups(spark):
    rnd = np.random.default_rng(6)
    base = rnd.integers(0, 2**63, 100, dtype=np.uint64)
    sets = [np.unique(np.r_[base[: rnd.integers(60, 101)], rnd.integers(0, 2**63, rnd.integers(0, 25), dtype=np.uint64)]) for _ in range(30)]
    rows = spark.createDataFrame([(k % 2, k, s.tobytes()) for k, s in enumerate(sets)], "bucket int, node long, fp binary")
    pairs = [(i, j) for i in range(30) for j in range(i) if i % 2 == j % 2 and len(np.intersect1d(sets[i], sets[j])) >= 0.8 * len(np.union1d(sets[i], sets[j]))]
    want = components(spark.createDataFrame(pairs, "a long, b long")).collect()
    for limit in (1 << 21, 300):
        links = simhash._in_buckets(rows, simhash._by_jaccard(0.8), limit, "a long, b long", simhash.F.octet_length("fp") / 8)
        assert sorted(map(tuple, components(links).collect())) == sorted(map(tuple, want))


def test_pii_against_patterns(docs, none):
    rnd = random.Random(1)
    bits = ["a", "@", ".", "1", "25", "+", "-", " ", "%", "4111111111111111", "1.2.3.4", "(", ")", "é", "x@y.z", "999"]
    for _ in range(3_000):
        text = "".join(rnd.choice(bits) for _ in range(rnd.randint(0, 25)))
        want = [(m.start(), 0, m.end()) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text)]
        for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text):
            want += [(m.start(), 1, m.end())] * all(int(p) <= 255 for p in m[0].split("."))
        for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text):
            digits = re.sub("[ -]", "", m[0])
            want += [(m.start(), 2, m.end())] * (12 <= len(digits) <= 19 and pii.luhn(digits))
        for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text):
            want += [(m.start(), 3, m.end())] * (9 <= len(re.sub("[^0-9]", "", m[0])) <= 15)
        assert pii.base_spans(text) == [(pii.KINDS[k], a, b) for a, k, b in sorted(want)], text
    assert pii.base_spans("1" * 200_000) == []
    chain = pii.train(pii.labelled_rows(each=10))
    ((base, spans),) = pii.find_spans(["we call +1 (817) 555-7788 190.1.2.3 now"], chain)
    assert base == [("ip", 26, 35)] and set(base) < set(spans)
    found = {r.doc_id: r for r in pii.find(docs, None).collect()}
    assert [s.kind for s in found[10].base] == ["email", "phone", "ip", "card"] and found[6].spans == []
    masked = {r.doc_id: r.text for r in pii.redact(docs, None).collect()}
    assert masked[10] == "Mail [EMAIL] or [PHONE], 10.0.0.256 [IP]; [CARD]." and masked[6] is None
    assert pii.find(none, chain).count() == pii.redact(none, chain).count() == 0


def test_pii_in_notations_never_seen():
    """The field finds the kinds in notations that its table lacks, and takes no near miss for one."""
    unseen = {("email", "parentheses"), ("ip", "parentheses"), ("card", "slashes"), ("phone", "dots")}
    chain = pii.train(pii.labelled_rows(without=frozenset(unseen)))
    only = {kind: {name: make for name, make in forms.items() if (kind, name) in unseen} for kind, forms in pii.NOTATIONS.items()}
    rows = pii.labelled_rows(seed=5, each=60, notations=only)
    hits, false = Counter(), 0
    for (_, labels), (base, spans) in zip(rows, pii.find_spans([t for t, _ in rows], chain), strict=True):
        if labels:
            ((kind, start, stop),) = labels
            assert not base
            hits[kind] += any(k == kind and a < stop and start < b for k, a, b in spans)
        else:
            false += len(spans) > len(base)
    assert hits["email"] >= 48 and hits["ip"] >= 48 and hits["card"] >= 54 and hits["phone"] >= 20, hits
    assert false <= 10


def test_pii_reads_whole_words():
    long = "x" * 5_000 + "-"
    assert pii.shape("é" * 60 + "7" * 60 + "@") == "aaa999@" != pii.shape("é" * 60 + "7" * 60)
    assert pii.measure(long + "4111.1111.1111.1111") == "16/4/ok/no octets"
    assert pii.measure(long + "1.0.0.255") == "6/4/octets" and pii.measure(long + "a@b.org") == "@."


def test_toxicity(docs, none, spark):
    rnd = random.Random(5)
    plain = [" ".join(rnd.choice(["house", "tree", "walk", "green", "lake"]) for _ in range(30)) for _ in range(120)]
    rows = [(t, 0) for t in plain] + [(t.replace("tree", "moron", 1), 1) for t in plain[:60]]
    model = toxicity.train(rows)
    (bad, spans), (good, none_found), (empty, _) = model.judge(["A Moron by the lake", "a green lake", ""])
    assert bad >= 0.5 > good and [(a, b) for a, b, _ in spans] == [(2, 7)] and not none_found and 0 <= empty < 0.5
    scored = toxicity.score_documents(docs, model)
    assert scored.count() == docs.count() and all(0 <= r.score <= 1 for r in scored.collect())
    assert toxicity.drop_toxic(docs, model).count() == docs.count()
    assert toxicity.score_documents(none, toxicity.train([("x", 0)])).count() == 0
    labels = spark.createDataFrame([(i, None if i == 3 else i % 2) for i in range(14)] + [(None, 1)], "doc_id long, toxic int")
    used = toxicity.training_rows(docs, labels)
    want = [i for i in range(14) if i != 3 and zlib.crc32(str(i).encode()) % 5]
    assert len(used) == sum(2 if i == 5 else 1 for i in want)


def test_labels_of_one_kind_drop_nothing(docs):
    for rows in ([], [("x", 1)], [("x", 0), (None, 0)]):
        model = toxicity.train(rows)
        assert all(r.score < 0.5 and not r.spans for r in toxicity.score_documents(docs, model).collect())
        assert toxicity.drop_toxic(docs, model).count() == docs.count()


def test_stages_carry_clashing_columns_through(spark):
    schema = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType())] + [T.StructField(c, T.IntegerType()) for c in CLASH])
    near = " ".join(f"word{i}" for i in range(60))
    rows = [(i, f"{t} {i}", *range(7, 7 + len(CLASH))) for i, t in enumerate(["one two", "mail", "three"])] + [(9, near, *range(len(CLASH))), (10, near, *range(len(CLASH)))]
    docs = spark.createDataFrame(rows, schema)
    bench = spark.createDataFrame([(1, "nowhere at all to be seen in any of these rows")], "item_id long, text string")
    stages = {
        "toxicity": (lambda d: toxicity.drop_toxic(d, toxicity.train([])), rows),
        "near_copies": (simhash.drop_near_copies, rows[:4]),
        "decontamination": (lambda d: decontaminate.drop_contaminated(d, bench), rows),
        "personal_data": (lambda d: pii.redact(d, None), rows),
    }
    for name, (stage, want) in stages.items():
        got = stage(docs)
        assert got.schema == docs.schema, name
        assert sorted(map(tuple, got.collect())) == sorted(want), name


def test_decontamination(docs, none, spark, texts):
    items = [(0, texts[0][1]), (1, "nowhere at all. To be seen here."), (2, None), (3, ""), (0, texts[0][1])]
    bench = spark.createDataFrame([(*i, "x") for i in items], "item_id long, text string, score string")
    found = decontaminate.contaminated(docs, bench)
    assert sorted((r.doc_id, r.item_id) for r in found.collect()) == [(d, 0) for d in (0, 0, 1, 1, 2, 2)]
    clean = decontaminate.drop_contaminated(docs, bench)
    assert clean.columns == docs.columns and clean.count() == docs.count() - 3
    assert decontaminate.contaminated(none, bench).count() == decontaminate.contaminated(docs, bench.limit(0)).count() == 0


def test_decontamination_in_blocks(spark, monkeypatch):
    rnd = random.Random(12)
    vocabulary = [f"w{int(rnd.paretovariate(0.6)) % 300}" for _ in range(2_000)]
    items = [(i, " ".join(rnd.sample(vocabulary, rnd.randint(8, 150)))) for i in range(14)]
    items += [(14, None), (15, ""), (3, items[3][1])]
    texts = []
    for i in range(40):
        words = items[i % 14][1].split()
        texts.append((i, " ".join(rnd.sample(vocabulary, 50) + [w if rnd.random() < 0.8 else "x" for w in words] + rnd.sample(vocabulary, 50))))
    bench = spark.createDataFrame(items, "item_id long, text string")
    docs = spark.createDataFrame(texts, "doc_id long, text string")

    def rows():
        found = decontaminate.contaminated(docs, bench, 0.6, 0.2).collect()
        return sorted(map(tuple, found)), sorted(map(tuple, decontaminate.drop_contaminated(docs, bench).collect()))

    one = rows()
    assert len({r[2] for r in one[0]}) > 10
    monkeypatch.setattr(decontaminate, "ITEMS_PER_BLOCK", 3)
    assert rows() == one


def test_wand_and_bound_against_all_scores():
    rnd = random.Random(9)
    vocabulary = [f"w{int(rnd.paretovariate(0.6)) % 400}" for _ in range(3_000)]
    items = [(i, " ".join(rnd.sample(vocabulary, rnd.randint(3, 150)))) for i in range(120)]
    for threshold in (0.15, 0.3, 0.6):
        index = decontaminate.build_index(items, threshold, passage=32)
        for _ in range(60):
            words = rnd.sample(vocabulary, 100)
            if rnd.random() < 0.5:
                words[20:40] = items[rnd.randrange(120)][1].split()[:20]
            ids = np.array([index.terms.get(w, -1) for w in words])
            allowed = set(decontaminate.candidate_passages(index, ids, np.zeros(100, dtype=int), passage=32).tolist())
            for start in range(0, 100, 16):
                query = sorted(set(ids[start : start + 32].tolist()) - {-1})
                scores = Counter()
                for t in query:
                    for chunk, weight in zip(*index.postings[t], strict=True):
                        scores[int(chunk)] += weight
                want = {c for c, s in scores.items() if s >= threshold}
                assert {c for c, _ in decontaminate.wand(index, query)} == want
                assert not want or start in allowed


def test_packing(docs, none, texts):
    vocabulary = packing.word_vocabulary()
    tokenizer = packing.encoder(vocabulary).tokenizer
    want = {}
    for d, t in texts:
        ids = tokenizer.encode(t or "", add_special_tokens=False).ids + [2]
        want.setdefault(d, []).append(np.array(ids, dtype="<u4"))
    rows = packing.pack_documents(docs, vocabulary).collect()
    for d, all_ids in want.items():
        starts = sorted((r.start, r.length, r.ids_crc32, r.doc_tokens) for r in rows if r.doc_id == d)
        cut = [(s, len(ids[s : s + 4096]), zlib.crc32(ids[s : s + 4096].tobytes()), len(ids)) for ids in all_ids for s in range(0, len(ids), 4096)]
        assert starts == sorted(cut)
    sequences = {}
    for r in rows:
        sequences.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for pieces in sequences.values():
        at = 0
        for offset, length in sorted(pieces):
            assert offset == at
            at += length
        assert at <= 4096
    assert packing.pack_documents(none, vocabulary).count() == 0


def test_best_fit_takes_the_tightest_window():
    rnd = random.Random(2)
    lengths = sorted((rnd.randint(1, 100) for _ in range(500)), reverse=True)
    rooms, want = [], []
    for n in lengths:
        fitting = [r for r in rooms if r >= n]
        if fitting:
            rooms.remove(min(fitting))
            rooms.append(min(fitting) - n)
            want.append(100 - min(fitting))
        else:
            rooms.append(100 - n)
            want.append(0)
    got = packing.best_fit(lengths, 100)
    assert [offset for _, offset in got] == want and len({w for w, _ in got}) == len(rooms)


def test_encoder_like_the_tokenizer():
    own = packing.encoder(packing.word_vocabulary())
    odd = ["İst", "ΑΣ", "ας.", "éa", "<|endoftext|>", "<|ENDOFTEXT|>", "a.b,", "don't", "'s", "x..", "9,", "日本語.", "a\x85b", "\x1cq", "ﬁ.", "", ".", "ß.", "a" * 90]
    rnd = random.Random(1)
    for _ in range(1_500):
        text = "".join(rnd.choice(odd) + rnd.choice([" ", "\n", "", " "]) for _ in range(rnd.randint(0, 12)))
        assert np.frombuffer(own.encode(text), dtype="<u4").tolist() == own.tokenizer.encode(text, add_special_tokens=False).ids, repr(text)


def test_sharding(docs, none, texts):
    rows = sharding.shard_rows(docs, n_shards=4, rows_per_range=3).collect()
    size = {}
    for d, t in texts:
        size.setdefault(d, []).append((len((t or "").encode()) + 16, zlib.crc32((t or "").encode())))
    for d, want in size.items():
        assert sorted((r["size"], r.text_crc32) for r in rows if r.doc_id == d) == sorted(want)
    for shard in {r.shard for r in rows}:
        assert sorted(r.slot for r in rows if r.shard == shard) == list(range(sum(r.shard == shard for r in rows)))
    assert sharding.shard_rows(none).count() == 0


def test_shards_near_equal_with_a_group_of_copies(spark, tmp_path):
    rows = [(i, "copy" * 20 if i % 3 == 0 else f"text {i} " * (1 + i % 7)) for i in range(3_000)]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(str(tmp_path / "d"))
    got = sharding.shard_rows(spark.read.parquet(str(tmp_path / "d")), n_shards=10, rows_per_range=100).groupBy("shard").sum("size").collect()
    sizes = [r["sum(size)"] for r in got]
    assert len(sizes) == 10 and max(sizes) - min(sizes) <= 2 * 120


def test_quality(docs, none, texts):
    got = {(r.doc_id, r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) for r in quality.features(docs).collect()}
    want = set()
    for d, t in texts:
        words = re.findall(r"[^\x20\x09-\x0D]+", t or "")
        windows = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
        count = Counter(windows)
        covered = {i + k for i, w in enumerate(windows) if count[w] > 1 for k in range(3)}
        lines = [x for x in (t or "").split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
        symbols = sum(c in "#*$%&|<>" for c in t or "")
        want.add((d, len(words), sum(map(len, words)), symbols, len(lines) - len(set(lines)), len(covered)))
    assert got == want
    judged = quality.cascade(docs, quality.default_rules())
    rules = quality.default_rules()
    for name, rule in rules.items():
        only = {r.doc_id for r in quality.features(docs).where(rule).collect()}
        assert only <= {r.doc_id for r in judged.where("rejected_by IS NOT NULL").collect()}, name
    # Columns named like the rules' helpers come through, the helpers do not.
    assert judged.columns == [*docs.columns[:2], *[c for c in docs.columns[2:] if c not in ("n_words", "rejected_by")],
                              "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "rejected_by"]
    odd = docs.select("doc_id", "text", F.lit(7).alias("_words"), F.lit("z").alias("_lines"))
    back = quality.cascade(odd, quality.default_rules())
    assert {(r["_words"], r["_lines"]) for r in back.select("_words", "_lines").collect()} == {(7, "z")}
    assert quality.cascade(none, quality.default_rules()).count() == 0


def test_rules_of_no_cost_apart_go_by_what_they_reject(spark):
    """The order does not depend on how long a job takes to start."""
    sample = settle(spark.range(2_000).selectExpr("CAST(id AS STRING) AS text"))
    rules = {"none": F.lit(False), "some": F.col("text") < "2", "most": F.col("text") < "9", "all": F.col("text") < "a"}
    for _ in range(2):
        assert quality.order_rules(sample, rules) == ["all", "most", "some", "none"]
