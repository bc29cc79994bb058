"""Each operator against a brute-force version, on the smallest tables and on awkward rows."""

import hashlib
import re
from collections import defaultdict

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
import corpus_pipeline
from natalis.llm import curriculum, language, licences, near, postings, repeats, suffixes, urls, weaklabels, winnowing
from natalis.llm.base import connected, table

SF = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, id long, kept string, words string"
WORD = re.compile(rb"[^\x20\x09-\x0D]+")
LOWER = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz")


def awkward_rows():
    """Nulls, empty and very long texts, ties, copies, and extra columns with the operators' own names."""
    rng = np.random.default_rng(5)
    vocabulary = ["".join(chr(97 + c) for c in rng.integers(0, 26, rng.integers(2, 8))) for _ in range(300)]
    say = lambda n: " ".join(rng.choice(vocabulary, n))
    passage, long = say(60), say(30_000)
    near_copy = say(200).split()
    texts = [None, "", "  \n\t", "$$$ 123", "Ünï", "one two", "One  two", long, long, long + " end", passage, f"{say(20)} {passage} {say(9)}", passage.upper(), say(3), " ".join(near_copy)]
    texts += [" ".join([*near_copy[:k], "changed", *near_copy[k + 1 :]]) for k in (5, 90, 150)]
    texts += ["a b c d e " * 40, "x" * 5000, "é" * 60 + " " + "日本語" * 40, "same text"] + ["same text"] * 3
    return [(k * 3, t, ["en", None, "de"][k % 3], ["s", None, "t", "", "é"][k % 5], None, 1, "k", "w") for k, t in enumerate(texts)]


@pytest.fixture(scope="module")
def awkward(spark):
    return spark.createDataFrame(awkward_rows(), SCHEMA).repartition(3)


@pytest.fixture(scope="module")
def nothing(spark):
    return spark.createDataFrame([], SCHEMA)


def texts_of(docs):
    return {r.doc_id: r.text for r in docs.select("doc_id", "text").collect()}


def both(spark, awkward):
    return [awkward, table(spark, SF, "documents")]


# -- near duplicates


def shingles(text):
    words = WORD.findall((text or "").encode().translate(LOWER))
    return frozenset(tuple(words[k : k + 5]) for k in range(len(words) - 4)) if len(words) >= 5 else frozenset([tuple(words)] if words else [])


def components(texts):
    sets, up, holders, seen = {i: shingles(t) for i, t in texts.items()}, {i: i for i in texts}, defaultdict(list), {}

    def root(x):
        while up[x] != x:
            x = up[x]
        return x

    for i in sorted(sets):
        if not sets[i]:
            continue
        if sets[i] in seen:
            up[i] = root(seen[sets[i]])
            continue
        seen[sets[i]] = i
        common = defaultdict(int)
        for s in sets[i]:
            for j in holders[s]:
                common[j] += 1
            holders[s].append(i)
        for j, n in common.items():
            a, b = root(i), root(j)
            if 100 * n >= 75 * (len(sets[i]) + len(sets[j]) - n) and a != b:
                up[max(a, b)] = min(a, b)
    return {i: (len(sets[i]), root(i)) for i in sets}


def test_near_duplicates(spark, awkward, nothing):
    for docs in both(spark, awkward):
        found = near.near_duplicates(docs).collect()
        want = components(texts_of(docs))
        assert {r.id: (r.n_shingles, r.component_id) for r in found} == want
        assert all(r.kept == (r.id == r.component_id) for r in found)
    assert near.near_duplicates(nothing).count() == 0


def test_near_duplicates_in_a_hot_group(spark, monkeypatch):
    """Many copies with few changes, dealt to small blocks; a small first budget sends regions deeper and into blocks there."""
    monkeypatch.setattr(near, "PAIRS_FIRST", 2)
    monkeypatch.setattr(near, "BLOCK", 16)
    rng = np.random.default_rng(1)
    base = [f"w{k}" for k in range(150)]
    rows = []
    for i in range(120):
        words = list(base)
        for k in rng.integers(0, 150, rng.integers(0, 9)):
            words[k] = f"x{rng.integers(0, 5)}"
        rows.append((i, " ".join(words)))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    found = {r.id: (r.n_shingles, r.component_id) for r in near.near_duplicates(docs).collect()}
    assert found == components(dict(rows))


def test_near_duplicates_in_a_crowded_group(spark, monkeypatch):
    """Many documents of one template, pairs around 0.6 to 0.8: regions too large are compared by their rarest shingles."""
    monkeypatch.setattr(near, "PAIRS_FIRST", 2)
    monkeypatch.setattr(near, "PAIRS_SECOND", 1)
    monkeypatch.setattr(near, "CELL", 16)
    rng = np.random.default_rng(23)
    template = [f"t{k}" for k in range(200)]
    texts = {}
    for k in range(240):
        own = template.copy()
        for at in rng.choice(200, rng.integers(3, 8), replace=False):
            own[at] = f"x{rng.integers(0, 10**9)}"
        texts[k] = " ".join(own)
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string").repartition(3)
    crowds = []
    filtered = near._filtered
    monkeypatch.setattr(near, "_filtered", lambda crowded, *more: crowds.append(crowded.count()) or filtered(crowded, *more))
    found = {r.id: (r.n_shingles, r.component_id) for r in near.near_duplicates(docs).collect()}
    assert found == components(texts)
    assert crowds and len({c for _, c in found.values()}) > 1


def test_rarest_shingles_miss_no_pair(spark):
    """Two sets of at least the share have one of their rarest shingles in common."""
    rng = np.random.default_rng(29)
    base = [f"b{k}" for k in range(120)]
    texts = {k: " ".join(f"y{rng.integers(0, 10**9)}" if rng.random() < 0.02 else w for w in base[: rng.integers(90, 121)]) for k in range(60)}
    docs = spark.createDataFrame(list(texts.items()), "id long, text string")
    rare = defaultdict(set)
    for r in near._rarest(docs.select("id"), docs, 5, 75).collect():
        rare[r.id].add(r.region)
    sets = {k: shingles(t) for k, t in texts.items()}
    linked = [(a, b) for a in sets for b in sets if a < b and 4 * len(sets[a] & sets[b]) >= 3 * len(sets[a] | sets[b])]
    assert len(linked) > 10 and all(rare[a] & rare[b] for a, b in linked)
    assert all(len(rare[k]) < len(sets[k]) / 3 for k in sets)


def test_rarest_shingles_take_one_python_worker(spark):
    """A task that ranks shingles has one Python step, so that an executor doesn't keep two workers for each of its cores."""
    rows = [(k, None if k == 3 else f"a b c d e f g{k % 5} h i j k l{k}") for k in range(30)]
    docs = spark.createDataFrame(rows, "id long, text string").repartition(3)
    found = near._rarest(docs.select("id"), docs, 5, 75)
    assert found._jdf.queryExecution().executedPlan().toString().count("MapInArrow") == 1
    kept = [r.id for r in found.collect()]
    assert {i: kept.count(i) for i in kept} == {i: len(shingles(t)) - -(-75 * len(shingles(t)) // 100) + 1 for i, t in rows if t}


def test_connected(spark):
    links = spark.createDataFrame([(k, k + 1) for k in range(1, 40) if k % 10] + [(50, 3), (3, 50), (7, 7)], "a long, b long")
    found = {r.id: r.component for r in connected(links).collect()}
    assert found == {**{k: (k - 1) // 10 * 10 + 1 for k in range(1, 41)}, 50: 1}


def test_few_links_make_few_tasks(spark):
    """Few rows are gathered in as few tasks and files, however many partitions a shuffle has."""
    links = spark.createDataFrame([(k, k + 1) for k in range(1, 40) if k % 10], "a long, b long")
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "30")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        found = connected(links)
        assert found.rdd.getNumPartitions() < 5
        assert {r.id: r.component for r in found.collect()} == {k: (k - 1) // 10 * 10 + 1 for k in range(1, 41)}
        docs = spark.createDataFrame([(k, " ".join(f"w{j}" for j in range(k % 4, 40 + k % 4))) for k in range(20)], "id long, text string")
        regions, _ = near._regions(near.describe(docs, 5).withColumn("component", F.col("id")), 20, 2, 64)
        assert regions.rdd.getNumPartitions() < 10
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


# -- repeated windows and byte strings


def without_windows(texts, size):
    words = {i: WORD.findall((t or "").encode()) for i, t in texts.items()}
    starts = defaultdict(int)
    for w in words.values():
        for k in range(len(w) - size + 1):
            starts[tuple(w[k : k + size])] += 1
    out = {}
    for i, w in words.items():
        gone = set()
        for k in range(len(w) - size + 1):
            if starts[tuple(w[k : k + size])] > 1:
                gone.update(range(k, k + size))
        out[i] = (len(w), len(gone), b" ".join(x for k, x in enumerate(w) if k not in gone).decode())
    return out


@pytest.mark.parametrize("size", [35, 3])
def test_repeated_windows(spark, awkward, nothing, size):
    for docs in both(spark, awkward):
        found = {r.id: (r.n_words, r.n_removed, r.kept) for r in repeats.remove_repeats(docs, size=size).collect()}
        assert found == without_windows(texts_of(docs), size)
    assert repeats.remove_repeats(nothing).count() == 0


def without_strings(texts, size):
    first = {}
    for i in sorted(texts):
        data = (texts[i] or "").encode()
        for k in range(len(data) - size + 1):
            first.setdefault(data[k : k + size], i)
    out = {}
    for i, t in texts.items():
        data = (t or "").encode()
        gone = np.zeros(len(data) + 1, bool)
        for k in range(len(data) - size + 1):
            if first[data[k : k + size]] < i:
                gone[k : k + size] = True
        runs = int((np.diff(np.concatenate([[0], gone[:-1].astype(int)])) == 1).sum())
        out[i] = (len(data), bytes(np.frombuffer(data, np.uint8)[~gone[:-1]]), runs)
    return out


def test_byte_strings(spark, awkward, nothing):
    for docs in both(spark, awkward):
        found = {r.id: (r.n_bytes, bytes(r.kept), len(r.spans)) for r in suffixes.remove_repeats(docs).collect()}
        assert found == without_strings(texts_of(docs), 50)
    assert suffixes.remove_repeats(nothing).count() == 0


def test_byte_strings_around_a_frequent_line(spark):
    """One header line before and within varying text, half of the strings around it shared on one side only."""
    rng = np.random.default_rng(41)
    header, tails = "== a line that stands in every one of these texts ==", ["".join(rng.choice(list("abcdefgh"), 40)) for _ in range(6)]
    texts = {}
    for k in range(150):
        own = lambda n: "".join(rng.choice(list("ijklmnop"), n))
        texts[k] = own(rng.integers(0, 30)) + tails[rng.integers(6)][: rng.integers(0, 40)] + header[rng.integers(0, 20) :] + tails[rng.integers(6)][: rng.integers(0, 40)] + own(rng.integers(0, 30))
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string").repartition(3)
    found = {r.id: (r.n_bytes, bytes(r.kept), len(r.spans)) for r in suffixes.remove_repeats(docs).collect()}
    assert found == without_strings(texts, 50)


def test_suffix_order():
    rng = np.random.default_rng(0)
    for _ in range(50):
        strings = [bytes(rng.integers(97, 97 + rng.integers(1, 4), rng.integers(1, 9)).astype(np.uint8)) for _ in range(rng.integers(1, 6))]
        ends = np.cumsum([len(s) for s in strings])
        want = sorted((s[k:], i, int(ends[i]) - len(s) + k) for i, s in enumerate(strings) for k in range(len(s)))
        assert suffixes.suffix_order(np.frombuffer(b"".join(strings), np.uint8), ends).tolist() == [w[2] for w in want]


# -- fingerprints


def test_winnowing_keeps_the_rightmost_least_hash():
    rng = np.random.default_rng(2)
    for _ in range(40):
        text = "".join(rng.choice(list("abé"), rng.integers(0, 200)))
        hashes, positions = winnowing.winnow(text, 5, 7)
        points = np.frombuffer(text.encode("utf-32-le"), np.uint32)
        every = winnowing._hashes(points, min(5, len(points))).tolist() if text else []
        size = min(7, len(every))
        want = sorted({max(range(k, k + size), key=lambda j: (-every[j], j)) for k in range(len(every) - size + 1)}) if every else []
        assert positions.tolist() == want
        assert hashes.tolist() == [every[k] for k in want]


def by_hand(text):
    """The selected (hash, position) of a text, window by window with plain integers."""
    points = [ord(c) for c in text]
    size = min(winnowing.GRAM, len(points))
    every = []
    for k in range(len(points) - size + 1 if points else 0):
        value = sum((p + 1) * pow(int(winnowing.BASE), j, 2**64) for j, p in enumerate(points[k : k + size])) % 2**64
        for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
            value = (value ^ value >> shift) * factor % 2**64
        every.append((value ^ value >> 31) >> 32)
    window = min(winnowing.WINDOW, len(every))
    return sorted({max(range(k, k + window), key=lambda j: (-every[j], j)) for k in range(len(every) - window + 1)}) if every else [], every


def test_fingerprints_by_hand(spark, tmp_path, monkeypatch):
    """Hashes, positions and likeness of the query against a version by hand; a passage in common is always found."""
    monkeypatch.setattr(winnowing, "STRETCH_BYTES", 900)
    rng = np.random.default_rng(17)
    say = lambda n: "".join(rng.choice(list("abc déf"), n))
    passage = say(winnowing.GRAM + winnowing.WINDOW - 1)
    texts = ["", "ab", say(11), say(40), say(300), say(120) + passage, passage + say(90), say(77) + passage + say(31), None, say(300)]
    rows = [(3 * k, t) for k, t in enumerate(texts)]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(str(tmp_path / "documents.parquet"))
    found = {r.doc_id // 3: r for r in winnowing.op7_winnowing(spark, str(tmp_path)).collect()}
    assert len(found) == len(texts)
    sets = []
    for k, text in enumerate(texts):
        places, every = by_hand(text or "")
        assert found[k].positions == places
        assert found[k].fingerprint == "".join(f"{every[p]:08x}" for p in places)
        sets.append({every[p] for p in places})
    like = lambda a, b: len(a & b) / len(a | b) if a | b else 1.0
    for k, text in enumerate(texts):
        text, after = text or "", texts[k - 1] or ""
        edited = text[: len(text) - len(text) // 2] + after[: len(text) // 2]
        places, every = by_hand(edited)
        assert found[k].near_next == like(sets[k], sets[k - 1])
        assert found[k].near_edited == like(sets[k], {every[p] for p in places})
    for a in (5, 6, 7):
        for b in (5, 6, 7):
            assert sets[a] & sets[b]


def test_edited_texts(spark, awkward, nothing, monkeypatch):
    monkeypatch.setattr(winnowing, "table", lambda *_: awkward)
    monkeypatch.setattr(winnowing.with_next, "__defaults__", ("doc_id", "text", 4))
    found = {r.doc_id: r for r in winnowing.op7_winnowing(spark, SF).collect()}
    ids = sorted(found, reverse=True)
    texts = {i: t or "" for i, t in texts_of(awkward).items()}
    prints = {}
    for at, i in enumerate(ids):
        text, following = texts[i], texts[ids[(at + 1) % len(ids)]]
        half = len(text) // 2
        edited = text[: len(text) - half] + following[:half]
        assert found[i].n_chars == len(text)
        assert found[i].edited_sha256 == hashlib.sha256(edited.encode()).hexdigest()
        assert prints.setdefault(text, found[i].fingerprint) == found[i].fingerprint
        assert 0 <= found[i].near_next <= 1
        if edited == text:
            assert found[i].near_edited == 1
    assert winnowing.fingerprints(nothing).count() == 0
    assert winnowing.fingerprints(awkward).count() == len(ids)


# -- languages, quality, licences


def test_languages(spark, awkward, nothing):
    found = language.op1_language_mixture(spark, SF).join(table(spark, SF, "documents").select("doc_id", "lang"), "doc_id")
    right = found.where("held_out").agg(F.avg((F.col("lang") == F.col("lang_pred")).cast("int"))).first()[0]
    assert right >= 0.97
    model = language.learn(table(spark, SF, "documents"))
    rows = {r.doc_id: r for r in language.identify(awkward.withColumn("score", F.lit("clash")), model).collect()}
    for i, text in texts_of(awkward).items():
        none = not re.search(r"[^\W\d_]", text or "")
        assert (rows[i].lang_pred == "und") == none
        assert 0 <= rows[i].score <= 1 and (not none or rows[i].score == 0)
    assert language.identify(nothing, model).count() == 0
    unlearned = language.learn(nothing)
    assert {r.lang_pred for r in language.identify(awkward, unlearned).collect()} == {"und"}


def test_mixed_text_has_both_languages(spark):
    docs = table(spark, SF, "documents")
    model = language.learn(docs)
    texts = {r.lang: r.text for r in docs.where("length(text) > 1500 and lang in ('en', 'de')").collect()}
    mixed = spark.createDataFrame([(1, texts["en"][:1500] + " " + texts["de"][:700])], "doc_id long, text string")
    shares = language.identify(mixed, model).first().proportions
    assert set(shares) >= {"en", "de"} and shares["en"] > shares["de"] > 0.15


def test_quality(spark, awkward, nothing):
    found = weaklabels.op10_weak_labels(spark, SF).join(table(spark, SF, "labels"), "doc_id")
    assert found.agg(F.avg((F.col("kept").cast("int") == F.col("quality")).cast("int"))).first()[0] >= 0.9
    docs = awkward.select(F.col("doc_id").alias("id"), "text")
    rows = {r.id: r for r in weaklabels.score(docs, *weaklabels.train(docs)).collect()}
    for i, text in texts_of(awkward).items():
        assert (rows[i].score == 0) == (not (text or "").strip())
    empty = nothing.select(F.col("doc_id").alias("id"), "text")
    assert weaklabels.score(empty, *weaklabels.train(empty)).count() == 0


def test_quality_sample_is_bounded(spark, monkeypatch):
    """Rows without ids, repeated ids and equal texts: as many different texts as asked for, and no more."""
    rows = [(None if k % 2 else k % 7, f"words of text number {k % 3000} " * (1 + k % 3)) for k in range(6000)] + [(1, None), (None, ""), (None, " \n")]
    docs = spark.createDataFrame(rows, "id long, text string").repartition(4)
    chosen = weaklabels._sample(docs, 6000, 100).collect()
    assert len(chosen) == 100 == len({r.text for r in chosen})
    assert weaklabels._sample(docs, 6000, 10**6).count() == len({t for _, t in rows if (t or "").strip()})
    sizes = []
    fit = weaklabels.fit
    monkeypatch.setattr(weaklabels, "fit", lambda found, labels: sizes.append(len(found)) or fit(found, labels))
    model = weaklabels.train(docs, 100)
    assert sizes == [100]
    found = weaklabels.score(docs.select(F.col("text").alias("id"), "text"), *model).distinct().collect()
    assert len(found) == len({t for _, t in rows}) and {r.score for r in found if not (r.id or "").strip()} == {0.0}


def test_label_model_by_enumeration():
    """Posteriors against the model played with one row at a time and plain probabilities."""
    rng = np.random.default_rng(13)
    n = len(weaklabels.LABELLERS)
    truth = rng.random(400) < 0.6
    votes = [[0 if rng.random() < 0.3 else (2 if (t if rng.random() < 0.85 else not t) else 1) for _ in range(n)] for t in truth]
    numbers = [int("".join(map(str, v)), 3) for v in votes]
    patterns, counts = np.unique(numbers, return_counts=True)
    found = dict(zip(patterns.tolist(), weaklabels.posteriors(patterns, counts.astype(float)).tolist(), strict=True))
    p = [(v.count(2) + 1) / (v.count(2) + v.count(1) + 2) for v in votes]
    for _ in range(200):
        prior = (sum(p) + 1) / (len(p) + 2)
        seen = [[{c: (0.5 if c != (2 if good else 1) else 1.0) + sum(q if good else 1 - q for q, v in zip(p, votes, strict=True) if v[k] == c) for c in (0, 1, 2)} for k in range(n)] for good in (False, True)]
        new = []
        for v in votes:
            like = [np.prod([seen[g][k][v[k]] / sum(seen[g][k].values()) for k in range(n)]) * (prior if g else 1 - prior) for g in (0, 1)]
            new.append(like[1] / (like[0] + like[1]))
        if max(abs(a - b) for a, b in zip(p, new, strict=True)) < 1e-10:
            break
        p = new
    assert [found[k] for k in numbers] == pytest.approx(p, abs=1e-6)
    assert np.mean([(found[k] > 0.5) == t for k, t in zip(numbers, truth, strict=True)]) > 0.95


def test_distinct_words_of_the_whole_text():
    """What follows the first 200 words counts as much as they do."""
    varied, same = np.arange(200, dtype=np.uint64), np.zeros(3800, np.uint64)
    name = next(k for k, n in enumerate(weaklabels.LABELLERS) if n.startswith("distinct words"))
    share = lambda hashes: weaklabels.measures(np.frombuffer(b"some words", np.uint8), hashes)[name]
    assert share(varied) == 1 and share(varied[:7]) == 1
    assert share(np.append(varied, same)) == pytest.approx((1 + 19 / 200) / 20)
    assert share(np.append(same, varied)) == pytest.approx((1 + 19 / 200) / 20)
    assert share(np.append(varied, [5, 5, 5, 6]).astype(np.uint64)) == pytest.approx((1 + 2 / 4) / 2)


def test_licences(spark, awkward, nothing):
    docs = table(spark, SF, "documents")
    added = [(10**6 + k, f"Some words here.\n{t}\nMore.", None, None, None) for k, t in enumerate(["Released under the MIT License.", "Licensed under the Fishing License of the shire.", "All words, no rights."])]
    docs = docs.union(spark.createDataFrame(added, docs.schema)).union(awkward.select(*docs.columns).withColumn("doc_id", F.col("doc_id") + 2_000_000))
    found = {r.id: r for r in licences.scan(docs).collect()}
    stated = {"Released under the MIT License.": "mit", "Licensed under the Apache License, Version 2.0.": "apache-2.0", "Licensed under CC BY-NC 4.0.": "cc-by-nc"}
    for i, text in texts_of(docs).items():
        for sentence, family in stated.items():
            if sentence in (text or ""):
                assert found[i].family == family
    assert found[10**6 + 1].family == "unknown"
    assert 10**6 + 2 not in found


def subsequence(a, b):
    row = [0] * (len(b) + 1)
    for x in a:
        now = [0]
        for k, y in enumerate(b):
            now.append(row[k] + 1 if x == y else max(row[k + 1], now[k]))
        row = now
    return row[-1]


def test_licences_need_the_order_of_words(spark, awkward, nothing):
    """Statements against a scan by hand; sentences with a template's words in another order or far apart state nothing."""
    cases = {
        "All seats are reserved and the rights of way stay open.": [],
        "The GNU herd lives under the general public bridge; a license to fish, version 3 of this work, is licensed": [],
        "License MIT the under released": [],
        "Licensed under " + "one two three four five six seven eight " * 4 + "the MIT License": [],
        "Released under MIT License.": ["mit"],
        "// SPDX-License-Identifier: MIT": ["mit"],
        "SPDX-License-Identifier: Apache-2.0": ["apache-2.0"],
        "Licensed under the MIT License or the Apache License, Version 2.0.": ["apache-2.0", "mit"],
        "Licensed under CC BY-NC 4.0.\nReleased under the MIT License.": ["cc-by-nc", "mit"],
    }
    docs = table(spark, SF, "documents").select("doc_id", "text")
    docs = docs.union(spark.createDataFrame([(10**6 + k, t) for k, t in enumerate(cases)] + [(None, "Released under the MIT License."), (10**6, None)], "doc_id long, text string"))
    classifier = licences.train(licences.paragraphs(docs, "doc_id", "text"))
    found = defaultdict(set)
    for r in licences.scan(docs, classifier=classifier).collect():
        if r.confirmed:
            found[r.id].add(r.family)
    for k, (text, families) in enumerate(cases.items()):
        assert sorted(found[10**6 + k]) == families, text
    assert found[None] == {"mit"}
    # every confirmed line of one line has its template in order, and no line that has one whole is missed
    words = lambda t: [w for w in (x.rstrip(".-+") for x in re.split(r"[^\w.+-]+", t.lower())) if w]
    known = [(f, words(t)) for f, texts in licences.TEMPLATES.items() for t in texts]
    for i, text in texts_of(table(spark, SF, "documents")).items():
        for line in (text or "").split("\n"):
            own = words(line)
            for family, template in known:
                whole = any(own[k : k + len(template)] == template for k in range(len(own)))
                assert not whole or family in found[i], (i, line)
        near = {f for f, t in known if subsequence(t, words(text or "")) >= 0.8 * len(t)}
        assert found[i] <= near
    assert licences.scan(nothing).count() == 0
    assert licences.scan(nothing, classifier=classifier).count() == 0
    assert {r.id for r in licences.scan(awkward, classifier=classifier).collect() if r.confirmed} == set()


def test_licences_are_learned_from_every_line(spark, monkeypatch):
    """Every line counts for the model and its threshold, copies as many times, however many there are."""
    lines = [(k, f"the fishing licence number {k + 10} of the shire") for k in range(9000)]
    lines += [(k, f"a copy of page {k} is made") for k in range(9000, 12000)] + [(k, "the same line again") for k in range(12000, 15000)]
    docs = spark.createDataFrame(lines + [(15000, "Released under the MIT License.")], "doc_id long, text string")
    fitted = []
    whole = licences._hashed
    monkeypatch.setattr(licences, "_hashed", lambda rows: fitted.append(rows) or whole(rows))
    classifier = licences.train(licences.paragraphs(docs, "doc_id", "text"))
    learned = fitted[0].where(f"label = {len(licences.TEMPLATES)}").groupBy("grams").agg(F.sum("weight")).collect()
    assert sum(r[1] for r in learned) == 15000
    assert {r[1] for r in learned} == {9000, 3000}
    found = {(r.id, r.family, r.confirmed) for r in licences.scan(docs, classifier=classifier).collect()}
    assert found == {(15000, "mit", True)}


def test_licences_wrapped_over_lines(spark):
    """Statements whose lines are each below a template, alone, behind comment marks and inside longer paragraphs."""
    mit = """Permission is hereby granted, free of charge, to any person obtaining a copy
of this software and associated documentation files (the "Software"), to deal
in the Software without restriction, including without limitation the rights
to use, copy, modify, merge, publish, distribute, sublicense, and/or sell
copies of the Software, and to permit persons to whom the Software is
furnished to do so, subject to the following conditions:"""
    bsd = """Redistribution and use in source and binary forms, with or without
modification, are permitted provided that the following conditions are met:"""
    gpl = """# This program is free software: you can redistribute it and/or modify
# it under the terms of the GNU General Public License as published by
# the Free Software Foundation, either version 3 of the License, or
# (at your option) any later version."""
    plain = "The river runs past the old mill\nand the children walk home\nbefore the evening rain begins"
    cases = [(mit, "mit"), (bsd, "bsd"), (gpl, "gpl"), (f"{plain}\n{bsd}\n{plain}", "bsd"), (f"{plain}\n \t\n{mit}\n\n{plain}", "mit"), (f"{plain}\nReleased under the MIT License.\n{plain}", "mit")]
    # a blank line between the halves: no paragraph has the statement
    cases += [(bsd.replace("\n", "\n\n"), None), (plain, None), ("", None), (None, None)]
    docs = table(spark, SF, "documents")
    docs = docs.union(spark.createDataFrame([(10**6 + k, t, None, None, None) for k, (t, _) in enumerate(cases)], docs.schema))
    found = defaultdict(list)
    for r in licences.scan(docs).where(f"id >= {10**6}").collect():
        found[r.id - 10**6].append((r.place, r.family, r.confirmed))
    for k, (_, family) in enumerate(cases):
        assert [f[1] for f in found[k] if f[2]] == ([family] if family else []), (k, found[k])
    assert found[0] == [(0, "mit", True)] and found[2] == [(0, "gpl", True)]
    assert found[4] == [(4, "mit", True)] and found[5] == [(3, "mit", True)]


# -- benchmark, lists, mixing


def hit_words(texts, items, size=13):
    word = re.compile(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
    split = lambda t: word.findall((t or "").encode().translate(LOWER))
    windows = defaultdict(set)
    for i, t in items:
        w = split(t)
        n = min(size, len(w))
        for k in range(len(w) - n + 1 if w else 0):
            windows[tuple(w[k : k + n])].add(i)
    out = {}
    for i, t in texts.items():
        w, hit, found = split(t), set(), set()
        for n in {len(x) for x in windows}:
            for k in range(len(w) - n + 1):
                if tuple(w[k : k + n]) in windows:
                    found |= windows[tuple(w[k : k + n])]
                    hit.update(range(k, k + n))
        out[i] = (len(w), len(hit), sorted(found), bool(hit) and 20 * len(hit) >= len(w))
    return out


def test_contamination(spark, awkward, nothing):
    texts = texts_of(awkward)
    items = [(1, None), (2, ""), (3, "One, TWO"), (4, " ".join(texts[30].split()[5:25])), (5, " ".join(texts[30].split()[5:25])), (6, "nowhere at all"), (7, "a b c d e a b c d e a b c d e a b"), (8, "é" * 60)]
    bench = spark.createDataFrame(items, "item_id long, text string")
    found = {r.id: (r.n_words, r.n_hit, sorted(r["items"]), r.contaminated) for r in postings.contamination(awkward, bench).collect()}
    assert found == hit_words(texts, items)
    assert postings.contamination(nothing, bench).count() == 0
    none = postings.contamination(awkward, bench.limit(0)).where("n_hit > 0 or contaminated")
    assert none.count() == 0


def test_contamination_of_rows_without_ids_and_of_equal_ids(spark):
    one, two = "alpha beta gamma delta", "epsilon zeta eta theta"
    rows = [(None, f"x {one} y"), (None, "nothing here"), (5, one), (5, two), (5, one), (6, f"alpha z beta z gamma z delta {two[:12]}")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("own", F.lit(1)).withColumn("at", F.lit(2))
    bench = spark.createDataFrame([(1, one), (2, two), (None, two), (2, "unseen words")], "item_id long, text string")
    found = sorted(((r.id or 0, r.n_words, r.n_hit, tuple(sorted(i or 0 for i in r["items"])), r.n_near, r.contaminated) for r in postings.contamination(docs, bench).collect()))
    assert found == [(0, 2, 0, (), 0, False), (0, 6, 4, (1,), 1, True), (5, 4, 4, (0, 2), 2, True), (5, 4, 4, (1,), 1, True), (5, 4, 4, (1,), 1, True), (6, 9, 0, (), 1, False)]


def test_proximity_survives_changed_words(spark):
    """An item quoted with a word that no training text has is near, though no phrase."""
    docs = spark.createDataFrame([(1, "q the old grey mill stood by a river w".split()), (2, "the mill river".split())], "id long, words array<string>")
    items = spark.createDataFrame([(7, "the old grey mill stands by a river".split()), (8, "the unseen thing".split()), (9, ["mill"])], "item long, words array<string>")
    found = {(r.id, r.item) for r in postings.proximity_matches(docs, items, within=12).collect()}
    assert found == {(1, 7), (1, 9), (2, 9)}  # of item 8 one word is known only
    assert {(r.id, r.item) for r in postings.phrase_matches(docs, items).collect()} == {(1, 9), (2, 9)}


def test_proximity(spark):
    docs = spark.createDataFrame([(1, ["rare", "x", "x", "odd"]), (2, ["odd", *["x"] * 9, "rare"]), (3, ["rare"])], "id long, words array<string>")
    items = spark.createDataFrame([(7, ["odd", "rare"])], "item long, words array<string>")
    found = postings.proximity_matches(docs, items, within=4).collect()
    assert [(r.id, r.item, r.first, r.last) for r in found] == [(1, 7, 0, 3)]


def test_url_lists(spark):
    pages = [(1, "http://A.b.NET/x"), (2, None), (3, "no scheme"), (4, "https://example.net/en/1#a/b"), (5, "http://net"), (6, "http://notexample.com/de/"), (7, "s://x.example.com/de/?q"), (8, "s://fr.org/fr/"), (9, "s://org/fr"), (1, "http://A.b.NET/x")]
    rules = spark.createDataFrame(urls.RULES, "host string, path string, verdict string")
    docs = spark.createDataFrame(pages, "page_id long, url string").withColumn("rule", F.lit("clash"))
    found = sorted((r.id, r.host, r.path, r.rule or "", r.verdict) for r in urls.judge(docs, rules).collect())
    assert found == sorted([
        (1, "a.b.net", "/x", "net/", "block"), (1, "a.b.net", "/x", "net/", "block"), (2, "", "", "", "allow"), (3, "", "", "", "allow"),
        (4, "example.net", "/en/1", "example.net/en/", "allow"), (5, "net", "", "", "allow"), (6, "notexample.com", "/de/", "", "allow"),
        (7, "x.example.com", "/de/", "example.com/de/", "block"), (8, "fr.org", "/fr/", "org/fr/", "allow"), (9, "org", "/fr", "", "allow"),
    ])
    # a host of 100,000 labels costs no more than its bytes; dots at the ends are labels too
    odd = ["a." * 100_000 + "net", "b." * 100_000, ".net", "net.", "..example.net", "x.y"]
    long = spark.createDataFrame([(k, f"s://{h}/en/") for k, h in enumerate(odd)], "page_id long, url string")
    assert {r.id: r.rule for r in urls.judge(long, rules).collect()} == {0: "net/", 1: None, 2: "net/", 3: None, 4: "example.net/en/", 5: None}
    assert urls.judge(docs.limit(0), rules).count() == 0
    assert {r.verdict for r in urls.judge(docs, rules.limit(0)).collect()} == {"allow"}


def shared(sizes, weights, most=3):
    """Targets by sharing what is over again, step by step."""
    total, capped = sum(sizes), set()
    while True:
        left = total - sum(most * sizes[k] for k in capped)
        weight = sum(w for k, w in enumerate(weights) if k not in capped)
        aims = [most * s if k in capped else left * weights[k] / weight for k, s in enumerate(sizes)]
        over = {k for k in range(len(sizes)) if k not in capped and aims[k] > most * sizes[k]}
        if not over:
            return aims
        capped |= over


def test_targets(spark):
    sizes = [10, 1000, 5, 40, 0, 700, 3]
    weights = [5, 2, 1, 5, 2, 1, 5]
    rows = spark.createDataFrame([(f"s{k}" if k < 6 else None, s) for k, s in enumerate(sizes)], "source string, source_size long")
    found = {r.source: r.target for r in curriculum.targets(rows, curriculum.repeating(5, 2, 1)).collect()}
    for k, aim in enumerate(shared(sizes, weights)):
        assert found[f"s{k}" if k < 6 else None] == pytest.approx(aim)


def test_curriculum(spark, awkward, nothing):
    planned = curriculum.plan(awkward, curriculum.repeating(5, 2, 1)).collect()
    again = curriculum.plan(awkward.repartition(7), curriculum.repeating(5, 2, 1)).collect()
    assert sorted(map(str, planned)) == sorted(map(str, again))
    by_source = defaultdict(list)
    for r in planned:
        assert 0 <= r.taken <= 3 * r.size
        by_source[r.source].append(r)
    for rows in by_source.values():
        assert sum(r.taken for r in rows) == round(rows[0].target)
    rising = curriculum.listed({"s": [(0, 1), (1, 0)], None: [(0, 0), (0.5, 0), (1, 4)]}, [(0, 1), (1, 1)])
    late = {r.source: r for r in curriculum.plan(awkward, rising).where("taken > 0").collect()}
    assert min(late[None].positions) >= 0.5
    order = curriculum.ordered(awkward, curriculum.plan(awkward, rising)).collect()
    assert [r.position for r in order] == sorted(r.position for r in order)
    assert curriculum.plan(nothing, rising).count() == 0


# -- queries and pipeline


@pytest.mark.parametrize("name", sorted(n for n in entry.oracle_sql() if n.startswith("op") and n[2].isdigit()))
def test_query_matches_sql(spark, name):
    duck = duckdb.connect()
    for t in ("documents", "pages", "benchmark", "embeddings"):
        duck.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    found = entry.queries()[name](spark, SF)
    columns = sorted(found.columns)
    want = duck.execute(f"SELECT {', '.join(columns)} FROM ({entry.oracle_sql()[name]})").fetchall()
    assert sorted(map(str, (tuple(r) for r in found.select(*columns).collect()))) == sorted(map(str, want))


def test_pipeline(spark, awkward, tmp_path):
    assert {f"op{n}" for n in range(1, 11)} <= {q.split("_")[0] for q in entry.queries()}
    docs = table(spark, SF, "documents")
    rows = awkward.select(*docs.columns).withColumn("doc_id", F.col("doc_id") + 10**6)
    docs.union(rows).write.parquet(str(tmp_path / "documents.parquet"))
    table(spark, SF, "benchmark").write.parquet(str(tmp_path / "benchmark.parquet"))
    at = table(spark, str(tmp_path), "documents")
    for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
        before = texts_of(at)
        out = stage(spark, at, str(tmp_path))
        if k < 4:
            assert out.columns == docs.columns
        out.write.parquet(str(tmp_path / f"stage{k}"))
        at = spark.read.parquet(str(tmp_path / f"stage{k}"))
        after = texts_of(at)
        if k == 1:
            groups = components(before)
            assert set(after) == {i for i in before if groups[i][1] == i}
        if k == 2:
            want = without_windows(before, 35)
            assert after == {i: before[i] if not want[i][1] else want[i][2] for i in before if want[i][0] > want[i][1] or not want[i][1]}
        if k == 3:
            items = [(r.item_id, r.text) for r in table(spark, SF, "benchmark").collect()]
            judged = hit_words(before, items)
            assert set(after) == {i for i in before if not judged[i][3]}
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == at.count() > 0


def test_repeated_rows_in_the_pipeline(spark):
    """A row that stands twice, null ids included, is kept once by near-dedup and loses nothing after it."""
    rng = np.random.default_rng(11)
    say = lambda n: " ".join(f"w{x}" for x in rng.integers(0, 10**6, n))
    long, short, nameless, other, single = say(200), say(9), say(120), say(120), say(80)
    rows = [(1, long), (1, long), (2, short), (2, short), (None, nameless), (None, nameless), (None, other), (3, single)]
    docs = spark.createDataFrame([(i, t, "en", "s", len(t)) for i, t in rows], "doc_id long, text string, lang string, source string, n_chars long").repartition(3)
    want = sorted([(1, long), (2, short), (3, single), (-1, nameless), (-1, other)])
    left = lambda df: sorted((-1 if r.doc_id is None else r.doc_id, r.text) for r in df.collect())
    at = corpus_pipeline.near_dedup(spark, docs, "")
    assert left(at) == want
    at = corpus_pipeline.substring_dedup(spark, at, "")
    assert left(at) == want
    planned = curriculum.plan(docs, curriculum.repeating(5, 2, 1))
    turns = sorted((-1 if r.id is None else r.id, p) for r in planned.collect() for p in r.positions)
    assert sorted((-1 if r.doc_id is None else r.doc_id, r.position) for r in corpus_pipeline.mixing(spark, docs, "").collect()) == turns


def test_decontamination_stage_tells_rows_apart(spark, tmp_path):
    """Of rows of one id only those with benchmark words go, rows without an id like others; columns of any name stay."""
    items = [(1, "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu nu")]
    spark.createDataFrame(items, "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    rows = [(7, items[0][1], 1), (7, "clean words", 2), (None, f"so {items[0][1]}", 3), (None, "", 4), (None, None, 5), (8, "alpha beta", 6)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, text_hash long").withColumn("words", F.lit("w")).repartition(2)
    left = corpus_pipeline.decontamination(spark, docs, str(tmp_path))
    assert left.columns == docs.columns
    assert sorted(r.text_hash for r in left.collect()) == [2, 4, 5, 6]


def test_pipeline_of_an_empty_table(spark, tmp_path):
    for name in ("documents", "benchmark"):
        table(spark, SF, name).limit(0).write.parquet(str(tmp_path / f"{name}.parquet"))
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0
