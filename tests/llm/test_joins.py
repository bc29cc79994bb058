"""Token alignment, the Jaccard join and hard negatives against brute-force versions."""

import hashlib
from collections import Counter, defaultdict
from functools import cache

import duckdb
import numpy as np
import pytest
import sentencepiece
from tokenizers import Tokenizer

from natalis.llm import alignment, jaccard, rtree
from natalis.llm.base import table
from tests.llm.test_operators import SCHEMA, SF, awkward_rows, shingles

FILES = [f"{alignment.FOLDER}/{name}" for name in (alignment.FILE_A, alignment.FILE_B)]


@pytest.fixture(scope="module")
def awkward(spark):
    return spark.createDataFrame(awkward_rows(), SCHEMA).repartition(3)


@pytest.fixture(scope="module")
def nothing(spark):
    return spark.createDataFrame([], SCHEMA)


# -- alignment


@cache
def models():
    a_model, b_model = Tokenizer.from_file(FILES[0]), sentencepiece.SentencePieceProcessor(model_file=FILES[1])
    a_model.encode_special_tokens = True
    return a_model, b_model


def aligned(text):
    """Ids of both tokenizers, groups, and links, with the libraries named by the files and ends looked up one by one."""
    a_model, b_model = models()
    letters = alignment.byte_letters()
    a, b = (a_model.encode(" " + text, add_special_tokens=False).ids, b_model.encode(text)) if text else ([], [])
    a_bytes = [bytes(letters[c] for c in a_model.id_to_token(i)) for i in a]
    b_bytes = [bytes([int(p[3:-1], 16)]) if b_model.is_byte(i) else p.replace("▁", " ").encode() for i, p in zip(b, map(b_model.id_to_piece, b), strict=True)]
    if not text or not b"".join(a_bytes) == b"".join(b_bytes) == (" " + text).encode():
        return [], [], [], []
    ends = [np.cumsum([len(t) for t in side]).tolist() for side in (a_bytes, b_bytes)]
    places = [{end: k for k, end in enumerate(side)} for side in ends]
    groups, links, at = [], [], (0, 0)
    for end in sorted(set(ends[0]) & set(ends[1])):
        to = places[0][end] + 1, places[1][end] + 1
        groups.append((a[at[0] : to[0]], b[at[1] : to[1]]))
        links.append((a[to[0] - 1], b[to[1] - 1]))
        at = to
    return a, b, groups, links


ODD = ["<|endoftext|> <s> a </s><unk><0x41>", "a▁b", "x  y\t\tz\n\n", "日本語 ½²", " lead", "　\x00 \r\n", "é é", "😀😀"]


def test_alignment(spark, awkward, nothing):
    odd = spark.createDataFrame([(1000 + k, t) for k, t in enumerate(ODD)], "doc_id long, text string")
    docs = awkward.select("doc_id", "text").union(odd).union(table(spark, SF, "documents").select("doc_id", "text").limit(60)).union(spark.createDataFrame([(None, "same text"), (3, None)], "doc_id long, text string"))
    rows = docs.collect()
    want = [(r.doc_id, *aligned(r.text)) for r in rows]
    count = Counter(x for *_, links in want for x in links)
    best = defaultdict(int)
    for (_, b), n in count.items():
        best[b] = max(best[b], n)
    digest = lambda groups: hashlib.sha256(";".join("|".join(",".join(map(str, side)) for side in g) for g in groups).encode()).hexdigest() if groups else ""
    plain = [(i, len(a), len(b), len(g), len(x), sum(count[p] == best[p[1]] for p in x), sum(count[p] for p in x), digest(g)) for i, a, b, g, x in want]
    found = [tuple(r) for r in alignment.link_counts(docs).collect()]
    assert Counter(found) == Counter(plain)
    assert sum(1 for p in plain if not p[1]) >= 4 and max(p[1] for p in plain) > 50_000
    assert alignment.link_counts(nothing).count() == 0
    for r in alignment.alignments(odd).collect():
        a, b, groups, _ = aligned(ODD[r.id - 1000])
        assert (r.a, r.b) == (a, b)
        assert [(len(x), len(y)) for x, y in groups] == list(zip(np.diff([0, *r.a_cuts]), np.diff([0, *r.b_cuts]), strict=True))
        own = alignment.tokenizers(*FILES)
        a_ends, b_ends = (np.cumsum([0, *lengths[np.array(ids, int)]]) for ids, lengths in ((a, own.a_lengths), (b, own.b_lengths)))
        assert [list(range(x, y)) for x, y in zip(r.b_from, r.b_to, strict=True)] == [[j for j in range(len(b)) if b_ends[j] < a_ends[k + 1] and b_ends[j + 1] > a_ends[k]] for k in range(len(a))]


def test_gallop():
    rng = np.random.default_rng(3)
    for _ in range(200):
        a, b = (np.unique(rng.integers(0, 6000, rng.integers(0, 3000))) for _ in range(2))
        _, i, j = np.intersect1d(a, b, return_indices=True)
        found = alignment.common(a, b)
        assert found[0].tolist() == i.tolist() and found[1].tolist() == j.tolist()
        assert alignment.gallop(a, b).tolist() == np.searchsorted(b, a).tolist()


def test_long_blanks_are_encoded_alike():
    own = alignment.tokenizers(*FILES)
    text = "a" + " " * 25_000 + "b"
    assert alignment.LONG_BLANKS.search(text)
    assert own.encode(text)[0] == own.a.encode_ordinary(" " + text)


# -- Jaccard join


def linked_components(texts, share):
    """Components of (id, text) rows: all pairs compared; rows of equal id are one document."""
    sets = [(i, shingles(t)) for i, t in texts if i is not None and shingles(t)]
    up = {i: i for i, _ in sets}

    def root(x):
        while up[x] != x:
            x = up[x]
        return x

    for k, (i, a) in enumerate(sets):
        for j, b in sets[:k]:
            both = len(a & b) if min(len(a), len(b)) * 100 >= share * max(len(a), len(b)) else 0
            if both and 100 * both >= share * (len(a) + len(b) - both):
                x, y = root(i), root(j)
                up[max(x, y)] = min(x, y)
    return Counter((i, len(shingles(t)), root(i) if i in up and shingles(t) else i) for i, t in texts)


def check_join(docs, share=80):
    rows = [(r[0], r[1]) for r in docs.select("doc_id", "text").collect()]
    assert Counter(tuple(r) for r in jaccard.joined(docs, share=share).collect()) == linked_components(rows, share)


def test_join(spark, awkward, nothing):
    again = spark.createDataFrame([(None, "one two"), (None, None), (0, "one two"), (3, "a b c d e " * 40)], "doc_id long, text string")
    check_join(awkward.select("doc_id", "text").union(again))
    check_join(table(spark, SF, "documents"))
    assert jaccard.joined(nothing).count() == 0


def varied(rng, base, n, most, fresh=5):
    out = []
    for _ in range(n):
        own = list(base)
        for at in rng.integers(0, len(base), rng.integers(0, most)):
            own[at] = f"x{rng.integers(0, fresh)}"
        out.append(" ".join(own))
    return out


@pytest.mark.parametrize("boundary", [0, 9, 16])
def test_join_of_light_and_heavy_sets(spark, monkeypatch, boundary):
    """Sets on both sides of every boundary, many of them near copies, are linked alike."""
    monkeypatch.setattr(jaccard, "boundary_of_least_cost", lambda *_: boundary)
    rng = np.random.default_rng(11)
    texts = []
    for size in (1, 3, 5, 6, 8, 10, 12, 14, 17, 19, 22, 25):
        base = [f"w{size}-{k}" for k in range(size)]
        texts += varied(rng, base, 12, 3) + [" ".join([*base, *(f"y{k}" for k in range(more))]) for more in range(4)]
    check_join(spark.createDataFrame([(int(i), t) for i, t in enumerate(rng.permutation(texts))], "doc_id long, text string").repartition(3))


def test_join_of_crowded_lists(spark, monkeypatch):
    """One template, pairs around the share: small budgets split lists by two shingles and compare the rest in blocks."""
    monkeypatch.setattr(jaccard, "PAIRS", 1)
    monkeypatch.setattr(jaccard, "TOGETHER", 8)
    monkeypatch.setattr(jaccard, "BLOCK", 16)
    rng = np.random.default_rng(31)
    texts = varied(rng, [f"t{k}" for k in range(150)], 260, 9, 10**9)
    used = []
    deeper = jaccard._by_two
    monkeypatch.setattr(jaccard, "_by_two", lambda *x: used.append(1) or deeper(*x))
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    check_join(docs)
    assert used


def test_sketches_tell_long_sets_apart(spark):
    """Unrelated sets of thousands of shingles are no candidates, and linked ones meet in sketches of different widths."""
    rng = np.random.default_rng(5)
    sets = [rng.integers(0, 2**63, n).astype(np.uint64) for n in (900, 2500, 2600, 4000, 4200, 9000, 9100) * 3]
    sets += [sets[4][:3900], sets[5][:8000]]
    rows = [(1, k, k, len(s), bytearray(jaccard._sketch(s))) for k, s in enumerate(sets)]
    found = jaccard._across(spark.createDataFrame(rows, "region long, id long, component long, n long, sketch binary"), 80, 16)
    assert {tuple(r) for r in found.collect()} == {(4, 21), (5, 22)}


def recorded(monkeypatch):
    """What the mapped functions of the join return from now on, duplicates included."""
    made = []
    whole = jaccard._sorted_map
    monkeypatch.setattr(jaccard, "_sorted_map", lambda *x: made.append(whole(*x)) or made[-1])
    return made


@pytest.mark.parametrize("pairs", [2, 10**6])
def test_pairs_are_candidates_once(spark, monkeypatch, pairs):
    """Every pair of two components that shares a region is found, whatever the blocks, and but once where members know all their regions."""
    monkeypatch.setattr(jaccard, "PAIRS", pairs)
    monkeypatch.setattr(jaccard, "BLOCK", 4)
    rng = np.random.default_rng(23)
    members = {r: rng.choice(60, int(rng.integers(1, 30)), False).tolist() for r in rng.integers(-(2**62), 2**62, 12).tolist()}
    rows = [(r, i, i // 3 if i % 2 else 90) for r, ids in members.items() for i in ids]
    regions = spark.createDataFrame([*rows, rows[0]], "region long, id long, component long").repartition(3)
    nodes = spark.createDataFrame([(i, 20, bytearray(jaccard._sketch(np.arange(20, dtype=np.uint64)))) for i in range(60)], "id long, n long, sketch binary")
    component = {i: c for _, i, c in rows}
    want = {(i, j) for ids in members.values() for i in ids for j in ids if i < j and component[i] != component[j]}
    measured = jaccard._measured(regions)
    assert {r.fits for r in measured.select("fits").distinct().collect()} == ({True} if pairs > 2 else {True, False})
    for earlier in (2, 16):
        monkeypatch.setattr(jaccard, "EARLIER", earlier)
        made = recorded(monkeypatch)
        found = jaccard._across(jaccard._with_sketches(jaccard._dealt(jaccard._with_earlier(measured.distinct())), nodes), 80, 16)
        assert Counter(tuple(r) for r in found.collect()) == Counter(want)
        assert earlier == 2 or made[0].count() == len(want)
        again = jaccard._across(jaccard._with_sketches(jaccard._dealt(jaccard._with_earlier(measured)), nodes), 80, 16)
        assert {tuple(r) for r in again.collect()} == want


def test_near_copies_are_candidates_of_few_lists(spark, monkeypatch):
    """Near copies of one template meet in many lists; the candidate rows are few more than the pairs."""
    monkeypatch.setattr(jaccard, "PAIRS", 1)
    monkeypatch.setattr(jaccard, "TOGETHER", 8)
    rng = np.random.default_rng(37)
    docs = spark.createDataFrame(list(enumerate(varied(rng, [f"t{k}" for k in range(150)], 200, 9, 10**9))), "doc_id long, text string").repartition(3)
    made = recorded(monkeypatch)
    check_join(docs)
    assert 100 < made[-1].count() <= 1.5 * made[-1].distinct().count()


def test_forest_connects_what_edges_connect():
    rng = np.random.default_rng(19)
    for _ in range(200):
        n = int(rng.integers(1, 40))
        i, j = rng.integers(0, n, (2, int(rng.integers(0, 90))))
        i, j = i[i != j], j[i != j]
        length = rng.integers(0, 4, len(i))

        def roots(edges, i=i, j=j, n=n):
            up = list(range(n))
            for e in edges:
                a, b = root(up, i[e]), root(up, j[e])
                up[max(a, b)] = min(a, b)
            return [root(up, x) for x in range(n)]

        kept = jaccard.forest(i, j, length, n)
        assert len(kept) == len(set(kept.tolist())) == n - len(set(roots(kept)))
        assert roots(kept) == roots(range(len(i)))


def root(up, x):
    while up[x] != x:
        x = up[x]
    return x


def test_boundary_follows_cost():
    few, many = {n: 10 for n in range(1, 17)}, {n: 10 for n in range(1, 17)}
    assert jaccard.boundary_of_least_cost(few, {n: 10**9 for n in range(1, 17)}) == 16
    assert jaccard.boundary_of_least_cost(many, {n: 1 for n in range(1, 17)}) < 5
    for a in range(1, 40):
        for b in range(1, 40):
            need = jaccard.required(a, b)
            assert all((100 * o >= 80 * (a + b - o)) == (o >= need) for o in range(min(a, b) + 1))


# -- hard negatives


def brute(rows, every=100, share=80, kept=5):
    sound = [(i, lab, np.array([int(np.floor(np.float64(x) * 256)) for x in v], object)) for i, v, lab in rows if lab is not None and v is not None and all(x is not None and np.isfinite(x) for x in v)]
    score = lambda a, b: int(sum(x * y for x, y in zip(a, b, strict=False)))
    out = []
    for k, (i, lab, v) in enumerate(sound):
        if i is None or i % every:
            continue
        scored = sorted(((score(v, w), j, other) for n, (j, other, w) in enumerate(sound) if n != k), key=lambda s: (-s[0], s[1] is None, s[1] or 0))
        for ps, p, _ in [s for s in scored if s[2] == lab][:kept]:
            hits = [s for s in scored if s[2] != lab and share * ps <= 100 * s[0] <= 100 * ps][:kept]
            out += [(i, p, r, n, ps, ns) for r, (ns, n, _) in enumerate(hits, 1)]
    return Counter(out)


VECTORS = "vec_id long, embedding array<float>, label int, score long, id int"


def vectors(n=900, width=6, seed=2):
    rng = np.random.default_rng(seed)
    base = rng.normal(size=(40, width)) / 2
    rows = [(int(i), [float(x) for x in base[rng.integers(40)] + rng.normal(size=width) * (0.1 if i % 3 else 0)], int(rng.integers(0, 4)), 1, 1) for i in range(n)]
    rows += [(rows[k][0], *rows[k][1:]) for k in (0, 100, 7)]
    odd = [None, [], [1.0], [float("nan")] * width, [float("inf")] + [0.0] * (width - 1), [None] + [0.5] * (width - 1), [0.0] * width]
    rows += [(2000 + 100 * k, v, 1, 1, 1) for k, v in enumerate(odd)]
    return rows + [(3000, [0.5] * width, None, 1, 1), (None, [0.5] * width, 2, 1, 1), (-100, [0.4] * width, 3, 1, 1)]


def test_hard_negatives(spark, monkeypatch):
    monkeypatch.setattr(rtree, "TILE", 120)
    monkeypatch.setattr(rtree, "PAGE", 8)
    rows = vectors()
    frame = spark.createDataFrame(rows, VECTORS).repartition(5)
    found = Counter(tuple(r) for r in rtree.hard_negatives(frame).collect())
    assert found == brute([r[:3] for r in rows]) and len(found) > 100
    assert rtree.hard_negatives(frame.limit(0)).count() == 0


def test_hard_negatives_of_equal_vectors(spark, monkeypatch):
    """A third of all rows are one vector: they fill no tile, and ties go by id."""
    monkeypatch.setattr(rtree, "TILE", 64)
    rows = [(int(k), [0.25, 0.5] if k % 3 else [0.25, 0.5 + k / 5000], k % 2, 1, 1) for k in range(600)]
    frame = spark.createDataFrame(rows, VECTORS).repartition(4)
    tiles, _ = rtree.index(frame, "vec_id", "embedding", frame["label"])
    assert max(len(r.ids) // 8 for r in tiles.select("ids").collect()) <= 200
    assert Counter(tuple(r) for r in rtree.hard_negatives(frame).collect()) == brute([r[:3] for r in rows])


def test_boxes_bound_scores_and_prune():
    rng = np.random.default_rng(9)
    values = np.sort(rng.integers(-300, 300, (2000, 3)), 0)
    tile = rtree.Tile.packed(np.arange(2000), np.zeros(2000, bool), np.zeros(2000, np.int64), values, [0, 1, 2])
    assert tile.firsts[-1] == 2000 and sorted(tile.ids) == list(range(2000))
    for k in range(len(tile.firsts) - 1):
        rows = tile.vectors[tile.firsts[k] : tile.firsts[k + 1]]
        assert (rows.min(0) == tile.low[tile.nodes + k]).all() and (rows.max(0) == tile.high[tile.nodes + k]).all()
    wide = np.full((1, 3), 1 << 40)
    assert rtree.exact(wide, wide)[0].dtype == np.int64 and rtree.exact(values, values)[0].dtype == np.float64


def test_hard_negatives_agree_with_sql(spark):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW embeddings AS SELECT * FROM read_parquet('{SF}/embeddings.parquet')")
    found = Counter(tuple(r) for r in rtree.op13_rtree(spark, SF).collect())
    assert found == Counter(con.execute(rtree.OP13_SQL).fetchall())
