"""Vector codes, exact search and ranked lexical search against brute force, on odd rows and on ties."""

from __future__ import annotations

import hashlib
import math
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from layerloom.llm import lexical_search, vector_codes, vector_search

NAN, INF = float("nan"), float("inf")
VECTORS = "vec_id bigint, embedding array<float>, label int"
CLASHING = ("row", "part", "place", "v", "entry", "error", "shard", "n", "rank", "score", "query", "cell", "gap", "asks", "_label")


def vector_rows(n: int, size: int = 8, seed: int = 1) -> list[tuple]:
    """Random vectors with copies, ties, odd components, null ids and vectors of other lengths."""
    draw = np.random.default_rng(seed)
    made = draw.normal(scale=0.3, size=(n, size)).astype(np.float32)
    made[5::7] = made[3]
    rows = [(i, made[i].tolist(), None if i % 11 == 0 else i % 3) for i in range(n)]
    odd = [None, [NAN] * size, [0.5] * (size - 1) + [None], [INF] + [0.0] * (size - 1), [], [0.25] * (size + 4)]
    rows += [(n + k, vector, 1) for k, vector in enumerate(odd)]
    return [*rows, rows[4], rows[4], (None, made[2].tolist(), 2)]


@pytest.fixture(scope="module")
def vectors(spark):
    frame = spark.createDataFrame(vector_rows(700), VECTORS).repartition(5)
    return frame.withColumns({c: F.lit("clash") for c in CLASHING})


def kept_rows(rows: list[tuple], scale: int, size: int = 8) -> list[tuple]:
    kept = [r for r in rows if r[1] is not None and len(r[1]) == size]
    kept = [r for r in kept if all(x is not None and math.isfinite(x) for x in r[1])]
    whole = [(i, [math.floor(scale * float(np.float32(x))) for x in v], label) for i, v, label in kept]
    return sorted(whole, key=lambda r: (r[0] is None, r[0] or 0, r[1]))


def trained_by_hand(points: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    book = points[:256].copy()
    nearest = lambda: ((points[:, None, :] - book[None, :, :]) ** 2).sum(axis=2)
    for _ in range(4):
        own = nearest().argmin(axis=1)
        for entry in set(own.tolist()):
            book[entry] = [int(s) // int((own == entry).sum()) for s in points[own == entry].sum(axis=0)]
    far = nearest()
    return far.argmin(axis=1), far.min(axis=1), book


def test_codes_are_those_of_plain_rounds(vectors):
    rows = kept_rows(vector_rows(700), 1024)
    points = np.array([r[1] for r in rows], dtype=np.int64)
    parts = [trained_by_hand(points[:, i : i + 2]) for i in (0, 2, 4, 6)]
    errors = sum(p[1] for p in parts)
    by_label = Counter()
    for r, error in zip(rows, errors.tolist(), strict=True):
        by_label[r[2]] += error
    digest = hashlib.sha256(",".join(str(x) for p in parts for x in p[2].ravel()).encode()).hexdigest()
    expected = Counter(
        (r[0], "".join(f"{p[0][k]:02x}" for p in parts), int(errors[k]), by_label[r[2]], digest)
        for k, r in enumerate(rows)
    )
    found, books = vector_codes.compress(vectors)
    assert found.columns == ["vec_id", "code", "error", "label_error", "codebooks_sha256"]
    assert Counter(map(tuple, found.collect())) == expected
    assert all((b == p[2]).all() for b, p in zip(books, parts, strict=True))


def test_labels_without_a_broadcast_give_the_same(vectors, monkeypatch):
    expected = sorted(map(repr, vector_codes.compress(vectors)[0].collect()))
    monkeypatch.setattr(vector_codes, "LABELS", 0)
    assert sorted(map(repr, vector_codes.compress(vectors)[0].collect())) == expected


def test_few_empty_and_no_vectors(spark):
    few = spark.createDataFrame([(7, [1.0, 2.0, 3.0, 4.0], None), (9, [1.0, 2.0, 3.0, 4.5], None)], VECTORS)
    assert [(r.vec_id, r.code, r.error) for r in vector_codes.compress(few)[0].orderBy("vec_id").collect()] == [
        (7, "00000000", 0), (9, "00000001", 0),
    ]
    assert vector_codes.compress(few.limit(0))[0].count() == 0
    assert vector_search.search(few.limit(0), F.lit(True)).count() == 0
    lengths = spark.createDataFrame([(1, [], 1), (2, [], 1)], VECTORS)
    assert [tuple(r)[:3] for r in vector_codes.compress(lengths)[0].orderBy("vec_id").collect()] == [
        (1, "00000000", 0), (2, "00000000", 0),
    ]
    assert sorted(tuple(r) for r in vector_search.search(lengths, F.lit(True)).collect()) == [(1, 1, 2, 0), (2, 1, 1, 0)]
    large = spark.createDataFrame([(1, [1e30] * 4, 1)], VECTORS)
    with pytest.raises(ValueError, match="too large"):
        vector_codes.compress(large)
    with pytest.raises(ValueError, match="too large"):
        vector_search.search(large, F.lit(True))


def test_shortlists_keep_every_nearest_entry():
    draw = np.random.default_rng(3)
    for spread in (2, 20, 200):
        points = draw.integers(-spread, spread, size=(60, 3)) + draw.integers(-300, 300, size=3)
        book = draw.integers(-300, 300, size=(40, 3))
        low, high = points.min(axis=0), points.max(axis=0)
        entries = vector_codes.shortlist(low, high, book)
        nearest = ((points[:, None] - book[None]) ** 2).sum(axis=2).argmin(axis=1)
        assert set(nearest.tolist()) <= set(entries.tolist())
        found, distance = vector_codes.assign(points, book[entries])
        assert (entries[found] == nearest).all()
        assert (distance == ((points - book[nearest]) ** 2).sum(axis=1)).all()


def test_curve_visits_neighbours():
    bits, side = 3, 8
    grid = np.array([(x, y) for x in range(side) for y in range(side)])
    order = sorted(range(len(grid)), key=lambda i: vector_codes.curve_place(grid[i : i + 1], bits)[0].tobytes())
    steps = np.abs(np.diff(grid[order], axis=0)).sum(axis=1)
    assert (steps == 1).all()


def test_search_finds_what_all_products_give(vectors, monkeypatch):
    monkeypatch.setattr(vector_search, "SHARD_ROWS", 90)
    monkeypatch.setattr(vector_search, "BLOCK_ROWS", 4)
    monkeypatch.setattr(vector_search, "FIRST_TAKEN", 2)
    rows = kept_rows(vector_rows(700), 256)
    expected = Counter()
    for k, (query, own, _) in enumerate(rows):
        if query is None or query % 50:
            continue
        scored = [
            (-sum(a * b for a, b in zip(own, x, strict=True)), i is None, i or 0)
            for j, (i, x, _) in enumerate(rows)
            if j != k
        ]
        for rank, (score, unnamed, i) in enumerate(sorted(scored)[:5], 1):
            expected[query, rank, None if unnamed else i, -score] += 1
    found = vector_search.search(vectors, F.col("vec_id") % 50 == 0)
    assert Counter(map(tuple, found.collect())) == expected


def test_copies_of_a_query_are_candidates(spark):
    rows = [(1, [1.0, 0.0], None), (1, [1.0, 0.0], None), (None, [1.0, 0.0], None), (2, [0.5, 0.0], None)]
    found = vector_search.search(spark.createDataFrame(rows, VECTORS), F.col("vec_id") == 1, top=9)
    expected = [(1, 1, 1, 65536), (1, 2, None, 65536), (1, 3, 2, 32768)]
    assert Counter(map(tuple, found.collect())) == Counter(2 * expected)


TEXTS = [
    (1, "The cat sat on the mat, the CAT!"), (2, None), (3, ""), (4, "?!  -- ..."), (5, "the"), (6, "cat " * 90),
    (7, "über größe cat 42"), (8, "ÜBER grösse CAT 42"), (9, "mat mat mat dog"), (9, "mat mat mat dog"),
    (None, "mat mat mat dog"), (10, "dog " + "word and " * 30_000), (11, "a\u0085b caté"), (12, "z1 z2"),
]
ITEMS = [
    (1, "the cat, the mat"), (2, None), (3, "-"), (4, "über größe"), (5, "dog dog mat"), (5, "z2"), (None, "Z1"),
    (6, "absent"), (7, " ".join(f"w{i}" for i in range(500)) + " 42 and"),
]


def ranked_by_hand(texts, items, top):
    terms = lambda t: re.findall(lexical_search.TERM, re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
    docs = [(i, Counter(terms(t))) for i, t in texts]
    docs = [(i, c, c.total()) for i, c in docs if c]
    n_docs, n_terms = len(docs), sum(n for _, _, n in docs)
    df = Counter(t for _, c, _ in docs for t in c)
    expected = Counter()
    for item, text in items:
        scores = []
        for i, c, n in docs:
            m = 100 - 50 + (50 * n * n_docs) // n_terms
            weight = lambda t: math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1)))
            total = sum(weight(t) * ((10**9 * c[t]) // (1000 * c[t] + 20 * m)) for t in set(terms(text)) if t in c)
            if total > 0:
                scores.append((-total, i is None, i or 0))
        for rank, (score, unnamed, i) in enumerate(sorted(scores)[:top], 1):
            expected[item, rank, None if unnamed else i, -score] += 1
    return expected


@pytest.mark.parametrize("top", [2, 50])
def test_lexical_search_on_odd_texts(spark, top):
    clash = {c: F.lit("clash") for c in ("item", "rank", "score", "n", "terms", "counts", "_part")}
    docs = spark.createDataFrame(TEXTS, "doc_id bigint, text string").repartition(3).withColumns(clash)
    items = spark.createDataFrame(ITEMS, "item_id bigint, text string").withColumns(clash)
    expected = ranked_by_hand(TEXTS, ITEMS, top)
    for item_bytes in (1 << 20, 40):
        found = lexical_search.search(docs, items, top=top, item_bytes=item_bytes)
        assert found.columns == ["item_id", "rank", "doc_id", "score"]
        assert Counter(map(tuple, found.collect())) == expected
    assert lexical_search.search(docs.limit(0), items).count() == 0
    assert lexical_search.search(docs, items.limit(0)).count() == 0


def test_tries_of_any_shape_give_the_same(spark, monkeypatch):
    draw = np.random.default_rng(5)
    words = [f"w{i}" for i in range(40)]
    texts = [
        (int(i), " ".join(draw.choice(words[: draw.integers(1, 40)], size=draw.integers(0, 60)))) for i in range(600)
    ]
    texts += [(1000 + i, " ".join(words[:i])) for i in range(40)] + [(2000 + i, texts[0][1]) for i in range(80)]
    items = [(i, " ".join(draw.choice(words, size=6))) for i in range(12)]
    expected = ranked_by_hand(texts, items, 10)
    docs = spark.createDataFrame(texts, "doc_id bigint, text string").repartition(2)
    for leaf, levels, block in ((1, 64, 100), (4, 3, 10_000), (300, 64, 10_000)):
        monkeypatch.setattr(lexical_search, "LEAF", leaf)
        monkeypatch.setattr(lexical_search, "LEVELS", levels)
        monkeypatch.setattr(lexical_search, "TRIE_DOCS", block)
        found = lexical_search.search(docs, spark.createDataFrame(items, "item_id bigint, text string"), top=10)
        assert Counter(map(tuple, found.collect())) == expected


def test_bounds_leave_out_most_documents():
    """Branches whose bound cannot enter are not opened."""
    sums, opened = lexical_search._Branch.sums, []

    def counted(self, wanted):
        if self.is_leaf:
            opened.append(len(self.least_id))
        return sums(self, wanted)

    n, n_terms = 4096, 64
    draw = np.random.default_rng(7)
    lists = [np.sort(draw.choice(n_terms, size=4, replace=False)) for _ in range(n)]
    ends = np.arange(n + 1) * 4
    trie = lexical_search._Trie(
        np.arange(n), np.zeros(n, bool), np.full(n, 100), ends, np.concatenate(lists).astype(np.int32),
        np.ones(4 * n, np.int32), np.arange(n_terms), np.full(n_terms, 1000),
    )
    best = lexical_search._Best(5)
    lexical_search._Branch.sums = counted
    try:
        lexical_search._walk(trie.root, np.arange(3, dtype=np.int32), best)
    finally:
        lexical_search._Branch.sums = sums
    assert len(best.scores) == 5
    assert sum(opened) < n / 2
