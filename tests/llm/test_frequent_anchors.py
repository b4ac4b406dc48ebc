"""Anchors that most rows have, or one row very often, are never held by one task."""

from __future__ import annotations

import random
from collections import defaultdict

import numpy as np
import pyarrow as pa
import pytest

from layerloom.llm import substrings
from layerloom.llm.scratch import Scratch


@pytest.mark.parametrize("range_anchors", [20, 500_000])
def test_shared_anchors_are_those_of_several_rows(spark, monkeypatch, range_anchors):
    monkeypatch.setattr(substrings, "RANGE_ANCHORS", range_anchors)
    rng = random.Random(11)
    noise = lambda n: "".join(rng.choices("abcdefgh", k=n))
    passage = noise(120)
    rows = [(i, noise(60) + (passage if i % 3 == 0 else "") + "z" * (i % 7 * 40)) for i in range(120)]
    where = defaultdict(set)
    for i, t in rows:
        for at, h in zip(*substrings.anchors(t.encode()), strict=True):
            where[int(h)].add((i, int(at)))
    want = {p for places in where.values() if len({i for i, _ in places}) > 1 for p in places}
    frame = spark.createDataFrame(rows, "row_id bigint, text string").repartition(6)
    found = substrings._shared_anchors(frame, 3, Scratch(spark)).collect()
    assert len(found) == len(want) > 300
    assert {(r.row_id, r.place) for r in found} == want


def test_a_block_has_each_hash_once_for_its_range():
    text = "the same fifty bytes of text and more in all of the many rows"
    batch = pa.RecordBatch.from_pydict({"row_id": list(range(3000)), "text": [text] * 2999 + ["q" * 20_000]})
    blocks = pa.Table.from_batches(list(substrings._blocks(1, ends=True)(iter([batch]))))
    distinct = {int(h) for t in (text, "q" * 60) for h in substrings.anchors(t.encode())[1]}
    assert len(substrings._unpacked(blocks.column("hashes")[0].as_py())) == len(distinct)
    assert blocks.column("n")[0].as_py() > 20_000


def test_anchor_hashes_fall_evenly_into_ranges():
    """Anchors have the smallest hashes around; ranges of hashes must get equal shares of them all the same."""
    data = np.random.default_rng(5).integers(97, 123, 400_000).astype(np.uint8).tobytes()
    at, h = substrings.anchors(data)
    share = np.bincount(((h >> np.uint64(32)) * np.uint64(64) >> np.uint64(32)).astype(np.int64), minlength=64) / len(h)
    assert share.max() < 2 / 64
    assert len(np.unique(h)) == len({data[i : i + substrings.ANCHOR] for i in at.tolist()})


def test_anchors_of_texts_side_by_side_are_those_of_each_alone():
    rng = random.Random(3)
    texts = [rng.choice([b"ab", b"abcdefgh"]) * rng.randint(0, 40) + rng.randbytes(rng.randint(0, 90)) for _ in range(200)]
    number, place, h = substrings._anchors(texts)
    for i, text in enumerate(texts):
        alone = substrings.anchors(text)
        assert place[number == i].tolist() == alone[0].tolist()
        assert h[number == i].tolist() == alone[1].tolist()


def test_only_what_a_smaller_id_has_as_well_leaves_a_batch_of_contexts():
    """Equal contexts and those of the smallest id give no rows; others give the bytes of their shared windows."""
    rng = random.Random(8)
    rows = []
    for anchor in range(60):
        middle = bytes(rng.choices(b"ab", k=substrings.ANCHOR)) if anchor % 3 else b"a" * substrings.ANCHOR
        for chunk in range(rng.randint(1, 6)):
            sides = [bytes(rng.choices(b"ab" if anchor % 2 else b"a", k=rng.randint(20, 26))) for _ in range(2)]
            rows.append((anchor, 100 * anchor + chunk, 7, sides[0] + middle + sides[1], rng.randint(0, 9)))
    rows = [r for r in rows if len(r[3]) >= substrings.LENGTH]
    kinds = {"anchor": pa.int64(), "chunk_id": pa.int64(), "at": pa.int32(), "context": pa.binary(), "id": pa.int64()}
    batch = pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds.values(), strict=True)], names=[*kinds])
    found = defaultdict(set)
    for r in pa.Table.from_batches(list(substrings._smaller(iter([batch])))).to_pylist():
        found[r["chunk_id"]] |= set(range(r["a"] - 7, r["b"] - 7))
    windows = lambda c: {c[i : i + 50]: i for i in range(len(c) - 49)}
    least: dict[bytes, int] = {}
    for *_, context, i in rows:
        for w in windows(context):
            least[w] = min(i, least.get(w, i))
    # Strings of one letter are shared across anchors too, which is as right.
    want = {}
    for *_, chunk, _, context, i in rows:
        gone = [s for s in range(len(context) - 49) if least[context[s : s + 50]] < i]
        want[chunk] = {b for s in gone for b in range(s, s + 50)}
    several = {r[1] for r in rows if len({x[3] for x in rows if x[0] == r[0]}) > 1}
    assert len(several) > 100
    assert all(found[c] == want[c] for c in several)
    assert all(not found[chunk] for _, chunk, _, context, i in rows if all(least[w] == i for w in windows(context)))
