"""Each operator against brute force, on odd rows and on planted cases."""

from __future__ import annotations

import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
import xxhash
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from layerloom.llm import (
    block_names,
    contamination,
    languages,
    line_chunks,
    packing,
    simhash,
    substrings,
    token_counts,
    tool_calls,
    toxicity,
)
from layerloom.llm.components import components
from layerloom.llm.scratch import Scratch

VOCAB = public_tokenizers.path("byte_bpe_50k.json")

#: Columns that clash with names the operators use inside.
CLASHING = (
    "row_id", "part", "number", "edge", "name", "pos", "left", "key", "id", "place", "start", "length", "fp",
    "root", "item_id", "shingle", "h", "n", "w", "toxic", "feature", "score", "rank", "chunk", "kept", "_hit", "_id",
)

DOCS = "doc_id bigint, text string, lang string, source string"

PASSAGE = "the quick brown fox jumps over the lazy dog while seven wizards hex a jolly old box of quartz"

TEXTS = [
    (1, "one two three four five six seven"),
    (2, None),
    (3, ""),
    (4, " \t\n "),
    (5, f"before it\n{PASSAGE}\nsecond line of it\nthird line of it\nafter"),
    (6, "one  two\tthree four five six seven"),
    (7, f"other words\n{PASSAGE}\nsecond line of it\nthird line of it\nmore"),
    (8, "é中文😀ß " * 40),
    (9, "aaaaaaaaaa" * 30),
    (10, "long " + "word and " * 6000),
    (11, f"{PASSAGE} " * 3 + "<|endoftext|> it's we'll 'r"),
    (11, f"{PASSAGE} " * 3 + "<|endoftext|> it's we'll 'r"),
    (12, "one two three four five six seven"),
    (None, "one two three four five six seven"),
    (13, "line\n" * 50),
    (14, "a"),
]


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(i, t, None if k % 5 == 0 else "en", None) for k, (i, t) in enumerate(TEXTS)]
    frame = spark.createDataFrame(rows, DOCS).repartition(3)
    return frame.withColumns({c: F.lit("clash") for c in CLASHING})


@pytest.fixture(scope="module")
def nothing(spark):
    return spark.createDataFrame([], DOCS)


def as_text(t: str | None) -> str:
    return t or ""


# Exact duplicates


def test_block_names_group_equal_texts(docs):
    found = block_names.duplicates(docs, block_bytes=16).collect()
    assert len(found) == len(TEXTS)
    groups = defaultdict(list)
    for i, t in TEXTS:
        groups[re.sub(r"[\x20\x09-\x0D]+", " ", as_text(t))].append(i)
    by_sha = {hashlib.sha256(t.encode()).hexdigest(): ids for t, ids in groups.items()}
    for r in found:
        ids = by_sha[r.text_sha256]
        assert r.group_size == len(ids)
        assert r.keep_id == min(i for i in ids if i is not None)
    assert Counter(r.text_sha256 for r in found if r.kept) == dict.fromkeys(by_sha, 1)
    assert all(r.doc_id == r.keep_id for r in found if r.kept)
    assert len({(r.n_blocks, r.name) for r in found}) == len(groups)


def test_names_depend_neither_on_partitions_nor_on_hot_blocks(spark):
    rows = [(i, "x" * 40 + ("same" if i % 3 else str(i))) for i in range(300)]
    frame = spark.createDataFrame(rows, "doc_id bigint, text string")
    runs = [
        {r.doc_id: (r.n_blocks, r.name, r.keep_id) for r in block_names.duplicates(f, block_bytes=8).collect()}
        for f in (frame, frame.repartition(7, "doc_id"))
    ]
    assert runs[0] == runs[1]
    assert len(set(runs[0].values())) == 101


def test_drop_duplicates_keeps_columns_and_one_row(docs, nothing):
    kept = block_names.drop_duplicates(docs)
    assert kept.columns == docs.columns
    assert sorted(r.doc_id for r in kept.collect()) == [1, 2, 4, 5, 7, 8, 9, 10, 11, 13, 14]
    assert block_names.drop_duplicates(nothing).count() == 0
    assert block_names.duplicates(nothing).count() == 0


# Token counts


def test_token_counts_are_those_of_the_library(docs, nothing):
    tokenizer = Tokenizer.from_file(VOCAB)
    n = lambda t: len(tokenizer.encode(t, add_special_tokens=False).ids)
    found = token_counts.count_tokens(docs, VOCAB, limit=20).collect()
    texts = dict(TEXTS)
    assert len(found) == len(TEXTS)
    for r in found:
        text = as_text(texts[r.doc_id])
        assert (r.n_bytes, r.n_tokens, r.over_limit) == (len(text.encode()), n(text), n(text) > 20)
        assert n(text[: r.fits_chars]) <= 20
        assert r.fits_chars == len(text) or n(text[: r.fits_chars + 1]) > 20
    assert token_counts.count_tokens(nothing, VOCAB).count() == 0


def test_every_prefix_has_its_own_count(spark):
    tokenizer = Tokenizer.from_file(VOCAB)
    rng = random.Random(3)
    parts = [*"ab'sretlvmd  \n\t12!?éß½²ªº  中文😀_\x1c\x85Ⅷ", "<|endoftext|>", "'re", " the", "llll"]
    texts = ["".join(rng.choices(parts, k=rng.randint(0, 12))) for _ in range(300)]
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    table = token_counts.prefix_table(frame, VOCAB)
    asked = table.select(
        "doc_id",
        "prefix_tokens",
        token_counts.tokens_of_prefix("prefix_tokens", 3).alias("of_3"),
        token_counts.longest_prefix("prefix_tokens", 2).alias("in_2"),
    )
    for r in asked.collect():
        text = texts[r.doc_id]
        want = [
            len(tokenizer.encode(text[:i], add_special_tokens=False).ids) for i in range(len(text) + 1)
        ]
        assert r.prefix_tokens == want
        assert r.of_3 == want[min(3, len(text))]
        assert r.in_2 == max(i for i, n in enumerate(want) if n <= 2)


# Packing


def test_packing_covers_every_token_once(docs, nothing):
    tokenizer = Tokenizer.from_file(VOCAB)
    found = packing.pack(docs, VOCAB, capacity=64).collect()
    ids = {i: [*tokenizer.encode(as_text(t), add_special_tokens=False).ids, 0] for i, t in TEXTS}
    copies = Counter(i for i, _ in TEXTS)
    bins, pieces = defaultdict(list), Counter()
    for r in found:
        own = np.array(ids[r.doc_id][r.start : r.start + r.length], dtype="<u4")
        assert zlib.crc32(own.tobytes()) == r.ids_crc32
        bins[r.sequence_id].append((r.offset, r.length))
        pieces[r.doc_id, r.piece, r.start, r.length] += 1
    for i, own in ids.items():
        first = len(own) % 64 or 64
        starts = [0, *range(first, len(own), 64)]
        ends = [*starts[1:], len(own)]
        for k, (a, b) in enumerate(zip(starts, ends, strict=True)):
            assert pieces.pop((i, k, a, b - a)) == copies[i]
    assert not pieces
    for placed in bins.values():
        at = 0
        for offset, length in sorted(placed):
            assert offset == at
            at += length
        assert at <= 64
    assert packing.pack(nothing, VOCAB).count() == 0


def best_bins(sizes: list[int], capacity: int) -> int:
    """Fewest bins, by trying all placements."""
    best = len(sizes)

    def place(i: int, bins: list[int]) -> None:
        nonlocal best
        if len(bins) >= best:
            return
        if i == len(sizes):
            best = len(bins)
            return
        for k in range(len(bins)):
            if bins[k] + sizes[i] <= capacity and bins[k] not in bins[:k]:
                place(i + 1, [*bins[:k], bins[k] + sizes[i], *bins[k + 1 :]])
        place(i + 1, [*bins, sizes[i]])

    place(0, [])
    return best


def test_bin_completion_reaches_the_optimum_of_small_cases():
    rng = random.Random(5)
    extra = 0
    for _ in range(60):
        sizes = sorted((rng.randint(1, 20) for _ in range(9)), reverse=True)
        places = packing.plan_bins(dict(Counter(sizes)), 20)
        used = sum(p[2] * p[4] for p in places)
        assert used == len(sizes)
        extra += max(p[5] + p[4] for p in places) - best_bins(sizes, 20)
    assert extra <= 1


# SimHash


def slow_fingerprint(text: str) -> int:
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text))
    if not words:
        return 0
    shingles = [" ".join(words[i : i + 3]) for i in range(len(words) - 2)] or [" ".join(words)]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def groups_of(links, nodes) -> dict:
    parent = {n: n for n in nodes}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in links:
        a, b = root(a), root(b)
        parent[max(a, b)] = min(a, b)
    return {n: root(n) for n in nodes}


def test_near_duplicates_against_all_pairs(spark, docs, nothing):
    base = [f"w{i}" for i in range(400)]
    rows = list(enumerate(t for _, t in TEXTS))
    for k in range(30):
        words = list(base)
        words[k * 7] = "changed"
        rows.append((100 + k, " ".join(words)))
    frame = spark.createDataFrame(rows, "doc_id bigint, text string")
    found = {r.doc_id: r for r in simhash.near_duplicates(frame).collect()}
    prints = {i: slow_fingerprint(as_text(t)) for i, t in rows}
    linked = [
        (a, b) for a in prints for b in prints if a < b and (prints[a] ^ prints[b]).bit_count() <= 3
    ]
    assert any(prints[a] != prints[b] for a, b in linked)
    want = groups_of(linked, prints)
    for i, r in found.items():
        assert (r.fingerprint, r.component_id) == (f"{prints[i]:016x}", want[i])
    kept = simhash.drop_near_duplicates(frame)
    assert sorted(r.doc_id for r in kept.collect()) == sorted(set(want.values()))
    assert len(simhash.near_duplicates(docs).collect()) == len(TEXTS)
    once = simhash.drop_near_duplicates(docs)
    assert once.columns == docs.columns
    assert once.where("doc_id = 11").count() == 1
    assert simhash.near_duplicates(nothing).count() == 0
    assert simhash.drop_near_duplicates(nothing).count() == 0


def test_large_entries_give_the_same_groups(monkeypatch):
    rng = np.random.default_rng(0)
    fps = np.unique(
        np.uint64(0x1122334455000000) | rng.integers(0, 1 << 24, 2000, dtype=np.uint64)
    )
    pairs = simhash._links_within(fps, 0xFFFFFFFFFF000000, 3)
    monkeypatch.setattr(simhash, "PAIRS_UP_TO", 10)
    assert groups_of(simhash._links_within(fps, 0xFFFFFFFFFF000000, 3), range(len(fps))) == groups_of(
        pairs, range(len(fps))
    )


def test_components_of_chains_and_stars(spark):
    chain = [(i, i + 1) for i in range(0, 60)]
    star = [(100, 200 + i) for i in range(40)]
    rng = random.Random(1)
    names = list(range(1000))
    rng.shuffle(names)
    links = [(names[a], names[b]) for a, b in chain + star]
    frame = spark.createDataFrame(links, "a bigint, b bigint")
    found = {r.node: r.root for r in components(frame, Scratch(spark)).collect()}
    assert found == groups_of(links, {n for pair in links for n in pair})


# Decontamination


def test_contained_items_by_definition(spark, docs, nothing):
    items = [
        (1, PASSAGE),
        (2, "Wizards, hex!"),
        (3, None),
        (4, " . "),
        (5, PASSAGE.upper().replace(" ", ", ")),
        (5, PASSAGE),
        (6, " ".join(PASSAGE.split()[:9]) + " and then something else entirely that no document has"),
        (None, "one two three four five six seven"),
    ]
    items_frame = spark.createDataFrame(items, "item_id bigint, text string").withColumn("doc_id", F.lit("x"))
    found = contamination.contained_items(docs, items_frame).collect()
    words = lambda t: re.findall(r"[^\W_]+", as_text(t).lower())
    want = {}
    for d, t in TEXTS:
        for i, item in items:
            w, k = words(t), words(item)
            n = min(5, len(k))
            if not n:
                continue
            of_item = {tuple(k[j : j + n]) for j in range(len(k) - n + 1)}
            of_doc = {tuple(w[j : j + n]) for j in range(len(w) - n + 1)}
            if len(of_item & of_doc) / len(of_item) >= 0.8:
                want[d, i] = (len(of_item), len(of_item & of_doc))
    assert {(r.doc_id, r.item_id): (r.n_shingles, r.n_found) for r in found} == want
    assert len(found) == len(want) > 5
    clean = contamination.drop_contaminated(docs, items_frame)
    assert clean.columns == docs.columns
    assert {r.doc_id for r in clean.collect()} == {i for i, _ in TEXTS} - {d for d, _ in want}
    assert contamination.contained_items(nothing, items_frame).count() == 0
    assert contamination.contained_items(docs, items_frame.limit(0)).count() == 0
    assert contamination.drop_contaminated(docs, items_frame.limit(0)).count() == len(TEXTS)


def test_a_shuffled_sketch_join_finds_the_same(spark, docs, monkeypatch):
    items = spark.createDataFrame([(1, PASSAGE)], "item_id bigint, text string")
    one = contamination.contained_items(docs, items).collect()
    monkeypatch.setattr(contamination, "BROADCAST_ROWS", 0)
    assert sorted(contamination.contained_items(docs, items).collect()) == sorted(one)


# Tool calls

SCHEMAS = [
    ("find", '{"properties": {"q": {"type": "string"}, "n": {"type": "integer", "minimum": 1, "maximum": 9}}, '
             '"required": ["q"], "additionalProperties": false}'),
    ("open", '{"properties": {"kind": {"type": "string", "enum": ["a", "b"]}, "x": {"type": "number"}}}'),
]


def test_tool_calls_link_order_and_validate(spark):
    call = lambda i, name, arguments: f'{{"id": "{i}", "name": "{name}", "arguments": {arguments}}}'
    message = lambda *calls: f'{{"tool_calls": [{", ".join(calls)}]}}'
    rows = [
        (1, 0, "assistant", message(
            call("c", "open", '{"x": {"$ref": "b"}, "kind": "a"}'),
            call("b", "find", '{"q": {"$ref": "a"}}'),
            call("a", "find", '{"q": "\\u00e9 \\"x\\"", "n": 3}'))),
        (1, 1, "tool", '{"tool_call_id": "a", "content": "late"}'),
        (1, 1, "tool", '{"tool_call_id": "a", "content": "first"}'),
        (1, 2, "tool", '{"tool_call_id": "gone", "content": "x"}'),
        (2, 0, "assistant", message(call("a", "find", '{"n": 12, "z": 1}'), call("d", "none", "{}"))),
        (2, 1, "assistant", message(
            call("e", "open", '{"kind": "c", "x": "no"}'), call("f", "find", '"text"'), call("g", "open", '[1]'))),
        (3, 0, "assistant", message(
            call("p", "open", '{"x": {"$ref": "q"}}'), call("q", "open", '{"x": {"$ref": "p"}}'), call("r", "open", "{}"))),
        (3, 1, "assistant", "plain words"), (3, 2, "assistant", None), (3, 3, "assistant", ""), (3, 4, None, "x"),
        (None, 0, "assistant", message(call("a", "open", '{"x": 1.5}'))),
        (None, 1, "tool", '{"tool_call_id": "a", "content": "never"}'),
    ]
    messages = spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string")
    messages = messages.withColumns({"name": F.lit("x"), "schema": F.lit("x"), "level": F.lit(1)})
    schemas = spark.createDataFrame(SCHEMAS, "name string, schema string")
    found = tool_calls.link_calls(messages, schemas).collect()
    got = {(r.conv_id, r.call_id): r for r in found}
    assert len(got) == len(found) == 13
    assert [got[1, i].level for i in "abc"] == [0, 1, 2]
    assert got[1, "a"].arguments == '{"n":3,"q":"é \\"x\\""}'
    assert (got[1, "a"].result, got[1, "a"].n_results, got[1, "a"].result_turn) == ("first", 2, 1)
    assert (got[1, "gone"].name, got[1, "gone"].n_calls_of_id) == (None, 0)
    assert {k: r.errors for k, r in got.items() if r.errors} == {
        (2, "a"): "missing:q,range:n,unknown:z",
        (2, "d"): "unknown_tool",
        (2, "e"): "enum:kind,type:x",
        (2, "f"): "invalid_json",
        (2, "g"): "invalid_json",
    }
    assert [got[3, i].level for i in "pqr"] == [None, None, 0]
    assert (got[None, "a"].errors, got[None, "a"].n_results) == ("", 0)
    assert tool_calls.link_calls(messages.limit(0), schemas).count() == 0
    assert tool_calls.link_calls(messages, schemas.limit(0)).count() == 13


def test_repeated_calls_and_results_do_not_multiply(spark):
    text = '{"tool_calls": [{"id": "a", "name": "open", "arguments": {}}]}'
    rows = [(1, i, "assistant", text) for i in range(50)]
    rows += [(1, 100 + i, "tool", '{"tool_call_id": "a", "content": "r"}') for i in range(50)]
    messages = spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string")
    schemas = spark.createDataFrame(SCHEMAS, "name string, schema string")
    found = tool_calls.link_calls(messages, schemas).collect()
    assert len(found) == 50
    assert {(r.n_calls_of_id, r.n_results, r.result_turn) for r in found} == {(50, 50, 100)}


# Line chunks


def slow_chunks(text: str) -> list[tuple[int, list[str]]]:
    lines, out, start = text.split("\n"), [], 0
    h = [0, 0] + [int(hashlib.md5(line.encode()).hexdigest()[:7], 16) for line in lines]
    rolled = [(h[i + 2] + 31 * h[i + 1] + 961 * h[i]) % 1000003 for i in range(len(lines))]
    for i in range(len(lines)):
        inside = 1 <= i <= len(lines) - 3
        if i == len(lines) - 1 or inside and rolled[i] < min(rolled[i - 1], rolled[i + 1]):
            out.append((start, lines[start : i + 1]))
            start = i + 1
    return out


def test_repeated_line_chunks_go(spark, docs, nothing):
    rng = random.Random(2)
    shared = [f"shared line {i}" for i in range(30)]
    rows = [(k, "\n".join([f"own {k} {rng.random()}", *shared, f"end {k}"])) for k in range(20)]
    rows += [(100 + k, t) for k, (_, t) in enumerate(TEXTS)]
    frame = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(4)
    found = {r.doc_id: r for r in line_chunks.drop_repeated_chunks(frame).collect()}
    seen, removed = set(), 0
    for i, t in sorted(rows):
        kept, gone = [], 0
        for _, lines in slow_chunks(as_text(t)):
            chunk = "\n".join(lines)
            if len(lines) > 1 and chunk.strip(" \t\n\v\f\r") and chunk in seen:
                gone += len(lines)
            else:
                kept += lines
            if len(lines) > 1:
                seen.add(chunk)
        want = as_text(t) if not gone else "\n".join(kept)
        assert (found[i].text, found[i].n_removed) == (want, gone)
        removed += gone
    assert removed > 19 * 20
    assert line_chunks.drop_repeated_chunks(docs).count() == len(TEXTS)
    assert line_chunks.drop_repeated_chunks(nothing).count() == 0


def test_copies_of_several_lines_leave_nothing_and_moved_passages_little(spark):
    rng = random.Random(5)
    line = lambda: " ".join(rng.choice("abcdefgh") * rng.randint(1, 9) for _ in range(6))
    texts = ["\n".join(line() for _ in range(n)) for n in range(2, 60)]
    texts += ["same\n" * 40 + "end", "\n\n\nthree above\n\n\n", "\n\n \t\n"]
    passage = "\n".join(line() for _ in range(200))
    moved = [f"{line()}\n" * k + passage + f"\n{line()}" * (k % 3) for k in range(8)]
    rows = list(enumerate([*texts, *texts, *moved]))
    frame = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(5)
    found = {r.doc_id: r for r in line_chunks.drop_repeated_chunks(frame).collect()}
    for i, text in enumerate(texts):
        assert found[i].text == text or "same" in text
        blank = not text.strip()
        assert found[len(texts) + i].text.strip() == "" and (found[len(texts) + i].n_removed == 0) == blank
    for k in range(1, 8):
        assert found[2 * len(texts) + k].n_removed >= 188


def test_a_text_of_very_many_lines_is_one_row(spark):
    text = "\n".join(f"line {i % 99_991}" for i in range(300_000))
    frame = spark.createDataFrame([(1, text), (2, text), (2, None), (None, "")], "doc_id bigint, text string")
    found = line_chunks.drop_repeated_chunks(frame.withColumn("chunk", F.lit(1))).collect()
    gone = sorted(r.n_removed for r in found if r.n_lines > 1)
    assert len(found) == 4 and 199_000 < gone[0] < 300_000 and gone[1] == 300_000


# Shared byte strings


def slow_removal(rows: list[tuple]) -> dict:
    last = 1 << 63
    first: dict[bytes, int] = {}
    order = [(last if i is None else i, as_text(t).encode()) for i, t in rows]
    for i, data in sorted(order):
        for at in range(len(data) - 49):
            first.setdefault(data[at : at + 50], i)
    found = []
    for i, data in order:
        gone = bytearray(len(data))
        for at in range(len(data) - 49):
            if first[data[at : at + 50]] < i:
                gone[at : at + 50] = b"\1" * 50
        spans = len(re.findall(b"\1+", bytes(gone)))
        found.append((len(data), sum(gone), spans, bytes(b for b, g in zip(data, gone, strict=True) if not g)))
    return Counter(found)


@pytest.mark.parametrize("most", [2, 20_000])
def test_shared_strings_go(spark, docs, nothing, monkeypatch, most):
    monkeypatch.setattr(substrings, "MOST_CONTEXTS", most)
    rng = random.Random(4)
    noise = lambda n: "".join(rng.choices("abcdefgh éß", k=n))
    shared = [noise(n) for n in (49, 50, 51, 90, 400)]
    rows = [(i, noise(rng.randint(0, 60)) + rng.choice(shared) + noise(rng.randint(0, 60))) for i in range(60)]
    rows += [(i, "ab" * rng.randint(10, 200)) for i in range(60, 66)]
    rows += [(None if i is None else 100 + i, t) for i, t in TEXTS if len(as_text(t)) < 5000]
    frame = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(4)
    found = substrings.drop_shared_strings(frame).withColumn(
        "left", F.coalesce("kept", F.encode(F.lit(""), "utf-8"))
    )
    texts = Counter()
    for r in found.collect():
        texts[r.n_bytes, r.n_removed, r.n_spans, hashlib.sha256(bytes(r.kept)).hexdigest() if r.kept is not None else r.kept_sha256] += 1
        assert r.kept is None or hashlib.sha256(bytes(r.kept)).hexdigest() == r.kept_sha256
    want = Counter({(*k[:3], hashlib.sha256(k[3]).hexdigest()): n for k, n in slow_removal(rows).items()})
    assert texts == want
    assert substrings.drop_shared_strings(docs).count() == len(TEXTS)
    assert substrings.drop_shared_strings(nothing).count() == 0


# Languages and toxicity

SOUNDS = {"xx": ["ka", "ki", "ku", "to", "ro"], "yy": ["ber", "sch", "ung", "ein", "tz"], "zz": ["é", "eau", "oi", "qu", "ar"]}


def spoken(rng: random.Random, lang: str, n: int) -> str:
    return " ".join("".join(rng.choices(SOUNDS[lang], k=rng.randint(1, 4))) for _ in range(n))


def test_languages_of_held_out_texts(spark, docs, nothing):
    rng = random.Random(6)
    rows = [(i, spoken(rng, l, rng.randint(3, 80)), l) for i in range(300) for l in [rng.choice(list(SOUNDS))]]
    frame = spark.createDataFrame(rows, "doc_id bigint, text string, lang string")
    filters = languages.train(frame, taught=F.col("doc_id") % 3 != 0)
    assert sorted(filters.langs) == sorted(SOUNDS)
    found = {r.doc_id: r for r in languages.identify(frame, filters).collect()}
    assert all(found[i].lang_pred == l for i, _, l in rows)
    assert all(0 <= r.score <= 1 for r in found.values())
    odd = {r.doc_id: r for r in languages.identify(docs, filters).collect()}
    assert [odd[i].lang_pred for i in (2, 3, 4)] == ["und"] * 3
    assert odd[14].lang_pred in SOUNDS
    assert len(languages.identify(docs, filters).collect()) == len(TEXTS)
    untaught = languages.train(nothing)
    assert {r.lang_pred for r in languages.identify(docs, untaught).collect()} == {"und"}
    assert languages.identify(nothing, filters).count() == 0


def test_filters_contain_all_members_and_few_others():
    rng = np.random.default_rng(1)
    members = [rng.integers(0, 1 << 63, 5000, dtype=np.uint64) for _ in range(70)]
    filters = languages.LanguageFilters([str(i) for i in range(70)], members)
    for i in (0, 63, 64, 69):
        masks = filters.masks(members[i])[i // 64]
        assert (masks >> np.uint64(i % 64) & np.uint64(1)).all()
        assert filters.shares(members[i]).argmax() == i
    other = filters.shares(rng.integers(0, 1 << 63, 20_000, dtype=np.uint64))
    assert other.max() < 0.01


@pytest.fixture(scope="module")
def judged(spark):
    rng = random.Random(7)
    bad = ["grumbold", "snarkwit", "flobberer"]
    docs, labels = [], []
    for i in range(400):
        words = spoken(rng, "xx", 60).split()
        toxic = int(i % 4 == 0)
        if toxic:
            for _ in range(2):
                words[rng.randrange(60)] = rng.choice(bad)
        docs.append((i, " ".join(words)))
        labels.append((i, toxic))
    labels += [(None, 1), (1, None), (4, 0), (9999, 1)]
    frame = spark.createDataFrame(docs, "doc_id bigint, text string")
    return frame, spark.createDataFrame(labels, "doc_id bigint, toxic int")


def test_toxicity_of_disguised_words(spark, judged, docs, nothing):
    frame, labels = judged
    model = toxicity.train(frame, labels, taught=F.col("doc_id") % 5 != 0)
    found = {r.doc_id: r for r in toxicity.score(frame, model).collect()}
    assert all(r.predicted == int(i % 4 == 0) for i, r in found.items())
    tests = ["kaki grumbold roto", "kaki gr0mbold g r u m b o l d", "Sn@rkw1t!", "fl0bb3r3r", "s.n.a.r.k.w.i.t",
             "grumbooooold", "SNARK-WIT", "gr*mbold", "kaki roto kuku", "", None, "12 34 !! 0", "k a k i"]
    odd = spark.createDataFrame(list(enumerate(tests)), "doc_id bigint, text string")
    scores = {r.doc_id: r.predicted for r in toxicity.score(odd, model).collect()}
    assert [scores[i] for i in range(len(tests))] == [1] * 8 + [0] * 5
    kept = toxicity.drop_toxic(docs.unionByName(odd, allowMissingColumns=True), model)
    assert kept.columns == docs.columns
    assert kept.count() == len(TEXTS) + 5
    assert toxicity.score(nothing, model).count() == 0
    nobody = toxicity.train(nothing, labels)
    assert {r.score for r in toxicity.score(docs, nobody).collect()} == {0.0}


def test_copied_toxic_texts_teach_only_once(spark):
    rng = random.Random(8)
    copied = spoken(rng, "yy", 50)
    rows = [(i, copied if i < 60 else spoken(rng, "xx", 40) + " grumbold") for i in range(160)]
    rows += [(i, spoken(rng, "xx", 50)) for i in range(160, 600)]
    labels = spark.createDataFrame([(i, int(i < 160)) for i in range(600)], "doc_id bigint, toxic int")
    model = toxicity.train(spark.createDataFrame(rows, "doc_id bigint, text string"), labels)
    assert "grumbold" in model.evidence
    assert not any(word in model.evidence for word in copied.split())


def test_few_texts_of_many_teach_and_a_join_scores_as_sent_evidence_does(spark):
    rng = random.Random(9)
    word = lambda: "".join(rng.choices("abcdefghijklmnop", k=9))
    plain = [word() for _ in range(400)]
    rows, labels = [], []
    for i in range(6000):
        own = rng.choices(plain, k=12) + ([word(), "zzvile", word()] if i < 2400 else [])
        if 2400 <= i < 2408:
            own += [word(), "rarecurse", word()]
        if i == 5999:
            own += ["rarecurse"] * 3
        rng.shuffle(own)
        rows.append((i, " ".join(own)))
        if i < 5500:
            labels.append((i, int(i < 2408)))
    rows += [(6000, None), (6000, ""), (None, "a r-a-r-e-c-u-r-s-e here")]
    frame = spark.createDataFrame(rows, "doc_id bigint, text string").withColumn("feature", F.lit(1)).repartition(4)
    known = spark.createDataFrame(labels, "doc_id bigint, toxic int")
    sent, joined = toxicity.train(frame, known), toxicity.train(frame, known, sent_features=0)
    assert joined.evidence is None and {"rarecurse", "zzvile"} <= set(sent.evidence)
    results = [
        sorted((str(r.doc_id), round(r.score, 9), r.predicted) for r in toxicity.score(frame, m).collect())
        for m in (sent, joined)
    ]
    assert results[0] == results[1]
    assert ("5999", 1) in {(i, p) for i, _, p in results[0]}
    kept = [sorted(map(repr, toxicity.drop_toxic(frame, m).collect())) for m in (sent, joined)]
    assert kept[0] == kept[1] and 3500 < len(kept[0]) < 3600
