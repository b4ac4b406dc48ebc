"""Each stage of the pipeline against a plain version of its rule, on odd rows."""

from __future__ import annotations

import re

import public_tokenizers
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from layerloom.llm import toxicity
from layerloom.llm.simhash import fingerprint

FOLDER = "/root/testdata/sf0.001"
STAGES = dict(corpus_pipeline.STAGES)
ITEM = pq.read_table(f"{FOLDER}/benchmark.parquet").to_pylist()[0]["text"]
ODD = [
    (900_001, None), (900_002, ""), (900_003, " \n"), (900_004, "some  words here"), (900_005, "some words here"),
    (900_006, f"before it {ITEM} after it"), (900_006, "a clean row of the same id"), (None, f"{ITEM}"),
    (None, "a clean row without an id"), (900_007, "long " * 400_000), (900_008, "A clean row of the same ID"),
]


@pytest.fixture(scope="module")
def docs(spark, tmp_path_factory):
    given = spark.read.parquet(f"{FOLDER}/documents.parquet")
    odd = spark.createDataFrame(ODD, "doc_id bigint, text string")
    path = str(tmp_path_factory.mktemp("docs") / "docs")
    both = given.unionByName(odd, allowMissingColumns=True).withColumn("_row", F.col("text"))
    both.withColumn("__row", F.lit("kept")).repartition(3).write.parquet(path)
    return spark.read.parquet(path)


def texts(docs):
    return [(r.doc_id, r.text) for r in docs.collect()]


def first(pair):
    return pair[0] is None, pair[0] or 0


def run(spark, name, docs):
    found = STAGES[name](spark, docs, FOLDER)
    if name != "packing":
        assert found.columns == docs.columns
        assert found.where("_row <=> text AND __row = 'kept'").count() == found.count()
    return found


def test_toxicity_stage_drops_what_is_predicted(spark, docs):
    folder = FOLDER.replace("0.001", "0.01")  # enough labels to learn from
    given = spark.read.parquet(f"{folder}/documents.parquet").unionByName(docs.where("doc_id > 900000"), True)
    model = toxicity.train(given, spark.read.parquet(f"{folder}/labels.parquet"))
    toxic = {r.doc_id for r in toxicity.score(given, model).where("predicted = 1").collect()}
    kept = STAGES["toxicity"](spark, given, folder)
    assert kept.columns == given.columns
    assert toxic
    assert sorted(map(repr, texts(kept))) == sorted(repr(d) for d in texts(given) if d[0] not in toxic)


def test_exact_dedup_stage(spark, docs):
    groups = {}
    for i, t in sorted(texts(docs), key=first):
        groups.setdefault(re.sub(r"[\x20\x09-\x0D]+", " ", t or ""), i)
    assert sorted(map(str, groups.values())) == sorted(str(i) for i, _ in texts(run(spark, "exact_dedup", docs)))


def test_near_dedup_stage_keeps_one_of_each_group(spark, docs):
    given = sorted(texts(docs), key=first)
    prints = [fingerprint(t or "") for _, t in given]
    root = list(range(len(given)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a in range(len(given)):
        for b in range(a):
            if ((prints[a] ^ prints[b]) & (2**64 - 1)).bit_count() <= 3:
                x, y = sorted((find(a), find(b)))
                root[y] = x
    kept = [str(given[k][0]) for k in range(len(given)) if find(k) == k]
    assert len(kept) < len(given)
    assert sorted(str(i) for i, _ in texts(run(spark, "near_dedup", docs))) == sorted(kept)


def test_decontamination_stage_judges_rows(spark, docs):
    words = lambda t: re.findall(r"[^\W_]+", (t or "").lower())
    joined = lambda w: {" ".join(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set()
    items = [joined(words(r["text"])) for r in pq.read_table(f"{FOLDER}/benchmark.parquet").to_pylist()]
    clean = []
    for i, t in texts(docs):
        own = joined(words(t))
        if not any(item and len(item & own) >= 0.8 * len(item) for item in items):
            clean.append((i, t))
    kept = texts(run(spark, "decontamination", docs))
    assert sorted(map(repr, kept)) == sorted(map(repr, clean))
    assert len(clean) < docs.count()


def test_packing_stage_places_every_token(spark, docs):
    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    given = docs.where("doc_id IS NOT NULL").dropDuplicates(["doc_id"])
    expected = {i: len(tokenizer.encode(t or "", add_special_tokens=False).ids) + 1 for i, t in texts(given)}
    found = run(spark, "packing", given).collect()
    total = {}
    for r in found:
        total[r.doc_id] = total.get(r.doc_id, 0) + r.length
    assert total == expected
    filled = {}
    for r in found:
        filled[r.sequence_id] = filled.get(r.sequence_id, 0) + r.length
    assert max(filled.values()) <= 2048
