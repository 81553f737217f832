"""Token store, hard negatives and lexical search against brute force."""

from __future__ import annotations

import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from blotter.llm import hard_negatives, lexical, queries, token_store
from helpers import lower

TOKENIZER = public_tokenizers.path("word_bpe_49k.json")
BYTES = public_tokenizers.path("byte_bpe_50k.json")


def test_minimal_hash_is_perfect():
    rng = np.random.default_rng(1)
    for n in (1, 2, 3, 50, 5000):
        keys = rng.integers(0, 1 << 64, n, dtype=np.uint64)
        pilots, slots = token_store.minimal_hash(keys)
        assert sorted(slots) == list(range(n))
        assert (token_store._slot(keys, pilots[token_store._group(keys, len(pilots))], n) == slots).all()


STRANGE = [
    "it's  two   blanks,and\ttabs\nlines \x0b \x0c   end ", " lead", "<|endoftext|> <|startoftext|>x a<|endoftext|>b",
    "Á é ́alone Å ﬁ İstanbul ΣΑΣ", "日本語 テキスト 🙂🙂 \U0001f469‍\U0001f680", "don't WON'T they'll I'm 's", "2024-05-06T12:30", " x\u0085y",
]


@pytest.mark.parametrize("path,apart", [(TOKENIZER, True), (TOKENIZER, False), (BYTES, False)])
def test_store_holds_every_document(make, prose, odd, monkeypatch, tmp_path, path, apart):
    for name, size in (("SHARD_BYTES", 4096), ("BUCKET_KEYS", 16), ("SLICE_BYTES", 3000), ("TASK_BYTES", 1 << 18), ("REMEMBERED", 400)):
        monkeypatch.setattr(token_store, name, size)
    rows = [*odd, *((20 + i, t) for i, t in enumerate(STRANGE)), *((50 + i % 90, prose(i, i % 40)) for i in range(120))]
    rows += [(7, "same key")] * 30
    store = token_store.write_store(
        make(rows).withColumn("START", F.lit(1)).withColumn("copy", F.lit("x")), path, 2, apart, str(tmp_path / "store")
    )
    assert store.shards.count() > 5 and store.buckets.count() > 3
    own = Tokenizer.from_file(path)
    held = Counter(i for i, _ in rows)
    asked = [(i, c) for i, n in held.items() for c in range(n + 2)] + [(10**6 + i, 0) for i in range(300)]
    got = token_store.lookup(
        token_store.open_store(store.buckets.sparkSession, store.path),
        store.shards.sparkSession.createDataFrame(asked * 2, "doc_id long, copy int"),
    ).collect()
    assert len(got) == len(rows)
    at, found = 0, []
    for r in sorted(got, key=lambda r: r["start"]):
        assert r["start"] == at and len(r["ids"]) == 4 * r["n_tokens"]
        at += r["n_tokens"]
        found.append((r["doc_id"], r["ids"]))
    order = [i for i, _ in found]
    assert order == sorted(order, key=lambda i: (i is not None, i or 0))
    want = Counter(
        (i, np.array([*own.encode(t or "", add_special_tokens=False).ids, 2], "<u4").tobytes()) for i, t in rows
    )
    assert Counter((i, bytes(ids)) for i, ids in found) == want


def test_empty_store(make, spark):
    store = token_store.write_store(make([]), TOKENIZER, 2, True)
    assert token_store.lookup(store, spark.createDataFrame([(1,)], "doc_id long")).count() == 0


def test_store_query(make, odd, tmp_path):
    make(odd).write.parquet(f"{tmp_path}/documents.parquet")
    own = Tokenizer.from_file(TOKENIZER)
    rows = queries.op11_token_store(make([]).sparkSession, str(tmp_path)).collect()
    want = Counter()
    for i, t in odd:
        ids = np.array([*own.encode(t or "", add_special_tokens=False).ids, 2], "<u4")
        want[i, len(ids), zlib.crc32(ids.tobytes())] += 1
    assert Counter((r["doc_id"], r["n_tokens"], r["ids_crc32"]) for r in rows) == want
    assert sum(r["n_tokens"] for r in rows) == max(r["start"] + r["n_tokens"] for r in rows)


def brute_negatives(rows, anchors, positives=5, negatives=3):
    """Pairs and scores with Python's whole numbers."""
    usable = [
        (i, label, [math.floor(256 * x) for x in v]) for i, label, v in rows
        if None not in (i, label, v) and all(x is not None and math.isfinite(x) for x in v)
    ]
    result = []
    for i, label, v in {(i, label, tuple(v)) for i, label, v in usable if i in anchors}:
        dot = lambda w: sum(a * b for a, b in zip(v, w))
        others = sorted(((-dot(w), j, other) for j, other, w in usable), key=lambda x: x[:2])
        for score, j, _ in [x for x in others if x[2] == label and x[1] != i][:positives]:
            hard = [(n, -s) for s, n, other in others if other != label and 50 * -score <= 100 * -s <= 95 * -score]
            result += [(i, j, rank + 1, n, -score, s) for rank, (n, s) in enumerate(hard[:negatives])]
    return Counter(result)


@pytest.mark.parametrize("scale", [0.3, 3000.0])
def test_negatives_equal_brute_force(spark, monkeypatch, scale):
    for name, size in (("BLOCK_ROWS", 7), ("ANCHOR_BYTES", 400), ("ANCHOR_ROWS", 3), ("WIDTH", 4)):
        monkeypatch.setattr(hard_negatives, name, size)
    rng = random.Random(5)
    rows = [(i, i % 4, [rng.gauss(0.4, 1) * scale for _ in range(9)]) for i in range(150)]
    rows += [(i, i % 3, [0.5] * 9) for i in range(200, 230)]  # ties
    rows += [(300, 1, [1.0, 2.0]), (301, 2, []), rows[0], rows[3], rows[3]]
    rows += [
        (None, 1, [1.0] * 9), (400, None, [1.0] * 9), (410, 1, None), (420, 1, [float("nan")] * 9),
        (430, 1, [float("inf")] + [1.0] * 8), (440, 1, [None] + [1.0] * 8),
    ]
    frame = spark.createDataFrame([(*r, "x") for r in rows], "vec_id long, label int, embedding array<double>, RANK string")
    got = hard_negatives.mine_negatives(frame.repartition(3), F.col("vec_id") % 10 == 0)
    assert Counter(map(tuple, got.collect())) == brute_negatives(rows, {i for i, _, _ in rows if i is not None and i % 10 == 0})
    assert got.columns[:4] == ["anchor_id", "positive_id", "rank", "negative_id"]


def test_scores_are_exact_for_any_size():
    rng = np.random.default_rng(2)
    for largest, width in ((3, 1), (300, 64), (1 << 25, 130)):
        a, b = (rng.integers(-largest, largest + 1, (20, width)).astype(float) for _ in range(2))
        primes = hard_negatives.primes_for(width * largest * largest)
        found = hard_negatives.scores(hard_negatives.remainders(a, primes), hard_negatives.remainders(b, primes), primes)
        assert (found == a.astype(np.int64) @ b.astype(np.int64).T).all()
    with pytest.raises(ValueError, match="62 bits"):
        hard_negatives.primes_for(1 << 62)


def test_negatives_of_nothing(spark):
    none = spark.createDataFrame([], "vec_id long, label int, embedding array<float>")
    assert hard_negatives.mine_negatives(none, F.col("vec_id") % 50 == 0).count() == 0


TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def brute_search(docs, items, k):
    terms = [(i, Counter(TERM.findall(lower(t)))) for i, t in docs]
    terms = [(i, c) for i, c in terms if c]
    n_all, total = len(terms), sum(c.total() for _, c in terms)
    df = Counter(t for _, c in terms for t in c)
    result = Counter()
    for item, text in set(items):
        scored = []
        for i, c in terms:
            m = 100 - 25 + (25 * c.total() * n_all) // total
            score = sum(
                math.floor(1000 * math.log((2 * n_all + 2) / (2 * df[t] + 1))) * ((10**9 * c[t]) // (1000 * c[t] + 12 * m))
                for t in TERM.findall(lower(text)) if t in c
            )
            if score > 0:
                scored.append((-score, i is None, i or 0))
        for rank, (score, null, i) in enumerate(sorted(scored)[:k]):
            result[item, rank + 1, None if null else i, -score] += 1
    return result


@pytest.mark.parametrize("first", [256, 2])
def test_search_equals_brute_force(make, odd, spark, monkeypatch, first):
    for name, size in (("SEGMENT_BYTES", 2000), ("RUN_BYTES", 700), ("QUERY_BYTES", 400), ("FIRST_DOCS", first)):
        monkeypatch.setattr(lexical, name, size)
    rng = random.Random(9)
    known = ["the", "of", *("".join(rng.choices("abcde", k=3)) for _ in range(60))]
    shares = [30 / (1 + i) for i in range(len(known))]
    draw = lambda n: " ".join(rng.choices(known, shares, k=n))
    docs = [*odd, *((100 + i, draw(rng.choice([1, 3, 20, 20, 90]))) for i in range(200))]
    docs += [(500 + i, "The one, the only") for i in range(40)] + [(100, docs[14][1])]
    items = [(i, draw(rng.randint(1, 25))) for i in range(30)]
    items += [(40, None), (41, ""), (42, "!!"), (43, "unheard"), (None, "the of the"), items[0], (44, "Ünï ONE one")]
    index = lexical.build_index(make(docs).withColumn("TERMS", F.lit("x")).repartition(4))
    assert index.segments.count() > 10
    got = lexical.search(index, spark.createDataFrame(items, "item_id long, text string"), 5)
    assert Counter(map(tuple, got.collect())) == brute_search(docs, items, 5)


def test_search_of_nothing(make, spark):
    none = spark.createDataFrame([], "item_id long, text string")
    some = spark.createDataFrame([(1, "a")], none.schema)
    assert lexical.search(lexical.build_index(make([])), some).count() == 0
    assert lexical.search(lexical.build_index(make([(1, "a b")])), none).count() == 0
    assert lexical.search(lexical.build_index(make([(1, "a b")])), some).count() == 1
