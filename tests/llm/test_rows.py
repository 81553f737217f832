"""Sharding, chat, URLs, mixing, toxicity and scoring: exact versions and odd rows."""

from __future__ import annotations

import random
import zlib
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from blotter.llm import chat, chunks, context_tree, mixing, sharding, toxicity, url_filters
from blotter.llm.url_rules import RULES
from helpers import PlainTree, differencing, plain_chain, unigram


def test_differencing_equals_a_plain_version():
    rng = random.Random(1)
    for parts in (2, 3, 8):
        for n in (1, 2, 7, 60):
            sizes = [rng.randint(1, 10**6) for _ in range(n)]
            sums = [0] * parts
            for size, part in zip(sizes, sharding.karmarkar_karp(sizes, parts)):
                sums[part] += size
            assert sorted(sums, reverse=True) == differencing(sizes, parts)
    assert sharding.karmarkar_karp([], 8) == []


@pytest.mark.parametrize("bundles", [1 << 14, 4])
def test_shards(make, prose, odd, bundles):
    rows = [*odd, *((50 + i, prose(i % 70, 5 + i % 40)) for i in range(300))]
    got = sharding.shard(make(rows), 8, bundles, cell_rows=7).collect()
    assert len(got) == len(rows) and {r["law"] for r in got} == {"bytes"}
    texts = defaultdict(list)
    for i, t in rows:
        texts[i].append(t or "")
    where, slots = defaultdict(set), defaultdict(list)
    for r in got:
        sizes = {len(t.encode()) + 1: zlib.crc32(t.encode()) for t in texts[r["doc_id"]]}
        assert sizes[r["size"]] == r["text_crc32"] and r["grown_shard"] is None
        where[r["text_crc32"], r["size"]].add(r["shard"])
        slots[r["shard"]].append(r["slot"])
    assert all(len(x) == 1 for x in where.values())
    assert all(sorted(x) == list(range(len(x))) for x in slots.values())


def test_shards_are_balanced_and_carry_columns(make, prose):
    rows = [(i, prose(i, 20 + i % 300)) for i in range(500)]
    docs = make(rows).withColumn("SHARD", F.lit("old")).withColumn("slot", F.lit("old"))
    got = sharding.shard(docs, 8, carry=tuple(docs.columns))
    assert [c for c in got.columns if c.lower() == "shard"] == ["shard"]
    sums = [r[0] for r in got.groupBy("shard").agg(F.sum("size")).select("sum(size)").collect()]
    assert len(sums) == 8 and max(sums) - min(sums) <= 2
    assert sharding.shard(make([])).count() == 0


def chat_rows(spark, rows):
    return spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, part string")


def test_every_participant_gets_a_view(spark):
    rows = [
        (1, 0, "ann", "hi <|x|>", ""), (1, 1, "bob", "yo", ""), (1, 1, "bob", "yo", "again"),
        (1, 2, None, None, ""), (None, 0, "ann", "alone", ""), (2, None, "bob", "first", ""),
        (2, 5, "bob", "then", ""), (2, 5, "ann", "tie", ""), (2, 130, "ann\nx", "late", ""),
    ]
    got = chat.rotate_perspectives(chat_rows(spark, rows)).collect()
    views = {(r["conv_id"], r["participant"], r["part"]): r for r in got}
    ann = views[1, "ann", 0]
    assert ann["rendered"] == (
        "<|im_start|>assistant\nhi < |x|><|im_end|>\n<|im_start|>user name=bob\nyo<|im_end|>\n"
        "<|im_start|>user name=unknown\n<|im_end|>\n"
    )
    assert (ann["n_turns"], ann["n_own"]) == (3, 1)
    for r in got:
        spans = [tuple(map(int, s.split("-"))) for s in r["mask"].split(",") if s]
        assert len(spans) == r["n_own"]
        for a, b in spans:
            assert r["rendered"][:a].endswith("<|im_start|>assistant\n")
            assert r["rendered"][a:b].endswith("<|im_end|>\n")
    assert views[None, "ann", 0]["n_own"] == 1
    assert {p for c, _, p in views if c == 2} == {None, 0, 2}
    assert "user name=ann x" in views[2, "bob", 2]["rendered"]
    assert {w for c, w, _ in views if c == 2} == {"ann", "bob", "ann\nx"}
    assert chat.rotate_perspectives(chat_rows(spark, [])).count() == 0


def test_a_long_dialogue_comes_in_parts(spark):
    rows = [(1, i, "ab"[i % 2], f"turn {i}", "") for i in range(200)]
    got = chat.rotate_perspectives(chat_rows(spark, rows)).orderBy("participant", "part").collect()
    assert [(r["participant"], r["part"], r["n_turns"]) for r in got] == [
        (p, i, n) for p in "ab" for i, n in enumerate((64, 64, 64, 8))
    ]
    whole = "".join(r["rendered"] for r in got if r["participant"] == "a")
    assert whole.count("assistant\n") == 100 and whole.index("turn 99") < whole.index("turn 100")


def test_crowded_parts_come_in_slices(spark):
    rng = random.Random(5)
    rows = [(1, None, "abc"[i % 3], "same start " * 9 + f"{rng.random()}", "") for i in range(1000)]
    rows += [(None, 3, "ab"[i % 2], f"turn {i}", "") for i in range(150)]
    rows += [(2, i % 70, "a", f"turn {i}", "") for i in range(200)]
    rows += [(3, 1, "a", "often", "")] * 500 + [(4, 1, "a", "x" * 500_000, ""), (4, None, "b", "few", "")]
    rng.shuffle(rows)
    got = chat.rotate_perspectives(chat_rows(spark, rows)).collect()
    sets = {}
    for conv, turn, role, text, _ in rows:
        sets.setdefault((conv, None if turn is None else turn // 64), set()).add((turn or 0, role, text))
    roles = {}
    for conv, _, role, _, _ in rows:
        roles.setdefault(conv, set()).add(role)
    expected = {}
    for (conv, part), turns in sets.items():
        for at, (_, role, text) in enumerate(sorted(turns)):
            for who in roles[conv]:
                head = "assistant" if who == role else f"user name={role}"
                expected.setdefault((conv, who, part, at // 64), []).append(
                    f"<|im_start|>{head}\n{text}<|im_end|>\n"
                )
    assert {(r["conv_id"], r["participant"], r["part"], r["slice"]): r["rendered"] for r in got} == {
        k: "".join(v) for k, v in expected.items()
    }
    assert len(got) == len(expected) and max(r["n_turns"] for r in got) == 64


def test_urls(spark):
    rows = [
        (1, "http://WWW.Example.org/es/x?q"), (2, "https://example.org/en/123#y"), (3, "http://org/"),
        (4, "http://x.org"), (5, "http://badorg/"), (6, "ftp://a.com/de/casino-win/"), (7, None),
        (8, "no scheme org/"), (9, ""), (10, "http://casino-win.net/a"), (11, "http://xcasino-win.net/a"),
        (12, "http://a.net/clickbaiting"), (13, "http://example.net/es/1.html"), (14, "://"),
        (1, "http://WWW.Example.org/es/x?q"), (None, "http://a.com/fr/"), (15, "http://example.org/es"),
        (16, "http://a.net/" + "x" * 100_000), (17, "http://example.org/en/1"),
    ]
    pages = spark.createDataFrame(rows, "page_id long, url string").withColumn("Host", F.lit("mine"))
    got = url_filters.filter_urls(pages, RULES).collect()
    assert len(got) == len(rows)
    of = {r["page_id"]: (r["host"], r["path"][:20], r["rule"], r["verdict"]) for r in got}
    assert of[1] == ("www.example.org", "/es/x", "example.org/es/", "block")
    assert of[2] == ("example.org", "/en/123", "example.org/en/1", "block")
    assert of[3] == ("org", "/", "org/", "allow") and of[4] == ("x.org", "", None, "allow")
    assert of[5][2:] == (None, "allow") and of[6][2:] == ("com/de/", "block")
    assert of[7] == of[8] == of[9] == of[14] == ("", "", None, "allow")
    assert of[10][2:] == (None, "block") and of[11][2:] == (None, "allow")
    assert of[12][2:] == (None, "block") and of[13][2:] == (None, "allow")
    assert of[None][2:] == ("com/fr/", "allow") and of[15][2:] == ("org/", "allow")
    assert of[17][2:] == ("example.org/en/1", "block")
    assert url_filters.filter_urls(pages.limit(0), RULES).count() == 0


def test_rules_that_do_not_fit_are_refused(spark):
    rule = url_filters.glob_rule("x" * (17 << 20), "block")
    with pytest.raises(ValueError, match="exceed"):
        url_filters.filter_urls(spark.createDataFrame([(1, "http://a")], "page_id long, url string"), [rule])


def plain_shares(children, budget):
    """Water-filling by rounds: children that cannot take their share take all they have."""
    open_, taken, result = dict(children), 0, {}
    while open_:
        total = sum(w for _, w in open_.values())
        short = {k for k, (cap, w) in open_.items() if cap * total <= (budget - taken) * w}
        if not short:
            return result | {k: (budget - taken) * w // total for k, (_, w) in open_.items()}
        for k in short:
            result[k] = open_[k][0]
        taken += sum(open_.pop(k)[0] for k in short)
    return result


def test_budgets_go_to_siblings_first(spark):
    rng = random.Random(6)
    leaves = {
        (d, x, s): rng.choice([1, 10, 100, 1000])
        for d in ("web", "books") for x in ("en", "de", "fr") for s in ("a", "b", "c")
    }
    mix = mixing.Mix(budget_pct=90, epochs=2, weights={"domain": {"web": 3}, "lang": {"en": 5, "fr": 0}})
    frame = spark.createDataFrame([(*k, n) for k, n in leaves.items()], "domain string, lang string, source string, leaf_tokens long")
    got = {(r["domain"], r["lang"], r["source"]): r["budget"] for r in mixing.allot(frame, mix).collect()}

    def split(prefix, budget):
        names = {k[len(prefix)] for k in leaves if k[: len(prefix)] == prefix}
        level = mixing.LEVELS[len(prefix)]
        weight = {n: mix.weights.get(level, {}).get(n, 1) for n in names}
        caps = {n: 2 * sum(t for k, t in leaves.items() if k[: len(prefix) + 1] == (*prefix, n)) for n in names}
        shares = plain_shares({n: (caps[n], weight[n]) for n in names if weight[n]}, budget)
        for n, share in shares.items():
            if len(prefix) == 2:
                yield (*prefix, n), share
            else:
                yield from split((*prefix, n), share)

    assert got == dict(split((), sum(leaves.values()) * 90 // 100))


def test_draws_are_prefixes_of_epochs(make, prose, odd):
    rows = [(100 + i, prose(i, 10)) for i in range(200)]
    docs = make(rows).unionByName(make([(i, prose(i, 10)) for i in range(500, 540)], source="src2"))
    mix = mixing.Mix(budget_pct=100, epochs=3)
    got = mixing.mix_sources(docs, mix).collect()
    drawn = Counter((r["source"], r["epoch"]) for r in got)
    # src2 (domain forum) takes three epochs of 400 tokens, src1 the rest of 2400.
    assert drawn == {("src2", 0): 40, ("src2", 1): 40, ("src2", 2): 40, ("src1", 0): 120}
    assert {r["text"] for r in got if r["source"] == "src1"} < {t for _, t in rows}
    again = mixing.mix_sources(docs.repartition(7), mix).collect()
    key = lambda x: sorted((r["doc_id"], r["epoch"]) for r in x)
    assert key(got) == key(again)
    strange = make(odd, lang=None, source=None).withColumn("Budget", F.lit("old"))
    whole = mixing.mix_sources(strange, mixing.Mix(100, 1))
    assert whole.count() == len(odd) and {r["leaf_source"] for r in whole.collect()} == {"unknown"}
    assert mixing.mix_sources(make([]), mix).count() == 0


LABELS = "doc_id long, quality int, toxic int"


def test_toxicity_on_held_out_documents(spark):
    sf = "/root/testdata/sf0.1"
    docs, labels = spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/labels.parquet")
    train = labels.where("doc_id % 2 = 0")
    links = toxicity.learn(docs, train)
    counts = Counter(
        (r[0], r[1])
        for r in toxicity.score_toxicity(docs, links, keep=("doc_id",))
        .withColumnRenamed("toxic", "found").join(labels.where("doc_id % 2 = 1"), "doc_id")
        .select("found", "toxic").collect()
    )
    assert counts[True, 1] >= 0.85 * (counts[True, 1] + counts[False, 1])
    assert counts[True, 0] <= 0.005 * (counts[True, 0] + counts[False, 0])
    assert len(links) == 3 and [len(x.chained) for x in links] == [0, 1, 2]


def test_toxicity_of_odd_rows_and_labels(spark, make, odd):
    none = spark.createDataFrame([], LABELS)
    links = toxicity.learn(make(odd), none)
    docs = make(odd).withColumn("TOXIC", F.lit("old")).withColumn("p_toxic", F.lit("old"))
    rows = toxicity.score_toxicity(docs, links).collect()
    assert len(rows) == len(odd) and not any(r["toxic"] for r in rows)
    strange = [(1, 1, 0), (1, 0, 1), (2, None, 1), (None, 1, 1), (3, 1, 0), (99, 1, 1), (3, 1, 0)]
    links = toxicity.learn(make(odd), spark.createDataFrame(strange, LABELS))
    assert len(links) == 3
    assert toxicity.score_toxicity(make([]), links).count() == 0


def test_toxicity_learns_and_chains(spark, make, prose):
    rng = random.Random(1)
    rows, labels = [], []
    for i in range(300):
        bad = i % 5 == 0
        text = prose(i, 40).split()
        if bad:
            text.insert(rng.randrange(40), rng.choice(["Grr", "uzz"]))
        rows.append((i, " ".join(text)))
        if i < 200:
            labels.append((i, 1, int(bad)))
    links = toxicity.learn(make(rows), spark.createDataFrame(labels, LABELS))
    got = toxicity.score_toxicity(make(rows), links).collect()
    assert all(r["toxic"] == (r["doc_id"] % 5 == 0) for r in got)


def test_toxicity_equals_a_plain_chain(spark, make):
    rng = random.Random(11)
    common = [f"w{i}" for i in range(60)]
    rows, labels = [], {}
    for i in range(400):
        text = rng.choices(common, k=25)
        poor, toxic = rng.random() < 0.3, rng.random() < 0.2
        text += rng.sample(["spam", "CLICK", "buy"], 2) if poor and rng.random() < 0.9 else []
        text += [rng.choice(["grr", "Uzz"])] if toxic or rng.random() < 0.05 else []
        rng.shuffle(text)
        rows.append((i, " ".join(text)))
        if i < 300:
            labels[i] = int(not poor), int(toxic)
    rows += [(500, None), (501, ""), (502, rows[3][1]), (503, "grr " * 5000)]
    labels[500], labels[502] = (0, 0), (0, 1)
    links = toxicity.learn(make(rows), spark.createDataFrame([(k, *v) for k, v in labels.items()], LABELS))
    assert all(len(x.words) for x in links)
    got = {r["doc_id"]: r for r in toxicity.score_toxicity(make(rows), links).collect()}
    for (name, _), expected in zip(rows, plain_chain([(i, t or "") for i, t in rows], labels)):
        row = got[name]
        assert [row[f"p_{c}"] for c in toxicity.CATEGORIES] == pytest.approx(expected, abs=1e-4)
        assert row["toxic"] == (row["p_toxic"] >= 0.5)


def test_toxicity_learns_from_the_smallest_of_several_texts(spark, make, prose):
    rows = [(i, prose(i, 20) + (" zzgrr" if i % 4 == 0 else "")) for i in range(120)]
    labels = spark.createDataFrame([(i, 1, int(i % 4 == 0)) for i in range(120)], LABELS)
    more = [(i, f"zz {prose(900 + i, 20)}") for i in range(120)] + [(i, None) for i in range(120)]
    plain = toxicity.learn(make(rows), labels)
    for twice in (rows + more, more + rows):
        for a, b in zip(plain, toxicity.learn(make(twice).repartition(5), labels)):
            assert (a.words.tolist(), a.constant) == (b.words.tolist(), b.constant)


@pytest.mark.parametrize("depth", [2, 5])
def test_scores_equal_a_plain_tree(make, prose, odd, depth):
    rows = [(i, prose(i % 9, 6 + i % 5) + ("é" if i % 4 else "")) for i in range(40)]
    rows += [(50, None), (51, ""), (52, "Aa aA\x0baa\x00b")]
    got = {r["doc_id"]: r for r in context_tree.score_texts(make(rows), depth).collect()}
    base = unigram(rows)
    tree = PlainTree([(t or "").encode() for i, t in rows if not base[i][0]], depth)
    for i, text in rows:
        r = got[i]
        assert (r["held_out"], r["n_tokens"], r["n_known"], r["train_tokens"]) == base[i][:4]
        assert r["base_score"] == pytest.approx(base[i][4], rel=1e-9)
        assert r["score"] == pytest.approx(tree.log10((text or "").encode()), rel=1e-5)


def test_sums_beyond_four_bytes_are_whole(make, prose):
    import numpy as np

    packed = chunks.pack(make([(i, prose(i, 30)) for i in range(4)]).repartition(2), 1)
    many = np.array([4_000_000_000, 3], np.uint64)
    keys = np.array([1 << 40, 9 << 60], np.uint64)
    for row in chunks.totals(packed, lambda _: (keys, many)).collect():
        assert chunks.joined(row["sums"]).tolist() == [16_000_000_000, 12]


def test_probabilities_of_a_byte_sum_to_one():
    import numpy as np

    grams, _ = context_tree.byte_grams([b"abracadabra", b"abba"], 3)
    tree = context_tree.Tree(*np.unique(grams, return_counts=True), 3)
    node, zeros, ones, below = tree.top
    top = []
    for size in (1 << 16, 1 << 8):
        log_p, share = context_tree._weigh(context_tree.log_kt(zeros, ones), below)
        full = [np.zeros(size) for _ in range(3)]
        for target, values in zip(full, (zeros, ones, share)):
            target[node.astype(int)] = values
        top.append(tuple(full))
        node, zeros, ones, below = context_tree._group(node & np.uint64(255), zeros, ones, log_p)
    for context in (b"abr", b"zzz", b"bba"):
        prefix = np.uint64(int.from_bytes(context[::-1], "big")) << np.uint64(8)
        every = prefix | np.arange(256, dtype=np.uint64)
        assert (10 ** tree.log10(every, top[::-1])).sum() == pytest.approx(1)


def test_scores_of_odd_rows(make, odd):
    rows = context_tree.score_texts(make(odd)).collect()
    assert len(rows) == len(odd) and all(r["score"] < 0 for r in rows)
    six = [r for r in rows if r["doc_id"] == 6]
    assert six[0] == six[1]
    assert context_tree.score_texts(make([])).count() == 0
