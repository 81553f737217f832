"""Near-dedup, decontamination, passages and fingerprints against brute force."""

from __future__ import annotations

import random
from hashlib import sha256

import pytest
from pyspark.sql import functions as F

from blotter.llm import decontamination, near_dedup, simhash, suffix_dedup
from blotter.llm.components import components
from blotter.llm.queries import op2_decontamination, op5_fingerprints
from helpers import classes, words


@pytest.fixture(scope="module")
def family(prose):
    """Copies, near copies with a growing number of changes, and a shared boilerplate."""
    rng = random.Random(5)
    rows, name = [], 0
    plate = prose(999, 15)
    for seed in range(8):
        base = prose(seed, 120).split()
        for changes in (0, 0, 1, 2, 3, 5, 9, 20):
            mine = list(base)
            for _ in range(changes):
                mine[rng.randrange(len(mine))] = f"new{rng.random()}".replace(".", "")
            rows.append((name, " ".join(mine) + (". " + plate if name % 3 else "")))
            name += 1
    return rows + [(900 + i, prose(500 + i, 40) + " " + plate) for i in range(20)]


@pytest.mark.parametrize("block", [512, 3])
def test_near_duplicates_equal_brute_force(make, family, block):
    found, _ = near_dedup.near_duplicates(make(family), block=block)
    rows = found.collect()
    assert {r["doc_id"]: r["class_id"] for r in rows} == classes(family)
    assert sum(r["keeper"] for r in rows) == len({r["class_id"] for r in rows})


@pytest.mark.parametrize("block", [512, 4])
def test_links_in_any_number_of_blocks(make, prose, monkeypatch, block):
    """A chain of texts, each like the next, whose ends are unlike: one band for all of
    them, so only comparing all that are not joined yet can join the chain."""
    long = prose(3, 300).split()
    chain = [(i, " ".join(long[10 * i : 10 * i + 150])) for i in range(9)]
    plain = near_dedup.Sampler.bands_of

    def one_band(self, hashes, weights, owner):
        which, bands = plain(self, hashes, weights, owner)
        bands[:] = 7
        return which, bands

    monkeypatch.setattr(near_dedup.Sampler, "bands_of", one_band)
    found = near_dedup.near_duplicates(make(chain), similarity=0.7, block=block)[0].collect()
    wanted = classes(chain, 0.7)
    assert len(set(wanted.values())) == 1
    assert {r["doc_id"]: r["class_id"] for r in found} == wanted


def test_samples_estimate_weighted_similarity():
    import numpy as np

    rng = np.random.default_rng(1)
    hashes = np.sort(rng.integers(0, 1 << 63, 400).astype(np.uint64))
    a, b = rng.random(400).astype(np.float32) + 0.1, rng.random(400).astype(np.float32) + 0.1
    sampler = near_dedup.Sampler(2000, 1)
    owner = np.zeros(400, int)
    one, two = (sampler.bands_of(hashes, w, owner)[1][0] for w in (a, b))
    exact = near_dedup.weighted_jaccard((hashes, a), (hashes, b))
    assert abs((one == two).mean() - exact) < 0.04


@pytest.mark.parametrize("documents", [90, 3000])
def test_a_family_stays_one_class_as_the_corpus_grows(make, prose, documents):
    """The more documents, the more a changed word weighs against words a family shares."""
    base = prose(7000, 70).split()
    rows = [(0, " ".join(base))]
    for i in range(1, documents // 3):
        mine = list(base)
        mine[5 + i % 50] = f"new{i}"
        rows.append((i, " ".join(mine)))
    rows += [(i, f"{prose(i, 12)} by {i}") for i in range(len(rows), documents)]
    family = documents // 3
    found = near_dedup.near_duplicates(make(rows))[0].collect()
    assert {r["doc_id"]: r["class_id"] for r in found} == {i: 0 if i < family else i for i, _ in rows}


def test_near_duplicates_of_odd_rows(make, odd):
    rows = near_dedup.near_duplicates(make(odd))[0].collect()
    assert len(rows) == len(odd)
    of = {r["doc_id"]: r for r in rows if r["doc_id"] is not None}
    assert of[1]["class_id"] == of[2]["class_id"] == 1  # null is the empty text
    assert of[4]["class_id"] == of[5]["class_id"] == 4 and of[3]["class_id"] == 3
    assert of[10]["class_id"] == of[11]["class_id"] == 10
    assert sum(r["keeper"] for r in rows if r["class_id"] == 6) == 1 and of[6]["copies"] == 2


def test_keep_one_keeps_columns_and_first_documents(make, family, spark):
    docs = make(family).withColumn("class_id", F.lit("mine"))
    kept = near_dedup.keep_one(docs)
    assert kept.columns == docs.columns
    assert {r["doc_id"] for r in kept.collect()} == set(classes(family).values())
    assert near_dedup.keep_one(make([])).count() == 0


def test_components_of_a_path_and_a_star(spark):
    links = [(i, i + 1) for i in range(40)] + [(100, 200 + i) for i in range(50)] + [(7, 7)]
    found = {r["node"]: r["label"] for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert {found[i] for i in range(41)} == {0} and {found[200 + i] for i in range(50)} == {100}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


ITEMS = "item_id long, text string"


def test_leaks_equal_brute_force_in_any_number_of_blocks(make, prose, spark):
    rng = random.Random(2)
    items = [(i, prose(1000 + i, rng.choice([4, 9, 10, 11, 30, 80]))) for i in range(30)]
    items += [(30, None), (31, "!!"), (None, "four words of nobody"), (5, items[5][1])]
    rows = []
    for i in range(60):
        text = prose(i, rng.randint(1, 60)).split()
        for _ in range(i % 3):
            w = words(rng.choice(items)[1])
            a = rng.randrange(max(1, len(w) - 5))
            at = rng.randrange(len(text) + 1)
            text[at:at] = w[a : a + rng.randint(3, 40)]
        rows.append((i, " ".join(text)))
    rows += [(100, "Say: Four, WORDS of nobody!"), (101, None), (102, "")]
    item_frame = spark.createDataFrame(items, ITEMS)
    results = []
    for size in (10**9, 600):
        found = decontamination.find_leaks(make(rows), item_frame, block_bytes=size, keep=("doc_id",))
        results.append({r["doc_id"]: r for r in found.collect()})
    assert results[0] == results[1]
    for name, text in rows:
        w, hit, ids = words(text), set(), set()
        for item, passage in items:
            v = words(passage)
            n = min(10, len(v))
            windows = {tuple(v[j : j + n]) for j in range(len(v) - n + 1)} if n else set()
            for j in range(len(w) - n + 1 if n else 0):
                if tuple(w[j : j + n]) in windows:
                    hit |= set(range(j, j + n))
                    ids.add("" if item is None else str(item))
        got = results[0][name]
        assert (got["n_words"], got["n_hit"], got["item_ids"]) == (len(w), len(hit), sorted(ids))
        assert got["contaminated"] == bool(hit)


def test_blocks_of_a_benchmark_are_held_one_at_a_time(make, prose, odd, spark, monkeypatch):
    items = [(i, prose(i, 40)) for i in range(60)]
    live, most = set(), []
    send = type(spark.sparkContext).broadcast

    def broadcast(context, value):
        held = send(context, value)
        live.add(id(held))
        most.append(len(live))
        destroy = held.destroy
        held.destroy = lambda: (live.discard(id(held)), destroy())
        return held

    monkeypatch.setattr(type(spark.sparkContext), "broadcast", broadcast)
    copies = [(1000 + i, "Lead in. " + prose(7, 40) + " and " + prose(8, 40)) for i in range(300)]
    rows = [*odd, *copies, (5000, None), (5001, prose(59, 40))]
    docs = make(rows).withColumn("SPANS", F.lit("x"))
    found = decontamination.find_leaks(docs, spark.createDataFrame(items, ITEMS), block_bytes=600)
    got = {r["doc_id"]: r for r in found.collect()}
    assert len(most) > 20 and max(most) == 1 and not live
    assert found.count() == len(rows) and found.columns[:5] == make([]).columns
    assert all(got[i]["item_ids"] == ["7", "8"] and got[i]["n_hit"] == 80 for i, _ in copies)
    assert got[5001]["spans"][0]["last"] == 40 and not got[5000]["contaminated"]
    assert got[8]["item_ids"] == ["8"]  # the very long text starts like this item
    assert sum(r["contaminated"] for r in got.values()) == 302


def test_leaks_of_odd_rows_and_clashing_names(make, odd, spark):
    none = spark.createDataFrame([], ITEMS)
    docs = make(odd).withColumn("Contaminated", F.lit("x")).withColumn("n_hit", F.lit("y"))
    rows = decontamination.find_leaks(docs, none).collect()
    assert len(rows) == len(odd) and not any(r["contaminated"] for r in rows)
    assert decontamination.find_leaks(make([]), none).count() == 0


def test_digest_of_no_items(spark, tmp_path, make):
    make([(1, "x")]).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(1, "y")], ITEMS).write.parquet(f"{tmp_path}/benchmark.parquet")
    row = op2_decontamination(spark, str(tmp_path)).first()
    assert row["items_sha256"] == sha256(b"").hexdigest() and row["n_words"] == 1


def brute_passages(rows, least):
    held: dict[tuple, set] = {}
    for place, (_, text) in enumerate(rows):
        w = words(text)
        for j in range(len(w) - least + 1):
            held.setdefault(tuple(w[j : j + least]), set()).add(place)
    result = []
    for _, text in rows:
        w, hit = words(text), set()
        for j in range(len(w) - least + 1):
            if len(held[tuple(w[j : j + least])]) > 1:
                hit |= set(range(j, j + least))
        result.append(len(hit))
    return result


def test_passages_equal_brute_force(make, prose):
    rng = random.Random(4)
    shared = [prose(700 + i, n) for i, n in enumerate((49, 50, 51, 55, 60, 120))]
    rows = []
    for i in range(40):
        parts = [prose(i, rng.randint(5, 80))]
        for _ in range(rng.randint(0, 3)):
            parts += [rng.choice(shared), prose(rng.random(), 7)]
        rows.append((i, " ".join(parts)))
    rows += [(40, rows[0][1]), (41, rows[0][1])]
    found = {r["doc_id"]: r for r in suffix_dedup.repeated_passages(make(rows)).collect()}
    assert [found[i]["n_repeated"] for i, _ in rows] == brute_passages(rows, 50)
    assert found[40]["copies"] == 3
    lone = suffix_dedup.repeated_passages(make([(1, shared[5] + " x " + shared[5])])).first()
    assert lone["n_repeated"] == 0  # in one document only


def test_passages_across_partitions_of_the_sort(make, prose, spark):
    """Every row in a partition of its own: only the edges can find the partner."""
    rows = [(i, f"{prose(i, 30)} {prose(9001, 60)} {prose(i + 50, 30)}") for i in range(12)]
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "60")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        found = suffix_dedup.repeated_passages(make(rows)).collect()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert [r["n_repeated"] for r in found] == [60] * 12


def test_a_passage_repeated_in_one_document_meets_the_others(make, prose):
    """More occurrences in one document than neighbours a suffix is compared with."""
    passage = prose(8001, 60)
    often = " ".join(f"{passage} {prose(8100 + i, 3)}" for i in range(300))
    rows = [(1, often), (2, f"{prose(11, 40)} {passage} {prose(12, 40)}"), (3, prose(13, 90))]
    rows += [(4, f"{prose(14, 70)} " * 90), (5, prose(15, 200))]  # repeats itself only
    found = {r["doc_id"]: r for r in suffix_dedup.repeated_passages(make(rows)).collect()}
    assert [found[i]["n_repeated"] for i, _ in rows] == brute_passages(rows, 50)
    assert found[1]["n_repeated"] == 300 * 60 and found[4]["n_repeated"] == 0


def test_passages_that_go_on_to_the_left_of_a_common_core(make, prose):
    """A core of every document, too short by itself, scatters the pairs that share more
    words before it among all of its holders."""
    core = prose(8002, 45)
    rows = [
        (i, f"{prose(i, 20)} {prose(20_000 + i // 2, 15)} {core} {prose(40_000 + i, 20)}")
        for i in range(200)
    ]
    rows += [(200 + i, f"{prose(200 + i, 30)} {core} {prose(60_000 + i, 9)}") for i in range(100)]
    found = {r["doc_id"]: r for r in suffix_dedup.repeated_passages(make(rows)).collect()}
    assert [found[i]["n_repeated"] for i, _ in rows] == brute_passages(rows, 50) == [60] * 200 + [0] * 100


def test_passages_of_odd_rows(make, odd):
    rows = suffix_dedup.repeated_passages(make(odd)).collect()
    assert len(rows) == len(odd) and all(r["n_repeated"] == 0 for r in rows)
    assert suffix_dedup.repeated_passages(make([])).count() == 0


def test_fingerprints_of_documents_and_edits(make, prose, odd):
    rows = [(100 + i * 3, prose(i, 200)) for i in range(30)] + [(i, t) for i, t in odd if i is not None]
    got = simhash.fingerprint(make(rows)).collect()
    assert len(got) == len(rows)
    ordered = sorted(((i, t or "") for i, t in rows))
    wanted = []
    for (i, text), (_, after) in zip(ordered, [*ordered[1:], ordered[0]]):
        cut = len(text) // 4
        edited = text[: len(text) - cut] + after[:cut]
        wanted.append((i, len(text), sha256(edited.encode()).hexdigest()))
    assert sorted((r["doc_id"], r["n_chars"], r["edited_sha256"]) for r in got) == sorted(wanted)
    marks = {}
    for r in got:
        assert 0 <= r["near_edited"] <= 1 and 0 <= r["near_next"] <= 1
        marks.setdefault(dict(ordered)[r["doc_id"]], set()).add(r["fingerprint"])
    assert all(len(x) == 1 for x in marks.values())
    long = [r for r in got if r["doc_id"] >= 100]
    assert sum(r["near_edited"] > r["near_next"] for r in long) >= len(long) - 1
    assert simhash.fingerprint(make([])).count() == 0
    assert simhash.fingerprint(make([(None, None)])).first()["near_next"] == 1.0


def test_fingerprints_vote_with_weights():
    one, two = simhash.simhash([b"alpha beta", b"Beta, alpha beta"])
    assert one != 0 and simhash.simhash([b""])[0] == 0
    assert simhash.simhash([b"ALPHA  beta!"])[0] == one
    assert simhash.likeness(one, one) == 1 and simhash.likeness(one, two) < 1
    big = (" ".join(["w"] * 400_000)).encode()
    assert simhash.simhash([big])[0] == simhash.simhash([big])[0]


def test_within_radius_equals_brute_force(spark):
    rng = random.Random(3)
    base = [rng.getrandbits(64) for _ in range(40)]
    marks = set(base)
    for x in base:
        for flips in (1, 2, 3, 4, 5):
            y = x
            for bit in rng.sample(range(64), flips):
                y ^= 1 << bit
            marks.add(y)
    signed = [x - (1 << 64) if x >> 63 else x for x in marks]
    frame = spark.createDataFrame([(x,) for x in signed], "_fp long")
    found = simhash.within_radius(frame, frame).collect()
    wanted = {
        (a, b): ((a ^ b) & ((1 << 64) - 1)).bit_count()
        for a in signed for b in signed if ((a ^ b) & ((1 << 64) - 1)).bit_count() <= 3
    }
    assert len(found) == len(wanted)
    assert {(r["_query"], r["_found"]): r["_distance"] for r in found} == wanted


def test_copies_are_counted_as_near(spark, tmp_path, make, prose):
    rows = [(100, prose(1, 50)), (101, prose(1, 50)), (102, prose(2, 50)), (200, prose(3, 50))]
    make(rows).write.parquet(f"{tmp_path}/documents.parquet")
    near = {r["doc_id"]: r["n_near"] for r in op5_fingerprints(spark, str(tmp_path)).collect()}
    assert near == {100: 1, 101: None, 102: None, 200: 0}


def test_a_large_family_travels_once(spark):
    """Texts sent for comparison grow with a family, not with its square."""
    sent = {}
    for n in (200, 400, 800):
        nodes = [bytes([i >> 8, i & 255]) for i in range(n)]
        rng = random.Random(n)
        entries = [(x, k, k if rng.random() < 0.7 else rng.randrange(10**9)) for x in nodes for k in range(16)]
        buckets = near_dedup._buckets(spark.createDataFrame(entries, "node binary, k int, band long"))
        connected = near_dedup._connected(buckets)
        assert connected.select("label").distinct().count() == 1 and connected.count() == n
        groups = near_dedup._groups(connected, 10)
        sizes = [r["count"] for r in groups.groupBy("name").count().collect()]
        sent[n] = sum(sizes)
        assert groups.where("side = 0").count() == n and max(sizes) < 60
        whole = connected.select("node", "label")
        assert near_dedup._open_groups(buckets, whole, 10).count() == 0
        # One node left over meets every other node of its buckets, and these do not meet again.
        last = F.when(F.col("node") == nodes[-1], F.col("node")).otherwise(F.col("label"))
        apart = near_dedup._open_groups(buckets, whole.withColumn("label", last), 10)
        assert n < apart.count() < 16 * n * 1.2
    # Some eight visitors to each ten nodes.
    assert all(n < sent[n] < 4 * n for n in sent)


def test_forests_keep_components_and_few_links(spark):
    from blotter.llm.components import forest

    links = [(i, j) for i in range(60) for j in range(i + 1, 60)] + [(100, 101)]
    kept = forest(spark.createDataFrame(links, "a long, b long").coalesce(1))
    assert kept.count() == 60
    assert forest(spark.createDataFrame([], "a long, b long")).count() == 0
