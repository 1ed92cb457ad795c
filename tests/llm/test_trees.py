"""Conversation tries, toxicity and hard negatives."""

import random
import zlib
from hashlib import sha256

import numpy as np
import pytest
from pyspark.sql import functions as F

from impressa.llm import negatives, queries, toxicity, trie

# ---------------------------------------------------------------- conversation trie

NODE = "conv_id depth parent_conv_id n_convs n_children n_leaves saved_tokens ends_sha256".split()
TURNS = "conv_id bigint, turn bigint, role string, text string"


def brute_sequences(rows):
    turns = {}
    for c, turn, role, text in rows:
        if c is not None:
            role, text = role or "", text or ""
            digest = sha256(f"{len(role)}:{role}{text}".encode()).hexdigest()
            turns.setdefault(c, []).append((turn is not None, turn or 0, digest, role, text))
    found = {}
    for c, own in turns.items():
        taken = zlib.crc32(str(c).encode()) % 6
        base = c - int(np.fmod(c, 100))
        both = sorted(turns.get(base, []))[:taken] + sorted(own)[taken:]
        found[c] = [t[3:] for t in both]
    return found


def brute_trie(sequences):
    members = {}
    for c, path in sequences.items():
        for d in range(len(path) + 1):
            members.setdefault(tuple(path[:d]), []).append(c)
    kids = {}
    for path in members:
        if path:
            kids.setdefault(path[:-1], []).append(path)
    below = {}
    for path in sorted(members, key=len, reverse=True):
        own = (len(members[path]) - 1) * len(path[-1][1]) if path else 0
        under = [below[k] for k in kids.get(path, [])]
        below[path] = (sum(u[0] for u in under) or 1, own + sum(u[1] for u in under))
    rows = []
    for path, inside in members.items():
        ends = ",".join(str(c) for c in sorted(c for c in inside if len(sequences[c]) == len(path)))
        above = min(members[path[:-1]]) if path else None
        rows.append((min(inside), len(path), above, len(inside), len(kids.get(path, [])), *below[path],
                     sha256(ends.encode()).hexdigest()))
    return sorted(rows, key=str)


def nodes_of(spark, rows, batches=2, extra=False):
    df = spark.createDataFrame(rows, TURNS)
    if extra:
        df = df.withColumns({c: F.lit("clash") for c in ("depth", "x", "position", "chars", "a", "owner")})
    conversations, turns = trie.rebuilt(trie.ordered_turns(df))
    return sorted((tuple(r) for r in trie.prefix_trie(conversations, turns, batches).select(*NODE).collect()), key=str)


@pytest.fixture(scope="module")
def talks():
    """Shared beginnings, copies, chains, null and repeated turns, negative ids."""
    rng = random.Random(1)
    rows = []
    for c in [*range(-130, 130), 1000, 2001]:
        if rng.random() < 0.1:
            continue
        for turn in range(rng.choice([1, 1, 2, 3, 4, 7, 9, 20])):
            text = rng.choice(["x", "yy", "é", "", None]) if rng.random() < 0.35 else "same"
            rows.append((c, None if rng.random() < 0.02 else turn, rng.choice(["u", None, "a"]) if rng.random() < 0.1 else "u", text))
        if rng.random() < 0.05:
            rows.append(rows[-1])
    return [*rows, (None, 1, "u", "q")]


@pytest.mark.parametrize("batches", [1, 3])
def test_trie_equals_brute_force_in_any_number_of_batches(spark, talks, batches):
    assert nodes_of(spark, talks, batches, extra=True) == brute_trie(brute_sequences(talks))


def test_trie_of_a_long_conversation_beside_its_beginnings(spark):
    long = [(7, t, "u", str(t % 3)) for t in range(700)]
    rows = [*long, *[(c, t, "u", str(t % 3)) for c in (1, 2, 3) for t in range(c * 150)], *[(9, t, "u", "z") for t in range(130)]]
    assert nodes_of(spark, rows, 2) == brute_trie(brute_sequences(rows))


def test_trie_without_conversations_or_turns(spark):
    assert nodes_of(spark, []) == []
    assert nodes_of(spark, [(None, 0, "u", "x")]) == []
    # A single conversation whose only turn is replaced by one that does not exist.
    alone = next(c for c in range(101, 200) if zlib.crc32(str(c).encode()) % 6 > 0)
    assert nodes_of(spark, [(alone, 0, "u", "x")]) == brute_trie({alone: []})


def test_two_fattest_numbers(spark):
    pairs = [(a, b) for a in range(20) for b in range(a + 1, 40)] + [(2**40 - 1, 2**41 + 5)]
    df = spark.createDataFrame(pairs, "a bigint, b bigint").withColumn("f", trie.two_fattest(F.col("a"), F.col("b")))
    for a, b, f in df.collect():
        if b < 100:
            assert f == max(range(a + 1, b + 1), key=lambda n: (n & -n, n))
        else:
            assert f == 2**41


def test_ids_of_an_end_are_hashed_in_order_over_many_runs(spark, monkeypatch):
    ids = random.Random(2).sample(range(-10**6, 10**6), 30_000)
    df = spark.createDataFrame([(1, 2, 3, i) for i in ids], "depth bigint, a bigint, b bigint, conv_id bigint").repartition(7)
    rows = trie.ends_digests(df).collect()
    assert [r["ends_sha256"] for r in rows] == [sha256(",".join(map(str, sorted(ids))).encode()).hexdigest()]


def test_texts_of_the_last_turns(spark):
    rows = [(100, 0, "u", "hello"), (100, 1, "a", "hi"), (101, 0, "u", "hello"), (101, 1, "a", "no")]
    nodes = spark.createDataFrame([(100, 0), (100, 2), (101, 2)], "conv_id bigint, depth bigint")
    texts = spark.createDataFrame([(c, t + 1, x) for c, t, _, x in rows], "conv_id bigint, depth bigint, text string")
    found = {(r["conv_id"], r["depth"]): r["text"] for r in trie.last_turns(nodes, texts).collect()}
    assert found == {(100, 0): None, (100, 2): "hi", (101, 2): "no"}


# ---------------------------------------------------------------- hard negatives


def test_residue_products_are_exact_for_large_and_negative_components():
    rng = np.random.RandomState(5)
    for size, columns in ((200, 64), (40_000, 300), (10**8, 7), (3, 5000)):
        a, b = rng.randint(-size, size + 1, (30, columns)), rng.randint(-size, size + 1, (40, columns))
        bound = int(np.sqrt((a.astype(float) ** 2).sum(1).max() * (b.astype(float) ** 2).sum(1).max())) + 1
        primes = negatives.primes_for(bound)
        assert (negatives.exact_products(a, b, primes) == a @ b.T).all()
    assert len(negatives.primes_for(10)) == 1
    with pytest.raises(ValueError):
        negatives.primes_for(1 << 62)


def brute_negatives(rows, is_anchor, positives=5, count=3):
    out = []
    for i, label, vector in rows:
        if not is_anchor(i):
            continue
        scored = sorted(
            (-sum(x * y for x, y in zip(vector, v, strict=True)), j, same == label)
            for j, same, v in rows if j != i and len(v) == len(vector)
        )
        for p, j, _ in [s for s in scored if s[2]][:positives]:
            inside = [(n, m) for n, m, same in scored if not same and 50 * -p <= 100 * -n <= 95 * -p][:count]
            out += [(i, j, rank, m, -p, -n) for rank, (n, m) in enumerate(inside, 1)]
    return sorted(out)


def mined(spark, rows, is_anchor, **more):
    df = spark.createDataFrame(rows, "id bigint, label bigint, vector array<bigint>").withColumn("row", F.lit("clash"))
    return sorted(tuple(r) for r in negatives.hard_negatives(df, is_anchor, **more).collect())


def test_hard_negatives_equal_brute_force_over_many_cells(spark, monkeypatch):
    monkeypatch.setattr(negatives, "ANCHOR_BLOCK", 5)
    monkeypatch.setattr(negatives, "CANDIDATE_BLOCK", 30)
    rng = random.Random(4)
    # Most rows of one label; few values, so that there are ties; two lengths; negative scores; copies.
    rows = [(i, 0 if rng.random() < 0.6 else rng.randrange(4), [rng.randint(-3, 6) for _ in range(4 if i % 9 else 3)])
            for i in range(-40, 160)]
    rows += [rows[10], rows[11]]
    found = mined(spark, rows, F.col("id") % 10 == 0)
    assert found == brute_negatives(rows, lambda i: i % 10 == 0)
    assert len(found) > 100


def test_hard_negatives_of_few_rows(spark):
    assert mined(spark, [], F.col("id") % 10 == 0) == []
    assert mined(spark, [(0, 1, [5])], F.col("id") % 10 == 0) == []
    rows = [(0, 1, [10]), (1, 1, [10]), (2, 2, [9]), (3, 2, [4]), (4, 3, [0])]
    assert mined(spark, rows, F.col("id") == 0) == [(0, 1, 1, 2, 100, 90)]
    assert mined(spark, rows, F.col("id") == 77) == []


def test_rows_without_whole_vectors_take_no_part(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(1, 1, [0.5, -0.001]), (2, None, [1.0, 1.0]), (3, 1, None), (4, 1, [1.0, None]), (5, 1, [nan, 1.0]),
            (6, 1, [inf, 1.0]), (None, 1, [1.0, 1.0])]
    df = spark.createDataFrame(rows, "vec_id bigint, label int, embedding array<float>").withColumn("id", F.lit("clash"))
    whole = negatives.integer_rows(df, "vec_id", "embedding", F.col("label"))
    assert [tuple(r) for r in whole.collect()] == [(1, 1, [128, -1])]


# ---------------------------------------------------------------- toxicity

DOCUMENT = "doc_id bigint, text string"


@pytest.fixture(scope="module")
def spoken():
    """Documents of invented words; toxic ones have words of their own, some of them disguised."""
    rng = random.Random(6)
    syllables = ["ba", "ne", "ti", "lo", "ru", "ka", "mi", "so"]
    word = lambda: "".join(rng.choices(syllables, k=rng.randint(2, 5)))
    bad = ["zorkig", "fleebin", "grumphal"]
    rows = []
    for i in range(1500):
        words = [word() for _ in range(rng.randint(8, 80))]
        toxic = i % 5 == 0
        if toxic:
            for _ in range(rng.randint(1, 4)):
                # An ending of its own, so that only the beginning of the word is known.
                words.insert(rng.randrange(len(words)), rng.choice(bad) + rng.choice(["", word(), "!"]))
        rows.append((i, " ".join(words), int(toxic)))
    return rows


@pytest.fixture(scope="module")
def model(spark, spoken):
    known = spark.createDataFrame([(i, t) for i, t, _ in spoken if i % 3], DOCUMENT)
    # Repeated, null and unmatched labels.
    labels = [(i, y) for i, _, y in spoken] + [(5, 0), (5, None), (None, 1), (99_999, 1)]
    return toxicity.learn(known, spark.createDataFrame(labels, "doc_id bigint, toxic int"))


def test_toxicity_of_held_out_documents(spark, spoken, model):
    unseen = [(i, t, y) for i, t, y in spoken if i % 3 == 0]
    df = spark.createDataFrame([(i, t) for i, t, _ in unseen], DOCUMENT)
    found = {r["doc_id"]: r["score"] for r in toxicity.score(df, model, ["doc_id"]).collect()}
    toxic = [found[i] >= 0.3 for i, _, y in unseen if y]
    clean = [found[i] >= 0.3 for i, _, y in unseen if not y]
    assert all(0 <= s <= 1 for s in found.values())
    assert sum(toxic) / len(toxic) > 0.95 and sum(clean) / len(clean) < 0.03


def test_disguised_words_are_known(model):
    describer = toxicity.Describer(model.lexicon)
    plain, disguised = describer.describe("ba zorkig ti"), describer.describe("ba z0rk1g ti")
    at = toxicity.FEATURES.index
    assert plain[at("strongest")] == disguised[at("strongest")] > 0.5
    assert (plain[at("disguised")], disguised[at("disguised")]) == (0, pytest.approx(1 / 3))
    assert disguised[at("disguised_entries")] > 0


def test_words_near_an_address(model):
    at = toxicity.FEATURES.index("near_address")
    near, far = ["you", "zorkig"], ["you", *["ba"] * 9, "zorkig"]
    describer = toxicity.Describer(model.lexicon)
    assert describer.describe(" ".join(near))[at] == pytest.approx(1 / 2)
    assert describer.describe(" ".join(far))[at] == 0
    both = [*far, "ba", "tu"]
    assert describer.describe(" ".join(both))[at] == pytest.approx(1 / len(both))


def test_toxicity_of_unusual_rows(spark, model):
    rows = [(1, None), (1, ""), (None, "zorkig"), (2, "... 12 !"), (3, "ba ti " * 60_000 + "zorkig"), (3, "ba"), (3, "ba")]
    df = spark.createDataFrame(rows, DOCUMENT).withColumns({c: F.lit("x") for c in ("features", "margin", "described", "prediction")})
    scored = toxicity.score(df, model, ["doc_id", "margin"]).collect()
    assert len(scored) == len(rows) and all(0 <= r["score"] <= 1 and r["margin"] == "x" for r in scored)
    empty = [r["score"] for r in scored if r["doc_id"] == 1]
    assert empty[0] == empty[1]
    assert toxicity.score(df.limit(0), model, ["doc_id"]).count() == 0


def test_toxicity_learned_from_one_label_or_none(spark, spoken):
    known = spark.createDataFrame([(i, t) for i, t, _ in spoken[:40]], DOCUMENT)
    for labels, base in (([], 0.0), ([(i, 1) for i in range(40)], 1.0), ([(i, 0) for i in range(40)], 0.0)):
        fitted = toxicity.learn(known, spark.createDataFrame(labels, "doc_id bigint, toxic int"))
        scored = toxicity.score(known, fitted, ["doc_id"])
        assert {r["score"] for r in scored.collect()} == {base}


def test_lexicon_counts_all_labelled_documents(spark, spoken):
    labelled = spark.createDataFrame(
        [(t, y, i % 2) for i, t, y in spoken], "text string, toxic int, half int"
    )
    lexicons = toxicity.learn_lexicons(labelled)
    toxic = sum(y for *_, y in spoken) / len(spoken)
    for entry, strength in lexicons.whole.items():
        with_it = [y for _, t, y in spoken if any(entry in toxicity.entries(toxicity.plain(w)) for w in toxicity._WORD.findall(t.lower()))]
        prior = toxicity._PRIOR_DOCUMENTS
        assert strength == pytest.approx((sum(with_it) + toxic * prior) / (len(with_it) + prior))
    assert {"zorkig", "flee-", "grump-"} <= set(lexicons.whole)


def test_toxicity_query_on_the_tables(spark, medium):
    scored = queries.op12_toxicity(spark, medium)
    rows = scored.collect()
    assert len(rows) == spark.read.parquet(f"{medium}/documents.parquet").count()
    labels = {r["doc_id"]: r["toxic"] for r in spark.read.parquet(f"{medium}/labels.parquet").collect()}
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2) for r in rows)
    assert all(r["predicted"] == int(r["score"] >= 0.3) for r in rows)
    judged = [(labels[r["doc_id"]], r["predicted"]) for r in rows if r["held_out"] and r["doc_id"] in labels]
    assert sum(p for y, p in judged if not y) <= 0.03 * len(judged)
    assert sum(p for y, p in judged if y) >= 0.5 * sum(y for y, _ in judged)
