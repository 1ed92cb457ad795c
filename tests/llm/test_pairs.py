"""Near-duplicates, components, top-k search and fingerprints against brute force."""

import hashlib
import random
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from impressa.llm import components, minhash, piecewise, queries, topk

DOCUMENT = "doc_id bigint, text string, lang string, source string, n_chars bigint"


def shingle_set(text):
    words = (text or "").encode().lower().split()
    if len(words) < 5:
        return frozenset([tuple(words)] if words else [])
    return frozenset(tuple(words[i : i + 5]) for i in range(len(words) - 4))


def least_reachable(nodes, links):
    parent = {n: n for n in nodes}

    def root(n):
        while parent[n] != n:
            n = parent[n]
        return n

    for a, b in links:
        a, b = root(a), root(b)
        parent[max(a, b)] = min(a, b)
    return {n: root(n) for n in nodes}


def brute_components(docs, percent=85):
    sets = {i: shingle_set(t) for i, t in docs}
    holders, links = {}, []
    for i, own in sets.items():
        for j, n in Counter(j for s in own for j in holders.get(s, ())).items():
            if 100 * n >= percent * (len(own) + len(sets[j]) - n):
                links.append((i, j))
        for s in own:
            holders.setdefault(s, []).append(i)
    return {i: (len(sets[i]), c) for i, c in least_reachable(sets, links).items()}


def assert_near_duplicates(spark, docs):
    df = spark.createDataFrame(docs, "doc_id bigint, text string")
    found = minhash.near_duplicates(df).collect()
    assert len(found) == len(docs)
    expected = brute_components(docs)
    assert {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in found} == expected
    assert all(r["kept"] == (r["doc_id"] == r["component_id"]) for r in found)


def edited(rng, words, times):
    words = list(words)
    for _ in range(times):
        words[rng.randrange(len(words))] = f"w{rng.randrange(10**6)}"
    return " ".join(words)


@pytest.fixture(scope="module")
def family():
    """Copies of one text with few to many edits, and copies of copies: similarities around 0.85."""
    rng = random.Random(4)
    base = [f"b{i}" for i in range(150)]
    docs = [(i, edited(rng, base, rng.randrange(8))) for i in range(100, 190)]
    docs += [(i, edited(rng, docs[i % 60][1].split(), 2)) for i in range(10, 60)]
    docs += [(i, " ".join(f"x{rng.randrange(10**6)}" for _ in range(60))) for i in range(200, 230)]
    return docs


def test_near_duplicates_of_a_chained_family(spark, family):
    assert_near_duplicates(spark, family)


def test_large_clusters_are_cut_into_blocks_without_losing_links(spark, family, monkeypatch):
    monkeypatch.setattr(minhash, "BLOCK_DOCUMENTS", 7)
    assert_near_duplicates(spark, family)


def test_clusters_of_many_shingles_are_cut_as_well(spark, family, monkeypatch):
    monkeypatch.setattr(minhash, "BLOCK_SHINGLES", 600)
    assert_near_duplicates(spark, family)


def test_near_duplicates_of_odd_texts(spark):
    long = " ".join(f"l{i % 5000}" for i in range(60_000))
    docs = [
        (1, None), (2, ""), (3, " \t\n "), (4, "one two"), (5, "ONE\u000btwo"), (6, "two one"),
        (7, "a b c d e"), (8, "A B C D E"), (9, "a b c d e f"), (10, "Äa b c d e"), (11, "äa b c d e"),
        (12, long), (13, long + " end"), (14, "a b c d e f"), (15, "same same same same same same"),
        (16, "same same same same same same same"),
    ]
    assert_near_duplicates(spark, docs)


def test_near_duplicates_with_null_and_repeated_ids(spark):
    docs = [(None, "a b c d e"), (None, None), (1, "a b c d e"), (1, "a b c d e"), (2, "A b c d e")]
    df = spark.createDataFrame(docs, "doc_id bigint, text string")
    found = [tuple(r) for r in minhash.near_duplicates(df).collect()]
    assert Counter(found) == Counter(
        [(None, 1, None, True), (None, 0, None, True), (1, 1, 1, True), (1, 1, 1, True), (2, 1, 1, False)]
    )


def test_near_duplicates_on_documents(spark, small):
    found = queries.op1_minhash(spark, small).collect()
    docs = [tuple(r) for r in spark.read.parquet(f"{small}/documents.parquet").select("doc_id", "text").collect()]
    expected = brute_components(docs)
    assert {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in found} == expected


def test_circulant_values_estimate_the_similarity():
    rng = np.random.RandomState(1)
    both, left, right = (rng.randint(0, 1 << 62, n).astype(np.uint64) for n in (600, 200, 200))
    a, b = np.concatenate((both, left)), np.concatenate((both, right))
    same = (minhash.signature(a) == minhash.signature(b)).mean()
    assert abs(same - 0.6) < 0.1
    assert (minhash.band_keys(minhash.signature(a)) == minhash.band_keys(minhash.signature(a))).all()


def test_unrelated_long_texts_share_no_band():
    rng = np.random.RandomState(2)
    keys = [minhash.band_keys(minhash.signature(rng.randint(0, 1 << 62, 250_000).astype(np.uint64))) for _ in range(4)]
    assert len(set(np.concatenate(keys).tolist())) == 4 * minhash.BANDS


def test_words_of_slices_are_the_words_of_the_text(monkeypatch):
    text = " Ab\tcd  ef\u00a0g\n" + "x" * 50 + " " * 30 + "last"
    whole = minhash.shingles(text * 7).tolist()
    monkeypatch.setattr(minhash, "_SLICE_BYTES", 9)
    assert minhash.shingles(text * 7).tolist() == whole


def test_long_chains_are_compared_at_a_linear_cost(spark, monkeypatch):
    monkeypatch.setattr(minhash, "BLOCK_DOCUMENTS", 8)
    words = [f"c{i}" for i in range(20_000)]
    starts = [25 * i + 22 * (i % 40 == 0) for i in range(600)]
    docs = [(i, " ".join(words[s : s + 200])) for i, s in enumerate(starts)]
    assert_near_duplicates(spark, docs)
    sketched = minhash.sketches(spark.createDataFrame(docs, "id bigint, text string"))
    laid = []
    for n in (200, 600):
        members = sketched.filter(F.col("id") < n).select("id", F.lit(0).cast("bigint").alias("cluster"), "n_shingles")
        laid.append(minhash._in_groups(members, sketched).count())
    assert laid[0] < 200 * 25 and laid[1] < 4 * laid[0]


def test_similar_pairs_at_the_exact_bound():
    sets = [np.arange(n, dtype=np.uint64) for n in (85, 84, 100)]
    linked = minhash.similar_pairs(sets, 85)
    assert linked[0, 2] and not linked[1, 2] and linked[0, 1]


@pytest.mark.parametrize("seed", range(3))
def test_components_of_random_graphs(spark, seed):
    rng = random.Random(seed)
    links = [(rng.randrange(400), rng.randrange(400)) for _ in range(250)]
    links += [(1000 + i, 1001 + i) for i in range(60)] + [(2000, 2000 + i) for i in range(1, 80)]
    found = components.connected_components(spark.createDataFrame(links, "a bigint, b bigint")).collect()
    links = [(a, b) for a, b in links if a != b]
    expected = least_reachable({n for link in links for n in link}, links)
    assert {r["node"]: r["component"] for r in found} == expected and len(found) == len(expected)


def test_components_without_edges(spark):
    assert components.connected_components(spark.createDataFrame([], "a bigint, b bigint")).count() == 0


# ---------------------------------------------------------------- top-k


def brute_top_k(rows, every, k):
    usable = {
        i: [int(np.floor(256 * float(x))) for x in v]
        for i, v in rows
        if i is not None and v is not None and all(x is not None and np.isfinite(x) for x in v)
    }
    found = set()
    for q, a in usable.items():
        if q % every == 0:
            scores = sorted(
                (-sum(x * y for x, y in zip(a, b, strict=True)), c)
                for c, b in usable.items()
                if c != q and len(b) == len(a)
            )
            found |= {(q, rank, c, -s) for rank, (s, c) in enumerate(scores[:k], 1)}
    return found


def assert_top_k(spark, rows, k=5):
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<float>")
    vectors = topk.integer_vectors(df, "vec_id", "embedding")
    found = topk.top_k_search(vectors, F.col("id") % 3 == 0, k)
    assert {tuple(r) for r in found.collect()} == brute_top_k(rows, 3, k)


def test_top_k_with_ties_and_copies(spark, monkeypatch):
    monkeypatch.setattr(topk, "QUERY_BLOCK", 20)
    monkeypatch.setattr(topk, "CANDIDATE_BLOCK", 30)
    rng = random.Random(2)
    rows = [(i, [rng.choice([-1.0, 0.0, 0.5, 1.0]) for _ in range(4)]) for i in range(150)]
    rows += [(i, [0.5, 0.5, 0.5, 0.5]) for i in range(150, 260)]
    assert_top_k(spark, rows)


def test_top_k_of_repeated_rows(spark):
    rows = [(0, [2.0, 0.0]), (0, [2.0, 0.0]), (0, [0.0, 2.0]), (6, [1.0, 1.0]), (6, [1.0, 1.0]), (7, [1.0, 0.0]), (8, [3.0, 1.0])]
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<float>")
    found = topk.top_k_search(topk.integer_vectors(df, "vec_id", "embedding"), F.col("id") % 3 == 0, 3)
    want = []
    for i, a in rows:
        if i % 3 == 0:
            scored = sorted((-sum(x * y for x, y in zip(a, b, strict=True)) * 65536, j) for j, b in rows if j != i)[:3]
            want += [(i, rank, j, -score) for rank, (score, j) in enumerate(scored, 1)]
    assert sorted(tuple(r) for r in found.collect()) == sorted(want)


def test_top_k_leaves_out_what_cannot_be_scored(spark):
    nan, inf = float("nan"), float("inf")
    rows = [
        (0, [1.0, 2.0]), (1, None), (2, [None, 1.0]), (3, [nan, 1.0]), (4, [inf, 0.0]), (None, [1.0, 1.0]),
        (5, [-3.0, 1e5]), (6, [0.1, -0.1]), (7, [1.0]), (9, [2.0]), (12, [4.0, 4.0, 4.0]), (15, []),
    ]
    assert_top_k(spark, rows)


def test_top_k_of_large_components_is_exact(spark):
    assert_top_k(spark, [(i, [1e5 + i, 3e5 - 7 * i, float(i)]) for i in range(30)], k=3)


def test_top_k_of_an_empty_table(spark):
    assert_top_k(spark, [])
    assert_top_k(spark, [(1, [1.0])])


# ---------------------------------------------------------------- piecewise hashing


def levenshtein(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        new = [i]
        for j, y in enumerate(b, 1):
            new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (x != y)))
        row = new
    return row[-1]


def test_edit_distances():
    rng = random.Random(3)
    pick = lambda: "".join(rng.choice("ABC") for _ in range(rng.choice([0, 1, 9, 32, 63, 64]))).encode()
    a, b = [pick() for _ in range(300)], [pick() for _ in range(300)]
    assert piecewise.edit_distances(a, b).tolist() == [levenshtein(x, y) for x, y in zip(a, b, strict=True)]


def test_fingerprints_tell_edits_from_other_texts():
    rng = random.Random(9)
    text = " ".join(str(rng.random()) for _ in range(400))
    other = " ".join(str(rng.random()) for _ in range(400))
    prints = [piecewise.fingerprint(t) for t in (text, text[:3000] + "!" + text[3000:], other)]
    same, edit, none = piecewise.likenesses([prints[0]] * 3, prints)
    assert same == 1.0 and edit > 0.9 and none < 0.3
    moved = piecewise.fingerprint("x" * 50 + text)
    assert piecewise.likenesses([prints[0]], [moved])[0] > 0.7


def test_fingerprints_of_odd_texts():
    assert piecewise.fingerprint("") == "3::"
    for text in ("a", "ab" * 3, "é" * 5000, "\0" * 100_000, "x" * 300_001):
        block, fine, coarse = piecewise.fingerprint(text).split(":")
        assert int(block) >= 3 and 1 <= len(fine) <= 64 and 1 <= len(coarse) <= 32
    assert piecewise.likenesses(["3::", "3::"], ["3::", "3:a:a"]).tolist() == [1.0, 0.0]


def plain_fingerprint(text):
    """The fingerprint, byte by byte, with numbers of Python."""
    data = text.encode()
    triggers = []
    for p in range(len(data)):
        x = sum((data[p - k] + 1) * 0x01000193**k for k in range(min(p + 1, 7))) % 2**32
        x = (x ^ (x >> 15)) * 0x85EBCA6B % 2**32
        triggers.append(x ^ (x >> 13))

    def signs(block, most):
        made, total, place = "", 0, 0
        for byte, trigger in zip(data, triggers, strict=True):
            total += (byte + 1) * pow(0x9E3779B97F4A7C15, place % 4096 + 1, 2**64)
            place += 1
            if trigger % block == block - 1 and len(made) < most - 1:
                made, total, place = made + sign(total % 2**64), 0, 0
        return made + sign(total % 2**64) if place else made

    def sign(total):
        code = (total ^ (total >> 32)) * 0xD6E8FEB86659FD93 % 2**64 >> 58
        return "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/"[code]

    block = 3
    while block * 64 < len(data):
        block *= 2
    while block > 3 and sum(t % block == block - 1 for t in triggers) < 31:
        block //= 2
    return f"{block}:{signs(block, 64)}:{signs(2 * block, 32)}"


def plain_likeness(left, right):
    if left == right:
        return 1.0
    sides = []
    for block, *signs in (left.split(":"), right.split(":")):
        sides.append({int(block): signs[0], 2 * int(block): signs[1]})
    found = [
        1 - levenshtein(a, sides[1][block]) / max(len(a), len(sides[1][block]))
        for block, a in sides[0].items()
        if a and sides[1].get(block)
    ]
    return max(found, default=0.0)


def test_fingerprints_against_brute_force():
    rng = random.Random(12)
    texts = ["", "a", "é" * 700, "\0" * 9000, " ".join(str(rng.random()) for _ in range(500))]
    texts += ["".join(rng.choice("ab cé") for _ in range(n)) for n in (6, 7, 8, 191, 192, 193, 3000, 20_000)]
    assert [piecewise.fingerprint(t) for t in texts] == [plain_fingerprint(t) for t in texts]


def test_comparison_with_the_next_against_brute_force(spark):
    rng = random.Random(15)
    text = lambda: "".join(rng.choice("abcdé ") for _ in range(rng.randrange(300)))
    docs = [(i, text()) for i in range(60)] + [(None, text()) for _ in range(80)] + [(None, None), (None, "same")]
    df = spark.createDataFrame([*docs, (None, "same")], "doc_id bigint, text string").repartition(4)
    found = piecewise.compare_with_next(df).collect()
    order = sorted([*docs, (None, "same")], key=lambda d: (d[0] is None, -(d[0] or 0), (d[1] or "").encode()))
    expected = []
    for (i, own), (_, after) in zip(order, order[1:] + order[:1], strict=True):
        own, after = own or "", after or ""
        new = own[: len(own) - len(own) // 2] + after[: len(own) // 2]
        a, b, c = map(plain_fingerprint, (own, new, after))
        digest = hashlib.sha256(new.encode()).hexdigest()
        expected.append((i, len(own), digest, a, b, round(plain_likeness(a, b), 9), round(plain_likeness(a, c), 9)))
    rows = [(*tuple(r)[:5], round(r["near_edited"], 9), round(r["near_next"], 9)) for r in found]
    assert Counter(rows) == Counter(expected)


def test_rows_without_id_are_spread_over_ranges(spark):
    df = spark.range(4000).select(F.lit(None).cast("bigint").alias("id"), F.sha1(F.col("id").cast("string")).alias("text"))
    sizes = [r["count"] for r in piecewise._beside_next(df).groupBy("_range").count().collect()]
    assert len(sizes) > 30 and max(sizes) < 400 and sum(sizes) < 4000 + 2 * len(sizes)


def test_each_row_meets_its_next(spark):
    rng = random.Random(5)
    docs = [(i, "".join(rng.choice("abcdé ") for _ in range(rng.randrange(80)))) for i in rng.sample(range(-900, 900), 300)]
    docs += [(docs[0][0], "again"), (docs[0][0], "again"), (None, "no id"), (None, None), (1000, None)]
    df = spark.createDataFrame(docs, "doc_id bigint, text string").repartition(5)
    found = piecewise.compare_with_next(df).collect()
    order = sorted(docs, key=lambda d: (d[0] is None, -(d[0] or 0), d[1] is not None, d[1] or ""))
    expected = []
    for (i, text), (_, after) in zip(order, order[1:] + order[:1], strict=True):
        text, after = text or "", after or ""
        half = len(text) // 2
        new = text[: len(text) - half] + after[:half]
        a, b, c = map(piecewise.fingerprint, (text, new, after))
        expected.append((i, len(text), a, b, *piecewise.likenesses([a, a], [b, c])))
    columns = ("doc_id", "n_chars", "fingerprint", "edited_fingerprint", "near_edited", "near_next")
    assert Counter(tuple(r[c] for c in columns) for r in found) == Counter(expected)


def test_a_single_row_is_its_own_next(spark):
    [row] = piecewise.compare_with_next(spark.createDataFrame([(7, "abcd")], "doc_id bigint, text string")).collect()
    assert row["near_next"] == 1.0 and row["n_chars"] == 4
    assert piecewise.compare_with_next(spark.createDataFrame([], "doc_id bigint, text string")).count() == 0
