"""SetSketch components, whitening and the conversation trie against brute force, on odd and on hot input."""

from __future__ import annotations

import hashlib
import random
import re
import zlib
from collections import defaultdict

import numpy as np
import pytest

from shoplens.llm import setsketch, trie, whitening

# Near-duplicates.


def shingles(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    return frozenset(zip(words, words[1:])) if len(words) > 1 else frozenset(words)


def brute_components(rows):
    """(key, text) -> sorted (key, n, component, kept), by all pairs of distinct sets."""
    sets = [shingles(text) for _, text in rows]
    distinct = list({s for s in sets if s})
    root = {s: s for s in distinct}

    def find(s):
        while root[s] != s:
            s = root[s]
        return s

    for i, a in enumerate(distinct):
        for b in distinct[:i]:
            if 100 * len(a & b) >= 80 * len(a | b):
                root[find(a)] = find(b)
    least = defaultdict(list)
    for (key, _), s in zip(rows, sets):
        if s and key is not None:
            least[find(s)].append(key)
    out = []
    for (key, _), s in zip(rows, sets):
        component = min(least[find(s)], default=None) if s else key
        out.append((key, len(s), component, key is not None and key == component))
    return sorted(out, key=str)


def found_components(df):
    return sorted(map(tuple, setsketch.components(df).collect()), key=str)


def near_copies(rng, n, words=60, edits=2):
    base = [f"w{rng.randrange(10**6)}" for _ in range(words)]
    for _ in range(n):
        copy = list(base)
        for _ in range(rng.randrange(edits + 1)):
            copy[rng.randrange(words)] = f"e{rng.randrange(10**6)}"
        yield " ".join(copy)


@pytest.fixture(scope="module")
def texts():
    rng = random.Random(5)
    found = list(near_copies(rng, 150)) + list(near_copies(rng, 40, edits=6)) + ["The same TEXT twice"] * 30
    passage = " ".join(f"p{i}" for i in range(50))
    found += [f"{passage} " + " ".join(f"x{rng.randrange(10**6)}" for _ in range(rng.randrange(8, 30))) for _ in range(150)]
    found += ["one", "ONE", "", None, " \n", "a b", "b a", "a b a b a b", "É é", "é É", "y" * 100_000, "z " * 50_000]
    return [(i if i % 17 else None, t) for i, t in enumerate(found)]


def test_components_are_those_of_all_pairs(make, texts, odd):
    rows = texts + [(r[0], r[1]) for r in odd] + [(5, "a wholly different text under a known key")]
    assert found_components(make([(k, t, "en", "a") for k, t in rows])) == brute_components(rows)


def test_crowded_buckets_lose_no_link(make, texts, monkeypatch):
    # Two sets beside the largest component are many here, and blocks are of three.
    monkeypatch.setattr(setsketch, "FEW", 1)
    monkeypatch.setattr(setsketch, "BLOCK", 3)
    assert found_components(make([(k, t, "en", "a") for k, t in texts], clash=False)) == brute_components(texts)


def test_sets_of_many_crowded_buckets_are_sent_once_per_block(spark, monkeypatch):
    monkeypatch.setattr(setsketch, "BLOCK", 5)
    members = [(bucket, row, row, 9, 20) for bucket in range(40) for row in range(20)]
    members += [(99, row, row, 9, 7) for row in range(50, 57)]
    dealt = setsketch._blocks(spark.createDataFrame(members, "bucket long, row long, part long, n long, size long")).collect()
    assert len(dealt) == 20 * 4 + 7 * 2
    groups = {}
    for r in dealt:
        groups.setdefault((r.cluster, r.x, r.y), []).append((r.own, r.row))
    met = [(a, b) for (_, x, y), rows in groups.items() for o, a in rows for p, b in rows if o == x and p == y and (x != y or a < b)]
    pairs = [{a, b} for a, b in met]
    assert len(pairs) == 20 * 19 // 2 + 7 * 6 // 2 and len(set(map(frozenset, pairs))) == len(pairs)


def test_no_documents_no_components(make):
    assert found_components(make([])) == []


def test_registers_merge_and_estimate():
    rng = np.random.default_rng(1)
    for similar, n in ((0.8, 400), (0.5, 150), (0.9, 5_000), (0.0, 30)):
        common = round(2 * n * similar / (1 + similar))
        a_b = rng.integers(0, 1 << 63, size=2 * n - common, dtype=np.uint64)
        a, b = setsketch.registers(a_b[:n]), setsketch.registers(a_b[n - common :])
        assert (setsketch.merged(a, b) == setsketch.registers(a_b)).all()
        sizes = np.array([float(n)])
        best, short = setsketch.estimate(a[None], b[None], sizes, sizes)
        true = common / (2 * n - common)
        assert abs(best[0] - true) < 5 * (true * (1 - true) / setsketch.REGISTERS) ** 0.5 + 0.02
        assert (short[0] <= setsketch.MARGIN) == (true >= 0.8 or short[0] <= setsketch.MARGIN)
        assert true > 0.6 or short[0] > setsketch.MARGIN


def test_bands_find_what_is_just_similar_enough():
    """Of pairs at 0.8 to 0.81 almost all share a band; the bound in the module is 3 in a million."""
    rng = np.random.default_rng(2)
    for _ in range(300):
        words = rng.integers(0, 1 << 63, size=110, dtype=np.uint64)
        a, b = setsketch.registers(words[:99]), setsketch.registers(words[10:])
        assert ((a == b).reshape(setsketch.BANDS, setsketch.ROWS).all(axis=1)).any()


# Whitening.


def vectors(spark, rows):
    wide = spark.createDataFrame(rows, "vec_id BIGINT, embedding ARRAY<FLOAT>, label INT")
    return wide.selectExpr("*", "1 AS a", "2 AS b", "3 AS c").toDF(*wide.columns, "key", "x", "VEC_ID")


def test_whitening_is_that_of_the_distinct_vectors(spark):
    rng = np.random.default_rng(3)
    plain = (rng.normal(size=(300, 24)) @ rng.normal(size=(24, 24))).astype(np.float32)
    rows = [(i, v.tolist(), i) for i, v in enumerate(plain)] + [(1_000 + i, plain[7].tolist(), None) for i in range(200)]
    odd = [(None, plain[8].tolist(), 1), (5, plain[9].tolist(), 1)]
    lost = [(2_000, None, 1), (2_001, [None, *plain[1].tolist()[1:]], 1), (2_002, [float("nan")] * 24, 1), (2_003, [float("inf")] * 24, 1)]
    found = whitening.whiten(vectors(spark, rows + odd + lost), keep=5).collect()
    x = np.floor(64 * plain.astype(float)).astype(np.int64) + 1_000_000
    n, sums = 300, x.sum(axis=0)
    centred = (n * x - sums) / n
    values, axes = np.linalg.eigh(centred.T @ centred / n)
    values, axes = values[::-1], axes[:, ::-1]
    white = centred @ axes[:, :5] / np.sqrt(values[:5])
    assert len(found) == 5 * 502 and {r.n for r in found} == {300}
    assert sorted(r.key for r in found if r.key is not None) == sorted([i for i, *_ in rows + odd if i is not None] * 5)
    at = {(r.key, r.component): r for r in found if r.key is not None and r.key != 5}
    signs = [np.sign(at[0, c + 1].whitened * white[0, c]) for c in range(5)]
    for i in set(range(300)) - {5}:
        for c in range(5):
            r = at[i, c + 1]
            assert r.whitened == pytest.approx(signs[c] * white[i, c], abs=1e-9)
            assert r.explained == pytest.approx(values[c] / values.sum(), rel=1e-12)
            assert r.deviation == int(((n * x[i] - sums) ** 2).sum()) and r.identity_error < 1e-9
    assert at[1_000, 3].whitened == at[7, 3].whitened


def test_whitening_of_little(spark):
    assert whitening.whiten(vectors(spark, [])).collect() == []
    assert whitening.whiten(vectors(spark, [(1, [0.5, 0.25], 0), (2, [0.5, 0.25], 0)])).collect() == []
    # Two vectors make one component; what a shorter one lacks is zero.
    found = whitening.whiten(vectors(spark, [(1, [1.0, 2.0], 0), (2, [1.0], 0), (3, [1.0, 0.0], 0), (4, [], 0)])).collect()
    by_key = defaultdict(list)
    for r in found:
        by_key[r.key].append(round(abs(r.whitened), 9))
    assert by_key[2] == by_key[3] and len(by_key[4]) == 2 and {r.n for r in found} == {4}


def test_deviations_stay_exact_beyond_doubles(spark):
    found = whitening.whiten(vectors(spark, [(1, [2.0**20, 0.0], 0), (2, [-(2.0**20), 1.0], 0), (3, [0.0, 3.0], 0)])).collect()
    x = [[2**26, 0], [-(2**26), 64], [0, 192]]
    sums = [sum(v[i] for v in x) for i in range(2)]
    assert {r.key: r.deviation for r in found} == {k: sum((3 * v[i] - sums[i]) ** 2 for i in range(2)) for k, v in enumerate(x, 1)}


def test_small_eigenvalues_keep_their_digits():
    rng = np.random.default_rng(4)
    axes = np.linalg.qr(rng.normal(size=(12, 12)))[0]
    scales = 10.0 ** -np.arange(12)
    # Graded by rows, as a Cholesky factor is: squares would lose what is below 1e-8 of the largest.
    matrix = (axes * scales) @ axes.T
    values, vectors_ = whitening.components((matrix + matrix.T) / 2)
    assert values[:6] == pytest.approx(scales[:6], rel=1e-9)
    assert np.abs(vectors_.T @ vectors_ - np.eye(len(values))).max() < 1e-12


# The trie.


def brute_trie(rows):
    """(conv, turn, role, text) -> the nodes, sorted."""
    own = defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            own[conv].append((turn is not None, turn or 0, role or "", text or ""))
    own = {c: [t[2:] for t in sorted(turns)] for c, turns in own.items()}
    members = defaultdict(list)
    for conv, turns in own.items():
        h = zlib.crc32(str(conv).encode()) % 9
        base = conv - (conv % 5 if conv >= 0 else -(-conv % 5))
        rebuilt = tuple(own.get(base, [])[:h] + turns[h:])
        for d in range(len(rebuilt) + 1):
            members[rebuilt[:d]].append((conv, d == len(rebuilt)))
    children = defaultdict(list)
    for node in members:
        if node:
            children[node[:-1]].append(node)
    below = {}
    for node in sorted(members, key=len, reverse=True):
        saved = (len(members[node]) - 1) * len(node[-1][1].encode()) if node else 0
        below[node] = (sum(below[x][0] for x in children[node]) or 1, saved + sum(below[x][1] for x in children[node]))
    out = []
    for node, found in members.items():
        ends = ",".join(str(c) for c in sorted(c for c, last in found if last))
        parent = min(c for c, _ in members[node[:-1]]) if node else None
        out.append((min(found)[0], len(node), parent, len(found), len(children[node]), *below[node], hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out, key=str)


def chats(spark, rows):
    wide = spark.createDataFrame(rows, "conv_id BIGINT, turn BIGINT, role STRING, text STRING")
    return wide.selectExpr("*", "1 AS a", "2 AS b", "3 AS c").toDF(*wide.columns, "ref", "conv", "TEXT")


def found_trie(df):
    return sorted(map(tuple, trie.trie(df).collect()), key=str)


@pytest.fixture(scope="module")
def conversations():
    rng = random.Random(9)
    rows = []
    for conv in [*range(0, 60, 5), *range(100, 160), -7, -5, 10**12]:
        for turn in range(rng.randrange(1, 14)):
            rows.append((conv, turn, rng.choice(["user", "assistant"]), rng.choice(["hi", "yes é", "no"]) if turn < 6 else f"t{rng.random()}"))
    # Nulls anywhere, ties, repeated rows, a very long text, and a group of equal conversations without a base.
    rows += [(3, None, None, None), (3, None, "user", "first"), (3, 1, "user", None), (3, 1, "user", None), (3, 2, "b", "x"), (3, 2, "a", "y")]
    rows += [(None, 1, "user", "no one's"), (4, 5, "user", "l" * 300_000), (4, 6, "user", "")]
    rows += [(c, t, "user", f"same {t}") for c in range(10_001, 10_400, 3) for t in range(10)]
    return rows


def test_trie_is_that_of_the_rebuilt_texts(spark, conversations):
    assert found_trie(chats(spark, conversations)) == brute_trie(conversations)


def test_a_conversation_with_a_third_of_all_turns(spark):
    # Thousands of turns over several sorted parts: the runs are carried on; five conversations share its head.
    rows = [(10, t, "user", f"turn {t % 7}") for t in range(1_200)] + [(c, t, "user", f"turn {t % 7}") for c in range(11, 15) for t in range(600)]
    df = chats(spark, rows).repartition(13)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        assert trie.ordered_turns(df, trie.BASES[0], "conv_id", "turn", "role", "text").where("conv = 10").select("run").distinct().count() > 1
        assert found_trie(df) == brute_trie(rows)
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def test_equal_products_of_different_turns_are_noticed(spark, conversations, monkeypatch):
    swapped = [(c, t, "user", "ab"[(c + t) % 2]) for c in (20_001, 20_002, 20_003, 20_004) for t in range(20)]
    df = chats(spark, conversations + swapped)
    monkeypatch.setattr(trie, "BASES", ((1, 1), trie.BASES[1]))  # R = 1: the order of the turns is lost
    assert found_trie(df) == brute_trie(conversations + swapped)
    monkeypatch.setattr(trie, "BASES", ((1, 1),))
    with pytest.raises(RuntimeError):
        trie.trie(df)


def test_no_conversations_no_nodes(spark):
    assert found_trie(chats(spark, [])) == [] == found_trie(chats(spark, [(None, 1, "user", "x")]))


def test_only_turnless_conversations(spark):
    # 102 lacks its base, and its own turns end before the cut.
    h = zlib.crc32(b"102") % 9
    rows = [(102, t, "user", "x") for t in range(h)] or [(102, None, None, None)]
    assert found_trie(chats(spark, rows)) == brute_trie(rows)
