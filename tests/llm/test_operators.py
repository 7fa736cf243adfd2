"""Each operator on nulls, empty and long texts, ties, repeated rows, empty tables and clashing columns, and on planted cases."""

from __future__ import annotations

import math
import random
import re

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from shoplens.llm import chat, components, fertility, golay, licenses, mixing, passages, pii, segment, simhash, tables, topk, toxicity


@pytest.fixture(scope="module")
def words():
    draw = random.Random(5)
    return ["".join(draw.choices("abcdefghijklmnop", k=draw.randint(3, 9))) for _ in range(4000)]


def prose(words, n, seed):
    return " ".join(random.Random(seed).choices(words, k=n))


# 1 top-k


def plain_topk(vectors, k):
    rows = [(i, [math.floor(256 * float(np.float32(x))) for x in v]) for i, v in vectors if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    out = []
    for q, v in rows:
        if q % 50 == 0:
            scored = sorted((-sum(a * b for a, b in zip(v, w)), c) for c, w in rows if c != q)
            out += [(q, r + 1, c, -s) for r, (s, c) in enumerate(scored[:k])]
    return sorted(out)


@pytest.mark.parametrize("lists", [1, 2, 3])
def test_topk_equals_brute_force(spark, lists):
    draw = np.random.default_rng(lists)
    vectors = [(i, draw.normal(size=8).astype(np.float32).tolist()) for i in range(220)]
    vectors += [(1000 + i, vectors[50][1]) for i in range(40)]  # copies of a query, among them queries
    vectors += [(2000, None), (2050, [1.0, None] * 4), (2100, [math.inf] + [0.0] * 7), (2150, [math.nan] * 8), (None, [1.0] * 8), (2200, [])]
    df = spark.createDataFrame(vectors, "vec_id BIGINT, embedding ARRAY<FLOAT>").withColumn("row", F.lit(1)).withColumn("ID", F.lit(2))
    found = topk.search(df, F.col("id") % 50 == 0, k=5, lists=lists)
    assert sorted(map(tuple, found.collect())) == plain_topk(vectors, 5)


def test_topk_in_blocks_of_queries(spark, monkeypatch):
    monkeypatch.setattr(topk, "QUERY_BLOCK", 3)
    draw = np.random.default_rng(0)
    vectors = [(i * 50, draw.normal(size=4).astype(np.float32).tolist()) for i in range(10)]
    df = spark.createDataFrame(vectors, "vec_id BIGINT, embedding ARRAY<FLOAT>")
    assert sorted(map(tuple, topk.search(df, F.col("id") % 50 == 0, k=20).collect())) == plain_topk(vectors, 20)
    assert topk.search(df.where("false"), F.col("id") % 50 == 0).count() == 0
    assert topk.search(df, F.lit(False)).count() == 0


# 2 personal data


def test_checksums_confirm_and_context_scores():
    text = "My IBAN is DE89 3704 0044 0532 0130 00, not DE89 3704 0044 0532 0130 01. Card 4111 1111 1111 1111, 4111 1111 1111 1112."
    found = {(k, text[a:b]) for k, a, b, _ in pii.find(text)}
    assert found == {("iban", "DE89 3704 0044 0532 0130 00"), ("card", "4111 1111 1111 1111")}
    assert [s[0] for s in pii.find("social security number 123-45-6789")] == ["ssn"]
    assert pii.find("part no. 123-45-6789") == []
    assert pii.mask("call +1 (212) 555-0101 or mail a@b.co.") == "call [PHONE] or mail [EMAIL]."
    assert pii.mask("a@b.c x") == "[EMAIL] x" and pii.mask(None) is None and pii.mask("") == ""


def test_pii_is_linear_on_long_runs():
    for text in ("a" * 300_000, "1" * 300_000, "1." * 150_000, "+1" * 150_000, "@" * 300_000, "A" * 300_000 + "@b.c"):
        pii.find(text)


def test_long_secrets_are_masked_whole():
    for value in ("a1" * 500, "x" * 600 + "7" + "y" * 399):
        assert [s[:3] for s in pii.find(f"the token={value} ends")] == [("secret", 10, 1010)]
        assert pii.mask(f"the token={value} ends") == "the token=[SECRET] ends"


def test_masking_keeps_rows_and_columns(spark, make, odd):
    df = make([*odd, (9, "mail a@b.org now", "en", "a")], clash=False)
    out = pii.mask_texts(df)
    assert out.columns == df.columns and out.schema == df.schema and out.count() == df.count()
    row = out.where("doc_id = 9").first()
    assert row.text == "mail [EMAIL] now" and row.n_chars == len(row.text)
    assert make(odd).select(pii.spans(F.col("n_chars").cast("string")).alias("s")).count() == len(odd)
    assert pii.mask_texts(df.where("false")).count() == 0


# 3 near copies


def test_golay_words_within_two_bits_share_an_index():
    draw = np.random.default_rng(2)
    a = draw.integers(0, 1 << 23, 4000)
    b = a ^ (1 << draw.integers(0, 23, 4000)) ^ (1 << draw.integers(0, 23, 4000))
    (x, n), (y, m) = golay.indices(a), golay.indices(b)
    assert set(n) == {1, 6}
    assert all(set(p[:i]) & set(q[:j]) for p, i, q, j in zip(x.tolist(), n, y.tolist(), m))


@pytest.mark.parametrize("pairwise", [64, 2])
def test_links_are_those_of_all_pairs(spark, monkeypatch, pairwise):
    monkeypatch.setattr(simhash, "PAIRWISE", pairwise)
    draw = random.Random(pairwise)
    fps = {draw.getrandbits(64) for _ in range(150)}
    for f in list(fps)[:40]:
        for _ in range(5):
            f ^= 1 << draw.randrange(64)
            fps.add(f)
            f ^= 1 << draw.randrange(64)
            fps.add(f)
    signed = [int(np.uint64(f).astype(np.int64)) for f in fps]
    star = components.stars(simhash.links(spark.createDataFrame([(f,) for f in signed], "fp BIGINT")))
    root = {r.node: r.root for r in star.collect()}

    def expected():
        low = {f: f for f in signed}
        for _ in signed:
            new = {f: min(low[g] for g in signed if ((f ^ g) & (2**64 - 1)).bit_count() <= 2) for f in signed}
            if new == low:
                return low
            low = new

    assert {f: root.get(f, f) for f in signed} == expected()


def test_components_of_a_long_chain_and_of_no_edges(spark):
    chain = spark.range(400).selectExpr("id AS a", "id + 1 AS b")
    assert {r.root for r in components.stars(chain).collect()} == {0}
    assert components.stars(chain.where("false")).count() == 0


def test_simhash_on_odd_rows(spark, make, odd):
    rows = {(r.key, r.component) for r in simhash.components(make(odd)).collect()}
    assert (1, 1) in rows and (2, 1) in rows and (3, 1) in rows and (6, 5) in rows and (7, 7) in rows
    assert simhash.components(make(odd).where("false")).count() == 0
    kept = simhash.one_of_each(make(odd, clash=False))
    assert sorted(r.doc_id for r in kept.collect() if r.doc_id is not None) == [1, 4, 5, 7]
    assert kept.where("doc_id IS NULL").count() == 2 and kept.columns == make(odd, clash=False).columns


# 4 toxicity


def test_toxic_stems_are_known_in_new_words(spark, make, words):
    docs, labels = [], []
    for i in range(600):
        bad = i % 4 == 0
        text = prose(words, 40, i) + (f" zzvexq{'aeiou'[i % 5]}{words[i][:3]}" if bad else "")
        docs.append((i, text, "en", "a"))
        labels.append((i, int(bad), 1))
    table = spark.createDataFrame([*labels, (None, 1, 0), (5, None, 0), (7, 9, 0)], "doc_id BIGINT, toxic INT, quality INT")
    docs += [(20_000 + i, prose(words, 5, -i), "en", "a") for i in range(600)]  # whole slices without a label
    docs += [(None, None, None, None), (10_000, "", "en", "a"), (10_001, "zzvexqnew " + prose(words, 30, 1), "en", "a"), (10_002, "?!", "en", "b")]
    rows = {r.key: r.score for r in toxicity.score(make(docs), toxicity.fit(make(docs), table)).collect()}
    # A stem in a form never seen is far more suspect than a text without it; the words here are few and the texts small.
    assert rows[10_001] > 0.2 > 10 * rows[10_000] and rows[10_002] == rows[10_000]
    wrong = [i for i, bad, _ in labels if (rows[i] >= 0.5) != bool(bad)]
    assert len(wrong) <= 40
    clean = toxicity.clean(make(docs, clash=False), table)
    assert clean.columns == make(docs, clash=False).columns and 10_000 in {r.doc_id for r in clean.collect()}


def test_class_counts_are_not_cut(spark, make, words):
    docs = [(i, f"{prose(words, 30, i)} {'zvuqkorz' if i % 9 == 0 else ''}", "en", "a") for i in range(300)]
    labels = spark.createDataFrame([(i, int(i % 9 == 0)) for i in range(300)], "doc_id long, toxic int")
    cut, whole = (toxicity.fit(make(docs), labels, grams=g).model for g in (10, 10**6))
    for (a, _), (b, _) in zip(cut.classes, whole.classes):
        assert len(b.keys) > 1000 and np.array_equal(a.keys, b.keys)


def test_toxicity_does_not_depend_on_what_a_task_holds(spark, make, words):
    docs = [(i, f"{prose(words, 30, i)} {f'zvuqkorz{words[i][:2]}' if i % 9 == 0 else ''}", "en", "a") for i in range(300)]
    # Words that no labelled document has, in two documents, in one and more than once in a text.
    docs += [(1_000 + i, f"{words[i][::-1]}ük{i // 2} {words[i][::-1]}ük{i // 2} {prose(words, 4, i)} qx{i}", "en", "a") for i in range(300)]
    docs += [(2_000, None, "en", "a"), (2_001, "?!", "en", "a")]
    labels = spark.createDataFrame([(i, int(i % 9 == 0)) for i in range(300)], "doc_id long, toxic int")
    few, whole = (toxicity.fit(make(docs), labels, grams=g) for g in (10, 10**6))
    assert few.levels and not whole.levels and few.model.held is not None
    a, b = ({r.key: tuple(r)[1:] for r in toxicity.score(make(docs), s).collect()} for s in (few, whole))
    assert a.keys() == b.keys() and all(a[k] == pytest.approx(b[k], rel=1e-6) for k in a)
    kept = toxicity.score(make(docs, clash=False), few, keep=True)
    assert {r.doc_id: r.score for r in kept.collect()} == {k: pytest.approx(v[0], rel=1e-6) for k, v in b.items()}


def test_the_curve_sees_every_row(spark):
    rng = np.random.default_rng(3)
    toxic = np.arange(400) % 4 == 0
    found = rng.normal(size=(400, 10)) / 5 + toxic[:, None]
    rows = spark.createDataFrame([(int(t), f.tolist()) for t, f in zip(toxic, found)], "toxic long, found array<double>").repartition(5)
    for m, (beta, loss) in enumerate(toxicity.fit_curves(rows, 2)):
        x, y = toxicity._scaled(found[:, 5 * m : 5 * m + 5]), toxic.astype(float)
        weight = np.where(y == 1, np.sqrt(3), 1.0)
        p = toxicity._curve(x @ beta)
        slope = x.T @ (weight * (y - p)) - np.diag([1e-6, 1, 1, 1]) @ beta
        assert np.abs(slope).max() < 1e-6
        assert loss == pytest.approx(-(weight * np.log(np.where(y == 1, p, 1 - p))).sum() / weight.sum())


def test_toxicity_without_labels(spark, make, odd):
    none = spark.createDataFrame([], "doc_id BIGINT, toxic INT")
    assert {r.score for r in toxicity.score(make(odd), toxicity.fit(make(odd), none)).collect()} == {0.0}
    assert toxicity.score(make(odd).where("false"), toxicity.fit(make(odd), none)).count() == 0


def test_class_probabilities_sum_to_one():
    text = ["abc", "abd", "abca", "bcd"]
    grams, _ = toxicity._letters(text)
    keys, counts = np.unique(grams, return_counts=True)
    model = toxicity.Model(keys, counts.astype(float), counts.astype(float), counts.astype(float) + 1)
    stem = int(toxicity._letters(["abc"])[0][1]) >> toxicity.BITS  # after ^^^a
    letters = np.unique(keys & ((1 << toxicity.BITS) - 1))
    chances = np.exp([0.0]) * 0
    for table in model.classes:
        p = model._back(stem << toxicity.BITS | letters, toxicity.ORDER, *table, lambda low: model._shared(low, toxicity.ORDER - 1))
        chances = np.append(chances, p.sum())
    assert all(0.9 < c <= 1.0 for c in chances[1:])  # the rest is for letters never seen


# 5 passages


def test_planted_passages_are_found_and_clean_documents_left(spark, make, words):
    exact, fuzzy = prose(words, 60, "p"), prose(words, 120, "q").split()
    edited = [w if i % 15 else "changed" for i, w in enumerate(fuzzy)]
    del edited[40]
    docs = [(i, prose(words, 300, i), "en", "a") for i in range(40)]
    docs += [(100 + i, f"{prose(words, 50 + i, f'a{i}')} {exact} {prose(words, 80, f'b{i}')}", "en", "a") for i in range(12)]
    docs += [(200, f"{prose(words, 90, 'x')} {' '.join(fuzzy)} {prose(words, 20, 'y')}", "en", "a"), (201, f"{' '.join(edited)} {prose(words, 99, 'z')}", "en", "a")]
    docs += [(300, docs[0][1], "en", "a"), (None, exact, "en", "a"), (301, None, None, None), (302, "", None, None)]
    found = passages.passages(make(docs)).collect()
    pairs = {(r.a, r.b) for r in found}
    assert (0, 300) in pairs and (200, 201) in pairs
    assert {d for p in pairs for d in p} == {0, 300, 200, 201, *range(100, 112)}
    linked = {100}
    for _ in range(12):
        linked |= {d for p in pairs if linked & set(p) for d in p}
    assert set(range(100, 112)) <= linked
    row = next(r for r in found if (r.a, r.b) == (200, 201))
    assert abs(row.a_start - 90) <= 2 and abs(row.a_end - 210) <= 2 and row.b_start <= 2 and row.similarity >= 0.85
    assert all(r.b_end - r.b_start == 60 for r in found if r.a == 100 and r.b == 101)


def test_frequent_passages_are_linked_past_documents_with_a_part(spark, make, words):
    exact = prose(words, 60, "p").split()
    docs = [(100 + i, f"{prose(words, 70, f'a{i}')} {' '.join(exact)} {prose(words, 70, f'b{i}')}", "en", "a") for i in range(20)]
    docs += [(i, f"{prose(words, 90, i)} {' '.join(exact[:45])} {prose(words, 90, f'c{i}')}", "en", "a") for i in (1, 999)]
    found = passages.passages(make(docs)).collect()
    assert {d for r in found for d in (r.a, r.b)} == set(range(100, 120))
    assert {r.b for r in found if r.a == 100} == set(range(101, 120))


def test_edited_copies_whose_seeds_are_all_frequent_are_linked(spark, make, words):
    text = prose(words, 56, "p").split()
    docs = []
    for i, at in enumerate(((2, 27, 52), (5, 30, 49), (2, 30, 52), (5, 27, 49))):
        edited = " ".join(f"changed{i}" if j in at else w for j, w in enumerate(text))
        docs.append((500 + i, f"{prose(words, 70, f'a{i}')} {edited} {prose(words, 70, f'b{i}')}", "en", "a"))
    # Parts of the passage, too short to be one, make its seeds frequent; they are in the first and the last documents.
    for i, at in enumerate((0, 14, 28) * 20):
        docs.append((i if i % 2 else 900 + i, f"{prose(words, 60, f'c{i}')} {' '.join(text[at : at + 28])} {prose(words, 60, f'd{i}')}", "en", "a"))
    pairs = {(r.a, r.b) for r in passages.passages(make(docs)).collect()}
    assert {d for p in pairs for d in p} == set(range(500, 504))
    linked = {500}
    for _ in range(4):
        linked |= {d for p in pairs if linked & set(p) for d in p}
    assert linked == set(range(500, 504))


def test_blocks_of_a_frequent_seed_lose_no_link(spark, make, words, monkeypatch):
    monkeypatch.setattr(passages, "BLOCK", 3)
    test_edited_copies_whose_seeds_are_all_frequent_are_linked(spark, make, words)


def test_lines_too_short_for_a_passage_are_not_aligned(words, monkeypatch):
    """Places of two seeds with a common line of 40 words, and two of either whose line goes on, edited, to 70 words."""
    lines = [prose(words, 70, f"p{seed}").split() for seed in range(2)]
    rows = []
    for seed, line in enumerate(lines):
        for i in range(60):
            inner = line[:40] + [w if j % 9 else f"changed{seed}" for j, w in enumerate(line[40:])] * (i < 2)
            text = " ".join([prose(words, 60, f"a{seed}-{i}"), *inner, prose(words, 60, f"b{seed}-{i}")])
            said = (passages.word_hashes(text) >> np.uint64(32)).astype(np.uint32).view(np.int32)[: 60 + 15 + 5 + 80]
            rows.append({"seed": seed, "key": 100 * seed + i, "at": 75, "begin": 0, "words": said, "part": None, "own": 0, "x": 0, "y": 0})
    kinds = [(c, pa.int64() if c in ("seed", "key", "part") else pa.list_(pa.int32()) if c == "words" else pa.int32()) for c in rows[0]]
    jobs, aligned = [], passages.stretches
    monkeypatch.setattr(passages, "stretches", lambda some: jobs.append(len(some)) or aligned(some))
    found = passages._compared(pa.Table.from_pylist(rows, schema=pa.schema(kinds)))
    assert set(zip(found["a"].to_pylist(), found["b"].to_pylist())) == {(0, 1), (100, 101)}
    assert sum(jobs) < 600 and len(jobs) < 40


def test_words_are_stored_only_around_places_that_may_be_connected(spark, make, words, monkeypatch):
    """A line of 25 words that 60 documents have, two of which go on, edited, to 70 words; the words of no others are stored."""
    line = prose(words, 70, "p").split()
    docs = []
    for i in range(60):
        inner = line[:25] + [w if j % 9 else "changed" for j, w in enumerate(line[25:])] * (i in (20, 30))
        docs.append((i, " ".join([prose(words, 60, f"a{i}"), *inner, prose(words, 60, f"b{i}")]), "en", "a"))
    stored, materialize = {}, passages.materialize

    def kept(df, label):
        out = materialize(df, label)
        if "words" in out.columns and dict(out.dtypes)["words"] == "array<int>":
            stored[label] = {r.key for r in out.select("key").collect()}
        return out

    monkeypatch.setattr(passages, "materialize", kept)
    assert {(r.a, r.b) for r in passages.passages(make(docs)).collect()} == {(20, 30)}
    assert set(stored) == {"around-places"} and {20, 30} <= stored["around-places"] and len(stored["around-places"]) <= 6


def test_a_byte_of_each_word_loses_no_place_that_words_connect(words):
    """Edited copies of one text around a seed's places, amid others: all that ``_compared`` connects are kept, block by block."""
    text, rows = prose(words, 120, "p").split(), []
    for i in range(90):
        inner = [w if 58 <= j < 63 or (j * 7 + i) % 13 > i % 5 else f"changed{i}" for j, w in enumerate(text)] if i % 3 else prose(words, 120, i).split()
        said = (passages.word_hashes(" ".join(inner)) >> np.uint64(32)).astype(np.uint32).view(np.int32)
        rows.append({"seed": 1, "key": i, "at": 58, "begin": 0, "words": said, "part": i % 2 if i % 7 == 0 else None, "own": i % 2, "x": 0, "y": 1})
    kinds = [(c, pa.int64() if c in ("seed", "key", "part") else pa.list_(pa.int32()) if c == "words" else pa.int32()) for c in rows[0]]
    found = passages._compared(pa.Table.from_pylist(rows, schema=pa.schema(kinds)))
    short = [
        {"seed": 1, "said": r["key"], "place": 58, "words": (r["words"].view(np.uint32) >> 24).astype(np.uint8).tobytes(), "settled": r["part"] is not None}
        | {"least": r["key"], "most": r["key"], "own": r["own"], "x": 0, "y": 1}
        for r in rows
    ]
    kept = set(passages._hopeful(pa.Table.from_pylist(short))["said"].to_pylist())
    assert len(found) > 20 and set(found["a"].to_pylist() + found["b"].to_pylist()) <= kept
    assert not kept & set(range(0, 90, 3))


def test_texts_taken_for_copies_by_the_bitmap_are_compared(spark, make, words, monkeypatch):
    monkeypatch.setattr(tables, "FILTER_BITS", 64)
    test_planted_passages_are_found_and_clean_documents_left(spark, make, words)


def test_every_occurrence_of_a_passage_has_its_span(spark, make, words):
    def times(n, gap, name):
        return " ".join(f"{prose(words, gap, f'{name}{i}')} {prose(words, 60, 'p')}" for i in range(n))

    docs = [(1, times(5, 90, "a"), "en", "a"), (2, times(1, 30, "b"), "en", "a"), (3, times(4, 20, "c"), "en", "a")]
    phrases = [" ".join(prose(words, 60, "q").split()[i : i + 10]) for i in range(0, 60, 10)]
    for d in (4, 5):  # the phrases of a passage also stand alone before and behind it
        alone = [" ".join(f"{prose(words, 60, f'{d}{side}{i}')} {x}" for i, x in enumerate(phrases)) for side in "xy"]
        docs.append((d, f"{alone[0]} {prose(words, 70, f'm{d}')} {' '.join(phrases)} {prose(words, 70, f'n{d}')} {alone[1]}", "en", "a"))
    found = passages.by_document(passages.passages(make(docs))).collect()
    for key, starts in ((1, [90 + 150 * i for i in range(5)]), (2, [30]), (3, [20 + 80 * i for i in range(4)]), (4, [490]), (5, [490])):
        assert sorted({min(starts, key=lambda s: abs(s - r.start)) for r in found if r.key == key and r.end - r.start < 75}) == starts


def test_near_passages_with_many_edits_are_found(spark, make, words):
    def edited(text, n, seed):
        at = set(random.Random(seed).sample(range(70), n))
        return " ".join("changed%s" % i if i in at else w for i, w in enumerate(text.split()))

    docs = []
    for i in range(100):
        text = prose(words, 70, f"p{i}")
        docs += [(2 * i, f"{prose(words, 60, f'a{i}')} {text} {prose(words, 60, f'b{i}')}", "en", "a")]
        docs += [(2 * i + 1, f"{prose(words, 30, f'c{i}')} {edited(text, 10, i)} {prose(words, 90, f'd{i}')}", "en", "a")]
    found = {(r.a, r.b) for r in passages.passages(make(docs)).collect()}
    assert found <= {(2 * i, 2 * i + 1) for i in range(100)} and len(found) >= 90


def test_passages_on_odd_rows(spark, make, odd):
    assert passages.passages(make(odd)).count() == 0
    assert passages.passages(make(odd).where("false")).count() == 0


def test_chains_are_the_best_collinear_ones():
    draw = np.random.default_rng(3)
    for _ in range(30):
        pairs = np.unique(draw.integers(0, 40, (25, 2)), axis=0)
        a, b = pairs.T
        score = np.zeros(len(a))
        for i in range(len(a)):
            before = [score[j] - passages.SKIP_COST * (a[i] + b[i] - a[j] - b[j]) for j in range(i) if a[j] < a[i] and b[j] < b[i]]
            score[i] = passages.K + max([0.0, *before])
        best = passages.chains(a, b)[0]
        steps = np.diff(a[best]) + np.diff(b[best])
        assert len(best) * passages.K - passages.SKIP_COST * steps.sum() == pytest.approx(score.max())


# 6 licences


def test_notices_are_found_whatever_their_layout(spark, make):
    mit = licenses.TEMPLATES["MIT grant"]
    docs = [
        (1, "Some prose.\nReleased under the MIT license!\nMore.", "en", "a"), (2, "first\n\n" + mit + "\n\nlast words here", "en", "a"),
        (3, "nothing of the kind is said in this text", "en", "a"), (4, "LICENSED under the Apache   License; version 2.0", "en", "a"),
    ]
    found = {(r.key, r.unit, r.license) for r in licenses.scan(make(docs)).collect()}
    assert found == {(1, "line", "MIT"), (2, "paragraph", "MIT grant"), (2, "text", "MIT grant"), (4, "line", "Apache-2.0")}


def test_licences_on_odd_rows(spark, make, odd):
    rows = [*odd, (11, "Released under the MIT License.", "en", "a"), (11, "Released under the MIT License.", "en", "a")]
    assert [r.key for r in licenses.scan(make(rows)).collect()] == [11, 11]
    assert licenses.scan(make(odd).where("false")).count() == 0
    assert licenses.scan(make(odd), templates={}).count() == 0


# 7 segmentations


@pytest.fixture(scope="module")
def vocabulary():
    return segment.Vocabulary(fertility.read_vocabulary(fertility.VOCABULARY))


def every_path(word, vocabulary):
    lattice = segment.Lattice(pa.array([word], type=pa.large_binary()), vocabulary)

    def go(node, ids, logp):
        if node == lattice.end[0]:
            yield tuple(ids), logp
            return
        for arc in range(lattice.first[node], lattice.first[node + 1]):
            yield from go(lattice.to[arc], [*ids, int(lattice.piece[arc])], logp + lattice.logp[arc])

    return dict(go(0, [], 0.0))


def test_samples_follow_the_lattice_without_replacement(vocabulary):
    paths = every_path(" then", vocabulary)
    assert sum(math.exp(p) for p in paths.values()) == pytest.approx(1)
    n = 8000
    drawn = segment.sample_chunk(["then"] * n, list(range(n)), vocabulary, 2, 0)
    for ids, logp in paths.items():
        first = math.exp(logp)
        second = sum(math.exp(p) * first / (1 - math.exp(p)) for q, p in paths.items() if q != ids)
        for place, chance in ((0, first), (1, second)):
            share = sum(tuple(d[place][0].tolist()) == ids for d in drawn) / n
            assert abs(share - chance) < 5 * math.sqrt(chance * (1 - chance) / n) + 1e-3
    # Weighted by their inclusion scores the samples count every path once in the mean.
    assert np.mean([sum(math.exp(s[1] - s[3]) for s in d) for d in drawn]) == pytest.approx(1, abs=0.05)


def test_few_segmentations_are_all_returned(vocabulary):
    paths = every_path(" then", vocabulary)
    for drawn in segment.sample_chunk(["then"] * 20, list(range(20)), vocabulary, len(paths) + 5, 0):
        assert {tuple(s[0].tolist()) for s in drawn} == set(paths) and {s[3] for s in drawn} == {0.0}
        values = [s[2] for s in drawn]
        assert values == sorted(values, reverse=True)


def test_round_trip_of_odd_texts(spark, make, odd, vocabulary):
    texts = ["▁x  y\n\n z</s><0x41>漢字😀\r\n", " ", "\n", "a" * 5000, "\u0000 é", *(r[1] for r in odd)]
    df = make([(i, x, None, None) for i, x in enumerate(texts)])
    rows = segment.sampled(df, samples=3).collect()
    for r in rows:
        assert segment.decode(r.ids, vocabulary) == (texts[r.key] or "")
    assert all(r.decoded == (texts[r.key] or "") for r in segment.sampled(df, samples=3, decoded=True).collect())
    for i, x in enumerate(texts):
        own = [tuple(r.ids) for r in rows if r.key == i]
        assert len(own) == len(set(own)) >= 1
    again = segment.sampled(df.repartition(7), samples=3).collect()
    assert sorted(rows) == sorted(again)
    assert segment.sampled(df.where("false")).count() == 0


def test_decoding_columns(spark, make):
    df = segment.sampled(make([(1, "some text", None, None)]), samples=1)
    assert df.select(segment.decoder(spark)("ids").alias("t")).first().t == "some text"


def test_lists_decode_as_single_ones_do(vocabulary):
    texts = ["some text", "", "é漢😀", None, "\n ", "x" * 300]
    ids = [None if x is None else segment.sample_chunk([x], [0], vocabulary, 1, 0)[0][0][0].tolist() for x in texts]
    lists = pa.array([[1, 2], *ids], type=pa.list_(pa.int32()))[1:]
    assert segment.decode_lists(lists, vocabulary).to_pylist() == texts
    assert segment.decode_lists(lists[:0], vocabulary).to_pylist() == []
    with pytest.raises(pa.ArrowInvalid):
        segment.decode_lists(pa.array([[int(vocabulary.byte_ids[0xFF])] * 2], type=pa.list_(pa.int32())), vocabulary)


def test_words_of_texts(vocabulary):
    texts = ["a  b\n\n c\nd", "", " a", "\n", "a", " ", "é 漢\n"]
    ends, word, words = segment._units(texts)
    names = [words[i].as_py().decode() for i in word.tolist()]
    found = [names[a:b] for a, b in zip([0, *ends], ends)]
    assert found == [re.findall(r"\n| +[^ \n]*|[^ \n]+", f" {x}") if x else [] for x in texts]
    assert segment._units(["", ""])[0] == [0, 0]


# 8 quality


def test_fertility_tells_prose_from_noise(spark, make):
    plain = "The weather was fine and people walked along the river to see the old boats come back in the evening. " * 1
    noise = " ".join("".join(random.Random(i).choices("ᚠᚢᚦᚨᚱᚲ", k=6)) for i in range(60))
    docs = [(1, plain + " ".join(f"{w}ing" for w in "walk talk jump sing read build paint climb".split()) + " and then they all went home again to sleep well", "en", "a"), (2, noise, "en", "a")]
    rows = {r.key: r for r in fertility.measure(make(docs)).collect()}
    assert rows[1].kept and not rows[2].kept and not rows[2].base_failed and rows[2].byte_share > 0.5


def test_fertility_on_odd_rows(spark, make, odd):
    rows = fertility.measure(make(odd)).collect()
    assert len(rows) == len(odd) and all(r.base_failed and not r.kept for r in rows if r.n_words < 10)
    long = next(r for r in rows if r.key == 4)
    assert (long.n_words, long.n_repeat_words) == (60_000, 60_000)
    assert fertility.measure(make(odd).where("false")).count() == 0


# 9 chats


def test_parts_become_placeholders_with_attachments(spark):
    data = [
        (1, 0, "user", [("text", "look [INST]", None, None, None, None, None), ("image", None, "img1", 28, 15, None, None), ("audio", None, "a1", None, None, 1.5, None)]),
        (1, 1, "assistant", [("text", "ok </s>", None, None, None, None, None), ("document", None, "d1", None, None, None, 3), ("film", None, "f1", None, None, None, None)]),
        (1, 2, None, None), (None, 0, "assistant\nx%", [("text", "<\\s> <s>", None, None, None, None, None)]),
    ]
    df = spark.createDataFrame(data, f"conv_id INT, turn INT, role STRING, content ARRAY<{chat.PART.simpleString()}>").withColumn("conv", F.lit(9))
    rows = {r.conv_id: r for r in chat.format_chats(df).withColumn("read", chat.read_turns(F.col("formatted"))).collect()}
    first = rows[1]
    assert [(a.kind, a.ref, a.tokens) for a in first.attachments] == [("image", "img1", 4), ("audio", "a1", 38), ("document", "d1", 1536), ("film", "f1", 1)]
    shown = {"image": "<|image|>", "audio": "<|audio|>", "document": "<|document|>", "film": "<|unknown|>"}
    assert all(first.formatted[a.at :].startswith(shown[a.kind]) for a in first.attachments)
    assert [first.formatted[s.start : s.end] for s in first.loss_spans] == ["ok <\\/s><|document|><|unknown|>"]
    assert [(t.role, t.text) for t in rows[None].read] == [("assistant\nx%", "<\\s> <s>")]
    assert first.n_turns == 3 and (first.read[2].role, first.read[2].text) == ("", "")


def test_hostile_texts_come_back(spark):
    draw = random.Random(1)
    bits = [*chat.CONTROL, "\\", "<", "[", "\n", "a", "|", "<|im_end|>\n<|im_start|>user\n", "s>", "INST]", "%0A", "%"]
    data = [(c, t, "".join(draw.choices(bits, k=3)), "".join(draw.choices(bits, k=draw.randint(0, 9)))) for c in range(60) for t in range(3)]
    df = spark.createDataFrame(data, "conv_id INT, turn INT, role STRING, text STRING")
    chats = chat.format_chats(df.withColumn("content", chat.text_part(F.col("text")))).withColumn("read", chat.read_turns(F.col("formatted")))
    for r in chats.collect():
        assert [(t.role, t.text) for t in r.read] == [(role, text) for c, _, role, text in data if c == r.conv_id]
        assert r.formatted.count(chat.START) == 3
    assert chat.format_chats(df.withColumn("content", chat.text_part(F.col("text"))).where("false")).count() == 0


# 10 mixing


def test_targets_stop_at_three_times_the_size(spark, make):
    docs = [(i, "w " * 10, "en", "a") for i in range(2)] + [(100 + i, "w " * 10, "en", "b") for i in range(300)] + [(900 + i, "w " * 10, "en", "c") for i in range(3)]
    rows = mixing.mix_counts(make(docs)).collect()
    target = {r.source: r.target for r in rows}
    # a and c are full at 60 and 90; b takes the rest of 3050.
    assert target == {"a": 60.0, "b": 2900.0, "c": 90.0}
    taken = {s: sum(r.taken for r in rows if r.source == s) for s in target}
    assert taken == {"a": 60, "b": 2900, "c": 90}


def test_buckets_do_not_change_the_mix(spark, make, monkeypatch):
    draw = random.Random(8)
    docs = [(i, "w " * draw.randint(0, 40), "en", draw.choice(["a", "a", "a", "b", None])) for i in range(400)]
    docs += docs[:30]
    whole = sorted(map(str, mixing.mix_counts(make(docs)).collect()))
    monkeypatch.setattr(mixing, "BUCKET_ROWS", 7)
    assert sorted(map(str, mixing.mix_counts(make(docs)).collect())) == whole
    mixed = mixing.mixed(make(docs, clash=False))
    assert mixed.columns == make(docs, clash=False).columns
    sent = sum(len((r.text or "").split()) for r in mixed.collect())
    assert sent == sum(r.taken for r in mixing.mix_counts(make(docs)).collect())


def test_mixing_odd_rows(spark, make, odd):
    rows = mixing.mix_counts(make(odd)).collect()
    assert len(rows) == len(odd) and all(r.taken == 0 for r in rows if r["size"] == 0)
    assert mixing.mix_counts(make(odd).where("false")).count() == 0
    assert mixing.mixed(make([(1, "", "en", "a"), (2, None, None, None)])).count() == 0
