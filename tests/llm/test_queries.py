"""The numbered queries against SQL where it can say what they do, and the contract of their columns."""

from __future__ import annotations

import hashlib
import importlib.util
import json
import re
from collections import defaultdict

import pytest
import xxhash

from compare import as_bag, spark_bag
from shoplens.llm.queries import ORACLES, QUERIES

PROMISED = {
    1: ["query_id", "rank", "vec_id", "score"],
    2: ["doc_id", "n_email", "n_ip", "n_card", "n_phone", "base_sha256", "spans"],
    3: ["doc_id", "fingerprint", "component_id"],
    4: ["doc_id", "held_out", "score", "predicted"],
    5: ["doc_id", "other_id"],
    6: ["doc_id", "license", "dice"],
    7: ["doc_id", "sample", "ids", "log_prob", "log_inclusion"],
    8: ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"],
    9: ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"],
    10: ["doc_id", "size", "source_size", "target", "taken"],
    11: ["doc_id", "n_shingles", "component_id", "kept"],
    12: ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"],
    13: ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"],
}


def one(number):
    return next(f for name, f in QUERIES.items() if name.startswith(f"op{number}_"))


@pytest.fixture(scope="module")
def documents(spark, testdata):
    return {r.doc_id: r for r in spark.read.parquet(f"{testdata}/sf0.001/documents.parquet").collect()}


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_matches_sql(spark, testdata, oracle, name):
    assert spark_bag(QUERIES[name](spark, f"{testdata}/sf0.01")) == as_bag(*oracle(ORACLES[name]))


@pytest.mark.parametrize("number", range(1, 14))
def test_promised_columns(spark, testdata, number):
    assert set(PROMISED[number]) <= set(one(number)(spark, f"{testdata}/sf0.001").columns)


def test_op2_base_spans(spark, testdata, documents):
    def luhn(digits):
        total = 0
        for i, c in enumerate(reversed(digits)):
            d = int(c) * (1 + i % 2)
            total += d - 9 * (d > 9)
        return total % 10 == 0

    def digits(m):
        return re.sub("[^0-9]", "", m)

    kinds = {
        "email": (r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", lambda m: True),
        "ip": (r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", lambda m: all(int(x) <= 255 for x in m.split("."))),
        "card": (r"[0-9]([\x20-]?[0-9])+", lambda m: 16 <= len(digits(m)) <= 19 and luhn(digits(m))),
        "phone": (r"\+[0-9][\x20().0-9-]+[0-9]", lambda m: 8 <= len(digits(m)) <= 15),
    }
    seen = 0
    for r in one(2)(spark, f"{testdata}/sf0.001").collect():
        found = {k: [m.span() for m in re.finditer(p, documents[r.doc_id].text) if ok(m[0])] for k, (p, ok) in kinds.items()}
        assert [r.n_email, r.n_ip, r.n_card, r.n_phone] == [len(v) for v in found.values()]
        listed = [f"{k}:{a}:{b}" for k, v in found.items() for a, b in v]
        assert r.base_sha256 == hashlib.sha256(",".join(listed).encode()).hexdigest()
        assert [s for s in r.spans.split(",") if s.split(":")[0] in kinds] == listed
        seen += len(listed)
    assert seen > 10


def test_op3_fingerprints_and_components(spark, testdata, documents):
    def plain(text):
        words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text))
        shingles = [" ".join(words[i : i + 3]) for i in range(len(words) - 2)] or ([" ".join(words)] if words else [])
        hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
        return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))

    rows = one(3)(spark, f"{testdata}/sf0.001").collect()
    prints = {r.doc_id: int(r.fingerprint, 16) for r in rows}
    assert prints == {d: plain(r.text) for d, r in documents.items()}
    least = {d: d for d in prints}
    changed = True
    while changed:
        changed = False
        for d, p in prints.items():
            low = min(least[e] for e, q in prints.items() if (p ^ q).bit_count() <= 2)
            changed |= low < least[d]
            least[d] = low
    assert {r.doc_id: r.component_id for r in rows} == least


def test_op4_learns_from_some_and_is_right_on_the_others(spark, testdata):
    labels = {r.doc_id: r.toxic for r in spark.read.parquet(f"{testdata}/sf0.1/labels.parquet").collect()}
    rows = one(4)(spark, f"{testdata}/sf0.1").collect()
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in rows) and len(rows) == 10_000
    tested = [r for r in rows if r.held_out and r.doc_id in labels]
    assert sum(r.predicted == labels[r.doc_id] for r in tested) / len(tested) > 0.93


def test_op8_base_columns(spark, testdata, documents):
    for r in one(8)(spark, f"{testdata}/sf0.001").collect():
        text = documents[r.doc_id].text
        words = re.findall(r"[^\x20\x09-\x0D]+", text)
        places = defaultdict(list)
        for i in range(len(words) - 4):
            places[tuple(words[i : i + 5])].append(i)
        repeated = {i + j for p in places.values() if len(p) > 1 for i in p for j in range(5)}
        lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
        failed = len(words) < 10 or 100 * len(repeated) > 20 * len(words)
        assert (r.n_words, r.word_chars, r.n_symbols) == (len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)))
        assert (r.n_dup_lines, r.n_repeat_words, r.base_failed) == (len(lines) - len(set(lines)), len(repeated), failed)
        assert not (failed and r.kept)


def test_op10_takes_near_the_target(spark, testdata):
    rows = one(10)(spark, f"{testdata}/sf0.1").collect()
    by_source = defaultdict(list)
    for r in rows:
        by_source[r.source].append(r)
    for own in by_source.values():
        assert sum(r["size"] for r in own) == own[0].source_size
        assert abs(sum(r.taken for r in own) - own[0].target) <= max(r["size"] for r in own)
    assert sum(r.taken for r in rows) <= sum(r["size"] for r in rows)
    assert all(r.taken in (0, r["size"], 2 * r["size"], 3 * r["size"]) for r in rows)
    assert sorted(rows) == sorted(one(10)(spark, f"{testdata}/sf0.1").collect())


def test_entry_registers_them(spark):
    import corpus_pipeline

    path = importlib.util.find_spec("corpus_pipeline").origin.replace("corpus_pipeline.py", "__spark_entry__.py")
    spec = importlib.util.spec_from_file_location("entry_module", path)
    module = importlib.util.module_from_spec(spec)
    spec.loader.exec_module(module)
    assert set(QUERIES) | {"pipeline"} <= set(module.queries()) and set(ORACLES) <= set(module.oracle_sql())
    assert len(corpus_pipeline.STAGES) == 5
    assert json.dumps(sorted(int(re.match(r"op(\d+)_", n)[1]) for n in QUERIES)) == json.dumps(list(range(1, 14)))
