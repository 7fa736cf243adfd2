"""Near copies go, but no text that is no copy, whatever keys the rows repeat."""

from __future__ import annotations

import random

from shoplens.llm import simhash

A, B = ("the quick brown fox jumps over the lazy dog tonight", "a wholly different line about rivers and stones in spring")


def kept(df):
    return sorted(((r[0], r[1]) for r in simhash.one_of_each(df).collect()), key=str)


def test_a_repeated_key_stands_for_each_of_its_texts(make):
    rows = [(1, A, "en", "a"), (5, A, "en", "a"), (5, B, "en", "a")]
    for order in (rows, rows[::-1], [rows[1], rows[2], rows[0]]):
        assert kept(make(order)) == sorted([(1, A), (5, B)], key=str)
    assert kept(make([(1, A, "en", "a"), (1, B, "en", "a"), (1, B, "de", "b"), (2, B, "en", "a")])) == sorted([(1, A), (1, B)], key=str)


def test_one_row_stays_of_each_component(make, odd):
    draw = random.Random(8)
    texts = [" ".join(f"w{draw.randrange(40)}" for _ in range(draw.randrange(0, 12))) for _ in range(60)]
    rows = odd + [(draw.randrange(100, 140), draw.choice(texts), "en", "a") for _ in range(200)]
    found = simhash.one_of_each(make(rows, clash=False)).collect()
    links = {t: simhash.fingerprint(t) for *_, t in ((r[1],) for r in rows)}
    root = {fp: fp for fp in links.values()}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a in root:
        for b in root:
            if (a ^ b).bit_count() <= 2:
                root[max(find(a), find(b))] = min(find(a), find(b))
    keyed = {}
    for key, text, *_ in rows:
        if key is not None:
            keyed.setdefault(find(links[text]), []).append(key)
    of_component = {}
    for r in found:
        if r.doc_id is not None:
            of_component.setdefault(find(links[r.text]), []).append(r.doc_id)
    assert of_component == {c: [min(keys)] for c, keys in keyed.items()}
