"""Benchmark decontamination and its index against plain scans."""

from __future__ import annotations

import hashlib
import random
import re

import numpy as np
import pytest

from shoplake.llm import decontamination, fm_index
from shoplake.llm.queries import QUERIES

WORD = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
DOCS = "doc_id long, text string, n_words long, row string, removed int, items string"
ITEMS = "item_id long, text string, item string, piece int"


def split(text):
    return WORD.findall((text or "").translate(LOWER))


def plain(docs, items, width=10):
    """(doc_id, n_words, set of hit words, ids) of each (doc_id, text)."""
    windows = {}
    for name, text in items:
        words = split(text)
        for i in range(max(len(words) - width + 1, 1) if words else 0):
            windows.setdefault(tuple(words[i : i + width]), set()).add(name)
    for name, text in docs:
        words, hit, ids = split(text), set(), set()
        for size in {len(w) for w in windows}:
            for i in range(len(words) - size + 1):
                found = windows.get(tuple(words[i : i + size]))
                if found:
                    hit |= set(range(i, i + size))
                    ids |= found - {None}
        yield name, len(words), hit, sorted(map(str, ids))


def key(row):
    return [(v is not None, v) for v in row]


def check(spark, docs, items, **options):
    made = decontamination.decontaminate(
        spark.createDataFrame([(*d, 1, "r", 2, "i") for d in docs], DOCS).repartition(3),
        spark.createDataFrame([(*i, "x", 3) for i in items], ITEMS),
        **options,
    ).collect()
    text_of = {}
    for name, text in docs:
        text_of.setdefault(name, set()).add(text)
    got = []
    for r in made:
        hit = [k for s in r.removed for k in range(s.first, s.stop)]
        assert len(hit) == len(set(hit)) == r.n_hit
        assert all(a.stop < b.first for a, b in zip(r.removed, r.removed[1:]))
        if len(text_of[r.doc_id]) == 1:
            raw = (next(iter(text_of[r.doc_id])) or "").encode()
            for s in r.removed:
                assert split(raw[s.start : s.end].decode()) == split(raw.decode())[s.first : s.stop]
        got.append((r.doc_id, r.n_words, tuple(sorted(hit)), tuple(sorted(r["items"]))))
    want = [(d, n, tuple(sorted(h)), tuple(i)) for d, n, h, i in plain(docs, items, options.get("width", 10))]
    assert sorted(got, key=key) == sorted(want, key=key)
    return got


PASSAGE = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu"
ODD_ITEMS = [(1, PASSAGE), (10, PASSAGE.upper()), (2, "Short item"), (3, None), (4, ""), (5, " ,;"), (None, "nameless thing here"), (7, "É é"), (2, "short ITEM")]
ODD_DOCS = [
    (1, f"Before. {PASSAGE}! After"),
    (1, f"Before. {PASSAGE}! After"),
    (2, None),
    (3, ""),
    (4, "..."),
    (None, "a short... item, a NAMELESS thing-here"),
    (5, "alpha beta gamma delta epsilon zeta eta theta iota"),
    (6, "x " * 200_000 + PASSAGE.replace(" ", "\n") + " \u0000 y" * 70_000),
    (7, "É é É é"),
    (8, "short"),
    (9, "item short item short item"),
    (-1, "ünïcode 日本 short item 日本"),
]


@pytest.mark.parametrize("options", [{}, {"block_bytes": 30, "piece_words": 11}, {"width": 1}, {"width": 3, "block_bytes": 1}])
def test_odd_rows(spark, options):
    got = check(spark, ODD_DOCS, ODD_ITEMS, **options)
    assert sum(bool(hit) for _, _, hit, _ in got) >= 7


@pytest.mark.parametrize("block_bytes", [1 << 20, 60])
def test_few_words_make_many_overlapping_windows(spark, block_bytes):
    rng = random.Random(3)

    def text(n):
        return " ".join(rng.choice("abc") for _ in range(n))

    docs = [(i, text(rng.randrange(60))) for i in range(60)]
    items = [(i % 9, text(rng.randrange(1, 9))) for i in range(12)]
    check(spark, docs, items, width=4, block_bytes=block_bytes)


def test_no_items_and_no_documents(spark):
    got = check(spark, [(1, "a b"), (2, None)], [])
    assert [n for _, n, _, _ in sorted(got)] == [2, 0]
    check(spark, [], [(1, "a")])


def test_query_over_the_sample_tables(spark):
    sf_dir = "/root/testdata/sf0.01"
    tables = [spark.read.parquet(f"{sf_dir}/{t}.parquet").collect() for t in ("documents", "benchmark")]
    want = [
        (d, n, len(h), len(i), hashlib.sha256(",".join(i).encode()).hexdigest(), bool(h))
        for d, n, h, i in plain([(r.doc_id, r.text) for r in tables[0]], [(r.item_id, r.text) for r in tables[1]])
    ]
    got = [tuple(r) for r in QUERIES["op11_decontamination"](spark, sf_dir).collect()]
    assert sorted(got) == sorted(want) and sum(r[-1] for r in got) > 5


@pytest.mark.parametrize("seed", range(6))
def test_index_finds_what_a_scan_finds(seed):
    rng = np.random.default_rng(seed)
    letters = int(rng.integers(1, 6))
    runs = [rng.integers(1, letters + 1, size=rng.integers(1, 90)) for _ in range(rng.integers(1, 30))]
    runs += runs[:5]
    symbols = np.concatenate([np.append(r, 0) for r in runs]).astype(np.int64)
    order = fm_index.suffix_order(symbols)
    # Ends of runs stand for numbers below all symbols, the earlier the less.
    ends = np.cumsum(symbols == 0)
    as_text = [(1, int(s)) if s else (0, int(e)) for s, e in zip(symbols, ends)]
    assert order.tolist() == sorted(range(len(symbols)), key=lambda i: as_text[i:])
    index = fm_index.FmIndex(symbols, letters)
    phrases = [rng.integers(1, letters + 1, size=rng.integers(1, 12)) for _ in range(50)] + [runs[0][:10]]
    flat, lengths = np.concatenate(phrases).astype(np.int64), np.array([len(p) for p in phrases])
    low, high = index.search(flat, np.cumsum(lengths) - lengths, lengths)
    for phrase, a, b in zip(phrases, low, high):
        plain_ = [i for i in range(len(symbols)) if symbols[i : i + len(phrase)].tolist() == phrase.tolist()]
        assert sorted(index.locate(np.arange(a, b)).tolist()) == plain_


def test_wavelet_counts_every_symbol():
    rng = np.random.default_rng(0)
    values = rng.integers(0, 37, size=1_000)
    wavelet = fm_index.Wavelet(values, 37)
    at = rng.integers(0, 1_001, size=300)
    symbols = rng.integers(0, 37, size=300)
    assert wavelet.rank(symbols, at).tolist() == [int((values[:i] == s).sum()) for s, i in zip(symbols, at)]
    found, before = wavelet.symbol_and_rank(np.arange(1_000))
    assert found.tolist() == values.tolist()
    assert before.tolist() == [int((values[:i] == values[i]).sum()) for i in range(1_000)]
