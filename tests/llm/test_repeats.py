"""Removal of repeated byte strings against every window of every document."""

import collections
import random

import numpy as np
import pytest

from salesmart.llm import repeats, suffix_sort
from salesmart.llm.common import table

SCHEMA = "doc_id long, text string, lang string, block long, body string, size int, kind int"


def _text(seed, n, words=None):
    r = random.Random(seed)
    return " ".join(r.choice(words or ["alpha", "beta", "gämma", "日本", "x1", "the", "of"]) + str(r.randrange(900)) for _ in range(n))


@pytest.fixture(scope="module")
def docs(spark):
    a, b, quote = _text(1, 200), _text(2, 90), "A passage that a good many of these documents quote, word by word, é."
    texts = [(0, a), (1, a), (2, a.replace("beta", "bexa", 2)), (3, None), (4, ""), (5, "x" * 49), (5, "x" * 50), (6, "x" * 200), (6, "x" * 200),
             (7, b[:49]), (8, b[:50]), (9, b), (None, b + "!"), (None, b), (None, None), (2**63 - 1, b), (-3, b[10:70]),
             (10, "-" * 3000), (11, "=" * 10 + "-" * 77 + "=" * 60), (12, "ab" * 500), (13, "ba" * 60), (14, a[100:600] + a[300:900]),
             (15, _text(15, 9000)), (16, _text(15, 9000)[5000:20000])]
    texts += [(100 + i, _text(100 + i, i % 9) + quote + _text(200 + i, i % 7)) for i in range(120)]
    texts += [(300 + i, _text(300, 40)[:100 + 3 * i]) for i in range(30)]
    random.Random(3).shuffle(texts)
    return spark.createDataFrame([(d, t, None, 1, "s", 2, 3) for d, t in texts], SCHEMA).repartition(5).cache()


def _plain(rows, length=50):
    """All windows in one dictionary."""
    rows = [(d, (t or "").encode()) for d, t in rows]
    number = lambda d: 2**63 - 1 if d is None else d
    first = {}
    for d, raw in rows:
        for i in range(len(raw) - length + 1):
            w = raw[i:i + length]
            first[w] = min(first.get(w, number(d)), number(d))
    out = collections.Counter()
    for d, raw in rows:
        gone = np.zeros(len(raw) + 2, bool)
        for i in range(len(raw) - length + 1):
            if first[raw[i:i + length]] < number(d):
                gone[i + 1:i + 1 + length] = True
        starts, stops = np.flatnonzero(~gone[:-1] & gone[1:]), np.flatnonzero(gone[:-1] & ~gone[1:])
        spans = tuple(zip(starts.tolist(), stops.tolist()))
        out[d, len(raw), int(gone.sum()), spans, bytes(x for x, g in zip(raw, gone[1:]) if not g)] += 1
    return out


def _found(df):
    return collections.Counter((r.doc_id, r.n_bytes, r.n_removed, tuple(tuple(s) for s in r.spans), bytes(r.kept)) for r in df.collect())


@pytest.fixture(scope="module")
def wanted(docs):
    return _plain([(r.doc_id, r.text) for r in docs.collect()])


@pytest.mark.parametrize("options", [{}, {"block_bytes": 3000, "bucket_bytes": 9000}, {"block_bytes": 2000, "bucket_bytes": 20_000, "hot": 3},
                                     {"block_bytes": 5000, "bits": 6, "anchor": 8}, {"block_bytes": 1, "bucket_bytes": 4000, "hot": 1, "bits": 3}])
def test_every_window(docs, wanted, options):
    """Many blocks and buckets, hot anchors, and hashes so short that they collide all the time."""
    assert _found(repeats.remove_repeats(docs, **options)) == wanted


def test_no_rows_and_nothing_long_enough(spark, docs):
    assert _found(repeats.remove_repeats(docs.limit(0))) == {}
    short = docs.where("length(text) < 50 or text is null")
    assert _found(repeats.remove_repeats(short)) == _plain([(r.doc_id, r.text) for r in short.collect()])


def test_given_documents(spark, data_dir):
    given = table(spark, data_dir, "documents")
    assert _found(repeats.remove_repeats(given, block_bytes=60_000, bucket_bytes=200_000)) == _plain([(r.doc_id, r.text) for r in given.collect()])


def test_no_table_stays_in_the_catalog(spark, docs):
    before = {t.name for t in spark.catalog.listTables()}
    repeats.remove_repeats(docs.limit(3)).collect()
    assert {t.name for t in spark.catalog.listTables()} == before


@pytest.mark.parametrize("bits", [64, 5, 1])
def test_suffix_sort(bits):
    r = random.Random(bits)
    for letters, n in (("ab", 400), ("a", 200), ("abcdefgh", 3000)):
        raw = np.frombuffer("".join(r.choice(letters) for _ in range(n)).encode(), np.uint8)
        at = np.arange(n - 30)
        group = np.sort(np.array([r.choice([0, 1, 1, 1, 2, 7]) for _ in at]))
        order, same = suffix_sort.suffix_sort(raw, suffix_sort.PrefixHashes(raw, bits), at, group, 30)
        keys = [(group[i], raw[at[i]:at[i] + 30].tobytes()) for i in order.tolist()]
        assert keys == sorted((group[i], raw[at[i]:at[i] + 30].tobytes()) for i in range(len(at)))
        assert same.tolist() == [False, *(x == y for x, y in zip(keys, keys[1:]))]
