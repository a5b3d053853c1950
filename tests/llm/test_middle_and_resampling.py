"""Fill-in-middle and importance resampling against plain loops over the contract's words."""

import collections
import hashlib
import math
import random
import re
import zlib

import numpy as np
import pytest

from salesmart.llm import middle, resampling
from salesmart.llm.common import table

SCHEMA = "doc_id long, text string, lang string, n long, score string, rank int, part int, a int"
UNIT = re.compile(r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+")


def _text(seed, n):
    r = random.Random(seed)
    return " ".join(r.choice(["alpha", "Beta", "gämma", "日本", "x1", "the", "of"]) + r.choice(["", ".", ", ", "\n"]) for _ in range(n))


@pytest.fixture(scope="module")
def docs(spark):
    texts = [(0, None), (1, ""), (2, " \n\t"), (3, _text(3, 30)), (3, _text(3, 30)), (4, _text(4, 30)), (None, _text(5, 40)), (None, None),
             (5, "a <P> b " * 20), (6, "<S>" + _text(6, 25)), (7, _text(7, 20_000)), (8, "w" * 70_000 + " " + _text(8, 30)),
             (9, "é" * 300), (10, "x" * 64 + " " + "y" * 65 + " z" * 30), (2**63 - 1, _text(9, 30)), (-4, _text(10, 25))]
    texts += [(100 + i, _text(100 + i, 5 + i)) for i in range(60)]
    return spark.createDataFrame([(d, t, None, 7, "s", 1, 2, 3) for d, t in texts], SCHEMA).repartition(4).cache()


def _middle(doc_id, text):
    text = text or ""
    units = UNIT.findall(text)
    h = hashlib.sha256(f"42:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(h[i:i + 8], 16) for i in (0, 8, 16, 24))
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")) or h3 % 100 >= 50:
        return doc_id, len(units), "plain", None, None, text, text
    a, b = sorted((h1 % (len(units) + 1), h2 % (len(units) + 1)))
    p, m, s = "".join(units[:a]), "".join(units[a:b]), "".join(units[b:])
    form, out = ("spm", f"<S>{s}<P>{p}<M>{m}") if h4 % 100 < 80 else ("psm", f"<P>{p}<S>{s}<M>{m}")
    return doc_id, len(units), form, len(p), len(m), out, text


def test_middle_equals_plain_cutting(spark, docs):
    got = collections.Counter(tuple(r) for r in middle.fill_in_middle(docs).collect())
    assert got == collections.Counter(_middle(r.doc_id, r.text) for r in docs.collect())
    assert {k[2] for k in got} == {"plain", "spm", "psm"}
    assert middle.fill_in_middle(docs.limit(0)).collect() == []


def test_skip_list_seeks_by_both_widths():
    r = random.Random(0)
    for n in (0, 1, 2, 3, 50, 5000):
        widths = np.array([r.randrange(1, 9) for _ in range(n)], np.int64)
        links, edges = middle.SkipList(widths), np.concatenate([[0], np.cumsum(widths)])
        assert all(links.seek(k) == (k, edges[k]) for k in ([*range(n + 1)] if n < 100 else r.sample(range(n + 1), 200)))
        assert links.seek(n + 5) == (n, edges[n])
        for _, units, points in links.lanes:  # a lane's links pass no more than all units and points
            assert units.sum() <= n and points.sum() <= edges[-1]
    assert len(middle.SkipList(np.ones(100_000, np.int64)).lanes) > 5


def test_marks_that_touch_text():
    text = "a < b<S c<P d> <M e"
    forms = set()
    for i in range(300):
        out, form, *_ = middle.transform_text(text, i)
        forms.add(form)
        assert middle.restore(out, form) == text
    assert forms == {"plain", "spm", "psm"}


def _words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def _features(text):
    w = _words(text)
    return [zlib.crc32(f.encode()) % 10_000 for f in [*w, *(" ".join(p) for p in zip(w, w[1:]))]]


def _resampled(rows, target):
    """The contract, document by document."""
    s, t = collections.Counter(), collections.Counter()
    for _, text in rows:
        s.update(_features(text))
    for text in target:
        t.update(_features(text))
    big_s, big_t = sum(s.values()), sum(t.values())
    gain = lambda b: math.floor(1000 * math.log((t[b] + 1) * (big_s + 10_000) / ((s[b] + 1) * (big_t + 10_000))))
    out = []
    for d, text in rows:
        f = _features(text)
        weight = sum(map(gain, f)) // len(f) if f else 0
        h = int(hashlib.sha256(f"7:{'' if d is None else d}".encode()).hexdigest()[:8], 16)
        out.append([d, len(f), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), len(_words(text)) >= 20])
    order = sorted((r for r in out if r[4]), key=lambda r: (-r[3], r[0] is None, r[0] or 0))
    drawn = [(*r[:4], i + 1) for i, r in enumerate(order[:25 * len(order) // 100])]
    want = collections.Counter(drawn)
    taken = collections.Counter(d[:4] for d in drawn)
    for r in out:
        if taken[tuple(r[:4])]:
            taken[tuple(r[:4])] -= 1
        else:
            want[(*r[:4], None)] += 1
    return want


def _draw(df):
    return collections.Counter(tuple(r) for r in df.select("doc_id", "n_features", "weight", "score", "rank").collect())


def test_resampling_equals_plain_loops(spark, docs, data_dir):
    target = spark.createDataFrame([(1, _text(50, 40)), (2, None), (3, "the of the")], "item_id long, text string")
    got = _draw(resampling.resample(docs, target))
    assert got == _resampled([(r.doc_id, r.text) for r in docs.collect()], [r.text for r in target.collect()])
    given = table(spark, data_dir, "documents")
    bench = table(spark, data_dir, "benchmark")
    assert _draw(resampling.resample(given, bench)) == _resampled(
        [(r.doc_id, r.text) for r in given.collect()], [r.text for r in bench.collect()])


def test_resampling_of_nothing(spark, docs):
    none = docs.limit(0)
    assert _draw(resampling.resample(none, docs)) == {}
    assert all(k[4] is None for k in _draw(resampling.resample(docs.where("doc_id < 3"), none)))


@pytest.mark.parametrize("kind", ["all equal", "few values", "distinct", "one partition holds the least"])
def test_kth_key_over_ties_and_hot_partitions(spark, kind):
    r = random.Random(kind)
    n = 400
    keys = {"all equal": [(5, 5)] * n, "few values": [(r.randrange(3), r.randrange(4)) for _ in range(n)],
            "distinct": [(r.randrange(-10**9, 10**9), i) for i in range(n)],
            "one partition holds the least": sorted((r.randrange(50), i) for i in range(n))}[kind]
    df = spark.createDataFrame(keys, "x long, y long").coalesce(1) if kind.startswith("one") else spark.createDataFrame(keys, "x long, y long").repartition(7)
    df = df.union(spark.createDataFrame([], "x long, y long")).cache()
    for k in (1, 2, 57, 200, 399, 400):
        assert resampling.kth_key(df, k) == sorted(keys)[k - 1]
