"""Optimal boundaries, whole-corpus level, honest exactness, and a combiner that is no worse than its better view."""

import numpy as np
import pytest
from tests.llm.test_operators import VOCABULARY

from zoneloom.llm import packing, pieces, quality, url_filter


def padded(counts, lengths, ends):
    return sum(int(counts[a + 1 : b + 1].sum() * lengths[b]) for a, b in zip([-1, *ends], ends, strict=False))


def least(counts, lengths, buckets):
    """The plain programme over every place to cut."""
    before = [0, *np.cumsum(counts).tolist()]
    best = [before[i + 1] * int(lengths[i]) for i in range(len(counts))]
    for _ in range(buckets - 1):
        best = [min([best[i], *(best[j] + (before[i + 1] - before[j + 1]) * int(lengths[i]) for j in range(i))]) for i in range(len(counts))]
    return best[-1]


def test_boundaries_over_many_lengths_are_optimal():
    rng = np.random.default_rng(11)
    for n in (1, 2, 3, 40, 150):
        for buckets in (1, 2, 5, 16):
            counts, lengths = rng.integers(1, 10 ** rng.integers(1, 6), n), np.cumsum(rng.integers(1, 50, n))
            assert padded(counts, lengths, packing.boundaries(counts, lengths, buckets)) == least(counts, lengths, buckets)
    heavy = np.full(6, 1 << 58)  # totals beyond 64 bits
    assert packing.boundaries(heavy, np.arange(1, 7), 6) == [0, 1, 2, 3, 4, 5]


def test_packed_padding_is_least(spark):
    rng = np.random.default_rng(2)
    sizes = [*rng.integers(0, 3_000, 300).tolist(), 70_000, 0, 5, 5]
    rows = [(i if i % 9 else None, "x" * n if n else None, "clash") for i, n in enumerate(sizes)] + [(7, "é" * 40, "clash")] * 2
    found = packing.pack(spark.createDataFrame(rows, "doc_id long, text string, bucket string"), buckets=6, budget=4_000).collect()
    lengths, counts = np.unique([len((t or "").encode()) for _, t, _ in rows], return_counts=True)
    assert len(found) == len(rows) and sorted(r.n_tokens for r in found) == sorted(len((t or "").encode()) for _, t, _ in rows)
    assert sum(r.bucket_width for r in found) == least(counts, lengths, 6)
    assert len({r.n_tokens for r in found}) == len({(r.n_tokens, r.bucket) for r in found})
    places = [(r.bucket, r.batch, r.place) for r in found]
    assert len(set(places)) == len(places)


def test_exact_means_that_decoding_gives_the_text(spark):
    texts = ["▁x", "a▁b", " x", "a b", "", None, "日本語\u0000😀", "  two  "]
    docs = spark.createDataFrame(list(enumerate(texts)) + [(None, "a▁b"), (3, "a b")], "doc_id long, text string")
    back = {r.doc_id: r.text for r in pieces.decode(pieces.encode(docs, VOCABULARY), VOCABULARY).collect() if r.doc_id is not None}
    got = [(r.doc_id, r.exact) for r in pieces.encoded_digests(docs, VOCABULARY).collect()]
    assert len(got) == 10 and (None, False) in got
    assert all(exact == (back[i] == (texts[i] or "")) for i, exact in got if i is not None)
    assert [dict(got)[i] for i in range(8)] == [False, False, True, True, True, True, True, True]


def test_segments_of_one_hash_are_told_apart(monkeypatch):
    vocabulary = pieces.Vocabulary.load(VOCABULARY)
    texts = ["one two three one", "two four", "one"]
    want = pieces.encode_texts(texts, vocabulary)
    monkeypatch.setattr(pieces, "mix", lambda h: np.zeros_like(h))
    got = pieces.encode_texts(texts, vocabulary)
    assert all(np.array_equal(a, b) for a, b in zip(got, want, strict=True))


def test_level_of_all_urls():
    steps, good, bad = np.array([5, -3, 2, 9]), np.array([4, 0, 1, 5]), np.array([0, 6, 2, 0])
    level = url_filter.best_level(steps, good, bad)
    assert level == pytest.approx(4 / url_filter.STEPS)  # between the steps 2 and 5
    assert url_filter.best_level(steps, good, bad * 0) == 0.0
    assert url_filter.best_level(steps[:0], good[:0], bad[:0]) == 0.0
    assert url_filter.best_level(np.array([1, 4]), np.array([3, 0]), np.array([0, 3])) * url_filter.STEPS in (1, 5)


def auc(score, y):
    rank = np.argsort(np.argsort(score))
    n = (y == 1).sum()
    return (rank[y == 1].sum() - n * (n - 1) / 2) / (n * (len(y) - n))


@pytest.mark.parametrize("told", [0.0, 1.2])
def test_both_views_are_no_worse_than_the_better_one(told):
    """``told``: how much the second view knows."""
    rng = np.random.default_rng(6)
    y = rng.integers(0, 2, 6_000)
    views = [rng.normal(size=(6_000, 4)) + 1.2 * y[:, None] * np.array([1, 1, 0, 0]),
             rng.normal(size=(6_000, 30)) + told * y[:, None] * (np.arange(30) == 0)]
    model = quality.CoTrained([(v[:1_000], v[1_000:3_000]) for v in views], y[:1_000])
    one, two, both = model.chances([v[3_000:] for v in views])
    reached = [auc(s, y[3_000:]) for s in (one, two, both)]
    assert reached[2] >= max(reached[:2]) - 1e-3
    if told:
        assert model.heard is None and reached[2] > max(reached[:2]) + 0.02
    else:
        assert model.heard == 0 and np.array_equal(both, one)
