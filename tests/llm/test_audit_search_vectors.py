"""Embedding near-dedup, filter audit and ranked search against brute force, odd rows included."""

import itertools
import math
import random
import re

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from zoneloom.llm import embedding_dedup, filter_audit, ranked_search

# ---- embeddings

VECTORS = "vec_id long, embedding array<float>, same string, node string, kept string, block long"


def made_vectors(n=260, size=24):
    rng = np.random.default_rng(8)
    base = rng.standard_normal((n, size))
    out = [list(map(float, v)) for v in base]
    for k in range(0, n, 4):  # near copies at the edge and well inside
        for far in (0.28, 0.34, 0.1):
            v = base[k] / np.linalg.norm(base[k])
            step = rng.standard_normal(size)
            step -= step @ v * v
            out.append(list(map(float, 3 * (v + far * step / np.linalg.norm(step)))))
    out += [out[5]] * 30  # a large group of equal vectors
    near = base[9] / np.linalg.norm(base[9])
    out += [list(map(float, near + 0.01 * rng.standard_normal(size))) for _ in range(60)]  # and of near ones
    out += [None, [], [0.0] * size, [float("nan")] * size, [1.0] * (size - 1) + [None], [float("inf")] + [1.0] * (size - 1), [1.0, 0.0], [2.0, 0.0]]
    out += [[x * 1e-30 for x in out[0]], [-x for x in out[1]]]
    return out


def groups_of(vectors, ids, least=0.95):
    """(n_links, component_id) by row, by comparing all pairs."""
    fine = [v is not None and len(v) and all(x is not None and math.isfinite(x) for x in v) and any(v) for v in vectors]
    arrays = [np.array(v, np.float32).astype(float) if f else None for v, f in zip(vectors, fine, strict=True)]
    links, root = [0] * len(ids), list(range(len(ids)))

    def top(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, j in itertools.combinations(range(len(ids)), 2):
        if fine[i] and fine[j] and len(arrays[i]) == len(arrays[j]):
            a, b = arrays[i] / np.abs(arrays[i]).max(), arrays[j] / np.abs(arrays[j]).max()
            if a @ b / np.linalg.norm(a) / np.linalg.norm(b) >= least:
                links[i] += 1
                links[j] += 1
                root[top(j)] = top(i)
    members = {}
    for i in range(len(ids)):
        members.setdefault(top(i), []).append(ids[i])
    smallest = {k: min((x for x in v if x is not None), default=None) for k, v in members.items()}
    return [(links[i], smallest[top(i)]) for i in range(len(ids))]


@pytest.fixture(scope="module")
def vectors():
    made = made_vectors()
    random.Random(3).shuffle(made)
    ids = [None if i % 41 == 7 else i % 350 - 40 for i in range(len(made))]  # null, negative and repeated ids
    return made, ids


def test_linked_vectors(spark, vectors):
    made, ids = vectors
    rows = spark.createDataFrame([(i, v, "x", "x", "x", 1) for i, v in zip(ids, made, strict=True)], VECTORS).repartition(5)
    want = sorted(((i, n, c, i == c) for i, (n, c) in zip(ids, groups_of(made, ids), strict=True)), key=str)
    for block in (4_096, 16):  # one block, and tables of small blocks with dealt ones among them
        got = embedding_dedup.link_vectors(rows, block_rows=block)
        assert got.columns == ["vec_id", "n_links", "component_id", "kept"]
        assert sorted(map(tuple, got.collect()), key=str) == want


def test_vectors_of_doubles_and_none(spark):
    rows = spark.createDataFrame([(1, [1e300, 1e300]), (2, [1e-300, 1e-300]), (3, [1e300, -1e300]), (4, None)], "vec_id long, embedding array<double>")
    got = {r.vec_id: (r.n_links, r.component_id, r.kept) for r in embedding_dedup.link_vectors(rows).collect()}
    assert got == {1: (1, 1, True), 2: (1, 1, False), 3: (0, 3, True), 4: (0, 4, True)}
    for rows in (spark.createDataFrame([], VECTORS), spark.createDataFrame([(7, None)], "vec_id long, embedding array<float>")):
        assert embedding_dedup.link_vectors(rows).count() == rows.count()


def test_count_is_calibrated():
    """Pairs just at the similarity share a block and reach the count as often as planned."""
    rng = np.random.default_rng(1)
    n, size = 4_000, 64
    a = rng.standard_normal((n, size))
    a /= np.linalg.norm(a, axis=1, keepdims=True)
    step = rng.standard_normal((n, size))
    step -= (step * a).sum(axis=1, keepdims=True) * a
    b = 0.95 * a + math.sqrt(1 - 0.95**2) * step / np.linalg.norm(step, axis=1, keepdims=True)
    plan = embedding_dedup.Plan(10_000_000, 4_096, 0.95)
    assert plan.cells > 5 and plan.tables > 5
    met = (plan.codes(a) == plan.codes(b)).any(axis=1)
    p, q = (x @ np.random.default_rng(2).standard_normal((size, embedding_dedup.COUNTED)) for x in (a, b))
    counted = (np.abs(p - q) <= embedding_dedup.WINDOW * plan.distance).sum(axis=1) >= plan.count
    assert (met & counted).mean() >= 0.985
    assert (plan.codes(a[1:]) == plan.codes(b[:-1])).mean() < 0.01  # and few others meet
    i, j = next(embedding_dedup.candidates(p[:50], q[:50], WINDOW_AT(plan), plan.count, False))
    want = (np.abs(p[:50, None] - q[None, :50]) <= WINDOW_AT(plan)).sum(axis=2) >= plan.count
    assert set(zip(i, j, strict=True)) == set(zip(*np.nonzero(want), strict=True))


def WINDOW_AT(plan):
    return embedding_dedup.WINDOW * plan.distance


# ---- filter audit

DOCS = "doc_id long, text string, lang string, source string, mask long, n long, salt int"


def made_documents():
    rng = random.Random(5)
    texts = [None, "", " \t", "A B C", "x # y", "| " * 120, "Word " * 150, " ".join(f"w{i}" for i in range(150)), "É" * 3 + "A" * 40]
    for _ in range(60):
        kind = rng.randrange(4)
        words = [rng.choice("abcdefghijklmnop") * rng.randint(1, 9) if kind else f"{rng.random():.7f}" for _ in range(rng.choice([20, 99, 100, 101, 300]))]
        if rng.random() < 0.3:
            words = [w.upper() for w in words]
        if rng.random() < 0.3:
            words.append("100%")
        texts.append(rng.choice([" ", "\n", "\x0b "]).join(words))
    texts += [texts[7]] * 40 + texts[10:30]
    rng.shuffle(texts)
    rows = [(None if k % 23 == 5 else k, t, rng.choice(["en", "de", None, ""])) for k, t in enumerate(texts)]
    rows += [rows[0], rows[3], (3, texts[7], "fr")]  # repeated rows and a repeated id
    labels = [(k, rng.choice([0, 1, None]), rng.choice([0, 0, 1])) for k in range(0, len(texts), 2)] + [(4, 1, 1), (None, 1, 1), (9_999, 1, 0)]
    return rows, labels


def audited(rows, labels):
    good, toxic = {i for i, q, _ in labels if q == 1 and i is not None}, {i for i, _, t in labels if t == 1 and i is not None}
    first, fails = {}, []
    for i, t, _ in rows:
        if i is not None:
            first[t or ""] = min(i, first.get(t or "", i))
    for i, t, lang in rows:
        t = t or ""
        words = re.findall(r"[^\x20\x09-\x0D]+", t)
        own = {f for f, bad in zip("ABCDE", (
            len(words) < 100, 100 * len(set(words)) < 80 * len(words), 100 * len(re.findall("[A-Z]", t)) > 10 * len(t),
            bool(re.search(r"[#$%&*|]", t)), i is not None and first[t] < i), strict=True) if bad}
        fails.append((lang or "", own, i in good, i in toxic))
    out = {}
    for part in {f[0] for f in fails}:
        own = [f for f in fails if f[0] == part]
        total = dict.fromkeys("ABCDE", 0)
        for order in itertools.permutations("ABCDE"):
            left = own
            for step, f in enumerate(order, 1):
                gone = [x for x in left if f in x[1]]
                left = [x for x in left if f not in x[1]]
                total[f] += len(gone)
                out[part, "".join(order), step] = [
                    len(left), len(gone), sum(f in x[1] for x in own) - len(gone), sum(x[1] == {f} for x in own),
                    sum(x[2] for x in gone), sum(x[3] for x in gone)]
        for (p, order, step), v in out.items():
            if p == part:
                v.append(total[order[step - 1]])
    return {k: tuple(v) for k, v in out.items()}


def test_filter_audit(spark):
    rows, labels = made_documents()
    docs = spark.createDataFrame([(i, t, lang, "s", 1, 1, 1) for i, t, lang in rows], DOCS).repartition(4)
    marks = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    names = ["kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley"]
    got = filter_audit.audit(docs, marks).collect()
    assert {(r.part, r.filter_order, r.step): tuple(r[n] for n in names) for r in got} == audited(rows, labels)
    assert len(got) == 600 * 4
    assert filter_audit.audit(docs.limit(0), marks).count() == 0
    alone = filter_audit.audit(docs, marks.limit(0)).agg(F.sum("good_lost"), F.sum("toxic_lost"), F.count("*")).first()
    assert tuple(alone) == (0, 0, 2400)


def test_gray_walk_visits_every_subset():
    rng = np.random.default_rng(2)
    masks, weights = np.arange(32), rng.integers(0, 50, (32, 3))
    states = filter_audit.gray_walk(masks, weights)
    assert (states == np.stack([weights[masks & s == 0].sum(axis=0) for s in range(32)])).all()


# ---- ranked search

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def terms(t):
    return TERM.findall(re.sub("[A-Z]+", lambda m: m[0].lower(), t or ""))


def ranking(docs, items, most=10):
    words = [terms(t) for _, t in docs]
    n_docs, length = sum(bool(w) for w in words), sum(map(len, words))
    df = {}
    for w in words:
        for t in set(w):
            df[t] = df.get(t, 0) + 1
    asked = {}
    for i, t in items:
        asked.setdefault(i, set()).update(terms(t))
    out = []
    for item, own in asked.items():
        scored = []
        for (i, _), w in zip(docs, words, strict=True):
            m = 100 - 90 + (90 * len(w) * n_docs) // max(1, length)
            s = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * (1_000_000_000 * w.count(t) // (1000 * w.count(t) + 8 * m))
                    for t in own if t in df)
            if s > 0:
                scored.append((-s, i is None, i, s))
        scored.sort(key=lambda x: (x[0], x[1], x[2] or 0))
        out += [(item, k, i, s) for k, (_, _, i, s) in enumerate(scored[:most], 1)]
    return sorted(out, key=str)


@pytest.fixture(scope="module")
def corpus():
    rng = random.Random(11)
    vocabulary = ["".join(rng.choice("abcdefß9ñ") for _ in range(rng.randint(1, 6))) for _ in range(300)]
    weight = [1 / (k + 1) for k in range(300)]
    docs = [(k, " ".join(rng.choices(vocabulary, weight, k=rng.choice([3, 30, 200])))) for k in range(700)]
    docs += [(k, docs[k % 9][1].upper()) for k in range(700, 760)]  # ties
    docs += [(None, docs[4][1]), (5, docs[5][1]), (5, "other"), (None, None), (800, ""), (801, "-- \n"), (802, "x" * 70_000 + " " + "tail " * 20_000)]
    rng.shuffle(docs)
    items = [(k, ", ".join(rng.choices(vocabulary, weight, k=rng.choice([2, 12, 40])))) for k in range(30)]
    items += [(40, None), (41, "  "), (42, "absent unheard"), (43, "tail"), (44, "A a A"), (None, docs[0][1]), (45, "b"), (45, "c d"), (46, "x" * 70_000)]
    return docs, items


def test_ranked_search(spark, corpus, monkeypatch):
    docs, items = corpus
    frame = spark.createDataFrame([(i, t, 1, "r", 2.0) for i, t in docs], "doc_id long, text string, n long, terms string, score double").repartition(3)
    asked = spark.createDataFrame([(i, t, 1) for i, t in items], "item_id long, text string, rank int")
    want = ranking(docs, items)
    assert sorted(map(tuple, ranked_search.search(frame, asked).collect()), key=str) == want
    monkeypatch.setattr(ranked_search, "ITEMS", 12)  # several blocks of items, small trees
    monkeypatch.setattr(ranked_search, "CELLS", 1)
    assert sorted(map(tuple, ranked_search.search(frame, asked).collect()), key=str) == want
    assert ranked_search.search(frame.limit(0), asked).count() == 0
    assert ranked_search.search(frame, asked.limit(0)).count() == 0


def test_tree_leaves_out_and_finds_all():
    rng = np.random.default_rng(4)
    n, size = 3_000, 60
    tf = rng.poisson(1 / (1 + np.arange(size)), (n, size)).astype(np.int32)
    tf[::7] = tf[0]  # equal paths
    row, term = np.nonzero(tf)
    m = rng.integers(10, 200, n)
    order = np.argsort(-(tf > 0).sum(axis=0), kind="stable")
    rank = np.empty(size, np.int64)
    rank[order] = np.arange(size)
    tree = ranked_search.Tree(pa.array(np.arange(n)), m, row, term, tf[row, term], rank)
    leaves = [(a, b) for a, b, c in zip(tree.lo, tree.hi, tree.children, strict=True) if not c]
    assert sorted(itertools.chain.from_iterable(range(a, b) for a, b in leaves)) == list(range(n))
    weight = rng.integers(0, 9_000, size)
    seen = []
    plain = ranked_search.score
    for _ in range(20):
        own = np.sort(rng.choice(size, 8, replace=False))
        want = plain(tf[:, own], m, weight[own])
        best = np.lexsort((np.arange(n), -want))[:10]
        rows, scores = tree.best(own, weight[own], 10)
        order = np.lexsort((tree.low_id[rows], -scores))
        assert [(int(s), int(i)) for s, i in zip(scores[order], tree.low_id[rows][order], strict=True)] == [(int(want[b]), int(b)) for b in best if want[b] > 0]
        with pytest.MonkeyPatch.context() as patch:
            patch.setattr(ranked_search, "score", lambda t, *a: seen.append(len(t)) or plain(t, *a))
            tree.best(own, weight[own], 10)
    assert sum(seen) / 20 < 0.6 * n + len(tree.lo)  # the bounds leave subtrees out
