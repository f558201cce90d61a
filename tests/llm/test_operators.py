"""Every text operator against a brute-force version on a small table with all the odd rows."""

import hashlib
import itertools
import random
import re

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from zoneloom.llm import exact_dedup, language, ngram_join, packing, pieces, quality, sharding, simhash, suffix_dedup, url_filter

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, kept string, key string"
VOCABULARY = "/opt/tokenizers/piece_bpe_32k.model"


def made_texts():
    rng = random.Random(4)
    vocabulary = ["".join(rng.choice("abcdeéßñ") for _ in range(rng.randint(2, 7))) for _ in range(400)]
    words = lambda n: [rng.choice(vocabulary) for _ in range(n)]
    passage = " ".join(words(30))
    out = [None, "", " \t\n", "...", "a", "two words", "Two Words", "x" * 5000, " ".join(words(3000))]
    for k in range(60):
        base = words(rng.randint(5, 160))
        out.append(" ".join(base))
        if k % 3 == 0:  # a near copy
            base[rng.randrange(len(base))] = "edited"
            out.append(" ".join(base))
        if k % 4 == 0:
            out.append(" ".join(words(20)) + "\n" + passage + "\n" + " ".join(words(20)))
        if k % 6 == 0:
            out.append(out[-1])
            out.append(out[-1].upper())
    near = words(80)
    for k in range(40):  # a large group of near copies
        own = list(near)
        own[k * 2 % 80] = f"w{k % 7}"
        out.append(" ".join(own))
    return out


@pytest.fixture(scope="module")
def rows():
    texts = made_texts()
    random.Random(1).shuffle(texts)
    return [(i, t) for i, t in enumerate(texts)]


@pytest.fixture(scope="module")
def docs(spark, rows):
    langs = ["en", "de", None]
    full = [(i, t, langs[i % 3], f"s{i % 4}" if i % 5 else None, None if t is None else len(t), "clash", "clash") for i, t in rows]
    return spark.createDataFrame(full, SCHEMA).repartition(5)


@pytest.fixture(scope="module")
def odd(spark, rows):
    """Null and repeated ids, repeated rows."""
    return spark.createDataFrame([(None, "two words"), (None, None), (3, "two words"), (3, "two words"), (3, "other"), (9, "x" * 60), (9, "x" * 60), (12, "x" * 70)],
                                 "doc_id long, text string")


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], SCHEMA)


def collected(df, *names):
    return {r["doc_id"]: tuple(r[n] for n in names) for r in df.collect()}


def ascii_lower(t):
    return re.sub("[A-Z]+", lambda m: m[0].lower(), t or "")


def test_repeated_strings(docs, odd, none, rows):
    first = {}
    for i, t in rows:
        b = (t or "").encode()
        for p in range(len(b) - 49):
            first.setdefault(b[p : p + 50], i)
    want, left = {}, {}
    for i, t in rows:
        b = (t or "").encode()
        gone = bytearray(len(b))
        for p in range(len(b) - 49):
            if first[b[p : p + 50]] < i:
                gone[p : p + 50] = b"\1" * 50
        spans = sum(1 for k, _ in itertools.groupby(gone) if k)
        want[i] = (len(b), sum(gone), spans, hashlib.sha256(bytes(x for x, g in zip(b, gone, strict=True) if not g)).hexdigest())
        at, text = 0, ""
        for c in t or "":
            n = len(c.encode())
            text += "" if all(gone[at : at + n]) else c
            at += n
        left[i] = text
    names = ("n_bytes", "n_removed", "n_spans", "kept_sha256")
    assert collected(suffix_dedup.repeated_strings(docs), *names) == want
    cut = suffix_dedup.cut_repeats(docs)
    assert cut.columns == docs.columns
    assert {i: t or "" for i, (t,) in collected(cut, "text").items()} == {i: t for i, t in left.items() if t or not rows[i][1]}
    found = suffix_dedup.repeated_strings(odd).collect()
    assert len(found) == odd.count() and {r.n_removed for r in found if r.doc_id == 9} == {0} and {r.n_removed for r in found if r.doc_id == 12} == {70}
    assert suffix_dedup.repeated_strings(none).count() == 0


def test_hot_anchors_travel_singly(docs, monkeypatch):
    names = ("n_removed", "n_spans", "kept_sha256")
    want = collected(suffix_dedup.repeated_strings(docs), *names)
    from zoneloom.llm import screen
    monkeypatch.setattr(screen, "HOT_BATCHES", 1)
    monkeypatch.setattr(screen, "BATCH_BYTES", 2_000)
    assert collected(suffix_dedup.repeated_strings(docs), *names) == want


def test_merged_transforms_find_first_holders():
    rng = random.Random(2)
    strings = list({"".join(rng.choice("ab") for _ in range(4)) * 14 + rng.choice("abc") * rng.randint(0, 9) for _ in range(60)})
    strings = [s.encode() for s in strings]
    holder = np.array([rng.randint(0, 5) for _ in strings])
    windows = np.array([len(s) - 49 for s in strings])
    least = {}
    for s, h, w in zip(strings, holder, windows, strict=True):
        for p in range(w):
            least[s[p : p + 50]] = min(least.get(s[p : p + 50], 99), h)
    want = [(i, p) for i, s in enumerate(strings) for p in range(windows[i]) if least[s[p : p + 50]] == holder[i]]
    for size in (1, 200, 1 << 16):
        suffix_dedup.SHARD_BYTES, kept = size, suffix_dedup.SHARD_BYTES
        owner, place = suffix_dedup.first_holders(strings, windows, holder)
        suffix_dedup.SHARD_BYTES = kept
        assert list(zip(owner.tolist(), place.tolist(), strict=True)) == want


def shingles(t):
    w = re.findall(r"[^\x20\x09-\x0D]+", ascii_lower(t))
    return frozenset([tuple(w)] if 0 < len(w) < 5 else [tuple(w[k : k + 5]) for k in range(len(w) - 4)])


def near_classes(rows):
    sets = {i: shingles(t) for i, t in rows}
    root = {i: i for i in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in itertools.combinations(sorted(sets), 2):
        both = len(sets[a] & sets[b])
        if both and 100 * both >= 80 * len(sets[a] | sets[b]):
            x, y = sorted((find(a), find(b)))
            root[y] = x
    return {i: (len(sets[i]), find(i)) for i in sets}


@pytest.mark.parametrize("token_block,block_shingles", [(4096, 2_000_000), (4, 300)])
def test_near_groups(docs, rows, token_block, block_shingles):
    got = ngram_join.near_groups(docs, token_block, block_shingles)
    assert collected(got, "n_shingles", "component_id") == near_classes(rows)


def test_near_groups_of_odd_rows(odd, none):
    assert ngram_join.near_groups(odd).count() == odd.count() and ngram_join.near_groups(none).count() == 0


def test_exact_duplicates(docs, odd, none, rows):
    groups = {}
    for i, t in rows:
        groups.setdefault(ascii_lower(t), []).append(i)
    want = {i: (max(g), len(g), i == max(g), hashlib.sha256(t.encode()).hexdigest()) for t, g in groups.items() for i in g}
    assert collected(exact_dedup.exact_duplicates(docs), "keep_id", "group_size", "kept", "text_sha256") == want
    kept = exact_dedup.keep_one(docs)
    assert kept.columns == docs.columns and sorted(r.doc_id for r in kept.collect()) == sorted(max(g) for g in groups.values())
    one = sorted(((r.doc_id if r.doc_id is not None else -1), r.text or "") for r in exact_dedup.keep_one(odd).collect())
    assert one == [(-1, ""), (3, "other"), (3, "two words"), (9, "x" * 60), (12, "x" * 70)]
    assert exact_dedup.exact_duplicates(none).count() == 0


def test_fuse_filter_knows_its_keys():
    rng = np.random.default_rng(1)
    for n in (0, 1, 2, 50, 5_000):
        keys = rng.integers(0, 1 << 63, n, dtype=np.uint64)
        f = exact_dedup.build_filter(keys)
        assert exact_dedup.may_hold(keys, *f).all()
        others = rng.integers(0, 1 << 63, 20_000, dtype=np.uint64)
        assert exact_dedup.may_hold(others, *f).mean() < 0.02


def test_fingerprints(docs, odd, none, rows):
    got = simhash.fingerprint_documents(docs).collect()
    by = {r.doc_id: r for r in got}
    assert len(got) == len(rows)
    for (i, t), (_, u) in zip(rows, rows[1:] + rows[:1], strict=True):
        t, u = t or "", u or ""
        k = len(t) // 4
        edited = t[: len(t) - k] + u[:k]
        assert by[i].n_chars == len(t) and by[i].edited_sha256 == hashlib.sha256(edited.encode()).hexdigest()
        own, other = simhash.fingerprints([t, edited])
        assert by[i].fingerprint == own.tobytes().hex() and by[i].edited_fingerprint == other.tobytes().hex()
    assert np.mean([r.near_edited for r in got]) > np.mean([r.near_next for r in got]) + 0.1
    away = lambda a, b: (int(a, 16) ^ int(b, 16)).bit_count()
    for r in got:
        near = [x.doc_id for x in got if away(x.fingerprint, r.fingerprint) <= simhash.RADIUS]
        assert (r.near_id, r.n_near) == ((min(near), len(near)) if r.doc_id % 20 == 0 else (None, None))
    assert simhash.fingerprint_next(odd).count() >= 1 and simhash.fingerprint_next(none).count() == 0


def near_families(n, seed=8):
    """n pairs of texts of random words, the second with some words edited."""
    rng = random.Random(seed)
    for _ in range(n):
        own = [f"w{rng.randrange(5000)}" for _ in range(rng.randint(80, 400))]
        copy = list(own)
        for at in rng.sample(range(len(own)), rng.randint(1, max(1, len(own) // 45))):
            copy[at] = "edited"
        yield " ".join(own), " ".join(copy)


def test_fingerprints_find_what_is_alike(spark):
    texts = {}
    for k, (own, copy) in enumerate(near_families(120)):
        texts[20 * k + 1], texts[20 * k + 20] = own, copy
    sets = {i: shingles(t) for i, t in texts.items()}
    alike = lambda a, b: len(sets[a] & sets[b]) / len(sets[a] | sets[b])
    got = simhash.fingerprint_documents(spark.createDataFrame(list(texts.items()), "doc_id long, text string")).collect()
    asked = {r.doc_id: r for r in got if r.doc_id % 20 == 0}
    want = {i: [j for j in texts if j != i and alike(i, j) >= 0.8] for i in asked}
    assert sum(map(len, want.values())) >= 80
    hit = sum(asked[i].near_id == min(w) and asked[i].n_near == 1 + len(w) for i, w in want.items() if w)
    assert hit >= 0.9 * sum(map(bool, want.values()))
    assert all(alike(i, asked[i].near_id) > 0.6 for i in asked)


@pytest.mark.parametrize("radius", [0, 3, 17, 23, 40])
def test_pairs_within_a_radius(radius, monkeypatch):
    rng = np.random.default_rng(radius)
    monkeypatch.setattr(simhash, "CANDIDATES", 500)
    base = rng.integers(0, 256, (6, 16), dtype=np.uint8)
    flip = np.packbits(rng.random((240, 128)) < rng.random((240, 1)) * 0.3, axis=1)
    prints = np.unique(np.concatenate([base, base[rng.integers(0, 6, 240)] ^ flip]), axis=0)
    queries = prints[::5]
    away = np.bitwise_count(queries[:, None] ^ prints[None]).sum(axis=2)
    got = [(int(a), int(b)) for x, y in simhash.pairs_within(queries, prints, radius) for a, b in zip(x, y, strict=True)]
    assert len(got) == len(set(got)) and set(got) == set(zip(*map(np.ndarray.tolist, np.nonzero(away <= radius)), strict=True))


def test_near_counts_over_several_tiles(spark, monkeypatch):
    monkeypatch.setattr(simhash, "TILE", 20)
    monkeypatch.setattr(simhash, "ASKED", 7)
    rng = np.random.default_rng(6)
    prints = [bytes(x) for x in np.packbits(rng.random((150, 128)) < 0.08, axis=1)]
    rows = [(p, None if i % 3 == 0 else 10 * i, i % 4 + 1) for i, p in enumerate(dict.fromkeys(prints))]
    held = spark.createDataFrame(rows, "print binary, least long, n long")
    got = {bytes(r.print): (r.near_id, r.n_near) for r in simhash.near_counts(held.filter("n = 2").select("print"), held, 18).collect()}
    away = lambda a, b: (int.from_bytes(a) ^ int.from_bytes(b)).bit_count()
    want = {}
    for p in (p for p, _, n in rows if n == 2):
        near = [(least, n) for q, least, n in rows if away(p, q) <= 18]
        want[p] = (min((x for x, _ in near if x is not None), default=None), sum(n for _, n in near))
    assert got == want


def test_shards(docs, odd, none, rows):
    found = sharding.assign_shards(docs, 7).collect()
    sizes = [sum(r.shard == s for r in found) for s in range(7)]
    assert len(found) == len(rows) and max(sizes) - min(sizes) <= 1
    for s in range(7):
        assert sorted(r.slot for r in found if r.shard == s) == list(range(sizes[s]))
    text = dict(rows)
    cut = {}
    for r in found:
        assert r.size == len((text[r.doc_id] or "").encode()) + 16
        cut.setdefault(text[r.doc_id], set()).add(r.shard)
    assert sum(len(x) > 1 for x in cut.values()) == 0  # the groups are small: all together
    assert sharding.assign_shards(odd, 3).count() == odd.count() and sharding.assign_shards(none).count() == 0


@pytest.mark.parametrize("rows,size,shards", [(1200, 2, 8), (1200, 10, 7), (1000, 90, 6)])
def test_shards_where_every_row_has_a_copy(spark, rows, size, shards):
    found = sharding.assign_shards(spark.range(rows).selectExpr("id AS doc_id", f"concat('text ', id div {size}) AS text"), shards).collect()
    sizes = [sum(r.shard == s for r in found) for s in range(shards)]
    assert len(found) == rows and max(sizes) - min(sizes) <= 1
    homes = {}
    for r in found:
        homes.setdefault(r.doc_id // size, set()).add(r.shard)
    assert sum(len(x) - 1 for x in homes.values()) < shards  # only groups at the border of a shard


def test_flows_of_shards():
    rng = np.random.default_rng(3)
    for _ in range(50):
        wishes, free = rng.integers(0, 90, (9, 9)) * (rng.random((9, 9)) < 0.4), rng.integers(0, 30, 9) * (rng.random(9) < 0.3)
        np.fill_diagonal(wishes, 0)
        moved = sharding.flows(wishes, free)
        assert (moved >= 0).all() and (moved <= wishes).all() and (moved.sum(axis=0) - moved.sum(axis=1) <= free).all()
    ring = np.roll(np.diag([7, 5, 6]), 1, axis=1)
    assert sharding.flows(ring, np.zeros(3, int)).sum() == 15  # round the ring, without any free place


def test_packing(docs, none, rows):
    found = packing.pack(docs, buckets=4, budget=2_000).collect()
    assert len(found) == len(rows)
    batches = {}
    for r in found:
        assert r.n_tokens + r.padding == r.bucket_width and r.padding >= 0
        batches.setdefault((r.bucket, r.batch), []).append(r)
    assert all(len(b) * b[0].bucket_width <= 2_000 or len(b) == 1 for b in batches.values())
    assert packing.pack(none).count() == 0


def test_boundaries_are_optimal():
    rng = np.random.default_rng(3)
    for n in (1, 2, 5, 9):
        counts, longest = rng.integers(1, 9, n), np.cumsum(rng.integers(1, 9, n))
        for k in (1, 2, 3):
            cost = lambda ends: sum(counts[a + 1 : b + 1].sum() * longest[b] for a, b in zip([-1, *ends], ends, strict=False))
            best = min(cost([*c, n - 1]) for m in range(min(k, n)) for c in itertools.combinations(range(n - 1), m))
            assert cost(packing.boundaries(counts, longest, k)) == best


def test_pieces_agree_with_the_library(docs, none, rows):
    sentencepiece = pytest.importorskip("sentencepiece")
    model = sentencepiece.SentencePieceProcessor(model_file=VOCABULARY)
    ids = {i: list(x) for i, (x,) in collected(pieces.encode(docs, VOCABULARY), "ids").items()}
    assert ids == {i: model.encode(t or "") for i, t in rows}
    back = pieces.decode(pieces.encode(docs, VOCABULARY), VOCABULARY)
    assert collected(back, "text") == {i: (t or "",) for i, t in rows}
    assert all(r.exact for r in pieces.encoded_digests(docs, VOCABULARY).collect())
    texts = ["  a  b ", "日本語😀\u0000", "y" * 300 + " " * 90, "▁x"]
    found, cuts, _ = pieces.encode_texts(texts, pieces.Vocabulary.load(VOCABULARY))
    assert [found[a:b].tolist() for a, b in zip(cuts, cuts[1:], strict=False)] == [model.encode(t) for t in texts]
    assert pieces.encode(none, VOCABULARY).count() == 0


def test_language(spark, none):
    rng = random.Random(8)
    sets = {"aa": ["the", "of", "and", "is"], "bb": ["der", "und", "ist", "zu"]}
    made = [(i, " ".join(rng.choice(sets[lang]) for _ in range(rng.randint(2, 40))), lang) for i, lang in enumerate(["aa", "bb"] * 60)]
    made += [(500, None, "aa"), (501, "12 ..", "bb"), (502, "", None), (None, "the of", None)]
    got = language.identify(spark.createDataFrame(made, "doc_id long, text string, lang string")).collect()
    assert len(got) == len(made) and all(0 <= r.score <= 1 for r in got)
    found = {r.doc_id: r for r in got}
    tried = [(found[i], lang) for i, _, lang in made[:120] if found[i].held_out]
    assert tried and np.mean([r.lang_pred == lang for r, lang in tried]) > 0.95
    assert [found[i].lang_pred for i in (500, 501, 502, None)] == ["und", "und", "und", "aa"]
    assert language.identify(none).count() == 0


def test_urls(spark):
    made = [f"http://a{i}.org/news/{i}" for i in range(40)] + [f"http://x{i}.com/de/win-{i}" for i in range(40)]
    special = [None, "nothing", "HTTP://WWW.Example.ORG/es/1?x", "http://example.org", "http://example.org/en/12", "http://q.net/news/7", "http://q.net/de/win-3", "http://com/fr/"]
    pages = spark.createDataFrame(list(enumerate(made + special)), "page_id long, url string")
    got = {r.page_id: r for r in url_filter.judge(pages).collect()}
    n = len(made)
    assert all(got[i].rule == "org/" and got[i].verdict == "allow" for i in range(40))
    assert all(got[i].rule == "com/de/" and got[i].verdict == "block" for i in range(40, 80))
    want = [("", "", None, "block"), ("", "", None, "block"), ("www.example.org", "/es/1", "example.org/es/", "block"), ("example.org", "", None, None),
            ("example.org", "/en/12", "example.org/en/1", "block"), ("q.net", "/news/7", None, None), ("q.net", "/de/win-3", None, None), ("com", "/fr/", "com/fr/", "allow")]
    for k, (host, path, rule, verdict) in enumerate(want):
        r = got[n + k]
        assert (r.host, r.path, r.rule) == (host, path, rule) and verdict in (None, r.verdict)
    plain = pages.filter(F.col("url").isin([*made, *special[5:7]]))
    assert [r.verdict for r in url_filter.judge(plain).orderBy("page_id").collect()[-2:]] == ["allow", "block"]
    assert url_filter.judge(pages.filter("page_id < 0")).count() == 0


def brute_chance(urls, context, symbol):
    """Witten-Bell over whole Python dictionaries; strings of three bytes and more count from two on."""
    seen = {}
    for u in urls:
        for k in range(url_filter.ORDER + 1):
            for i in range(k, len(u)):
                seen[u[i - k : i], u[i]] = seen.get((u[i - k : i], u[i]), 0) + 1
    seen = {c: n for c, n in seen.items() if len(c[0]) < 2 or n > 1}
    p = 1 / 256
    for k in range(len(context) + 1):
        own = {s: n for (c, s), n in seen.items() if c == context[len(context) - k :]}
        total = sum(own.values())
        p = (own.get(symbol, 0) + len(own) * p) / (total + len(own)) if total else p
    return p


def test_url_models(spark):
    good, bad, others = [b"abcab", b"abd", b"abcabcabcx"], [b"xx/abc", b"abcab"], ["bcabé".encode(), b"qab"]
    rows = [(u.decode(), k) for k, kind in ((1, good), (2, bad), (0, others)) for u in kind]
    got = {r.gram: (r.p_good, r.p_bad) for r in url_filter.models(spark.createDataFrame(rows, "url string, kind int")).collect()}
    want = {u[i - k : i + 1] for u in [*good, *bad, *others] for i in range(len(u)) for k in range(min(i, url_filter.ORDER) + 1)}
    pack = lambda w: (len(w) << 48) + int.from_bytes(w, "big")
    assert set(got) == {pack(w) for w in want}
    for w in want:
        assert got[pack(w)] == pytest.approx((brute_chance(good, w[:-1], w[-1]), brute_chance(bad, w[:-1], w[-1])))
    assert sum(brute_chance(good, b"ab", s) for s in range(256)) == pytest.approx(1.0)
    gains = spark.createDataFrame([(g, float(np.log(a) - np.log(b))) for g, (a, b) in got.items()], "gram long, gain double")
    urls = [(i, u.decode()) for i, u in enumerate([*good, *others, *good])] + [(50, ""), (51, None), (None, "abd")]
    for r in url_filter.evidence(spark.createDataFrame(urls, "page_id long, url string"), gains).collect():
        u = (r.url or "").encode()
        parts = [np.log(brute_chance(good, u[max(0, i - 5) : i], u[i]) / brute_chance(bad, u[max(0, i - 5) : i], u[i])) for i in range(len(u))]
        assert r.evidence == pytest.approx(np.mean(parts) if parts else 0.0)


def test_quality(spark, docs, none):
    rng = random.Random(6)
    good = [(i, " ".join(rng.choice(["lorem", "ipsum", "dolor", "sit"]) + rng.choice(["", ",", "."]) for _ in range(50)), "en", "s", 1) for i in range(80)]
    bad = [(100 + i, " ".join(["spam***"] * 30), "en", "s", None) for i in range(40)]
    rows = good + bad + [(900, None, None, None, None), (901, "", "en", "s", 0)]
    table = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    labels = spark.createDataFrame([(i, int(i < 100), 0) for i, *_ in good[::2] + bad[::2]] + [(None, 1, 0), (5000, 0, 0)], "doc_id long, quality int, toxic int")
    got = {r.doc_id: r for r in quality.score_documents(table, labels).collect()}
    assert len(got) == len(rows) and all(got[i].kept == (i < 100) for i, *_ in good + bad)
    kept = quality.keep_good(table, labels)
    assert kept.columns == table.columns and {r.doc_id for r in kept.collect()} == {i for i, r in got.items() if r.kept}
    assert quality.keep_good(docs, labels.filter("doc_id < 0")).count() == docs.count() and quality.score_documents(none, labels).count() == 0


def test_pipeline_stages(spark, docs, rows, tmp_path):
    import corpus_pipeline

    texts = dict(rows)
    exact = corpus_pipeline.exact(spark, docs, str(tmp_path))
    near = corpus_pipeline.near(spark, exact, str(tmp_path))
    kept = [r.doc_id for r in exact.select("doc_id").collect()]
    classes = near_classes([(i, texts[i]) for i in kept])
    assert sorted(r.doc_id for r in near.collect()) == sorted(i for i, (_, c) in classes.items() if c == i)
    assert corpus_pipeline.packing(spark, near, "").count() == near.count()


def test_pipeline_near_with_null_and_repeated_ids(spark):
    import corpus_pipeline

    rng = random.Random(12)
    words = lambda n=60: [f"w{rng.randrange(4000)}" for _ in range(n)]
    near = lambda w, k=1: " ".join(["edited", *w[1:-k], *["last"] * k])
    a, b, c, d = words(), words(), words(), words()
    clean = [" ".join(words()) for _ in range(4)]
    rows = [(1, " ".join(a)), (None, near(a)),  # a null id near one that has an id
            (None, clean[0]), (None, clean[1]),
            (2, " ".join(b)), (7, near(b)), (7, clean[2]),  # an id on a near copy and on a clean text
            (None, " ".join(c)), (None, near(c)), (None, near(c, 2)),  # null ids alone
            (9, " ".join(d)), (9, near(d)), (9, near(d)),  # one id alone, a row of it twice
            (11, clean[3]), (11, clean[3]), (None, ""), (None, None), (12, " ")]
    kept = corpus_pipeline.near(spark, spark.createDataFrame(rows, "doc_id long, text string").repartition(3), "").collect()
    got = sorted((r.doc_id or 0, r.text or "") for r in kept)
    sure = [(1, " ".join(a)), (0, clean[0]), (0, clean[1]), (2, " ".join(b)), (7, clean[2]), (11, clean[3]), (0, ""), (0, ""), (12, " ")]
    rest = [x for x in got if x not in sure]
    assert sorted(x for x in got if x in sure) == sorted(sure)
    assert len(rest) == 2 and rest[0] in [(0, " ".join(c)), (0, near(c)), (0, near(c, 2))] and rest[1] in [(9, " ".join(d)), (9, near(d))]
