"""Weighted fingerprints, collocations and whitening against brute force."""

import hashlib
import math
import random
from collections import Counter, defaultdict
from fractions import Fraction

import numpy as np
import pytest
import xxhash
from llm_helpers import SF, prose, same
from pyspark.sql import functions as F

from tabletrust.llm import collocations, weighted_sampling, whitening

# fingerprints

MASK = (1 << 64) - 1


def h64(*longs):
    """Spark's xxhash64 of longs or, as 4 bytes, of ints given as (value,)."""
    seed = 42
    for x in longs:
        data = x[0].to_bytes(4, "little", signed=True) if isinstance(x, tuple) else (x & MASK).to_bytes(8, "little")
        seed = xxhash.xxh64_intdigest(data, seed)
    return seed


def brute_draw(term, weight, j, seed=1):
    """r, c ~ Gamma(2, 1) and beta ~ U(0, 1) of a term and a position, and
    what they give: (t, a)."""
    h = h64((term & MASK) ^ h64((seed,), (j,)))
    a = -math.log1p(-((h >> 28) + 0.5) / 2.0**36)
    y, u = (((h64(h, (i,)) >> 11) + 0.5) / 2.0**53 for i in (1, 2))
    z = 1 - math.log(u) / a
    r, c = math.log(z) - math.log(y), a * z
    beta = -math.log(y) / r
    t = math.floor(math.log(weight) / r + beta)
    return t, c * math.exp(-r * (t - beta + 1)), r, c, beta


def generalised_jaccard(a, b):
    keys = a.keys() | b.keys()
    return sum(min(a.get(k, 0), b.get(k, 0)) for k in keys) / sum(max(a.get(k, 0), b.get(k, 0)) for k in keys)


def test_draws_have_their_laws():
    draws = [brute_draw(term, 1, j)[2:] for term in range(2000) for j in range(4)]

    def distance(values, cdf):
        values = sorted(values)
        return max(abs(cdf(x) - (i + 0.5) / len(values)) for i, x in enumerate(values))
    gamma = lambda x: 1 - math.exp(-x) * (1 + x)
    for values, cdf in zip(zip(*draws), (gamma, gamma, lambda x: x), strict=True):
        assert distance(values, cdf) < 1.63 / math.sqrt(len(values))


def test_samples_are_the_smallest_draws(spark):
    rng = random.Random(3)
    bags = {i: {rng.randrange(-2**63, 2**63): rng.choice([1.0, 1.0, 2.0, 7.0, 0.25, 3.5]) for _ in range(rng.randint(1, 40))} for i in range(30)}
    rows = [(i, [(t, w) for t, w in bag.items()]) for i, bag in bags.items()]
    rows += [(100, []), (101, None), (102, [(5, 0.0), (6, None), (None, 1.0)]), (103, [(7, -1.0), (8, 1.0)])]
    df = spark.createDataFrame(rows, "id int, bag array<struct<term:bigint,weight:double>>").repartition(3)
    got = {r.id: r.sig for r in weighted_sampling.weighted_samples(df, ["id"], samples=16).collect()}
    assert got[100] == got[101] == got[102] == [] and len(got[103]) == 16
    winner, sample = {}, defaultdict(set)
    for i, bag in bags.items():
        for j in range(16):
            win = min(bag, key=lambda t: brute_draw(t, bag[t], j)[1])
            winner[i, j] = win, brute_draw(win, bag[win], j)[0]
            sample[winner[i, j], j].add(got[i][j])
    assert all(len(s) == 1 for s in sample.values())
    assert len({next(iter(s)) for s in sample.values()}) == len(sample)


def test_collision_rate_is_generalised_jaccard(spark):
    rng = random.Random(8)
    pairs = [({1: 10.0, 2: 1.0}, {1: 10.0}), ({1: 3.0, 2: 1.0, 3: 1.0}, {1: 1.0, 2: 2.0, 3: 1.0}), ({1: 0.5, 2: 4.0}, {1: 0.75, 2: 4.0, 3: 0.25})]
    pairs += [({t: float(rng.randint(1, 5)) for t in range(40)}, {t: float(rng.randint(1, 5)) for t in range(20, 50)}) for _ in range(2)]
    rows = [(2 * i + k, [(t, w) for t, w in bag.items()]) for i, pair in enumerate(pairs) for k, bag in enumerate(pair)]
    df = spark.createDataFrame(rows, "id int, bag array<struct<term:bigint,weight:double>>")
    hits = Counter()
    for seed in range(12):
        sig = {r.id: r.sig for r in weighted_sampling.weighted_samples(df, ["id"], 64, seed).collect()}
        for i in range(len(pairs)):
            hits[i] += sum(a == b for a, b in zip(sig[2 * i], sig[2 * i + 1], strict=True))
    for i, (a, b) in enumerate(pairs):
        want = generalised_jaccard(a, b)
        assert abs(hits[i] / 768 - want) < 4 * math.sqrt(want * (1 - want) / 768) + 0.005


def brute_bag(text, n=5):
    import re
    words = re.findall(r"[฀-໿぀-ヿ一-鿿]|[^\x20\x09-\x0D฀-໿぀-ヿ一-鿿]+", (text or "").lower())
    return Counter(tuple(words[i:i + n]) for i in range(max(1, len(words) - n + 1))) if words else Counter()


def test_edited_texts_and_likeness(spark):
    rng = random.Random(5)
    texts = [prose(rng, rng.randint(1, 300)) for _ in range(150)] + [None, "", "one", "東京の図書館は来月から", " \n ", "a b a b a b a b a b a b a b"]
    texts[40] = texts[41] = texts[42]
    rng.shuffle(texts)
    ids = sorted(rng.sample(range(1000), len(texts)))
    rows = list(zip(ids, texts, strict=True))
    rng.shuffle(rows)
    got = {r.doc_id: r for r in weighted_sampling.edited_fingerprints(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    errors = []
    for i, (doc, text) in enumerate(zip(ids, texts, strict=True)):
        text, after = text or "", texts[(i + 1) % len(texts)] or ""
        cut = len(text) // 4
        edited = text[: len(text) - cut] + after[:cut]
        r = got[doc]
        assert r.n_chars == len(text) and r.edited_sha256 == hashlib.sha256(edited.encode()).hexdigest()
        bags = [brute_bag(t) for t in (text, edited, after)]
        for near, other in ((r.near_edited, bags[1]), (r.near_next, bags[2])):
            want = generalised_jaccard(bags[0], other) if bags[0] and other else float(not bags[0] and not other)
            errors.append(near - want)
            assert abs(near - want) < 0.3 and (0 < want < 1 or near == want)
        assert (r.fingerprint == r.edited_fingerprint) >= (text == edited)
    assert abs(np.mean(errors)) < 0.01 and np.std(errors) < 0.06
    prints = defaultdict(set)
    for doc, text in rows:
        prints[text or ""].add(got[doc].fingerprint)
    assert all(len(p) == 1 for p in prints.values())


def test_fingerprints_of_odd_rows(spark, odd, odd_rows, clashing, empty):
    run = weighted_sampling.edited_fingerprints
    out = run(odd)
    assert run(empty).collect() == [] and same(out, run(clashing))
    rows = out.collect()
    assert Counter(r.doc_id for r in rows) == Counter(r[0] for r in odd_rows)
    whole = {r.fingerprint for r in weighted_sampling.fingerprints(odd.where("doc_id = 0")).collect()}
    assert len(whole) == 1 and {r.fingerprint for r in rows if r.doc_id == 0} == whole
    # Two of the three equal rows have an equal text next.
    assert sorted(r.near_next == 1 for r in rows if r.doc_id == 0) in ([False, True, True], [True, True, True])


def test_many_equal_rows_each_get_one(spark, monkeypatch):
    monkeypatch.setattr(weighted_sampling, "EQUAL", 4)
    text = "one two three four five six seven eight"
    rows = [(None, text)] * 50 + [(1, "a b c d e f g h i")] + [(2, text)] * 3
    out = weighted_sampling.edited_fingerprints(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert Counter(r.doc_id for r in out) == {None: 50, 1: 1, 2: 3}
    assert sum(r.near_next == 1 for r in out if r.doc_id is None) == 49 and sum(r.near_next == 1 for r in out if r.doc_id == 2) == 3


# collocations

def brute_collocations(rows, longest=3, min_count=10, top=2000, covered=50):
    import re
    f, n = Counter(), Counter()
    for lang, text in rows:
        lang = lang or "und"
        low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
        for piece in re.split("[.,;:!?\n-\r]", low):
            w = [x for x in re.split("[ \t]+", piece) if x]
            n[lang] += len(w)
            for m in range(1, longest + 1):
                f.update((lang, tuple(w[i:i + m])) for i in range(len(w) - m + 1))
    out = defaultdict(list)
    often = {k: a for k, a in f.items() if len(k[1]) > 1 and a >= min_count}
    over = defaultdict(int)
    for (lang, w), a in often.items():
        for m in range(2, len(w)):
            for i in range(len(w) - m + 1):
                over[lang, w[i:i + m]] = max(over[lang, w[i:i + m]], a)
    for (lang, w), a in often.items():
        if 100 * over[lang, w] >= covered * a:
            continue
        score, _, left, right = min((10**6 * a * a // (f[lang, w[:k]] * f[lang, w[k:]]), k, f[lang, w[:k]], f[lang, w[k:]]) for k in range(1, len(w)))
        out[lang].append((-score, -a, " ".join(w).encode(), left, right))
    return sorted((lang, i, p.decode(), -a, left, right, n[lang], -score) for lang, found in out.items()
                  for i, (score, a, p, left, right) in enumerate(sorted(found)[:top], 1))


def wordy(rng, n):
    common = ["the", "of", "new", "york", "city", "é", "x y", "Ä", "state", "in"]
    return "".join(rng.choice(common + [f"w{rng.randrange(300)}"]) + rng.choice([" ", " ", " ", "\t", "  ", ". ", ",", "\n", "\r", "\x0b", "\x85"]) for _ in range(n))


@pytest.fixture(scope="module")
def phrase_rows():
    rng = random.Random(11)
    rows = [(rng.choice(["a", "b", None, "und", "x\ny"]), wordy(rng, rng.randint(0, 300))) for _ in range(150)]
    copy = wordy(rng, 60) + " " + "z" * 70 + " yes " + "z" * 70
    return rows + [("a", None), (None, ""), ("b", " . ,, \n"), ("c", "one")] + [("a", copy)] * 40


@pytest.mark.parametrize("params", [{}, {"rate": 0.05}, {"rate": 1.0, "lowered": 0.1}, {"longest": 5, "min_count": 4}, {"longest": 2, "top": 5}, {"bits": 6}])
def test_collocations_match_brute_force(spark, phrase_rows, params, monkeypatch):
    if "rate" in params:  # small stretches cut pieces between words
        monkeypatch.setattr(collocations, "STRETCH", 500)
    df = spark.createDataFrame(phrase_rows, "lang string, text string").repartition(5)
    got = collocations.collocations(df, **params).collect()
    want = brute_collocations(phrase_rows, **{k: v for k, v in params.items() if k in ("longest", "min_count", "top")})
    assert len(want) > 4 and sorted(map(tuple, got)) == want


def test_collocations_of_long_texts_and_odd_rows(spark, odd, odd_rows, clashing, empty):
    out = collocations.collocations(odd, min_count=2)
    assert same(out, collocations.collocations(clashing, min_count=2)) and collocations.collocations(empty).collect() == []
    assert sorted(map(tuple, out.collect())) == brute_collocations([(r[2], r[1]) for r in odd_rows], min_count=2)


def test_keys_of_a_bucket_travel_in_four_bytes():
    rng = np.random.default_rng(3)
    for bits in (10, 17, 30):
        keys = np.sort(rng.integers(0, 1 << (64 - bits), 3000, np.uint64)) | (np.uint64(5) << np.uint64(64 - bits))
        sent = collocations._steps(keys, bits)
        assert len(sent) <= 4 * len(keys)
        got = collocations._from_steps(np.frombuffer(sent, np.uint8), 5, bits)
        cut = np.uint64(32 - bits)
        assert (got >> cut == keys >> cut).all()
    counts = rng.integers(1, 1 << 40, 100, np.int64)
    assert (collocations._from_planes(np.frombuffer(collocations._planes(counts), np.uint8), np.int64) == counts).all()


def test_border_keys_take_two_bytes_and_names_few_rows(spark):
    rng = np.random.default_rng(4)
    keys = np.unique(rng.integers(0, 1 << 64, 1 << 21, np.uint64))
    keys = keys[keys >> np.uint64(54) == np.uint64(5)]
    sent = np.frombuffer(collocations._steps(keys, 10, collocations.BORDER), np.uint8)
    assert not sent.reshape(4, -1)[3].any() and np.mean(sent.reshape(4, -1)[2] > 0) < 0.05
    got = collocations._from_steps(sent, 5, 10, collocations.BORDER)
    assert (got >> np.uint64(30) == keys >> np.uint64(30)).all()
    docs = spark.createDataFrame([("a", bytearray(" ".join(f"w{i}" for i in range(3000)), "utf-8"))], "lang string, text binary").coalesce(1)
    real, rows = type(docs).repartition, []
    try:
        type(docs).repartition = lambda self, *a: (rows.extend(self.collect()), real(self, *a))[1]
        counted = collocations._counted(docs, range(1, 2), {}, {}, True, 1).collect()
    finally:
        type(docs).repartition = real
    assert sum(r.n for r in counted if r.words == 1) == 3000
    assert len([r for r in rows if r.words == 1]) <= 1024 >> collocations.WIDER


def test_phrases_are_whole_at_cuts():
    rng = random.Random(2)
    text = wordy(rng, 3000).encode().translate(collocations._PLAIN)
    for longest in (2, 3, 5):
        old, collocations.STRETCH = collocations.STRETCH, 300
        try:
            parts = list(collocations.stretches(text, longest))
        finally:
            collocations.STRETCH = old
        got, want = Counter(), Counter()
        for part, own in [*parts, (text, len(text))]:
            w = collocations.Words(part, own, np.uint64(0))
            words = [part[a:b] for a, b in zip(w.starts, w.ends, strict=True)]
            into = want if part is text else got
            for i in range(w.own):
                for m in range(1, longest + 1):
                    if i + m <= len(words) and all(w.joined[i:i + m - 1]):
                        into[tuple(words[i:i + m])] += 1
        assert len(parts) > 10 and got == want


# whitening

def check_whitened(rows, out, k=8):
    good = [(i, v) for i, v in rows if v and all(c is not None and math.isfinite(c) for c in v)]
    x = [[math.floor(Fraction(1024) * Fraction(np.float32(c).item())) + 100_000 for c in v] for _, v in good]
    n, dims = len(x), len(x[0])
    s = [sum(r[d] for r in x) for d in range(dims)]
    c = np.array([[float(Fraction(r[d] * n - s[d], n)) for d in range(dims)] for r in x])
    values, vectors = np.linalg.eigh(c.T @ c / n)
    values, vectors = values[::-1], vectors[:, ::-1]
    count = min(k, dims, int((values > 1e-9 * values.sum()).sum()))
    assert Counter(r.vec_id for r in out) == Counter(i for i, _ in good for _ in range(count))
    deviations = defaultdict(set)
    for (i, _), r in zip(good, x, strict=True):
        deviations[i].add(sum((n * a - b) ** 2 for a, b in zip(r, s, strict=True)))
    assert all(r.n == n and int(r.deviation) in deviations[r.vec_id] for r in out)
    assert len({r.identity_error for r in out}) == 1 and out[0].identity_error < 1e-9
    explained = {r.component: r.explained for r in out}
    assert np.allclose([explained[j + 1] for j in range(count)], values[:count] / values.sum(), rtol=1e-9)
    y = defaultdict(dict)
    for r in out:
        if r.vec_id is not None and len(deviations[r.vec_id]) == 1:
            y[r.vec_id][r.component] = r.whitened
    gaps = np.abs(np.diff(values, append=0))
    for j in range(count):
        if min(gaps[j], gaps[j - 1] if j else np.inf) > 1e-6 * values[0]:
            want = np.array([c[a] @ vectors[:, j] / math.sqrt(values[j]) for a, (i, _) in enumerate(good) if i in y])
            got = np.array([y[i][j + 1] for i, _ in good if i in y])
            assert min(np.abs(got - want).max(), np.abs(got + want).max()) < 1e-6


@pytest.mark.parametrize("dims", [1, 3, 40, 90])
def test_whitening_matches_eigh(spark, dims):
    rng = np.random.default_rng(dims)
    x = (rng.normal(size=(400, dims)) / np.arange(1, dims + 1) ** 0.3).astype(np.float32).tolist()
    x[50:200] = [x[0]] * 150
    nan, inf = float("nan"), float("inf")
    rows = list(enumerate(x)) + [(None, x[3]), (7, x[9]), (900, None), (901, []), (902, [nan] * dims), (903, [inf] * dims), (904, [None] * dims), (905, [0.5] * (dims + 1))]
    df = spark.createDataFrame([(i, v, 0, 0.0) for i, v in rows], "vec_id long, embedding array<float>, n int, whitened double").repartition(3)
    check_whitened(rows[:-1], whitening.whiten(df).collect())


def test_whitening_of_few_directions(spark):
    rng = np.random.default_rng(1)
    x = (rng.normal(size=(60, 2)) @ np.round(rng.normal(size=(2, 24)) * 64) / 8).round().astype(np.float32)
    rows = [(i, (v / 1024).tolist()) for i, v in enumerate(x)]
    frame = lambda r: spark.createDataFrame(r, "vec_id long, embedding array<float>")
    check_whitened(rows, whitening.whiten(frame(rows)).collect())
    assert whitening.whiten(frame([])).collect() == [] and whitening.whiten(frame([(i, [1.0, 2.0]) for i in range(9)])).collect() == []
    assert whitening.whiten(frame([(1, None)])).collect() == []
    with pytest.raises(Exception, match="exact sums"):
        whitening.whiten(frame([(1, [1e30, 1.0]), (2, [0.0, 1.0])])).collect()
    big = [(i, [float(2**38 * (i % 3)), float(i)]) for i in range(50)]
    check_whitened(big, whitening.whiten(frame(big)).collect())


def test_jacobi_davidson_needs_minres_and_restarts():
    rng = np.random.default_rng(4)
    q = np.linalg.qr(rng.normal(size=(400, 400)))[0]
    values = np.r_[[9, 8, 8, 7.5, 7.4999, 3, 2.99, 2.98], np.linspace(2.9, 0, 392)]
    a = (q * values) @ q.T
    products = []

    def apply(w):
        products.append(w.shape[1])
        return a @ w
    got, vectors = whitening.jacobi_davidson(apply, 400, 8)
    assert np.allclose(got, values[:8], rtol=1e-12) and np.abs(vectors.T @ vectors - np.eye(8)).max() < 1e-12
    assert np.linalg.norm(a @ vectors - vectors * got, axis=0).max() < 1e-12 * 9 and sum(products) < 400 * 8
    b = rng.normal(size=(400, 3))
    x = whitening.minres(lambda y: a @ y - 5 * y, b, 400, 1e-10)
    assert np.linalg.norm(a @ x - 5 * x - b, axis=0).max() < 1e-7


def test_queries_have_their_columns(spark):
    import __spark_entry__ as entry
    q = entry.queries()
    w = q["op11_jacobi_davidson_whitening"](spark, SF)
    assert dict(w.dtypes) == {"vec_id": "bigint", "component": "int", "n": "bigint", "deviation": "bigint", "whitened": "double", "explained": "double", "identity_error": "double"}
    f = q["op12_weighted_fingerprints"](spark, SF)
    assert f.columns == ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"]
    assert f.agg(F.count(F.lit(1)), F.min("near_edited") >= 0, F.max("near_next") <= 1).first()[0] == 1000
