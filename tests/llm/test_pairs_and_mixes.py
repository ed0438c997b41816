"""Hard negatives, spelling variants and source mixing against brute force."""

from __future__ import annotations

import collections
import itertools
import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from ledgerline.llm import mixing, negatives, variants

# --------------------------------------------------------------------------
# Hard negatives
# --------------------------------------------------------------------------

VECTORS = "vec_id long, label int, embedding array<double>, score string, block int"


def mined(rows, anchor=lambda i: i % 5 == 0):
    """The same by sorting all pairs in Python."""
    clean = set()
    for i, label, v, *_ in rows:
        if i is None or label is None or v is None or any(x is None or not np.isfinite(x) for x in v):
            continue
        clean.add((i, label, tuple(v)))
    quant = [(i, label, [int(np.floor(256 * x)) for x in v]) for i, label, v in clean]
    out = []
    for i, label, v in quant:
        if not anchor(i):
            continue
        scored = sorted(
            ((sum(a * b for a, b in zip(v, w, strict=False)), j, other) for j, other, w in quant if j != i),
            key=lambda t: (-t[0], t[1]),
        )
        for p, j, _ in [t for t in scored if t[2] == label][:5]:
            found = [t for t in scored if t[2] != label and 50 * p <= 100 * t[0] <= 95 * p][:3]
            out += [(i, j, r, k, p, s) for r, (s, k, _) in enumerate(found, 1)]
    return sorted(out)


def run_negatives(spark, rows):
    df = spark.createDataFrame(rows, VECTORS)
    return sorted(tuple(r) for r in negatives.hard_negatives(df, F.col("vec_id") % 5 == 0).collect())


@pytest.mark.parametrize("width", [3, 8, 21])
def test_hard_negatives_equal_brute_force(spark, width, monkeypatch):
    monkeypatch.setattr(negatives, "BLOCK_ROWS", 7)  # several blocks, chunks and tasks
    monkeypatch.setattr(negatives, "CHUNK_ROWS", 16)
    monkeypatch.setattr(negatives, "TASK_SCORES", 200)
    rng = np.random.RandomState(width)
    rows = [(int(i), int(rng.randint(3)), [float(x) for x in rng.normal(0.1, 1, width).round(1)], "x", 1) for i in range(120)]
    rows += [(200 + i, i % 3, [0.5] * width, None, None) for i in range(12)]  # ties
    rows += rows[:3]  # repeated rows
    rows += [(300, 1, [40.0] * width, "", 0), (305, 2, [-1e6] * width, "", 0), (310, 0, [], "", 0), (311, 0, [2.0], "", 0)]
    rows += [
        (None, 1, [1.0] * width, "", 0), (400, None, [1.0] * width, "", 0), (405, 1, None, "", 0),
        (410, 1, [float("nan")] * width, "", 0), (415, 1, [1.0, None, 1.0], "", 0), (420, 0, [float("-inf")], "", 0),
    ]
    want = mined(rows)
    assert len(want) > 50
    assert run_negatives(spark, rows) == want


def test_hard_negatives_of_little(spark):
    assert run_negatives(spark, []) == []
    assert run_negatives(spark, [(1, 1, [1.0], "", 0)]) == []  # no anchor
    assert run_negatives(spark, [(5, 1, [1.0], "", 0), (6, 2, [1.0], "", 0)]) == []  # no positive
    hot = [(5, 1, [float(i)], "", 0) for i in range(40)]  # one id on all rows: no partners
    assert run_negatives(spark, hot) == []


def test_lookup_scores_are_exact():
    rng = np.random.RandomState(1)
    for bits, width in ((3, 5), (12, 64), (40, 17), (62, 9)):
        q = rng.randint(-(1 << bits), 1 << bits, (50, width), dtype=np.int64)
        a = rng.randint(-(1 << 12), 1 << 12, (9, width), dtype=np.int64)
        planes = negatives.bit_planes(q)
        got = negatives.scores(negatives.subset_sums(a, planes.shape[1]), planes)
        with np.errstate(over="ignore"):
            assert (got == q @ a.T).all()  # modulo 2**64
    assert negatives.quantised(np.array([1e300, -1e300, 0.999, -0.001]), 256).tolist() == [2**63 - 1, -(2**63), 255, -1]


# --------------------------------------------------------------------------
# Spelling variants
# --------------------------------------------------------------------------


def one_edit(a: str, b: str) -> bool:
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    a, b = sorted((a, b), key=len)
    return len(b) - len(a) == 1 and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def grouped(words: dict[str, int]):
    near = {w: [v for v in words if v != w and one_edit(w, v)] for w in words}
    form = {}
    for w, n in words.items():
        best = min(near[w], key=lambda v: (-words[v], v), default=None)
        if best is not None and words[best] >= 5 * n:
            form[w] = best

    def root(w):
        while w in form:
            w = form[w]
        return w

    return {(w, form.get(w), root(w), n, len(near[w]), words.get(form.get(w))) for w, n in words.items()}


def many_words(seed: int, letters: str, n: int) -> dict[str, int]:
    rng = random.Random(seed)
    out: dict[str, int] = {}
    while len(out) < n:
        w = "".join(rng.choice(letters) for _ in range(rng.randint(6, 10)))
        out[w] = rng.choice([5, 9, 60, 1000, 80000])
        for _ in range(rng.randint(0, 3)):  # its neighbours
            i, kind = rng.randrange(len(w)), rng.randrange(3)
            v = w[:i] + ("" if kind == 0 else rng.choice(letters)) + w[i + (kind != 1) :]
            if len(v) >= 6:
                out[v] = rng.choice([5, 9, 60, 1000, 80000])
    return out


@pytest.mark.parametrize("letters", ["ab", "abcdeé", "abcdefghijklmnopqrstuvwxyzàÿ"])
def test_variants_equal_brute_force(spark, letters):
    words = many_words(len(letters), letters, 300)
    words |= {letters[0] * k: 50 for k in range(6, 12)} | {letters[0] * 400: 7, letters[0] * 401: 70}
    df = spark.createDataFrame(list(words.items()), "word string, n long")
    got = variants.variants(df).collect()
    assert {tuple(r) for r in got} == grouped(words) and len(got) == len(words)


def test_vocabulary_and_noise(spark):
    texts = {1: "Schön schöner, SCHÖNER schÖner x2y", 2: None, 3: "", 4: "schöner-schöner " * 3 + "abcdef ghijk"}
    rows = [(i, t, "en") for i, t in texts.items()] + [(None, "abcdef " * 5, "de"), (4, "abcdef", None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, n string")
    got = {r.word: r.n for r in variants.vocabulary(docs).collect()}
    assert got == {"schöner": 7, "abcdef": 7}  # only A-Z is lower-cased: SCHÖNER and schÖner are other words
    assert variants.vocabulary(docs.where("1 = 0")).count() == 0
    assert variants.variants(variants.vocabulary(docs.where("1 = 0"))).count() == 0
    hit = next(w for w in (f"{c}abcdeé" for c in map(chr, range(97, 123))) if any(
        zlib.crc32(f"{i}:{w}".encode()) % 199 == 0 for i in range(2000)))
    key = next(i for i in range(2000) if zlib.crc32(f"{i}:{hit}".encode()) % 199 == 0)
    at = zlib.crc32(f"{key}:{hit}".encode()) % len(hit)
    assert variants.noisy(key, hit.encode()).decode() == hit[:at] + hit[at + 1 :]
    assert variants.noisy(key + 1, hit.encode()).decode() == hit


def test_a_task_passes_counts_on_when_it_holds_many(spark, monkeypatch):
    monkeypatch.setattr(variants, "FLUSH_WORDS", 2)
    words = [chr(97 + i) * 6 for i in range(20)]
    docs = spark.createDataFrame([(i, " ".join(words)) for i in range(9)], "doc_id long, text string").coalesce(1)
    assert {r.word: r.n for r in variants.vocabulary(docs).collect()} == dict.fromkeys(words, 9)


def test_pivots_are_disjoint_and_cheapest():
    rng = random.Random(3)
    for _ in range(300):
        word = "".join(rng.choice("abc") for _ in range(rng.randint(6, 12))).encode()
        grams = sorted({word[i : i + 2] for i in range(len(word) - 1)})
        rank = {g: i for i, g in enumerate(grams)}
        frequency = [rng.randint(1, 50) for _ in grams]
        prefix, last = variants.prefix_of(word, rank)
        assert len(prefix) >= 3 and {r for _, r in prefix} <= set(range(last + 1))
        left, right = variants.pivots_of(prefix, len(word), frequency)

        def cost(p, q):
            of = dict(prefix)
            return frequency[of[p]] * 8.0**-p + frequency[of[q]] * 8.0 ** -(len(word) - 2 - q)

        places = [p for p, _ in prefix]
        best = min(cost(p, q) for p in places for q in places if q - p >= 2)
        assert right - left >= 2 and cost(left, right) == pytest.approx(best)


# --------------------------------------------------------------------------
# Mixing
# --------------------------------------------------------------------------


def cheapest(edges, capacity, quota, copies):
    """(flow, repetition cost) of the best whole-number routing, by trying all."""
    best = (0, 0)
    choices = [range(min(copies * capacity[p], quota[s]) + 1) for p, s in edges]
    for flow in itertools.product(*choices):
        used, got = [0] * len(capacity), [0] * len(quota)
        for (p, s), f in zip(edges, flow, strict=True):
            used[p] += f
            got[s] += f
        if any(u > copies * c for u, c in zip(used, capacity, strict=True)) or any(g > q for g, q in zip(got, quota, strict=True)):
            continue
        cost = sum(max(0, u - k * c) for u, c in zip(used, capacity, strict=True) for k in range(1, copies))
        best = max(best, (sum(flow), -cost))
    return best


def test_routes_are_full_and_repeat_least():
    rng = random.Random(5)
    for _ in range(120):
        n_p, n_s = rng.randint(1, 3), rng.randint(1, 3)
        every = [(p, s) for p in range(n_p) for s in range(n_s)]
        edges = sorted(rng.sample(every, rng.randint(1, min(4, len(every)))))
        capacity = [rng.randint(0, 2) for _ in range(n_p)]
        quota = [rng.randint(0, 4) for _ in range(n_s)]
        flow = mixing.route(edges, capacity, quota, 2)
        used, got = [0] * n_p, [0] * n_s
        for (p, s), f in zip(edges, flow, strict=True):
            assert f >= 0
            used[p] += f
            got[s] += f
        assert all(u <= 2 * c for u, c in zip(used, capacity, strict=True))
        assert all(g <= q for g, q in zip(got, quota, strict=True))
        cost = sum(max(0, u - c) for u, c in zip(used, capacity, strict=True))
        assert (sum(flow), -cost) == cheapest(edges, capacity, quota, 2)


def shared(words, total):
    """Targets by the contract's rounds, in exact fractions."""
    from fractions import Fraction

    weight = [(5, 2, 1)[i % 3] for i in range(len(words))]
    fixed: dict[int, Fraction] = {}
    while True:
        rest = total - sum(fixed.values())
        left = [i for i in range(len(words)) if i not in fixed]
        share = {i: rest * weight[i] / sum(weight[j] for j in left) for i in left} if left else {}
        above = {i: Fraction(2 * words[i]) for i in left if share[i] > 2 * words[i]}
        if not above:
            return [float(fixed.get(i, share.get(i))) for i in range(len(words))]
        fixed |= above


def test_targets_equal_the_rounds(spark):
    from fractions import Fraction

    for seed in range(4):
        rng = random.Random(seed)
        words = [rng.choice([0, 3, 50, 700, 9000]) for _ in range(11)]
        names = sorted(f"s{i}" for i in range(10)) + [None]
        total = Fraction(3, 2) * sum(words)
        df = spark.createDataFrame(list(zip(names, words, strict=True)), "source string, words long").repartition(5)
        got = {r.source: r.target for r in mixing.targets(df, float(total)).collect()}
        assert [got[n] for n in names] == pytest.approx(shared(words, total))


def docs_of(spark, rows):
    schema = "doc_id long, text string, source string, size long, taken int, pattern_id int"
    return spark.createDataFrame([(*r, 1, 2, 3) for r in rows], schema)


def test_mix_meets_targets_and_repeats_itself(spark):
    rng = random.Random(9)
    rows = []
    for i in range(3000):
        source = rng.choice(["a"] * 6 + ["b", "c", None])
        rows.append((i, " ".join("w" * 1 for _ in range(rng.choice([0, 1, 7, 30, 400]))), source))
    rows += [(7000, "one two three", "a")] * 500  # one document on many rows
    rows += [(8000, None, "b"), (None, "no id", "c"), (8001, "x " * 5000, "b")]
    df = docs_of(spark, rows)
    mixed = mixing.mix(df, F.array("source"))
    got = mixed.documents.collect()
    assert len(got) == len(rows)
    taken, size = collections.Counter(), collections.Counter()
    for r in got:
        assert 0 <= r.taken <= 2 * r.size and r.taken == r.copies * r.size
        taken[r.sources[0]] += r.taken
        size[r.sources[0]] += r.size
    goals = {r.source: r for r in mixed.sources.collect()}
    assert {s: g.words for s, g in goals.items()} == dict(size)
    names = ["a", "b", "c", None]
    assert [goals[s].target for s in names] == pytest.approx(shared([size[s] for s in names], 1.5 * sum(size.values())))
    for s, g in goals.items():
        assert abs(taken[s] - g.target) <= 4  # the smallest documents have one word
    again = mixing.mix(df.repartition(7), F.array("source")).documents.collect()
    key = lambda r: (r.key or -1, r.size, r.taken)
    assert sorted(map(key, again)) == sorted(map(key, got))


def test_mix_of_overlapping_sources(spark):
    rows = [(i, "w " * (10 + i % 3), None) for i in range(900)]
    df = docs_of(spark, rows)
    member = (
        F.when(F.col("doc_id") < 300, F.array(F.lit("a")))
        .when(F.col("doc_id") < 600, F.array(F.lit("b"), F.lit("a"), F.lit("a")))
        .when(F.col("doc_id") < 800, F.array(F.lit("b")))
        .when(F.col("doc_id") < 850, F.array().cast("array<string>"))
    )
    mixed = mixing.mix(df, member)
    got = mixed.documents.collect()
    by_pattern = collections.Counter()
    for r in got:
        by_pattern[tuple(r.sources or ())] += r.taken
    routed = collections.Counter()
    for r in mixed.routes.collect():
        routed[r.source] += r.words
    goals = {r.source: r.target for r in mixed.sources.collect()}
    assert set(by_pattern) == {("a",), ("a", "b"), ("b",), ()} and by_pattern[()] == 0
    assert sum(by_pattern.values()) == pytest.approx(sum(routed.values()), abs=30)
    for s, words in routed.items():
        assert words <= round(goals[s])
    words = {p: sum(r.size for r in got if tuple(r.sources or ()) == p) for p in by_pattern}
    assert all(by_pattern[p] <= 2 * words[p] for p in words)
    # no document is taken twice while another that could serve the same source is not taken
    assert by_pattern[("a",)] >= words[("a",)] - 12 or by_pattern[("a", "b")] <= words[("a", "b")] + 12


def test_mix_of_nothing(spark):
    empty = docs_of(spark, [(1, "x", "a")]).where("1 = 0")
    assert mixing.mix(empty, F.array("source")).documents.count() == 0
    blank = mixing.mix(docs_of(spark, [(1, None, "a"), (2, " ", None)]), F.array("source"))
    assert sorted(r.taken for r in blank.documents.collect()) == [0, 0]
    assert [r.target for r in blank.sources.collect()] == [0.0, 0.0]


def test_fill_comes_near():
    assert mixing.fill([5, 100, 3], [1, 1, 1], 9) == [1, 0, 1]
    assert mixing.fill([100, 40], [1, 1], 90) == [0, 1]
    assert mixing.fill([7], [5], 24) == [3]
    assert mixing.fill([7], [5], 26) == [4]
    assert mixing.fill([0, 4], [3, 1], 3) == [0, 1]
