"""Alphabets, repeated ids, clashing columns and SQL of the training-data operators."""

from __future__ import annotations

import os
import random
import re

import duckdb
import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from ledgerline.llm import bpe, decontaminate, language, near_dup, pu_quality, queries, rules, secrets, sharding, token_counts
from ledgerline.llm.rows import free_name, numbered
from ledgerline.llm.text import chunks

SF = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"

# --------------------------------------------------------------------------
# Language: a naive longest-match parse
# --------------------------------------------------------------------------

SAMPLES = {
    "en": "the river runs down to the sea and the town lies by the river",
    "de": "der fluss läuft hinab zum meer und die stadt liegt am fluss",
    "el": "το ποτάμι κυλά προς τη θάλασσα και η πόλη είναι δίπλα στο ποτάμι",
    "ja": "川は海へ流れて町は川のそばにあります山の向こうに村がある",
    "ru": "река течёт к морю и город стоит у реки за горой есть деревня",
}


def naive_phrases(text: bytes, sample: bytes, block: int) -> int:
    """Longest phrases of the sample, left to right; a byte that the sample lacks ends the phrase it stands in."""
    count = 0
    for at in range(0, len(text), block):
        part, i = text[at : at + block], 0
        while i < len(part):
            n = 0
            while i + n < len(part) and part[i : i + n + 1] in sample:
                n += 1
            if i + n < len(part) and part[i + n : i + n + 1] not in sample:
                n += 1  # the foreign byte belongs to the phrase that it ends
            count += 1
            i += n
    return count


@pytest.mark.parametrize("names", [("en", "de"), ("en", "ru"), ("el", "en", "ja"), tuple(SAMPLES)])
def test_phrases_equal_a_naive_parse(names, monkeypatch):
    monkeypatch.setattr(language, "BLOCK", 40)
    samples = {n: SAMPLES[n].encode() for n in names}
    parser = language.CrossParser(samples)
    rng = random.Random(len(names))
    letters = "".join(SAMPLES.values()) + "xyzжщ語ß "
    texts = ["".join(rng.choice(letters) for _ in range(rng.randint(0, 60))) for _ in range(60)]
    texts += [s[i : i + 25] for s in SAMPLES.values() for i in range(0, 40, 7)]
    run = next(chunks(pa.array(texts)))
    data, offsets = language.normalise(run)
    got = parser.phrases(data, offsets)
    for i in range(len(texts)):
        row = data[offsets[i] : offsets[i + 1]].tobytes()
        want = [naive_phrases(row, samples[n], 40) for n in sorted(names)]
        assert got[i].tolist() == want, texts[i]


def test_languages_of_several_alphabets(spark):
    rng = random.Random(4)
    rows = []
    for i in range(600):
        lang = rng.choice(list(SAMPLES))
        text = SAMPLES[lang]
        at = rng.randrange(len(text) // 2)
        rows.append((i, text[at : at + rng.randint(12, 40)], lang, "s", 0))
    docs = spark.createDataFrame(rows, SCHEMA)
    model = language.fit(docs.where("doc_id % 3 <> 0"))
    got = {r.doc_id: r.lang_pred for r in language.predict(docs, model).collect()}
    right = sum(got[i] == lang for i, _, lang, *_ in rows if i % 3 == 0)
    assert right >= 0.97 * 200


# --------------------------------------------------------------------------
# Repeated ids
# --------------------------------------------------------------------------


def test_repeated_ids_confirm_one_pair(spark, monkeypatch):
    base = " ".join(f"w{i}" for i in range(60))
    rows = [(1, base, None, None, 0)] * 300 + [(2, base + " end", None, None, 0)] * 300
    rows += [(3, f"other text number {i} of this id here", None, None, 0) for i in range(50)]
    seen = spark.sparkContext.accumulator(0)
    real = near_dup._confirm

    def counting(batches):
        for batch in batches:
            seen.add(batch.num_rows)
            yield from real(iter([batch]))

    monkeypatch.setattr(near_dup, "_confirm", counting)
    got = near_dup.near_duplicates(spark.createDataFrame(rows, SCHEMA)).collect()
    assert len(got) == len(rows)
    assert {(r.doc_id, r.component_id, r.kept) for r in got} == {(1, 1, True), (2, 1, False), (3, 3, True)}
    assert 1 <= seen.value <= 60  # pairs of classes, not of rows


def test_wide_bands_are_compared_in_parts(spark, monkeypatch):
    monkeypatch.setattr(near_dup, "BAND_PART", 3)
    common = [f"c{i}" for i in range(40)]
    rng = random.Random(2)
    texts = {}
    for i in range(60):  # a loose cloud: most pairs below the threshold, some above
        own = [f"x{rng.randrange(9)}y{j}" for j in range(rng.randint(0, 14))]
        texts[i] = " ".join(common[: rng.randint(30, 40)] + own)

    def shingles(t):
        w = t.split()
        return {tuple(w[k : k + 5]) for k in range(len(w) - 4)}

    sets = {i: shingles(t) for i, t in texts.items()}
    root = {i: i for i in sets}
    for _ in range(60):
        for a in sets:
            for b in sets:
                n = len(sets[a] & sets[b])
                if a < b and 100 * n >= 75 * len(sets[a] | sets[b]):
                    root[a] = root[b] = min(root[a], root[b])
    docs = spark.createDataFrame([(i, t, None, None, 0) for i, t in texts.items()], SCHEMA)
    got = {r.doc_id: r.component_id for r in near_dup.near_duplicates(docs).collect()}
    assert got == root


def test_secret_sample_counts_documents(spark, monkeypatch):
    monkeypatch.setattr(secrets, "SAMPLE_DOCS", 300)
    rows = [(i, f"token = abc{i}def{i} and name_{i}x", None, None, 0) for i in range(800)]
    whole = secrets.samples_from(spark.createDataFrame(rows, SCHEMA)).distinct().count()
    hot = min(rows, key=lambda r: r[0])
    rows += [(hot[0], hot[1], None, None, 0)] * 700
    many = secrets.samples_from(spark.createDataFrame(rows, SCHEMA))
    assert many.distinct().count() >= 0.9 * whole
    assert many.count() <= 2 * many.distinct().count()


# --------------------------------------------------------------------------
# Row numbers
# --------------------------------------------------------------------------


def test_row_numbers_come_from_files(spark, tmp_dir):
    path = f"{tmp_dir}/docs"
    spark.range(1000).select("id", F.lit("x").alias("__row"), F.lit(1).alias("__path")).repartition(5).write.parquet(path)
    docs = spark.read.parquet(path)
    name = free_name("__row", docs.columns)
    assert name == "__row_"
    one = {r.id: r[name] for r in numbered(docs, name).collect()}
    two = {r.id: r[name] for r in numbered(docs.repartition(3), "n").withColumnRenamed("n", name).collect()}
    assert len(set(one.values())) == 1000 and len(set(two.values())) == 1000
    assert one == {r.id: r[name] for r in numbered(docs.select("__row", "id"), name).orderBy("id").collect()}
    assert set(numbered(docs, name).columns) == {"id", "__row", "__path", name}


# --------------------------------------------------------------------------
# Decontamination against dynamic programming
# --------------------------------------------------------------------------


def least_distance(item: str, text: str) -> int:
    row = np.zeros(len(text) + 1, int)
    for c in item:
        new = np.empty_like(row)
        new[0] = row[0] + 1
        for j, d in enumerate(text, 1):
            new[j] = min(row[j] + 1, new[j - 1] + 1, row[j - 1] + (c != d))
        row = new
    return int(row.min())


def test_items_are_found_within_their_budget(spark):
    rng = random.Random(8)
    vocabulary = ["lorem", "ipsum", "dolor", "amet", "elit", "magna", "quis", "nisi"]
    items = [" ".join(rng.choice(vocabulary) for _ in range(12)) for _ in range(8)]
    rows = []
    for i in range(80):
        item = list(rng.choice(items))
        for _ in range(rng.randint(0, 6)):
            at, kind = rng.randrange(len(item)), rng.randrange(3)
            item[at : at + (kind != 1)] = [] if kind == 0 else [rng.choice("abcxyz")]
        rows.append((i, f"some words {''.join(item)} go on", None, None, 0))
    docs = spark.createDataFrame(rows, SCHEMA)
    bench = spark.createDataFrame(list(enumerate(items)), "item_id long, text string")
    got = {(r.doc_id, r.item_id): r.distance for r in decontaminate.find_items(docs, bench).collect()}
    assert got
    fold = lambda t: re.sub(r"[^a-z0-9]+", " ", t.lower()).strip()
    for i, text, *_ in rows:
        for k, item in enumerate(items):
            d, budget = least_distance(fold(item), fold(text)), len(fold(item)) // 20
            assert ((i, k) in got) == (d <= budget), (text, item, d)


# --------------------------------------------------------------------------
# n-grams of the quality rules
# --------------------------------------------------------------------------


def test_ngrams_equal_a_plain_count():
    texts = ["", "a", "été à l'été à l'été", "日本語 日本語の本 x", "one two one two three", "ab\n\tab  ab", "😀😀😀😀 ok"]
    run = next(chunks(pa.array(texts)))
    found = rules.features(run)
    weights = np.random.RandomState(0).normal(size=rules.KINDS * rules.WIDTH).astype(np.float32)
    outputs = rules.Model(weights, 1.0, 0.0).output(run)
    for i, text in enumerate(texts):
        words = [w for w in re.split("[ \t-\r]+", text) if w]
        by_word = [tuple(words[k : k + n]) for n in (1, 2) for k in range(len(words) - n + 1)]
        by_char = [text[k : k + n] for n in (3, 4, 5) for k in range(len(text) - n + 1)]
        cells, shares = found[i]
        for first, grams in ((0, by_word), (rules.WIDTH, by_char)):
            counts = sorted(np.unique(np.array([str(g) for g in grams]), return_counts=True)[1]) if grams else []
            own = (cells >= first) & (cells < first + rules.WIDTH)
            assert sorted(shares[own]) == pytest.approx([rules.SCALE * c / len(grams) for c in counts])
        assert outputs[i] == pytest.approx(float((weights[cells] * shares).sum()), abs=1e-4)


def test_calibration_of_separable_outputs():
    z = np.array([-3.0, -2.5, -2.0, 5.0, 6.0, 7.0])
    slope, shift = rules._calibrate(z, np.array([0.0, 0, 0, 1, 1, 1]))
    assert 0 < slope < 10
    p = 1 / (1 + np.exp(-(slope * z + shift)))
    assert p[:3].max() < 0.3 < p[3:].min()


# --------------------------------------------------------------------------
# Clashing columns, empty tables, SQL
# --------------------------------------------------------------------------

CLASHES = ["verdict", "__verdict", "score", "lang_pred", "spans", "base_spans", "ids", "n_tokens", "decoded", "band",
           "component_id", "n", "id", "__row", "h", "draw", "quality", "label", "shard", "slot", "key", "order", "words"]


@pytest.fixture(scope="module")
def clashing(spark):
    rows = [(i, t, "en", "s", 1) for i, t in enumerate([None, "", "plain words of a text " * 8, "password = abcdefgh1", "été 日本"])]
    docs = spark.createDataFrame(rows * 2, SCHEMA)
    return docs.withColumns({c: F.lit("mine") for c in CLASHES})


def test_operators_take_tables_with_their_own_column_names(spark, clashing):
    plain = clashing.select("doc_id", "text", "lang", "source", "n_chars")
    labels = spark.createDataFrame([(2, 1, 0), (3, 0, 0)], "doc_id long, quality int, toxic int")
    labels = labels.withColumns({"score": F.lit("mine"), "draw": F.lit("mine"), "text": F.lit("mine")})
    items = spark.createDataFrame([(1, "plain words of a text plain words of a text", "mine")], "item_id long, text string, doc_id string")
    model = language.fit(plain)
    runs = {
        "language": lambda d: language.predict(d, model),
        "near_dup": near_dup.near_duplicates,
        "keep_one": near_dup.keep_one,
        "leaks": lambda d: decontaminate.drop_leaks(d, items),
        "items": lambda d: decontaminate.find_items(d, items),
        "secrets": lambda d: secrets.scan(d, secrets.fit(secrets.samples_from(d))),
        "mask": lambda d: secrets.mask(d, secrets.fit(secrets.samples_from(d))),
        "bpe": lambda d: bpe.digests(d, bpe.RANKS),
        "pu": lambda d: pu_quality.score(d, pu_quality.fit(d, labels)),
        "rules": lambda d: rules.judge(d, rules.fit(d, labels)),
        "tokens": lambda d: token_counts.build(d.select(*[c for c in ("doc_id", "text", "band") if c in d.columns])),
        "shards": lambda d: sharding.histogram_shards(d, F.xxhash64("text"), F.col("doc_id"), F.length("text"), 3),
    }
    for name, run in runs.items():
        with_more, without = run(clashing), run(plain)
        assert with_more.count() == without.count(), name
        assert run(clashing.where("1 = 0")).count() == 0, name


def test_stages_keep_other_columns(spark, clashing, tmp_dir):
    os.makedirs(f"{tmp_dir}/sf")
    items = spark.createDataFrame([(1, "plain words of a text plain words of a text")], "item_id long, text string")
    items.write.parquet(f"{tmp_dir}/sf/benchmark.parquet")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, clashing, f"{tmp_dir}/sf").columns == clashing.columns, name


@pytest.mark.skipif(not os.path.isdir(SF), reason="test data not present")
@pytest.mark.parametrize("key", sorted(queries.ORACLE))
def test_query_equals_its_sql(spark, key):
    con = duckdb.connect()
    for table in ("documents", "embeddings", "pages"):
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM read_parquet('{SF}/{table}.parquet')")
    found = con.execute(queries.ORACLE[key])
    names = [d[0] for d in found.description]
    want = sorted(found.fetchall(), key=repr)
    got = sorted((tuple(r[c] for c in names) for r in queries.QUERIES[key](spark, SF).collect()), key=repr)
    assert got == want
