"""Spelling variant grouping: words one edit apart, found by pivotal bigrams.

Words are runs of Latin letters with their number of occurrences.  Two words are
near if they differ by exactly one inserted, deleted or replaced code point.

1. ``vocabulary``: one pass over whole texts; every task adds up its own words
   before the shuffle by word.
2. ``gram_order``: how many words hold each bigram.  The alphabet has 90 letters
   (``LETTERS``), so there are at most 8,100 bigrams whatever the input; their
   ranks by (frequency, bigram) are broadcast.
3. A word's prefix is its ``PREFIX`` least ranked bigrams, with all places of the
   last of them.  Of the prefix, dynamic programming along the places chooses two
   disjoint pivots, a left and a right one, of least expected list length (the
   bigram's frequency, divided by ``SPREAD`` for each code point of the side that
   the pivot vouches for).
4. One edit cannot touch both pivots.  If it stands right of the left pivot, that
   pivot and all before it are the same in both words, at the same place; else
   the right pivot and all behind it are, at a place shifted by the difference of
   lengths.  Of two near words, the one whose prefix ends first in the bigram
   order has its surviving pivot in the other's prefix.  So pivots are joined
   with prefix bigrams on (bigram, side, code points of that side), under the
   position limits, a length difference of at most one, and parity bitmaps of
   the letters that differ in at most two cells.
5. Candidates are ids (hashes of words); their words are fetched once for each
   distinct pair and verified by edit distance.  Two words of equal hash are both
   fetched, so an equal hash adds a comparison and loses nothing.

No list is cut: a bigram's list is as long as the words that share it and its side.

Defined results: null text has no words; a null key counts as empty text in the
noise rule; repeated rows count each; an empty table gives no rows; other columns
are not read.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerline.llm.workers import ship
from ledgerline.operators.staging import release, stage, stage_at

LETTERS = "A-Za-zÀ-ÿ"
MIN_LENGTH = 6  # code points; shorter words have too few bigrams for two pivots and a prefix
MIN_COUNT = 5
FORM_RATIO = 5  # a form is at least so many times as frequent as its variant
PREFIX = 3
SPREAD = 8.0
NOISE = 199

FLUSH_WORDS = 200_000  # a task's partial counts are passed on at this many words ...
FLUSH_BYTES = 16 << 20  # ... or this many bytes of them


def noisy(key: object, word: bytes) -> bytes:
    """The word as document ``key`` spells it: one in ``NOISE`` (by hash) loses a code point."""
    h = zlib.crc32(word, zlib.crc32(f"{'' if key is None else key}:".encode()))
    if h % NOISE:
        return word
    text = word.decode()
    at = h % len(text)
    return (text[:at] + text[at + 1 :]).encode()


def _count(spell: Callable[[object, bytes], bytes] | None, min_length: int):
    run = re.compile(f"[{LETTERS}]{{{min_length},}}")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: Counter[bytes] = Counter()
        held = 0

        def flush() -> pa.RecordBatch:
            words = pa.array(list(total.keys()), pa.binary()).cast(pa.string())
            out = pa.RecordBatch.from_arrays([words, pa.array(list(total.values()), pa.int64())], names=["word", "n"])
            total.clear()
            return out

        for batch in batches:
            for key, text in zip(batch.column(0), batch.column(1), strict=True):
                if not text.is_valid:
                    continue
                key = key.as_py()
                for found, n in Counter(run.findall(text.as_py())).items():
                    word = found.encode().lower()  # bytes: A-Z only
                    if spell is not None:
                        word = spell(key, word)
                    if word not in total:
                        held += len(word)
                    total[word] += n
                if len(total) > FLUSH_WORDS or held > FLUSH_BYTES:
                    yield flush()
                    held = 0
        yield flush()

    return count


def vocabulary(
    docs: DataFrame,
    text: str = "text",
    key: str = "doc_id",
    spell: Callable[[object, bytes], bytes] | None = None,
    min_length: int = MIN_LENGTH,
    min_count: int = MIN_COUNT,
) -> DataFrame:
    """(word, n) of all words of at least ``min_length`` code points and ``min_count`` occurrences.

    ``spell(key, word)`` may change a word as its document spells it; a result that
    is too short is no word.
    """
    ship(docs.sparkSession)
    rows = docs.select(F.col(key).alias("key"), F.col(text).cast("string").alias("text"))
    parts = rows.mapInArrow(_count(spell, min_length), "word string, n bigint")
    counted = parts.groupBy("word").agg(F.sum("n").alias("n"))
    return counted.where((F.length("word") >= min_length) & (F.col("n") >= min_count))


def _bigrams(word: Column) -> Column:
    at = F.sequence(F.lit(1), F.length(word) - 1)
    return F.array_distinct(F.transform(at, lambda i: F.substring(word, i, F.lit(2))))


def gram_order(words: DataFrame) -> tuple[dict[bytes, int], list[int]]:
    """(bigram -> rank, frequency of each rank); at most 90 * 90 bigrams exist."""
    grams = words.select(F.explode(_bigrams(F.col("word"))).alias("gram"))
    counts = grams.groupBy("gram").count().orderBy("count", "gram").collect()
    return {r["gram"].encode("latin-1"): i for i, r in enumerate(counts)}, [r["count"] for r in counts]


def prefix_of(word: bytes, rank: dict[bytes, int]) -> tuple[list[tuple[int, int]], int]:
    """((place, rank) of the prefix bigrams by place, rank of the last); ``word`` in Latin-1."""
    ranks = [rank[word[i : i + 2]] for i in range(len(word) - 1)]
    last = sorted(ranks)[PREFIX - 1]
    return [(i, r) for i, r in enumerate(ranks) if r <= last], last


def pivots_of(prefix: list[tuple[int, int]], n: int, frequency: list[int]) -> tuple[int, int]:
    """Places of the two disjoint pivots of least expected list length.

    One sweep: the cheapest left pivot that ends at or before each place is kept
    while the right pivot moves along.
    """
    best = None
    left = None  # (cost, place) of the cheapest left pivot so far
    behind = 0  # first prefix bigram not yet offered as a left pivot
    for place, r in prefix:
        while prefix[behind][0] <= place - 2:
            at, q = prefix[behind]
            cost = frequency[q] * SPREAD ** -min(at, 99)
            if left is None or cost < left[0]:
                left = (cost, at)
            behind += 1
        if left is not None:
            cost = left[0] + frequency[r] * SPREAD ** -min(n - 2 - place, 99)
            if best is None or cost < best[0]:
                best = (cost, left[1], place)
    return best[1], best[2]


def _sides(word: bytes, places: list[int]) -> dict[int, tuple[int, int]]:
    """Checksums of what stands before and behind the bigram at each place (in order)."""
    left, at, crc = {}, 0, 0
    for p in places:
        crc, at = zlib.crc32(word[at:p], crc), p
        left[p] = crc
    turned, at, crc, out = word[::-1], 0, 0, {}
    for p in reversed(places):
        crc, at = zlib.crc32(turned[at : len(word) - 2 - p], crc), len(word) - 2 - p
        out[p] = (left[p], crc)
    return out


def _parity(word: bytes) -> int:
    bits = 0
    for letter in word:
        bits ^= 1 << (letter * 11 % 64)
    return bits - (1 << 64) if bits >> 63 else bits


ENTRY = "key bigint, id bigint, is_pivot boolean, place int, size int, last int, letters bigint"


def _entries(shared):
    def entries(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rank, frequency = shared.value
        names = [c.split()[0] for c in ENTRY.split(", ")]
        types = [pa.int64(), pa.int64(), pa.bool_(), pa.int32(), pa.int32(), pa.int32(), pa.int64()]

        def batch_of(rows: list[tuple]) -> pa.RecordBatch:
            columns = zip(*rows, strict=True) if rows else [[]] * len(types)
            return pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(columns, types, strict=True)], names=names
            )

        for batch in batches:
            rows: list[tuple] = []
            for i, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                word = text.encode("latin-1")
                prefix, last = prefix_of(word, rank)
                left, right = pivots_of(prefix, len(word), frequency)
                sides = _sides(word, [p for p, _ in prefix])
                letters = _parity(word)
                for place, r in prefix:
                    for side, crc in enumerate(sides[place]):
                        key = ((crc << 32) | (r << 1) | side) - (1 << 63)
                        entry = (key, i, False, place, len(word), last, letters)
                        rows.append(entry)
                        if place == (left, right)[side]:
                            rows.append((key, i, True, *entry[3:]))
                if len(rows) > 50_000:
                    yield batch_of(rows)
                    rows = []
            yield batch_of(rows)

    return entries


def near_pairs(words: DataFrame) -> DataFrame:
    """(a, n_a, b, n_b) of all pairs of near words, each once; ``words(word, n)`` is read several times."""
    spark = words.sparkSession
    ship(spark)
    shared = spark.sparkContext.broadcast(gram_order(words))
    named = words.select(F.xxhash64("word").alias("id"), "word", "n")
    entries = stage(named.select("id", "word").mapInArrow(_entries(shared), ENTRY), "variant-entries")
    pivot = entries.where("is_pivot").drop("is_pivot").alias("p")
    other = entries.where("not is_pivot").drop("is_pivot").alias("o")
    right_side = F.col("p.key").bitwiseAND(F.lit(1)) == 1
    shift = F.col("o.size") - F.col("p.size")
    met = (
        (F.abs(shift) <= 1)
        & (F.col("o.place") - F.col("p.place") == F.when(right_side, shift).otherwise(0))
        & (F.col("p.last") <= F.col("o.last"))
        & (F.bit_count(F.col("p.letters").bitwiseXOR(F.col("o.letters"))) <= 2)
        & (F.col("p.id") != F.col("o.id"))
    )
    pairs = pivot.join(other, (F.col("p.key") == F.col("o.key")) & met).select(
        F.least("p.id", "o.id").alias("a"), F.greatest("p.id", "o.id").alias("b")
    )
    pairs = pairs.distinct()
    one = named.select(F.col("id").alias("a"), F.col("word").alias("word_a"), F.col("n").alias("n_a"))
    two = named.select(F.col("id").alias("b"), F.col("word").alias("word_b"), F.col("n").alias("n_b"))
    both = pairs.join(one, "a").join(two, "b")
    found = both.where(F.levenshtein("word_a", "word_b", 1) == 1)
    return found.select(F.col("word_a").alias("a"), "n_a", F.col("word_b").alias("b"), "n_b")


def _roots(forms: DataFrame) -> DataFrame:
    """(word, root): forms followed to the last, doubling the stride each round.

    A form is at least ``FORM_RATIO`` times as frequent as its variant, so a chain
    has at most 27 links and five rounds reach every end.
    """
    spark = forms.sparkSession
    now, path = stage_at(forms.select("word", F.col("form").alias("root")), "variant-roots")
    while True:
        ahead = now.select(F.col("word").alias("root"), F.col("root").alias("next"))
        step = now.join(ahead, "root", "left")
        nxt, nxt_path = stage_at(
            step.select("word", F.coalesce("next", "root").alias("root"), F.isnotnull("next").alias("moved")),
            "variant-roots",
        )
        moved = not nxt.where("moved").isEmpty()
        release(spark, path)
        now, path = nxt.select("word", "root"), nxt_path
        if not moved:
            return now


def variants(words: DataFrame, ratio: int = FORM_RATIO) -> DataFrame:
    """word, form, root, n, n_near, form_n for every row of ``words(word, n)``."""
    words = stage(words, "variant-words")
    pairs = stage(near_pairs(words), "variant-pairs")
    both = pairs.select(F.col("a").alias("word"), F.struct((-F.col("n_b")).alias("n"), F.col("b").alias("w")).alias("x"))
    both = both.union(
        pairs.select(F.col("b").alias("word"), F.struct((-F.col("n_a")).alias("n"), F.col("a").alias("w")).alias("x"))
    )
    best = both.groupBy("word").agg(F.count("*").alias("n_near"), F.min("x").alias("x"))
    judged = words.join(best, "word", "left")
    is_form = -F.col("x.n") >= ratio * F.col("n")
    judged = stage(
        judged.select(
            "word",
            F.when(is_form, F.col("x.w")).alias("form"),
            "n",
            F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
            F.when(is_form, -F.col("x.n")).alias("form_n"),
        ),
        "variant-forms",
    )
    roots = _roots(judged.where("form is not null"))
    return judged.join(roots, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n"
    )
