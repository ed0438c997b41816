"""Secret scan: fixed patterns plus character Markov models, in Spark functions only.

Base spans come from three patterns (assignments, access keys, hex runs).  The
method adds spans of kind ``random``: runs of key characters that a character
Markov model of random strings explains better than one of ordinary
identifiers.  Both are bigram models over the same alphabet, fitted from
labelled samples ``(token, is_random)``; a run is a secret when its
log-likelihood ratio is at least ``MIN_RATIO`` per character.

Everything here is built-in expressions over one row: a pattern's matches are
bracketed by two control characters (their own occurrences in a text are first
replaced, one for one, by a third that no pattern accepts), the text is split
at the first and the parts' lengths give each match's place in code points.

Fitting reads at most ``SAMPLE_DOCS`` documents, chosen by hash among those
with a base span, and only bigram counts (alphabet squared) reach the driver;
scanning covers every whole text.

Defined results: a null text is an empty one; spans are sorted by start, then
by kind as listed in ``KINDS``; added spans never overlap base ones; without
labelled samples the models agree and nothing is added.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The patterns and least lengths of the base spans.
ASSIGN = (
    r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
)
ASSIGN_MIN = 6
ACCESS = r"AKIA[A-Z0-9]{16,}"
HEX = r"[0-9a-f]{24,}"
KINDS = ("assign", "access", "hex", "random")

RUN_MIN = 20
RUN = rf"(?<![A-Za-z0-9+/_=-])[A-Za-z0-9+/_=-]{{{RUN_MIN},}}"
IDENTIFIER = r"[A-Za-z][A-Za-z0-9_-]{7,}"
ALPHABET = "abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789"
WIDTH = len(ALPHABET) + 2  # 0: start of a token, last: any other character
MIN_RATIO = 0.75
SAMPLE_DOCS = 2000
MASK = "[SECRET]"

_OPEN, _CLOSE, _OTHER = "\x01", "\x02", "\x03"
_SPANS = "array<struct<start:bigint,rank:int,end:bigint,value:string>>"


def _clean(text: Column) -> Column:
    return F.translate(F.coalesce(text, F.lit("")), _OPEN + _CLOSE, _OTHER + _OTHER)


def _matches(text: Column, pattern: str, rank: int, needs: Column | None = None) -> Column:
    """Leftmost non-overlapping matches as (start, rank, end, value), in code points.

    Only texts that hold a match are rewritten; ``needs`` is a cheaper test that
    every text with a match passes.
    """
    marked = F.regexp_replace(_clean(text), f"(?:{pattern})", f"{_OPEN}$0{_CLOSE}")
    parts = F.split(marked, _OPEN)

    def place(state: Column, part: Column) -> Column:
        value = F.substring_index(part, _CLOSE, 1)
        start = state["at"]
        span = F.struct(
            start.alias("start"),
            F.lit(rank).alias("rank"),
            (start + F.length(value)).alias("end"),
            value.alias("value"),
        )
        return F.struct(
            (start + F.length(part) - 1).alias("at"), F.concat(state["out"], F.array(span)).alias("out")
        )

    begin = F.struct(
        F.length(parts[0]).cast("long").alias("at"), F.from_json(F.lit("[]"), _SPANS).alias("out")
    )
    found = F.aggregate(F.slice(parts, F.lit(2), F.size(parts)), begin, place, lambda s: s["out"])
    some = text.rlike(pattern) if needs is None else needs & text.rlike(pattern)
    return F.when(some, found).otherwise(F.from_json(F.lit("[]"), _SPANS))


def base_spans(text: Column) -> Column:
    """Spans of the three fixed patterns, by start, then kind."""
    assign = F.filter(
        _matches(text, ASSIGN, 0, text.contains("=") | text.contains(":")),
        lambda s: F.length(F.regexp_extract(s["value"], ASSIGN, 2)) >= ASSIGN_MIN,
    )
    access = _matches(text, ACCESS, 1, text.contains("AKIA"))
    return F.array_sort(F.concat(assign, access, _matches(text, HEX, 2)))


def _codes(token: Column) -> Column:
    """Alphabet places of a token's characters."""
    table = [WIDTH - 1] * 128
    for i, c in enumerate(ALPHABET, 1):
        table[ord(c)] = i
    places = F.split(F.lit(",".join(map(str, table))), ",").cast("array<int>")
    return F.transform(
        F.split(token, ""),
        lambda c: F.when(F.ascii(c) < 128, F.element_at(places, F.ascii(c) + 1)).otherwise(WIDTH - 1),
    )


def fit(samples: DataFrame) -> list[float]:
    """Log-likelihood ratio of each bigram from ``samples(token string, is_random boolean)``.

    Counts are taken over distinct tokens, smoothed by one count per cell; the
    random model is mixed half and half with the uniform one, since a sample
    shows only some kinds of random string.
    """
    rows = samples.where("length(token) > 0 and is_random is not null").distinct()
    pairs = rows.select("is_random", F.concat(F.array(F.lit(0)), _codes(F.col("token"))).alias("c"))
    grams = F.zip_with(
        F.slice("c", F.lit(1), F.size("c") - 1),
        F.slice("c", F.lit(2), F.size("c") - 1),
        lambda a, b: a * WIDTH + b,
    )
    counted = pairs.select("is_random", F.explode(grams).alias("g")).groupBy("is_random", "g").count()
    count = {True: [1.0] * (WIDTH * WIDTH), False: [1.0] * (WIDTH * WIDTH)}
    seen = {True: False, False: False}
    for r in counted.collect():  # at most 2 x WIDTH x WIDTH rows
        count[r["is_random"]][r["g"]] += r["count"]
        seen[r["is_random"]] = True
    out = [0.0] * (WIDTH * WIDTH)
    if not all(seen.values()):
        return out
    uniform = 1.0 / len(ALPHABET)
    for a in range(WIDTH):
        row = slice(a * WIDTH, (a + 1) * WIDTH)
        total = {k: sum(v[row]) for k, v in count.items()}
        for b in range(WIDTH):
            g = a * WIDTH + b
            random = 0.5 * count[True][g] / total[True] + 0.5 * uniform
            out[g] = round(math.log(random / (count[False][g] / total[False])), 6)
    return out


def ratio(token: Column, model: list[float]) -> Column:
    """Log-likelihood ratio of a token, random against ordinary, per character."""
    table = F.split(F.lit(",".join(map(str, model))), ",").cast("array<double>")
    start = F.struct(F.lit(0).alias("last"), F.lit(0.0).alias("sum"))
    return F.aggregate(
        _codes(token),
        start,
        lambda s, c: F.struct(
            c.alias("last"), (s["sum"] + F.element_at(table, s["last"] * WIDTH + c + 1)).alias("sum")
        ),
        lambda s: s["sum"],
    ) / F.greatest(F.length(token), F.lit(1))


def samples_from(docs: DataFrame, text: str = "text", key: str = "doc_id") -> DataFrame:
    """Labelled tokens of a bounded sample: base values are random, other identifiers ordinary.

    The sample are the ``SAMPLE_DOCS`` documents of least hash of key and text; rows
    that repeat both are one document.
    """
    rows = docs.select(F.xxhash64(F.col(key), F.col(text)).alias("h"), F.col(text).alias("text"))
    body = F.col("text")
    some = (
        body.contains("AKIA") & body.rlike(ACCESS)
        | (body.contains("=") | body.contains(":")) & body.rlike(ASSIGN)
        | body.rlike(HEX)
    )
    rows = rows.where(some)
    # the hash of the last row to take; only hashes are gathered, not texts
    last = rows.select("h").distinct().orderBy("h").limit(SAMPLE_DOCS).agg(F.max("h")).first()[0]
    rows = rows.where(F.col("h") <= F.lit(0 if last is None else last))
    rows = rows.groupBy("h").agg(F.first("text").alias("text"))
    rows = rows.select("text", base_spans(F.col("text")).alias("spans"))
    rest = F.regexp_replace(F.regexp_replace(F.regexp_replace("text", ASSIGN, " "), ACCESS, " "), HEX, " ")
    value = F.transform(
        "spans",
        lambda s: F.when(s["rank"] == 0, F.regexp_extract(s["value"], ASSIGN, 2)).otherwise(s["value"]),
    )
    secret = rows.select(F.explode(value).alias("token"), F.lit(True).alias("is_random"))
    plain = rows.select(
        F.explode(F.regexp_extract_all(rest, F.lit(IDENTIFIER), F.lit(0))).alias("token"),
        F.lit(False).alias("is_random"),
    )
    return secret.union(plain)


def all_spans(text: Column, base: Column, model: list[float]) -> Column:
    """Base spans and the runs that the Markov models add, by start, then kind."""
    added = F.filter(
        _matches(text, RUN, 3),
        lambda s: (ratio(s["value"], model) >= MIN_RATIO)
        & ~F.exists(base, lambda b: (b["start"] < s["end"]) & (s["start"] < b["end"])),
    )
    return F.array_sort(F.concat(base, added))


def scan(docs: DataFrame, model: list[float], text: str = "text") -> DataFrame:
    """``docs`` with ``base_spans`` and ``spans``: arrays of (start, rank, end, value)."""
    body = F.col(text).cast("string")
    with_base = docs.withColumn("base_spans", base_spans(body))
    return with_base.withColumn("spans", all_spans(body, F.col("base_spans"), model))


def written(spans: Column) -> Column:
    """kind:start:end of each span, comma-joined."""
    names = F.array(*(F.lit(k) for k in KINDS))
    return F.array_join(
        F.transform(
            spans, lambda s: F.concat_ws(":", F.element_at(names, s["rank"] + 1), s["start"], s["end"])
        ),
        ",",
    )


def masked(text: Column, spans: Column) -> Column:
    """``text`` with every stretch covered by spans replaced by ``MASK``."""
    start = F.struct(F.lit(0).cast("long").alias("at"), F.lit("").alias("out"))

    def step(state: Column, s: Column) -> Column:
        gap = F.substring(text, (state["at"] + 1).cast("int"), (s["start"] - state["at"]).cast("int"))
        fresh = (s["start"] >= state["at"]) & (s["end"] > state["at"])
        return F.struct(
            F.greatest(state["at"], s["end"]).alias("at"),
            F.when(fresh, F.concat(state["out"], gap, F.lit(MASK))).otherwise(state["out"]).alias("out"),
        )

    def finish(state: Column) -> Column:
        return F.concat(state["out"], F.substring(text, (state["at"] + 1).cast("int"), F.length(text)))

    return F.when(F.size(spans) > 0, F.aggregate(spans, start, step, finish)).otherwise(text)


def mask(docs: DataFrame, model: list[float], text: str = "text", length: str = "n_chars") -> DataFrame:
    """``docs`` with secrets masked in ``text``; ``length``, where present, follows the new text."""
    found = docs.withColumn("__spans", base_spans(F.col(text)))
    found = found.withColumn("__spans", all_spans(F.col(text), F.col("__spans"), model))
    found = found.withColumn(text, masked(F.col(text), F.col("__spans")))
    if length in docs.columns:
        new = F.when(F.size("__spans") > 0, F.length(text)).otherwise(F.col(length))
        found = found.withColumn(length, new.cast(docs.schema[length].dataType))
    return found.select(*docs.columns)
