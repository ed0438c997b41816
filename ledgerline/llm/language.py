"""Language identification by cross-parsing entropy.

For every language a suffix automaton is built over a bounded sample of
labelled text.  A text is parsed from left to right into the longest phrases
that occur in a language's sample (a byte that occurs nowhere in the sample
ends the phrase it stands in).  With ``c`` phrases over ``n`` bytes and a
sample of ``T`` bytes the cross-parsing entropy is ``c * log2(T) / n``; the
language with the least entropy wins.

Fitting reads a bounded sample of labelled rows: ``SAMPLE_ROWS`` rows for each
language, chosen by hash over all labelled rows, ``SAMPLE_CHARS`` characters of
each.  That sample is what reaches the driver; its automata become dense
transition tables that are broadcast (their size depends on the sample alone).
Prediction reads every text whole, cut into parse blocks of ``BLOCK`` bytes
that all advance together, one byte of each block and language at a time.

Defined results
  * null text, or text without a letter: ``und``, score 0
  * text with letters but no labelled row to learn from: ``und``, score 0
  * equal entropies: the language that sorts first
  * rows are kept one for one, repeated rows and extra columns included
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerline.llm.rows import free_name
from ledgerline.llm.text import Run, chunks, folded
from ledgerline.llm.workers import forget, ship

UNKNOWN = "und"
SAMPLE_ROWS = 64
SAMPLE_CHARS = 600
MAX_LANGUAGES = 200  # a label column with more values is not a language column
BLOCK = 1024
SHARPNESS = 8.0

_FLAG = np.int32(1 << 30)
_PAD = 255  # pads the blocks of a run to one length; never a UTF-8 byte


def normalise(run: Run) -> tuple[np.ndarray, np.ndarray]:
    """Letters of a run in lower case, anything else as one blank; new row offsets."""
    data, offsets, _ = folded(run, digits=False)
    return data, offsets


def suffix_automaton(sample: bytes) -> list[dict[int, int]]:
    """Transitions of the smallest automaton of all substrings of ``sample`` (state 0 starts)."""
    step: list[dict[int, int]] = [{}]
    link, length = [-1], [0]
    last = 0
    for c in sample:
        cur = len(step)
        step.append({})
        length.append(length[last] + 1)
        link.append(0)
        p = last
        while p >= 0 and c not in step[p]:
            step[p][c] = cur
            p = link[p]
        if p >= 0:
            q = step[p][c]
            if length[q] == length[p] + 1:
                link[cur] = q
            else:
                twin = len(step)
                step.append(dict(step[q]))
                length.append(length[p] + 1)
                link.append(link[q])
                while p >= 0 and step[p].get(c) == q:
                    step[p][c] = twin
                    p = link[p]
                link[q] = link[cur] = twin
        last = cur
    return step


class CrossParser:
    """Dense phrase tables of several languages over one shared byte alphabet."""

    def __init__(self, samples: dict[str, bytes]):
        self.languages = sorted(samples)
        used = sorted({b for s in samples.values() for b in s})
        self.unseen, self.pad = len(used), len(used) + 1
        width = len(used) + 2
        self.code = np.full(256, self.unseen, np.int64)
        self.code[used] = np.arange(len(used))
        self.code[_PAD] = self.pad
        tables, self.roots, base = [], [], 0
        for lang in self.languages:
            states = suffix_automaton(samples[lang])
            root = np.full(width, base | _FLAG, np.int32)  # a byte this language lacks is a phrase end
            root[self.pad] = base
            table = np.empty((len(states), width), np.int32)
            for byte, state in states[0].items():
                root[self.code[byte]] = (base + state * width) | _FLAG
            table[:] = root
            for i, moves in enumerate(states):  # the start state's own moves end no phrase
                for byte, state in moves.items():
                    table[i, self.code[byte]] = base + state * width
            tables.append(table.ravel())
            self.roots.append(base)
            base += table.size
        self.table = np.concatenate(tables) if tables else np.zeros(0, np.int32)
        self.bits = np.array([np.log2(max(2, len(samples[x]))) for x in self.languages])

    def phrases(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """Phrases of each row in each language; a parse block ends the phrase it cuts."""
        lengths = np.diff(offsets)
        blocks = -(-lengths // BLOCK)
        row = np.repeat(np.arange(len(lengths)), blocks)
        nth = np.arange(len(row)) - np.repeat(np.cumsum(blocks) - blocks, blocks)
        start = offsets[:-1][row] + nth * BLOCK
        size = np.minimum(BLOCK, offsets[1:][row] - start)
        order = np.argsort(-size, kind="stable")
        row, start, size = row[order], start[order], size[order]
        counts = np.zeros((len(self.languages), len(row)), np.int64)
        roots = np.array(self.roots, np.int32)[:, None]
        state = np.repeat(roots, len(row), axis=1)
        codes = self.code[data]
        live = len(row)
        for t in range(int(size[0]) if len(size) else 0):
            live = int(np.searchsorted(-size[:live], -t, "left"))  # blocks longer than t
            nxt = self.table[state[:, :live] + codes[start[:live] + t]]
            counts[:, :live] += nxt >> 30
            state[:, :live] = nxt & (_FLAG - 1)
        counts += state != roots  # the phrase still open at the block's end
        out = np.zeros((len(lengths), len(self.languages)))
        for k in range(len(self.languages)):
            out[:, k] = np.bincount(row, weights=counts[k], minlength=len(lengths))
        return out

    def predict(self, run: Run, has_letter: np.ndarray) -> tuple[list[str], np.ndarray]:
        """Language and score of each row of a run."""
        names = [UNKNOWN] * run.n_rows
        scores = np.zeros(run.n_rows)
        if not self.languages:
            return names, scores
        data, offsets = normalise(run)
        entropy = self.phrases(data, offsets) * self.bits / np.maximum(1, np.diff(offsets))[:, None]
        best = np.argmin(entropy, axis=1)
        least = entropy[np.arange(run.n_rows), best][:, None]
        share = 1.0 / np.exp2(SHARPNESS * (least - entropy)).sum(axis=1)
        for i in np.flatnonzero(has_letter):
            names[i] = self.languages[best[i]]
            scores[i] = share[i]
        return names, scores


def _letters(run: Run) -> np.ndarray:
    """Whether each row has a letter (any script)."""
    letter = np.zeros(256, bool)
    letter[[b for b in range(128) if chr(b).isalpha()]] = True
    seen = np.concatenate(([0], np.cumsum(letter[run.data])))
    out = seen[run.offsets[1:]] > seen[run.offsets[:-1]]
    wide = np.concatenate(([0], np.cumsum(run.data >= 0x80)))
    for i in np.flatnonzero(~out & (wide[run.offsets[1:]] > wide[run.offsets[:-1]])):
        text = run.data[run.offsets[i] : run.offsets[i + 1]].tobytes().decode("utf-8", "ignore")
        out[i] = any(c.isalpha() for c in text)
    return out


def fit(
    labelled: DataFrame,
    text: str = "text",
    lang: str = "lang",
    key: str = "doc_id",
    sample_rows: int = SAMPLE_ROWS,
    sample_chars: int = SAMPLE_CHARS,
) -> CrossParser:
    """Build the automata from a bounded, hash-chosen sample of all labelled rows."""
    rows = labelled.select(
        F.col(lang).alias("lang"), F.col(text).alias("text"), F.xxhash64(F.col(key)).alias("h")
    ).where("lang is not null and length(text) > 0")
    slot = F.pmod("h", F.lit(sample_rows))
    picks = rows.groupBy("lang", slot.alias("slot")).agg(F.min("h").alias("h")).select("lang", "h")
    picks = picks.limit(sample_rows * MAX_LANGUAGES + 1)
    found = (
        rows.join(F.broadcast(picks), ["lang", "h"])  # bounded by sample_rows x MAX_LANGUAGES
        .groupBy("lang", "h")
        .agg(F.min(F.substring("text", 1, sample_chars)).alias("text"))
    )
    parts: dict[str, list[tuple[int, str]]] = {}
    for r in found.collect():
        parts.setdefault(r["lang"], []).append((r["h"], r["text"]))
    if len(parts) > MAX_LANGUAGES:
        raise ValueError(f"column {lang} has more than {MAX_LANGUAGES} values: not a language label")
    samples = {}
    for name, texts in parts.items():
        column = pa.array([t for _, t in sorted(texts)], pa.string())
        samples[name] = b"".join(normalise(run)[0].tobytes() for run in chunks(column))
    return CrossParser({k: v for k, v in samples.items() if v.strip()})


def predict(
    docs: DataFrame,
    model: CrossParser,
    text: str = "text",
    lang_col: str = "lang_pred",
    score_col: str = "score",
) -> DataFrame:
    """Add the predicted language and its score; columns of those names are replaced."""
    ship(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def score(texts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        forget()
        parser = shared.value
        for column in texts:
            names: list[str] = []
            scores = [np.zeros(0)]
            for run in chunks(column):
                got, s = parser.predict(run, _letters(run))
                names += got
                scores.append(s)
            yield pa.StructArray.from_arrays(
                [pa.array(names, pa.string()), pa.array(np.concatenate(scores))], names=["lang", "score"]
            )

    # only the text goes to the workers and only the verdict comes back
    verdict = F.arrow_udf(score, "lang string, score double")
    kept = [c for c in docs.columns if c not in (lang_col, score_col)]
    own = free_name("verdict", kept)
    found = docs.select(*kept, verdict(F.col(text).cast("string")).alias(own))
    return found.select(
        *kept, F.col(own)["lang"].alias(lang_col), F.col(own)["score"].alias(score_col)
    )


def fold(key: str = "doc_id", n: int = 3) -> Column:
    """crc32 of the key as text, modulo ``n`` (null keys: of the empty text)."""
    return F.pmod(F.crc32(F.coalesce(F.col(key).cast("string"), F.lit("")).cast("binary")), F.lit(n))
