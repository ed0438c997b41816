"""Byte-level BPE encoding and decoding.

A text is cut into pieces by the tokenizer's pattern.  A piece starts as its
single bytes; a fold then merges, again and again, the leftmost adjacent pair
whose bytes have the least rank, until no pair is in the vocabulary.  Decoding
concatenates the tokens' bytes, from the ids alone.

A worker takes a run of rows at a time and works on Arrow and numpy arrays: the
run's distinct stretches between blanks are cut into pieces, the distinct pieces
are folded together, and the texts are put together from their stretches.  Ids
and decoded bytes of stretches are kept for later runs, about ``KEPT_BYTES`` of
them twice (it only saves work; results do not depend on it).

The fold runs in Arrow batches.  The same fold as Spark higher-order functions
gave the same ids but took about 266 microseconds a piece (see README), which
the distinct pieces alone of a corpus of invented words do not allow.

The job is map-only: nothing is shuffled, collected or joined.  The rank map is
a fixed vocabulary, read by the driver from the path given and broadcast.

Defined results: a null text is an empty one (no ids); rows are kept one for
one, repeated keys and extra columns included.
"""

from __future__ import annotations

import base64
import heapq
import uuid
from collections.abc import Iterator

import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerline.llm.text import IS_SPACE, Run, chunks
from ledgerline.llm.workers import held, ship

RANKS = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
PATTERN = public_tokenizers.PATTERN
KEPT_BYTES = 2 << 20  # of stretches, ids and bytes that are kept; the ones before them are kept as long
RUN = 512 << 10  # bytes of text encoded together
LONGEST = 2048  # a longer stretch (a text without blanks) is not kept
CELLS = 1 << 16  # bytes of pieces folded together
LONG = 256  # pieces beyond this many bytes use a heap of their own

ID_BITS, RANK_BITS, PLACE_BITS = 17, 20, 12
_END = 1 << 16  # above every id: no token here
_NONE = (1 << RANK_BITS) - 1  # above every rank

Entries = tuple[pa.Array, pa.Array, pa.Array, pa.Array]  # stretches, ids, decoded bytes, numbers of tokens

_wide = (0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000)
_wide = [chr(c).encode() for c in _wide]
WIDE_SPACES = {n: np.array([int.from_bytes(c) for c in _wide if len(c) == n]) for n in (2, 3)}


def white(data: np.ndarray) -> np.ndarray:
    """Whether each byte of UTF-8 text belongs to a white space character."""
    mask = IS_SPACE[data]
    for n, codes in WIDE_SPACES.items():
        firsts = np.unique(codes >> 8 * (n - 1))
        lead = np.flatnonzero(np.isin(data[: max(len(data) - n + 1, 0)], firsts.astype(np.uint8)))
        if len(lead):
            code = sum(data[lead + i].astype(np.int64) << 8 * (n - 1 - i) for i in range(n))
            lead = lead[np.isin(code, codes)]
            mask[(lead[:, None] + np.arange(n)).ravel()] = True
    return mask


def stretch_starts(run: Run) -> np.ndarray:
    """First bytes of the stretches of a run; no piece of any text crosses them.

    A blank after a character that is no white space always starts a piece, and so
    does one before such a character.
    """
    data, ends = run.data, run.offsets[1:]
    inked = np.ones(len(data) + 1, bool)
    inked[:-1] = ~white(data)
    before, after = inked[:-1].copy(), inked[1:]
    before[1:] = inked[:-2]
    after[ends[ends > run.offsets[:-1]] - 1] = False  # what follows a text is another one
    cut = (data == 0x20) & (before | after)
    cut[run.offsets[:-1][ends > run.offsets[:-1]]] = True
    return np.flatnonzero(cut)


def read_ranks(path: str) -> dict[bytes, int]:
    """Token bytes and ranks of a rank file."""
    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in (line.split() for line in f if line.strip())}


def _offsets(counts: np.ndarray) -> np.ndarray:
    """Where each of consecutive stretches of ``counts`` elements begins, and the end."""
    return np.concatenate(([0], np.cumsum(counts, dtype=np.int64)))


def _spans(starts: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Numbers ``start .. start + count`` of every span, one after the other."""
    first = _offsets(counts)
    return np.repeat(starts - first[:-1], counts) + np.arange(first[-1])


def _buffers(array: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Offsets (from 0) and bytes of a string or binary array."""
    if not len(array):
        return np.zeros(1, np.int64), np.zeros(0, np.uint8)
    _, offsets, data = array.buffers()
    at = np.frombuffer(offsets, np.int32)[array.offset : array.offset + len(array) + 1].astype(np.int64)
    held_bytes = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return at - at[0], held_bytes[at[0] : at[-1]]


def _join(values: pa.Array, first: np.ndarray, separator: str | bytes) -> pa.Array:
    """Consecutive values joined, ``first`` telling where each group begins."""
    groups = pa.ListArray.from_arrays(pa.array(first, pa.int32()), values)
    return pc.binary_join(groups, pa.scalar(separator, values.type))


class PairTable:
    """Joined token of a pair of tokens, for arrays: two hash tables, one read of each a lookup."""

    def __init__(self, pairs: dict[tuple[int, int], int]):
        bits = max(8, (2 * len(pairs)).bit_length())
        self.shift = np.uint64(64 - bits)
        keys = np.array([a << ID_BITS | b for a, b in pairs], np.uint64)
        slots = [self._slot(keys, side).tolist() for side in (0, 1)]
        place = {k: (x, y) for k, x, y in zip(keys.tolist(), *slots, strict=True)}
        self.entries = np.full((2, 1 << bits), (1 << 2 * ID_BITS) - 1 << RANK_BITS | _NONE, np.uint64)  # key and rank
        ranks = dict(zip(place, pairs.values(), strict=True))
        held: list[dict[int, int]] = [{}, {}]
        for key in place:
            side = 0
            for _ in range(1000):  # an entry found in the slot moves to its other slot
                slot = place[key][side]
                key, held[side][slot] = held[side].get(slot), key
                if key is None:
                    break
                side = 1 - side
            else:
                raise RuntimeError("pair table too full")
        for side in (0, 1):
            for slot, key in held[side].items():
                self.entries[side, slot] = key << RANK_BITS | ranks[key]

    def _slot(self, keys: np.ndarray, side: int) -> np.ndarray:
        factor = np.uint64((0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F)[side])
        return ((keys * factor) >> self.shift).view(np.int64)

    def __call__(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Rank of each joined pair, ``_NONE`` where a pair joins to no token."""
        keys = (left.astype(np.uint64) << np.uint64(ID_BITS)) | right
        one, two = (self.entries[side][self._slot(keys, side)] for side in (0, 1))
        low = np.uint64(RANK_BITS)
        found = np.where(one >> low == keys, one, two)
        return np.where(found >> low == keys, found & np.uint64(_NONE), np.uint64(_NONE)).astype(np.uint32)


class Codec:
    """Encoder and decoder of one vocabulary."""

    def __init__(self, ranks: dict[bytes, int], pattern: str = PATTERN):
        if max(ranks.values()) >= _END:
            raise ValueError("ranks of 65,536 and above are not supported")
        self.ranks = ranks
        self.pieces = regex.compile(pattern).findall
        self.tokens = [b""] * (max(ranks.values()) + 1)
        pairs: dict[tuple[int, int], int] = {}  # adjacent tokens -> the token they join to
        for token, rank in ranks.items():
            self.tokens[rank] = token
            for i in range(1, len(token)):
                a, b = ranks.get(token[:i]), ranks.get(token[i:])
                if a is not None and b is not None:
                    pairs[a, b] = rank
        self.names = pa.array([str(i) for i in range(len(self.tokens))], pa.string())
        self.token_bytes = pa.array(self.tokens, pa.binary())
        self.whole = pa.array(list(ranks), pa.binary()), np.array(list(ranks.values()), np.uint32)
        self.bytes = np.array([ranks[bytes([b])] for b in range(256)], np.uint32)
        self.table = PairTable(pairs)
        self.byte_pairs = self.table(np.repeat(self.bytes, 256), np.tile(self.bytes, 256))
        # by number of the run that brought them: stretches, their ids, bytes and numbers of tokens
        self.young: dict[int, Entries] = {}
        self.old: dict[int, Entries] = {}
        self.used = np.zeros(0, bool)  # older entries found again
        self.sizes = np.zeros(0, np.int64)  # bytes of the older entries
        self.held = 0  # bytes of the younger entries and of the older ones found again
        self.runs = 0

    def fold(self, pieces: list[bytes]) -> list[list[int]]:
        """Token ids of each piece."""
        ids, first = self._fold(pa.array(pieces, pa.binary()))
        return [ids[a:b].tolist() for a, b in zip(first[:-1], first[1:], strict=True)]

    def _fold(self, pieces: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Token ids of all pieces in order, and where each piece's begin (and the last one's end)."""
        starts, data = _buffers(pieces)
        lengths = np.diff(starts)
        found = pc.fill_null(pc.index_in(pieces, self.whole[0]), -1).to_numpy(zero_copy_only=False)
        whole = np.flatnonzero(found >= 0)
        done = [(whole, np.ones(len(whole), np.int64), self.whole[1][found[whole]])]  # pieces, their counts, ids
        for i in np.flatnonzero((found < 0) & (lengths > LONG)).tolist():
            ids = np.array(self._fold_long(data[starts[i] : starts[i + 1]].tobytes()), np.uint32)
            done.append((np.array([i]), np.array([len(ids)]), ids))
        short = np.flatnonzero((found < 0) & (lengths <= LONG) & (lengths > 0))
        short = short[np.argsort(lengths[short], kind="stable")]
        while len(short):  # pieces of like length
            some = short[: max(1, CELLS // int(lengths[short[0]] + 2))]
            some = some[: max(1, CELLS // int(lengths[some[-1]] + 2))]
            done.append((some, *self._fold_group(data, starts[some], lengths[some])))
            short = short[len(some) :]
        counts = np.zeros(len(pieces), np.int64)
        for which, n, _ in done:
            counts[which] = n
        first = _offsets(counts)
        out = np.empty(first[-1], np.uint32)
        for which, n, ids in done:
            out[_spans(first[which], n)] = ids
        return out, first

    def _fold_group(self, data: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Numbers of tokens and ids of pieces that advance together, one merge a round.

        A cell stands for a byte (a row) of a piece (a column); a token lies in the cell
        of its first byte, linked to those before and after it.
        """
        n, width = len(starts), int(lengths.max())
        place = np.arange(width)[:, None]
        inside = place < lengths
        read = data[np.where(inside, starts + place, 0)].astype(np.int64)
        ids = np.full((width + 2, n), _END, np.uint32)  # a row before and one after the tokens
        ids[1:-1][inside] = self.bytes[read[inside]]
        best = np.full((width + 2, n), _NONE << PLACE_BITS, np.uint32)  # rank of each token with the next, and place
        both = inside[1:]
        ranks = self.byte_pairs[read[:-1] << 8 | read[1:]]
        best[1:-2][both] = (ranks << PLACE_BITS | place[:-1].astype(np.uint32))[both]
        ids, flat = ids.ravel(), best.ravel()
        after = np.arange(n, len(ids) + n, dtype=np.int32)
        before = np.arange(-n, len(ids) - n, dtype=np.int32)
        while True:
            least = best.min(axis=0)  # the leftmost of the least
            live = np.flatnonzero(least < _NONE << PLACE_BITS)
            if not len(live):
                break
            least = least[live]
            at = ((least & (1 << PLACE_BITS) - 1) + 1).astype(np.int64) * n + live
            token = least >> PLACE_BITS
            gone = after[at]
            left, right = before[at], after[gone]
            ids[at], ids[gone] = token, _END
            after[at], before[right] = right, at
            flat[gone] = _NONE << PLACE_BITS
            cells = np.concatenate((left, at))
            ranks = self.table(ids[cells], np.concatenate((token, ids[right])))
            flat[cells] = ranks << PLACE_BITS | np.maximum(cells // n - 1, 0).astype(np.uint32)
        ids = ids.reshape(-1, n).T
        is_token = ids != _END
        return is_token.sum(axis=1), ids[is_token]

    def _fold_long(self, piece: bytes) -> list[int]:
        """The same merges in n log n steps: a heap of (rank, place) over linked tokens."""
        n = len(piece)
        ids = self.bytes[list(piece)].tolist()
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        heap: list[tuple[int, int, int, int]] = []

        def offer(i: int, j: int) -> None:
            rank = self.ranks.get(self.tokens[ids[i]] + self.tokens[ids[j]])
            if rank is not None:
                heapq.heappush(heap, (rank, i, ids[i], ids[j]))

        for i in range(n - 1):
            offer(i, i + 1)
        while heap:
            rank, i, left, right = heapq.heappop(heap)
            j = after[i]
            if ids[i] != left or j >= n or ids[j] != right:
                continue  # one of the two has been merged since
            ids[i], ids[j] = rank, -1
            after[i] = after[j]
            if after[j] < n:
                before[after[j]] = i
                offer(i, after[j])
            if before[i] >= 0:
                offer(before[i], i)
        return [x for x in ids if x >= 0]

    def decode(self, ids: list[int]) -> bytes:
        """Bytes of token ids."""
        return b"".join([self.tokens[i] for i in ids])

    def _cut(self, stretches: pa.Array) -> tuple[pa.Array, np.ndarray]:
        """Pieces of all stretches in order, and the first of each stretch (and the last one's end)."""
        starts, data = _buffers(stretches)
        pieces = pa.array(self.pieces(data.tobytes().decode()), pa.string())
        cuts, matched = _buffers(pieces)
        first = np.searchsorted(cuts, starts)
        if len(matched) == len(data) and (cuts[first] == starts).all():
            return pieces, first
        each = [self.pieces(s.decode()) for s in stretches.to_pylist()]
        return pa.array([p for cut in each for p in cut], pa.string()), _offsets([len(cut) for cut in each])

    def _learned(self, stretches: pa.Array) -> Entries:
        """Entries of stretches."""
        starts, data = _buffers(stretches)
        # a blank and no other white space: a piece starts there whatever stands before
        inked = np.append(~white(data), False)
        led = (data[starts[:-1]] == 0x20) & inked[starts[:-1] + 1]
        order = np.argsort(~led, kind="stable")
        some, rest = pa.array(order[: led.sum()]), pa.array(order[led.sum() :])
        pieces, first = self._cut(stretches.take(some))
        each = [self.pieces(s.decode()) for s in stretches.take(rest).to_pylist()]
        pieces = pa.concat_arrays([pieces, pa.array([p for cut in each for p in cut], pa.string())])
        first = np.concatenate((first[:-1], first[-1] + _offsets([len(cut) for cut in each])))
        coded = pieces.dictionary_encode()
        ids, begin = self._fold(coded.dictionary.cast(pa.binary()))
        codes = coded.indices.to_numpy()
        tokens = np.diff(begin)[codes]  # of each piece
        ids = pa.array(ids[_spans(begin[codes], tokens)])
        first = _offsets(tokens)[first]
        back = np.empty(len(order), np.int64)
        back[order] = np.arange(len(order))
        joined = _join(self.names.take(ids), first, ","), _join(self.token_bytes.take(ids), first, b"")
        return stretches, *(x.take(pa.array(back)) for x in (*joined, pa.array(np.diff(first))))

    def _turn(self) -> None:
        """Drop the older entries that were not found again; all others are the older ones now."""
        used = np.concatenate((self.used, np.ones(sum(len(e[0]) for e in self.young.values()), bool)))
        old = self._joined([*self.old.values(), *self.young.values()], pa.array(used))
        self.old, self.young, self.held = {self.runs: old}, {}, 0
        self.used = np.zeros(len(old[0]), bool)
        self.sizes = self._sizes(old)

    @staticmethod
    def _joined(entries: list[Entries], keep: pa.Array | None = None) -> Entries:
        joined = (pa.concat_arrays(x) for x in zip(*entries, strict=True))
        return tuple(x if keep is None else x.filter(keep) for x in joined)

    @staticmethod
    def _sizes(entries: Entries) -> np.ndarray:
        return sum(np.diff(_buffers(x)[0]) for x in entries[:3]) + 20  # with offsets and number

    def encode_run(self, run: Run) -> tuple[np.ndarray, pa.Array, pa.Array]:
        """Number of tokens, ids (decimal, comma-joined) and the bytes decoded from them, of each text.

        Stretches are looked up among those of earlier runs.
        """
        if self.held > KEPT_BYTES:
            self._turn()
        self.runs += 1
        starts = stretch_starts(run)
        if not len(starts):
            empty = pa.array([""] * run.n_rows, pa.string())
            return np.zeros(run.n_rows, np.int64), empty, empty.cast(pa.binary())
        cut = np.append(starts, len(run.data)).astype(np.int32)
        stretches = pa.Array.from_buffers(pa.binary(), len(starts), [None, pa.py_buffer(cut), pa.py_buffer(run.data)])
        kept = [*self.old.values(), *self.young.values()]
        known, older = sum(len(e[0]) for e in kept), len(self.used)
        coded = pa.concat_arrays([*(e[0] for e in kept), stretches]).dictionary_encode()
        codes = coded.indices.to_numpy()[known:]
        again = np.zeros(older, bool)
        again[codes[codes < older]] = True
        again &= ~self.used
        self.used |= again
        self.held += int(self.sizes[again].sum())
        fresh = coded.dictionary[known:]
        if len(fresh):
            learned = self._learned(fresh)
            kept.append(learned)
            # filtered, so copied: the dictionary's buffers are not held
            short = self._joined([learned], pc.less_equal(pc.binary_length(fresh), LONGEST))
            self.young[self.runs] = short
            self.held += int(self._sizes(short).sum())
        _, names, back, counts = self._joined(kept)
        first = np.searchsorted(starts, run.offsets)
        tokens = _offsets(counts.to_numpy()[codes])[first]
        at = pa.array(codes)
        return np.diff(tokens), _join(names.take(at), first, ","), _join(back.take(at), first, b"")

    def encode(self, texts: list[str]) -> Iterator[tuple[str, bytes]]:
        """Ids of each text (decimal, comma-joined) and the bytes decoded from them."""
        for run in chunks(pa.array(texts, pa.string()), RUN):
            _, ids, back = self.encode_run(run)
            yield from zip(ids.to_pylist(), back.to_pylist(), strict=True)


def encode(
    docs: DataFrame, path: str = RANKS, text: str = "text", pattern: str = PATTERN
) -> DataFrame:
    """``docs`` with n_tokens, ids (decimal, comma-joined) and decoded (binary)."""
    spark = docs.sparkSession
    ship(spark)
    shared, name = spark.sparkContext.broadcast((read_ranks(path), pattern)), uuid.uuid4().hex
    added = ("n_tokens", "ids", "decoded")
    kept = [c for c in docs.columns if c not in added]
    at = kept.index(text)

    def run_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = held(name, lambda: Codec(*shared.value))  # later tasks find its dictionary filled
        for batch in batches:
            for run in chunks(batch.column(at), RUN):
                counts, ids, decoded = codec.encode_run(run)
                rows = batch.slice(run.first, run.n_rows)
                yield pa.RecordBatch.from_arrays(
                    [*rows.columns, pa.array(counts, pa.int64()), ids, decoded], names=[*kept, *added]
                )

    schema = docs.select(*kept).schema
    schema = schema.add("n_tokens", "long").add("ids", "string").add("decoded", "binary")
    return docs.select(*kept).mapInArrow(run_batches, schema)


def digests(docs: DataFrame, path: str = RANKS, text: str = "text", key: str = "doc_id") -> DataFrame:
    """key, n_tokens, ids_sha256, decoded_sha256 of every row."""
    return encode(docs.select(key, text), path, text).select(
        key,
        "n_tokens",
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )
