"""Token ids in binary: adaptive context-mixing range coder in independently reset, checksummed blocks.

Model. The distribution of the next id is a blend. Order 2 (the id that last followed this pair) and order 1 (the id
that last followed this id) each offer an id with a confidence, which counts how often it has followed in a row; order 0
offers the ids that the block has held so far, kept in ``SEEN`` slots by a hash of the id; an id that is new to the block
has a fixed prior by its bit length. The shares of the four are adaptive, one set for each pair of confidences. Where
orders 1 and 2 offer the same id their shares add up; the share of order 0 lies apart. A 64-bit range coder with carry
codes which of the four it is. The slots of order 0 are equally likely, and the prior's shares are powers of two, so the
slot and the new id follow as plain bits, which are as many as the range coder would write for them.

Lanes. A block of ``BLOCK`` ids starts from a fresh model and a fresh coder, so blocks are independent; some ``LANES``
of them are coded side by side in numpy, one id each per step, and a damaged block costs only itself. The coder finds
what the contexts know by sorting whole blocks, the decoder keeps it in tables. Memory is bounded by the lanes and does
not grow with the input.

Blocks. Numbers of new ids and of slots (16 bits each); the new ids' parts of the prior; the rest of their bits; the range
coder's words; the slots, a byte each. All begin at words of 32 bits.

Files. Documents are sorted by doc_id over all files (range partitioning; the files' order is the shards' order). A row
of the Parquet files is one segment: whole documents with their ids' counts, and a body with a magic word, a block
directory (ids, bytes and CRC-32 of each block) and the coded blocks. Spark's committer makes the write safe against
lost executors. Readers check the CRC of every block and fail on a damaged one.

Defined results: a null or empty text has only the end id; rows without a doc_id come first; rows that share a doc_id
stand in the order of their texts' hashes; an empty table writes no segment; other columns are ignored. Ids up to 2^24
can be written.
"""

from __future__ import annotations

import json
import os
import re
import struct
import zlib
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain, repeat

import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from nightaudit.llm.common import scratch_path, table, text_or_empty

TOKENIZER = "word_bpe_49k.json"
END_ID = 1
CACHED_WORDS = 700_000
LONGEST_CACHED = 48
BATCH_BYTES = 1 << 23

MAGIC, VERSION = b"NACM", 3
BLOCK = 2048
LANES = 2048
SLOT_BITS = 9
SLOTS = 1 << SLOT_BITS
SEGMENT_IDS = 32 * BLOCK

PROB_BITS = 14
RATE = 5
LEAST = 48
SEEN = 256
PARTS = 32
#: Steps between two looks at the coders' range, which each step narrows by 8.4 bits at most and which needs 14.
SETTLE = 2
SORT_LANES = 64


class Model:
    """Fixed figures of the coder for ids below ``vocabulary``, shared by coder and decoder."""

    def __init__(self, vocabulary: int):
        top = max(9, int(vocabulary - 1).bit_length())
        self.vocabulary = vocabulary
        # Classes of new ids: below 256, then one for each longer bit length; each has a power of two of the PARTS.
        bits = np.array([8, *range(8, top)])
        part = 1 << ((PARTS // len(bits)).bit_length() - 1)
        twice = len(bits) - (PARTS - part * len(bits)) // part
        parts = np.where(np.arange(len(bits)) >= twice, 2 * part, part)
        self.part_bits = PARTS.bit_length() - 1
        # Of every part: its first id and the bits of an id within it.
        self.rest_bits = np.repeat(bits - np.log2(parts).astype(int), parts)
        within = np.arange(PARTS) - np.repeat(np.cumsum(parts) - parts, parts)
        self.first = np.repeat(np.array([0, *(1 << b for b in range(8, top))]), parts) + (within << self.rest_bits)
        # Of every id: its part.
        self.part = np.searchsorted(self.first, np.arange(1 << top), side="right").astype(np.uint8) - 1

        # Symbols: 0 as order 2 says, 1 as order 1 says, 2 a slot of order 0, 3 a new id. A set of shares is four numbers
        # of 16 bits: the lower bounds of the symbols. An upper bound is the next number, modulo the whole.
        whole = 1 << PROB_BITS
        least = np.arange(4) * LEAST
        late = np.array([0, *(whole - least[:0:-1])])
        above = np.arange(4) > np.arange(4)[:, None]
        self.target = np.where(above, late, least).astype(np.int16).view(np.uint64).ravel()
        two = np.array([2, 10, 24, 44])[:, None] / 64
        one = (1 - two) * np.array([2, 8, 20, 40]) / 64
        rest = 1 - two - one
        shares = np.stack([0 * rest, two + 0 * one, two + one, two + one + rest / 3], -1)
        self.start = np.minimum(np.floor(shares * whole), late).astype(np.int16).reshape(16, 4).view(np.uint64).ravel()


_ONE, _TWO, _THREE = np.uint32(1), np.uint32(2), np.uint32(3)
_HASH, _HASH2 = np.uint32(0x9E3779B1), np.uint32(0x27D4EB2F)
_SEEN_SHIFT, _SLOT_SHIFT, _MIX = np.uint32(33 - SEEN.bit_length()), np.uint32(32 - SLOT_BITS), np.uint32(9)


def _pick(mask: np.ndarray, yes: np.ndarray, no: np.ndarray) -> np.ndarray:
    """``np.where`` for masks that no branch prediction can follow."""
    out = yes ^ no
    out *= mask
    out ^= no
    return out


class _Shares:
    """The adaptive shares of blocks that are coded side by side, one set for each pair of confidences. Indices are in
    range by construction, here and in :class:`_Lanes`, so ``take`` need not check them (``clip``)."""

    def __init__(self, model: Model, lanes: int):
        self.target, self.n = model.target, -1
        self.shares = np.tile(model.start, lanes)

    def look(self, row: np.ndarray) -> None:
        if len(row) != self.n:
            self.n = len(row)
            lane = np.arange(self.n, dtype=np.intp)
            self.rows, self.quads = lane * 16, lane * 4
            self.own = np.zeros(self.n + 1, np.uint64)  # the last number's upper bound is the 0 behind it
            self.bounds = self.own.view(np.int16)
            self.ends = self.bounds[:-4].reshape(self.n, 4)
        self.row = self.rows + row
        self.shares.take(self.row, mode="clip", out=self.own[:-1])

    def interval(self, sym: np.ndarray, joint: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Start and width of a symbol's share; ``joint``: orders 1 and 2 say the same and their shares add up."""
        at = self.quads + sym
        below = self.bounds.take(at, mode="clip")
        at += 1
        at += joint
        share = self.bounds.take(at, mode="clip")
        share -= below
        share &= _LAST_SHARE
        return below.astype(np.uint64), share.astype(np.uint64)

    def learn(self, sym: np.ndarray) -> None:
        ends = self.bounds[:-4]
        change = self.target.take(sym, mode="clip").view(np.int16)
        change -= ends
        change >>= RATE
        ends += change
        self.shares[self.row] = self.own[:-1]


def _pair_slots(hash_: np.ndarray, hash2: np.ndarray) -> np.ndarray:
    """Slots of order 2, from the hashes of the last id and the one before."""
    out = hash2 >> _MIX
    out ^= hash_
    out *= _HASH2
    out >>= _SLOT_SHIFT
    return out


class _Lanes:
    """What blocks that are decoded side by side have held: by order 1 and order 2, and the slots of order 0."""

    def __init__(self, lanes: int):
        self.lanes, self.n = lanes, -1
        self.table = np.zeros(2 * lanes * SLOTS, np.uint32)  # orders 1 and 2: id, confidence in the last two bits
        self.seen = np.zeros(lanes * SEEN, np.uint32)
        self.hash = self.hash2 = np.zeros(lanes, np.uint32)  # of the last id and the one before

    def predict(self, n: int) -> None:
        if n != self.n:
            self.n, self.hash, self.hash2 = n, self.hash[:n], self.hash2[:n]
            lane = np.arange(n, dtype=np.intp)
            self.seen_at = lane * SEEN
            self.slots = np.concatenate((lane, lane + self.lanes)) * SLOTS
            self.at, self.entry, self.fresh = np.empty(2 * n, np.intp), np.empty(2 * n, np.uint32), np.empty(2 * n, np.uint32)
        np.add(self.slots[:n], self.hash >> _SLOT_SHIFT, out=self.at[:n])
        np.add(self.slots[n:], _pair_slots(self.hash, self.hash2), out=self.at[n:])
        self.table.take(self.at, mode="clip", out=self.entry)
        self.confidence = self.entry & _THREE
        self.guess = self.entry >> _TWO

    def learn(self, ids: np.ndarray) -> None:
        n = self.n
        hashes = ids * _HASH
        np.left_shift(ids, _TWO, out=self.fresh[:n])
        self.fresh[:n] |= _ONE
        self.fresh[n:] = self.fresh[:n]
        hits = self.fresh >> _TWO == self.guess
        self.entry += self.confidence < _THREE
        self.table[self.at] = _pick(hits, self.entry, self.fresh)
        self.seen[self.seen_at + (hashes >> _SEEN_SHIFT)] = ids
        self.hash2, self.hash = self.hash, hashes


def _history(ids: np.ndarray, slots: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """What :class:`_Lanes` knows before each id of whole blocks (a row each): whether its slot holds the id, and the
    slot's confidence. Sorted by slot and place, an id stands behind the one that the slot holds."""
    lanes, n = ids.shape
    bits = np.uint32(n.bit_length())
    keys = np.sort(slots << bits | np.arange(n, dtype=np.uint32), axis=1)
    at = ((keys & np.uint32((1 << n.bit_length()) - 1)) + (np.arange(lanes, dtype=np.intp) * n)[:, None]).ravel()
    keys >>= bits
    x = ids.ravel().take(at, mode="clip").reshape(lanes, n)
    later = np.zeros(ids.shape, bool)
    np.equal(keys[:, 1:], keys[:, :-1], out=later[:, 1:])
    again = np.zeros(ids.shape, bool)
    np.equal(x[:, 1:], x[:, :-1], out=again[:, 1:])
    again &= later
    confidence = later.astype(np.uint8)
    confidence[:, 1:] += later[:, 1:] & again[:, :-1]
    confidence[:, 2:] += later[:, 2:] & again[:, 1:-1] & again[:, :-2]
    again |= (x == 0) & ~later  # an empty slot holds id 0
    hit_of, confidence_of = np.empty(ids.size, bool), np.empty(ids.size, np.uint8)
    hit_of[at], confidence_of[at] = again.ravel(), confidence.ravel()
    return hit_of.reshape(ids.shape), confidence_of.reshape(ids.shape)


_LOW32, _SHIFT32, _TOP = np.uint64(0xFFFFFFFF), np.uint64(32), np.uint64(1 << 32)
_PROB_SHIFT, _LAST_SHARE = np.uint64(PROB_BITS), np.int16((1 << PROB_BITS) - 1)


def _active(sizes: np.ndarray) -> Iterator[tuple[int, int]]:
    """(step, lanes still running) for lanes sorted by falling size."""
    running = len(sizes)
    for t in range(int(sizes[0]) if len(sizes) else 0):
        while sizes[running - 1] <= t:
            running -= 1
        yield t, running


def _starts(sizes: np.ndarray) -> np.ndarray:
    return np.cumsum(sizes) - sizes


def pack_bits(values: np.ndarray, widths: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Values of up to 32 bits, the widths given, as 32-bit words: ``counts`` values in each run, which begins with a new
    word. Gives the words and each run's number of words."""
    ends = np.r_[0, np.cumsum(widths, dtype=np.int64)]
    first = _starts(counts)
    bits = ends[first + counts] - ends[first]
    lengths = (bits + 31) >> 5
    at = ends[:-1] + np.repeat(_starts(lengths) * 32 - ends[first], counts)
    word, shift = at >> 5, (64 - widths - (at & 31)).astype(np.uint64)
    both = values.astype(np.uint64) << shift
    n = int(lengths.sum())
    # The bits of different values lie apart, so that sums put them together, and 32 of them are exact in a double.
    out = np.bincount(word, both >> _SHIFT32, n + 1) + np.bincount(word + 1, both & _LOW32, n + 1)[:n + 1]
    return out[:n].astype(np.uint32), lengths


def unpack_bits(words: np.ndarray, begin: np.ndarray, widths: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """The values that :func:`pack_bits` packed; ``begin``: the place of each run's first word."""
    ends = np.r_[0, np.cumsum(widths, dtype=np.int64)]
    at = ends[:-1] + np.repeat(begin * 32 - ends[_starts(counts)], counts)
    word = at >> 5
    both = words.take(word, mode="clip").astype(np.uint64) << _SHIFT32 | words.take(word + 1, mode="clip")
    both <<= (at & 31).astype(np.uint64)
    # No shift by 64, which is not defined, for values of no bits.
    return np.where(widths > 0, both >> np.minimum(64 - widths, 63).astype(np.uint64), 0).astype(np.int64)


def _symbols(ids: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For whole blocks (a row each, of the sizes given): the symbols, the ids' slots of order 0, and events for the
    coder: pair of confidences, symbol and whether orders 1 and 2 say the same, from the lowest bit."""
    hashes = np.zeros((ids.shape[0], ids.shape[1] + 2), np.uint32)
    np.multiply(ids, _HASH, out=hashes[:, 2:])
    slots = hashes[:, 2:] >> _SEEN_SHIFT
    hit1, confidence1 = _history(ids, hashes[:, 1:-1] >> _SLOT_SHIFT)
    hit2, confidence2 = _history(ids, _pair_slots(hashes[:, 1:-1], hashes[:, :-2]))
    hit0, _ = _history(ids, slots)
    sym = 2 - hit0.view(np.uint8)
    sym *= ~hit1
    sym += 1
    sym *= ~hit2
    events = confidence2 << 2 | confidence1 | sym << 4 | (hit1 & hit2).view(np.uint8) << 6
    sym[np.arange(ids.shape[1]) >= sizes[:, None]] = 4
    return sym, slots.astype(np.uint8), events


def _plain_bits(ids: np.ndarray, symbols: np.ndarray, slots: np.ndarray, model: Model) -> Iterator[tuple[bytes, bytes]]:
    """What stands in a block before and behind the range coder's words: counts, new ids' parts and the rest of them;
    slots."""
    is_new, is_slot = symbols == 3, symbols == 2
    n_new, n_slot = np.count_nonzero(is_new, axis=1), np.count_nonzero(is_slot, axis=1)
    new, slots = ids[is_new], slots[is_slot].tobytes()
    part = model.part.take(new)
    parts, parts_len = pack_bits(part, np.full(len(part), model.part_bits), n_new)
    rests, rests_len = pack_bits(new - model.first.take(part), model.rest_bits.take(part), n_new)
    parts, rests = parts.astype("<u4").tobytes(), rests.astype("<u4").tobytes()
    edges = [np.r_[0, np.cumsum(n)].tolist() for n in (4 * parts_len, 4 * rests_len, n_slot)]
    for k, (new, slot) in enumerate(zip(n_new.tolist(), n_slot.tolist())):
        a, b, c = (slice(e[k], e[k + 1]) for e in edges)
        yield struct.pack("<HH", new, slot) + parts[a] + rests[b], slots[c] + bytes(-slot % 4)


def code_blocks(blocks: list[np.ndarray], model: Model) -> list[bytes]:
    """Code each block of ids (at most BLOCK of them) on its own. All ids are known here, so what the contexts know before
    each id comes from sorting whole blocks; only shares and range go on step by step."""
    order = np.argsort([-len(b) for b in blocks], kind="stable")
    sizes = np.array([len(blocks[i]) for i in order], np.int64)
    out: list[bytes] = [b""] * len(blocks)
    lanes = int(np.count_nonzero(sizes))
    if not lanes:
        return out
    sizes, order = sizes[:lanes], order[:lanes].tolist()
    events = np.empty((int(sizes[0]), lanes), np.uint8)
    plain: list[tuple[bytes, bytes]] = []
    for a in range(0, lanes, SORT_LANES):
        own = sizes[a:a + SORT_LANES]
        ids = np.zeros((len(own), len(events)), np.uint32)
        for lane, i in enumerate(order[a:a + SORT_LANES]):
            ids[lane, :own[lane]] = blocks[i]
        symbols, slots, known = _symbols(ids, own)
        events[:, a:a + SORT_LANES] = known.T
        plain += _plain_bits(ids, symbols, slots, model)

    shares = _Shares(model, lanes)
    low, rng = np.zeros(lanes, np.uint64), np.full(lanes, 0xFFFFFFFFFFFFFFFF, np.uint64)
    words = np.zeros((lanes, int(sizes[0]) // SETTLE + 4), np.uint32)
    pos = np.zeros(lanes, np.intp)

    def settle(n: int) -> None:
        """Carries, and words that are done, of the first lanes."""
        carry = np.flatnonzero(low[:n] < before[:n])
        if len(carry):
            at = pos[carry] - 1
            while len(carry):
                words[carry, at] += _ONE
                over = words[carry, at] == 0
                carry, at = carry[over], at[over] - 1
        need = np.flatnonzero(rng[:n] < _TOP)
        if len(need):
            value, at = low[need], pos[need]
            words[need, at] = value >> _SHIFT32
            pos[need] = at + 1
            low[need] = value << _SHIFT32
            rng[need] <<= _SHIFT32

    running = lanes
    for t, n in _active(sizes):
        if t % SETTLE == 0:
            if t:
                settle(running)
            before, running = low.copy(), n
        event = events[t, :n]
        sym = event >> 4
        joint = sym >> 2
        sym &= 3
        shares.look(event & 15)
        below, share = shares.interval(sym, joint)
        r = rng[:n]
        r >>= _PROB_SHIFT
        below *= r
        low[:n] += below
        r *= share
        shares.learn(sym)
    settle(running)
    lane = np.arange(lanes)
    words[lane, pos] = low >> _SHIFT32
    words[lane, pos + 1] = low & _LOW32
    for k, (i, p, (head, tail)) in enumerate(zip(order, (pos + 2).tolist(), plain)):
        out[i] = head + words[k, :p].astype("<u4").tobytes() + tail
    return out


def decode_blocks(coded: list[bytes], counts: list[int], model: Model) -> list[np.ndarray]:
    """The ids of each block."""
    order = np.argsort([-c for c in counts], kind="stable")
    sizes = np.array([counts[i] for i in order], np.int64)
    out: list[np.ndarray] = [np.zeros(0, np.uint32)] * len(coded)
    lanes = int(np.count_nonzero(sizes))
    if not lanes:
        return out
    sizes, own = sizes[:lanes], [coded[i] for i in order[:lanes]]
    joined = b"".join(own)
    words, octets = np.frombuffer(joined, "<u4"), np.frombuffer(joined, np.uint8)
    length = np.array([len(c) for c in own], np.int64) >> 2
    begin = _starts(length)
    n_new, n_slot = (words[begin] & 0xFFFF).astype(np.int64), (words[begin] >> 16).astype(np.int64)
    new, pos = np.empty(int(n_new.sum()), np.uint32), np.empty(lanes, np.int64)
    new_pos = _starts(n_new)
    for a in range(0, lanes, SORT_LANES):
        group = slice(a, a + SORT_LANES)
        n, at = n_new[group], begin[group] + 1
        part = unpack_bits(words, at, np.full(int(n.sum()), model.part_bits), n)
        at += (n * model.part_bits + 31) >> 5
        bits = model.rest_bits.take(part)
        new[new_pos[a]:new_pos[a] + len(part)] = model.first.take(part) + unpack_bits(words, at, bits, n)
        upto = np.r_[0, np.cumsum(bits)]
        pos[group] = at + ((upto[np.cumsum(n)] - upto[_starts(n)] + 31) >> 5)
    slot_pos = 4 * (np.cumsum(length) - ((n_slot + 3) >> 2))

    ids = np.zeros((int(sizes[0]), lanes), np.uint32)
    state, shares = _Lanes(lanes), _Shares(model, lanes)
    rng = np.full(lanes, 0xFFFFFFFFFFFFFFFF, np.uint64)
    code = words.take(pos).astype(np.uint64) << _SHIFT32 | words.take(pos + 1)
    pos += 2
    running = lanes
    for t, n in _active(sizes):
        if t % SETTLE == 0:
            need = np.flatnonzero(rng[:running] < _TOP) if t else ()
            if len(need):
                at = pos[need]
                code[need] = code[need] << _SHIFT32 | words.take(at)
                pos[need] = at + 1
                rng[need] <<= _SHIFT32
            running = n
        state.predict(n)
        shares.look(state.confidence[n:] << _TWO | state.confidence[:n])
        guess1, guess2 = state.guess[:n], state.guess[n:]
        c, r = code[:n], rng[:n]
        r >>= _PROB_SHIFT
        value = (c // r).astype(np.int16)
        ends = shares.ends
        sym = (value >= ends[:, 1]).view(np.uint8) + (value >= ends[:, 2]).view(np.uint8)
        sym += (value >= ends[:, 3]).view(np.uint8)
        joint = (guess1 == guess2) & (sym < 2)
        sym *= ~joint
        below, share = shares.interval(sym, joint)
        below *= r
        c -= below
        r *= share
        is_slot = sym == 2
        at = slot_pos[:n]
        x = state.seen.take(state.seen_at + octets.take(at, mode="clip"), mode="clip")
        at += is_slot
        x = _pick(is_slot, x, _pick(sym == 0, guess2, guess1))
        far = np.flatnonzero(sym == 3)
        at = new_pos[far]
        x[far] = new.take(at)
        new_pos[far] = at + 1
        ids[t, :n] = x
        shares.learn(sym)
        state.learn(x)
    by_lane = np.ascontiguousarray(ids.T)
    for k, i in enumerate(order[:lanes].tolist()):
        out[i] = by_lane[k, :sizes[k]]
    return out


def _groups(blocks: int) -> list[slice]:
    """Blocks that go side by side: some LANES, a quarter more at most, in groups of one size, as a step on a few lanes
    costs hardly less than one on many."""
    n = -(-blocks // (LANES + LANES // 4))
    edges = [blocks * k // n for k in range(n + 1)] if n else [0]
    return [slice(a, b) for a, b in zip(edges, edges[1:])]


def pack_segments(segments: list[np.ndarray], model: Model) -> list[bytes]:
    """The body of each segment of ids."""
    cut = [[s[a:a + BLOCK] for a in range(0, len(s), BLOCK)] for s in segments]
    flat = list(chain.from_iterable(cut))
    coded: list[bytes] = []
    for group in _groups(len(flat)):
        coded += code_blocks(flat[group], model)
    out, at = [], 0
    for blocks in cut:
        own = coded[at:at + len(blocks)]
        at += len(blocks)
        head = struct.pack("<4sHII", MAGIC, VERSION, model.vocabulary, len(blocks))
        directory = b"".join(struct.pack("<III", len(b), len(c), zlib.crc32(c)) for b, c in zip(blocks, own))
        out.append(head + directory + b"".join(own))
    return out


def unpack_segments(bodies: list[bytes]) -> list[np.ndarray]:
    """The ids of each segment; a wrong magic word or checksum is an error."""
    coded, counts, owner, vocabularies = [], [], [], set()
    size = struct.calcsize("<4sHII")
    for k, body in enumerate(bodies):
        magic, version, vocabulary, n = struct.unpack_from("<4sHII", body)
        if magic != MAGIC or version != VERSION:
            raise ValueError("not a segment of token ids")
        vocabularies.add(vocabulary)
        at = size + 12 * n
        for b in range(n):
            ids, length, crc = struct.unpack_from("<III", body, size + 12 * b)
            part = body[at:at + length]
            if len(part) != length or zlib.crc32(part) != crc:
                raise ValueError(f"block {b} of a segment is damaged")
            at += length
            coded.append(part)
            counts.append(ids)
            owner.append(k)
    parts: list[list[np.ndarray]] = [[] for _ in bodies]
    if len(vocabularies) > 1:
        raise ValueError("segments of several vocabularies")
    if coded:
        model = Model(vocabularies.pop())
        for group in _groups(len(coded)):
            for k, ids in zip(owner[group], decode_blocks(coded[group], counts[group], model)):
                parts[k].append(ids)
    return [np.concatenate(p) if p else np.zeros(0, np.uint32) for p in parts]


class WordTokenizer:
    """Ids of texts by the tokenizers library. The tokenizer drops white space and never joins what a space or line feed
    parts, nor a letter and signs that end a word, so each distinct word of a batch is looked up once as a stem and the
    signs behind it, new ones are encoded once, and Arrow puts their ids (little-endian bytes) back in the texts' order.
    Stems over ``LONGEST_CACHED`` characters are not kept, so the cache is bounded in bytes; when it is full, the stems of
    the present batch stay. Normal forms change nothing in Latin-1 words but their case, so these are lower-cased here.
    Stems of Latin-1 letters are one piece each and need no other rule of the tokenizer than its merges."""

    #: Stands between words that go to the library together; words that hold it go alone and are left as they are.
    MARK = "|"
    LATIN = re.compile("[\x00-\xff]*")
    LETTERS = re.compile(f"[a-z\xdf-\xf6\xf8-\xff]{{1,{LONGEST_CACHED}}}")
    SIGNS = "!\"#$%&()*+,-./:;<=>?@[\\]^_`{}~"

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark runs a task on each core
        from tokenizers import Tokenizer, pre_tokenizers
        self.library = Tokenizer.from_file(path)
        self.vocabulary = self.library.get_vocab_size()
        self.mark, = self.library.encode(self.MARK, add_special_tokens=False).ids
        self.lower_cased = Tokenizer.from_str(json.dumps(json.loads(self.library.to_str()) | {"normalizer": None}))
        self.pieces = Tokenizer.from_str(json.dumps(json.loads(self.library.to_str()) | {
            "normalizer": None, "pre_tokenizer": {"type": "WhitespaceSplit"}}))
        self.is_last = np.zeros(self.vocabulary, bool)
        suffix = self.library.model.end_of_word_suffix
        self.is_last[[i for token, i in self.library.get_vocab().items() if token.endswith(suffix)]] = True
        octets = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)
        # The vocabulary's signs for octets, which stand for themselves but for these second octets of letters.
        second = {c - 0x40: octets.pre_tokenize_str(chr(c))[0][0][1] for c in range(0xdf, 0x100)}
        self.moved = [(chr(b), sign) for b, sign in second.items() if chr(b) != sign]
        sign, letter = np.zeros(256, bool), np.zeros(256, bool)
        sign[list(self.SIGNS.encode())] = letter[ord("a"):ord("z") + 1] = True
        self.is_sign, self.is_letter = sign, letter
        self.known: dict[str, int] = {}
        self.coded = pa.array([], pa.large_binary())  # the ids of the known stems

    def _alone(self, word: str) -> bytes:
        return np.array(self.library.encode(word, add_special_tokens=False).ids, "<u4").tobytes()

    def _together(self, words: list[str], library, lower: bool) -> Iterator[tuple[str, bytes]]:
        for at in range(0, len(words), 500):
            part = words[at:at + 500]
            line = f" {self.MARK} ".join(part) + f" {self.MARK}"
            encoded, = library.encode_batch_fast([line.lower() if lower else line], add_special_tokens=False)
            ids = np.array(encoded.ids, "<u4")
            ends = np.flatnonzero(ids == self.mark) * 4
            if len(ends) != len(part):
                raise ValueError("the tokenizer joins words")
            coded, a = ids.tobytes(), 0
            for word, b in zip(part, ends.tolist()):
                yield word, coded[a:b]
                a = b + 4

    def _letters(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of stems of letters, one after the other, and where each stem's end. A piece's last token, and no
        other, has the suffix."""
        found = [np.zeros(0, "<u4")]
        for at in range(0, len(words), 100):
            line = " ".join(words[at:at + 100])
            if not line.isascii():
                line = line.encode().decode("latin-1")
                for octet, sign in self.moved:
                    line = line.replace(octet, sign)
            encoded, = self.pieces.encode_batch_fast([line], add_special_tokens=False)
            found.append(np.array(encoded.ids, "<u4"))
        ids = np.concatenate(found)
        ends = np.flatnonzero(self.is_last[ids]) + 1
        if len(ends) != len(words):
            raise ValueError("a stem is not one piece")
        return ids, ends

    def _new(self, words: list[str]) -> tuple[list[str], int, pa.LargeBinaryArray]:
        """The words in some order, the number of those to keep, which come first, and the ids of all."""
        letters, out, latin, others = [], {}, [], []
        for w in words:
            if self.LETTERS.fullmatch(w):
                letters.append(w)
            elif self.MARK in w:
                out[w] = self._alone(w)
            else:
                (latin if w.isascii() or self.LATIN.fullmatch(w) else others).append(w)
        out.update(self._together(latin, self.lower_cased, True))
        out.update(self._together(others, self.library, False))
        rest = sorted(out, key=lambda w: len(w) > LONGEST_CACHED)
        ids, ends = self._letters(letters)
        ends = np.r_[0, ends].astype(np.int64) * 4
        coded = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(letters), [None, pa.py_buffer(ends), pa.py_buffer(ids)])
        kept = len(letters) + sum(len(w) <= LONGEST_CACHED for w in rest)
        return letters + rest, kept, pa.concat_arrays([coded, pa.array([out[w] for w in rest], pa.large_binary())])

    def _stems(self, words: pa.StringArray) -> pa.StringArray:
        """Of each word the stem and the signs behind it (or nothing), one after the other. Latin-1 words without a mark
        are lower-cased, and their signs parted if they follow a letter; other words are their own stems."""
        edges = np.frombuffer(words.buffers()[1], np.int32)[words.offset:words.offset + len(words) + 1]
        data = np.frombuffer(words.buffers()[2] or b"", np.uint8)[edges[0]:edges[-1]].copy()
        edges = edges - edges[0]
        lead = np.r_[False, data[:-1] == 0xC3]  # before the second byte of U+00C0 to U+00FF
        strange = np.r_[0, np.cumsum((data >= 0xC4) | (data == ord(self.MARK)), dtype=np.int32)]
        plain = strange[edges[1:]] == strange[edges[:-1]]
        upper = ((data - 65).view(np.uint8) < 26) | (lead & (data < 0x9F) & (data != 0x97))
        upper &= np.repeat(plain, np.diff(edges))
        data += upper.view(np.uint8) << 5
        lower = self.is_letter[data] | (lead & (data >= 0x9F) & (data != 0xB7))
        ends = edges[1:].copy()
        open_ = np.flatnonzero(plain & (ends > edges[:-1]))
        while len(open_):
            open_ = open_[self.is_sign[data[ends[open_] - 1]]]
            ends[open_] -= 1
            open_ = open_[ends[open_] > edges[:-1][open_]]
        cut = (ends < edges[1:]) & (ends > edges[:-1])
        cut[cut] = lower[ends[cut] - 1]
        both = np.empty(2 * len(words) + 1, np.int32)
        both[::2], both[1::2] = edges, np.where(cut, ends, edges[1:])
        return pa.StringArray.from_buffers(2 * len(words), pa.py_buffer(both), pa.py_buffer(data))

    def encode_batch(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts, one after the other (null: empty), and where each text's begin, and the end."""
        lists = pc.split_pattern(pc.replace_substring(pc.fill_null(texts, ""), "\n", " "), " ")
        words = lists.flatten().dictionary_encode()
        stems = self._stems(words.dictionary).dictionary_encode()
        names = stems.dictionary.to_numpy(zero_copy_only=False).tolist()
        places = np.fromiter(map(self.known.get, names, repeat(-1)), np.int64, len(names))
        missing = np.flatnonzero(places < 0)
        coded = self.coded
        if len(missing):
            new, kept, own = self._new([names[i] for i in missing])
            at = dict(zip(new, range(len(coded), len(coded) + len(new))))
            places[missing] = [at[names[i]] for i in missing]
            coded = pa.concat_arrays([coded, own])
            if len(self.known) + kept > CACHED_WORDS:
                stay = [(w, p) for w, p in zip(names, places.tolist()) if len(w) <= LONGEST_CACHED][:CACHED_WORDS]
                self.known = {w: i for i, (w, _) in enumerate(stay)}
                self.coded = coded.take(pa.array([p for _, p in stay], pa.int64()))
            else:
                self.known.update((w, at[w]) for w in new[:kept])
                self.coded = coded.slice(0, len(coded) - len(new) + kept)
        halves = coded.take(pa.array(places)).take(stems.indices)
        edges = np.frombuffer(halves.buffers()[1], np.int64, len(halves) + 1)[::2].copy()
        whole = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(edges) - 1, [None, pa.py_buffer(edges), halves.buffers()[2]])
        flat = whole.take(words.indices)
        edges = np.frombuffer(flat.buffers()[1], np.int64, len(flat) + 1) // 4
        ids = np.frombuffer(flat.buffers()[2], "<u4", int(edges[-1])) if edges[-1] else np.zeros(0, np.uint32)
        return ids, edges[lists.offsets.to_numpy()]


@lru_cache(2)
def tokenizer(path: str) -> WordTokenizer:
    return WordTokenizer(path)


SEGMENT_SCHEMA = ("shard int, segment int, first long, n_ids long, doc_ids array<long>, counts array<int>, body binary")


def _write_segments(batches: Iterator[pa.RecordBatch], path: str) -> Iterator[pa.RecordBatch]:
    tok = tokenizer(path)
    model = Model(tok.vocabulary)
    shard = TaskContext.get().partitionId()
    docs: list[tuple[int | None, np.ndarray]] = []
    segment, first, held = 0, 0, 0

    def flush() -> Iterator[pa.RecordBatch]:
        nonlocal segment, first, held
        groups, size = [[]], 0
        for d in docs:
            if size >= SEGMENT_IDS:
                groups.append([])
                size = 0
            groups[-1].append(d)
            size += len(d[1])
        joined = [np.concatenate([x for _, x in g]) for g in groups]
        rows = []
        for g, ids, body in zip(groups, joined, pack_segments(joined, model)):
            rows.append((shard, segment, first, len(ids), [i for i, _ in g], [len(x) for _, x in g], body))
            segment, first = segment + 1, first + len(ids)
        docs.clear()
        held = 0
        cols = list(zip(*rows))
        types = [pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.list_(pa.int64()), pa.list_(pa.int32()), pa.binary()]
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, types)],
                                         names=["shard", "segment", "first", "n_ids", "doc_ids", "counts", "body"])

    for whole in batches:
        upto = np.cumsum(pc.fill_null(pc.binary_length(whole.column(1)), 0).to_numpy(zero_copy_only=False).astype(np.int64))
        cuts = [0, *(np.flatnonzero(np.diff(upto // BATCH_BYTES)) + 1).tolist(), whole.num_rows]
        for at, end in zip(cuts, cuts[1:]):
            b = whole.slice(at, end - at)
            ids, edges = tok.encode_batch(b.column(1))
            for doc_id, begin, end in zip(b.column(0).to_pylist(), edges[:-1].tolist(), edges[1:].tolist()):
                docs.append((doc_id, np.append(ids[begin:end], np.uint32(END_ID))))
                held += end - begin + 1
                if held >= LANES * BLOCK:
                    yield from flush()
    if docs:
        yield from flush()


def write_tokens(docs: DataFrame, folder: str, path: str | None = None) -> None:
    """Write the ids of every text, in ascending doc_id order over all files, to ``folder``."""
    path = path or public_tokenizers.path(TOKENIZER)
    rows = docs.select("doc_id", text_or_empty().alias("text"))
    ordered = rows.repartitionByRange("doc_id").sortWithinPartitions("doc_id", F.xxhash64("text"))
    ordered.mapInArrow(lambda it: _write_segments(it, path), SEGMENT_SCHEMA).write.parquet(folder)


def _segments(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[list[dict], list[np.ndarray]]]:
    """Rows and ids, as many segments at a time as fill the lanes."""
    held, size = [], 0
    for b in batches:
        for row in b.to_pylist():
            held.append(row)
            size += row["n_ids"]
            if size >= LANES * BLOCK:
                yield held, unpack_segments([r["body"] for r in held])
                held, size = [], 0
    if held:
        yield held, unpack_segments([r["body"] for r in held])


def _documents(batches: Iterator[pa.RecordBatch], with_ids: bool) -> Iterator[pa.RecordBatch]:
    for rows, ids in _segments(batches):
        for row, own in zip(rows, ids):
            edges = np.r_[0, np.cumsum(row["counts"])].astype(np.int64)
            parts = [own[a:b] for a, b in zip(edges[:-1], edges[1:])]
            columns = [pa.array([row["shard"]] * len(parts), pa.int32()), pa.array(row["doc_ids"], pa.int64()),
                       pa.array(row["first"] + edges[:-1], pa.int64()), pa.array(row["counts"], pa.int64()),
                       pa.array([zlib.crc32(p.astype("<u4").tobytes()) for p in parts], pa.int64())]
            names = ["shard", "doc_id", "at", "n_tokens", "ids_crc32"]
            if with_ids:
                columns.append(pa.array([p.astype(np.int32) for p in parts], pa.list_(pa.int32())))
                names.append("ids")
            yield pa.RecordBatch.from_arrays(columns, names=names)


def read_tokens(spark: SparkSession, folder: str, with_ids: bool = False) -> DataFrame:
    """Per document of the files: doc_id, start (ids of all documents before it), n_tokens, ids_crc32 and, if asked
    for, ids. The shards' starts come from the narrow columns of the segments, one row per shard."""
    files = spark.read.parquet(folder)
    per_shard = files.groupBy("shard").agg(F.sum("n_ids").alias("n"))
    in_order = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    begin = per_shard.select(F.col("shard").alias("s"), F.coalesce(F.sum("n").over(in_order), F.lit(0)).alias("begin"))
    schema = "shard int, doc_id long, at long, n_tokens long, ids_crc32 long" + (", ids array<int>" if with_ids else "")
    docs = files.mapInArrow(lambda it: _documents(it, with_ids), schema)
    return docs.join(begin, F.col("shard") == F.col("s")).select(
        "doc_id", (F.col("begin") + F.col("at")).alias("start"), "n_tokens", "ids_crc32", *(["ids"] if with_ids else []))


def op1_token_output(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = scratch_path(spark, "token-ids")
    write_tokens(table(spark, sf_dir, "documents"), folder)
    return read_tokens(spark, folder)


QUERIES = {"op1_token_output": op1_token_output}
