"""Byte-level BPE: vectorised pre-tokenisation with classes and scans, cached pair merging, decoding.

Pre-tokenisation. The texts of a batch become one array of code points, each with a small class number (letters that
matter to contractions, other letters, numbers, apostrophe, other signs, space, other white space, text start). A class
is a function from the automaton's state to its next state, and functions compose associatively, so the states of all
places come from a scan: the array is cut into short blocks, all blocks compose their functions side by side, the
composed functions are chained over the blocks (the same scan again, until one block is left), and the blocks then run
side by side from their true states. Piece starts follow from neighbouring states and classes.

Merging. A piece's bytes are merged by rank, lowest rank first and leftmost among equals. Short pieces are merged in a
loop and cached (``CACHED_PIECES`` at most, then afresh); long ones with a heap over a linked list, so that a piece of
n bytes costs n log n. Pieces keep their order, and a token's bytes have a fixed length, so offsets of tokens in the
decoded bytes are running sums of token lengths: :func:`token_spans` gives them back.

Defined results: a null or empty text has no tokens and decodes to no bytes; repeated rows are encoded row by row; an
empty table gives an empty result; every byte is a token of the rank file, so any text can be encoded, whatever its
length. Texts are encoded where they are read: no shuffle.
"""

from __future__ import annotations

import base64
import hashlib
import heapq
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain

import numpy as np
import public_tokenizers
import pyarrow as pa
import tiktoken
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from nightaudit.llm.common import table, text_or_empty

RANKS = "byte_bpe_50k.tiktoken"
CACHED_PIECES = 150_000
SHORT = 48
BLOCK = 64
#: Code points that are scanned together; a longer text is scanned alone.
SCAN_CHARS = 400_000

# Classes of code points. The letters of contractions have their own: 's 't 'm 'd end at once, 're 've 'll need one more.
OTHER, LETTER, ENDS, R_OR_V, E, L, NUMBER, APOSTROPHE, SPACE, WHITE, START = range(11)
N_CLASSES = 11
# States: what stands at the place. Q: apostrophe that begins a piece; RV, LL1: first letter after it, may go on;
# DONE: last letter of a contraction.
S_SIGNS, S_LETTERS, S_NUMBERS, S_WHITE, S_SPACE, S_Q, S_RV, S_LL1, S_DONE, S_BEGIN = range(10)
N_STATES = 10


def _transitions() -> np.ndarray:
    t = np.zeros((N_CLASSES, N_STATES), np.uint8)
    t[START] = S_BEGIN
    t[NUMBER] = S_NUMBERS
    t[SPACE] = S_SPACE
    t[WHITE] = S_WHITE
    t[OTHER] = S_SIGNS
    for c in (LETTER, ENDS, R_OR_V, E, L):
        t[c] = S_LETTERS
    t[ENDS, S_Q] = S_DONE
    t[R_OR_V, S_Q] = S_RV
    t[L, S_Q] = S_LL1
    t[E, S_RV] = S_DONE
    t[L, S_LL1] = S_DONE
    # An apostrophe begins a piece unless signs, or a space that it follows, run on into it. After an apostrophe that
    # could have begun a contraction the signs run on as well.
    t[APOSTROPHE] = S_Q
    t[APOSTROPHE, [S_SIGNS, S_SPACE, S_Q]] = S_SIGNS
    return t


TRANSITIONS = _transitions()


@lru_cache(1)
def class_table() -> np.ndarray:
    """The class of every code point. Letters, numbers and white space are what the tokenizer library itself takes
    for them, so that its Unicode version holds."""
    every = "".join(chr(cp) for cp in range(0x110000) if not 0xD800 <= cp < 0xE000)
    single = {bytes([b]): b for b in range(256)}
    table_ = np.zeros(0x110000, np.uint8)
    for pattern, cls in ((r"\p{L}", LETTER), (r"\p{N}", NUMBER), (r"\s", WHITE)):
        found = bytes(tiktoken.Encoding(pattern, pat_str=pattern, mergeable_ranks=single,
                                        special_tokens={}).encode_ordinary(every)).decode()
        table_[np.frombuffer(found.encode("utf-32-le"), np.uint32)] = cls
    table_[0x20] = SPACE
    for chars, cls in (("stmd", ENDS), ("rv", R_OR_V), ("e", E), ("l", L), ("'", APOSTROPHE)):
        table_[[ord(c) for c in chars]] = cls
    return table_


def scan_states(classes: np.ndarray, begin: int = S_BEGIN) -> np.ndarray:
    """The automaton's state at every place, by composing transition functions block by block."""
    flat = TRANSITIONS.reshape(-1)

    def runs(functions: np.ndarray, state: int) -> np.ndarray:
        """States before each of a row of functions (n x N_STATES), beginning with ``state``."""
        n = len(functions)
        if n <= BLOCK:
            out = np.empty(n, np.uint8)
            for i in range(n):
                out[i] = state
                state = functions[i, state]
            return out
        blocks = -(-n // BLOCK)
        padded = np.tile(np.arange(N_STATES, dtype=np.uint8), (blocks * BLOCK, 1))
        padded[:n] = functions
        padded = padded.reshape(blocks, BLOCK, N_STATES)
        composed = padded[:, 0]
        for k in range(1, BLOCK):
            composed = np.take_along_axis(padded[:, k], composed, axis=1)
        entry = runs(composed, state)
        out = np.empty((blocks, BLOCK), np.uint8)
        rows = np.arange(blocks)
        for k in range(BLOCK):
            out[:, k] = entry
            entry = padded[rows, k, entry]
        return out.reshape(-1)[:n]

    n = len(classes)
    blocks = -(-n // BLOCK)
    padded = np.zeros(blocks * BLOCK, np.uint8)
    padded[:n] = classes
    by_place = np.ascontiguousarray(padded.reshape(blocks, BLOCK).T).astype(np.intp) * N_STATES
    composed = np.tile(np.arange(N_STATES, dtype=np.uint8)[:, None], (1, blocks))
    for k in range(BLOCK):
        composed = flat[by_place[k] + composed]
    state = runs(np.ascontiguousarray(composed.T), begin)
    out = np.empty((BLOCK, blocks), np.uint8)
    for k in range(BLOCK):
        state = flat[by_place[k] + state]
        out[k] = state
    return np.ascontiguousarray(out.T).reshape(-1)[:n]


def piece_starts(points: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Start places of all pieces. ``points``: code points of texts one after another, each behind one mark of any
    value; ``first``: the places of these marks."""
    classes = class_table()[points]
    classes[first] = START
    state = scan_states(classes)
    kind = np.array([0, 1, 2, 3, 3, 0, 1, 1, 1, 4], np.uint8)[state]  # signs, letters, numbers, white space, mark
    after_state, after_kind = np.r_[state[1:], S_BEGIN].astype(np.uint8), np.r_[kind[1:], 4].astype(np.uint8)
    before_kind = np.r_[4, kind[:-1]].astype(np.uint8)
    before_state = np.r_[S_BEGIN, state[:-1]].astype(np.uint8)
    start = kind != before_kind
    # A single space belongs to what follows it.
    start &= ~((before_state == S_SPACE) & (kind < 3))
    # The last of several white-space characters is a piece of its own, or begins the next one, unless the text ends.
    start |= (kind == 3) & (after_kind < 3)
    # Contractions: the letters belong to the apostrophe, what follows begins anew.
    done_two = (state == S_DONE) & ((before_state == S_RV) | (before_state == S_LL1))
    start &= ~((state == S_DONE) & (before_state == S_Q)) & ~done_two
    open_ = (state == S_RV) | (state == S_LL1)
    start = np.where(open_, after_state != S_DONE, start)
    start |= (before_state == S_DONE) & (kind < 3)
    start[first] = False
    return np.flatnonzero(start)


def split_pieces(texts: list[str]) -> list[list[str]]:
    """The pieces of every text."""
    out: list[list[str]] = []
    at = 0
    while at < len(texts):
        upto, size = at, 0
        while upto < len(texts) and (upto == at or size + len(texts[upto]) < SCAN_CHARS):
            size += len(texts[upto]) + 1
            upto += 1
        joined = "\0" + "\0".join(texts[at:upto])
        points = np.frombuffer(joined.encode("utf-32-le"), np.uint32)
        marks = np.cumsum([0] + [len(t) + 1 for t in texts[at:upto]])
        starts = piece_starts(points, marks[:-1])
        edges = np.searchsorted(starts, marks)
        places = starts.tolist()
        for i in range(upto - at):
            own = places[edges[i]:edges[i + 1]]
            out.append([joined[a:b] for a, b in zip(own, [*own[1:], int(marks[i + 1])])])
        at = upto
    return out


def _merge_short(ranks: dict[bytes, int], parts: list[bytes]) -> list[bytes]:
    never = len(ranks) + 1
    found = [ranks.get(a + b, never) for a, b in zip(parts, parts[1:])]  # of each part with the next one
    while found:
        r = min(found)
        if r == never:
            break
        i = found.index(r)
        parts[i:i + 2] = [parts[i] + parts[i + 1]]
        del found[i]
        if i < len(found):
            found[i] = ranks.get(parts[i] + parts[i + 1], never)
        if i:
            found[i - 1] = ranks.get(parts[i - 1] + parts[i], never)
    return parts


def _merge_long(ranks: dict[bytes, int], parts: list) -> list[bytes]:
    n = len(parts)
    after, before = list(range(1, n + 1)), list(range(-1, n - 1))
    heap = []

    def offer(i: int) -> None:
        j = after[i]
        if j < n:
            r = ranks.get(parts[i] + parts[j])
            if r is not None:
                heapq.heappush(heap, (r, i, parts[i], parts[j]))

    for i in range(n):
        offer(i)
    while heap:
        _, i, x, y = heapq.heappop(heap)
        j = after[i]
        if parts[i] is not x or j >= n or parts[j] is not y:
            continue  # one of the two has been merged meanwhile
        parts[i], parts[j] = x + y, None
        after[i] = after[j]
        if after[j] < n:
            before[after[j]] = i
        offer(i)
        if before[i] >= 0:
            offer(before[i])
    return [p for p in parts if p is not None]


class Encoder(dict):
    """Maps a piece to its ids; ``ranks`` from a rank file."""

    def __init__(self, ranks: dict[bytes, int]):
        super().__init__()
        self.ranks = ranks
        self.bytes_of = {i: b for b, i in ranks.items()}
        self.decimal = {i: str(i) for i in ranks.values()}

    def __missing__(self, piece: str) -> tuple[int, ...]:
        raw = piece.encode()
        whole = self.ranks.get(raw)
        if whole is not None:
            ids = (whole,)
        else:
            parts = [raw[i:i + 1] for i in range(len(raw))]
            merged = _merge_short(self.ranks, parts) if len(raw) <= SHORT else _merge_long(self.ranks, parts)
            ids = tuple(map(self.ranks.__getitem__, merged))
        if len(raw) <= SHORT:
            if len(self) >= CACHED_PIECES:
                self.clear()
            self[piece] = ids
        return ids

    def encode_batch(self, texts: list[str]) -> list[list[int]]:
        return [list(chain.from_iterable(map(self.__getitem__, pieces))) for pieces in split_pieces(texts)]

    def decode(self, ids) -> bytes:
        return b"".join(map(self.bytes_of.__getitem__, ids))


def token_spans(encoder: Encoder, ids) -> np.ndarray:
    """Byte offsets (start, end) of each token in the decoded bytes."""
    ends = np.cumsum([len(encoder.bytes_of[i]) for i in ids], dtype=np.int64)
    return np.stack([np.r_[0, ends[:-1]], ends], axis=1) if len(ends) else np.zeros((0, 2), np.int64)


def load_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}


@lru_cache(2)
def encoder(path: str) -> Encoder:
    """One encoder a worker process, loaded from the tokenizer file that every node has."""
    return Encoder(load_ranks(path))


def _encoded(batches: Iterator[pa.RecordBatch], path: str, work) -> Iterator[pa.RecordBatch]:
    enc = encoder(path)
    for whole in batches:
        for at in range(0, whole.num_rows, 500):
            b = whole.slice(at, 500)
            yield work(enc, b.column(0), enc.encode_batch(b.column(1).to_pylist()))


def _digests(enc: Encoder, doc_ids: pa.Array, ids: list[list[int]]) -> pa.RecordBatch:
    sha = hashlib.sha256
    return pa.RecordBatch.from_arrays([
        doc_ids, pa.array([len(x) for x in ids], pa.int64()),
        pa.array([sha(" ".join(map(enc.decimal.__getitem__, x)).encode()).hexdigest() for x in ids], pa.string()),
        pa.array([sha(enc.decode(x)).hexdigest() for x in ids], pa.string()),
    ], names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])


def _ids(enc: Encoder, doc_ids: pa.Array, ids: list[list[int]]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([doc_ids, pa.array(ids, pa.list_(pa.int32()))], names=["doc_id", "ids"])


def _whole(enc: Encoder, doc_ids: pa.Array, ids: list[list[int]]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([*_digests(enc, doc_ids, ids).columns, _ids(enc, doc_ids, ids).column(1)],
                                      names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256", "ids"])


def encode(docs: DataFrame, path: str | None = None) -> DataFrame:
    """(doc_id, ids): the token ids of every text."""
    path = path or public_tokenizers.path(RANKS)
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_or_empty().alias("text")).mapInArrow(
        lambda it: _encoded(it, path, _ids), "doc_id long, ids array<int>")


def decode(encoded: DataFrame, path: str | None = None) -> DataFrame:
    """(doc_id, text) from (doc_id, ids); ids that are no whole text become replacement characters."""
    path = path or public_tokenizers.path(RANKS)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(path)
        for b in batches:
            texts = [enc.decode(x or ()).decode("utf-8", "replace") for x in b.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(texts, pa.string())], names=["doc_id", "text"])

    return encoded.select("doc_id", "ids").mapInArrow(work, "doc_id long, text string")


def digests(docs: DataFrame, path: str | None = None) -> DataFrame:
    """Per row of ``docs``: doc_id, n_tokens, and SHA-256 of the decimal ids and of the bytes decoded from them."""
    path = path or public_tokenizers.path(RANKS)
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_or_empty().alias("text")).mapInArrow(
        lambda it: _encoded(it, path, _digests),
        "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")


def encode_checked(docs: DataFrame, path: str | None = None) -> DataFrame:
    """The columns of :func:`digests` and the ids, from one pass over the texts."""
    path = path or public_tokenizers.path(RANKS)
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_or_empty().alias("text")).mapInArrow(
        lambda it: _encoded(it, path, _whole),
        "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string, ids array<int>")


def op8_byte_level_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return digests(table(spark, sf_dir, "documents"))


QUERIES = {"op8_byte_level_bpe": op8_byte_level_bpe}
