"""Byte-level BPE encoding and decoding in padded matrices.

A text is cut by the split pattern. The different pieces of a chunk of texts that are not
tokens themselves go to matrices of similar length, padded with -1. In every
round, each piece merges its leftmost pair of minimum rank; ranks come from a hash table of
(left id, right id), open addressing in numpy arrays. The ids right of the merge close up,
pieces without a pair leave the matrix. Ids of a text are those of its pieces in order.

A piece longer than the widest bucket (``WIDTHS``) would cost one round of its whole length for
each merge; those few take the same merges from a priority queue. Both give what the merges of
byte pairs by rank give one at a time.

Defined results: null and empty texts have no ids; every row gets a result, repeated or not; an
empty table gives none. Memory is bounded by a chunk of texts (``common.CHUNK_CHARS``) and
the longest text. Other columns are not looked at.
"""

import base64
import hashlib
import heapq
from collections.abc import Iterator
from functools import cache, cached_property

import numpy as np
import public_tokenizers
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from riskwindow.llm import common

VOCABULARY = "byte_bpe_50k.tiktoken"
WIDTHS = (4, 6, 8, 10, 12, 16, 20, 24, 32, 48, 64, 128, 256, 512)
CELLS = 1 << 19
#: Different pieces whose ids a worker keeps for the next texts; beyond that it starts anew.
MEMO = 150_000
_NONE = np.int32(2**31 - 1)
_FACTOR = np.uint64(0x9E3779B97F4A7C15)
_ID_BITS = 20


class Vocabulary:
    """Tokens by rank, with a hash table of the pairs whose bytes together are a token."""

    def __init__(self, path: str, pattern: str = public_tokenizers.PATTERN):
        with open(path, "rb") as lines:
            parts = [line.split() for line in lines if line.strip()]
        self.rank = {base64.b64decode(a): int(b) for a, b in parts}
        self.token = {i: t for t, i in self.rank.items()}
        self.byte = np.array([self.rank[bytes([i])] for i in range(256)], dtype=np.int32)
        self.pattern = regex.compile(pattern)

    @cached_property
    def pairs(self) -> dict[tuple[int, int], int]:
        """(left id, right id) -> id of the token that their bytes make."""
        found = {}
        for token, rank in self.rank.items():
            for cut in range(1, len(token)):
                left, right = self.rank.get(token[:cut]), self.rank.get(token[cut:])
                if left is not None and right is not None:
                    found[left, right] = rank
        return found

    @cached_property
    def _slots(self) -> tuple[np.ndarray, np.ndarray, np.uint64]:
        left, right, ranks = (
            np.array(x, dtype=np.uint64) for x in zip(*[(a, b, r) for (a, b), r in self.pairs.items()])
        )
        keys = left << np.uint64(_ID_BITS) | right
        bits = max(4, int(4 * len(keys)).bit_length())
        shift = np.uint64(64 - bits)
        table = np.full(1 << bits, np.uint64(2**64 - 1))
        values = np.full(1 << bits, _NONE, dtype=np.int32)
        slots, waiting = (keys * _FACTOR) >> shift, np.arange(len(keys))
        while len(waiting):
            free = table[slots[waiting]] == np.uint64(2**64 - 1)
            at, first = np.unique(slots[waiting[free]], return_index=True)
            placed = waiting[free][first]
            table[at], values[at] = keys[placed], ranks[placed].astype(np.int32)
            waiting = np.setdiff1d(waiting, placed, assume_unique=True)
            slots[waiting] = (slots[waiting] + np.uint64(1)) % np.uint64(1 << bits)
        return table, values, shift

    def pair_ranks(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Rank of each pair, _NONE where it is no token or one side is padding."""
        table, values, shift = self._slots
        keys = (left.astype(np.uint64) << np.uint64(_ID_BITS) | right.astype(np.uint64)).ravel()
        slots = (keys * _FACTOR) >> shift
        ranks = np.full(len(keys), _NONE, dtype=np.int32)
        at = np.flatnonzero((right >= 0).ravel())
        while len(at):
            held, wanted = table[slots[at]], keys[at]
            hit = held == wanted
            ranks[at[hit]] = values[slots[at[hit]]]
            at = at[~hit & (held != np.uint64(2**64 - 1))]
            slots[at] = (slots[at] + np.uint64(1)) % np.uint64(len(table))
        return ranks.reshape(left.shape)

    @cached_property
    def byte_pairs(self) -> np.ndarray:
        """Rank of each pair of bytes, at 256 * left + right."""
        left, right = np.divmod(np.arange(65_536), 256)
        return self.pair_ranks(self.byte[left], self.byte[right])

    def merge_rows(self, pieces: list[bytes], width: int) -> list[list[int]]:
        """Ids of pieces of at most ``width`` bytes, one column of a matrix for each piece.

        Pieces stand in columns, so that every step runs along rows that lie together.
        """
        lengths = np.array([len(p) for p in pieces])
        raw = np.frombuffer(b"".join(p.ljust(width, b"\0") for p in pieces), dtype=np.uint8)
        raw = np.ascontiguousarray(raw.reshape(-1, width).T)
        place = np.arange(width)[:, None]
        ids = np.where(place < lengths, self.byte[raw], np.int32(-1))
        ranks = self.byte_pairs[raw[:-1].astype(np.int32) * 256 + raw[1:]]
        ranks[place[1:] >= lengths] = _NONE
        done: list[list[int]] = [[] for _ in pieces]
        rows = np.arange(len(pieces))
        while len(rows):
            at = ranks.argmin(axis=0)  # the first of the least
            best = ranks[at, np.arange(len(rows))]
            if (best == _NONE).any():
                ended, going = np.flatnonzero(best == _NONE), np.flatnonzero(best != _NONE)
                for row, n, own in zip(
                    rows[ended].tolist(), lengths[ended].tolist(), ids[:, ended].T.tolist()
                ):
                    done[row] = own[:n]
                ids, ranks = ids[:, going], ranks[:, going]
                rows, lengths, at, best = rows[going], lengths[going], at[going], best[going]
                if not len(rows):
                    break
            n = np.arange(len(rows))
            ids = np.where(place[: len(ids) - 1] > at, ids[1:], ids[:-1])
            ids[at, n] = best
            lengths = lengths - 1
            if len(ids) == 1:  # of every piece one token is left
                ranks = np.full((1, len(rows)), _NONE)
                continue
            ranks = np.where(place[: len(ranks) - 1] > at, ranks[1:], ranks[:-1])
            # Only the pairs on both sides of the new token have changed.
            left, here = np.maximum(at - 1, 0), np.minimum(at, len(ranks) - 1)
            ranks[left, n] = self.pair_ranks(ids[left, n], ids[left + 1, n])
            ranks[here, n] = self.pair_ranks(ids[here, n], ids[here + 1, n])
        return done

    def merge_long(self, piece: bytes) -> list[int]:
        """Ids of one long piece: the same merges, taken from a priority queue."""
        ids = self.byte[np.frombuffer(piece, dtype=np.uint8)].tolist()
        after, before = list(range(1, len(ids) + 1)), list(range(-1, len(ids) - 1))
        rank_of = self.pairs.get
        queue = [
            (r, i, ids[i], ids[i + 1])
            for i in range(len(ids) - 1)
            if (r := rank_of((ids[i], ids[i + 1]))) is not None
        ]
        heapq.heapify(queue)
        while queue:
            rank, i, left, right = heapq.heappop(queue)
            j = after[i]
            if ids[i] != left or j >= len(ids) or ids[j] != right:
                continue  # one side has been merged meanwhile
            ids[i], ids[j] = rank, -1
            after[i] = after[j]
            if after[j] < len(ids):
                before[after[j]] = i
            for a in (before[i], i):
                b = after[a] if a >= 0 else len(ids)
                if b < len(ids) and (r := rank_of((ids[a], ids[b]))) is not None:
                    heapq.heappush(queue, (r, a, ids[a], ids[b]))
        return [x for x in ids if x >= 0]

    def encode_pieces(self, pieces: list[bytes]) -> list[list[int]]:
        """Ids of each of the given different pieces."""
        out = [[whole] if (whole := self.rank.get(p)) is not None else None for p in pieces]
        lengths = np.array([0 if x else len(p) for x, p in zip(out, pieces)], dtype=np.int64)
        for i in np.flatnonzero(lengths > WIDTHS[-1]).tolist():
            out[i] = self.merge_long(pieces[i])
        for least, width in zip((0, *WIDTHS), WIDTHS):
            members = np.flatnonzero((lengths > least) & (lengths <= width)).tolist()
            step = max(1, CELLS // width)
            for at in range(0, len(members), step):
                part = members[at : at + step]
                for i, ids in zip(part, self.merge_rows([pieces[i] for i in part], width)):
                    out[i] = ids
        return out

    def encode(self, texts: list[str | None]) -> list[list[int]]:
        """Ids of each text."""
        cut = [self.pattern.findall(t) if t else [] for t in texts]
        different = list({p: None for pieces in cut for p in pieces})
        ids = dict(zip(different, self.encode_pieces([p.encode() for p in different])))
        return [[x for p in pieces for x in ids[p]] for pieces in cut]

    def decode(self, ids: list[int]) -> bytes:
        return b"".join(map(self.token.__getitem__, ids))


@cache
def vocabulary(name: str = VOCABULARY) -> Vocabulary:
    return Vocabulary(public_tokenizers.path(name))


def encoded(docs: DataFrame, name: str = VOCABULARY) -> DataFrame:
    """doc_id, ids (array of int) and decoded (binary) of every row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = vocabulary(name)
        for batch in common.chunks(batches):
            ids = words.encode(batch.column("text").to_pylist())
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    pa.array(ids, pa.list_(pa.int32())),
                    pa.array([words.decode(x) for x in ids], pa.binary()),
                ],
                names=["doc_id", "ids", "decoded"],
            )

    return common.keyed(docs, "text").drop("text_key").mapInArrow(
        run, "doc_id long, ids array<int>, decoded binary"
    )


def digests(docs: DataFrame, name: str = VOCABULARY) -> DataFrame:
    """doc_id, n_tokens and the digests of the ids and of the decoded bytes of every row.

    Ids are written and decoded once for each different piece of a chunk.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = vocabulary(name)
        said: dict[str, str] = {}
        back: dict[str, bytes] = {}
        for batch in common.chunks(batches):
            cut = [words.pattern.findall(t) if t else [] for t in batch.column("text").to_pylist()]
            different = {p for pieces in cut for p in pieces}
            if len(said) > MEMO:
                said.clear()
                back.clear()
            new = [p for p in different if p not in said]
            ids = words.encode_pieces([p.encode() for p in new])
            said.update(zip(new, (" ".join(map(str, x)) for x in ids)))
            back.update(zip(new, map(words.decode, ids)))
            lines = [" ".join(map(said.__getitem__, p)) for p in cut]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    pa.array([x.count(" ") + 1 if x else 0 for x in lines], pa.int64()),
                    pa.array([_sha(x.encode()) for x in lines], pa.string()),
                    pa.array([_sha(b"".join(map(back.__getitem__, p))) for p in cut], pa.string()),
                ],
                names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"],
            )

    return common.keyed(docs, "text").drop("text_key").mapInArrow(
        run, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"
    )


def _sha(raw: bytes) -> str:
    return hashlib.sha256(raw).hexdigest()


def op7_bpe(spark, sf_dir: str) -> DataFrame:
    return digests(common.table(spark, sf_dir, "documents"))
