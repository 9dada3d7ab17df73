"""Token counts of a word-piece vocabulary by a longest-match automaton.

A word is cut greedily into the longest piece that begins it and then the longest pieces that continue it; a word
that cannot be cut to its end is one unknown token. The automaton has a trie of the pieces that
begin words and one of those that continue them. Where no letter leads on from a node, its failure link gives
the node to go on from once some pieces have been popped off, and the number of these is known beforehand. So every
letter is read once, nothing is read again, and no piece is ever built.

The vocabulary is that of a public SentencePiece model: pieces marked as the beginning of a word, and the others.
Words are runs of letters, digits and marks of writing between white space; any other character is a word of its own.

Defined results: null, empty and blank texts have no words; every row gets a result, repeated or not; an empty
table gives none. Memory is bounded by a batch of texts and ``MEMO`` words. Other columns are not looked at.
"""

from collections import deque
from collections.abc import Iterable, Iterator
from functools import cache

import public_tokenizers
import pyarrow as pa
import regex
import sentencepiece
from pyspark.sql import DataFrame

from riskwindow.llm import common

VOCABULARY = "piece_bpe_32k.model"
#: Different words whose counts a worker keeps; beyond that it starts anew.
MEMO = 400_000
_WORD = regex.compile(r"[\p{L}\p{M}\p{N}]+|[^\p{L}\p{M}\p{N}\s]")
_UNKNOWN = 1 << 32


class Automaton:
    """Nodes by number; node 0 begins a word, node 1 continues it."""

    def __init__(self, first: Iterable[str], more: Iterable[str]):
        self.next: list[dict[str, int]] = [{}, {}]
        self.piece = [False, False]
        for root, pieces in ((0, first), (1, more)):
            for piece in pieces:
                node = root
                for letter in piece:
                    node = self.next[node].setdefault(letter, len(self.next))
                    if node == len(self.next):
                        self.next.append({})
                        self.piece.append(False)
                self.piece[node] = node > 1
        # After failing at a node: pieces popped, and the node to go on from (None: the word is unknown).
        self.popped: list[int] = [0] * len(self.next)
        self.fail: list[int | None] = [None] * len(self.next)
        queue = deque((0, 1))
        while queue:
            parent = queue.popleft()
            for letter, node in self.next[parent].items():
                queue.append(node)
                if self.piece[node]:
                    self.popped[node], self.fail[node] = 1, 1
                    continue
                popped, at = self.popped[parent], self.fail[parent]
                while at is not None and letter not in self.next[at]:
                    popped, at = popped + self.popped[at], self.fail[at]
                if at is not None:
                    self.popped[node], self.fail[node] = popped, self.next[at][letter]

    def count(self, word: str) -> int | None:
        """Number of pieces of a word; None if it is unknown."""
        node, n = 0, 0
        steps, popped, fail = self.next, self.popped, self.fail
        for letter in word:
            while letter not in steps[node]:
                after = fail[node]
                if after is None:
                    return None
                n += popped[node]
                node = after
            node = steps[node][letter]
        while node > 1:
            after = fail[node]
            if after is None:
                return None
            n += popped[node]
            node = after
        return n


@cache
def automaton(name: str = VOCABULARY) -> Automaton:
    model = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path(name))
    first, more = [], []
    for i in range(model.vocab_size()):
        if model.is_control(i) or model.is_unknown(i) or model.is_byte(i):
            continue
        piece = model.id_to_piece(i)
        if piece.startswith("▁"):
            first.append(piece[1:])
        else:
            more.append(piece)
    return Automaton(filter(None, first), more)


class _Counts(dict):
    """Text between white space -> tokens + 2^32 x unknown words; fills itself."""

    def __init__(self, machine: Automaton):
        self.count = machine.count

    def __missing__(self, chunk: str) -> int:
        total = 0
        for word in _WORD.findall(chunk):
            n = self.count(word)
            total += 1 + _UNKNOWN if n is None else n
        self[chunk] = total
        return total


def token_counts(docs: DataFrame, name: str = VOCABULARY) -> DataFrame:
    """doc_id, n_tokens, n_unknown (words that are one unknown token) of every row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = _Counts(automaton(name))
        for batch in batches:
            totals = []
            for text in batch.column("text"):
                if len(counts) > MEMO:
                    counts.clear()
                totals.append(sum(map(counts.__getitem__, (text.as_py() or "").split())))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    pa.array([t % _UNKNOWN for t in totals], pa.int64()),
                    pa.array([t // _UNKNOWN for t in totals], pa.int64()),
                ],
                names=["doc_id", "n_tokens", "n_unknown"],
            )

    return common.keyed(docs, "text").drop("text_key").mapInArrow(
        run, "doc_id long, n_tokens long, n_unknown long"
    )


def op8_token_counts(spark, sf_dir: str) -> DataFrame:
    return token_counts(common.table(spark, sf_dir, "documents"))
