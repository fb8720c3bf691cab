"""Token counts by unigram segmentation, computed once per shared prefix in a trie.

The distinct pre-tokens of a batch of documents (words, led by the word mark) are put in a trie.
The forward scores of the unigram model, best score and number of pieces up to each position, depend
on the prefix alone, so they are computed per node of the trie, level by level, and a pre-token's
count is what its last node holds. Levels are numpy arrays: all nodes of one depth advance together.

The pieces and their scores are those of the vocabulary file. A character without a piece counts one
token per byte, at a score below all pieces. Equal best scores go to the shorter last piece.

Defined cases: null, empty and blank texts have no tokens; rows are independent; an empty table
gives an empty result; other columns are ignored; texts of any length are counted whole.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from panelmend.llm.common import WORD

MARK = "▁"
#: Distinct pre-tokens put in one trie, and words of documents collected before it is built.
TRIE_WORDS = 60_000
BATCH_WORDS = 3_000_000
_BASE = np.uint64(0x9E3779B97F4A7C15)
SCHEMA = "doc_id long, n_words long, n_tokens long"


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    return x ^ (x >> np.uint64(27))


class Unigram:
    """Scores of the pieces, looked up by the hash of their code points."""

    def __init__(self, pieces: dict[str, float]):
        self.pieces = pieces
        self.longest = max(map(len, pieces))
        self.unknown = min(pieces.values()) - 10.0
        self.powers = np.multiply.accumulate(np.full(self.longest + 1, _BASE))
        keys = np.array([self._hash(p) for p in pieces], dtype=np.uint64)
        order = np.argsort(keys)
        self.keys = keys[order]
        self.scores = np.array(list(pieces.values()))[order]
        self.maybe = np.zeros(1 << 22, dtype=bool)
        self.maybe[_mixed(self.keys) >> np.uint64(42)] = True

    def _hash(self, piece: str) -> int:
        h = 0
        for c in piece:
            h = (h * int(_BASE) + ord(c) + 1) % 2 ** 64
        return h

    def lookup(self, hashes: np.ndarray) -> np.ndarray:
        """Scores, -inf where there is no such piece."""
        out = np.full(hashes.shape, -np.inf)
        at = np.nonzero(self.maybe[_mixed(hashes) >> np.uint64(42)])
        found = np.minimum(np.searchsorted(self.keys, hashes[at]), len(self.keys) - 1)
        hit = self.keys[found] == hashes[at]
        out[tuple(x[hit] for x in at)] = self.scores[found[hit]]
        return out

    def counts(self, words: list[str]) -> np.ndarray:
        """Number of tokens of every pre-token; ``words`` sorted and distinct."""
        points = np.frombuffer("".join(words).encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
        length = np.array([len(w) for w in words], dtype=np.int64)
        begin = np.cumsum(length) - length
        out = np.zeros(len(words), dtype=np.int64)
        # what a node knows of its path: hash, best score, tokens at the last depths, own depth last
        active = np.arange(len(words))
        node = np.zeros(len(words), dtype=np.int64)
        hashes = np.zeros((1, 1), dtype=np.uint64)
        best = np.zeros((1, 1))
        tokens = np.zeros((1, 1), dtype=np.int64)
        depth = 0
        while len(active):
            depth += 1
            char = points[begin[active] + depth - 1]
            new = np.ones(len(active), dtype=bool)
            new[1:] = (node[1:] != node[:-1]) | (char[1:] != char[:-1])
            parent, letter = node[new], char[new].astype(np.uint64)
            width = min(depth, self.longest)
            hashes, best, tokens = (x[parent][:, -width:] for x in (hashes, best, tokens))
            own = hashes[:, -1] * _BASE + letter + np.uint64(1)
            # column j of the history lies width - j characters back
            span = np.arange(width, 0, -1)
            score = self.lookup(own[:, None] - hashes * self.powers[span - 1]) + best
            size = np.where(letter < 0x80, 1, np.where(letter < 0x800, 2, np.where(letter < 0x10000, 3, 4)))
            bytes_ = best[:, -1] + self.unknown * size
            at = width - 1 - np.argmax(score[:, ::-1], axis=1)  # the shortest of equal ones
            rows = np.arange(len(parent))
            top = score[rows, at]
            known = top >= bytes_
            count = np.where(known, tokens[rows, at] + 1, tokens[:, -1] + size)
            hashes = np.concatenate([hashes, own[:, None]], axis=1)
            best = np.concatenate([best, np.where(known, top, bytes_)[:, None]], axis=1)
            tokens = np.concatenate([tokens, count[:, None]], axis=1)
            node = np.cumsum(new) - 1
            done = length[active] == depth
            out[active[done]] = count[node[done]]
            active, node = active[~done], node[~done]
        return out


@cache
def unigram(model_file: str) -> Unigram:
    """One per worker process; control, unknown and byte pieces are left out."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=model_file)
    return Unigram({model.IdToPiece(i): model.GetScore(i) for i in range(model.GetPieceSize())
                    if not (model.IsControl(i) or model.IsUnknown(i) or model.IsByte(i))})


def count_tokens(docs: DataFrame, model_file: str | None = None) -> DataFrame:
    """``doc_id, n_words, n_tokens`` for every document."""
    import public_tokenizers

    model_file = model_file or public_tokenizers.path("piece_bpe_32k.model")
    word = re.compile(WORD)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = unigram(model_file)
        ids: list[int | None] = []
        ends: list[int] = []
        numbers: list[np.ndarray] = []
        seen: dict[str, int] = {}
        total = 0

        def counted() -> pa.RecordBatch:
            order = sorted(seen)
            counts = np.zeros(len(seen), dtype=np.int64)
            for lo in range(0, len(order), TRIE_WORDS):
                part = order[lo:lo + TRIE_WORDS]
                counts[[seen[w] for w in part]] = model.counts([MARK + w for w in part])
            upto = np.concatenate([[0], np.cumsum(counts[np.concatenate(numbers)] if numbers
                                                  else np.zeros(0, np.int64))])
            stops = np.array(ends, dtype=np.int64)
            starts = np.concatenate([[0], stops[:-1]])
            return pa.RecordBatch.from_arrays(
                [pa.array(ids, pa.int64()), pa.array(stops - starts),
                 pa.array(upto[stops] - upto[starts])], names=["doc_id", "n_words", "n_tokens"])

        for batch in batches:
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                found = word.findall(text.as_py() or "")
                numbers.append(np.array([seen.setdefault(w, len(seen)) for w in found], dtype=np.int64))
                total += len(found)
                ids.append(doc_id)
                ends.append(total)
                if total >= BATCH_WORDS:
                    yield counted()
                    ids, ends, numbers, total = [], [], [], 0
                    seen.clear()
        if ids:
            yield counted()

    return docs.select("doc_id", "text").mapInArrow(run, SCHEMA)
