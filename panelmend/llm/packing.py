"""Packing documents into fixed windows by Karmarkar-Karp multiway differencing.

Whatever fills a window by itself is cut off first. The rest goes, in pieces of at most a quarter of
a window, into blocks of bounded size; each block is divided among as few windows as its tokens
need. Differencing keeps partial partitions as sorted tuples of loads and always merges the two of
largest spread with opposing order, heavy against light. When a window of the result exceeds its
capacity, the block is divided again among one more window.

Blocks lie within a partition of the scan, so nothing is shuffled and a lost task is simply run
again with the same result.

Defined cases: a null or empty text is one piece holding the closing id alone; rows with equal or
null ``doc_id`` are packed separately; an empty table gives an empty result; other columns are
ignored. Texts of any length are tokenized whole.
"""

from __future__ import annotations

import base64
import heapq
import zlib
from collections.abc import Iterator
from functools import cache, cached_property

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame

WINDOW = 1024
#: Tokens of one block of rests, and the longest piece of a rest.
BLOCK_TOKENS = 128 * WINDOW
PIECE = WINDOW // 4
SPECIAL = "<|endoftext|>"
SCHEMA = ("doc_id long, start long, length long, ids_crc32 long, doc_tokens long, "
          "sequence_id long, offset long")


class TextEncoder:
    """Ids of byte_bpe_50k, as little-endian 32-bit words; nothing is kept of the texts.

    Texts with the special token are encoded by the tokenizer's own file.
    """

    def __init__(self, ranks_file: str, tokenizer_file: str):
        import public_tokenizers
        import tiktoken

        with open(ranks_file, "rb") as lines:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
        self.encoding = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN,
                                          mergeable_ranks=ranks, special_tokens={})
        self.tokenizer_file = tokenizer_file

    @cached_property
    def tokenizer(self):
        from tokenizers import Tokenizer
        return Tokenizer.from_file(self.tokenizer_file)

    def __call__(self, text: str) -> bytes:
        if SPECIAL in text:
            ids = self.tokenizer.encode(text, add_special_tokens=False).ids
        else:
            ids = self.encoding.encode_to_numpy(text, disallowed_special=())
        return np.asarray(ids, dtype="<u4").tobytes()


@cache
def encoder(ranks_file: str, tokenizer_file: str) -> TextEncoder:
    """One per worker process."""
    return TextEncoder(ranks_file, tokenizer_file)


def differencing(sizes: list[int], k: int) -> np.ndarray:
    """The window (0 to k - 1) of every item, by multiway differencing."""
    n = len(sizes)
    if k == 1:
        return np.zeros(n, dtype=np.int64)
    left, right = [0] * (n + 1), [0] * (n + 1)  # nodes 1..n are items; later ones join two nodes
    heap = []
    for i, size in enumerate(sizes):
        loads, nodes = np.zeros(k, dtype=np.int64), np.zeros(k, dtype=np.int64)
        loads[-1], nodes[-1] = size, i + 1
        heap.append((-size, i, loads, nodes))
    heapq.heapify(heap)
    serial = n
    while len(heap) > 1:
        _, _, a, node_a = heapq.heappop(heap)
        _, _, b, node_b = heapq.heappop(heap)
        loads, other = a + b[::-1], node_b[::-1]
        nodes = np.where(node_a == 0, other, node_a)
        for at in np.flatnonzero((node_a != 0) & (other != 0)):
            left.append(int(node_a[at]))
            right.append(int(other[at]))
            nodes[at] = len(left) - 1
        order = np.argsort(loads, kind="stable")
        loads = loads[order]
        loads -= loads[0]  # only differences matter
        heapq.heappush(heap, (-int(loads[-1]), serial, loads, nodes[order]))
        serial += 1
    out = np.zeros(n, dtype=np.int64)
    for window, top in enumerate(heap[0][3]):
        stack = [int(top)] if top else []
        while stack:
            node = stack.pop()
            if node <= n:
                out[node - 1] = window
            else:
                stack += (left[node], right[node])
    return out


def windows(sizes: list[int], capacity: int) -> np.ndarray:
    """The window of every item, none above capacity; starts with as few windows as possible."""
    k = max(1, -(-sum(sizes) // capacity))
    while True:
        at = differencing(sizes, k)
        if np.bincount(at, weights=sizes).max() <= capacity:
            return at
        k += 1


def pack(docs: DataFrame, window: int = WINDOW, block_tokens: int = BLOCK_TOKENS,
         ranks: str | None = None, tokenizer: str | None = None, end_id: int = 0) -> DataFrame:
    """One row per piece: ``doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset``."""
    import public_tokenizers

    ranks = ranks or public_tokenizers.path("byte_bpe_50k.tiktoken")
    tokenizer = tokenizer or public_tokenizers.path("byte_bpe_50k.json")
    piece, end = window // 4, np.array([end_id], dtype="<u4").tobytes()
    schema = pa.schema([(name, pa.int64()) for name in
                        [c.split()[0] for c in SCHEMA.split(", ")]])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(ranks, tokenizer)
        sequence = TaskContext.get().partitionId() << 36
        rests, tokens = [], 0

        def placed() -> list[tuple]:
            nonlocal sequence
            at = windows([r[2] for r in rests], window)
            filled: dict[int, int] = {}
            out = []
            for r, w in zip(rests, at.tolist()):
                out.append((*r, sequence + w, filled.get(w, 0)))
                filled[w] = filled.get(w, 0) + r[2]
            sequence += int(at.max()) + 1
            return out

        def rows(out: list[tuple]) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays(
                [pa.array(c, pa.int64()) for c in zip(*out)], schema=schema)

        for batch in batches:
            out = []
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                ids = encode(text or "") + end
                n = len(ids) // 4
                full = n // window * window
                for start in range(0, full, window):
                    out.append((doc_id, start, window, zlib.crc32(ids[4 * start:4 * (start + window)]),
                                n, sequence, 0))
                    sequence += 1
                for start in range(full, n, piece):
                    stop = min(n, start + piece)
                    rests.append((doc_id, start, stop - start,
                                  zlib.crc32(ids[4 * start:4 * stop]), n))
                    tokens += stop - start
                if tokens >= block_tokens:
                    out += placed()
                    rests, tokens = [], 0
                if len(out) >= 50_000:
                    yield rows(out)
                    out = []
            if out:
                yield rows(out)
        if rests:
            yield rows(placed())

    return docs.select("doc_id", "text").mapInArrow(run, SCHEMA)
