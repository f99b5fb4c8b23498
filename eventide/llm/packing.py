"""Operator 8: packing by Karmarkar-Karp multiway differencing.

Documents are tokenized where they are read (no shuffle).  Each document is cut into whole windows of
``capacity`` tokens, which are sequences of their own, and a remainder.  Remainders gather in blocks of about
``block_windows`` windows; a block is dealt to k = ceil(tokens / capacity) windows by differencing: the two
partial partitions with the largest imbalance are merged, the fullest window of one with the emptiest of the
other, until one is left, which has near-equal windows.  Where cutting is allowed, what a window holds beyond its
capacity is cut off and put into windows with room; where it is not, the window count rises until all fit.

A task holds one block at a time.  Sequence ids are (partition id, counter), so a rerun task gives the same rows.
Padding is below one window per block, and below one per input partition for its last block.

Defined cases: a null or empty text is a document of the end token alone; repeated rows are separate documents;
null ids stay null; an empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

import heapq

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventide.llm.common import vocabulary_path, word_encoder

SCHEMA = "doc_id long, start long, length long, ids binary, doc_tokens long, sequence_id long, offset long"


def difference(lengths: list[int], k: int) -> list[list[int]]:
    """Karmarkar-Karp: deal item numbers to k windows of near-equal total length.

    A partial partition is its non-empty windows as (total, items), fullest first; the empty ones are implied."""
    if not lengths:
        return [[] for _ in range(k)]
    heap = [(-n, i, [(n, (i,))]) for i, n in enumerate(lengths)]
    if k == 1:
        return [list(range(len(lengths)))]
    heapq.heapify(heap)
    serial = len(lengths)
    while len(heap) > 1:
        _, _, a = heapq.heappop(heap)
        _, _, b = heapq.heappop(heap)
        free = k - len(b)  # that many of a's fullest windows meet empty ones of b
        low = b[::-1]      # emptiest first
        merged = a[:free] + [(x[0] + y[0], (x[1], y[1])) for x, y in zip(a[free:], low)] + low[max(0, len(a) - free):]
        merged.sort(key=lambda w: -w[0])
        spread = merged[0][0] - (merged[-1][0] if len(merged) == k else 0)
        heapq.heappush(heap, (-spread, serial, merged))
        serial += 1
    out = []
    for _, items in heap[0][2]:
        flat, todo = [], [items]
        while todo:
            x = todo.pop()
            if isinstance(x, tuple):
                todo.extend(x)
            else:
                flat.append(x)
        out.append(sorted(flat))
    return out + [[] for _ in range(k - len(out))]


def plan_block(lengths: list[int], capacity: int, cut: bool = True) -> list[list[tuple[int, int, int]]]:
    """Windows of (item, start in the item, length).  ``cut=False``: no item is cut and the count rises instead."""
    k = max(1, -(-sum(lengths) // capacity))
    dealt = difference(lengths, k)
    while not cut and max((sum(lengths[i] for i in w) for w in dealt), default=0) > capacity:
        k += 1
        dealt = difference(lengths, k)
    windows, over = [], []
    for items in dealt:
        room, window = capacity, []
        for i in sorted(items, key=lambda i: lengths[i]):
            n = min(room, lengths[i])
            if n:
                window.append((i, 0, n))
            if n < lengths[i]:
                over.append((i, n, lengths[i] - n))
            room -= n
        windows.append((room, window))
    roomy = sorted((w for w in windows if w[0]), key=lambda w: -w[0])
    for i, at, n in over:
        while n:
            room, window = roomy[0]
            m = min(room, n)
            window.append((i, at, m))
            at, n = at + m, n - m
            roomy[0] = (room - m, window)
            if room == m:
                roomy.pop(0)
    return [w for _, w in windows if w]


def _packer(path: str, end_id: int, capacity: int, block_windows: int, cut: bool):
    def run(batches):
        from pyspark import TaskContext
        encoder = word_encoder(path)
        end = end_id.to_bytes(4, "little")
        sequence = TaskContext.get().partitionId() << 33
        pool: list[tuple] = []  # (doc_id, start, ids, doc_tokens)
        held = 0

        def batch(rows):
            cols = list(zip(*rows))
            kinds = [pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.int64(), pa.int64(), pa.int64()]
            names = ["doc_id", "start", "length", "ids", "doc_tokens", "sequence_id", "offset"]
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds)], names)

        def flush():
            nonlocal sequence
            rows = []
            for window in plan_block([len(p[2]) // 4 for p in pool], capacity, cut):
                offset = 0
                for i, at, n in window:
                    doc, start, ids, total = pool[i]
                    rows.append((doc, start + at, n, ids[4 * at:4 * (at + n)], total, sequence, offset))
                    offset += n
                sequence += 1
            return batch(rows)

        for b in batches:
            for doc, text in zip(b.column(0).to_pylist(), b.column(1)):
                ids = encoder.encode(text.as_py()) + end
                total = len(ids) // 4
                whole = total - total % capacity
                for at in range(0, whole, 64 * capacity):
                    rows = []
                    for s in range(at, min(whole, at + 64 * capacity), capacity):
                        rows.append((doc, s, capacity, ids[4 * s:4 * (s + capacity)], total, sequence, 0))
                        sequence += 1
                    yield batch(rows)
                if whole < total:
                    pool.append((doc, whole, ids[4 * whole:], total))
                    held += total - whole
                    if held >= block_windows * capacity:
                        yield flush()
                        pool, held = [], 0
        if pool:
            yield flush()
    return run


def pack_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", *, capacity: int = 4096,
                   vocabulary: str | None = None, end_id: int = 2, block_windows: int = 128,
                   cut: bool = True) -> DataFrame:
    """Pieces of documents in sequences of at most ``capacity`` tokens.

    Returns doc_id, start (the document's ids before the piece), length, ids (little-endian uint32), doc_tokens,
    sequence_id, offset (place in the sequence, gapless from 0).  Documents over ``capacity`` are cut in any case."""
    path = vocabulary or vocabulary_path("word_bpe_49k.json")
    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")).mapInArrow(
        _packer(path, end_id, capacity, block_windows, cut), SCHEMA)


def packing_digest(pieces: DataFrame) -> DataFrame:
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens",
                         "sequence_id", "offset")
