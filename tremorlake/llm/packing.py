"""Hierarchical multi-length packing of documents into context windows.

A document is its token ids and one end id. Its full windows of the longest length go out at once; what
remains is routed to the tier of the smallest window (a power of two) that holds it, and each tier packs
its own windows in order. A remainder that no longer fits closes the window: the gap is handed to the
shorter tiers, which fill it with whole remainders, the longest that fits first, and then with a cut one.
A task packs the rows it reads, in one pass and without a shuffle, and holds at most ``HELD`` tokens of
remainders. What it holds at its end is laid out from end to end and cut into windows at powers of two, the last
ones below ``SMALLEST``, so no window is padded.

Windows are then dealt into step groups of ``STEP_TOKENS`` tokens: each group takes windows of all tiers
in turn, longest first to the group with the fewest tokens.

Defined results: a null or empty text is the end id alone; an empty table has no pieces; rows with equal
``doc_id`` are packed as documents of their own. Sequence and group ids are unique, and gapless within a
task only. A text that spells a special token is tokenized as the tokenizers library does.
"""

import heapq
import zlib
from collections import deque
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tremorlake.llm.shipping import ship

WINDOW = 1024
SMALLEST = 64
#: Tokens of remainders a task holds before the tiers must pack.
HELD = 1 << 21
#: Tokens of a step group.
STEP_TOKENS = 1 << 15
END_ID = 0

SCHEMA = ("doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, "
          "offset long, tier int, step_group long, ids binary")


def tiers(window: int = WINDOW, smallest: int = SMALLEST) -> list[int]:
    """Window lengths, longest first."""
    out = [window]
    while out[-1] > smallest:
        out.append(out[-1] // 2)
    return out


class Packer:
    """Packs documents of one task. A piece is (doc_id, start, ids as bytes, doc_tokens)."""

    def __init__(self, first_id: int, window: int = WINDOW, smallest: int = SMALLEST):
        self.window, self.smallest = window, smallest
        self.tiers = tiers(window, smallest)
        self.waiting: dict[int, deque] = {t: deque() for t in self.tiers}
        self.tokens = dict.fromkeys(self.tiers, 0)  # that wait, by tier
        self.next_id = self.next_group = first_id

    def _tier(self, tokens: int) -> int:
        return max(self.smallest, 1 << (tokens - 1).bit_length())

    def add(self, doc_id, ids: bytes) -> Iterator[tuple[int, list]]:
        """Takes a document; gives the windows that are full, as (length, pieces)."""
        total, step = len(ids) // 4, self.window * 4
        whole = len(ids) - len(ids) % step
        for at in range(0, whole, step):
            yield self.window, [(doc_id, at // 4, ids[at:at + step], total)]
        if whole < len(ids):
            self._wait((doc_id, whole // 4, ids[whole:], total))
        if sum(self.tokens.values()) > HELD:
            yield from self.pack(keep=HELD // 2)

    def _wait(self, piece) -> None:
        tier = self._tier(len(piece[2]) // 4)
        self.waiting[tier].append(piece)
        self.tokens[tier] += len(piece[2]) // 4

    def _take(self, tier: int):
        piece = self.waiting[tier].popleft()
        self.tokens[tier] -= len(piece[2]) // 4
        return piece

    def _fill(self, gap: int, longest: int) -> list:
        """Pieces for a gap from tiers up to ``longest``: whole ones that fit, then one cut to size."""
        got = []
        for tier in self.tiers:
            while tier <= longest and gap and self.waiting[tier] and len(self.waiting[tier][0][2]) // 4 <= gap:
                got.append(self._take(tier))
                gap -= len(got[-1][2]) // 4
        for tier in reversed(self.tiers):
            if gap and tier <= longest and self.waiting[tier]:
                doc_id, start, ids, total = self._take(tier)  # longer than the gap, else it had gone whole
                got.append((doc_id, start, ids[:gap * 4], total))
                self._wait((doc_id, start + gap, ids[gap * 4:], total))
                gap = 0
        return got

    def pack(self, keep: int = 0) -> Iterator[tuple[int, list]]:
        """Packs tier after tier, longest first, until at most ``keep`` tokens wait."""
        for tier in self.tiers:
            # Only windows that this tier and the shorter ones can fill are opened.
            while (self.waiting[tier] and sum(self.tokens[t] for t in self.tiers if t <= tier) >= tier
                   and sum(self.tokens.values()) >= keep):
                first = self._take(tier)
                yield tier, [first, *self._fill(tier - len(first[2]) // 4, tier)]

    def finish(self) -> Iterator[tuple[int, list]]:
        """Packs all that waits; what fills no window any more is cut at powers of two."""
        yield from self.pack()
        rest = sorted((p for t in self.tiers for p in self.waiting[t]), key=lambda p: -len(p[2]))
        left = sum(len(p[2]) // 4 for p in rest)
        rest = deque(rest)
        while left:
            length = min(self.window, 1 << (left.bit_length() - 1))
            pieces, open_tokens = [], length
            while open_tokens:
                doc_id, start, ids, total = rest.popleft()
                cut = min(open_tokens, len(ids) // 4)
                pieces.append((doc_id, start, ids[:cut * 4], total))
                if cut * 4 < len(ids):
                    rest.appendleft((doc_id, start + cut, ids[cut * 4:], total))
                open_tokens -= cut
            left -= length
            yield length, pieces

    def rows(self, windows: list[tuple[int, list]]) -> pd.DataFrame:
        """Rows of windows, numbered and dealt into step groups of equal size."""
        tokens = sum(length for length, _ in windows)
        groups = [(0, g) for g in range(max(1, round(tokens / STEP_TOKENS)))]
        out = []
        for length, pieces in sorted(windows, key=lambda w: -w[0]):
            load, group = heapq.heappop(groups)
            heapq.heappush(groups, (load + length, group))
            offset = 0
            for doc_id, start, ids, total in pieces:
                n = len(ids) // 4
                out.append((doc_id, start, n, zlib.crc32(ids), total, self.next_id, offset, length,
                            self.next_group + group, ids))
                offset += n
            self.next_id += 1
        self.next_group += len(groups)
        return pd.DataFrame(out, columns=[c.split()[0] for c in SCHEMA.split(", ")])


def pack(docs: DataFrame, encoder: Callable[[], Callable[[list[str]], list[bytes]]], doc_id: str = "doc_id",
         text: str = "text", window: int = WINDOW, smallest: int = SMALLEST) -> DataFrame:
    """The pieces of every document: where each lies, and its ids (little-endian unsigned 32 bits each).

    ``encoder`` makes, inside a task, a function from texts to their ids as bytes.
    """
    ship(docs.sparkSession)
    end = np.array([END_ID], dtype="<u4").tobytes()

    def run(batches: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        encode = encoder()
        packer = Packer(TaskContext.get().partitionId() << 33, window, smallest)
        ready, tokens = [], 0
        for batch in batches:
            for at in range(0, len(batch), 256):
                part = batch.iloc[at:at + 256]
                for key, ids in zip(part.doc_id, encode([t if isinstance(t, str) else "" for t in part.text])):
                    for done in packer.add(None if pd.isna(key) else int(key), ids + end):
                        ready.append(done)
                        tokens += done[0]
                if tokens >= HELD:
                    yield packer.rows(ready)
                    ready, tokens = [], 0
        ready.extend(packer.finish())
        if ready:
            yield packer.rows(ready)

    return docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text")).mapInPandas(
        run, SCHEMA)
