"""Token counts by rank-synchronous array merging.

All unseen pre-tokens of a batch lie in one ragged numpy array: their symbols
end to end, with a start each. In every round each sequence finds its lowest
pair rank (one segmented minimum), and all places that hold this rank merge at
once, left to right where they overlap. Sequences without a rank left drop out
with the number of symbols that survive. A merge's symbol is made by that merge
alone (checked when the file is loaded), so merging all places of the lowest
rank at once gives the same symbols as merging them one by one.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .bpe_codec import chunks
from .bpe_vocab import NO_RANK, Vocabulary, received, segments, ship

CACHE_WORDS = 300_000
LONG = 4096                    # symbols from which a pre-token is counted by itself
SYMBOLS = 1 << 20              # symbols in one ragged array


def check_unique_merges(vocab: Vocabulary) -> None:
    if len(np.unique(vocab.merged)) != len(vocab.merged):
        raise ValueError("two merges of this vocabulary make the same symbol")


def _first_in_overlaps(hit: np.ndarray) -> np.ndarray:
    """Of touching hits (a pair of equal symbols repeated), the 1st, 3rd, ..."""
    at = np.flatnonzero(hit)
    if len(at) < 2:
        return at
    fresh = np.ones(len(at), bool)
    fresh[1:] = np.diff(at) != 1
    run = np.cumsum(fresh) - 1
    return at[(at - at[fresh][run]) % 2 == 0]


def count_ragged(vocab: Vocabulary, words: list[bytes]) -> np.ndarray:
    """Surviving symbols of each pre-token (not empty)."""
    w = len(words)
    out = np.ones(w, np.int64)
    lengths = np.fromiter(map(len, words), np.int64, w)
    raw = np.frombuffer(b"".join(words), np.uint8)
    ids = vocab.inner[raw]
    ends = np.cumsum(lengths)
    ids[ends - 1] = vocab.final[raw[ends - 1]]
    who = np.arange(w)
    starts = ends - lengths
    ranks = np.full(len(ids), NO_RANK, np.int64)      # of the pair that starts here
    ranks[:-1] = vocab.ranks(ids[:-1], ids[1:])
    ranks[ends - 1] = NO_RANK
    while len(who):
        low = np.minimum.reduceat(ranks, starts)
        lengths = np.diff(np.append(starts, len(ids)))
        done = low == NO_RANK
        if done.any():
            out[who[done]] = lengths[done]
            keep = np.repeat(~done, lengths)
            ids, ranks, who, low, lengths = ids[keep], ranks[keep], who[~done], low[~done], lengths[~done]
            if not len(who):
                break
        at = _first_in_overlaps(ranks == np.repeat(low, lengths))
        owner = np.repeat(np.arange(len(who)), lengths)
        ids[at] = vocab.merged[ranks[at]]
        keep = np.ones(len(ids), bool)
        keep[at + 1] = False
        gone = np.bincount(owner[at], minlength=len(who))
        # The pair after a merged symbol starts where the vanished one did.
        now = np.cumsum(keep) - 1
        at = now[at]
        ids, ranks, owner = ids[keep], ranks[keep], owner[keep]
        lengths = lengths - gone
        starts = np.cumsum(lengths) - lengths
        for left in (at, at[at > 0] - 1):
            right = np.minimum(left + 1, len(ids) - 1)
            joined = (owner[left] == owner[right]) & (right > left)
            ranks[left] = np.where(joined, vocab.ranks(ids[left], ids[right]), NO_RANK)
    return out


def count_long(vocab: Vocabulary, word: bytes) -> int:
    """The same rounds for one long pre-token: places wait by rank, the lowest
    rank's places merge together, left to right."""
    raw = np.frombuffer(word, np.uint8)
    first = vocab.inner[raw]
    first[-1] = vocab.final[raw[-1]]
    known = dict(zip(vocab.pair_keys.tolist(), vocab.pair_ranks.tolist()))
    ids, n = first.tolist(), len(first)
    after, before, left = list(range(1, n + 1)), list(range(-1, n - 1)), n
    places: dict[int, list[int]] = {}
    queue: list[int] = []

    def wait(at: int) -> None:
        if at >= 0 and after[at] < n:
            rank = known.get(ids[at] << 20 | ids[after[at]])
            if rank is not None:
                if rank not in places:
                    places[rank] = []
                    heapq.heappush(queue, rank)
                places[rank].append(at)

    for at in range(n - 1):
        wait(at)
    while queue:
        rank = heapq.heappop(queue)
        joined = int(vocab.merged[rank])
        for at in sorted(set(places.pop(rank))):
            if ids[at] < 0 or after[at] >= n or known.get(ids[at] << 20 | ids[after[at]]) != rank:
                continue
            gone = after[at]
            ids[at], ids[gone], after[at] = joined, -1, after[gone]
            if after[at] < n:
                before[after[at]] = at
            left -= 1
            wait(at)
            wait(before[at])
    return left


def count_words(vocab: Vocabulary, words: list[bytes]) -> np.ndarray:
    out = np.zeros(len(words), np.int64)
    batch, symbols = [], 0
    for i, word in enumerate(words):
        if len(word) >= LONG:
            out[i] = count_long(vocab, word)
            continue
        batch.append(i)
        symbols += len(word)
        if symbols >= SYMBOLS:
            out[batch] = count_ragged(vocab, [words[j] for j in batch])
            batch, symbols = [], 0
    if batch:
        out[batch] = count_ragged(vocab, [words[j] for j in batch])
    return out


class Counter:
    """Counts texts, with a bounded cache of pre-tokens."""

    def __init__(self, vocab: Vocabulary, cache_words: int = CACHE_WORDS) -> None:
        check_unique_merges(vocab)
        self.vocab, self.limit, self.known = vocab, cache_words, {}

    def count(self, texts: list[str]) -> list[int]:
        split = [list(segments(self.vocab, t)) for t in texts]
        new = {w for parts in split for _, words in parts for w in words}.difference(self.known)
        if len(self.known) + len(new) > self.limit:
            self.known.clear()
            new = {w for parts in split for _, words in parts for w in words}
        fresh = list(new)
        self.known.update(zip(fresh, count_words(self.vocab, [w.encode() for w in fresh]).tolist()))
        get = self.known.__getitem__
        return [sum(1 if special is not None else sum(map(get, words)) for special, words in parts)
                for parts in split]


def count_tokens(docs: DataFrame, path: str, limit: int = 2048) -> DataFrame:
    """doc_id, n_bytes, n_tokens and over_limit (n_tokens > ``limit``) of every
    whole text.

    A null text is an empty one (0 bytes, 0 tokens). Null ids, repeated rows
    and empty tables pass through unchanged in number. Very long texts are
    handled in pieces cut at blanks. Other columns are not read.
    """
    shipped = ship(docs.sparkSession, path)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = Counter(received(shipped))
        for batch in batches:
            for part in chunks(batch, "text"):
                counts = counter.count([t or "" for t in part.column("text").to_pylist()])
                size = pc.fill_null(pc.binary_length(part.column("text")), 0)
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), size.cast(pa.int64()), pa.array(counts, pa.int64())],
                    ["doc_id", "n_bytes", "n_tokens"])

    source = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    counted = source.mapInArrow(run, "doc_id long, n_bytes long, n_tokens long")
    return counted.select("*", (F.col("n_tokens") > limit).alias("over_limit"))
