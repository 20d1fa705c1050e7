"""BPE encoding and decoding with segment trees over adjacent pair ranks.

A pre-token's symbols are a linked list. A segment tree holds, for every symbol,
the rank of the pair it starts; its root is the lowest rank, of equal ranks the
leftmost. Each merge takes the root, joins the pair and updates three leaves
(the pair itself, the one before, the one that vanished) up to the root, until
the root holds no rank. Pre-tokens of like length go through their trees
together, one merge each at a time, as numpy columns; a long one goes alone.

Work is spread by documents; each task keeps a bounded cache of pre-tokens.
"""

from __future__ import annotations

import ctypes
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame

from .bpe_vocab import NO_RANK, Vocabulary, received, segments, ship

CACHE_WORDS = 150_000
BATCH_BYTES = 4 << 20         # of texts that reach a Python worker at a time
BATCH_LIMIT, DEFAULT_LIMIT = "spark.sql.execution.arrow.maxBytesPerBatch", "67108864b"
CHUNK_CHARS = 2 << 20          # text handled, and rows returned, at a time
ALONE = 512                    # symbols from which a pre-token has a tree of its own
CELLS = 1 << 19                # symbols in one group of trees
_INF = NO_RANK << 32
_TRIM = getattr(ctypes.CDLL(None), "malloc_trim", None)        # glibc has it


def _first_symbols(vocab: Vocabulary, word: bytes) -> np.ndarray:
    raw = np.frombuffer(word, np.uint8)
    ids = vocab.inner[raw]
    ids[-1] = vocab.final[raw[-1]]
    return ids


def encode_alone(vocab: Vocabulary, word: bytes) -> list[int]:
    """One pre-token with a tree of its own."""
    first = _first_symbols(vocab, word)
    n = len(first)
    leaves = 1 << max(0, (n - 1).bit_length())
    tree = np.full(2 * leaves, _INF, np.int64)
    if n > 1:
        tree[leaves:leaves + n - 1] = vocab.ranks(first[:-1], first[1:]) << 32 | np.arange(n - 1)
    tree[leaves:][tree[leaves:] >= _INF] = _INF
    half = leaves
    while half > 1:
        tree[half // 2:half] = np.minimum(tree[half:2 * half:2], tree[half + 1:2 * half:2])
        half //= 2
    tree, ids = tree.tolist(), first.tolist()
    after, before = list(range(1, n + 1)), list(range(-1, n - 1))
    ranks = dict(zip(vocab.pair_keys.tolist(), vocab.pair_ranks.tolist())) if n > 64 else None

    def rank(a: int, b: int) -> int:
        key = ids[a] << 20 | ids[b]
        if ranks is not None:
            return ranks.get(key, NO_RANK)
        at = int(np.searchsorted(vocab.pair_keys, key))
        same = at < len(vocab.pair_keys) and vocab.pair_keys[at] == key
        return int(vocab.pair_ranks[at]) if same else NO_RANK

    def put(leaf: int, value: int) -> None:
        node = leaves + leaf
        tree[node] = value
        while node > 1:
            node >>= 1
            a, b = tree[2 * node], tree[2 * node + 1]
            best = a if a <= b else b
            if tree[node] == best:
                break
            tree[node] = best

    while n > 1 and tree[1] < _INF:
        at, r = tree[1] & 0xFFFFFFFF, tree[1] >> 32
        gone = after[at]
        follows = after[gone]
        ids[at], ids[gone], after[at] = int(vocab.merged[r]), -1, follows
        put(gone, _INF)
        r = rank(at, follows) if follows < n else NO_RANK
        if follows < n:
            before[follows] = at
        put(at, _INF if r == NO_RANK else r << 32 | at)
        if before[at] >= 0:
            r = rank(before[at], at)
            put(before[at], _INF if r == NO_RANK else r << 32 | before[at])
    return [i for i in ids if i >= 0]


def _encode_group(vocab: Vocabulary, words: list[bytes], leaves: int) -> list[np.ndarray]:
    """Pre-tokens of 2..``leaves`` symbols, a row of a tree table each."""
    w = len(words)
    lengths = np.fromiter(map(len, words), np.int64, w)
    raw = np.zeros((w, leaves), np.uint8)
    inside = np.arange(leaves) < lengths[:, None]
    raw[inside] = np.frombuffer(b"".join(words), np.uint8)
    ids = np.full((w, leaves + 1), -1, np.int64)
    ids[:, :-1] = np.where(inside, vocab.inner[raw], -1)
    row = np.arange(w)
    ids[row, lengths - 1] = vocab.final[raw[row, lengths - 1]]
    tree = np.full((w, 2 * leaves), _INF, np.int64)
    paired = np.arange(leaves - 1) < (lengths - 1)[:, None]
    r = vocab.ranks(ids[:, :leaves - 1][paired], ids[:, 1:leaves][paired])
    at = np.nonzero(paired)[1]
    tree[:, leaves:2 * leaves - 1][paired] = np.where(r == NO_RANK, _INF, r << 32 | at)
    half = leaves
    while half > 1:
        tree[:, half // 2:half] = np.minimum(tree[:, half:2 * half:2], tree[:, half + 1:2 * half:2])
        half //= 2
    after = np.tile(np.arange(1, leaves + 1), (w, 1))
    before = np.tile(np.arange(-1, leaves - 1), (w, 1))

    def put(rows: np.ndarray, leaf: np.ndarray, value: np.ndarray | int) -> None:
        node = leaves + leaf
        tree[rows, node] = value
        while node[0] > 1:
            node = node >> 1
            tree[rows, node] = np.minimum(tree[rows, 2 * node], tree[rows, 2 * node + 1])

    rows = np.flatnonzero(tree[:, 1] < _INF)
    while len(rows):
        root = tree[rows, 1]
        at = root & 0xFFFFFFFF
        gone = after[rows, at]
        follows = after[rows, gone]
        ids[rows, at] = vocab.merged[root >> 32]
        ids[rows, gone] = -1
        after[rows, at] = follows
        put(rows, gone, _INF)
        more = follows < lengths[rows]
        some = rows[more]
        before[some, follows[more]] = at[more]
        # The column after the last symbol holds -1, which no merge knows.
        r = np.full(len(rows), NO_RANK, np.int64)
        r[more] = vocab.ranks(ids[some, at[more]], ids[some, follows[more]])
        put(rows, at, np.where(r == NO_RANK, _INF, r << 32 | at))
        prior = before[rows, at]
        has = prior >= 0
        if has.any():
            some, prior = rows[has], prior[has]
            r = vocab.ranks(ids[some, prior], ids[some, at[has]])
            put(some, prior, np.where(r == NO_RANK, _INF, r << 32 | prior))
        rows = rows[tree[rows, 1] < _INF]
    alive = ids[:, :-1] >= 0
    counts = alive.sum(1)
    return np.split(ids[:, :-1][alive], np.cumsum(counts)[:-1])


def encode_words(vocab: Vocabulary, words: list[bytes]) -> list[np.ndarray]:
    """Ids of each pre-token (its UTF-8 bytes)."""
    out: list = [None] * len(words)
    groups: dict[int, list[int]] = {}
    for i, word in enumerate(words):
        if len(word) == 1:
            out[i] = _first_symbols(vocab, word)
        elif len(word) >= ALONE:
            out[i] = np.array(encode_alone(vocab, word), np.int64)
        else:
            groups.setdefault(1 << (len(word) - 1).bit_length(), []).append(i)
    for leaves, members in groups.items():
        step = max(1, CELLS // leaves)
        for s in range(0, len(members), step):
            part = members[s:s + step]
            for i, ids in zip(part, _encode_group(vocab, [words[j] for j in part], leaves)):
                out[i] = ids
    return out


class Codec:
    """Encoder and decoder of one task, with a bounded cache of pre-tokens."""

    def __init__(self, vocab: Vocabulary, cache_words: int = CACHE_WORDS) -> None:
        self.vocab, self.limit = vocab, cache_words
        self.known: dict[str, bytes] = {}

    def encode(self, texts: list[str]) -> list[bytes]:
        """Ids of each text as little-endian 32-bit integers."""
        split = [list(segments(self.vocab, t)) for t in texts]
        new = {w for parts in split for _, words in parts for w in words}.difference(self.known)
        if len(self.known) + len(new) > self.limit:
            self.known.clear()
            new = {w for parts in split for _, words in parts for w in words}
        fresh = list(new)
        for word, ids in zip(fresh, encode_words(self.vocab, [w.encode() for w in fresh])):
            self.known[word] = ids.astype("<u4").tobytes()
        get = self.known.__getitem__
        return [b"".join(special.to_bytes(4, "little") if special is not None else b"".join(map(get, words))
                         for special, words in parts) for parts in split]

    def decode(self, ids: bytes) -> str:
        """The tokens of the ids with a blank between (the file names no
        decoder); special tokens are kept."""
        return " ".join(map(self.vocab.tokens.__getitem__, np.frombuffer(ids, "<u4").tolist()))


def small_batches(docs: DataFrame) -> DataFrame:
    """``docs``, with Arrow batches of at most ``BATCH_BYTES`` in its session from now on,
    unless the session sets a limit of its own. Texts are handled ``CHUNK_CHARS`` at a
    time anyway; the default of 64 MB costs every task that much in the JVM and again in
    its Python worker."""
    conf = docs.sparkSession.conf
    if conf.get(BATCH_LIMIT) == DEFAULT_LIMIT:
        conf.set(BATCH_LIMIT, str(BATCH_BYTES))
    return docs


def give_back() -> None:
    """Return freed memory to the system: Python workers live on between stages, and
    what they keep is missing beside the executor's heap."""
    pa.default_memory_pool().release_unused()
    if _TRIM is not None:
        _TRIM(0)


def chunks(batch: pa.RecordBatch, column: str) -> Iterator[pa.RecordBatch]:
    """Slices of a batch with about ``CHUNK_CHARS`` bytes of text each. What the last
    slices have left free is given back."""
    give_back()
    sizes = np.array([0 if n is None else n for n in
                      pc.binary_length(batch.column(column)).to_pylist()], np.int64)
    start = used = 0
    for i, n in enumerate(sizes.tolist()):
        if i > start and used + n > CHUNK_CHARS:
            yield batch.slice(start, i - start)
            start, used = i, 0
        used += n
    if start < batch.num_rows:
        yield batch.slice(start)


def encode_decode(docs: DataFrame, path: str, keep: Sequence[str] = ("doc_id",)) -> DataFrame:
    """Ids and decoded text of every whole text.

    Returns the columns ``keep`` of ``docs`` and n_tokens, ids (binary,
    little-endian 32-bit), decoded. A null text is an empty one: no ids, an
    empty decoded text. Null ids, repeated rows and empty tables pass through
    unchanged in number. Very long texts are handled in pieces cut at blanks,
    and rows are returned a few MB at a time. Columns of ``docs`` that are not
    named in ``keep`` are not read, so their names cannot clash; ``keep`` may
    not name the three new columns.
    """
    if clash := {"n_tokens", "ids", "decoded"} & set(keep):
        raise ValueError(f"names of new columns: {sorted(clash)}")
    shipped = ship(docs.sparkSession, path)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = Codec(received(shipped))
        for batch in batches:
            for part in chunks(batch, "text"):
                ids = codec.encode([t or "" for t in part.column("text").to_pylist()])
                yield pa.RecordBatch.from_arrays(
                    [*[part.column(c) for c in keep],
                     pa.array([len(x) // 4 for x in ids], pa.int64()), pa.array(ids, pa.binary()),
                     pa.array([codec.decode(x) for x in ids], pa.string())],
                    [*keep, "n_tokens", "ids", "decoded"])
                del ids

    source = small_batches(docs).select(*dict.fromkeys([*keep, "text"]))
    kept = [f"`{f.name}` {f.dataType.simpleString()}" for f in source.select(*keep).schema.fields]
    return source.mapInArrow(run, ", ".join([*kept, "n_tokens long", "ids binary", "decoded string"]))
