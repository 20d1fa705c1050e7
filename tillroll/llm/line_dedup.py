"""Lines that many documents share, dropped by keep bitmaps.

Every line's key becomes a hash with its document and position. The hashes are
range partitioned by hash, then document (largest id first), row and position, and
sorted inside the partitions. One pass streams each partition: the first document
of a hash is the one that keeps its lines, and once enough documents have been
seen the lines of the others are dropped.

A hash that fills several partitions is decided across them: the first and the
last hash of a partition leave one summary row each, which tells how many
documents the hash has in all and which is its first. These are two rows for a
partition, however many documents share the line. Rows never wait for the end of a
hash: at most the lines of one document are held back.

What comes back is a compressed bitmap for each document that loses lines, no
text. Only those documents are read again to apply it.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..plans.durable import durable
from .exact_dedup import normalised
from .sized import free_name

BLANKS = " \t\n\x0b\x0c\r"
MIN_CHARS = 20
MIN_DOCUMENTS = 3

DROPPED, UNDECIDED, SUMMARY = 0, 1, 2
VERDICTS = ("kind int, doc_id long, text_key long, pos int, line binary, "
            "first_tag long, last_tag long, documents long")
_ARROW = pa.schema([("kind", pa.int32()), ("doc_id", pa.int64()), ("text_key", pa.int64()),
                    ("pos", pa.int32()), ("line", pa.binary()), ("first_tag", pa.int64()),
                    ("last_tag", pa.int64()), ("documents", pa.int64())])


def text_key(text: Column) -> Column:
    """Tells texts of the same doc_id apart."""
    return F.xxhash64(F.coalesce(text, F.lit("")))


def lines_of(text: Column) -> Column:
    """A null text is empty; an empty text is one empty line."""
    return F.split(F.coalesce(text, F.lit("")), "\n")


def line_hashes(docs: DataFrame, min_chars: int) -> DataFrame:
    """doc_id, text_key, row_tag, pos and line (128 bits of the key's SHA-256) of
    every line whose key has at least ``min_chars`` code points."""
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), text_key(F.col("text")).alias("text_key"),
        F.monotonically_increasing_id().alias("row_tag"), normalised(F.col("text")).alias("text"))
    lines = rows.select("doc_id", "text_key", "row_tag",
                        F.posexplode(lines_of(F.col("text"))).alias("pos", "raw"))
    key = F.btrim(F.col("raw"), F.lit(BLANKS))
    return lines.filter(F.char_length(key) >= min_chars).select(
        "doc_id", "text_key", "row_tag", "pos",
        F.unhex(F.substring(F.sha2(key.cast("binary"), 256), 1, 32)).alias("line"))


class _Lines:
    """Rows of one sorted batch as numpy columns."""

    def __init__(self, batch: pa.RecordBatch) -> None:
        ids = batch.column("doc_id")
        self.has_id = ids.is_valid().to_numpy(zero_copy_only=False)
        self.doc_id = ids.fill_null(0).to_numpy(zero_copy_only=False)
        self.text_key = batch.column("text_key").to_numpy(zero_copy_only=False)
        self.tag = batch.column("row_tag").to_numpy(zero_copy_only=False)
        self.pos = batch.column("pos").to_numpy(zero_copy_only=False)
        line = batch.column("line").cast(pa.binary(16))
        self.line = np.frombuffer(line.buffers()[1], dtype="V16", count=len(line),
                                  offset=16 * line.offset)

    def starts(self) -> np.ndarray:
        """Where a new line begins, and the number of rows at the end."""
        change = np.flatnonzero(self.line[1:] != self.line[:-1]) + 1
        return np.concatenate([[0], change, [len(self.line)]])


class _Stream:
    """Verdicts of one partition, group of equal lines by group."""

    def __init__(self, least: int) -> None:
        self.least = least
        self.line = None
        self.first_group = True
        self.out: dict[str, list] = {}
        self._clear()

    def _clear(self) -> None:
        self.out = {name: [] for name in _ARROW.names}

    def _emit(self, kind: int, rows: _Lines, at: np.ndarray) -> None:
        n = len(at)
        self.out["kind"].append(np.full(n, kind, np.int32))
        self.out["doc_id"].append(np.ma.masked_array(rows.doc_id[at], ~rows.has_id[at]))
        self.out["text_key"].append(rows.text_key[at])
        self.out["pos"].append(rows.pos[at])
        undecided = kind == UNDECIDED
        self.out["line"].append(np.full(n, self.line.tobytes() if undecided else None, dtype=object))
        for name in ("first_tag", "last_tag", "documents"):
            self.out[name].append(np.ma.masked_all(n, np.int64))

    def _summary(self) -> None:
        has_id, doc_id = self.top
        row = {"kind": SUMMARY, "text_key": 0, "pos": 0, "first_tag": self.first_tag,
               "last_tag": self.last_tag, "documents": self.documents}
        for name, value in row.items():
            self.out[name].append(np.array([value], np.int32 if name in ("kind", "pos") else np.int64))
        self.out["doc_id"].append(np.ma.masked_array([doc_id], [not has_id], dtype=np.int64))
        self.out["line"].append(np.array([self.line.tobytes()], dtype=object))

    def batch(self) -> pa.RecordBatch:
        columns = []
        for name, kind in zip(_ARROW.names, _ARROW.types):
            parts = self.out[name]
            if name == "line":
                columns.append(pa.array([v for p in parts for v in p], kind))
            else:
                whole = np.ma.concatenate(parts) if parts else np.ma.masked_all(0, kind.to_pandas_dtype())
                columns.append(pa.array(np.ma.getdata(whole), kind, mask=np.ma.getmaskarray(whole)))
        self._clear()
        return pa.RecordBatch.from_arrays(columns, schema=_ARROW)

    def _open(self, rows: _Lines, at: int) -> None:
        self.line = rows.line[at]
        self.top = bool(rows.has_id[at]), int(rows.doc_id[at])
        self.first_tag = self.last_tag = int(rows.tag[at])
        self.documents = 1
        self.held: list[tuple[_Lines, np.ndarray]] = []

    def _extend(self, rows: _Lines, start: int, end: int) -> None:
        """Rows ``start`` to ``end`` hold the open line."""
        tags = rows.tag[start:end]
        self.documents += int(tags[0] != self.last_tag) + int(np.count_nonzero(tags[1:] != tags[:-1]))
        self.last_tag = int(tags[-1])
        at = np.arange(start, end)
        if self.first_group:
            self._emit(UNDECIDED, rows, at)
            return
        other = (rows.has_id[at] != self.top[0]) | (rows.doc_id[at] != self.top[1])
        self.held.append((rows, at[other]))
        if self.documents >= self.least:
            self._release(DROPPED)

    def _release(self, kind: int) -> None:
        for rows, at in self.held:
            self._emit(kind, rows, at)
        self.held = []

    def _whole_groups(self, rows: _Lines, starts: np.ndarray) -> None:
        """Groups that begin and end inside the batch, all at once."""
        low, high = starts[0], starts[-1]
        if low == high:
            return
        sizes = np.diff(starts)
        group = np.repeat(np.arange(len(sizes)), sizes)
        tags = rows.tag[low:high]
        first = starts[:-1] - low
        fresh = np.concatenate([[True], tags[1:] != tags[:-1]])
        fresh[first] = True
        many = np.add.reduceat(fresh, first, dtype=np.int64) >= self.least
        ids, has = rows.doc_id[low:high], rows.has_id[low:high]
        other = (ids != ids[first][group]) | (has != has[first][group])
        at = low + np.flatnonzero(many[group] & other)
        if len(at):
            self._emit(DROPPED, rows, at)

    def feed(self, rows: _Lines) -> None:
        starts = rows.starts()
        at = 0
        if self.line is None:
            self._open(rows, 0)
        if rows.line[0] == self.line:
            self._extend(rows, 0, int(starts[1]))
            at = 1
        if at == len(starts) - 1:
            return
        self._close()
        self._whole_groups(rows, starts[at:-1])
        self._open(rows, int(starts[-2]))
        self._extend(rows, int(starts[-2]), int(starts[-1]))

    def _close(self) -> None:
        """The open line ends inside the partition."""
        if self.first_group:
            self._summary()
        self.held = []
        self.first_group = False

    def end(self) -> None:
        """The open line may go on in the next partition."""
        if self.line is not None:
            self._release(UNDECIDED)
            self._summary()


def stream_verdicts(sorted_lines: DataFrame, least: int) -> DataFrame:
    """Verdicts (see ``VERDICTS``) of sorted partitions: ``DROPPED`` lines, lines
    that are ``UNDECIDED`` inside their partition, and a ``SUMMARY`` of its first
    and its last line (doc_id: of its first document there)."""
    def stream(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        state = _Stream(least)
        for batch in batches:
            if batch.num_rows:
                state.feed(_Lines(batch))
                yield state.batch()
        state.end()
        yield state.batch()

    return sorted_lines.mapInArrow(stream, VERDICTS)


def dropped_lines(docs: DataFrame, min_chars: int = MIN_CHARS,
                  min_documents: int = MIN_DOCUMENTS) -> DataFrame:
    """doc_id, text_key and pos of every line that goes."""
    keys = ["line", F.desc_nulls_last("doc_id"), "row_tag", "pos"]
    hashes = durable(line_hashes(docs, min_chars), "line-hashes")
    ordered = hashes.repartitionByRange(*keys).sortWithinPartitions(*keys)
    verdicts = durable(stream_verdicts(ordered, min_documents), "line-verdicts")
    # Two rows for a partition at most; a row in the middle of its line's documents
    # there is in no other partition.
    ends = verdicts.filter(f"kind = {SUMMARY}").select(
        "line", "doc_id", F.greatest(F.col("documents") - 2, F.lit(0)).alias("inside"),
        F.explode(F.array("first_tag", "last_tag")).alias("tag"))
    totals = ends.groupBy("line", "tag").agg(
        F.sum("inside").alias("inside"), F.max("doc_id").alias("top")).groupBy("line").agg(
        (F.count(F.lit(1)) + F.sum("inside") / 2).cast("long").alias("documents"), F.max("top").alias("top"))
    open_rows = verdicts.filter(f"kind = {UNDECIDED}").select("doc_id", "text_key", "pos", "line")
    late = (open_rows.join(F.broadcast(totals.filter(F.col("documents") >= min_documents)), "line")
            .filter(~F.col("doc_id").eqNullSafe(F.col("top"))))
    columns = ["doc_id", "text_key", "pos"]
    return verdicts.filter(f"kind = {DROPPED}").select(*columns).unionByName(late.select(*columns))


def pack(dropped: np.ndarray) -> bytes:
    """Bitmap of the lines to keep, compressed. It ends with a 1 behind the last
    line that goes, so the bits that fill up the last byte are told from lines."""
    keep = np.ones(int(dropped.max()) + 2, np.uint8)
    keep[dropped] = 0
    return zlib.compress(np.packbits(keep, bitorder="little").tobytes(), 6)


def unpack(bitmap: bytes, n_lines: int) -> np.ndarray:
    """Whether each of ``n_lines`` lines stays; lines past the bitmap do."""
    bits = np.unpackbits(np.frombuffer(zlib.decompress(bitmap), np.uint8), bitorder="little")
    end = int(np.flatnonzero(bits)[-1])
    keep = np.ones(max(n_lines, end), bool)
    keep[:end] = bits[:end].astype(bool)
    return keep[:n_lines]


def keep_bitmaps(docs: DataFrame, min_chars: int = MIN_CHARS,
                 min_documents: int = MIN_DOCUMENTS) -> DataFrame:
    """A row (doc_id, text_key, n_dropped, keep_bitmap) for every document that
    loses lines, written.

    A line's key is the line with blanks stripped at both ends and A-Z
    lower-cased. Keys of at least ``min_chars`` code points that at least
    ``min_documents`` documents hold lose all their lines except in the document
    with the largest doc_id.

    Every row is a document. Rows that repeat the largest doc_id all keep the line;
    null ids are one id below all others. Null and empty texts have one empty line.
    An empty table gives an empty result. Other columns are not looked at.
    """
    def pack_all(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            packed = [pack(np.asarray(p.values)) for p in batch.column("dropped")]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("text_key"), batch.column("n_dropped"),
                 pa.array(packed, pa.binary())], ["doc_id", "text_key", "n_dropped", "keep_bitmap"])

    # A set: rows that repeat id and text lose the same lines.
    sets = (dropped_lines(docs, min_chars, min_documents).groupBy("doc_id", "text_key")
            .agg(F.collect_set("pos").alias("dropped"))
            .select("doc_id", "text_key", F.size("dropped").cast("long").alias("n_dropped"), "dropped"))
    return durable(sets.mapInArrow(
        pack_all, "doc_id long, text_key long, n_dropped long, keep_bitmap binary"), "keep-bitmaps")


def kept_texts(docs: DataFrame, bitmaps: DataFrame) -> DataFrame:
    """The rows of ``docs`` that lose lines: their columns as they are, with the
    kept lines as ``text``, and ``n_dropped`` (underscores are added if a column
    has that name). Rows that lose nothing are not moved: the join is an inner one
    on id and text key, so Spark may filter the texts by the bitmaps' keys first."""
    name, dropped = free_name(docs.columns, "_keep_bitmap"), free_name(docs.columns, "n_dropped")
    d = docs.alias("d")
    b = bitmaps.alias("b")
    on = (F.col("d.doc_id").cast("long").eqNullSafe(F.col("b.doc_id"))
          & (text_key(F.col("d.text")) == F.col("b.text_key")))
    met = d.join(b, on).select("d.*", F.col("b.keep_bitmap").alias(name), F.col("b.n_dropped").alias(dropped))
    at = [i for i, c in enumerate(met.columns) if c.lower() == "text"][0]

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = []
            for text, bitmap in zip(batch.column(at).to_pylist(), batch.column(name).to_pylist()):
                lines = (text or "").split("\n")
                keep = unpack(bitmap, len(lines))
                texts.append("\n".join(line for line, k in zip(lines, keep) if k))
            columns = list(batch.columns)
            columns[at] = pa.array(texts, batch.schema.field(at).type)
            yield pa.RecordBatch.from_arrays(columns, schema=batch.schema)

    return met.mapInArrow(cut, met.schema).drop(name)


def dedup_lines(docs: DataFrame, min_chars: int = MIN_CHARS,
                min_documents: int = MIN_DOCUMENTS) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_lines (before), n_dropped, and the
    SHA-256 of the text that is left. Digests of texts that lose nothing are taken
    where they are read; odd rows as in ``keep_bitmaps``."""
    bitmaps = keep_bitmaps(docs, min_chars, min_documents)

    def digest(text: Column) -> Column:
        return F.sha2(F.coalesce(text, F.lit("")).cast("binary"), 256)

    slim = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    whole = slim.select("doc_id", text_key(F.col("text")).alias("text_key"),
                        F.size(lines_of(F.col("text"))).cast("long").alias("n_lines"),
                        digest(F.col("text")).alias("whole_sha256"))
    keyed = slim.withColumn("text_key", text_key(F.col("text")))
    cut = durable(kept_texts(keyed, bitmaps).groupBy("doc_id", "text_key").agg(
        F.any_value("n_dropped").alias("n_dropped"), F.any_value(digest(F.col("text"))).alias("cut_sha256")),
        "cut-digests")
    w, c = whole.alias("w"), cut.alias("c")
    on = F.col("w.doc_id").eqNullSafe(F.col("c.doc_id")) & (F.col("w.text_key") == F.col("c.text_key"))
    return w.join(c, on, "left").select(
        "w.doc_id", "w.n_lines", F.coalesce("c.n_dropped", F.lit(0).cast("long")).alias("n_dropped"),
        F.coalesce("c.cut_sha256", "w.whole_sha256").alias("kept_sha256"))
