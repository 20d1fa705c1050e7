"""Prefix trie of conversations from double arrays.

Every conversation is a sequence of turns. A node is a distinct sequence of first
turns. A sequence is cut into segments of ``SEGMENT`` turns; a segment's shard is
the prefix before it, told by a 128-bit hash. Equal segments of a shard become one
row with counts, so copies of a conversation, however many, weigh no more than one.

The segments are range partitioned and sorted by shard and content, so a prefix
that very many conversations share is spread. Each partition packs runs of sorted
segments: it gives their turns dense ids, builds BASE and CHECK arrays, walks them
for the nodes and sums subtrees bottom-up. Nodes that another pack may also hold
(those on the paths of a pack's first and last segment, and of segments of full
length, which go on in the next shard) leave partial aggregates, which are merged by
node and added up along the shared part of the trie by pointer doubling, in
log2(depth) rounds. All other nodes are final in their pack.

The ids of conversations that end at the same node are range sorted, joined in
chunks, and hashed from chunk to chunk, so no list of ids is held.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..plans.durable import durable
from .double_array import DoubleArray
from .ordering import numbered
from .sized import broadcast_if_small

SEGMENT = 512
PACK_TURNS = 60_000
TURNS_PER_COPY = 4096
#: Bytes of a turn: 16 of its digest, 8 of the code points of its text.
TURN = 24
BLOCK, LEADS = 100, 6
#: Rows of the shared part of the trie (about 100 bytes each) that may be broadcast.
SHARED_ROWS = 100_000

_PACKED = pa.schema([
    ("depth", pa.int64()), ("id1", pa.int64()), ("id2", pa.int64()), ("up1", pa.int64()),
    ("up2", pa.int64()), ("shared", pa.bool_()), ("n", pa.int64()), ("low", pa.int64()),
    ("chars", pa.int64()), ("children", pa.int64()), ("leaves", pa.int64()), ("saved", pa.int64()),
    ("ends", pa.int64()), ("end_low", pa.int64()), ("up_low", pa.int64())])
PACKED = ", ".join(f"{f.name} {'boolean' if f.name == 'shared' else 'long'}" for f in _PACKED)
NODE = ["depth", "id1", "id2"]
_NONE = np.iinfo(np.int64).max


def turn_token(role: Column, text: Column) -> Column:
    """24 bytes that tell a turn, null as empty: 128 bits of the SHA-256 of role and
    text, and the text's code points."""
    role, text = F.coalesce(role, F.lit("")), F.coalesce(text, F.lit(""))
    told = F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text)
    return F.unhex(F.concat(F.substring(F.sha2(told.cast("binary"), 256), 1, 32),
                            F.lpad(F.hex(F.char_length(text)), 16, "0")))


def ordered_turns(conversations: DataFrame) -> DataFrame:
    """conv_id, token, pos (from 0) and group_rows of every turn, written. Turns
    are ordered by turn (null first), then by token. Rows without a conv_id are in no
    conversation."""
    turns = durable(conversations.filter(F.col("conv_id").isNotNull()).select(
        F.col("conv_id").cast("long").alias("conv_id"), "turn",
        turn_token(F.col("role"), F.col("text")).alias("token"),
        F.monotonically_increasing_id().alias("row_tag")), "trie-turns")
    return durable(numbered(turns, ["conv_id"], ["turn", "token", "row_tag"], "trie-turns")
                   .select("conv_id", "token", "pos", "group_rows"), "trie-ordered")


def lead_turns(conv_id: Column, leads: int = LEADS) -> Column:
    """How many turns a conversation takes from its block's first one."""
    return F.crc32(conv_id.cast("string").cast("binary")) % leads


def rebuilt_turns(ordered: DataFrame, block: int = BLOCK, leads: int = LEADS) -> tuple[DataFrame, DataFrame]:
    """(conv_id, length) of every rebuilt conversation, and its turns (conv_id,
    length, at, token): the first ``lead_turns`` of the conversation whose id is
    the largest multiple of ``block`` towards 0, then its own turns after as many.

    A conversation's row is copied once for every ``TURNS_PER_COPY`` of its turns,
    and its turns are dealt among the copies."""
    lead = lead_turns(F.col("conv_id"), leads).alias("lead")
    heads = (ordered.filter((F.col("conv_id") % block == 0) & (F.col("pos") < leads - 1))
             .groupBy(F.col("conv_id").alias("first_id"))
             .agg(F.array_sort(F.collect_list(F.struct("pos", "token"))).alias("head")))
    convs = ordered.filter("pos = 0").select(
        "conv_id", "group_rows", lead, (F.col("conv_id") - F.col("conv_id") % block).alias("first_id"))
    taken = F.slice(F.coalesce("head.token", F.array().cast("array<binary>")), F.lit(1), F.col("lead").cast("int"))
    convs = convs.join(heads, "first_id", "left").select("conv_id", "group_rows", "lead", taken.alias("taken"))
    convs = durable(convs.select("*", (F.size("taken") + F.greatest(
        F.col("group_rows") - F.col("lead"), F.lit(0))).cast("long").alias("length")), "trie-conversations")
    copies = convs.select("conv_id", "lead", "length", F.size("taken").alias("before"), F.explode(F.sequence(
        F.lit(0).cast("long"), F.expr(f"(group_rows - 1) div {TURNS_PER_COPY}"))).alias("copy"))
    own = (ordered.withColumn("copy", F.expr(f"pos div {TURNS_PER_COPY}")).join(copies, ["conv_id", "copy"])
           .filter("pos >= lead")
           .select("conv_id", "length", (F.col("pos") - F.col("lead") + F.col("before")).alias("at"), "token"))
    led = convs.select("conv_id", "length", F.posexplode("taken").alias("at", "token"))
    return convs.select("conv_id", "length"), own.unionByName(led)


def segments(convs: DataFrame, turns: DataFrame, size: int = SEGMENT) -> DataFrame:
    """conv_id, length, band, segment (bytes), p1, p2 (hash of the prefix before it), q1,
    q2 (hash of the prefix up to its end) and last, written. A conversation
    without turns has one empty segment."""
    band = F.expr(f"at div {size}").alias("band")
    cut = turns.groupBy("conv_id", "length", band).agg(
        F.array_sort(F.collect_list(F.struct("at", "token"))).alias("t")).select(
        "conv_id", "length", "band",
        F.unhex(F.array_join(F.transform("t.token", lambda x: F.hex(x)), "")).alias("segment"))
    empty = convs.filter("length = 0").select(
        "conv_id", "length", F.lit(0).cast("long").alias("band"), F.unhex(F.lit("")).alias("segment"))

    def own(seed: int) -> Column:
        return F.xxhash64(F.lit(seed).cast("long"), F.col("band"), F.col("segment"))

    told = durable(cut.select("*", own(1).alias("s1"), own(2).alias("s2")).unionByName(
        empty.select("*", F.lit(0).cast("long").alias("s1"), F.lit(0).cast("long").alias("s2"))), "trie-cut")
    # Only conversations of several segments have prefixes; hashes are xored, one small row a segment.
    earlier = W.partitionBy("conv_id").orderBy("band").rowsBetween(W.unboundedPreceding, -1)
    zero = F.lit(0).cast("long")
    prefixes = told.filter(f"length > {size}").select("conv_id", "band", *[
        F.coalesce(F.bit_xor(f"s{i}").over(earlier), zero).alias(f"p{i}") for i in (1, 2)])
    short = told.filter(f"length <= {size}").select("*", zero.alias("p1"), zero.alias("p2"))
    long = told.filter(f"length > {size}").join(prefixes, ["conv_id", "band"])
    return durable(short.unionByName(long).select(
        "conv_id", "length", "band", "segment", "p1", "p2",
        F.col("p1").bitwiseXOR(F.col("s1")).alias("q1"), F.col("p2").bitwiseXOR(F.col("s2")).alias("q2"),
        (F.col("band") == F.expr(f"greatest(length - 1, 0) div {size}")).alias("last")), "trie-segments")


def _signed(value: int) -> int:
    return value - (value >> 63 << 64)


def _seeds(band: int) -> list[int]:
    """The running hash before a segment's bytes, as in ``segments``."""
    return [xxhash.xxh64_intdigest(band.to_bytes(8, "little"),
                                   xxhash.xxh64_intdigest(seed.to_bytes(8, "little"), 42)) for seed in (1, 2)]


class _Pack:
    """Sorted distinct segments of one shard as a double array."""

    def __init__(self, band: int, prefix: tuple[int, int], raw: list[bytes], counts: np.ndarray, size: int) -> None:
        self.band, self.prefix, self.raw, self.size = band, prefix, raw, size
        self.n, self.low, self.ends, self.end_low = counts
        lengths = np.array([len(r) // TURN for r in raw], np.int64)
        tokens = np.frombuffer(b"".join(raw), np.dtype([("a", ">u8"), ("b", ">u8"), ("c", ">u8")]))
        kinds, codes = np.unique(tokens, return_inverse=True)
        self.trie = DoubleArray(codes.astype(np.int64), lengths)
        self.code_chars = kinds["c"].astype(np.int64)
        self.lengths = lengths

    def nodes(self, open_paths: set[int]) -> dict[str, np.ndarray]:
        """Columns of ``PACKED`` for the shard's nodes in this pack. ``open_paths``:
        segments whose path another pack may share."""
        states = len(self.trie.check)
        total = {name: np.zeros(states, np.int64) for name in
                 ("n", "ends", "children", "leaves", "saved", "chars", "depth")}
        low, end_low = np.full(states, _NONE), np.full(states, _NONE)
        sample = np.full(states, _NONE)
        shared = np.zeros(states, bool)
        shared[0] = True
        levels = []
        long = self.lengths == self.size
        long[list(open_paths)] = True
        for depth, alive, state in self.trie.walk():
            np.add.at(total["n"], state, self.n[alive])
            np.minimum.at(low, state, self.low[alive])
            np.minimum.at(sample, state, alive)
            done = self.lengths[alive] == depth
            np.add.at(total["ends"], state[done], self.ends[alive[done]])
            np.minimum.at(end_low, state[done], self.end_low[alive[done]])
            shared[state[long[alive]]] = True
            here = np.unique(state)
            total["depth"][here] = depth
            if depth:
                one = self.trie.first[sample[here]] + depth - 1
                total["chars"][here] = self.code_chars[self.trie.codes[one]]
            levels.append(here)
        for here in reversed(levels[1:]):
            own = here[~shared[here]]
            up = self.trie.check[own]
            total["leaves"][own] += total["children"][own] == 0
            total["saved"][own] += (total["n"][own] - 1) * total["chars"][own]
            np.add.at(total["children"], up, 1)
            np.add.at(total["leaves"], up, total["leaves"][own])
            np.add.at(total["saved"], up, total["saved"][own])
        every = np.concatenate(levels)
        id1, id2 = self._ids(total["depth"], sample, every, states)
        up = np.where(every == 0, 0, self.trie.check[every])
        top = every == 0
        if self.band:      # counted with the last node of the shard before
            total["n"][0] = total["ends"][0] = 0
            low[0] = end_low[0] = _NONE
        masked = np.ma.masked_array
        return {
            "depth": total["depth"][every] + self.band * self.size, "id1": id1[every], "id2": id2[every],
            "up1": masked(id1[up], top), "up2": masked(id2[up], top), "shared": shared[every],
            "n": total["n"][every], "low": masked(low[every], low[every] == _NONE),
            "end_low": masked(end_low[every], end_low[every] == _NONE),
            "up_low": masked(low[up], top | shared[up]),
            **{name: total[name][every] for name in ("chars", "children", "leaves", "saved", "ends")}}

    def _ids(self, depth: np.ndarray, sample: np.ndarray, every: np.ndarray, states: int) -> list[np.ndarray]:
        out = []
        for prefix, seed in zip(self.prefix, _seeds(self.band)):
            ids = np.zeros(states, np.int64)
            ids[0] = prefix
            for s in every[every > 0].tolist():
                part = self.raw[sample[s]][:depth[s] * TURN]
                ids[s] = prefix ^ _signed(xxhash.xxh64_intdigest(part, seed))
            out.append(ids)
        return out


def _pack_nodes(rows: list[tuple], size: int) -> Iterator[pa.RecordBatch]:
    """Nodes of a pack: ``rows`` (band, p1, p2, segment, n, low, ends, end_low),
    sorted. Only its first and last paths can go on elsewhere."""
    start = 0
    for i in range(1, len(rows) + 1):
        if i < len(rows) and rows[i][:3] == rows[start][:3]:
            continue
        group = rows[start:i]
        counts = np.array([[r[k] if r[k] is not None else _NONE for r in group] for k in (4, 5, 6, 7)], np.int64)
        pack = _Pack(group[0][0], group[0][1:3], [r[3] for r in group], counts, size)
        ends = {0} if start == 0 else set()
        ends |= {len(group) - 1} if i == len(rows) else set()
        columns = pack.nodes(ends)
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.ma.getdata(c := columns[f.name]), f.type,
                      mask=np.ma.getmaskarray(c) if np.ma.isMaskedArray(c) else None) for f in _PACKED],
            schema=_PACKED)
        start = i


def packed_nodes(cut: DataFrame, size: int = SEGMENT, pack_turns: int = PACK_TURNS) -> DataFrame:
    """Nodes of all packs, written: final ones, and partial aggregates of shared
    ones (``shared``; children, leaves and saved of final nodes below only)."""
    order = ["band", "p1", "p2", "segment"]
    distinct = durable(cut.groupBy(*order).agg(
        F.count(F.lit(1)).alias("n"), F.min("conv_id").alias("low"), F.count_if("last").alias("ends"),
        F.min(F.when(F.col("last"), F.col("conv_id"))).alias("end_low")), "trie-distinct")

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows, held = [], 0
        for batch in batches:
            for row in zip(*[c.to_pylist() for c in batch.columns]):
                rows.append(row)
                held += len(row[3]) // TURN + 1
                if held >= pack_turns:
                    yield from _pack_nodes(rows, size)
                    rows, held = [], 0
        if rows:
            yield from _pack_nodes(rows, size)

    ordered = distinct.repartitionByRange(*order).sortWithinPartitions(*order)
    return durable(ordered.mapInArrow(pack, PACKED), "trie-nodes")


def _node_on(a: str, b: str, up: bool = False) -> Column:
    """Table ``a``'s node (or its parent) is table ``b``'s node."""
    if up:
        return ((F.col(f"{a}.depth") - 1 == F.col(f"{b}.depth")) & (F.col(f"{a}.up1") == F.col(f"{b}.id1"))
                & (F.col(f"{a}.up2") == F.col(f"{b}.id2")))
    return (F.col(f"{a}.depth") == F.col(f"{b}.depth")) & (F.col(f"{a}.id1") == F.col(f"{b}.id1")) & (
        F.col(f"{a}.id2") == F.col(f"{b}.id2"))


def shared_nodes(packed: DataFrame) -> DataFrame:
    """Merged shared nodes with sums over their whole subtrees, written."""
    parts = packed.filter("shared")
    merged = durable(parts.groupBy(*NODE).agg(
        F.max("up1").alias("up1"), F.max("up2").alias("up2"), F.sum("n").alias("n"), F.min("low").alias("low"),
        F.max("chars").alias("chars"), F.sum("children").alias("children"), F.sum("leaves").alias("leaves"),
        F.sum("saved").alias("saved"), F.sum("ends").alias("ends"), F.min("end_low").alias("end_low")),
        "trie-merged")
    below = merged.filter("up1 is not null").groupBy(
        (F.col("depth") - 1).alias("depth"), F.col("up1").alias("id1"), F.col("up2").alias("id2")).agg(
        F.count(F.lit(1)).alias("more"))
    whole = merged.join(below, NODE, "left").withColumn(
        "children", F.col("children") + F.coalesce("more", F.lit(0))).drop("more")
    whole = durable(whole.withColumns({
        "leaves": F.col("leaves") + (F.col("children") == 0).cast("long"),
        "saved": F.col("saved") + (F.col("n") - 1) * F.col("chars")}), "trie-shared")
    sums = whole.select(*NODE, (F.col("depth") - 1).alias("to_depth"), F.col("up1").alias("to1"),
                        F.col("up2").alias("to2"), "leaves", "saved")
    while not sums.filter("to1 is not null").isEmpty():
        sums = _double(sums)
    return durable(whole.drop("leaves", "saved").join(sums.select(*NODE, "leaves", "saved"), NODE), "trie-shared")


def _double(sums: DataFrame) -> DataFrame:
    """One round: a node that sums all descendants nearer than its pointer's reach
    takes the sums of those exactly as far away; pointers then reach twice as far."""
    a, t = sums.filter("to1 is not null").alias("a"), sums.alias("t")
    to = ((F.col("a.to_depth") == F.col("t.depth")) & (F.col("a.to1") == F.col("t.id1"))
          & (F.col("a.to2") == F.col("t.id2")))
    further = a.join(t, to).select("a.depth", "a.id1", "a.id2", "t.to_depth", "t.to1", "t.to2")
    lower = sums.filter("to1 is not null").groupBy(
        F.col("to_depth").alias("depth"), F.col("to1").alias("id1"), F.col("to2").alias("id2")).agg(
        F.sum("leaves").alias("more_leaves"), F.sum("saved").alias("more_saved"))
    return durable(sums.drop("to_depth", "to1", "to2").join(lower, NODE, "left").join(further, NODE, "left").select(
        *NODE, "to_depth", "to1", "to2",
        (F.col("leaves") + F.coalesce("more_leaves", F.lit(0))).alias("leaves"),
        (F.col("saved") + F.coalesce("more_saved", F.lit(0))).alias("saved")), "trie-sums")


def end_hashes(cut: DataFrame) -> DataFrame:
    """SHA-256 of the comma-joined ascending ids of the conversations that end at a
    node, at least for all nodes where several do, written."""
    ends = cut.filter("last").select(F.col("length").alias("depth"), F.col("q1").alias("id1"),
                                     F.col("q2").alias("id2"), "conv_id")
    order = [*NODE, "conv_id"]

    def chunk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            keys = np.stack([batch.column(c).to_numpy() for c in NODE])
            ids = batch.column("conv_id").to_pylist()
            starts = np.flatnonzero(np.concatenate([[True], (keys[:, 1:] != keys[:, :-1]).any(axis=0)]))
            stops = np.append(starts[1:], len(ids))
            # One id inside a batch is alone at its node; at an end it may have neighbours.
            some = (stops - starts > 1) | (starts == 0) | (stops == len(ids))
            starts, stops = starts[some], stops[some]
            yield pa.RecordBatch.from_arrays(
                [pa.array(keys[i, starts]) for i in range(3)]
                + [pa.array([ids[a] for a in starts], pa.int64()),
                   pa.array([",".join(map(str, ids[a:b])) for a, b in zip(starts, stops)], pa.string())],
                [*NODE, "first", "ids"])

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, running = None, None
        for batch in batches:
            out = []
            for *node, _, ids in zip(*[c.to_pylist() for c in batch.columns]):
                if node == key:
                    running.update(b"," + ids.encode())
                else:
                    out += [(*key, running.hexdigest())] if key else []
                    key, running = node, hashlib.sha256(ids.encode())
            yield rows(out)
        yield rows([(*key, running.hexdigest())] if key else [])

    def rows(out: list[tuple]) -> pa.RecordBatch:
        kinds = [pa.int64()] * 3 + [pa.string()]
        return pa.RecordBatch.from_arrays(
            [pa.array([r[i] for r in out], kinds[i]) for i in range(4)], [*NODE, "ends_sha256"])

    chunks = ends.repartitionByRange(*order).sortWithinPartitions(*order).mapInArrow(
        chunk, "depth long, id1 long, id2 long, first long, ids string")
    return durable(chunks.repartition(*NODE).sortWithinPartitions(*NODE, "first").mapInArrow(
        digest, "depth long, id1 long, id2 long, ends_sha256 string"), "trie-ends")


def prefix_trie(conversations: DataFrame, block: int = BLOCK, leads: int = LEADS, size: int = SEGMENT,
                pack_turns: int = PACK_TURNS) -> DataFrame:
    """Nodes of the trie of all rebuilt conversations (see ``rebuilt_turns``).

    One row per node: conv_id (smallest member), depth, parent_conv_id, n_convs,
    n_children, n_leaves, saved_tokens, ends_sha256. The root has depth 0 and no
    parent; conversations that are left without turns end there.

    Null roles and texts are empty. Null turns come first; turns that repeat a
    number are ordered by their token. Rows without conv_id belong to no
    conversation. Repeated rows are turns of their own. An empty table has no root.
    Other columns are not looked at. Prefixes are told apart by 128-bit hashes.
    """
    convs, turns = rebuilt_turns(ordered_turns(conversations), block, leads)
    cut = segments(convs, turns, size)
    packed = packed_nodes(cut, size, pack_turns)
    shared = shared_nodes(packed)
    columns = [*NODE, "low", "n", "children", "leaves", "saved", "ends", "end_low"]
    ups = broadcast_if_small(shared.select(*NODE, "low"), SHARED_ROWS).alias("u")
    inner = packed.filter("not shared")
    known = inner.filter("up_low is not null").select(*columns, F.col("up_low").alias("parent_conv_id"))
    below = inner.filter("up_low is null").alias("a").join(ups, _node_on("a", "u", up=True)).select(
        *[f"a.{c}" for c in columns], F.col("u.low").alias("parent_conv_id"))
    upper = shared.alias("a").join(ups, _node_on("a", "u", up=True), "left").select(
        *[f"a.{c}" for c in columns], F.col("u.low").alias("parent_conv_id"))
    nodes = durable(known.unionByName(below).unionByName(upper), "trie-all")
    few = nodes.filter("ends <= 1").select("*", F.sha2(F.coalesce(
        F.col("end_low").cast("string"), F.lit("")).cast("binary"), 256).alias("ends_sha256"))
    many = nodes.filter("ends > 1").join(end_hashes(cut), NODE)
    return few.unionByName(many).select(
        F.col("low").alias("conv_id"), "depth", "parent_conv_id", F.col("n").alias("n_convs"),
        F.col("children").alias("n_children"), F.col("leaves").alias("n_leaves"),
        F.col("saved").alias("saved_tokens"), "ends_sha256")
