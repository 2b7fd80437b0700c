"""Operator 8, suffix-array dedup by the distributed difference-cover algorithm.

The bytes that another place of the corpus repeats (matches of ``length`` bytes
or more, never across documents) are found in these steps:

1. Texts are cut into phrases at winnowed anchors: every window of ``length``
   bytes has the anchor with the smallest hash of its ``k``-byte grams, so equal
   windows have equal anchors.  Anchors that occur only once cannot lie in a
   repeat; runs of shared anchors are segments, strings of phrase names.  Equal
   segments are kept once, with the number of places that they have.
2. ``suffix_order`` sorts all suffixes of the segments with the difference cover
   {1, 2} mod 3: sampled triples are sorted and named, the strings of names are
   sorted by recursion, and the remaining suffixes are merged in by their first
   symbol and the rank that follows it.
3. Prefixes of adjacent suffixes are compared: what they share is a repeat,
   known to whole phrases (and a segment with several places is one to its end).
4. Only the windows that this leaves open (where a repeat ends inside a phrase)
   are compared byte by byte: by the hash of the whole window with the open
   windows and with those of one place of each segment.  Before, the windows of an
   anchor are dealt to buckets by where the anchor lies in them; what all
   windows of a bucket have in common is a longer gram, and buckets whose gram has
   no other place are left out.

Memory: a task holds parts of bounded size; names, ranks and order are made by
range-partitioned sorts; of anchors and windows that are frequent in a task one
entry is sent.  Equality of grams, phrases and windows is by 64-bit hashes.

Results for odd input: a null text is empty; texts shorter than ``length`` have
no repeats; a null id is larger than all others; repeated rows are copies of
each other; extra columns are left alone; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strata.llm.common import (
    PACKED,
    Held,
    _power_table,
    answers,
    by_document,
    keyed,
    mixed,
    packed_rows,
    partitions,
    parts_of,
    passed_on,
    reduced,
    release_since,
    slices,
    stored,
    text_bytes,
    trim,
    unpacked,
    with_answers,
    word_hashes,
    written,
)

LENGTH, GRAM = 200, 32
DEPTH = 40  # more levels than any string has: a level's strings have a third of the length
STEP = 1 << 18  # window starts that are handled at once
PHRASE = [np.uint64, np.int64, np.int64, np.int32, np.int32, np.uint64]  # gram, id, salt, place, gap, name
ENTRY = [np.uint64, np.int64, np.int64, np.int32, np.int8]                         # window, id, salt, place, asks
_NONE = -(1 << 63)
BUCKETS = 8  # of the windows of an anchor, by how far it is from their start
WHICH, ASKS, TOLD = BUCKETS - 1, 16, 32  # flags of a bucket's entry


def _spans(raw: np.ndarray, n: int) -> np.ndarray:
    """Hash of each run of ``n`` bytes."""
    if len(raw) < n:
        return np.zeros(0, np.uint64)
    up, down = _power_table(len(raw) + 1)
    sums = np.zeros(len(raw) + 1, np.uint64)
    np.cumsum((raw.astype(np.uint64) + np.uint64(1)) * up[:len(raw)], out=sums[1:])
    return mixed((sums[n:] - sums[:-n]) * down[:len(raw) - n + 1])


def anchored(raw: np.ndarray, ends: np.ndarray, length: int, k: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """First byte, anchor and text of the windows of ``length`` bytes that lie
    in one text, in steps of bounded size."""
    w = length - k + 1
    low = np.uint64((1 << 24) - 1)
    for lo in range(0, max(0, len(raw) - length + 1), STEP):
        part = raw[lo:lo + STEP + length - 1]
        grams = _spans(part, k)
        n = len(grams) - w + 1
        # the place goes into the low bits, so that the right-most of equal grams is the smallest
        keys = (grams & ~low) | (low - np.arange(len(grams), dtype=np.uint64))
        padded = np.full(-(-len(keys) // w) * w, ~np.uint64(0))
        padded[:len(keys)] = keys
        rows = padded.reshape(-1, w)
        before = np.minimum.accumulate(rows, axis=1).ravel()
        after = np.minimum.accumulate(rows[:, ::-1], axis=1)[:, ::-1].ravel()
        least = np.minimum(after[:n], before[w - 1:w - 1 + n])
        starts = np.arange(lo, lo + n)
        owner = np.searchsorted(ends, starts, "right") - 1
        inside = starts + length <= ends[owner + 1]
        yield starts[inside], (lo + (low - (least & low)).astype(np.int64))[inside], owner[inside]


def _phrases(parts: int, length: int, k: int):
    """Map side of the join on anchors."""
    def send(*arrays: np.ndarray) -> Iterator[pa.RecordBatch]:
        g, ords = arrays[:2]
        order = np.argsort(g, kind="stable")
        same = np.zeros(len(g) + 1, bool)
        same[1:-1] = g[order][1:] == g[order][:-1]
        known, head = same[:-1] | same[1:], ~same[:-1]
        arrays = [a[order] for a in arrays]
        yield from packed_rows(parts, mixed(arrays[1][known].view(np.uint64)), [a[known] for a in arrays], kind=1)
        sent = ~known | head
        arrays[3] = np.where(known, -1, arrays[3]).astype(np.int32)  # a witness, which is not sent back
        yield from packed_rows(parts, arrays[0][sent], [a[sent] for a in arrays])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = Held(send, 400_000)
        for batch in slices(batches, "text"):
            raw, ends = text_bytes(batch["text"])
            found, owners = [], []
            for _, anchor, owner in anchored(raw, ends, length, k):
                if len(anchor):
                    new = np.diff(anchor, prepend=-1) != 0
                    found.append(anchor[new])
                    owners.append(owner[new])
            if not found:
                continue
            at, first = np.unique(np.concatenate(found), return_index=True)
            owner = np.concatenate(owners)[first]
            ords, salts = (batch[c].to_numpy()[owner] for c in ("_ord", "_salt"))
            begin, end = ends[owner], ends[owner + 1]
            last = np.append(owner[1:] != owner[:-1], True)
            gap = np.where(last, end - at, np.append(at[1:], 0) - at)
            name = word_hashes(raw, at, np.where(last, end, np.minimum(at + gap + k, end)))
            # no other text has the phrase after a text's last anchor
            own = mixed(ords.view(np.uint64) ^ mixed(salts.view(np.uint64) + at.astype(np.uint64)))
            name = np.where(last, name ^ own, name)
            yield from held.add(word_hashes(raw, at, at + k), ords, salts, (at - begin).astype(np.int32),
                                gap.astype(np.int32), name)
        yield from held.flush()
    return run


def _shared_phrases(part: int, blocks: dict[int, list[bytes]]) -> Iterator[pa.RecordBatch]:
    """Reduce side: anchors that occur more than once, back to their documents."""
    yield from passed_on(part, blocks.get(1, []))
    arrays = unpacked(blocks.get(0, []), PHRASE)
    order = np.argsort(arrays[0], kind="stable")
    g = arrays[0][order]
    same = np.zeros(len(g) + 1, bool)
    same[1:-1] = g[1:] == g[:-1]
    back = order[(same[:-1] | same[1:]) & (arrays[3][order] >= 0)]
    arrays = [a[back] for a in arrays]
    yield from packed_rows(_shared_phrases.parts, mixed(arrays[1].view(np.uint64)), arrays)


def _segments(part: int, blocks: dict[int, list[bytes]]) -> Iterator[pa.RecordBatch]:
    """The runs of shared anchors of the documents: one row per run, without
    its last anchor, whose phrase has no other place."""
    _, ords, salts, at, gap, name = unpacked([b for bs in blocks.values() for b in bs], PHRASE)
    order = np.lexsort((at, salts, ords))
    ords, salts, at, gap, name = (a[order] for a in (ords, salts, at, gap, name))
    keep = np.ones(len(ords), bool)
    keep[1:] = (ords[1:] != ords[:-1]) | (salts[1:] != salts[:-1]) | (at[1:] != at[:-1])
    ords, salts, at, gap, name = (a[keep] for a in (ords, salts, at, gap, name))
    if not len(ords):
        return
    ends = np.append((ords[1:] != ords[:-1]) | (salts[1:] != salts[:-1]) | (at[:-1] + gap[:-1] != at[1:]), True)
    new = np.append(True, ends[:-1])
    run = np.cumsum(new) - 1
    first = np.flatnonzero(new)
    # the name of a run: a hash of its names in order, and of how many they are
    count = np.bincount(run) - 1
    weight = mixed((np.arange(len(run)) - first[run]).astype(np.uint64) + np.uint64(0x2545F4914F6CDD1D))
    sums = np.zeros(len(first), np.uint64)
    inner = ~ends
    np.add.at(sums, run[inner], mixed(name[inner] ^ weight[inner]))
    segment = mixed(sums + mixed(count.astype(np.uint64))).view(np.int64)
    offsets = pa.array(np.append(0, np.cumsum(count)).astype(np.int32))
    lists = [pa.ListArray.from_arrays(offsets, pa.array(a[inner])) for a in (gap, name.view(np.int64))]
    yield pa.RecordBatch.from_arrays(
        [pa.array(segment), pa.array(ords[first]), pa.array(salts[first]), pa.array(at[first]), pa.array(count.astype(np.int32)), *lists],
        ["segment", "_ord", "_salt", "at", "size", "gap", "name"])


# --- the difference cover ----------------------------------------------------

def _in_order(df: DataFrame, keys: list[str], name: str) -> DataFrame:
    """``df`` sorted by ``keys`` over all partitions and stored; the column
    ``_place`` follows this order."""
    return stored(df.repartitionByRange(*keys).sortWithinPartitions(*keys)
                  .withColumn("_place", F.monotonically_increasing_id()), name)


def _following(array: str, i: Column | str) -> Column:
    return F.coalesce(F.get(F.col(array), i), F.lit(_NONE))


def _greatest_before(rows: DataFrame, keys: list[str], value: str, out: str) -> DataFrame:
    """``rows`` with the greatest ``value`` (long) up to them in the order of
    ``keys``.  (Not the last one: suffixes without a difference have ranks in no
    special order.)  Sorted partitions are repaired by one value per partition."""
    def fill(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        chunk, most = TaskContext.get().partitionId(), _NONE
        for batch in batches:
            if not len(batch):
                continue
            filled = np.maximum.accumulate(pc.fill_null(batch[value], most).to_numpy())
            filled = np.maximum(filled, most)
            most = int(filled[-1])
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(filled), pa.array([chunk] * len(filled), pa.int32())],
                                             [*batch.schema.names, "_in", "_chunk"])

    schema = ", ".join(f"{c} {t}" for c, t in rows.dtypes) + ", _in long, _chunk int"
    filled = stored(rows.repartitionByRange(*keys).sortWithinPartitions(*keys).mapInArrow(fill, schema), "merge")
    before = Window.orderBy("_chunk").rowsBetween(Window.unboundedPreceding, -1)
    chunks = (filled.groupBy("_chunk").agg(F.max("_in").alias("_most"))
              .select("_chunk", F.max("_most").over(before).alias("_carry")))
    return (filled.join(F.broadcast(chunks), "_chunk")  # one row per partition
            .withColumn(out, F.greatest("_in", "_carry")).drop("_in", "_carry", "_chunk"))


def suffix_order(strings: DataFrame, carried: list[str] = (), depth: int = DEPTH, name: str = "syms") -> DataFrame:
    """All suffixes of the strings (columns ``sid`` long, ``name`` array<long>)
    in order: sid, i, rank.  Ranks are order-preserving, not dense.

    A string that ends is smaller than one that goes on.  Recursion ends when
    all triples have different names or no string has a second symbol, or at
    ``depth``, from where suffixes with
    equal prefixes of 3 ** depth symbols are in no special order."""
    mark = written()
    s = strings.select("sid", F.col(name).alias("s"))
    sampled = s.select("sid", F.explode(F.expr(
        "filter(transform(s, (x, i) -> struct(i AS i, x AS a, s[least(i + 1, size(s) - 1)] AS b, "
        "s[least(i + 2, size(s) - 1)] AS c, size(s) AS n)), t -> t.i % 3 <> 0)")).alias("t"))
    past = F.lit(_NONE)
    triples = sampled.select(
        "sid", "t.i", "t.a", F.when(F.col("t.i") + 1 < F.col("t.n"), F.col("t.b")).otherwise(past).alias("b"),
        F.when(F.col("t.i") + 2 < F.col("t.n"), F.col("t.c")).otherwise(past).alias("c"))
    # sort the sampled triples and name them by their place
    counted = triples.groupBy("a", "b", "c").agg(F.count("*").alias("n"))
    names = _in_order(counted, ["a", "b", "c"], "names")
    named = triples.join(names.select("a", "b", "c", F.col("_place").alias("rank")), ["a", "b", "c"])
    if depth > 1 and not names.filter("n > 1").isEmpty():
        # recurse on the strings of names: one for each class of places
        inner = (named.groupBy((F.col("sid") * 2 + F.col("i") % 3 - 1).alias("sid"))
                 .agg(F.transform(F.sort_array(F.collect_list(F.struct("i", "rank"))), lambda x: x["rank"]).alias("syms")))
        named = (suffix_order(stored(inner, "names-strings"), depth=depth - 1)
                 .select((F.col("sid") - F.pmod("sid", F.lit(2))).alias("_twice"), F.pmod("sid", F.lit(2)).alias("_odd"), "i", "rank")
                 .select((F.col("_twice") / 2).cast("long").alias("sid"),
                         (F.col("i") * 3 + 1 + F.col("_odd")).cast("int").alias("i"), "rank"))
    ranks = named.groupBy("sid").agg(F.transform(F.sort_array(F.collect_list(F.struct("i", "rank"))),
                                                 lambda x: x["rank"]).alias("r"))
    # all places with their first two symbols and the sampled ranks at and after them
    every = (s.join(ranks, "sid", "left").withColumn("r", F.coalesce("r", F.array().cast("array<long>")))
             .select("sid", "s", "r", F.explode(F.sequence(F.lit(0), F.size("s") - 1)).alias("i"))
             .filter("size(s) > 0"))
    slot = lambda d: (F.floor((F.col("i") + d) / 3) * 2 + (F.col("i") + d) % 3 - 1).cast("int")
    rank_at = lambda d: _following("r", slot(d))
    every = stored(every.select(
        "sid", "i", (F.col("i") % 3).alias("cls"), F.get("s", F.col("i")).alias("a"), _following("s", F.col("i") + 1).alias("b"),
        F.when(F.col("i") % 3 != 0, rank_at(0)).alias("own"),
        F.when(F.col("i") % 3 != 2, rank_at(1)).alias("next"),
        F.when(F.col("i") % 3 != 1, rank_at(2)).alias("after")), "places")
    release_since(mark, every)  # names, their strings and order
    # merge: where the remaining suffixes stand among the sampled ones of either class
    rest = _greatest_before(every.filter("cls <> 2"), ["a", "next", "own"], "own", "p1")
    # (nulls first: a remaining suffix that ties with a sampled one stands before it)
    both = rest.filter("cls = 0").unionByName(every.filter("cls = 2").withColumn("p1", F.lit(None).cast("long")))
    rest = _greatest_before(both, ["a", "b", "after", "own"], "own", "p2").filter("cls = 0")
    merged = (rest.select("sid", "i", F.greatest("p1", "p2").alias("k0"), F.lit(1).alias("k1"), "a", "next")
              .unionByName(every.filter("cls <> 0").select("sid", "i", F.col("own").alias("k0"), F.lit(0).alias("k1"),
                                                           F.lit(_NONE).alias("a"), F.lit(_NONE).alias("next"))))
    order = _in_order(merged, ["k0", "k1", "a", "next"], "order")
    release_since(mark, order)
    out = order.select("sid", "i", F.col("_place").alias("rank"))
    out._stored_in = order._stored_in
    return out


# --- the repeats ---------------------------------------------------------------

def _prefixes(reach: int):
    """For each suffix of a segment: its rank, and for its prefixes of 1, 2, ..
    phrases up to ``reach`` bytes their hashes and the bytes that they cover."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in few_names(batches):
            ends = batch["gap"].offsets.to_numpy().astype(np.int64)
            ends = ends - ends[0]
            n = len(ends) - 1
            gap = batch["gap"].flatten().to_numpy().astype(np.int64)
            name = batch["name"].flatten().to_numpy().view(np.uint64)
            owner = np.repeat(np.arange(n), np.diff(ends))
            stop = ends[1:][owner]
            chain, covered = np.zeros(len(name), np.uint64), np.zeros(len(name), np.int64)
            level, alive, at = [], np.arange(len(name)), 0
            while len(alive):
                chain[alive] = mixed(chain[alive] * np.uint64(0x9E3779B97F4A7C15) + name[alive + at])
                covered[alive] += gap[alive + at]
                level.append((alive, chain[alive], covered[alive]))
                at += 1
                alive = alive[(covered[alive] < reach) & (alive + at < stop[alive])]
            which, keys, reached = (np.concatenate(c) for c in zip(*level, strict=True)) if level else (np.zeros(0, np.int64),) * 3
            order = np.argsort(which, kind="stable")
            offsets = pa.array(np.concatenate([[0], np.cumsum(np.bincount(which, minlength=len(name)))]).astype(np.int32))
            yield pa.RecordBatch.from_arrays(
                [batch["sid"].take(pa.array(owner)), pa.array((np.arange(len(name)) - ends[:-1][owner]).astype(np.int32)),
                 pa.array(batch["ranks"].flatten().to_numpy()),
                 pa.ListArray.from_arrays(offsets, pa.array(keys[order].view(np.int64))),
                 pa.ListArray.from_arrays(offsets, pa.array(reached[order].astype(np.int32)))],
                ["sid", "i", "rank", "pre", "bytes"])
        trim()
    return run


def few_names(batches: Iterator[pa.RecordBatch], most: int = 1 << 15) -> Iterator[pa.RecordBatch]:
    """The batches cut into slices of about ``most`` phrases, as each has several
    prefixes (a longer segment is a slice of its own)."""
    for batch in batches:
        ends, at = batch["gap"].offsets.to_numpy(), 0
        while at < len(batch):
            to = max(at + 1, int(np.searchsorted(ends, ends[at] + most, "right")) - 1)
            yield batch.slice(at, to - at)
            at = to


def _adjacent(k: int):
    """Compares the prefixes of adjacent suffixes in sorted partitions: per
    suffix the bytes that it shares with a neighbour.  The last suffix of a batch
    waits for the first of the next."""
    def covers(rows: pa.RecordBatch, most: np.ndarray) -> pa.RecordBatch:
        ends = rows["bytes"].offsets.to_numpy().astype(np.int64)
        reached = rows["bytes"].values.to_numpy()
        cover = np.where(most > 0, reached[ends[:-1] + np.maximum(most, 1) - 1] + k, 0)
        return pa.RecordBatch.from_arrays([rows["sid"], rows["i"], pa.array(cover.astype(np.int32))], ["sid", "i", "cover"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, before = None, 0
        for batch in batches:
            if not len(batch):
                continue
            rows = pa.concat_batches([held, batch]) if held is not None else batch
            ends = rows["pre"].offsets.to_numpy().astype(np.int64)
            keys = rows["pre"].values.to_numpy()
            size, n = np.diff(ends), len(rows)
            shared = np.zeros(n - 1, np.int64)  # phrases shared with the next suffix
            alive, d = np.arange(n - 1), 0
            while len(alive):
                alive = alive[(size[alive] > d) & (size[alive + 1] > d)]
                alive = alive[keys[ends[alive] + d] == keys[ends[alive + 1] + d]]
                shared[alive] += 1
                d += 1
            if n > 1:
                yield covers(rows.slice(0, n - 1), np.maximum(shared, np.append(before, shared[:-1])))
                before = int(shared[-1])
            held = pa.RecordBatch.from_pylist(rows.slice(n - 1).to_pylist(), schema=rows.schema)  # holds no batch
        if held is not None:
            yield covers(held, np.array([before]))
        trim()
    return run


def _marks(k: int):
    """The marks of each place of a segment, its last anchor included: the
    bytes repeated from there on, and whether its closed windows are sent.
    Closed windows start at or after the segment's first anchor and end with
    its last gram, so they are the same in all its places, and one sends them."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for at, gap, cover, n, head in zip(batch["at"].to_numpy(), batch["gap"], batch["covers"], batch["n"].to_numpy(),
                                               batch["head"].to_pylist(), strict=True):
                g = gap.values.to_numpy().astype(np.int64) if len(gap.values) else np.zeros(0, np.int64)
                place = np.append(0, np.cumsum(g))
                c = np.append(cover.values.to_numpy(), 0) if len(g) else np.zeros(1, np.int64)
                if n > 1:
                    c = np.maximum(c, place[-1] - place + k)
                out.append((at + place, c, np.full(len(c), head)))
            size = np.array([len(x) for x, _, _ in out])
            offsets = pa.array(np.append(0, np.cumsum(size)).astype(np.int32))
            at, cover, lead = (np.concatenate([o[i] for o in out]) if out else np.zeros(0) for i in range(3))
            marks = pa.StructArray.from_arrays([pa.array(at.astype(np.int32)), pa.array(cover.astype(np.int32)), pa.array(lead.astype(bool))],
                                               ["at", "cover", "lead"])
            yield pa.RecordBatch.from_arrays([batch["_ord"], batch["_salt"], pa.ListArray.from_arrays(offsets, marks)],
                                             ["_ord", "_salt", "marks"])
    return run


def _closed_and_leads(raw: np.ndarray, ends: np.ndarray, marks: pa.Array, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """From the marks of a batch: the places of anchors and whose they are,
    whether they are leads, and which window starts are closed."""
    count = np.diff(marks.offsets.to_numpy())
    flat = marks.flatten()
    owner = np.repeat(np.arange(len(count)), count)
    at, cover, lead = (flat.field(f).to_numpy(zero_copy_only=False) for f in ("at", "cover", "lead"))
    at = at + ends[owner]
    closed = np.zeros(len(raw) + 1, np.int32)
    long = cover >= length
    np.add.at(closed, at[long], 1)
    np.add.at(closed, (at + cover - length + 1)[long], -1)
    return at, owner, lead, np.cumsum(closed)[:-1] > 0


def _bucket(ahead: np.ndarray, length: int, k: int) -> np.ndarray:
    """The bucket of windows whose anchor is ``ahead`` bytes after their start."""
    return np.minimum(ahead // ((length - k) // BUCKETS or 1), BUCKETS - 1)


def _long_grams(parts: int, length: int, k: int):
    """Map side of the join on long grams: all windows of one bucket of an anchor
    have the bytes in common that begin before the anchor where the last of
    them does and end where the first does.  Entries tell the bucket, whether it has
    an open window (asks) and whether they were answered in their task already."""
    step = (length - k) // BUCKETS or 1

    def send(h: np.ndarray, ords: np.ndarray, salts: np.ndarray, at: np.ndarray, flags: np.ndarray) -> Iterator[pa.RecordBatch]:
        order = np.argsort(h, kind="stable")
        h, ords, salts, at, flags = (a[order] for a in (h, ords, salts, at, flags))
        asks = (flags & ASKS) > 0
        group = np.cumsum(np.append(True, h[1:] != h[:-1])) - 1
        told = (np.bincount(group) > 1)[group] & (np.bincount(group, asks) > 0)[group]
        yield from answers(parts, ords[told], salts[told], at[told], flags[told] & WHICH, kind=1)
        head = told & np.append(True, h[1:] != h[:-1])
        sent = ~told | head
        where = [np.where(told, 0, a)[sent] for a in (ords, salts, at)]
        flags = np.where(told, ASKS | TOLD, flags).astype(np.int8)[sent]
        yield from packed_rows(parts, h[sent], [h[sent], where[0], where[1], where[2].astype(np.int32), flags])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = Held(send, 400_000)
        for batch in slices(batches, "text"):
            raw, ends = text_bytes(batch["text"])
            at, owner, lead, closed = _closed_and_leads(raw, ends, batch["marks"], length)
            up, down = _power_table(len(raw) + 1)
            sums = np.zeros(len(raw) + 1, np.uint64)
            np.cumsum((raw.astype(np.uint64) + np.uint64(1)) * up[:len(raw)], out=sums[1:])
            shut = np.append(0, np.cumsum(closed))
            ids = [batch[c].to_numpy() for c in ("_ord", "_salt")]
            for m in range(BUCKETS):
                most = length - k if m == BUCKETS - 1 else (m + 1) * step - 1
                first, last = at - most, at - m * step  # starts of the bucket's windows
                a, b = last, first + length
                inside = (a >= ends[owner]) & (b <= ends[owner + 1])
                first = np.maximum(first, ends[owner])
                asks = shut[np.where(inside, last, 0) + 1] - shut[np.where(inside, first, 0)] < last - first + 1
                use = inside & (asks | lead)
                h = mixed((sums[b[use]] - sums[a[use]]) * down[a[use]] + np.uint64(m + 1))
                yield from held.add(h, ids[0][owner[use]], ids[1][owner[use]], (at[use] - ends[owner[use]]).astype(np.int32),
                                    (m | np.where(asks[use], ASKS, 0)).astype(np.int8))
        yield from held.flush()
    return run


def _shared_buckets(part: int, blocks: dict[int, list[bytes]]) -> Iterator[pa.RecordBatch]:
    """Reduce side: buckets whose long gram occurs again, if some of them ask."""
    yield from passed_on(part, blocks.get(1, []))
    h, ords, salts, at, flags = unpacked(blocks.get(0, []), ENTRY)
    _, group = np.unique(h, return_inverse=True)
    asks = np.bincount(group, (flags & ASKS) > 0) > 0
    keep = (np.bincount(group) > 1)[group] & asks[group] & ((flags & TOLD) == 0) if len(h) else np.zeros(0, bool)
    yield from answers(_shared_buckets.parts, ords[keep], salts[keep], at[keep], flags[keep] & WHICH)


def _open_windows(parts: int, length: int, k: int):
    """Map side of the comparison of open windows."""
    def send(h: np.ndarray, ords: np.ndarray, salts: np.ndarray, at: np.ndarray, asks: np.ndarray) -> Iterator[pa.RecordBatch]:
        order = np.lexsort((~asks, h))
        h, ords, salts, at, asks = (a[order] for a in (h, ords, salts, at, asks))
        same = np.zeros(len(h) + 1, bool)
        same[1:-1] = h[1:] == h[:-1]
        known, head = same[:-1] | same[1:], ~same[:-1]
        told = known & asks
        yield from answers(parts, ords[told], salts[told], at[told], kind=1)
        sent, asks = ~known | head, asks & ~known
        where = [np.where(asks, a, 0)[sent] for a in (ords, salts, at)]
        yield from packed_rows(parts, h[sent], [h[sent], where[0], where[1], where[2].astype(np.int32), asks[sent].astype(np.int8)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = Held(send, 400_000)
        for batch in slices(batches, "text"):
            raw, ends = text_bytes(batch["text"])
            at, _, lead, closed = _closed_and_leads(raw, ends, batch["marks"], length)
            leads = np.zeros(len(raw), bool)
            leads[at] = lead
            # the buckets of anchors that are compared
            wanted = np.sort(np.concatenate([
                (begin + np.frombuffer(places, np.int32)) * BUCKETS + np.frombuffer(which, np.int8)
                for begin, places, which in zip(ends[:-1], batch["places"].to_pylist(), batch["buckets"].to_pylist(), strict=True)]))
            ids = [batch[c].to_numpy() for c in ("_ord", "_salt")]
            for begin, anchor, owner in anchored(raw, ends, length, k):
                if not len(begin):
                    continue
                asks = ~closed[begin]
                key = anchor * BUCKETS + _bucket(anchor - begin, length, k)
                sent = (wanted[np.minimum(np.searchsorted(wanted, key), len(wanted) - 1)] == key) & (asks | leads[anchor])
                begin, owner, asks = begin[sent], owner[sent], asks[sent]
                lo = int(begin[0]) if len(begin) else 0
                hashes = _spans(raw[lo:(int(begin[-1]) if len(begin) else -1) + length], length)
                yield from held.add(hashes[begin - lo], ids[0][owner], ids[1][owner], (begin - ends[owner]).astype(np.int32), asks)
        yield from held.flush()
    return run


def _repeated_windows(part: int, blocks: dict[int, list[bytes]]) -> Iterator[pa.RecordBatch]:
    yield from passed_on(part, blocks.get(1, []))
    h, ords, salts, at, asks = unpacked(blocks.get(0, []), ENTRY)
    order = np.argsort(h, kind="stable")
    same = np.zeros(len(h) + 1, bool)
    same[1:-1] = h[order][1:] == h[order][:-1]
    told = order[(same[:-1] | same[1:]) & (asks[order] > 0)]
    yield from answers(_repeated_windows.parts, ords[told], salts[told], at[told])


def _with_parts(reduce, parts: int):
    """The reducer with the number of parts that its answers are dealt to."""
    def run(part: int, blocks: dict[int, list[bytes]]) -> Iterator[pa.RecordBatch]:
        reduce.parts = parts
        yield from reduce(part, blocks)
    return run


def repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = LENGTH, k: int = GRAM,
            depth: int = DEPTH) -> DataFrame:
    """doc_id, text, ``marks`` (array of at, cover, lead: ``cover`` bytes from
    byte ``at`` on are repeated elsewhere if they are ``length`` or more) and ``at``
    (binary int32: more first bytes of repeated windows); both null if none."""
    if not 8 <= k <= length < 30_000:
        raise ValueError("k: from 8 to length")
    begin = written()
    rows = keyed(docs, id_col, text_col)
    parts = parts_of(docs)
    shared = reduced(rows.mapInArrow(_phrases(parts, length, k), PACKED), _with_parts(_shared_phrases, parts), PACKED)
    places = stored(reduced(shared, _segments, "segment long, _ord long, _salt long, at int, size int, gap array<int>, name array<long>"),
                    "segment-places")
    head = F.min(F.struct("_ord", "_salt", "at"))
    distinct = stored(places.groupBy("segment").agg(F.first("gap").alias("gap"), F.first("name").alias("name"), F.count("*").alias("n"),
                                                    head.alias("head"))
                      .withColumn("sid", F.monotonically_increasing_id()), "segments")
    order = suffix_order(distinct.filter(F.size("name") > 0), depth=depth, name="name")
    ranks = order.groupBy("sid").agg(F.transform(F.sort_array(F.collect_list(F.struct("i", "rank"))), lambda x: x["rank"]).alias("ranks"))
    reach = 2 * length - k + 1  # a window's anchor lies at most length - k bytes after its start
    suffixes = (distinct.select("sid", "gap", "name").join(ranks, "sid")
                .mapInArrow(_prefixes(reach), "sid long, i int, rank long, pre array<long>, bytes array<int>"))
    # the partitions of the order (upper bits of its ranks) as they are: a new range exchange would make
    # all prefixes once more, to sample them
    n = partitions(docs.sparkSession)
    compared = (suffixes.repartition(n, F.shiftright("rank", 33)).sortWithinPartitions("rank")
                .mapInArrow(_adjacent(k), "sid long, i int, cover int"))
    covers = compared.groupBy("sid").agg(F.transform(F.sort_array(F.collect_list(F.struct("i", "cover"))), lambda x: x["cover"]).alias("covers"))
    known = stored(distinct.select("sid", "segment", "n", "head").join(covers, "sid", "left").drop("sid"), "segment-covers")
    marked = (places.select("segment", "_ord", "_salt", "at", "gap").join(known, "segment")
              .withColumn("head", F.struct("_ord", "_salt", "at") == F.col("head"))
              .select("_ord", "_salt", "at", "gap", F.coalesce("covers", F.array().cast("array<int>")).alias("covers"), "n", "head")
              .mapInArrow(_marks(k), "_ord long, _salt long, marks array<struct<at: int, cover: int, lead: boolean>>"))
    marks = stored(marked.groupBy("_ord", "_salt").agg(F.flatten(F.collect_list("marks")).alias("marks")), "marks")
    release_since(begin, distinct, order, marks)
    asked = with_answers(rows, marks, only=True).mapInArrow(_long_grams(parts, length, k), PACKED)
    kept = by_document(reduced(asked, _with_parts(_shared_buckets, parts), PACKED))
    kept = stored(kept.select("_ord", "_salt", F.col("at").alias("places"), F.col("flags").alias("buckets")), "buckets")
    opened = with_answers(rows, marks.join(kept, ["_ord", "_salt"]), only=True).mapInArrow(_open_windows(parts, length, k), PACKED)
    more = stored(by_document(reduced(opened, _with_parts(_repeated_windows, parts), PACKED)).drop("flags"), "windows")
    covered = marks.filter(F.exists("marks", lambda m: m["cover"] >= length))
    return with_answers(rows, covered.join(more, ["_ord", "_salt"], "full"), only=False)


def _covered(marks, at: bytes | None, length: int) -> tuple[np.ndarray, np.ndarray]:
    """Maximal repeated runs [start, stop) of one text."""
    starts = [np.frombuffer(at, np.int32)] if at else []
    stops = [s + length for s in starts]
    if marks is not None:
        a, c = marks.field("at").to_numpy(), marks.field("cover").to_numpy()
        starts.append(a[c >= length])
        stops.append((a + c)[c >= length])
    if not starts:
        return np.zeros(0, np.int32), np.zeros(0, np.int32)
    starts, stops = np.concatenate(starts), np.concatenate(stops)
    order = np.argsort(starts, kind="stable")
    starts, stops = starts[order], np.maximum.accumulate(stops[order]) if len(stops) else stops
    new = np.append(True, starts[1:] > stops[:-1])[:len(starts)]
    first = np.flatnonzero(new)
    return starts[first], stops[np.append(first[1:], len(stops)) - 1] if len(first) else stops


def deduplicated(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = LENGTH, k: int = GRAM,
                 depth: int = DEPTH, with_bytes: bool = False) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256, spans (array<int>: start
    and end byte of each maximal run), and on request ``kept``, the bytes left."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            out: list[tuple] = []
            marks = batch["marks"]
            flat, offsets = marks.values, marks.offsets.to_numpy()
            for i, text in enumerate(batch["text"].cast(pa.binary())):
                raw = text.as_py() or b""
                own = flat.slice(offsets[i], offsets[i + 1] - offsets[i]) if marks[i].is_valid else None
                starts, stops = _covered(own, batch["at"][i].as_py(), length)
                left, at = [], 0
                for a, b in zip(starts.tolist(), stops.tolist(), strict=True):
                    left.append(raw[at:a])
                    at = b
                left = b"".join([*left, raw[at:]])
                out.append((len(raw), len(raw) - len(left), len(starts), hashlib.sha256(left).hexdigest(),
                            np.stack([starts, stops], 1).ravel().astype(np.int32), left if with_bytes else None))
            n, removed, spans, sha, ends, left = zip(*out, strict=True)
            yield pa.RecordBatch.from_arrays(
                [batch["doc_id"], pa.array(n, pa.int64()), pa.array(removed, pa.int64()), pa.array(spans, pa.int64()),
                 pa.array(sha), pa.array(ends, pa.list_(pa.int32())), *[pa.array(left, pa.binary())] * with_bytes], names)

    names = ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "spans", *["kept"] * with_bytes]
    return (repeats(docs, id_col, text_col, length, k, depth).select("doc_id", "text", "marks", "at")
            .mapInArrow(run, "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, spans array<int>"
                             + ", kept binary" * with_bytes))
