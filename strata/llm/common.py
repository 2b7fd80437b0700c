"""Helpers shared by the training-data operators: scratch tables in the shared
folder, fixed-size membership bitmaps, and text access in Arrow batches."""

from __future__ import annotations

import atexit
from collections.abc import Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.session import scratch_path

#: ASCII white space that separates words: space and 0x09-0x0D.
WORD = r"[^\x20\x09-\x0D]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

_SPACE = np.zeros(256, dtype=bool)
_SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True

_written: list[tuple[SparkSession, str]] = []


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{table}.parquet")


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once as Parquet under the shared checkpoint folder and
    read back, so later stages neither recompute it nor depend on executors
    that may be lost.  The folder is removed when the application ends."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    if not _written:
        atexit.register(_clean)
    _written.append((spark, path))
    with _shuffle_files_removed(spark):
        df.write.option("compression", "zstd").parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out._stored_in = path
    return out


@contextmanager
def _shuffle_files_removed(spark: SparkSession) -> Iterator[None]:
    """Shuffle files of what runs here are removed when it ends: the table that
    was written replaces them, so they would only fill the executors' disks."""
    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(key, None)
    spark.conf.set(key, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(key)
        else:
            spark.conf.set(key, before)


def written() -> int:
    """How many tables ``stored`` has written so far."""
    return len(_written)


def release(tables: list[tuple[SparkSession, str]]) -> None:
    """Removes stored tables that nothing reads any more."""
    for spark, path in tables:
        try:
            jvm = spark._jvm
            where = jvm.org.apache.hadoop.fs.Path(path)
            where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)
        except Exception:  # the session is gone: nothing left to ask
            return


def tables_since(count: int) -> list[tuple[SparkSession, str]]:
    return _written[count:]


def release_since(count: int, *keep: DataFrame) -> None:
    """Removes the tables that ``stored`` has written since it had written
    ``count``, but for those of ``keep`` (as ``stored`` returned them)."""
    kept = {df._stored_in for df in keep}
    release([t for t in _written[count:] if t[1] not in kept])


def _clean() -> None:
    release(_written)


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


# --- membership bitmaps -----------------------------------------------------

#: Bits of one bitmap page (``bitmap_construct_agg`` makes pages of 32768 bits).
PAGE = 32768


def member_pages(keys: DataFrame, key: str, bits: int = 1 << 23) -> DataFrame:
    """A bitmap of ``bits`` bits over the hashes of ``keys[key]``: at most
    ``bits / 32768`` rows of 4 KB (1 MB for the default), whatever the number
    of keys, so the result may be broadcast."""
    slot = F.pmod(F.xxhash64(key), F.lit(bits)) + 1
    return (keys.select(slot.alias("_slot"))
            .groupBy(F.bitmap_bucket_number("_slot").alias("_page"))
            .agg(F.bitmap_construct_agg(F.bitmap_bit_position("_slot")).alias("_bitmap")))


def with_member_flag(df: DataFrame, key: str, pages: DataFrame, out: str,
                     bits: int = 1 << 23) -> DataFrame:
    """Adds ``out``: false means that ``key`` is surely not among the keys of
    ``pages``; true means that it may be."""
    slot = F.pmod(F.xxhash64(key), F.lit(bits)) + 1
    bit = F.bitmap_bit_position(slot)
    byte = F.conv(F.hex(F.substring(F.col("_bitmap"), (bit / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    flag = F.coalesce((F.shiftright(byte, 0).bitwiseAND(F.element_at(
        F.array(*[F.lit(1 << i) for i in range(8)]), (bit % 8).cast("int") + 1))) > 0, F.lit(False))
    return (df.withColumn("_page", F.bitmap_bucket_number(slot))
            .join(F.broadcast(pages), "_page", "left")
            .withColumn(out, flag).drop("_page", "_bitmap"))


# --- text in Arrow batches --------------------------------------------------

def slices(batches: Iterator[pa.RecordBatch], column: str,
           limit: int = 1_000_000) -> Iterator[pa.RecordBatch]:
    """The batches cut into slices of about ``limit`` bytes of ``column`` (a
    longer text is a slice of its own), to bound the memory of array work."""
    for batch in batches:
        col = batch.column(column)
        if not len(col):
            continue
        ends = np.frombuffer(col.buffers()[1], np.int32 if pa.types.is_string(col.type) or pa.types.is_binary(col.type)
                             else np.int64)[col.offset:col.offset + len(col) + 1].astype(np.int64)
        at = 0
        while at < len(col):
            to = max(at + 1, int(np.searchsorted(ends, ends[at] + limit, "right")) - 1)
            yield batch.slice(at, to - at)
            at = to


def text_bytes(col: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The column's UTF-8 bytes and each text's bounds in them; null is empty."""
    wide = pa.types.is_large_string(col.type) or pa.types.is_large_binary(col.type)
    ends = np.frombuffer(col.buffers()[1], np.int64 if wide else np.int32)[col.offset:col.offset + len(col) + 1].astype(np.int64)
    if col.null_count:
        col = col.fill_null("" if pa.types.is_string(col.type) or pa.types.is_large_string(col.type) else b"")
        return text_bytes(col)
    data = col.buffers()[2]
    raw = np.frombuffer(data, np.uint8)[ends[0]:ends[-1]] if data is not None else np.zeros(0, np.uint8)
    return raw, ends - ends[0]


def words_of(raw: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends (bytes) of the words of all texts, and the index of each
    text's first word (one more entry than texts)."""
    black = np.ones(len(raw) + 2, bool)
    black[0] = black[-1] = False
    black[1:-1] = ~_SPACE[raw]
    first = black[1:-1] & ~black[:-2]
    last = black[1:-1] & ~black[2:]
    inner = ends[1:-1]
    inner = inner[(inner > 0) & (inner < len(raw))]
    first[inner] = black[1:-1][inner]
    last[inner - 1] = black[1:-1][inner - 1]
    starts = np.flatnonzero(first)
    return starts, np.flatnonzero(last) + 1, np.searchsorted(starts, ends)


def mixed(h: np.ndarray) -> np.ndarray:
    """The 64-bit finaliser of MurmurHash3 (public domain), on arrays."""
    h = h ^ (h >> np.uint64(33))
    h = h * np.uint64(0xFF51AFD7ED558CCD)
    h ^= h >> np.uint64(33)
    h *= np.uint64(0xC4CEB9FE1A85EC53)
    h ^= h >> np.uint64(33)
    return h


_BASE = 0x9E3779B97F4A7C15
_powers: dict[str, np.ndarray] = {}


def _power_table(n: int) -> tuple[np.ndarray, np.ndarray]:
    if len(_powers.get("up", ())) < n:
        size = max(n, 1 << 16)
        for name, base in (("up", _BASE), ("down", pow(_BASE, -1, 1 << 64))):
            table = np.empty(size, np.uint64)
            table[0] = 1
            np.cumprod(np.full(size - 1, base, np.uint64), out=table[1:])
            _powers[name] = table
    return _powers["up"], _powers["down"]


def word_hashes(raw: np.ndarray, starts: np.ndarray, stops: np.ndarray,
                block: int = 1 << 19) -> np.ndarray:
    """64-bit hash of each word ``raw[start:stop]``, from running polynomial
    sums over blocks of whole words."""
    out = np.empty(len(starts), np.uint64)
    at = 0
    while at < len(starts):
        to = max(at + 1, int(np.searchsorted(stops, starts[at] + block, "right")))
        lo, hi = int(starts[at]), int(stops[to - 1])
        up, down = _power_table(hi - lo + 1)
        sums = np.zeros(hi - lo + 1, np.uint64)
        np.cumsum((raw[lo:hi].astype(np.uint64) + np.uint64(1)) * up[:hi - lo], out=sums[1:])
        s, e = starts[at:to] - lo, stops[at:to] - lo
        out[at:to] = mixed((sums[e] - sums[s]) * down[s] + (e - s).astype(np.uint64))
        at = to
    return out


def gram_hashes(words: np.ndarray, n: int) -> np.ndarray:
    """Hash of each run of ``n`` consecutive word hashes."""
    if len(words) < n:
        return np.zeros(0, np.uint64)
    count = len(words) - n + 1
    h = words[:count].copy()
    for i in range(1, n):
        h *= np.uint64(_BASE)
        h += words[i:i + count]
    return mixed(h)


# --- packed exchange --------------------------------------------------------
#
# Many small (hash, document, position) entries move as compressed blocks: a
# map task deals its entries out by hash into ``parts``, Spark shuffles the
# blocks by part, and a task reduces one part at a time with array operations.

#: A packed row: ``part`` is dealt out, ``kind`` is the caller's, ``data`` holds arrays.
PACKED = "part int, kind int, data binary"
PART_BYTES = 2 << 20


def pack(*arrays: np.ndarray) -> bytes:
    """Equal-length integer arrays as one compressed block: the first as
    differences, bytes of equal weight side by side."""
    import zstandard
    n = len(arrays[0])
    body = [np.array([n], np.int64).tobytes()]
    for i, a in enumerate(arrays):
        a = np.diff(a, prepend=a.dtype.type(0)) if i == 0 else np.ascontiguousarray(a)
        body.append(a.view(np.uint8).reshape(n, a.dtype.itemsize).T.tobytes())
    return zstandard.compress(b"".join(body), 1)


def unpack(data: bytes, kinds: list[type]) -> list[np.ndarray]:
    import zstandard
    raw = zstandard.decompress(data)
    n, at, out = int(np.frombuffer(raw, np.int64, 1)[0]), 8, []
    for i, kind in enumerate(kinds):
        size = np.dtype(kind).itemsize
        a = np.frombuffer(raw, np.uint8, n * size, at).reshape(size, n).T.copy().view(kind).reshape(n)
        out.append(np.cumsum(a, dtype=kind) if i == 0 else a)
        at += n * size
    return out


def unpacked(blocks: list[bytes], kinds: list[type]) -> list[np.ndarray]:
    """All blocks' arrays, one after another."""
    each = [unpack(b, kinds) for b in blocks]
    return [np.concatenate([e[i] for e in each]) if each else np.zeros(0, k) for i, k in enumerate(kinds)]


def packed_rows(parts: int, deal: np.ndarray, arrays: list[np.ndarray], kind: int = 0) -> Iterator[pa.RecordBatch]:
    """Rows ``PACKED``: entries dealt out by the high bits of ``deal``, a uniform
    hash, so that parts are even; in a part in the order of the first array."""
    if not len(deal):
        return
    part = ((deal >> np.uint64(32)) * np.uint64(parts) >> np.uint64(32)).astype(np.int32)
    order = np.lexsort((arrays[0], part))
    part, arrays = part[order], [a[order] for a in arrays]
    cuts = np.flatnonzero(np.diff(part, prepend=-1)).tolist()
    ends = [*cuts[1:], len(part)]
    for at in range(0, len(cuts), 64):
        some = list(zip(cuts[at:at + 64], ends[at:at + 64], strict=True))
        yield pa.RecordBatch.from_arrays(
            [pa.array([int(part[a]) for a, _ in some], pa.int32()), pa.array([kind] * len(some), pa.int32()),
             pa.array([pack(*[x[a:b] for x in arrays]) for a, b in some], pa.binary())], ["part", "kind", "data"])


def parts_of(docs: DataFrame) -> int:
    """How many parts the entries of ``docs`` are dealt to: one for each 2 MB of
    (estimated) input up to 4096 parts, then as many as keep them under 64 MB.
    It follows the data, not the cluster, so parts fit in memory and blocks do
    not get smaller when there are more tasks.  Results do not depend on it."""
    size = int(str(docs._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    return max(16, min(size // PART_BYTES, 4096), size // (32 * PART_BYTES))


def reduced(packed: DataFrame, reduce, schema: str) -> DataFrame:
    """Brings the rows of each part together and reduces them:
    ``reduce(part, blocks)`` gets the part's blocks by kind and yields record
    batches.  Rows come sorted by part, so a task holds one part at a time."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at: int | None = None
        held: dict[int, list[bytes]] = {}
        for batch in batches:
            for part, kind, data in zip(*[batch.column(c).to_pylist() for c in ("part", "kind", "data")], strict=True):
                if part != at and held:
                    yield from reduce(at, held)
                    held = {}
                at = part
                held.setdefault(kind, []).append(data)
        if held:
            yield from reduce(at, held)
        trim()

    parts = packed.repartition(partitions(packed.sparkSession), "part").sortWithinPartitions("part")
    return parts.mapInArrow(run, schema)


#: A document is known by its id and, where ids repeat, a hash of its text.
NO_ID = np.int64((1 << 63) - 1)


def keyed(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """doc_id, text, ``_ord`` (the id; null is the largest) and ``_salt`` (0, or
    a hash of the text where the id may not be unique)."""
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    rows = rows.withColumn("_ord", F.coalesce("doc_id", F.lit(int(NO_ID))))
    twice = rows.groupBy("_ord").count().filter("count > 1").select("_ord")
    if twice.isEmpty():
        return rows.withColumn("_salt", F.lit(0).cast("long"))
    rows = with_member_flag(rows, "_ord", member_pages(twice, "_ord"), "_twice")
    return rows.withColumn("_salt", F.when(F.col("_twice"), F.xxhash64("text")).otherwise(0)).drop("_twice")


#: Entries of one document: id, salt, position (and a flag of the caller's).
ANSWER = [np.int64, np.int64, np.int32, np.int8]


def answers(parts: int, ords: np.ndarray, salts: np.ndarray, at: np.ndarray, flags: np.ndarray | None = None,
            kind: int = 0) -> Iterator[pa.RecordBatch]:
    """Packed rows that take entries back to their documents."""
    flags = np.zeros(len(ords), np.int8) if flags is None else flags.astype(np.int8)
    yield from packed_rows(parts, mixed(ords.view(np.uint64)), [ords, salts, at.astype(np.int32), flags], kind)


def by_document(packed: DataFrame) -> DataFrame:
    """_ord, _salt, at (binary int32, ascending, distinct), flags (binary int8)
    from the rows of ``answers``: one row per document."""
    def run(part: int, blocks: dict[int, list[bytes]]) -> Iterator[pa.RecordBatch]:
        ords, salts, at, flags = unpacked([b for bs in blocks.values() for b in bs], ANSWER)
        order = np.lexsort((flags, at, salts, ords))
        ords, salts, at, flags = ords[order], salts[order], at[order], flags[order]
        new = np.ones(len(ords), bool)
        new[1:] = (ords[1:] != ords[:-1]) | (salts[1:] != salts[:-1])
        more = new.copy()
        more[1:] |= (at[1:] != at[:-1]) | (flags[1:] != flags[:-1])
        ords, salts, at, flags, new = ords[more], salts[more], at[more], flags[more], new[more]
        cuts = np.flatnonzero(new).tolist()
        yield pa.RecordBatch.from_arrays(
            [pa.array(ords[new]), pa.array(salts[new]),
             pa.array([at[a:b].tobytes() for a, b in zip(cuts, [*cuts[1:], len(at)], strict=True)], pa.binary()),
             pa.array([flags[a:b].tobytes() for a, b in zip(cuts, [*cuts[1:], len(at)], strict=True)], pa.binary())],
            ["_ord", "_salt", "at", "flags"])

    return reduced(packed, run, "_ord long, _salt long, at binary, flags binary")


def with_answers(rows: DataFrame, found: DataFrame, only: bool, bits: int = 1 << 23) -> DataFrame:
    """``keyed`` rows with their answers (``only``: the rows that have some).
    Texts without an answer are not moved: a bitmap of fixed size over the
    answered ids holds them back."""
    flagged = with_member_flag(rows, "_ord", member_pages(found, "_ord", bits), "_maybe", bits)
    moved = flagged.filter("_maybe").drop("_maybe").join(found, ["_ord", "_salt"], "inner" if only else "left")
    if only:
        return moved
    still = flagged.filter("NOT _maybe").drop("_maybe").select(
        "*", *[F.lit(None).cast(f.dataType).alias(f.name) for f in found.schema.fields if f.name not in ("_ord", "_salt")])
    return moved.unionByName(still)


def passed_on(part: int, blocks: list[bytes], kind: int = 0) -> Iterator[pa.RecordBatch]:
    """Blocks that were dealt by document already, as they are."""
    for data in blocks:
        yield pa.RecordBatch.from_arrays([pa.array([part], pa.int32()), pa.array([kind], pa.int32()),
                                          pa.array([data], pa.binary())], ["part", "kind", "data"])


class Held:
    """Entries of a map task, handed to ``send`` when many or at the end."""

    def __init__(self, send, limit: int = 800_000):
        self.send, self.limit, self.rows, self.size = send, limit, [], 0

    def add(self, *arrays: np.ndarray) -> Iterator[pa.RecordBatch]:
        self.rows.append(arrays)
        self.size += len(arrays[0])
        if self.size >= self.limit:
            yield from self.flush()

    def flush(self) -> Iterator[pa.RecordBatch]:
        if self.size:
            arrays = [np.concatenate(a) for a in zip(*self.rows, strict=True)]
            self.rows, self.size = [], 0
            yield from self.send(*arrays)
            del arrays
            trim()


def trim() -> None:
    """Gives freed memory back to the system: Python workers live as long as
    their executor, and each stage would otherwise keep the peak of the last."""
    import ctypes
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (OSError, AttributeError):  # not glibc
        pass


def runs(at: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """Maximal runs [start, stop) covered by windows of ``length`` at ``at`` (ascending)."""
    if not len(at):
        return at, at
    gap = np.flatnonzero(at[1:] > at[:-1] + length)
    return at[np.append(0, gap + 1)], at[np.append(gap, len(at) - 1)] + length


# --- rows by key ------------------------------------------------------------

KEY = "__row_key"


def row_key(id_col: str, text_col: str) -> Column:
    """A 128-bit hash of id and text (nulls apart from all values), the same in
    every scan: rows with equal keys are equal in both."""
    def told(c: str) -> Column:
        return F.coalesce(F.concat(F.lit("="), F.col(c).cast("string")), F.lit(""))
    return F.unhex(F.md5(F.concat(told(id_col), F.lit("\x00"), told(text_col))))


def with_key(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with their ``row_key``."""
    return docs.withColumn(KEY, row_key(id_col, text_col))


def without_keys(docs: DataFrame, keys: DataFrame, bits: int = 1 << 23) -> DataFrame:
    """``docs`` (with ``KEY``) without the rows whose key is among ``keys``.  Rows
    whose key is surely not are not moved."""
    pages = member_pages(keys, KEY, bits)
    flagged = with_member_flag(docs, KEY, pages, "__maybe", bits)
    left = flagged.filter("__maybe").join(keys.select(KEY).distinct(), KEY, "left_anti")
    return left.select(*docs.columns).unionByName(flagged.filter("NOT __maybe").select(*docs.columns))
