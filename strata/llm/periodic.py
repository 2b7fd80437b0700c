"""Operator 12, periodic run detection by Baier's grouping.

A run is a stretch of consecutive words that repeats with a smallest period q,
is as long as asked for, and cannot be extended by a neighbouring word.

1. Words of which no run can consist are left out: a run of ``least`` words and
   ``times`` periods repeats, q words apart, at least ``gram`` words from each
   place but its last, so every window of ``gram`` words in it starts twice in
   its document.  Stretches of words in such windows are searched; a run and
   the words beside it that would extend it lie in one stretch.
2. Phase one of Baier's suffix sorter is run on a stretch under the order of its
   words and under the reverse order: it groups the suffixes by their longest
   Lyndon prefix, whose length is the Lyndon array (``lyndon_lengths``).
3. Every run has a Lyndon root that is the longest Lyndon word at its place in
   one of the two orders.  Roots are extended both ways by longest common
   extensions: by binary search on running hashes, then compared word by word.

Documents are independent, so Spark deals them out and nothing is shuffled.  The
words of one text and the state of its stretches are held by one task.

Results for odd input: a null text or one without words has no runs; texts of
any length are searched whole; a null id is left null; repeated rows and ids are
handled row by row; extra columns are left alone; an empty table gives an empty
result.  Ties between longest runs go to the smallest start, then period.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.llm.common import WORD, gram_hashes, mixed, slices, text_bytes, word_hashes, words_of

LEAST, TIMES = 6, 4
_BASE = np.uint64(0x9E3779B97F4A7C15)


def lyndon_lengths(symbols: list[int]) -> list[int]:
    """For each place the length of the longest Lyndon word that starts there.

    Groups of places, in the order of the strings that they are known to begin
    with, are taken from the greatest down.  A place of the group is appended to
    the nearest place before it that belongs to a smaller group: that place then
    begins with its string and as many copies of the group's string as point to
    it, and moves into a new group right above its old one.  When a group is
    taken its string is final, and is the longest Lyndon word of its places."""
    n = len(symbols)
    kinds = sorted(set(symbols))
    group_of = {s: g for g, s in enumerate(kinds)}
    group = [group_of[s] for s in symbols]
    members: list[list[int]] = [[] for _ in kinds]
    for i, g in enumerate(group):
        members[g].append(i)
    size = [1] * len(kinds)
    below = list(range(-1, len(kinds) - 1))
    above = [*range(1, len(kinds)), -1]
    out, before, taken = [0] * n, list(range(-1, n - 1)), bytearray(n)
    at = len(kinds) - 1
    while at >= 0:
        places = [i for i in members[at] if group[i] == at]
        members[at] = []
        width = size[at]
        for i in places:
            taken[i] = 1
            out[i] = width
        count: dict[int, int] = {}
        for i in places:
            j = before[i]
            while j >= 0 and taken[j]:
                j = before[j]
            k = before[i]  # all places on the way point to j from now on
            before[i] = j
            while k != j:
                before[k], k = j, before[k]
            if j >= 0:
                count[j] = count.get(j, 0) + 1
        moved: dict[tuple[int, int], list[int]] = {}
        for j, times in count.items():
            moved.setdefault((group[j], times), []).append(j)
        for old, times in sorted(moved, key=lambda m: -m[1]):  # the most copies stand highest
            new = len(size)
            members.append(moved[old, times])
            for j in members[new]:
                group[j] = new
            size.append(size[old] + times * width)
            below.append(old)
            above.append(above[old])
            if above[old] >= 0:
                below[above[old]] = new
            above[old] = new
        at = below[at]
    return out


def _extensions(x: np.ndarray, a: np.ndarray, b: np.ndarray, right: bool) -> np.ndarray:
    """How many symbols agree from a and b on (``right``), or before them; never
    too few, too many only if hashes collide."""
    n = len(x)
    power = np.ones(n + 1, np.uint64)
    np.cumprod(np.full(n, _BASE, np.uint64), out=power[1:])
    sums = np.zeros(n + 1, np.uint64)
    np.cumsum(mixed(x.astype(np.uint64) + np.uint64(1)) * power[:n], out=sums[1:])
    lo, hi = np.zeros(len(a), np.int64), (n - b if right else a).astype(np.int64)
    while (lo < hi).any():
        mid = (lo + hi + 1) // 2
        p, q = (a, b) if right else (a - mid, b - mid)
        same = (sums[p + mid] - sums[p]) * power[q - p] == sums[q + mid] - sums[q]
        lo, hi = np.where(same, mid, lo), np.where(same, hi, np.maximum(mid - 1, lo))
    return lo


def runs_of(x: np.ndarray, least: int = LEAST, times: int = TIMES) -> list[tuple[int, int, int]]:
    """(start, length, period) of the runs of a sequence of integers, in order."""
    found: set[tuple[int, int, int]] = set()
    symbols = np.unique(x, return_inverse=True)[1].astype(np.int64)
    for order in (symbols, symbols.max(initial=0) - symbols):
        at, period = np.arange(len(x)), np.array(lyndon_lengths(order.tolist()), np.int64)
        inside = at + period < len(x)
        at, period = at[inside], period[inside]
        agree = symbols[at] == symbols[at + period]
        at, period = at[agree], period[agree]
        if not len(at):
            continue
        # the first root of a run starts less than a period after it, so two more follow
        after = _extensions(symbols, at, at + period, True)
        long = after >= np.maximum(period * (times - 2), 1)
        at, period, after = at[long], period[long], after[long]
        ahead = _extensions(symbols, at, at + period, False)
        start, stop = at - ahead, at + period + after
        enough = stop - start >= np.maximum(least, times * period)
        found |= set(zip(start[enough].tolist(), stop[enough].tolist(), period[enough].tolist(), strict=True))
    out = set()
    for start, stop, period in found:
        differ = np.flatnonzero(x[start:stop - period] != x[start + period:stop])
        if not len(differ):
            out.add((start, stop - start, period))
            continue
        # hashes collided: the stretches between the places that differ
        edges = [start - 1, *(start + differ).tolist(), stop - period]
        for a, b in zip(edges[:-1], edges[1:], strict=True):
            if b - a - 1 + period >= max(least, times * period):
                out.add((a + 1, b - a - 1 + period, period))
    return sorted(out, key=lambda r: (r[0], r[2]))


def gram_size(least: int, times: int) -> int:
    """Words that a run repeats at least from each place but its last ones."""
    return min(max(least - q, (times - 1) * q) for q in range(1, least + 1))


def stretches(hashes: np.ndarray, first: np.ndarray, gram: int) -> list[tuple[int, int, int]]:
    """(document, first word, last word + 1) of the stretches of words that lie
    in windows of ``gram`` words which their document has twice."""
    grams = gram_hashes(hashes, gram)
    owner = np.repeat(np.arange(len(first) - 1), np.diff(first))
    at = np.flatnonzero(owner[:len(grams)] == owner[gram - 1:]) if len(grams) else np.zeros(0, np.int64)
    keys = mixed(grams[at] ^ mixed(owner[at].astype(np.uint64) + np.uint64(0x5851F42D4C957F2D)))
    order = np.argsort(keys, kind="stable")
    same = np.zeros(len(order) + 1, bool)
    same[1:-1] = keys[order][1:] == keys[order][:-1]
    twice = np.sort(at[order[same[:-1] | same[1:]]])
    if not len(twice):
        return []
    new = np.append(True, (twice[1:] > twice[:-1] + gram) | (owner[twice[1:]] != owner[twice[:-1]]))
    head = np.flatnonzero(new)
    last = twice[np.append(head[1:], len(twice)) - 1] + gram
    return list(zip(owner[twice[head]].tolist(), twice[head].tolist(), last.tolist(), strict=True))


def _document(words: list[bytes], found: list[tuple[int, int, int]]) -> tuple:
    """The columns of one document from its runs."""
    lines = "".join(f"{s},{n},{q}\n" for s, n, q in found).encode()
    best = max(found, key=lambda r: (r[1], -r[0], -r[2]), default=(None, None, None))
    if found:
        edge = np.zeros(len(words) + 1, np.int64)
        for s, n, q in found:
            edge[s + q] += 1
            edge[s + n] -= 1
        words = [words[i] for i in np.flatnonzero(np.cumsum(edge[:-1]) == 0)]
    kept = b" ".join(words)
    return (len(found), *best, 1000 * best[1] // best[2] if found else None, hashlib.sha256(lines).hexdigest(),
            hashlib.sha256(kept).hexdigest(), kept, [x for r in found for x in r])


def periodic_runs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", least: int = LEAST, times: int = TIMES,
                  outputs: bool = False) -> DataFrame:
    """doc_id, n_runs; of the longest run start, length, period, exponent_milli;
    runs_sha256 and collapsed_sha256; with ``outputs`` also ``collapsed`` (the kept
    words) and ``runs`` (array<long>: start, length and period of each run)."""
    if least < 2 or times < 3:
        raise ValueError("least: 2 or more; times: 3 or more")
    gram = gram_size(least, times)
    names = ["doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256", "collapsed", "runs"]
    kinds = [pa.int64()] * 5 + [pa.string(), pa.string(), pa.binary(), pa.list_(pa.int64())]
    keep = len(names) if outputs else len(names) - 2

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            raw, ends = text_bytes(batch["text"])
            starts, stops, first = words_of(raw, ends)
            found: dict[int, list[tuple[int, int, int]]] = {}
            for doc, a, b in stretches(word_hashes(raw, starts, stops), first, gram):
                known: dict[bytes, int] = {}
                x = np.array([known.setdefault(raw[s:e].tobytes(), len(known)) for s, e in zip(starts[a:b], stops[a:b], strict=True)])
                shift = a - int(first[doc])
                found.setdefault(doc, []).extend((s + shift, n, q) for s, n, q in runs_of(x, least, times))
            out = []
            for i, (a, b) in enumerate(zip(ends[:-1].tolist(), ends[1:].tolist(), strict=True)):
                out.append(_document(raw[a:b].tobytes().split(), found.get(i, [])))
            columns = [pa.array(c, k) for c, k in list(zip(zip(*out, strict=True), kinds, strict=True))[:keep - 1]]
            yield pa.RecordBatch.from_arrays([batch["doc_id"], *columns], names[:keep])

    kind = docs.schema[id_col].dataType.simpleString()
    schema = (f"doc_id {kind}, n_runs long, start long, length long, period long, exponent_milli long, runs_sha256 string, "
              "collapsed_sha256 string" + ", collapsed binary, runs array<long>" * outputs)
    texts = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return texts.mapInArrow(run, schema)


def planted(docs: DataFrame) -> DataFrame:
    """doc_id and text, in which of the documents whose h = crc32(doc_id) ends in
    0 each word from a on is word a + (i - a) % p; g = h / 10, a = g % n, p = 1 + (n - a) / (3 + g % 8)."""
    h = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    rows = (docs.select("doc_id", F.col("text").cast("string").alias("text"))
            .withColumn("_w", F.when(h % 10 == 0, F.regexp_extract_all("text", F.lit(f"({WORD})"), F.lit(1))))
            .withColumn("_g", F.floor(h / 10)).withColumn("_n", F.size("_w"))
            .withColumn("_a", F.when(F.col("_n") > 0, F.col("_g") % F.col("_n")))
            .withColumn("_p", 1 + F.floor((F.col("_n") - F.col("_a")) / (3 + F.col("_g") % 8))))
    words = F.transform(F.sequence(F.lit(0).cast("long"), (F.col("_n") - 1).cast("long")),
                        lambda i: F.get("_w", F.when(i < F.col("_a"), i).otherwise(F.col("_a") + (i - F.col("_a")) % F.col("_p")).cast("int")))
    return rows.select("doc_id", F.when(F.col("_n") > 0, F.array_join(words, " ")).otherwise(F.col("text")).alias("text"))
