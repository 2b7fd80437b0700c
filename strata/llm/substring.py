"""Operator 4, substring dedup by seed and extend, on words.

1. Seeds: of the ``k``-word grams of every window of ``min_words`` words the one
   with the smallest hash (the right-most of equal ones) is the window's anchor
   (winnowing), so equal windows have equal anchors.  Anchors are joined by
   hash; those that only one document has can not seed a repeat.
2. Extension: from each anchor that documents share, the match is extended both
   ways to all windows of ``min_words`` words that the anchor stands for; they are
   compared by the hash of the whole window with those of other documents.
3. Maximal repeats: the windows that an earlier document (smaller id) has too
   are joined to maximal runs, whose words are removed.

No pair of documents is ever made: of a window that thousands of documents
share, each task sends one entry, for its smallest id; later documents of the
same task are answered at once.  So a passage that a third of all documents
hold costs one entry per task, not per document.  Windows are judged on the
input.  Equality of windows is by 64-bit hashes.

Results for odd input: a null text has no words; a null id is larger than all
others; repeated rows are judged each, and do not count as earlier documents of
each other; texts are read whole, whatever their length; extra columns are left
alone; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import compress

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from strata.llm.common import (
    PACKED,
    Held,
    answers,
    by_document,
    gram_hashes,
    keyed,
    packed_rows,
    parts_of,
    passed_on,
    reduced,
    runs,
    slices,
    text_bytes,
    unpacked,
    with_answers,
    word_hashes,
    words_of,
)

ENTRY = [np.uint64, np.int64, np.int64, np.int32]  # hash, id, salt, position


def windows(hashes: np.ndarray, first: np.ndarray, min_words: int, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of all windows that lie in one text: first word, anchor's word, text."""
    n = len(hashes) - min_words + 1
    if n <= 0:
        return (np.zeros(0, np.int64),) * 3
    owner = np.repeat(np.arange(len(first) - 1), np.diff(first))
    inside = owner[:n] == owner[min_words - 1:]
    grams = gram_hashes(hashes, k)
    best, at = grams[:n].copy(), np.zeros(n, np.int64)
    for j in range(1, min_words - k + 1):
        less = grams[j:j + n] <= best
        np.copyto(best, grams[j:j + n], where=less)
        at[less] = j
    starts = np.flatnonzero(inside)
    return starts, starts + at[starts], owner[starts]


def _groups(hashes: np.ndarray, ords: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Order by (hash, id), group numbers in it, and each group's smallest id."""
    order = np.lexsort((ords, hashes))
    h = hashes[order]
    new = np.ones(len(h), bool)
    new[1:] = h[1:] != h[:-1]
    return order, np.cumsum(new) - 1, ords[order][new]


def _seeds(parts: int, min_words: int, k: int):
    """Map side of the anchor join."""
    def send(h: np.ndarray, ords: np.ndarray, salts: np.ndarray, at: np.ndarray) -> Iterator[pa.RecordBatch]:
        order, group, least = _groups(h, ords)
        h, ords, salts, at = h[order], ords[order], salts[order], at[order]
        shared = np.zeros(len(least), bool)
        shared[group[ords != least[group]]] = True
        known = shared[group]
        yield from answers(parts, ords[known], salts[known], at[known], kind=1)
        # a shared anchor sends one entry, which asks for no answer
        head = np.ones(len(h), bool)
        head[1:] = group[1:] != group[:-1]
        sent = ~known | head
        yield from packed_rows(parts, h[sent], [h[sent], ords[sent], salts[sent], np.where(known, -1, at)[sent].astype(np.int32)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = Held(send)
        for batch in slices(batches, "text"):
            raw, ends = text_bytes(batch["text"])
            starts, stops, first = words_of(raw, ends)
            hashes = word_hashes(raw, starts, stops)
            _, anchor, owner = windows(hashes, first, min_words, k)
            if not len(anchor):
                continue
            new = np.ones(len(anchor), bool)
            new[1:] = (anchor[1:] != anchor[:-1]) | (owner[1:] != owner[:-1])
            anchor, owner = anchor[new], owner[new]
            ords, salts = (batch[c].to_numpy()[owner] for c in ("_ord", "_salt"))
            yield from held.add(gram_hashes(hashes, k)[anchor], ords, salts, (anchor - first[owner]).astype(np.int32))
        yield from held.flush()
    return run


def _shared_seeds(parts: int):
    """Reduce side: anchors of two or more documents, back to these."""
    def run(part: int, blocks: dict[int, list[bytes]]) -> Iterator[pa.RecordBatch]:
        yield from passed_on(part, blocks.get(1, []))
        h, ords, salts, at = unpacked(blocks.get(0, []), ENTRY)
        order, group, least = _groups(h, ords)
        ords, salts, at = ords[order], salts[order], at[order]
        shared = np.zeros(len(least), bool)
        shared[group[ords != least[group]]] = True
        asked = shared[group] & (at >= 0)
        yield from answers(parts, ords[asked], salts[asked], at[asked])
    return run


def _extensions(parts: int, min_words: int, k: int):
    """Map side of the comparison of windows at shared anchors."""
    def send(h: np.ndarray, ords: np.ndarray, salts: np.ndarray, at: np.ndarray) -> Iterator[pa.RecordBatch]:
        order, group, least = _groups(h, ords)
        h, ords, salts, at = h[order], ords[order], salts[order], at[order]
        later = ords > least[group]
        yield from answers(parts, ords[later], salts[later], at[later], kind=1)
        yield from packed_rows(parts, h[~later], [h[~later], ords[~later], salts[~later], at[~later]])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = Held(send)
        for batch in slices(batches, "text"):
            raw, ends = text_bytes(batch["text"])
            starts, stops, first = words_of(raw, ends)
            hashes = word_hashes(raw, starts, stops)
            begin, anchor, owner = windows(hashes, first, min_words, k)
            if not len(begin):
                continue
            seed = np.zeros(len(hashes), bool)
            for i, at in enumerate(batch["at"].to_pylist()):
                seed[first[i] + np.frombuffer(at, np.int32)] = True
            kept = seed[anchor]
            begin, owner = begin[kept], owner[kept]
            ords, salts = (batch[c].to_numpy()[owner] for c in ("_ord", "_salt"))
            yield from held.add(gram_hashes(hashes, min_words)[begin], ords, salts, (begin - first[owner]).astype(np.int32))
        yield from held.flush()
    return run


def _later_windows(parts: int):
    """Reduce side: windows that a document with a smaller id has too."""
    def run(part: int, blocks: dict[int, list[bytes]]) -> Iterator[pa.RecordBatch]:
        yield from passed_on(part, blocks.get(1, []))
        h, ords, salts, at = unpacked(blocks.get(0, []), ENTRY)
        order, group, least = _groups(h, ords)
        ords, salts, at = ords[order], salts[order], at[order]
        later = ords > least[group]
        yield from answers(parts, ords[later], salts[later], at[later])
    return run


def repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_words: int = 13, k: int = 5) -> DataFrame:
    """doc_id, text and ``at``: the first words (binary int32, null if none) of
    the windows that a document with a smaller id has too."""
    if not 0 < k <= min_words:
        raise ValueError("k: from 1 to min_words")
    rows = keyed(docs, id_col, text_col)
    parts = parts_of(docs)
    seeds = reduced(rows.mapInArrow(_seeds(parts, min_words, k), PACKED), _shared_seeds(parts), PACKED)
    seeded = with_answers(rows, by_document(seeds), only=True)
    later = reduced(seeded.mapInArrow(_extensions(parts, min_words, k), PACKED), _later_windows(parts), PACKED)
    return with_answers(rows, by_document(later), only=False)


def deduplicated(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_words: int = 13, k: int = 5,
                 with_text: bool = False) -> DataFrame:
    """doc_id, n_words, n_removed, kept_sha256 (of the kept words joined by one
    space), spans (array<int>: start and end word of each maximal repeat), and
    on request ``kept``, the text that is left."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            out: list[tuple] = []
            for text, at in zip(batch["text"].cast(pa.binary()), batch["at"], strict=True):
                words = (text.as_py() or b"").split()
                n, spans, removed = len(words), np.zeros(0, np.int32), 0
                if at.is_valid:
                    starts, stops = runs(np.frombuffer(at.as_py(), np.int32), min_words)
                    keep = np.ones(n + 1, bool)
                    for a, b in zip(starts.tolist(), stops.tolist(), strict=True):
                        keep[a:b] = False
                    removed = int((stops - starts).sum())
                    words = list(compress(words, keep.tolist()))
                    spans = np.stack([starts, stops], 1).ravel().astype(np.int32)
                left = b" ".join(words)
                out.append((n, removed, hashlib.sha256(left).hexdigest(), spans, left if with_text else None))
            n, removed, sha, spans, left = zip(*out, strict=True)
            columns = [batch["doc_id"], pa.array(n, pa.int64()), pa.array(removed, pa.int64()), pa.array(sha),
                       pa.array(spans, pa.list_(pa.int32()))]
            if with_text:
                columns.append(pa.array(left, pa.binary()).cast(pa.string()))
            yield pa.RecordBatch.from_arrays(columns, names)

    names = ["doc_id", "n_words", "n_removed", "kept_sha256", "spans", *["kept"] * with_text]
    return (repeats(docs, id_col, text_col, min_words, k).select("doc_id", "text", "at")
            .mapInArrow(run, "doc_id long, n_words long, n_removed long, kept_sha256 string, spans array<int>"
                             + ", kept string" * with_text))
