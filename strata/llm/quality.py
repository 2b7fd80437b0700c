"""Operator 5, quality classifier by Bradley-Terry pairwise ranking.

Preference pairs (a text labelled 1 beats a text labelled 0) are drawn with a
fixed seed; the probability that a beats b is ``1 / (1 + exp(-(z_a - z_b)))`` with
``z = w . x``, so ``w`` comes from logistic loss on differences of features.  The
threshold is the quantile of the training scores at the share of 0 labels, and
the score is ``1 / (1 + exp(-(z - threshold)))``.

Features are rates over the whole text (bytes, neighbouring classes of bytes,
distinct and repeated words in windows of 256 words, word and line lengths); no
label, language, source or id is one.  The fit uses at most ``sample`` labelled
rows (those with the smallest seeded hashes of their ids) and ``pairs`` pairs, so
what reaches the driver is bounded; scoring covers every row in one pass
without a shuffle.

Results for odd input: a null text is scored like an empty one; texts above
2 MB are read in parts cut at white space, whole; labels that are null or whose
id has no text are not used; without both labels every score is 0.5; repeated
rows are scored each; extra columns are left alone.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.llm.common import slices, text_bytes, word_hashes, words_of

PART = 2_000_000   # bytes of a text that are in memory as arrays at once
WINDOW = 256       # words of a window for distinct words
CLASSES = 10
_CLASS = np.full(256, 9, np.uint8)
for _k, _bytes in enumerate((b"abcdefghijklmnopqrstuvwxyz", b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"0123456789", b" \t", b"\r\n",
                             b".,;:", b"!?", b"\"'()[]{}<>-/|\\", b"#$%&*+=@^_`~")):
    _CLASS[list(_bytes)] = _k

#: Raw counts per text: bytes, ASCII bytes, class pairs, words, distinct words
#: in windows, most frequent word in windows, lines, words equal to the previous.
WIDTH = 1 + 128 + CLASSES * CLASSES + 5


def _tally(raw: np.ndarray, ends: np.ndarray) -> np.ndarray:
    n = len(ends) - 1
    out = np.zeros((n, WIDTH))
    lens = np.diff(ends)
    out[:, 0] = lens
    if not len(raw):
        return out
    doc = np.repeat(np.arange(n), lens)
    plain = raw < 128
    out[:, 1:129] = np.bincount(doc[plain] * 128 + raw[plain], minlength=n * 128).reshape(n, 128)
    kinds = _CLASS[raw].astype(np.int64)
    same = doc[1:] == doc[:-1]
    codes = (doc[1:] * CLASSES + kinds[:-1]) * CLASSES + kinds[1:]
    out[:, 129:129 + CLASSES ** 2] = np.bincount(codes[same], minlength=n * CLASSES ** 2).reshape(n, -1)
    at = 129 + CLASSES ** 2
    starts, stops, first = words_of(raw, ends)
    count = np.diff(first)
    out[:, at] = count
    out[:, at + 3] = np.bincount(doc[raw == 10], minlength=n)
    if len(starts):
        h = word_hashes(raw, starts, stops)
        owner = np.repeat(np.arange(n), count)
        out[:, at + 4] = np.bincount(owner[1:][(h[1:] == h[:-1]) & (owner[1:] == owner[:-1])], minlength=n)
        window = (np.arange(len(h)) - first[owner]) // WINDOW
        new = np.ones(len(h), bool)
        new[1:] = (owner[1:] != owner[:-1]) | (window[1:] != window[:-1])
        window = np.cumsum(new) - 1
        order = np.lexsort((h, window))
        hs, ws = h[order], window[order]
        fresh = np.ones(len(h), bool)
        fresh[1:] = (hs[1:] != hs[:-1]) | (ws[1:] != ws[:-1])
        runs = np.diff(np.flatnonzero(np.append(fresh, True)))
        of = ws[fresh]
        most = np.zeros(window[-1] + 1)
        np.maximum.at(most, of, runs)
        to = owner[new]
        out[:, at + 1] = np.bincount(to[of], minlength=n)
        out[:, at + 2] = np.bincount(to, weights=most, minlength=n)
    return out


def tallies(col: pa.Array) -> np.ndarray:
    """Raw counts of each text; a long one is read in parts."""
    raw, ends = text_bytes(col)
    if len(raw) <= PART or len(ends) > 2:
        return _tally(raw, ends)
    total, lo = np.zeros((1, WIDTH)), 0
    while lo < len(raw):
        hi = min(len(raw), lo + PART)
        if hi < len(raw):
            spaces = np.flatnonzero(raw[lo:hi] <= 32)
            hi = lo + int(spaces[-1]) + 1 if len(spaces) else hi
        total += _tally(raw[lo:hi], np.array([0, hi - lo]))
        lo = hi
    return total


def features(t: np.ndarray) -> np.ndarray:
    """Rates from raw counts, on a scale where rare things still show."""
    size = np.maximum(t[:, :1], 1)
    at = 129 + CLASSES ** 2
    words = np.maximum(t[:, at:at + 1], 1)
    rates = np.log1p(1000 * t[:, 1:at] / size)
    return np.hstack([rates, t[:, at + 1:at + 3] / words, np.log1p(t[:, at + 4:at + 5] / words * 100),
                      np.log1p(size / words), np.log1p(words / (t[:, at + 3:at + 4] + 1)),
                      np.log1p(t[:, at:at + 1]), (t[:, at:at + 1] == 0)])


def fit(x: np.ndarray, y: np.ndarray, pairs: int = 30_000, penalty: float = 1e-3, seed: int = 7,
        rounds: int = 25) -> dict[str, np.ndarray]:
    """Mean, scale, weights and threshold: Newton steps on the pairwise loss."""
    mean, scale = x.mean(axis=0) if len(x) else 0.0, x.std(axis=0) if len(x) else 1.0
    scale = np.where(scale > 1e-9, scale, 1.0)
    z = np.clip((x - mean) / scale, -8, 8)
    good, bad = np.flatnonzero(y == 1), np.flatnonzero(y == 0)
    w = np.zeros(x.shape[1])
    if not len(good) or not len(bad):
        return {"mean": mean, "scale": scale, "w": w, "threshold": np.float64(0)}
    rng = np.random.default_rng(seed)
    d = z[rng.choice(good, pairs)] - z[rng.choice(bad, pairs)]
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(d @ w, -30, 30)))
        slope = d.T @ (p - 1) / pairs + penalty * w
        bend = (d * (p * (1 - p))[:, None]).T @ d / pairs + penalty * np.eye(len(w))
        step = np.linalg.solve(bend, slope)
        w -= step
        if np.abs(step).max() < 1e-6:
            break
    s = np.sort(z @ w)
    # between the scores below and above the quantile of the 0 labels
    k = len(bad)
    return {"mean": mean, "scale": scale, "w": w, "threshold": (s[k - 1] + s[min(k, len(s) - 1)]) / 2}


def scores(model: dict[str, np.ndarray], x: np.ndarray) -> np.ndarray:
    z = np.clip((x - model["mean"]) / model["scale"], -8, 8) @ model["w"] - model["threshold"]
    return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def held_out(id_col: str = "doc_id") -> Column:
    """Rows that are never learnt from: crc32 of the id's text, mod 3, is 1."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string")) % 3 == 1, F.lit(False))


def trained(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
            label_col: str = "quality", sample: int = 20_000, pairs: int = 30_000, seed: int = 7) -> dict[str, np.ndarray]:
    """The model, from at most ``sample`` labelled rows that are not held out."""
    chosen = (labels.filter(~held_out(id_col) & F.col(label_col).isin(0, 1) & F.col(id_col).isNotNull())
              .select(F.col(id_col).alias("_id"), F.col(label_col).cast("int").alias("_y"))
              .orderBy(F.xxhash64("_id", F.lit(seed)), "_id", "_y").limit(sample))
    # at most ``sample`` rows of two numbers
    rows = (docs.select(F.col(id_col).alias("_id"), F.col(text_col).cast("string").alias("text"))
            .join(F.broadcast(chosen), "_id"))

    def learn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            x = features(tallies(batch["text"])).astype(np.float32)
            yield pa.RecordBatch.from_arrays([batch["_id"], batch["_y"], pa.array([r.tobytes() for r in x], pa.binary())],
                                             ["_id", "_y", "x"])

    kind = dict(rows.dtypes)["_id"]
    got = (rows.mapInArrow(learn, f"_id {kind}, _y int, x binary")
           .orderBy(F.xxhash64("_id", F.lit(seed)), "_id", "_y", "x").limit(sample).toArrow())
    width = features(np.zeros((1, WIDTH))).shape[1]
    x = np.frombuffer(b"".join(got["x"].to_pylist()), np.float32).reshape(-1, width).astype(np.float64)
    return fit(x, np.array(got["_y"].to_pylist()), pairs, seed=seed)


def scored(docs: DataFrame, model: dict[str, np.ndarray], text_col: str = "text", out: str = "score") -> DataFrame:
    """``docs`` with ``out`` double, 0 to 1: the higher, the likelier label 1."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, text_col):
            s = scores(model, features(tallies(batch[text_col])))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(s)], [*batch.schema.names, out])

    kept = docs.drop(out)
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in kept.schema.fields)
    return kept.mapInArrow(run, f"{fields}, `{out}` double")


def classified(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, held_out, score, predicted."""
    model = trained(docs, labels, id_col, text_col)
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return scored(rows, model).select("doc_id", held_out().alias("held_out"), "score",
                                      (F.col("score") >= 0.5).cast("int").alias("predicted"))
