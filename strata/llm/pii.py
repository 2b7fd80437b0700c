"""Operator 13, personal data by candidate gradient boosting.

1. Base spans: the fixed patterns and checks below; they always stay.
2. Generators propose further spans of each kind, overlapping and with high
   recall: addresses with a spoken or bracketed "at" and "dot", any sequence of
   neighbouring digit groups of a fitting length, four numbers with a marked dot.
3. A candidate's features are its format (groups, digits, separators, checksum)
   and its context (characters and words around it).  What makes a span a base
   span (the @, the plus sign, plain dots) is not among them, so a base span and
   the same data written otherwise look alike.
4. For each kind boosted trees learn from the candidates of all documents:
   those that are base spans against all others (parts of base spans, numbers that
   fail the checks, phrases).  Documents of one in four hashes are not learnt from;
   on them the scores are calibrated (a logistic curve); the threshold is the least
   score at which the calibrated chance, and from where the share of base spans, is
   ``precision`` or more.  A kind without ``enough`` examples adds nothing.
5. Candidates above their threshold are taken by falling score, if they overlap
   no base span and none taken before.

Nothing is sampled: the candidates' features are stored as codes (how many of at
most 24 cuts a value is above), equal ones as one row with their weight, and a Spark
job a level of a tree sums slopes and bends by node, feature and code over all of
them.  The candidates of one document, kind and label weigh ``each`` together at
most, so that no long text decides alone, and both labels weigh the same in the fit.
Every document is searched whole, in the task that reads it.  Offsets are code
points, ends exclusive.

Results for odd input: a null text is empty and has no spans; texts of any length
are searched whole, in time linear in them; a null id is left null; repeated rows
are handled row by row; extra columns are left alone; an empty table gives an
empty result and a model that adds nothing.  Ties of score go to the longer span,
then to the smaller start, then to the kind listed first.
"""

from __future__ import annotations

import re
from bisect import bisect_left
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.llm.common import release_since, slices, stored, written

KINDS = ("email", "ip", "card", "phone")
EACH, PRECISION, ENOUGH = 10, 0.95, 40
Span = tuple[str, int, int]

# The patterns and limits of the base spans.
DOMAIN = re.compile(r"[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"(?<![0-9])[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
MOST_OCTET, CARD_DIGITS, PHONE_DIGITS = 255, (14, 19), (10, 15)

# Words that announce personal data.
CUES = {
    "email": ("mail", "contact", "write", "reach"),
    "ip": ("ip", "host", "server", "address"),
    "card": ("card", "visa", "credit", "pay"),
    "phone": ("phone", "call", "tel", "fax", "mobile"),
}

AT = re.compile(r"@|[ \t]?[(\[{]at[)\]}][ \t]?|[ \t]at[ \t]")
LOOSE_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:(?:\.|[ \t]?[(\[{]dot[)\]}][ \t]?|[ \t]dot[ \t])[A-Za-z0-9-]+)+")
DOT = re.compile(r"\.|[ \t]?[(\[{]dot[)\]}][ \t]?|[ \t]dot[ \t]")
LOOSE_IP = re.compile(r"(?=(?<![0-9])([0-9]{1,3}(?:[ \t]?[(\[{]?(?:\.|dot)[)\]}]?[ \t]?[0-9]{1,3}){3})(?![0-9]))")
GROUPS = re.compile(r"[0-9]+(?:[ ./() \t-]{1,3}[0-9]+)*")
DIGITS = re.compile(r"[0-9]+")
NEAR, LONGEST_LOCAL, MOST_GROUPS = 24, 64, 8


def luhn(digits: str) -> bool:
    total = sum(map(int, digits[-1::-2])) + sum(sum(divmod(2 * int(c), 10)) for c in digits[-2::-2])
    return total % 10 == 0


def _small(part: str) -> bool:
    part = part.lstrip("0")
    return len(part) <= 3 and int(part or 0) <= MOST_OCTET


def base_spans(text: str) -> list[Span]:
    """The base spans by start, then kind.  (An address is found from its @ to
    the left, which gives the leftmost match without rescanning.)"""
    out: list[Span] = []
    done, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > done and text[start - 1] in LOCAL:
            start -= 1
        host = DOMAIN.match(text, at + 1) if start < at else None
        if host:
            out.append(("email", start, host.end()))
        done = host.end() if host else at + 1
        at = text.find("@", done)
    if DIGITS.search(text):
        out += [("ip", m.start(), m.end()) for m in IP.finditer(text) if all(map(_small, m.group().split(".")))]
        for m in CARD.finditer(text):
            digits = m.group().replace(" ", "").replace("-", "")
            if CARD_DIGITS[0] <= len(digits) <= CARD_DIGITS[1] and luhn(digits):
                out.append(("card", m.start(), m.end()))
        if "+" in text:
            out += [("phone", m.start(), m.end()) for m in PHONE.finditer(text)
                    if PHONE_DIGITS[0] <= sum(c.isdigit() for c in m.group()) <= PHONE_DIGITS[1]]
    return sorted(out, key=lambda s: (s[1], KINDS.index(s[0])))


# --- candidates -----------------------------------------------------------------

def candidates(text: str) -> Iterator[Span]:
    """Proposed spans.  Where a base span has a mark that others may lack (the
    plus sign), the candidate begins after it."""
    for m in AT.finditer(text):
        start = m.start()
        while start > 0 and m.start() - start < LONGEST_LOCAL and text[start - 1] in LOCAL:
            start -= 1
        host = LOOSE_DOMAIN.match(text, m.end()) if start < m.start() else None
        if host:
            ends = [d.start() for d in DOT.finditer(text, m.end(), host.end())][1:][:6]
            yield from (("email", start, e) for e in [*ends, host.end()])
    if not DIGITS.search(text):
        return
    yield from (("ip", m.start(1), m.end(1)) for m in LOOSE_IP.finditer(text))
    for m in GROUPS.finditer(text):
        groups = [(g.start(), g.end()) for g in DIGITS.finditer(text, m.start(), m.end())]
        for i, (start, _) in enumerate(groups):
            digits = 0
            for a, end in groups[i:i + MOST_GROUPS]:
                digits += end - a
                if digits > 19:
                    break
                if 12 <= digits:
                    yield "card", start, end
                if 7 <= digits <= 15:
                    yield "phone", start, end


def _shape(char: str) -> float:
    if not char or char.isspace():
        return 0.0
    return 1.0 if char.isalpha() else 2.0 if char.isdigit() else 4.0 if char in ".-_/" else 3.0


WIDTH = 20


def features(text: str, kind: str, start: int, end: int) -> list[float]:
    """Format and context of a span, without the marks of base spans."""
    span = text[start:end]
    if kind == "email":
        at = AT.search(span)
        local, host = span[:at.start()], DOT.split(span[at.end():])
        form = [len(local), len(host), len(host[-1]), max(map(len, host)), min(map(len, host)),
                sum(c.isdigit() for c in local), sum(c.isdigit() for c in "".join(host)),
                sum(c in "._%+-" for c in local), float(host[-1].isalpha()), float(local[0].isalnum()), float(local[-1].isalnum())]
    else:
        groups = DIGITS.findall(span)
        between = DIGITS.split(span)[1:-1]
        digits = "".join(groups)
        form = [len(digits), len(groups), max(map(len, groups)), min(map(len, groups)), len(groups[0]), len(groups[-1]),
                float(luhn(digits)), max(min(int(g[:6]), 999) for g in groups), float(any(g[0] == "0" and len(g) > 1 for g in groups)),
                float(digits[0]), float(len(set(between)))]
    before = start - 1
    if kind == "phone":
        while before >= 0 and text[before] in "+(":  # the marks of a base span
            before -= 1
    left, right = text[max(0, before + 1 - NEAR):before + 1], text[end:end + NEAR]
    words = left.lower()
    context = [_shape(left[-1:]), _shape(right[:1]), _shape(left[-2:-1]), _shape(right[1:2]),
               float(sum(c.isdigit() for c in left)), float(sum(c.isdigit() for c in right)),
               sum(c.isalpha() for c in left) / max(1, len(left)), float("\n" in left[-2:] or not left),
               float(any(c in words for c in CUES[kind]))]
    return [float(v) for v in (*form, *context)]


def _label(kind: str, start: int, end: int, base: set[Span]) -> bool:
    return (kind, start - (kind == "phone"), end) in base  # after the plus sign


# --- boosted trees ----------------------------------------------------------------

BINS, ROUNDS, DEPTH, RATE, PENALTY = 24, 60, 3, 0.2, 1.0
#: The code of a cut that nothing is above: a node that is not split.
UNSPLIT = 255


def _node(values: np.ndarray, feature: np.ndarray, cut: np.ndarray, levels: int) -> np.ndarray:
    """The node of each row (of features or of their codes) after ``levels`` splits."""
    node, rows = np.zeros(len(values), np.int64), np.arange(len(values))
    for level in range(levels):
        here = (1 << level) - 1 + node
        node = 2 * node + (values[rows, feature[here]] > cut[here])
    return node


def _raised(values: np.ndarray, trees: list[tuple[np.ndarray, np.ndarray, np.ndarray]], start: float, depth: int) -> np.ndarray:
    """The score of each row: ``start`` and its leaf of each tree."""
    out = np.full(len(values), start)
    for feature, cut, value in trees:
        out += value[_node(values, feature, cut, depth)]
    return out


def _codes(x: np.ndarray, cuts: list[np.ndarray]) -> np.ndarray:
    """How many cuts of its feature a value is above: x > cut[i] if and only if code > i."""
    return np.stack([np.searchsorted(c, v, "left") for c, v in zip(cuts, x.T, strict=True)], axis=1).astype(np.uint8)


def _slopes(score: np.ndarray, y: np.ndarray, weight: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First and second derivative of the logistic loss."""
    p = 1 / (1 + np.exp(-np.clip(score, -500, 500)))
    return (p - y) * weight, np.maximum(p * (1 - p), 1e-9) * weight


def _sums(code: np.ndarray, node: np.ndarray, value: np.ndarray, many: int, width: int) -> np.ndarray:
    """Sums of ``value`` by node, feature and code."""
    shape = many, code.shape[1], width
    slot = (node[:, None] * shape[1] + np.arange(shape[1])) * width + code
    return np.bincount(slot.ravel(), np.repeat(value, shape[1]), many * shape[1] * width).reshape(shape)


def boosted(start: dict, cuts: dict[object, list[np.ndarray]], sums, rounds: int = ROUNDS, depth: int = DEPTH, rate: float = RATE,
            penalty: float = PENALTY) -> dict:
    """Boosted trees (on codes) of each key of ``cuts``.  ``sums(trees, growing, level)``
    gives for each key the sums of slopes and bends by node of that level, feature
    and code; all else needs no rows."""
    trees: dict = {k: [] for k in cuts}
    for _ in range(rounds):
        growing = {k: (np.zeros((1 << depth) - 1, np.int64), np.full((1 << depth) - 1, UNSPLIT)) for k in cuts}
        value = {k: np.zeros(1 << depth) for k in cuts}
        for level in range(depth):
            first, many = (1 << level) - 1, 1 << level
            for k, (g, h) in sums(trees, growing, level).items():
                g, h = g.cumsum(axis=2), h.cumsum(axis=2)
                part = lambda a, b: a * a / (b + penalty)
                gain = (part(g, h) + part(g[..., -1:] - g, h[..., -1:] - h) - part(g[..., -1:], h[..., -1:]))[..., :-1]
                for f, c in enumerate(cuts[k]):
                    gain[:, f, len(c):] = -np.inf
                gain = gain.reshape(many, -1)
                at = gain.argmax(axis=1)
                better = gain[np.arange(many), at] > 1e-9
                feature, cut = growing[k]
                feature[first:first + many][better] = (at // (g.shape[2] - 1))[better]
                cut[first:first + many][better] = (at % (g.shape[2] - 1))[better]
                if level == depth - 1:
                    for i in range(many):
                        f, c = feature[first + i], min(cut[first + i], g.shape[2] - 1)
                        for leaf, (a, b) in enumerate(((g[i, f, c], h[i, f, c]), (g[i, f, -1] - g[i, f, c], h[i, f, -1] - h[i, f, c]))):
                            value[k][2 * i + leaf] = -rate * a / (b + penalty)
        for k in cuts:
            trees[k].append((*growing[k], value[k]))
    return trees


class Trees:
    """Boosted regression trees of a fixed depth on the logistic loss; splits are
    at quantiles of the features, leaves are Newton steps."""

    def __init__(self, rounds: int = ROUNDS, depth: int = DEPTH, bins: int = BINS, rate: float = RATE, penalty: float = PENALTY):
        self.rounds, self.depth, self.bins, self.rate, self.penalty = rounds, depth, bins, rate, penalty
        self.trees: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        self.start = 0.0

    def fit(self, x: np.ndarray, y: np.ndarray) -> Trees:
        cuts = [np.unique(np.quantile(c, np.linspace(0, 1, self.bins + 1)[1:-1])) for c in x.T]
        cuts = [np.unique(np.concatenate([c, (np.unique(v)[:-1] + np.unique(v)[1:]) / 2])) if len(np.unique(v)) <= self.bins else c
                for c, v in zip(cuts, x.T, strict=True)]
        code = _codes(x, cuts)
        share = np.clip(y.mean(), 1e-6, 1 - 1e-6)
        start, width = float(np.log(share / (1 - share))), max(map(len, cuts)) + 1

        def sums(trees: dict, growing: dict, level: int) -> dict:
            node = _node(code, *growing[0], level)
            return {0: tuple(_sums(code, node, v, 1 << level, width)
                             for v in _slopes(_raised(code, trees[0], start, self.depth), y, np.ones(len(y))))}

        return self.of_codes(boosted({0: start}, {0: cuts}, sums, self.rounds, self.depth, self.rate, self.penalty)[0], cuts, start)

    def of_codes(self, trees: list[tuple[np.ndarray, np.ndarray, np.ndarray]], cuts: list[np.ndarray], start: float) -> Trees:
        """These trees, made on codes, with the cuts themselves."""
        at = lambda f, c: cuts[f][c] if c < len(cuts[f]) else np.inf
        self.start = start
        self.trees = [(feature, np.array([at(f, c) for f, c in zip(feature, cut, strict=True)]), value) for feature, cut, value in trees]
        return self

    def scores(self, x: np.ndarray) -> np.ndarray:
        return _raised(x, self.trees, self.start, self.depth)


def calibrated(score: np.ndarray, y: np.ndarray, rounds: int = 50, weight: np.ndarray | None = None) -> tuple[float, float]:
    """a, b of the chance 1 / (1 + exp(-(a s + b))), with smoothed targets."""
    weight = np.ones(len(y)) if weight is None else weight
    good, bad = (weight * y).sum(), (weight * (1 - y)).sum()
    target = np.where(y == 1, (good + 1) / (good + 2), 1 / (bad + 2))
    z = np.stack([score, np.ones(len(score))], axis=1)
    w = np.zeros(2)
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(z @ w, -30, 30)))
        step = np.linalg.solve((z * (weight * p * (1 - p))[:, None]).T @ z + 1e-6 * np.eye(2), z.T @ (weight * (p - target)))
        w -= step
        if np.abs(step).max() < 1e-8:
            break
    return float(w[0]), float(w[1])


def threshold(score: np.ndarray, y: np.ndarray, precision: float, weight: np.ndarray | None = None) -> float:
    """The least score at which the calibrated chance is ``precision`` and from
    where the share of ones among the held-out rows is too (infinite if none)."""
    weight = np.ones(len(y)) if weight is None else weight
    a, b = calibrated(score, y, weight=weight)
    if a <= 0:
        return float("inf")
    least = (np.log(precision / (1 - precision)) - b) / a
    starts = np.concatenate([[least], np.unique(score[score > least])])
    order = np.argsort(score, kind="stable")
    from_on = lambda v: np.concatenate([np.cumsum(v[order][::-1])[::-1], [0.0]])[np.searchsorted(score[order], starts, "left")]
    every, ones = from_on(weight), from_on(weight * y)
    good = (every > 0) & (ones >= precision * every)
    return float(starts[good.argmax()]) if good.any() else float("inf")


def examples(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", each: int = EACH, seed: int = 7) -> DataFrame:
    """kind, y, held, w, x: all candidates of all documents.  The candidates of
    one document, kind and label weigh ``each`` together, or one each if fewer
    (w, in ``UNIT``-ths)."""
    rows = docs.select(F.xxhash64(F.col(id_col), F.length(text_col), F.lit(seed)).alias("_h"),
                       F.col(text_col).cast("string").alias("text"))

    def propose(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            out: list[tuple] = []
            for h, text in zip(batch["_h"].to_pylist(), batch["text"].to_pylist(), strict=True):
                text = text or ""
                base = set(base_spans(text))
                many = Counter((kind, _label(kind, a, b, base)) for kind, a, b in candidates(text))
                for kind, a, b in candidates(text) if many else ():
                    y = _label(kind, a, b, base)
                    weight = max(1, UNIT * min(each, many[kind, y]) // many[kind, y])
                    out.append((KINDS.index(kind), int(y), h % 4 == 0, weight, np.array(features(text, kind, a, b)).tobytes()))
                    if len(out) >= 20_000:
                        yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*out, strict=True)], _EXAMPLE)
                        out = []
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*out, strict=True)], _EXAMPLE)

    return rows.mapInArrow(propose, "kind long, y long, held boolean, w long, x binary")


_EXAMPLE = ["kind", "y", "held", "w", "x"]
# Fixed: parts of an example's weight, of a slope in the sums (whole numbers: the sums
# do not depend on the order of rows), and of a score in the counts of held-out rows.
UNIT, SCALE, STEP, MOST = 1 << 16, float(1 << 24), 256, 64


def _features(batch: pa.RecordBatch) -> np.ndarray:
    return np.frombuffer(b"".join(batch["x"].to_pylist()), np.float64).reshape(-1, WIDTH)


def feature_cuts(rows: DataFrame, totals: dict[tuple[int, int], int], bins: int = BINS) -> dict[int, list[np.ndarray]]:
    """Of each kind of ``totals`` (weights by kind and label) the cuts of its features:
    quantiles of all values that are learnt from, both labels weighing the same, or
    all borders between values if these are few."""

    def values(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            kind, y, w, x = *(batch[c].to_numpy() for c in ("kind", "y", "w")), _features(batch)
            for k in np.unique(kind).tolist():
                of = kind == k
                for f in range(WIDTH):
                    v, at = np.unique(x[of, f], return_inverse=True)
                    sums = [np.bincount(at, w[of] * (y[of] == label), len(v)).astype(np.int64) for label in (0, 1)]
                    yield pa.RecordBatch.from_arrays([pa.array(np.full(len(v), k)), pa.array(np.full(len(v), f)), pa.array(v), *map(pa.array, sums)],
                                                     ["kind", "f", "v", "w0", "w1"])

    share = F.lit(0.0)
    for (k, y), total in totals.items():
        share = share + F.when(F.col("kind") == k, F.col(f"w{y}") / F.lit(2.0 * total)).otherwise(0.0)
    learnt = rows.filter(~F.col("held") & F.col("kind").isin(sorted({k for k, _ in totals})))
    by = (learnt.select("kind", "y", "w", "x").mapInArrow(values, "kind long, f long, v double, w0 long, w1 long")
          .groupBy("kind", "f", "v").agg(F.sum("w0").alias("w0"), F.sum("w1").alias("w1")).withColumn("s", share))
    at = "OVER (PARTITION BY kind, f ORDER BY v)"
    by = by.selectExpr("*", f"sum(s) {at} AS c", f"lead(v) {at} AS later", "count(*) OVER (PARTITION BY kind, f) AS many")
    cut = (F.when(F.col("many") <= bins, (F.col("v") + F.col("later")) / 2)
           .when(F.floor(F.col("c") * bins) > F.floor((F.col("c") - F.col("s")) * bins), F.col("v")))
    got = by.filter("later IS NOT NULL").select("kind", "f", cut.alias("cut")).filter("cut IS NOT NULL").collect()
    return {k: [np.array(sorted(r.cut for r in got if (r.kind, r.f) == (k, f))) for f in range(WIDTH)] for k in sorted({k for k, _ in totals})}


def coded(rows: DataFrame, cuts: dict[int, list[np.ndarray]]) -> DataFrame:
    """The examples by kind, label, part and codes of their features, with their weight."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            kind, x = batch["kind"].to_numpy(), _features(batch)
            code = np.zeros(x.shape, np.uint8)
            for k in np.unique(kind).tolist():
                code[kind == k] = _codes(x[kind == k], cuts[k])
            yield pa.RecordBatch.from_arrays([*(batch[c] for c in ("kind", "y", "held", "w")), pa.array([c.tobytes() for c in code], pa.binary())],
                                             ["kind", "y", "held", "w", "code"])

    some = rows.filter(F.col("kind").isin(sorted(cuts)))
    return (some.mapInArrow(run, "kind long, y long, held boolean, w long, code binary")
            .groupBy("kind", "y", "held", "code").agg(F.sum("w").alias("w")))


def _rows_of(batch: pa.RecordBatch) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray]]:
    """kind, y, weight and codes of the rows of a batch."""
    kind, y, w = batch["kind"].to_numpy(), batch["y"].to_numpy().astype(np.float64), batch["w"].to_numpy() / UNIT
    code = np.frombuffer(b"".join(batch["code"].to_pylist()), np.uint8).reshape(-1, WIDTH)
    for k in np.unique(kind).tolist():
        yield k, y[kind == k], w[kind == k], code[kind == k]


def fitted(rows: DataFrame, cuts: dict[int, list[np.ndarray]], totals: dict[tuple[int, int], int], rounds: int = ROUNDS) -> dict[int, list]:
    """Trees on the codes of each kind, from all ``coded`` rows that are learnt from:
    a Spark job a level sums slopes and bends over them.  Both labels weigh the same."""
    learnt = rows.filter(~F.col("held")).select("kind", "y", "w", "code")
    factor = {k: np.array([sum(totals[k, y] for y in (0, 1)) / 2 / totals[k, label] for label in (0, 1)]) for k in cuts}
    width = {k: max(map(len, c)) + 1 for k, c in cuts.items()}
    shape = lambda k, level: (1 << level, WIDTH, width[k])

    def sums(trees: dict, growing: dict, level: int) -> dict:
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            found = {k: np.zeros((2, *shape(k, level))) for k in cuts}
            for batch in batches:
                for k, y, w, code in _rows_of(batch):
                    node = _node(code, *growing[k], level)
                    for i, v in enumerate(_slopes(_raised(code, trees[k], 0.0, DEPTH), y, w * factor[k][y.astype(np.int64)])):
                        found[k][i] += _sums(code, node, np.rint(v * SCALE), 1 << level, width[k])
            yield pa.RecordBatch.from_arrays([pa.array(list(found)), pa.array([v.astype(np.int64).tobytes() for v in found.values()], pa.binary())],
                                             ["kind", "sums"])

        # a task sends its sums (a few 10 KB a kind, however many rows it read)
        out = {k: np.zeros((2, *shape(k, level)), np.int64) for k in cuts}
        for r in learnt.mapInArrow(run, "kind long, sums binary").collect():
            out[r.kind] += np.frombuffer(r.sums, np.int64).reshape(out[r.kind].shape)
        return {k: (g / SCALE, h / SCALE) for k, (g, h) in out.items()}

    return boosted(dict.fromkeys(cuts, 0.0), cuts, sums, rounds)


def held_scores(rows: DataFrame, trees: dict[int, list]) -> dict[int, tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Of each kind: scores (rounded down to ``STEP``-ths, at most ``MOST`` either
    way), labels and weights of all held-out rows, counted by score and label."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k, y, w, code in _rows_of(batch):
                score = np.floor(np.clip(_raised(code, trees[k], 0.0, DEPTH), -MOST, MOST) * STEP).astype(np.int64)
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(y), k)), pa.array(score), pa.array(y.astype(np.int64)),
                                                  pa.array((w * UNIT).astype(np.int64))], ["kind", "score", "y", "w"])

    got = (rows.filter("held").select("kind", "y", "w", "code").mapInArrow(run, "kind long, score long, y long, w long")
           .groupBy("kind", "score", "y").agg(F.sum("w").alias("w")).orderBy("kind", "score", "y").toPandas())
    out = {}
    for k in trees:
        part = got[got["kind"] == k]
        out[k] = part["score"].to_numpy() / STEP, part["y"].to_numpy(np.float64), part["w"].to_numpy() / UNIT
    return out


def trained(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", each: int = EACH, precision: float = PRECISION,
            enough: int = ENOUGH, seed: int = 7) -> dict[str, tuple[Trees, float]]:
    """The trees and threshold of each kind that has enough examples."""
    before = written()
    rows = stored(examples(docs, id_col, text_col, each, seed), "pii-examples")
    counts: Counter = Counter()
    totals = {}
    for r in rows.groupBy("kind", "y", "held").agg(F.count(F.lit(1)).alias("n"), F.sum("w").alias("w")).collect():
        counts[r.kind, r.y, r.held] = r.n
        if not r.held:
            totals[r.kind, r.y] = r.w
    kinds = [k for k in range(len(KINDS)) if min(counts[k, y, held] for y in (0, 1) for held in (False, True)) >= enough / 4
             and counts[k, 1, False] + counts[k, 1, True] >= enough]
    model = {}
    if kinds:
        totals = {(k, y): w for (k, y), w in totals.items() if k in kinds}
        cuts = feature_cuts(rows, totals)
        rows = stored(coded(rows, cuts), "pii-coded")
        trees = fitted(rows, cuts, totals)
        for k, (score, y, weight) in held_scores(rows, trees).items():
            least = np.ceil(threshold(score, y, precision, weight) * STEP) / STEP
            if np.isfinite(least):
                model[KINDS[k]] = (Trees().of_codes(trees[k], cuts[k], 0.0), float(least))
    release_since(before)
    return model


# --- selection ----------------------------------------------------------------------

def added_spans(text: str, base: list[Span], model: dict[str, tuple[Trees, float]], block: int = 20_000) -> list[tuple[str, int, int, float]]:
    """The candidates that the model selects, with the log-odds above their
    threshold."""
    chosen: list[tuple[float, str, int, int]] = []

    def judge(held: list[Span]) -> None:
        for kind, (trees, least) in model.items():
            own = [s for s in held if s[0] == kind]
            if own:
                scores = trees.scores(np.array([features(text, *s) for s in own])) - least
                chosen.extend((float(v), *s) for v, s in zip(scores, own, strict=True) if v >= 0)

    free = _Taken(base)
    held: list[Span] = []
    for span in candidates(text):
        if span[0] in model and not free.meets(span[1], span[2]):
            held.append(span)
            if len(held) >= block:
                judge(held)
                held = []
    judge(held)
    out = []
    for v, kind, a, b in sorted(chosen, key=lambda c: (-c[0], c[2] - c[3], c[2], KINDS.index(c[1]))):
        if not free.meets(a, b):
            free.add(a, b)
            out.append((kind, a, b, v))
    return out


class _Taken:
    """Taken stretches of a text, disjoint and in order."""

    def __init__(self, spans: list[Span]):
        self.starts: list[int] = []
        self.ends: list[int] = []
        for _, a, b in sorted(spans, key=lambda s: s[1:]):
            if self.ends and a < self.ends[-1]:
                self.ends[-1] = max(self.ends[-1], b)
            else:
                self.starts.append(a)
                self.ends.append(b)

    def meets(self, a: int, b: int) -> bool:
        at = bisect_left(self.starts, b) - 1
        return at >= 0 and self.ends[at] > a

    def add(self, a: int, b: int) -> None:
        at = bisect_left(self.starts, a)
        self.starts.insert(at, a)
        self.ends.insert(at, b)


SPANS = "array<struct<kind: string, start: long, end: long, base: boolean, score: double>>"


def found(docs: DataFrame, model: dict[str, tuple[Trees, float]] | None = None, id_col: str = "doc_id", text_col: str = "text",
          redact: bool = False) -> DataFrame:
    """doc_id, spans (by start, then kind; score: log-odds above the threshold,
    null for base spans) and on request ``redacted``, the text with each stretch
    of spans replaced by the kinds in it, as in ``[email]``."""
    if model is None:
        model = trained(docs, id_col, text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            spans, texts = [], []
            for text in batch["text"].to_pylist():
                text = text or ""
                base = base_spans(text)
                every = [(*s, True, None) for s in base] + [(k, a, b, False, v) for k, a, b, v in added_spans(text, base, model)]
                every.sort(key=lambda s: (s[1], KINDS.index(s[0])))
                spans.append([dict(zip(("kind", "start", "end", "base", "score"), s, strict=True)) for s in every])
                if redact:
                    texts.append(redacted(text, every))
            columns = [batch["doc_id"], pa.array(spans, _SPANS), *[pa.array(texts, pa.string())] * redact]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "spans", *["redacted"] * redact])

    kind = docs.schema[id_col].dataType.simpleString()
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return rows.mapInArrow(run, f"doc_id {kind}, spans {SPANS}" + ", redacted string" * redact)


_SPANS = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("base", pa.bool_()),
                             ("score", pa.float64())]))


def redacted(text: str, spans: list[tuple]) -> str:
    out, at, end, kinds = [], 0, 0, []
    for kind, a, b, *_ in [*spans, (None, len(text) + 1, 0)]:
        if kinds and a >= end:
            out.append(f"[{'+'.join(dict.fromkeys(kinds))}]")
            at, kinds = end, []
        if kind:
            if not kinds:
                out.append(text[at:a])
            kinds.append(kind)
            end = max(end, b)
    return "".join([*out, text[at:]])


def digests(spans: DataFrame) -> DataFrame:
    """doc_id, the numbers of base spans, base_sha256, spans (one string of all
    spans) and n_added, from the rows of ``found``."""
    line = lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))
    joined = lambda c: F.array_join(F.transform(c, line), ",")
    base = F.filter("spans", lambda s: s["base"])
    count = lambda k: F.size(F.filter("spans", lambda s: s["base"] & (s["kind"] == k))).cast("long").alias(f"n_{k}")
    return spans.select("doc_id", *map(count, KINDS), F.sha2(joined(base).cast("binary"), 256).alias("base_sha256"),
                        joined(F.col("spans")).alias("spans"), (F.size("spans") - F.size(base)).cast("long").alias("n_added"))
