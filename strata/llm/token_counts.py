"""Operator 9, token counts by prefix dynamic programming.

No token of this vocabulary crosses ASCII white space, so the count of a prefix
that ends with a word is the count up to the word before plus the word's own:
running sums over the words give the exact count at every word's end: the prefix
table of a text, whose last entry is the count of the whole text.  A prefix
that ends inside a word adds the count of that part of the word, from a table
with the exact count of every prefix of the word (``Counter.within``).  Words'
counts come from the library and are remembered for two generations of
``Counter.most`` words, so frequent words are encoded once per Python worker.

A word is what stands between ASCII white space, so a text without it is one
word.  Words of over ``Counter.long`` bytes are cut where no token can cross in
any prefix (``piece_ends``: between letters, digits and signs), and the table
has the counts at the ends of these pieces.  A run of letters or of signs of any
length gets the counts of all its prefixes in one pass (``Merges.prefixes``).

``token_counts`` returns the counts of whole documents, and on request the
counts at all ends of words and pieces; ``truncated`` answers budgets from
these: only the piece in which the budget ends is looked at.

Results for odd input: a null text is empty and has 0 tokens; long texts and
words without white space are counted whole; repeated rows are counted each;
extra columns are left alone; an empty table gives an empty result.
"""

from __future__ import annotations

import json
import unicodedata
from collections.abc import Iterator
from functools import cache, cached_property

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.llm.common import _SPACE, slices

VOCABULARY = "word_bpe_49k.json"
SPACES = frozenset("\x85\xa0\u1680\u2028\u2029\u202f\u205f\u3000" + "".join(map(chr, range(0x2000, 0x200B))))
END = "</w>"


@cache
def _seconds() -> frozenset[str]:
    """Characters that may compose with the one before them."""
    parts = (unicodedata.decomposition(chr(i)).split() for i in range(0x110000))
    return frozenset(chr(int(p[1], 16)) for p in parts if len(p) == 2 and p[0][0] != "<") | frozenset(map(chr, range(0x1161, 0x1200)))


@cache
def _kind(char: str) -> tuple[str, str]:
    """What the splitting pattern takes a character for, L (letter), N (number),
    S (sign) or Z (space), and its normal form.  Empty if that depends on its
    neighbours or on the version of Unicode."""
    old = unicodedata.category(char)
    normal = unicodedata.normalize("NFC", char).lower()
    first = unicodedata.normalize("NFD", char)[0]
    if len(normal) != 1 or unicodedata.combining(first) or first in _seconds() or unicodedata.ucd_3_2_0.category(char) != old:
        return "", normal
    if char in SPACES:
        return "Z", normal
    kind = unicodedata.category(normal)[0]
    return {"L": "L", "N": "N", "P": "S", "S": "S", "M": "S"}.get(kind, ""), normal


def piece_ends(word: str, whole: tuple[str, ...] = ()) -> list[int]:
    """Places in ``word``, the last one its end, at which the count of a prefix
    is the count up to there plus that of the rest, for every prefix that
    reaches it.  ``whole``: strings that the tokenizer takes out first."""
    kinds = [_kind(c) for c in word]
    ends = set()
    for i, ((a, x), (b, y)) in enumerate(zip(kinds, kinds[1:], strict=False), 1):
        # after an apostrophe these letters may be a contraction, which is split off
        if a and b and (a != b or a in "NZ") and not (x == "'" and y in "strvmld"):
            ends.add(i)
    for text in whole:
        at = word.find(text)
        while at >= 0:
            ends.difference_update(range(at + 1, at + len(text)))
            ends.add(at + len(text))
            at = word.find(text, at + len(text))
    return sorted(ends | {len(word)})


class Merges:
    """Counts of all prefixes of a run that is not split, in one pass.

    Tokens are the encoding of their text if each two neighbours are that of
    theirs.  So the last token of a prefix is the one vocabulary entry at its end
    that goes with the last token of the prefix before it.  Only the last byte of
    a prefix carries the end mark: its token follows an unmarked prefix."""

    def __init__(self, model: dict):
        pairs = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
        self.rank = {tuple(m): i for i, m in reversed(list(enumerate(pairs)))}
        self.vocab = frozenset(model["vocab"])
        self.longest = max(len(t.removesuffix(END)) for t in self.vocab)
        plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
        other = [b for b in range(256) if b not in set(plain)]
        self.byte = {b: chr(b) for b in plain} | {b: chr(256 + i) for i, b in enumerate(other)}
        self.valid: dict[tuple[str, str], bool] = {}

    def encoded(self, text: str) -> list[str]:
        """The tokens of byte characters, the last with the end mark or not."""
        body = text.removesuffix(END)
        out = list(body)
        out[-1] += text[len(body):]
        while len(out) > 1:
            ranks = [self.rank.get(p, len(self.rank)) for p in zip(out, out[1:], strict=False)]
            least = min(ranks)
            if least == len(self.rank):
                break
            i = ranks.index(least)
            out[i:i + 2] = [out[i] + out[i + 1]]
        return out

    def goes(self, before: str, token: str) -> bool:
        key = (before, token)
        if key not in self.valid:
            if len(self.valid) > 1_000_000:
                self.valid.clear()
            self.valid[key] = self.encoded(before + token) == [t for t in key if t]
        return self.valid[key]

    def prefixes(self, run: str) -> np.ndarray:
        """The count of ``run[:j]`` for j = 0 .. len(run); ``run`` is normal."""
        text = "".join(self.byte[b] for b in run.encode())
        last, count = [""], [0]

        def final(i: int, mark: str) -> tuple[str, int]:
            for m in range(min(i, self.longest), 0, -1):
                token = text[i - m:i] + mark
                if token in self.vocab and self.goes(last[i - m], token):
                    return token, count[i - m] + 1
            raise ValueError("no token ends here")

        for i in range(1, len(text) + 1):
            token, n = final(i, "")
            last.append(token)
            count.append(n)
        ends = np.cumsum([len(c.encode()) for c in run]).tolist()
        return np.array([0, *(final(i, END)[1] for i in ends)])


class Counter:
    """Token counts of words and of all prefixes of a word."""

    most = 500_000  # words of a generation that are remembered; words of over ``long`` bytes are not
    long = 100
    run = 300  # characters from which a run's prefixes are counted in one pass

    def __init__(self, path: str):
        from tokenizers import Tokenizer
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        # remembered words, and those of the generation before
        self.known: dict[bytes, int] = {}
        self.older: dict[bytes, int] = {}
        self.prefixes: dict[str, np.ndarray] = {}

    @cached_property
    def model(self) -> dict:
        return json.loads(self.tokenizer.to_str())

    @cached_property
    def merges(self) -> Merges:
        return Merges(self.model["model"])

    @cached_property
    def whole(self) -> tuple[str, ...]:
        return tuple(t["content"] for t in self.model["added_tokens"])

    def pieces(self, word: bytes) -> list[bytes]:
        """A long word's pieces between the places that no token crosses."""
        if len(word) <= self.long:
            return [word]
        text = word.decode("utf-8", "replace")
        ends = piece_ends(text, self.whole)
        return [text[a:b].encode() for a, b in zip([0, *ends], ends, strict=False)]

    def encoded(self, texts: list[str]) -> list[int]:
        return [len(e.ids) for e in self.tokenizer.encode_batch(texts, add_special_tokens=False)]

    def joined(self, words: list[bytes]) -> np.ndarray:
        """The count of each word, encoded as one text with spaces between."""
        texts = [w.decode("utf-8", "replace") for w in words]
        ends = np.cumsum(np.fromiter((len(t) + 1 for t in texts), np.int64, len(texts)))
        offsets = self.tokenizer.encode(" ".join(texts), add_special_tokens=False).offsets
        starts = np.fromiter((a for a, _ in offsets), np.int64, len(offsets))
        return np.bincount(np.searchsorted(ends, starts, "right"), minlength=len(words))

    def of(self, words: list[bytes]) -> np.ndarray:
        """The count of each word."""
        if len(self.known) > self.most:
            self.known, self.older = {}, self.known
        known, older = self.known, self.older
        missing = set(words).difference(known)
        if older:
            again = missing.intersection(older)
            known.update(zip(again, map(older.__getitem__, again), strict=True))
            missing -= again
        missing = list(missing)
        # many long words at once would hold all their tokens in memory
        for at in range(0, len(missing), 2000):
            part = missing[at:at + 2000]
            known.update(zip(part, self.joined(part).tolist(), strict=True))
        out = np.fromiter(map(known.__getitem__, words), np.int64, len(words))
        for w in missing:
            if len(w) > self.long:
                del known[w]
        return out

    def table(self, texts: list[bytes]) -> tuple[list[list[bytes]], np.ndarray, np.ndarray]:
        """The prefix table of each text: its words and pieces of long words,
        where they begin among those of all texts (one more entry than texts),
        and the text's exact count up to the end of each."""
        pieces = [t.split() for t in texts]
        for i, t in enumerate(texts):
            if len(t) > self.long and any(len(w) > self.long for w in pieces[i]):
                pieces[i] = [p for w in pieces[i] for p in self.pieces(w)]
        first = np.append(0, np.cumsum(np.fromiter(map(len, pieces), np.int64, len(pieces))))
        sums = np.append(0, np.cumsum(self.of([p for ps in pieces for p in ps])))
        return pieces, first, sums[1:] - np.repeat(sums[first[:-1]], np.diff(first))

    def within(self, word: str) -> np.ndarray:
        """The exact count of ``word[:j]`` for j = 0 .. len(word)."""
        found = self.prefixes.get(word)
        if found is not None:
            return found
        if len(word) > self.run:
            return self.within_long(word)
        if len(self.prefixes) > 10_000:
            self.prefixes.clear()
        found = self.prefixes[word] = np.array([0, *self.encoded([word[:j] for j in range(1, len(word) + 1)])])
        return found

    def within_long(self, word: str) -> np.ndarray:
        out = [np.zeros(1, np.int64)]
        ends = piece_ends(word, self.whole)
        for a, b in zip([0, *ends], ends, strict=False):
            piece = word[a:b]
            kinds = [_kind(c) for c in piece]
            if len(piece) <= self.run:
                inside = self.within(piece)
            elif {k for k, _ in kinds} in ({"L"}, {"S"}) and not any(t in piece for t in self.whole):
                inside = self.merges.prefixes("".join(c for _, c in kinds))
            else:
                inside = np.zeros(b - a + 1, np.int64)
                step = max(1, 1_000_000 // len(piece))  # bounds the memory, not the time
                for j in range(1, b - a + 1, step):
                    part = range(j, min(j + step, b - a + 1))
                    inside[part.start:part.stop] = self.encoded([piece[:i] for i in part])
            out.append(out[-1][-1] + inside[1:])
        return np.concatenate(out)


_counters: dict[str, Counter] = {}


def counter(path: str) -> Counter:
    """One counter per Python worker and vocabulary."""
    if path not in _counters:
        _counters[path] = Counter(path)
    return _counters[path]


def vocabulary(name: str = VOCABULARY) -> str:
    import public_tokenizers
    return str(public_tokenizers.path(name))


def word_ends(raw: bytes) -> np.ndarray:
    """The byte at which each word ends (exclusive)."""
    from strata.llm.common import words_of
    a = np.frombuffer(raw, np.uint8)
    return words_of(a, np.array([0, len(a)]))[1]


def _piece_ends(raw: bytes, pieces: list[bytes]) -> np.ndarray:
    """The byte at which each word, or piece of a word, ends (exclusive)."""
    size = np.array([len(p) for p in pieces], np.int64)
    stops = word_ends(raw)
    if len(stops) == len(size):
        return stops
    # the pieces of a word add up to it, without white space between
    a = np.frombuffer(raw, np.uint8)
    black = np.flatnonzero(~_SPACE[a]) + 1
    return black[np.cumsum(size) - 1]


def token_counts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", path: str | None = None,
                 limit: int = 2048, at_words: bool = False) -> DataFrame:
    """doc_id, n_bytes, n_tokens, over_limit; with ``at_words`` also the prefix
    table: word_ends array<int> (bytes; ends of words and of the pieces of long
    words) and prefix_tokens array<int>."""
    where = path
    kind = docs.schema[id_col].dataType.simpleString()
    names = ["doc_id", "n_bytes", "n_tokens", *["word_ends", "prefix_tokens"] * at_words]
    schema = f"doc_id {kind}, n_bytes long, n_tokens long" + ", word_ends array<int>, prefix_tokens array<int>" * at_words

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = counter(where or vocabulary())
        for batch in slices(batches, "text"):
            texts = [t.as_py() or b"" for t in batch.column("text").cast(pa.binary())]
            pieces, first, tokens = c.table(texts)
            # a text's count is the last entry of its prefix table
            total = np.where(np.diff(first) > 0, np.append(tokens, 0)[first[1:] - 1], 0)
            columns = [batch.column("doc_id"), pa.array([len(t) for t in texts], pa.int64()), pa.array(total)]
            if at_words:
                columns += [pa.array([_piece_ends(t, ps) for t, ps in zip(texts, pieces, strict=True)], pa.list_(pa.int32())),
                            pa.array([tokens[a:b] for a, b in zip(first[:-1], first[1:], strict=True)], pa.list_(pa.int32()))]
            yield pa.RecordBatch.from_arrays(columns, names)

    texts = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return texts.mapInArrow(count, schema).withColumn("over_limit", F.col("n_tokens") > limit)


def prefix_count(text: bytes, ends: np.ndarray, tokens: np.ndarray, upto: int, c: Counter) -> int:
    """The exact count of the prefix of ``upto`` bytes, from the prefix table."""
    k = int(np.searchsorted(ends, upto, "right"))
    before = int(tokens[k - 1]) if k else 0
    inside = text[int(ends[k - 1]) if k else 0:upto].split()
    return before + (c.encoded([inside[0].decode("utf-8", "ignore")])[0] if inside else 0)


def longest_prefix(text: bytes, ends: np.ndarray, tokens: np.ndarray, budget: int, c: Counter) -> int:
    """Bytes of the longest prefix (of whole characters) with at most
    ``budget`` tokens.  Only the first word or piece that does not fit is looked at."""
    k = int(np.searchsorted(tokens, budget, "right"))
    if k == len(tokens):
        return len(text)
    left = budget - (int(tokens[k - 1]) if k else 0)
    start = int(ends[k - 1]) if k else 0
    word = text[start:int(ends[k])].split()[0]
    start = int(ends[k]) - len(word)
    chars = word.decode("utf-8", "replace")
    fits = np.flatnonzero(c.within(chars) <= left)
    return start + len(chars[:int(fits[-1])].encode())


def truncated(docs: DataFrame, counts: DataFrame, budget: int, id_col: str = "doc_id",
              text_col: str = "text", path: str | None = None) -> DataFrame:
    """doc_id, text cut to the longest prefix of at most ``budget`` tokens, from
    a prefix table made by ``token_counts(..., at_words=True)``; ids are unique."""
    where = path
    rows = (docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))
            .join(counts.select("doc_id", "word_ends", "prefix_tokens"), "doc_id"))
    kind = docs.schema[id_col].dataType.simpleString()

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = counter(where or vocabulary())
        for batch in slices(batches, "text"):
            out = []
            for t, e, n in zip(batch["text"].cast(pa.binary()), batch["word_ends"], batch["prefix_tokens"], strict=True):
                raw = t.as_py() or b""
                out.append(raw[:longest_prefix(raw, e.values.to_numpy(), n.values.to_numpy(), budget, c)].decode("utf-8"))
            yield pa.RecordBatch.from_arrays([batch["doc_id"], pa.array(out, pa.string())], ["doc_id", "text"])

    return rows.mapInArrow(cut, f"doc_id {kind}, text string")
