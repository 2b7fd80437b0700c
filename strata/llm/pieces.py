"""Operator 7, SentencePiece encoding and decoding by streaming Viterbi.

The best segmentation of a text into vocabulary pieces is found from left to
right.  Only a window of positions is kept: the last ``max_piece`` of them, from
which a later piece may start, and the backpointers that they still need.  When
all surviving paths run through one boundary, the ids up to it are committed
and the state before it is dropped (``Encoder.stream``).

A boundary that no piece can cross needs no search for convergence: no piece
holds a word's first space (written as U+2581) after another character.  So the
text is cut there first, and the ids of such units are remembered (up to
twice ``Encoder.most`` of them); every new unit goes through the streaming search.

Piece scores: this model file ranks its pieces, so a piece of rank r gets the
Zipf log-probability -ln(r + 1); characters outside the vocabulary become byte
pieces.  The file's normalisation is the identity with one leading space.  A
literal U+2581 is written as bytes, so decoding gives back every text exactly.

Results for odd input: a null text is encoded as the empty one (no ids), long
texts and words are encoded whole, repeated rows each; extra columns are left
alone; an empty table gives an empty result.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.llm.common import slices

MODEL = "piece_bpe_32k.model"
SPACE = "▁"
_UNIT = re.compile(r" +[^ ]*")


def model_path(name: str = MODEL) -> str:
    import public_tokenizers
    return str(public_tokenizers.path(name))


class Encoder:
    most = 150_000  # remembered units (of two generations each)
    long = 64       # characters of a unit that is remembered

    def __init__(self, path: str):
        import sentencepiece
        sp = sentencepiece.SentencePieceProcessor(model_file=path)
        n = sp.vocab_size()
        plain = [i for i in range(n) if not (sp.is_byte(i) or sp.is_control(i) or sp.is_unknown(i) or sp.is_unused(i))]
        ranked = sorted(plain, key=lambda i: (-sp.get_score(i), i))
        self.pieces = {sp.id_to_piece(i): (i, -math.log(r + 1)) for r, i in enumerate(ranked)}
        # a literal U+2581 in a text must not read as a space
        self.byte = [sp.piece_to_id(f"<0x{b:02X}>") for b in range(256)]
        self.unknown = -math.log(len(plain) + 1) - 10.0
        self.max_piece = max(map(len, self.pieces))
        self.spans = any(SPACE in p.lstrip(SPACE) for p in self.pieces)
        self.table: list[bytes] = [b""] * n
        for p, (i, _) in self.pieces.items():
            self.table[i] = p.replace(SPACE, " ").encode()
        for b, i in enumerate(self.byte):
            self.table[i] = bytes([b])
        # remembered units, and those of the generation before
        self.known: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}
        # a trie: character -> (children, id as int32 or None, score); in it spaces are spaces
        self.trie: dict = {}
        for p, (i, gain) in self.pieces.items():
            level, p = self.trie, p.replace(SPACE, " ")
            for c in p[:-1]:
                level = level.setdefault(c, [{}, None, 0.0])[0]
            level.setdefault(p[-1], [{}, None, 0.0])[1:] = i.to_bytes(4, "little"), gain

    def stream(self, parts: Iterable[str]) -> Iterator[bytes]:
        """Ids (int32) of the best segmentation of the text that ``parts`` make
        up, as they are committed."""
        width, window = self.max_piece, ""
        # per position of the window, from the last committed boundary on
        score, back = [0.0], [None]
        at = 0  # pieces were started before it
        for part in parts:
            window += part
            self._extend(window, score, back, at, max(at, len(window) - width))
            at = max(at, len(window) - width)
            cut = self._converged(back, score, at)
            if cut:
                yield self._ids(back, cut)
                window, at = window[cut:], at - cut
                score[:] = [s - score[cut] for s in score[cut:]]
                back[:] = [None, *[b and (b[0] - cut, b[1]) for b in back[cut + 1:]]]
        self._extend(window, score, back, at, len(window))
        if window:
            yield self._ids(back, len(window))

    def _extend(self, window: str, score: list[float], back: list, at: int, to: int) -> None:
        """Starts pieces at the positions from ``at`` up to ``to``; ties go to
        the path whose last piece is the longest."""
        end = len(window)
        score += [-math.inf] * (end + 1 - len(score))
        back += [None] * (end + 1 - len(back))
        for i in range(at, to):
            here, level, j, single = score[i], self.trie, i, False
            if here == -math.inf:
                continue
            while j < end:
                node = level.get(window[j])
                if node is None:
                    break
                j += 1
                level, code, gain = node
                if code is not None:
                    if j == i + 1:
                        single = True
                    if here + gain > score[j] + 1e-12:
                        score[j], back[j] = here + gain, (i, code)
            if not single and here + self.unknown > score[i + 1] + 1e-12:
                score[i + 1] = here + self.unknown
                back[i + 1] = (i, b"".join([self.byte[x].to_bytes(4, "little") for x in window[i].encode("utf-8", "surrogatepass")]))

    @staticmethod
    def _converged(back: list, score: list[float], at: int) -> int:
        """The last boundary that every surviving path runs through: positions
        that are reached at or after ``at`` (no piece was started there yet)."""
        alive = {i for i in range(at, len(back)) if score[i] > -math.inf}
        while len(alive) > 1:
            last = max(alive)
            alive.discard(last)
            alive.add(back[last][0])
        return alive.pop() if alive else 0

    @staticmethod
    def _ids(back: list, to: int) -> bytes:
        out = []
        while to:
            to, code = back[to]
            out.append(code)
        out.reverse()
        return b"".join(out)

    def unit(self, text: str) -> bytes:
        """Ids (int32) of one unit."""
        found = self.known.get(text) or self.older.get(text)
        if found is None:
            if len(text) > self.long:
                return b"".join(self.stream(text[i:i + 4096] for i in range(0, len(text), 4096)))
            # a short unit ends before the window is full: nothing to commit on the way
            score, back = [0.0], [None]
            self._extend(text, score, back, 0, len(text))
            found = self._ids(back, len(text))
        if len(self.known) >= self.most:
            self.older, self.known = self.known, {}
        self.known[text] = found
        return found

    def encode(self, text: str) -> bytes:
        """Ids (int32) of a text."""
        if not text:
            return b""
        known = self.known
        units = _UNIT.findall(" " + text) if not self.spans else [" " + text]
        return b"".join([known.get(u) or self.unit(u) for u in units])

    def decode(self, ids: np.ndarray) -> str:
        table = self.table
        return b"".join([table[i] for i in ids.tolist()]).decode("utf-8", "replace")[1:]


_encoders: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    """One encoder per Python worker and model."""
    if path not in _encoders:
        _encoders[path] = Encoder(path)
    return _encoders[path]


def encoded(docs: DataFrame, text_col: str = "text", path: str | None = None, out: str = "token_ids",
            check: str | None = None) -> DataFrame:
    """``docs`` with ``out`` array<int>: the ids of the whole text, and on request
    ``check`` boolean: decoding gave the text back."""
    where = path

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        e = encoder(where or model_path())
        for batch in slices(batches, text_col):
            ids = [e.encode(t.as_py() or "") for t in batch.column(text_col)]
            ends = np.concatenate([[0], np.cumsum([len(x) // 4 for x in ids])]).astype(np.int32)
            values = pa.array(np.frombuffer(b"".join(ids), np.int32))
            columns = [*batch.columns, pa.ListArray.from_arrays(pa.array(ends), values)]
            if check:
                columns.append(pa.array([e.decode(np.frombuffer(x, np.int32)) == (t.as_py() or "")
                                         for x, t in zip(ids, batch.column(text_col), strict=True)], pa.bool_()))
            yield pa.RecordBatch.from_arrays(columns, [*batch.schema.names, *added])

    added = [out, *[check] * bool(check)]
    kept = docs.drop(*added)
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in kept.schema.fields)
    return kept.mapInArrow(encode, f"{fields}, `{out}` array<int>" + f", `{check}` boolean" * bool(check))


def decoded(rows: DataFrame, ids_col: str = "token_ids", path: str | None = None, out: str = "decoded") -> DataFrame:
    """``rows`` with ``out`` string: the text that the ids stand for (null ids: empty)."""
    where = path

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        e = encoder(where or model_path())
        for batch in batches:
            texts = [e.decode(x.values.to_numpy(zero_copy_only=False)) if x.is_valid else "" for x in batch.column(ids_col)]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(texts, pa.string())], [*batch.schema.names, out])

    kept = rows.drop(out)
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in kept.schema.fields)
    return kept.mapInArrow(decode, f"{fields}, `{out}` string")


def digests(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", path: str | None = None) -> DataFrame:
    """doc_id, n_tokens, ids_sha256 (hex of the ids as little-endian int32),
    decoded_sha256 (of the text read back), round_trip (it equals the text)."""
    import hashlib
    where = path
    kind = docs.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        e = encoder(where or model_path())
        for batch in slices(batches, "text"):
            texts = [t.as_py() or "" for t in batch.column("text")]
            ids = [e.encode(t) for t in texts]
            back = [e.decode(np.frombuffer(x, np.int32)) for x in ids]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array([len(x) // 4 for x in ids], pa.int64()),
                 pa.array([hashlib.sha256(x).hexdigest() for x in ids]),
                 pa.array([hashlib.sha256(t.encode()).hexdigest() for t in back]),
                 pa.array([a == b for a, b in zip(texts, back, strict=True)])],
                ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256", "round_trip"])

    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return rows.mapInArrow(run, f"doc_id {kind}, n_tokens long, ids_sha256 string, decoded_sha256 string, round_trip boolean")
