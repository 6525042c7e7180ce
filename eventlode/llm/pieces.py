"""SentencePiece encoding and decoding as a weighted transducer.

A model compiles to three machines: the normaliser (a mark for each space, one before the text), the pieces, and the byte
pieces that stand for characters without one. Composed with a text they give a lattice whose arcs are pieces; the
encoding is its shortest path in the tropical semiring (the least sum of weights).

Unigram models weigh an arc by the piece's negative score. A model trained by merges has no such weights; its encoding is
the path on which every two neighbours are what merging their joined text gives. Its lattice therefore has an arc for
each pair of neighbours, of weight 0 if they agree and infinite otherwise, and the shortest path is the one of weight 0.
No piece holds a space mark after other characters, so the lattice falls apart before each run of marks, and also between
any two characters that no piece holds side by side. The paths of such parts are remembered.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import lru_cache
from heapq import heappop, heappush

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from .common import batches, byte_texts, ids_and_texts, list_array, map_arrow, table

MARK = "▁"
# Parts and pairs a task remembers before it starts anew (about 100 MB together).
MEMORY = 300_000


def default_model() -> str:
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


class Transducer:
    """A compiled model. It holds plain tables and can be sent to tasks."""

    def __init__(self, pieces: list[tuple[str, float, int]], unigram: bool, dummy_prefix: bool, squeeze: bool):
        # The format's piece types are 1 normal, 2 unknown, 3 control, 4 user-defined, 5 unused, 6 byte.
        self.words = [p for p, _, _ in pieces]
        self.arcs = {p: k for k, (p, _, kind) in enumerate(pieces) if kind in (1, 4)}
        self.weights = {p: -s for p, s, kind in pieces if kind in (1, 4)}
        self.bytes_ = [k for _, k in sorted((int(p[3:5], 16), k) for k, (p, _, kind) in enumerate(pieces) if kind == 6)]
        self.byte_of = {k: b for b, k in enumerate(self.bytes_)}
        self.unknown = next(k for k, (_, _, kind) in enumerate(pieces) if kind == 2)
        self.silent = {k for k, (_, _, kind) in enumerate(pieces) if kind == 3}
        self.longest = max(map(len, self.arcs), default=1)
        # Neighbouring characters that some piece holds. Between any others no arc can pass, so the lattice falls apart.
        self.joined = {x + y for piece in self.arcs for x, y in zip(piece, piece[1:])}
        special = set(self.bytes_) | self.silent | {self.unknown}
        self.special = np.array([k in special for k in range(len(pieces))], np.bool_)
        self.unigram, self.dummy_prefix, self.squeeze = unigram, dummy_prefix, squeeze
        inner = any(MARK in p.lstrip(MARK) for p in self.arcs)
        self.cut = None if inner else re.compile(f"{MARK}*[^{MARK}]+|{MARK}+")
        self.paths: dict[str, tuple[int, ...]] = {}
        self.pairs: dict[tuple[str, str], bool] = {}
        self.machine = None

    def __getstate__(self):
        return self.__dict__ | {"paths": {}, "pairs": {}, "machine": None}

    def _arcs_in(self, part: str):
        """(last place, piece) of every arc of a part's lattice, by place, longer pieces first."""
        if self.machine is None:
            self.machine = ahocorasick.Automaton()
            for piece in self.arcs:
                self.machine.add_word(piece, piece)
            self.machine.make_automaton()
        return self.machine.iter(part)

    def _cut_apart(self, part: str) -> Iterator[str]:
        at = 0
        for k in range(1, len(part)):
            if part[k - 1 : k + 1] not in self.joined:
                yield part[at:k]
                at = k
        yield part[at:]

    @classmethod
    def load(cls, path: str) -> Transducer:
        from sentencepiece import sentencepiece_model_pb2

        model = sentencepiece_model_pb2.ModelProto()
        with open(path, "rb") as f:
            model.ParseFromString(f.read())
        spec, kind = model.normalizer_spec, model.trainer_spec.model_type
        if spec.precompiled_charsmap:
            raise ValueError("models whose normaliser rewrites characters are not supported")
        if kind not in (1, 2):
            raise ValueError("only unigram and merge models are supported")
        return cls([(p.piece, p.score, p.type) for p in model.pieces], kind == 1, spec.add_dummy_prefix, spec.remove_extra_whitespaces)

    def normalise(self, text: str) -> str:
        if self.squeeze:
            text = re.sub(" +", " ", text.strip(" "))
        if not text:
            return ""
        return (MARK if self.dummy_prefix else "") + text.replace(" ", MARK)

    def merged(self, text: str) -> list[str]:
        """The pieces that merging leaves: the best pair first, the leftmost of equals. Pairs wait in a heap by weight and place."""
        parts: list[str | None] = list(text)
        after, before = list(range(1, len(parts) + 1)), list(range(-1, len(parts) - 1))
        waiting: list[tuple[float, int, str]] = []

        def offer(at: int) -> None:
            if at >= 0 and after[at] < len(parts):
                both = parts[at] + parts[after[at]]
                weight = self.weights.get(both)
                if weight is not None:
                    heappush(waiting, (weight, at, both))

        for k in range(len(parts)):
            offer(k)
        while waiting:
            _, at, both = heappop(waiting)
            # A pair is gone if one of its two parts has been merged since.
            if parts[at] is None or after[at] >= len(parts) or parts[at] + parts[after[at]] != both:
                continue
            gone = after[at]
            parts[at], parts[gone] = both, None
            after[at] = after[gone]
            if after[gone] < len(parts):
                before[after[gone]] = at
            offer(before[at])
            offer(at)
        return [x for x in parts if x is not None]

    def _agree(self, pair: tuple[str, str]) -> bool:
        found = self.pairs[pair] = self.merged(pair[0] + pair[1]) == [x for x in pair if x]
        return found

    def _merge_path(self, part: str) -> list[str]:
        """The path of weight 0, state by state: at each place only one last piece can be reached."""
        if part[:2] == MARK * 2:
            # Pieces of several marks weigh the same, so neighbours alone don't decide between them; the merges do.
            return self.merged(part)
        if len(part) == 1:
            return [part]
        # None: no path of weight 0 leads here.
        last: list[str | None] = ["", *[None] * len(part)]
        pairs = self.pairs
        for place, piece in self._arcs_in(part):
            end = place + 1
            if last[end] is None:
                before = last[end - len(piece)]
                if before is not None:
                    pair = (before, piece)
                    agree = pairs.get(pair)
                    if agree or (agree is None and self._agree(pair)):
                        last[end] = piece
        if last[-1] is None:
            return self.merged(part)
        out, at = [], len(part)
        while at:
            out.append(last[at])
            at -= len(last[at])
        return out[::-1]

    def _unigram_path(self, part: str) -> list[str]:
        """The path with the least sum of weights. Characters without a piece cost more than any piece."""
        fallback = max(self.weights.values(), default=0.0) + 10.0
        cost = [0.0] + [np.inf] * len(part)
        begin = [0] * (len(part) + 1)
        for end in range(1, len(part) + 1):
            for start in range(max(0, end - self.longest), end):
                weight = self.weights.get(part[start:end], fallback if start == end - 1 else np.inf)
                if cost[start] + weight < cost[end]:
                    cost[end], begin[end] = cost[start] + weight, start
        out, at = [], len(part)
        while at:
            out.append(part[begin[at] : at])
            at = begin[at]
        return out[::-1]

    def _ids(self, part: str) -> Iterator[int]:
        for piece in self._unigram_path(part) if self.unigram else self._merge_path(part):
            k = self.arcs.get(piece)
            if k is not None:
                yield k
            elif self.bytes_:
                yield from (self.bytes_[b] for b in piece.encode("utf-8", "surrogatepass"))
            else:
                yield self.unknown

    def _path(self, part: str) -> tuple[int, ...]:
        ids: list[int] = []
        for own in self._cut_apart(part):
            found = self.paths.get(own)
            if found is None:
                found = tuple(self._ids(own))
                if len(own) < 64:
                    self.paths[own] = found
            ids += found
        return tuple(ids)

    def encode(self, text: str) -> list[int]:
        if len(self.paths) > MEMORY:
            self.paths.clear()
        if len(self.pairs) > 2 * MEMORY:
            self.pairs.clear()
        paths, out = self.paths, []
        text = self.normalise(text)
        for part in (self.cut.findall(text) if self.cut else [text] if text else []):
            ids = paths.get(part)
            if ids is None:
                ids = self._path(part)
                if len(part) < 64:
                    paths[part] = ids
            out.extend(ids)
        return out

    def decode(self, ids: list[int]) -> str:
        """The inverse machine: pieces to text, runs of byte pieces as UTF-8 (broken ones as U+FFFD), marks to spaces."""
        words = self.words
        parts: list[str] = []
        run = bytearray()
        at = 0
        # Only byte, control and unknown pieces need a look of their own; the words between them are joined at once.
        for place in [*np.flatnonzero(self.special[np.array(ids, np.int64)]).tolist(), len(ids)]:
            if place > at:
                parts.append(run.decode("utf-8", "replace"))
                run.clear()
                parts.extend(map(words.__getitem__, ids[at:place]))
            at = place + 1
            if place == len(ids):
                break
            k = ids[place]
            b = self.byte_of.get(k)
            if b is not None:
                run.append(b)
            elif k not in self.silent:
                parts += [run.decode("utf-8", "replace"), " ⁇ "]
                run.clear()
            else:
                parts.append(run.decode("utf-8", "replace"))
                run.clear()
        parts.append(run.decode("utf-8", "replace"))
        text = "".join(parts).replace(MARK, " ")
        return text[1:] if self.dummy_prefix and text[:1] == " " else text


@lru_cache(maxsize=4)
def _compiled(path: str) -> Transducer:
    return Transducer.load(path)


_PIECES = "n_tokens long, ids array<int>, round_trip boolean"


def add_pieces(docs: DataFrame, model_path: str | None = None, text_col: str = "text") -> DataFrame:
    """``docs`` with n_tokens, ids and round_trip; columns of these names that it had before are replaced.

    The model is compiled on the driver and sent to the tasks, which need no file. Null and empty texts have no ids.
    ``round_trip``, whether decoding the ids gives the text back, is false for texts that hold the space mark itself,
    which decodes to a space. An empty table gives an empty result.
    """
    shared = docs.sparkSession.sparkContext.broadcast(_compiled(model_path or default_model()))
    given = docs.drop("n_tokens", "ids", "round_trip")
    names = given.columns

    def run(items: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        machine = shared.value
        for batch in items:
            found, same = [], []
            for raw in byte_texts(batch.column(text_col)):
                text = raw.decode("utf-8", "replace")
                ids = machine.encode(text)
                found.append(np.array(ids, np.int32))
                same.append(machine.decode(ids) == text)
            lengths = np.array([len(x) for x in found])
            yield batches({**{c: batch.column(c) for c in names}, "n_tokens": pa.array(lengths, pa.int64()),
                           "ids": list_array(np.concatenate(found), lengths, pa.int32()), "round_trip": pa.array(same, pa.bool_())})

    kinds = T._parse_datatype_string(_PIECES)
    return map_arrow(given, run, T.StructType([*given.schema.fields, *kinds.fields]))


def encode_pieces(docs: DataFrame, model_path: str | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: doc_id, n_tokens, ids and round_trip, as in ``add_pieces``. Null ids get their own rows."""
    return add_pieces(ids_and_texts(docs, id_col, text_col), model_path).drop("text")


def decode_pieces(encoded: DataFrame, model_path: str | None = None, id_col: str = "doc_id", ids_col: str = "ids") -> DataFrame:
    """(doc_id, text) from rows of ids. Null ids give an empty text."""
    shared = encoded.sparkSession.sparkContext.broadcast(_compiled(model_path or default_model()))

    def run(items: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in items:
            texts = [shared.value.decode(x or []) for x in batch.column(1).to_pylist()]
            yield batches({"doc_id": batch.column(0), "text": pa.array(texts, pa.string())})

    return map_arrow(encoded.selectExpr(f"cast(`{id_col}` as bigint) as doc_id", f"`{ids_col}` as ids"), run, "doc_id long, text string")


def op2_sentencepiece(spark, sf_dir: str) -> DataFrame:
    return encode_pieces(table(spark, sf_dir, "documents"))
