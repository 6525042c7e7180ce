"""Sum-of-squares online packing of token sequences.

Documents arrive one after the other. Windows that are neither empty nor complete are counted by fill level in one array.
A piece goes to the level, or to a new window, after which the sum of the squared counts is smallest, so that no level
gathers many windows that only a rare length would complete. A window whose fill is a power of two needs no padding; such
levels weigh nothing in the sum, but may be filled further.

Each task packs the documents of its own part of the table in the order in which they are stored. Documents are only cut
where they are longer than a window, and in the windows that are still open when a part ends: their pieces are laid end to
end, cut at every full window, and what is left is cut into powers of two. No sequence needs padding then.
"""

from __future__ import annotations

import json
import os
import re
import zlib
from collections import defaultdict
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import batches, byte_texts, list_array, map_arrow, table

WINDOW = 1024
# Open windows of a task that are held at most; beyond that, they are completed by cutting as at the end of a part.
MOST_OPEN = 8_192
# Sequence ids of one task lie together; a task makes fewer than 2^40 of them.
TASK_SHIFT = 40

# Texts of other characters go to the tokenizer's own engine: what counts as a letter there may depend on the edition of
# Unicode that an engine knows.
_OTHER = re.compile(r"[^\x00-ԯ -⁯₠-₿←-⯿ぁ-ゖァ-ヺ一-鿪"
                    r"가-힣\U0001f300-\U0001faff]")
_LONG_RUN = 2_000
_LONG_SPACE = re.compile(r"\s{%d}" % _LONG_RUN)


def default_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def _byte_of_char() -> dict[str, int]:
    """The characters that stand for bytes in a byte-level vocabulary: printable ones for themselves, others from 256 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + k): b for k, b in enumerate(rest)}


class Ids:
    """Token ids of texts by a ``tokenizers`` file.

    Byte-level BPE vocabularies whose ids follow their merges give the same ids in the faster engine of ``tiktoken``,
    which is used for them. Texts that hold a special token, letters of newer scripts, or a run of thousands of
    characters without a word boundary go to ``tokenizers`` itself, as do all texts of other kinds of files.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.own = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as f:
            self.fast = self._fast(json.load(f))
        self.special = re.compile("|".join(re.escape(x.content) for x in self.own.get_added_tokens_decoder().values()) or r"(?!)")

    @staticmethod
    def _fast(spec: dict):
        model, pre = spec["model"], spec.get("pre_tokenizer") or {}
        plain = not (spec.get("normalizer") or spec.get("post_processor") or spec.get("truncation") or spec.get("padding"))
        if not plain or model.get("type") != "BPE" or pre.get("type") != "ByteLevel" or pre.get("add_prefix_space") or not pre.get("use_regex"):
            return None
        if any(model.get(k) for k in ("dropout", "unk_token", "continuing_subword_prefix", "end_of_word_suffix", "byte_fallback", "ignore_merges")):
            return None
        import tiktoken

        chars, special = _byte_of_char(), {x["content"] for x in spec["added_tokens"]}
        ranks = {bytes(chars[c] for c in token): k for token, k in model["vocab"].items() if token not in special}
        merged = ["".join(x.split(" ") if isinstance(x, str) else x) for x in model["merges"]]
        if [model["vocab"][x] for x in merged] != list(range(256, 256 + len(merged))):
            return None
        # Fixed value: the pattern that byte-level pre-tokenization with its built-in expression stands for.
        pattern = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
        return tiktoken.Encoding("own", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})

    def _safe(self, text: str) -> bool:
        if not text.isascii() and _OTHER.search(text) or self.special.search(text):
            return False
        return len(text) < _LONG_RUN or (not _LONG_SPACE.search(text) and max(map(len, text.split()), default=0) < _LONG_RUN)

    def of(self, text: str) -> np.ndarray:
        if self.fast is not None and self._safe(text):
            return np.array(self.fast.encode_ordinary(text), np.uint32)
        return np.array(self.own.encode(text, add_special_tokens=False).ids, np.uint32)


@lru_cache(maxsize=4)
def ids_of(path: str) -> Ids:
    return Ids(path)


class Levels:
    """Counts of open windows by fill, and for each piece the level with the smallest sum of squares after it."""

    def __init__(self, window: int):
        self.window = window
        self.counts = np.zeros(window + 1, np.int64)
        self.weighs = np.ones(window + 1, np.int64)
        self.weighs[0] = self.weighs[window] = 0
        self.weighs[[1 << k for k in range(window.bit_length()) if 1 << k <= window]] = 0
        # What the sum changes by if a window leaves a level (impossible while there is none) or comes to it.
        self.never = np.int64(1) << 60
        self.leave = np.full(window + 1, self.never)
        self.leave[0] = 0
        self.come = self.weighs.copy()

    def _set(self, level: int, change: int) -> None:
        if not 0 < level < self.window:
            return
        self.counts[level] += change
        n, w = self.counts[level], self.weighs[level]
        self.leave[level] = w * (1 - 2 * n) if n else self.never
        self.come[level] = w * (2 * n + 1)

    def place(self, size: int) -> int:
        """The level that a piece of ``size`` ids goes to; among equals the fullest."""
        costs = self.leave[: self.window - size + 1] + self.come[size:]
        level = len(costs) - 1 - int(np.argmin(costs[::-1]))
        self._set(level, -1)
        self._set(level + size, 1)
        return level

    def sum_of_squares(self) -> int:
        return int((self.weighs * self.counts * self.counts).sum())


class Packer:
    """Places pieces (row, start, ids) into windows; ``done`` holds complete ones as lists of pieces."""

    def __init__(self, window: int, most_open: int):
        self.window, self.most_open = window, most_open
        self.done: list[list[tuple]] = []
        self._reset()

    def _reset(self) -> None:
        self.levels = Levels(self.window)
        self.open: dict[int, list[list[tuple]]] = defaultdict(list)
        self.n_open = 0

    def add(self, row: tuple, ids: np.ndarray) -> None:
        whole = len(ids) // self.window * self.window
        for k in range(0, whole, self.window):
            self.done.append([(row, k, ids[k : k + self.window])])
        if whole == len(ids):
            return
        piece = (row, whole, ids[whole:])
        size = len(ids) - whole
        level = self.levels.place(size)
        if level:
            pieces = self.open[level].pop()
        else:
            pieces, self.n_open = [], self.n_open + 1
        pieces.append(piece)
        if level + size == self.window:
            self.done.append(pieces)
            self.n_open -= 1
        else:
            self.open[level + size].append(pieces)
        if self.n_open > self.most_open:
            self.finish()

    def finish(self) -> None:
        """Completes all open windows: those of a power of two as they are, the others end to end and cut."""
        line = []
        for level in sorted(self.open):
            for pieces in self.open[level]:
                if level & (level - 1) == 0:
                    self.done.append(pieces)
                else:
                    line += pieces
        left = sum(len(x[2]) for x in line)
        now: list[tuple] = []
        room = size = self._next(left)
        for row, start, ids in line:
            while len(ids):
                part = ids[:room]
                now.append((row, start, part))
                start, ids, room = start + len(part), ids[len(part) :], room - len(part)
                if not room:
                    self.done.append(now)
                    left -= size
                    now, size = [], self._next(left)
                    room = size
        self._reset()

    def _next(self, left: int) -> int:
        """The length of the next sequence: a whole window, or the largest power of two that can still be filled."""
        return self.window if left >= self.window else 1 << (left.bit_length() - 1) if left else 0

    def take(self) -> list[list[tuple]]:
        out, self.done = self.done, []
        return out


PIECES = ("doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long, "
          "ids array<int>")


def _piece_rows(sequences: list[list[tuple]], first: int) -> pa.RecordBatch:
    rows = {c: [] for c in ("doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset")}
    every = []
    for k, pieces in enumerate(sequences):
        offset = 0
        for (doc_id, n), start, ids in pieces:
            for name, value in zip(rows, (doc_id, start, len(ids), zlib.crc32(ids.astype("<u4").tobytes()), n, first + k, offset), strict=True):
                rows[name].append(value)
            offset += len(ids)
            every.append(ids)
    columns = {name: pa.array(values, pa.int64()) for name, values in rows.items()}
    columns["ids"] = list_array(np.concatenate(every).view(np.int32), np.array([len(x) for x in every]), pa.int32())
    return batches(columns)


def pack_documents(docs: DataFrame, tokenizer: str | None = None, window: int = WINDOW, end_id: int = 0,
                   most_open: int = MOST_OPEN, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset, and the ids themselves.

    A document is its token ids and then ``end_id``; null or empty texts are that id alone. Every row is a document of its
    own, also repeated ones and ones with a null id, which stays null. A sequence has at most ``window`` ids (a power of
    two), and is full or has a power of two of them. Sequence ids don't depend on when a task runs, so a task that is run
    again gives the same rows. Other columns are ignored. An empty table gives an empty result.
    """
    if window < 1 or window & (window - 1):
        raise ValueError("a window must have a power of two ids")
    path = tokenizer or default_tokenizer()
    given = docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), F.col(f"`{text_col}`").cast("string").alias("text"))

    def run(items: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, packer = ids_of(path), Packer(window, most_open)
        after = TaskContext.get().partitionId() << TASK_SHIFT
        end = np.array([end_id], np.uint32)
        for batch in items:
            for doc_id, raw in zip(batch.column("doc_id").to_pylist(), byte_texts(batch.column("text")), strict=True):
                found = np.concatenate([ids.of(raw.decode("utf-8", "replace")), end])
                packer.add((doc_id, len(found)), found)
            if done := packer.take():
                yield _piece_rows(done, after)
                after += len(done)
        packer.finish()
        if done := packer.take():
            yield _piece_rows(done, after)

    return map_arrow(given, run, PIECES)


def sequences(pieces: DataFrame, window: int = WINDOW, pad_id: int = 0) -> DataFrame:
    """One row per sequence: sequence_id, input_ids, n_tokens and the starts of its pieces, for a loader.

    Input ids are padded to the window unless their number is a power of two. A sequence is bounded by its window.
    """
    grouped = pieces.groupBy("sequence_id").agg(F.sort_array(F.collect_list(F.struct("offset", "ids"))).alias("p"))
    ids = F.flatten(F.transform("p", lambda x: x["ids"]))
    n = F.size(ids)
    padded = F.when(F.bit_count(n) == 1, ids).otherwise(F.concat(ids, F.array_repeat(F.lit(pad_id), F.lit(window) - n)))
    return grouped.select("sequence_id", padded.alias("input_ids"), n.alias("n_tokens"),
                          F.transform("p", lambda x: x["offset"]).alias("starts"))


def op11_sum_of_squares_packing(spark, sf_dir: str) -> DataFrame:
    return pack_documents(table(spark, sf_dir, "documents")).drop("ids")
