"""Quality rules as a short-circuit cascade.

Each rule looks at a text and either rejects it or passes it on. On a bounded sample every rule is timed alone and its
rejections are counted; the rules then run in the order of rejections per second, and a text stops at the first rule
that rejects it. The order changes the time taken, never the verdict.
"""

from __future__ import annotations

import time
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import cached_property

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import batches, byte_texts, covered, ids_and_texts, map_arrow, table

SYMBOLS = b"#*$%&|<>"
WINDOW = 8
# Rows on which costs and selectivities are estimated. They only decide the order of the rules.
SAMPLE_ROWS = 1000


class Measures:
    """What rules ask about one text; each value is computed at most once and only if asked for."""

    def __init__(self, raw: bytes):
        self.raw = raw

    @cached_property
    def words(self) -> list[bytes]:
        return self.raw.split()

    @cached_property
    def n_words(self) -> int:
        return len(self.words)

    @cached_property
    def word_chars(self) -> int:
        joined = np.frombuffer(b"".join(self.words), np.uint8)
        return int(np.count_nonzero((joined & 0xC0) != 0x80))

    @cached_property
    def n_symbols(self) -> int:
        return len(self.raw) - len(self.raw.translate(None, SYMBOLS))

    @cached_property
    def lines(self) -> list[bytes]:
        return [x for x in self.raw.split(b"\n") if x.strip()]

    @cached_property
    def n_dup_lines(self) -> int:
        return len(self.lines) - len(set(self.lines))

    @cached_property
    def n_repeat_words(self) -> int:
        """Words in windows of eight that occur again. Windows get exact ids by doubling: words, pairs, fours, eights."""
        n = self.n_words
        if n <= WINDOW:
            return 0
        seen: dict[bytes, int] = {}
        ids = np.fromiter((seen.setdefault(w, len(seen)) for w in self.words), np.int64, n)
        counts = None
        for step in (1, 2, 4):
            pairs = ids[:-step] * (n + 1) + ids[step:]
            _, ids, counts = np.unique(pairs, return_inverse=True, return_counts=True)
        again = np.flatnonzero(counts[ids] > 1)
        return int(np.count_nonzero(covered(again, WINDOW, n))) if len(again) else 0

    @cached_property
    def upper_share(self) -> float:
        raw = np.frombuffer(self.raw, np.uint8)
        upper = np.count_nonzero((raw >= 65) & (raw <= 90))
        lower = np.count_nonzero((raw >= 97) & (raw <= 122))
        return upper / max(1, upper + lower)


@dataclass(frozen=True)
class Rule:
    name: str
    rejects: Callable[[Measures], bool]


BASE_RULES = (
    Rule("few_words", lambda m: m.n_words < 20),
    Rule("repeated_windows", lambda m: 100 * m.n_repeat_words > 30 * m.n_words),
)
RULES = BASE_RULES + (
    Rule("symbols", lambda m: 100 * m.n_symbols > 20 * m.n_words),
    Rule("duplicate_lines", lambda m: 100 * m.n_dup_lines > 50 * len(m.lines)),
    Rule("exclamations", lambda m: 100 * m.raw.count(b"!") > 30 * m.n_words),
    Rule("shouting", lambda m: m.upper_share > 0.6),
    Rule("word_length", lambda m: not 2 * m.n_words <= m.word_chars <= 20 * m.n_words),
)


def estimate(docs: DataFrame, rules: tuple[Rule, ...] = RULES, sample_rows: int = SAMPLE_ROWS) -> list[dict]:
    """Cost and selectivity of each rule: rows of rule, seconds, rejected, tried.

    The sample is the rows whose ids hash no higher than the ``sample_rows``-th lowest. It is measured where it is stored: only
    the hash bound and the rules' sums reach the driver, and no text moves. Where an id has very many rows, a task measures
    ``sample_rows`` of them. An empty table gives zero rows tried.
    """
    key = F.xxhash64("doc_id")
    bound = docs.select(key.alias("key")).orderBy("key").limit(sample_rows).agg(F.max("key").alias("bound")).first().bound
    if bound is None:
        return [{"rule": r.name, "seconds": 0.0, "rejected": 0, "tried": 0} for r in rules]

    def measure(items: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seconds, rejected, tried = [0.0] * len(rules), [0] * len(rules), 0
        for batch in items:
            texts = byte_texts(batch.column("text").slice(0, sample_rows - tried))
            tried += len(texts)
            for k, rule in enumerate(rules):
                fresh = [Measures(x) for x in texts]
                start = time.perf_counter()
                rejected[k] += sum(bool(rule.rejects(m)) for m in fresh)
                seconds[k] += time.perf_counter() - start
        if tried:
            yield batches({
                "rule": pa.array([r.name for r in rules]), "seconds": pa.array(seconds, pa.float64()),
                "rejected": pa.array(rejected, pa.int64()), "tried": pa.array([tried] * len(rules), pa.int64()),
            })

    chosen = docs.where(key <= bound).select("text")
    rows = (map_arrow(chosen, measure, "rule string, seconds double, rejected long, tried long").groupBy("rule")
            .agg(*[F.sum(c).alias(c) for c in ("seconds", "rejected", "tried")]).collect())
    return [r.asDict() for r in rows]


def ordered(rules: tuple[Rule, ...], figures: list[dict]) -> tuple[Rule, ...]:
    """Rules by rejections per second, most first; listed order where nothing was measured."""
    worth = {f["rule"]: f["rejected"] / max(f["seconds"], 1e-9) for f in figures}
    return tuple(sorted(rules, key=lambda r: -worth.get(r.name, 0.0)))


def first_rejection(measures: Measures, rules: tuple[Rule, ...]) -> str | None:
    for rule in rules:
        if rule.rejects(measures):
            return rule.name
    return None


def keep_quality(docs: DataFrame, rules: tuple[Rule, ...] = RULES, sample_rows: int = SAMPLE_ROWS,
                 id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that no rule rejects, with all their columns as they were.

    Null and empty texts have no words and are rejected by ``few_words``. Repeated rows are judged alike and all kept or
    all dropped. An empty table stays empty.
    """
    cascade = ordered(rules, estimate(ids_and_texts(docs, id_col, text_col), rules, sample_rows))
    at = docs.columns.index(text_col)

    def run(items: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in items:
            mask = [first_rejection(Measures(x), cascade) is None for x in byte_texts(batch.column(at))]
            yield batch.filter(pa.array(mask, pa.bool_()))

    return map_arrow(docs, run, docs.schema)


def measure_quality(docs: DataFrame, rules: tuple[Rule, ...] = RULES, sample_rows: int = SAMPLE_ROWS,
                    id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: doc_id, the measures, ``base_failed`` and ``kept``.

    ``base_failed`` asks the two base rules, ``kept`` the whole cascade, which contains them. Null text counts as empty:
    all measures zero, not kept. A null id stays null.
    """
    base = ids_and_texts(docs, id_col, text_col)
    cascade = ordered(rules, estimate(base, rules, sample_rows))
    columns = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")

    def run(items: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in items:
            values, failed, kept = [], [], []
            for raw in byte_texts(batch.column("text")):
                m = Measures(raw)
                kept.append(first_rejection(m, cascade) is None)
                failed.append(any(r.rejects(m) for r in BASE_RULES))
                values.append([getattr(m, c) for c in columns])
            table_ = np.array(values, np.int64).reshape(-1, len(columns))
            yield batches({
                "doc_id": batch.column("doc_id"),
                **{c: pa.array(table_[:, k]) for k, c in enumerate(columns)},
                "base_failed": pa.array(failed, pa.bool_()), "kept": pa.array(kept, pa.bool_()),
            })

    return map_arrow(base, run, "doc_id long, " + ", ".join(f"{c} long" for c in columns)
                     + ", base_failed boolean, kept boolean")


def op8_quality_rules(spark, sf_dir: str) -> DataFrame:
    return measure_quality(table(spark, sf_dir, "documents"))
