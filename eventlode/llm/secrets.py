"""Secret scans over a trigram index, in DataFrame functions only.

Each rule's regular expression yields a Boolean trigram query: an OR over the ways through the pattern, each the AND of
the trigrams any match on that way must contain. The index holds, for every trigram some rule asks for, the documents
whose lower-cased text contains it. Intersected postings give each rule's candidate documents, and only these are
verified with the rule itself. A rule whose pattern can match without any fixed trigram scans all texts.
"""

from __future__ import annotations

import re
from dataclasses import dataclass
from itertools import product

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from eventlode.session import materialize

from .common import ids_and_texts, table


@dataclass(frozen=True)
class Rule:
    """A kind of secret. Matches are leftmost and don't overlap; those whose ``group`` is shorter than ``least`` go."""

    kind: str
    pattern: str
    group: int = 0
    least: int = 0
    base: bool = False


# What is looked for.
RULES = (
    Rule("assign", r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 6, True),
    Rule("access", r"AKIA[A-Z0-9]+", 0, 20, True),
    # Runs of [0-9a-f] can't be cut short by a neighbour, so asking for 24 at once finds the same matches as filtering.
    Rule("hex", r"[0-9a-f]{24,}", 0, 24, True),
    Rule("private_key", r"-----BEGIN [A-Z ]{0,40}PRIVATE KEY-----"),
    Rule("hub_token", r"gh[pousr]_[A-Za-z0-9]{36,}"),
    Rule("chat_token", r"xox[abprs]-[A-Za-z0-9-]{10,}"),
    Rule("maps_key", r"AIza[A-Za-z0-9_-]{35}"),
    Rule("web_token", r"eyJ[A-Za-z0-9_-]{8,}\.eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}"),
    Rule("pay_key", r"sk_live_[A-Za-z0-9]{24,}"),
)
# More ways through a pattern than this are not told apart; such a part then counts as unknown text.
MOST_WAYS = 64
SMALL_SET = 6


def _ways(items) -> list[list[str | None]]:
    """Ways through a parsed pattern: lists of fixed characters, with None for text that isn't fixed."""
    ways: list[list[str | None]] = [[]]
    for op, value in items:
        name = str(op)
        if name == "LITERAL":
            here = [[chr(value)]]
        elif name == "IN" and all(str(o) == "LITERAL" for o, _ in value) and len(value) <= SMALL_SET:
            here = [[chr(v)] for _, v in value]
        elif name == "SUBPATTERN":
            here = _ways(value[3])
        elif name == "BRANCH":
            here = [w for branch in value[1] for w in _ways(branch)]
        elif name == "MAX_REPEAT" and value[0] == 0 and value[1] == 1:
            here = [[], *_ways(value[2])]
        elif name == "MAX_REPEAT" and value[0] > 0:
            once = _ways(value[2])
            here = [w * value[0] if value[0] == value[1] else w * value[0] + [None] for w in once] if value[0] * len(once) <= 8 else [[None]]
        elif name == "AT":
            here = [[]]
        else:
            here = [[None]]
        if len(ways) * len(here) > MOST_WAYS:
            here = [[None]]
        ways = [a + b for a, b in product(ways, here)]
    return ways


def trigram_query(pattern: str) -> frozenset[frozenset[str]] | None:
    """The pattern's query: sets of trigrams, of which one must be contained wholly. None: nothing is mandatory."""
    query = set()
    for way in _ways(re._parser.parse(pattern)):
        fixed = "".join("\0" if c is None else c for c in way).lower()
        terms = frozenset(fixed[i : i + 3] for i in range(len(fixed) - 2) if "\0" not in fixed[i : i + 3])
        if not terms:
            return None
        query.add(terms)
    # A way whose terms include another's adds nothing.
    return frozenset(q for q in query if not any(p < q for p in query))


def build_index(docs: DataFrame, trigrams: list[str]) -> DataFrame:
    """Postings (trigram, key) of the given trigrams over the lower-cased texts of ``docs`` (key, text)."""
    low = docs.select("key", F.lower("text").alias("low"))
    held = F.array_compact(F.array(*[F.when(F.contains("low", F.lit(t)), F.lit(t)) for t in trigrams]))
    return low.select("key", F.explode(held).alias("trigram"))


def candidates(postings: DataFrame, queries: dict[int, frozenset[frozenset[str]]]) -> DataFrame:
    """key and ``rules``, the bits of the rules whose query the key's trigrams meet."""
    terms = [(rule, way, len(terms), t) for rule, query in queries.items()
             for way, terms in enumerate(sorted(query, key=sorted)) for t in sorted(terms)]
    # One row per term of the rules, whatever the size of the data.
    wanted = F.broadcast(postings.sparkSession.createDataFrame(terms, "rule int, way int, n int, trigram string"))
    met = postings.join(wanted, "trigram").groupBy("key", "rule", "way").agg(
        F.countDistinct("trigram").alias("held"), F.first("n").alias("n")).where("held = n")
    return met.groupBy("key").agg(F.bit_or(F.expr("shiftleft(1L, rule)")).alias("rules"))


def spans_of(text: Column, rule: Rule, order: int) -> Column:
    """The rule's matches in a text: array of (start, order, end), in code points.

    The text between matches and the matches alternate, so running sums of their lengths are the positions.
    """
    between = F.transform(F.split(text, rule.pattern, -1), F.char_length)
    matches = F.regexp_extract_all(text, F.lit(rule.pattern), F.lit(0))
    fits = F.transform(matches, lambda m: F.struct(
        F.char_length(m).alias("size"),
        (F.char_length(F.regexp_extract(m, rule.pattern, rule.group)) >= rule.least).alias("fits")))
    pairs = F.arrays_zip(between.alias("gap"), fits.alias("match"))
    start = F.struct(F.lit(0).cast("long").alias("at"), F.array().cast("array<struct<start:bigint,order:int,end:bigint>>").alias("found"))

    def step(acc: Column, pair: Column) -> Column:
        at = acc["at"] + pair["gap"]
        end = at + pair["match"]["size"]
        span = F.struct(at.cast("long").alias("start"), F.lit(order).alias("order"), end.cast("long").alias("end"))
        return F.struct(F.coalesce(end, at).cast("long").alias("at"),
                        F.when(pair["match"]["fits"], F.array_append(acc["found"], span)).otherwise(acc["found"]).alias("found"))

    return F.aggregate(pairs, start, step)["found"]


def _flagged(docs: DataFrame, rules: tuple[Rule, ...]) -> DataFrame:
    """``docs`` (key, text, ...) with ``spans``: array of (start, order, end), sorted."""
    queries = {k: trigram_query(r.pattern) for k, r in enumerate(rules)}
    scanned = [k for k, q in queries.items() if q is None]
    indexed = {k: q for k, q in queries.items() if q is not None}
    if indexed:
        trigrams = sorted({t for q in indexed.values() for way in q for t in way})
        postings = materialize(build_index(docs.select("key", "text"), trigrams), "secrets-index")
        flagged = docs.join(candidates(postings, indexed), "key", "left")
    else:
        flagged = docs.withColumn("rules", F.lit(0).cast("long"))
    bits = F.coalesce("rules", F.lit(0).cast("long")).bitwiseOR(F.lit(sum(1 << k for k in scanned)).cast("long"))
    empty = F.array().cast("array<struct<start:bigint,order:int,end:bigint>>")
    found = []
    for k, rule in enumerate(rules):
        verify = bits.bitwiseAND(F.lit(1 << k).cast("long")) != 0
        found.append(F.when(verify & F.col("text").rlike(rule.pattern), spans_of(F.col("text"), rule, k)).otherwise(empty))
    return flagged.withColumn("spans", F.array_sort(F.concat(*found))).drop("rules")


def find_secrets(docs: DataFrame, rules: tuple[Rule, ...] = RULES, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: doc_id, text and ``spans``, an array of (start, order, end) sorted by these.

    ``order`` is the rule's place in ``rules``; positions are code points, the end exclusive. Null text counts as empty
    and has no spans. Repeated rows and null ids get their own rows. An empty table gives an empty result.
    """
    base = ids_and_texts(docs, id_col, text_col).select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    keyed = base.select(F.xxhash64("doc_id", "text").alias("key"), "doc_id", "text")
    return _flagged(keyed, rules).drop("key")


def named_spans(spans: Column, rules: tuple[Rule, ...]) -> Column:
    kinds = F.array(*[F.lit(r.kind) for r in rules])
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", F.get(kinds, s["order"]), s["start"], s["end"])), ",")


def redact_secrets(docs: DataFrame, rules: tuple[Rule, ...] = RULES, text_col: str = "text") -> DataFrame:
    """``docs`` with every secret replaced by ``[kind]``; overlapping spans become one, named after the first.

    All columns and rows stay; null texts stay null. ``n_chars``, if there is such a column, is counted anew for texts
    that change.
    """
    kinds = F.array(*[F.lit(r.kind) for r in rules])
    columns = docs.columns
    held = docs.select(F.struct(*[F.col(f"`{c}`") for c in columns]).alias("row"), F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit("")).alias("text"))
    found = _flagged(held.withColumn("key", F.xxhash64("text")), rules).drop("key")

    start = F.struct(F.lit(0).cast("long").alias("at"), F.array().cast("array<string>").alias("parts"))

    def step(acc: Column, s: Column) -> Column:
        # A span that begins inside the text already replaced only moves the place where copying goes on.
        gap = F.substring(F.col("text"), (acc["at"] + 1).cast("int"), (s["start"] - acc["at"]).cast("int"))
        tag = F.concat(gap, F.lit("["), F.get(kinds, s["order"]), F.lit("]"))
        return F.struct(F.greatest(acc["at"], s["end"]).alias("at"),
                        F.when(s["start"] >= acc["at"], F.array_append(acc["parts"], tag)).otherwise(acc["parts"]).alias("parts"))

    done = F.aggregate("spans", start, step)
    rest = F.substring(F.col("text"), (F.col("done.at") + 1).cast("int"), F.char_length("text"))
    clean = found.select("row", "text", "spans", done.alias("done")).select(
        "row", "spans", F.when(F.size("spans") > 0, F.concat(F.array_join("done.parts", ""), rest)).alias("clean"))
    out = []
    for c in columns:
        now = F.col("row")[c]
        if c == text_col:
            now = F.coalesce("clean", now)
        elif c == "n_chars":
            now = F.when(F.col("clean").isNotNull(), F.char_length("clean").cast(docs.schema[c].dataType)).otherwise(now)
        out.append(now.alias(c))
    return clean.select(*out)


def op5_secret_scan(spark, sf_dir: str) -> DataFrame:
    found = find_secrets(table(spark, sf_dir, "documents"))
    base = F.filter("spans", lambda s: s["order"] < sum(r.base for r in RULES))

    def count(k: int) -> Column:
        return F.size(F.filter("spans", lambda s: s["order"] == k)).cast("long")

    return found.select(
        "doc_id", count(0).alias("n_assign"), count(1).alias("n_access"), count(2).alias("n_hex"),
        F.sha2(named_spans(base, RULES), 256).alias("base_sha256"), named_spans(F.col("spans"), RULES).alias("spans"))
