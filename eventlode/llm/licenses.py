"""License scans by conditional compression.

A candidate block is as many words around a license word as a template can span, wherever lines end; blocks that meet are one.
It is compressed alone and with each template as a raw dictionary. Templates that save bytes are tried, most bytes first: their
notices are confirmed by the exact differences in wording and cut out, and what is left is ranked again, until no template saves
anything. What is left of the runs of lines with license words is reported with the template that shrinks it best, unconfirmed.
"""

from __future__ import annotations

import re
from bisect import bisect_left
from collections import defaultdict
from collections.abc import Iterator
from difflib import SequenceMatcher

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import batches, byte_texts, ids_and_texts, map_arrow, table

# Short names and wordings of public licenses, and the words that mark a candidate line.
TEMPLATES = {
    "Apache-2.0": "Licensed under the Apache License, Version 2.0.",
    "Apache-2.0-header": "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0. Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing permissions and limitations under the License.",
    "BSD-2-Clause": "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: 1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer. 2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution.",
    "BSD-3-Clause": "Licensed under the BSD 3-Clause License.",
    "CC-BY-4.0": "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    "CC-BY-NC-4.0": "Licensed under CC BY-NC 4.0.",
    "CC-BY-SA-4.0": "Licensed under CC BY-SA 4.0.",
    "CC0-1.0": "This work has been dedicated to the public domain under CC0 1.0 Universal license.",
    "GPL-2.0": "This work is licensed under the GNU General Public License, version 2.",
    "GPL-3.0": "This work is licensed under the GNU General Public License, version 3.",
    "GPL-3.0-header": "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version. This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU General Public License for more details.",
    "LGPL-3.0": "This work is licensed under the GNU Lesser General Public License, version 3.",
    "MIT": "Released under the MIT License.",
    "MIT-text": "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions: The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.",
    "MPL-2.0": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/.",
}
CUES = ("licens", "licenc", "copyright", "warrant", "permission is hereby", "redistribut", "spdx", "free software", "public domain")
# Bytes of a line above which it is cut at sentence ends, and lines without a cue that a block may bridge.
LONG_LINE, BRIDGE = 1_000, 2
# Share of the template's words a block must have.
LEAST_SHARE = 0.8
# Characters compressed at once, and bytes compression is tuned to, with a template and without alike.
PIECE, TUNED_TO = 4_096, 8_192
# Passages whose reductions a task remembers.
MEMORY = 10_000

_WORD = re.compile(r"[a-z0-9]+(?:[.-][a-z0-9]+)*")
_ANY_WORD = re.compile(r"[A-Za-z0-9]+(?:[.-][A-Za-z0-9]+)*")
_CUE = re.compile("|".join(map(re.escape, CUES)), re.IGNORECASE)


def words_of(text: str) -> list[str]:
    return _WORD.findall(text.lower())


def blocks_of(text: str) -> Iterator[tuple[int, int]]:
    """(start, end) of the candidate blocks, in code points: runs of lines with cues, small gaps bridged."""
    spans = []
    for line in re.finditer(r"[^\n]+", text):
        if len(line[0]) <= LONG_LINE:
            spans.append(line.span())
        else:
            at = line.start()
            for stop in re.finditer(r"[.!?](?= |$)", line[0]):
                spans.append((at, line.start() + stop.end()))
                at = line.start() + stop.end() + 1
            if at < line.end():
                spans.append((at, line.end()))
    found: list[list[int]] = []
    for k, (start, end) in enumerate(spans):
        low = text[start:end].lower()
        if any(c in low for c in CUES):
            if found and k - found[-1][2] <= BRIDGE + 1:
                found[-1][1:] = [end, k]
            else:
                found.append([start, end, k])
    for start, end, _ in found:
        yield start, end


class Neighbours:
    """Spans of words, none longer than ``longest``, found again by those that overlap them."""

    def __init__(self, longest: int):
        self.longest = max(1, longest)
        self.held: defaultdict[int, list[tuple[list[int], tuple]]] = defaultdict(list)

    def add(self, places: list[int], item: tuple) -> bool:
        self.held[places[0] // self.longest].append((places, item))
        return True

    def overlapping(self, places: list[int]) -> list[tuple]:
        slots = range(places[0] // self.longest - 1, places[-1] // self.longest + 1)
        return [item for slot in slots for own, item in self.held.get(slot, ()) if own[0] <= places[-1] and places[0] <= own[-1]]


class Matcher:
    """The templates, compiled for comparison."""

    def __init__(self, templates: dict[str, str]):
        self.words = {name: words_of(text) for name, text in templates.items()}
        # Words that a notice and what is put between its words can span.
        self.reach = {name: 2 * len(words) + 8 for name, words in self.words.items()}
        self.furthest = max(self.reach.values(), default=0)
        # One set of parameters, or sizes would differ by more than what a template saves.
        self.parameters = zstandard.ZstdCompressionParameters.from_level(3, source_size=TUNED_TO)
        self.plain = zstandard.ZstdCompressor(compression_params=self.parameters)
        self.with_template = {
            name: zstandard.ZstdCompressor(compression_params=self.parameters, dict_data=zstandard.ZstdCompressionDict(
                text.lower().encode(), dict_type=zstandard.DICT_TYPE_RAWCONTENT))
            for name, text in templates.items()}
        self.ranked: dict[str, list[tuple[int, str]]] = {}

    def reductions(self, block: str) -> list[tuple[int, str]]:
        """Bytes saved by each template, most first; ties by name. Long blocks are compressed in pieces, losses counting 0."""
        ranked = self.ranked.get(block)
        if ranked is None:
            saved = dict.fromkeys(self.with_template, 0)
            pieces = [block[k : k + PIECE].lower().encode("utf-8", "replace") for k in range(0, len(block), PIECE)]
            for data in pieces:
                alone = len(self.plain.compress(data))
                for name, c in self.with_template.items():
                    less = alone - len(c.compress(data))
                    saved[name] += less if len(pieces) == 1 else max(0, less)
            ranked = sorted(((k, name) for name, k in saved.items()), key=lambda x: (-x[0], x[1]))
            if len(block) <= PIECE:
                if len(self.ranked) >= MEMORY:
                    self.ranked.clear()
                self.ranked[block] = ranked
        return ranked

    def wording(self, block: list[str], name: str) -> tuple[int, list[str], list[str]]:
        """Words in common in order, the template's words that are missing, and other words among those in common."""
        template = self.words[name]
        matches = [m for m in SequenceMatcher(None, template, block, autojunk=False).get_matching_blocks() if m.size]
        held = {m.a + k for m in matches for k in range(m.size)}
        missing = [w for k, w in enumerate(template) if k not in held]
        extra = []
        for one, two in zip(matches, matches[1:], strict=False):
            extra += block[one.b + one.size : two.b]
        return len(held), missing, extra

    def judge(self, block: str) -> dict:
        """The license of a block: the first in order of bytes saved that its wording confirms, else the one that saves most.

        It is confirmed if the block has enough of the template's words and all of its words with digits (versions).
        """
        words = words_of(block)
        best = None
        for saved, name in self.reductions(block):
            if saved <= 0:
                break
            held, missing, extra = self.wording(words, name)
            ok = held >= LEAST_SHARE * len(self.words[name]) and not any(c.isdigit() for w in missing for c in w)
            if ok or best is None:
                best = {"license": name, "saved_bytes": saved, "missing": missing, "extra": extra, "confirmed": ok}
            if ok:
                break
        return best or {"license": None, "saved_bytes": 0, "missing": [], "extra": [], "confirmed": False}

    def occurrences(self, words: list[str], name: str) -> list[tuple[int, list[int], list[str], list[str]]]:
        """(words in common less differences, places of the common words, missing, extra) of a template's confirmed notices."""
        template, reach = self.words[name], self.reach[name]
        own, versions = set(template), {w for w in template if any(c.isdigit() for c in w)}
        if not template or not versions <= set(words):
            return []
        inside = np.concatenate([[0], np.cumsum([w in own for w in words])])
        starts = np.flatnonzero(np.diff(inside))
        ends = np.minimum(starts + reach, len(words))
        starts = starts[inside[ends] - inside[starts] >= LEAST_SHARE * len(template)]
        found, last, step = [], -len(words), len(template) // 16
        matcher = SequenceMatcher(None, autojunk=False)
        for start in starts.tolist():
            # A window may begin a few words early: it still holds the notice.
            if start < last + step:
                continue
            last = start
            part = words[start : start + reach]
            matcher.set_seqs(template, part)
            matches = [m for m in matcher.get_matching_blocks() if m.size]
            held = {m.a + k for m in matches for k in range(m.size)}
            places = [start + m.b + k for m in matches for k in range(m.size)]
            missing = [w for k, w in enumerate(template) if k not in held]
            if len(held) < LEAST_SHARE * len(template) or versions & set(missing):
                continue
            within = set(places)
            extra = [words[k] for k in range(places[0], places[-1]) if k not in within]
            if len(held) > len(missing) + len(extra):
                found.append((len(held) - len(missing) - len(extra), places, missing, extra))
        near = Neighbours(self.furthest)
        return [x for x in sorted(found, key=lambda x: (-x[0], x[1])) if not near.overlapping(x[1]) and near.add(x[1], x)]

    def in_block(self, text: str, tokens: list[tuple[int, int, str]]) -> list[tuple]:
        """The confirmed notices of one candidate block, its words being ``tokens``.

        Templates have their turn by the bytes they save on what is left of the block. A notice is cut out if its template is
        also the one that saves most on the notice alone; others may turn out to be a similar template's, and stay.
        """
        words = [t[2] for t in tokens]
        begin, stop = tokens[0][0], tokens[-1][1]
        left = np.ones(stop - begin, np.bool_)
        rest, tried, found = text[begin:stop], set(), []
        while True:
            name = next((n for saved, n in self.reductions(rest) if saved > 0 and n not in tried), None)
            if name is None:
                break
            tried.add(name)
            cut = False
            for x in self.occurrences(words, name):
                start, end = tokens[x[1][0]][0], tokens[x[1][-1]][1]
                saved, best = self.reductions(text[start:end])[0]
                if best != name:
                    saved = next(k for k, n in self.reductions(text[start:end]) if n == name)
                if saved > 0:
                    found.append((*x, name, saved))
                    if best == name:
                        # Other words between the notice's own stay: they may belong to another notice, as in a dual license.
                        for one, two in zip(x[1], [*x[1][1:], None], strict=True):
                            stop_at = tokens[two][0] if two == one + 1 else tokens[one][1]
                            left[tokens[one][0] - begin : stop_at - begin] = False
                        cut = True
            if cut:
                edges = np.flatnonzero(np.diff(np.concatenate([[False], left, [False]]).astype(np.int8)))
                rest = " ".join(text[begin + lo : begin + hi] for lo, hi in edges.reshape(-1, 2).tolist())
        # Where notices of several templates overlap, exact wording settles which of them stand.
        near, chosen = Neighbours(self.furthest), []
        for x in sorted(found, key=lambda x: (-x[0], x[1], x[4])):
            if all(self._stands_beside(words, x, y) for y in near.overlapping(x[1])):
                near.add(x[1], x)
                chosen.append(x)
        return chosen

    def licenses(self, text: str) -> list[dict]:
        """All confirmed notices in a text, by place.

        Notices may share words, as in a dual license. One that overlaps a better one counts only if most of the words
        that tell its template from the other's are there besides, or half of them and no other word between.
        """
        tokens = [(m.start(), m.end(), m[0].lower()) for m in _ANY_WORD.finditer(text)]
        begins = [t[0] for t in tokens]
        regions: list[list[int]] = []
        for cue in _CUE.finditer(text):
            at = bisect_left(begins, cue.start())
            lo, hi = max(0, at - self.furthest), at + self.furthest
            if regions and lo <= regions[-1][1]:
                regions[-1][1] = hi
            else:
                regions.append([lo, hi])
        rows = []
        for lo, hi in regions:
            block = tokens[lo:hi]
            if block:
                rows += [{"block_start": block[places[0]][0], "block_end": block[places[-1]][1], "license": name, "saved_bytes": saved,
                          "missing": missing, "extra": extra, "confirmed": True}
                         for _, places, missing, extra, name, saved in self.in_block(text, block)]
        return sorted(rows, key=lambda r: (r["block_start"], r["block_end"], r["license"]))

    def _stands_beside(self, words: list[str], one: tuple, other: tuple) -> bool:
        telling = set(self.words[one[4]]) - set(self.words[other[4]])
        used = set(other[1])
        own = 2 * len({words[k] for k in one[1] if k not in used} & telling)
        return own > len(telling) or (own == len(telling) > 0 and not one[3])


def left_of(start: int, end: int, rows: list[dict]) -> Iterator[tuple[int, int]]:
    """The parts of a block outside the confirmed notices."""
    for row in rows:
        if row["block_start"] < end and start < row["block_end"]:
            if start < row["block_start"]:
                yield start, row["block_start"]
            start = row["block_end"]
    if start < end:
        yield start, end


_SCHEMA = ("doc_id long, block_start long, block_end long, license string, saved_bytes long, missing array<string>, "
           "extra array<string>, confirmed boolean")


def scan_licenses(docs: DataFrame, templates: dict[str, str] | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per confirmed notice, and per other candidate block: doc_id, its span, the best license, bytes saved,
    differing words, and ``confirmed``.

    Blocks that no template shrinks have a null license. Texts without license words, null and empty texts give no rows.
    Repeated rows and null ids give their own rows. An empty table gives an empty result.
    """
    chosen = templates or TEMPLATES

    def run(items: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        matcher = Matcher(chosen)
        known: dict[str, dict] = {}
        for batch in items:
            rows = []
            for doc_id, raw in zip(batch.column("doc_id").to_pylist(), byte_texts(batch.column("text")), strict=True):
                text = raw.decode("utf-8", "replace")
                confirmed = matcher.licenses(text)
                rows += [{"doc_id": doc_id, **row} for row in confirmed]
                for start, end in (x for block in blocks_of(text) for x in left_of(*block, confirmed)):
                    block = text[start:end]
                    if not _CUE.search(block):
                        continue
                    if block not in known:
                        if len(known) >= MEMORY:
                            known.clear()
                        known[block] = {**matcher.judge(block), "confirmed": False}
                    rows.append({"doc_id": doc_id, "block_start": start, "block_end": end, **known[block]})
            if rows:
                yield pa.RecordBatch.from_pylist(rows, pa.schema([
                    ("doc_id", pa.int64()), ("block_start", pa.int64()), ("block_end", pa.int64()), ("license", pa.string()), ("saved_bytes", pa.int64()),
                    ("missing", pa.list_(pa.string())), ("extra", pa.list_(pa.string())), ("confirmed", pa.bool_())]))

    # The cues are looked for before texts leave the JVM.
    low = ids_and_texts(docs, id_col, text_col).withColumn("low", F.lower("text"))
    cue = F.lit(False)
    for c in CUES:
        cue = cue | F.contains("low", F.lit(c))
    return map_arrow(low.where(cue).drop("low"), run, _SCHEMA)


def op3_license_scan(spark, sf_dir: str) -> DataFrame:
    return scan_licenses(table(spark, sf_dir, "documents"))
