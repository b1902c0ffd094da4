"""License scan by conditional compression.

A text is cut into lines, a line of more than ``LONG_LINE`` words into sentences.
Runs of neighbouring pieces that hold a cue word are the candidate blocks. A
candidate is compressed alone and with each template as a raw zstandard dictionary;
the share of bytes that a template saves ranks the templates. Every template is
confirmed by wording, whatever it saves: words that the block lacks or has in between,
in lower case without punctuation, may be at most ``most_differences`` of the template's
words, and with differences the notice alone has to save ``least_saving``. What stands
before and after the template's words in the block is no difference. A notice may begin
before or end after its block, by as many words as the longest template has, whatever
the line breaks; begin and end then cover both. SPDX tags name their identifiers.

Defined results for odd input: a NULL, empty or blank text has no candidate and no
license; of equal savings the template that is first in the table wins; repeated
rows are scanned each; several licenses of a text are all reported, the one with
the largest saving is the first; only ``doc_id`` and ``text`` are read.
"""

from __future__ import annotations

import bisect
import difflib
import re
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spanvec.llm.labelled import texts_of

#: Short notices as they are commonly worded, by SPDX identifier.
TEMPLATES = (
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", 'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License.'),
    ("MIT", "Released under the MIT License."),
    ("MIT", "Licensed under the MIT License."),
    ("BSD-3-Clause", "Licensed under the BSD 3-Clause License."),
    ("GPL-2.0", "This work is licensed under the GNU General Public License, version 2."),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("LGPL-3.0", "This work is licensed under the GNU Lesser General Public License, version 3."),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-4.0", "Licensed under the CC BY 4.0."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("CC-BY-SA-4.0", "Licensed under the CC BY-SA 4.0."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-NC-4.0", "Licensed under the CC BY-NC 4.0."),
    ("CC0-1.0", "Dedicated to the public domain under CC0 1.0."),
    ("proprietary", "All rights reserved."),
    (
        "MIT",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions: The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.",
    ),
    (
        "ISC",
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies.",
    ),
    (
        "BSD-3-Clause",
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: 1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer. 2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution. 3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission.",
    ),
)
CUES = ("licen", "rights reserved", "public domain", "copyright", "spdx")
LONG_LINE = 60
LEVEL = 19
#: Blocks a worker remembers.
REMEMBERED = 20_000

_WORD = re.compile(r"[^\W_]+(?:[.\-][^\W_]+)*")
_PIECE = re.compile(r"[^\n]+")
_ID = r"[A-Za-z0-9][\w+-]*(?:\.[\w+-]+)*"
_TAG = re.compile(rf"(?i:SPDX-License-Identifier):[ \t]*(\(*{_ID}\)*(?:[ \t]+(?:AND|OR|WITH)[ \t]+\(*{_ID}\)*)*)")
_EXCEPTION = re.compile(rf"\bWITH[ \t]+{_ID}|\b(?:AND|OR)\b")
_IDENTIFIER = re.compile(_ID)
_SENTENCE = re.compile(r"\S.*?(?:[.!?](?=\s)|$)")


def words(text: str) -> list[str]:
    return _WORD.findall(text.lower())


def pieces(text: str) -> Iterator[tuple[int, int]]:
    """Begin and end of each line, of each sentence of a long line."""
    for line in _PIECE.finditer(text):
        if line[0].count(" ") <= LONG_LINE:
            yield line.span()
        else:
            for sentence in _SENTENCE.finditer(line[0]):
                yield line.start() + sentence.start(), line.start() + sentence.end()


def candidates(text: str, cues: tuple[str, ...] = CUES) -> list[tuple[int, int]]:
    """Begin and end of the runs of neighbouring pieces that hold a cue, or a part of one that is wrapped."""
    low = text.lower()
    phrases = [p for p in map(str.split, cues) if len(p) > 1 and all(w in low for w in p)]
    wrapped = [m.span() for p in phrases for m in re.finditer(r"\W+".join(map(re.escape, p)), text, re.I) if "\n" in m[0]]
    if not wrapped and not any(cue in low for cue in cues):
        return []
    out: list[tuple[int, int]] = []
    after_cue = False
    for begin, end in pieces(text):
        part = text[begin:end].lower()
        has = any(cue in part for cue in cues) or any(b < end and begin < e for b, e in wrapped)
        if has and after_cue:
            out[-1] = (out[-1][0], end)
        elif has:
            out.append((begin, end))
        after_cue = has
    return out


def differences(template: list[str], block: list[str]) -> tuple[list[str], list[str]]:
    """Words of the template that the block lacks, and words of the block between those it shares."""
    matches = [m for m in difflib.SequenceMatcher(None, template, block, False).get_matching_blocks() if m.size]
    if not matches:
        return template, []
    shared = {i for m in matches for i in range(m.a, m.a + m.size)}
    kept = {j for m in matches for j in range(m.b, m.b + m.size)}
    inside = range(matches[0].b, matches[-1].b + matches[-1].size)
    return [w for i, w in enumerate(template) if i not in shared], [block[j] for j in inside if j not in kept]


@dataclass(frozen=True)
class Match:
    license: str
    saving: float
    missing: tuple[str, ...]
    added: tuple[str, ...]


class Scanner:
    """Compressors of one table of templates."""

    def __init__(self, templates, most_differences: float, least_saving: float):
        self.templates = [(name, words(text)) for name, text in templates]
        self.plain = zstandard.ZstdCompressor(level=LEVEL, write_content_size=False)
        self.given = [
            zstandard.ZstdCompressor(
                level=LEVEL, write_content_size=False, write_dict_id=False,
                dict_data=zstandard.ZstdCompressionDict(text.lower().encode(), dict_type=zstandard.DICT_TYPE_RAWCONTENT),
            )
            for _, text in templates
        ]
        self.most_differences, self.least_saving = most_differences, least_saving
        self.matches = lru_cache(REMEMBERED)(self._matches)

    def savings(self, block: str) -> list[float]:
        """Share of the block's compressed size that each template saves."""
        data = block.lower().encode("utf-8", "replace")
        alone = len(self.plain.compress(data))
        return [(alone - len(c.compress(data))) / alone for c in self.given]

    def _notice(self, i: int, block: str) -> tuple[list[str], list[str]] | None:
        """Words missing and added, if the block holds the template's wording."""
        wanted, own = self.templates[i][1], words(block)
        missing, added = differences(wanted, own)
        if len(missing) + len(added) > self.most_differences * len(wanted):
            return None
        if missing or added:
            shared = [m for m in difflib.SequenceMatcher(None, wanted, own, False).get_matching_blocks() if m.size]
            spans = [m.span() for m in _WORD.finditer(block.lower())]
            notice = block.lower()[spans[shared[0].b][0] : spans[shared[-1].b + shared[-1].size - 1][1]]
            if self.savings(notice)[i] < self.least_saving:
                return None
        return missing, added

    def _matches(self, block: str) -> tuple[Match, ...]:
        """Confirmed licenses of a block, the largest saving first, each license once."""
        saved = self.savings(block)
        found: dict[str, Match] = {}
        for i in sorted(range(len(saved)), key=lambda i: (-saved[i], i)):
            name = self.templates[i][0]
            notice = None if name in found else self._notice(i, block)
            if notice:
                found[name] = Match(name, saved[i], tuple(notice[0]), tuple(notice[1]))
        return tuple(found.values())

    def tags(self, block: str) -> Iterator[Match]:
        """Identifiers of the SPDX tags of a block."""
        for tag in _TAG.finditer(block):
            for name in _IDENTIFIER.findall(_EXCEPTION.sub(" ", tag[1])):
                given = self.plain_with(f"spdx-license-identifier: {name}".lower())
                data = block.lower().encode("utf-8", "replace")
                alone = len(self.plain.compress(data))
                yield Match(name, (alone - len(given.compress(data))) / alone, (), ())

    @staticmethod
    def plain_with(text: str) -> zstandard.ZstdCompressor:
        given = zstandard.ZstdCompressionDict(text.encode("utf-8", "replace"), dict_type=zstandard.DICT_TYPE_RAWCONTENT)
        return zstandard.ZstdCompressor(level=LEVEL, write_content_size=False, write_dict_id=False, dict_data=given)

    def beyond(self, text_words: list[re.Match], begin: int, end: int) -> Iterator[tuple[int, int, int]]:
        """Template, begin and end of the exact notices that overlap a block and reach beyond it."""
        reach = max((len(wanted) for _, wanted in self.templates), default=0)
        first_word = bisect.bisect_left(text_words, begin, key=lambda w: w.start())
        after_word = bisect.bisect_left(text_words, end, key=lambda w: w.start())
        near = text_words[max(0, first_word - reach) : after_word + reach]
        low = [w[0].lower() for w in near]
        for i, (_, wanted) in enumerate(self.templates):
            n = len(wanted)
            for at in range(len(low) - n + 1):
                if low[at] == wanted[0] and low[at : at + n] == wanted:
                    first, last = near[at].start(), near[at + n - 1].end()
                    if first < end and last > begin and (first < begin or last > end):
                        yield i, first, last

    def scan(self, text: str) -> list[tuple[int, int, Match]]:
        out: list[tuple[int, int, Match]] = []
        seen: set[tuple[int, int, int]] = set()
        blocks = candidates(text)
        text_words = list(_WORD.finditer(text)) if blocks else []
        for begin, end in blocks:
            block = text[begin:end]
            found = {m.license for m in self.matches(block)}
            out += [(begin, end, m) for m in self.matches(block)]
            for m in self.tags(block) if "spdx" in block.lower() else ():
                if m.license not in found:
                    found.add(m.license)
                    out.append((begin, end, m))
            for i, first, last in self.beyond(text_words, begin, end):
                if (i, first, last) not in seen and self.templates[i][0] not in found:
                    found.add(self.templates[i][0])
                    b, e = min(begin, first), max(end, last)
                    out.append((b, e, Match(self.templates[i][0], self.savings(text[b:e])[i], (), ())))
                seen.add((i, first, last))
        return out


def scan_blocks(docs: DataFrame, *, templates=TEMPLATES, most_differences: float = 0.0, least_saving: float = 0.1) -> DataFrame:
    """``doc_id, begin, end, license, saving, missing, added, block``: each confirmed license of each block."""
    kind = dict(docs.dtypes)["doc_id"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scanner = Scanner(templates, most_differences, least_saving)
        for part, texts in texts_of(batches, 1):
            rows = [(i, *hit, t[hit[0] : hit[1]]) for i, t in enumerate(texts) for hit in scanner.scan(t or "")]
            yield pa.RecordBatch.from_pydict({
                "doc_id": part.column(0).take(pa.array([r[0] for r in rows], pa.int64())),
                "begin": pa.array([r[1] for r in rows], pa.int64()),
                "end": pa.array([r[2] for r in rows], pa.int64()),
                "license": pa.array([r[3].license for r in rows], pa.string()),
                "saving": pa.array([r[3].saving for r in rows], pa.float64()),
                "missing": pa.array([list(r[3].missing) for r in rows], pa.list_(pa.string())),
                "added": pa.array([list(r[3].added) for r in rows], pa.list_(pa.string())),
                "block": pa.array([r[4] for r in rows], pa.string()),
            })

    schema = f"doc_id {kind}, begin bigint, end bigint, license string, saving double, missing array<string>, added array<string>, block string"
    return docs.select("doc_id", F.col("text").cast("string")).mapInArrow(run, schema)


def scan_documents(docs: DataFrame, *, templates=TEMPLATES, most_differences: float = 0.0, least_saving: float = 0.1) -> DataFrame:
    """``doc_id, n_candidates, n_licenses, license, begin, end, saving, licenses`` of every document.

    ``licenses`` are all distinct ones in order, joined by commas; without one it is NULL,
    as are the fields of the first.
    """
    kind = dict(docs.dtypes)["doc_id"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scanner = Scanner(templates, most_differences, least_saving)
        for part, texts in texts_of(batches, 1):
            blocks, hits = [], []
            for text in texts:
                blocks.append(len(candidates(text or "")))
                hits.append(scanner.scan(text or "") if blocks[-1] else [])
            first = [min(h, key=lambda x: (-x[2].saving, x[0]), default=None) for h in hits]
            names = [sorted({m.license for *_, m in h}) for h in hits]
            yield pa.RecordBatch.from_pydict({
                "doc_id": part.column(0),
                "n_candidates": pa.array(blocks, pa.int64()),
                "n_licenses": pa.array([len(n) for n in names], pa.int64()),
                "license": pa.array([f and f[2].license for f in first], pa.string()),
                "begin": pa.array([f and f[0] for f in first], pa.int64()),
                "end": pa.array([f and f[1] for f in first], pa.int64()),
                "saving": pa.array([f and f[2].saving for f in first], pa.float64()),
                "licenses": pa.array([",".join(n) or None for n in names], pa.string()),
            })

    schema = f"doc_id {kind}, n_candidates bigint, n_licenses bigint, license string, begin bigint, end bigint, saving double, licenses string"
    return docs.select("doc_id", F.col("text").cast("string")).mapInArrow(run, schema)
