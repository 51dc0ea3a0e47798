"""License notices: conditional compression against templates, confirmed word by word."""

from __future__ import annotations

import difflib
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from signalstar.llm.common import body

# Public notices by license identifier.
TEMPLATES: list[tuple[str, str]] = [
    ("MIT", "Released under the MIT License."),
    ("MIT", "Licensed under the MIT License."),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this "
            "software and associated documentation files (the \"Software\"), to deal in the Software "
            "without restriction, including without limitation the rights to use, copy, modify, merge, "
            "publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons "
            "to whom the Software is furnished to do so, subject to the following conditions: The above "
            "copyright notice and this permission notice shall be included in all copies or substantial "
            "portions of the Software."),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this "
                   "file except in compliance with the License. You may obtain a copy of the License at "
                   "http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed "
                   "to in writing, software distributed under the License is distributed on an \"AS IS\" "
                   "BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied."),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-3.0", "This program is free software: you can redistribute it and/or modify it under the terms "
                "of the GNU General Public License as published by the Free Software Foundation, either "
                "version 3 of the License, or (at your option) any later version."),
    ("GPL-2.0", "This work is licensed under the GNU General Public License, version 2."),
    ("LGPL-3.0", "This work is licensed under the GNU Lesser General Public License, version 3."),
    ("AGPL-3.0", "This work is licensed under the GNU Affero General Public License, version 3."),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    ("BSD-3-Clause", "Redistribution and use in source and binary forms, with or without modification, are "
                     "permitted provided that the following conditions are met:"),
    ("ISC", "Permission to use, copy, modify, and/or distribute this software for any purpose with or "
            "without fee is hereby granted, provided that the above copyright notice and this permission "
            "notice appear in all copies."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-ND-4.0", "Licensed under CC BY-ND 4.0."),
    ("CC-BY-NC-SA-4.0", "Licensed under CC BY-NC-SA 4.0."),
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("CC-BY-SA-4.0", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 "
                     "International License."),
    ("CC0-1.0", "This work is dedicated to the public domain under CC0 1.0."),
    ("Unlicense", "This is free and unencumbered software released into the public domain."),
    ("Proprietary", "All rights reserved."),
]

# The other members of two families, each with its versions.
TEMPLATES += [
    (f"{short}-{version}",
     f"This {what} is free software: you can redistribute it and/or modify it under the terms of the "
     f"GNU {kind}General Public License as published by the Free Software Foundation, either version "
     f"{said} of the License, or (at your option) any later version.")
    for short, what, kind, said, version in [
        ("GPL", "program", "", "1", "1.0"), ("GPL", "program", "", "2", "2.0"),
        ("LGPL", "library", "Library ", "2", "2.0"), ("LGPL", "library", "Lesser ", "2.1", "2.1"),
        ("LGPL", "program", "Lesser ", "3", "3.0"), ("AGPL", "program", "Affero ", "3", "3.0"),
    ]
]
TEMPLATES += [
    ("LGPL-2.1", "This work is licensed under the GNU Lesser General Public License, version 2.1."),
    ("MPL-1.1", "The contents of this file are subject to the Mozilla Public License Version 1.1."),
    ("CC-BY-NC-ND-4.0", "Licensed under CC BY-NC-ND 4.0."),
]
TEMPLATES += [
    (f"CC-{short}-{version}", f"This work is licensed under a Creative Commons {name} {version} {area} License.")
    for version, area in (("4.0", "International"), ("3.0", "Unported"), ("2.5", "Generic"), ("2.0", "Generic"))
    for short, name in (
        ("BY", "Attribution"), ("BY-SA", "Attribution-ShareAlike"),
        ("BY-NC", "Attribution-NonCommercial"), ("BY-ND", "Attribution-NoDerivatives"),
        ("BY-NC-SA", "Attribution-NonCommercial-ShareAlike"),
        ("BY-NC-ND", "Attribution-NonCommercial-NoDerivatives"),
    )
    if (version, short) not in (("4.0", "BY"), ("4.0", "BY-SA"))
]

# Words that tell the licenses of a family apart; within a family none may differ.
FAMILIES = [
    {"gnu", "lesser", "affero", "gpl", "lgpl", "agpl"},
    {"cc", "cc0", "commons", "attribution", "noncommercial", "commercial", "noderivatives", "noderivs",
     "derivatives", "derivs", "sharealike", "nc", "nd", "sa"},
    {"mit"}, {"apache"}, {"mozilla"},
]
_VERSION = re.compile(r"v?\d+(?:\.\d+)*")

# Every template holds one of these, so a text without them has no notice.
_GAP = r"[\W\d_]+"
TRIGGER = (
    rf"(?i:licen[cs]e|redistribut|permission|public{_GAP}domain|rights{_GAP}reserved|unencumbered)"
)
_TRIGGER = re.compile(TRIGGER)
_WORD = re.compile(r"[^\W_]+(?:[.'-][^\W_]+)*")
_PART = re.compile(r"[.'-]")
REACH = 600  # characters around a trigger that form a candidate block
SPLIT = 6000  # longer runs of triggers are looked at in overlapping pieces
CLOSE = 8  # templates whose reduction is within so many bytes of the best are tried with it
TOLERANCE = 0.1  # wording differences allowed, as a share of the template's words


@dataclass(frozen=True)
class _Template:
    license: str
    words: list[str]
    counts: Counter
    names: set[str]  # of the families that the template belongs to
    compressor: zstandard.ZstdCompressor


def _words(text: str) -> list[str]:
    return [m.group().lower() for m in _WORD.finditer(text)]


def _compressor(dictionary: bytes | None) -> zstandard.ZstdCompressor:
    data = None
    if dictionary is not None:
        data = zstandard.ZstdCompressionDict(dictionary, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
    return zstandard.ZstdCompressor(
        level=9, dict_data=data, write_content_size=False, write_checksum=False
    )


def prepared(templates: list[tuple[str, str]]) -> tuple[list[_Template], zstandard.ZstdCompressor]:
    """Templates with their compressors, and one without a dictionary."""
    made = []
    for license, text in templates:
        words = _words(text)
        parts = {part for word in words for part in _PART.split(word)}
        names = set().union(*(f for f in FAMILIES if f & parts))
        made.append(
            _Template(license, words, Counter(words), names, _compressor(" ".join(words).encode()))
        )
    return made, _compressor(None)


def blocks(text: str) -> list[tuple[int, int]]:
    """Spans of candidate blocks: triggers with their surroundings, merged where they meet."""
    spans: list[list[int]] = []
    for m in _TRIGGER.finditer(text):
        start, end = max(0, m.start() - REACH), min(len(text), m.end() + REACH)
        if spans and start <= spans[-1][1]:
            spans[-1][1] = end
        else:
            spans.append([start, end])
    out = []
    for start, end in spans:
        # Pieces overlap by more than the longest notice, so none is cut through in both.
        step = SPLIT - 2 * REACH
        out.extend((at, min(at + SPLIT, end)) for at in range(start, max(start + 1, end - 2 * REACH), step))
    return out


def _renames(template: _Template, words: list[str], edits: list[tuple]) -> bool:
    """Whether the differences touch a word that decides which license it is."""
    for op, i1, i2, j1, j2 in edits:
        if op == "equal":
            continue
        lost, new = template.words[i1:i2], words[j1:j2]
        if any(_VERSION.fullmatch(word) for word in lost):
            return True
        if any(part in template.names for word in (*lost, *new) for part in _PART.split(word)):
            return True
        if "gnu" in template.names and any(
            near[k] == "library" and k and near[k - 1] == "gnu"
            for near, span in ((template.words, range(i1, i2)), (words, range(j1, j2))) for k in span
        ):
            return True
    return False


def _aligned(template: _Template, words: list[str]) -> tuple[int, int, int] | None:
    """Wording differences of the best aligned stretch of words, and that stretch.

    None if they are too many, or if a word that names the license differs.
    """
    allowed = TOLERANCE * len(template.words)
    match = difflib.SequenceMatcher(None, template.words, words, autojunk=False)
    longest = match.find_longest_match()
    if not longest.size:
        return None
    # Around the longest common stretch, as many words as the template has there and a tenth.
    slack = len(template.words) // 10 + 1
    low = max(0, longest.b - longest.a - slack)
    high = min(len(words), longest.b + len(template.words) - longest.a + slack)
    some = words[low:high]
    same = difflib.SequenceMatcher(None, template.words, some, autojunk=False).get_matching_blocks()[:-1]
    first, last = low + same[0].b, low + same[-1].b + same[-1].size
    stretch = words[first:last]
    edits = difflib.SequenceMatcher(None, template.words, stretch, autojunk=False).get_opcodes()
    differences = sum(max(i2 - i1, j2 - j1) for op, i1, i2, j1, j2 in edits if op != "equal")
    if differences > allowed or _renames(template, stretch, edits):
        return None
    return differences, first, last


def notices(text: str, made: list[_Template], plain: zstandard.ZstdCompressor) -> list[tuple]:
    """(start, end, license, reduction, differences) of every confirmed notice in a text."""
    found: dict[tuple[int, int], tuple] = {}
    for at, to in blocks(text):
        marks = list(_WORD.finditer(text, at, to))
        todo = [(0, len(marks))]
        while todo:
            low, high = todo.pop()
            words = [m.group().lower() for m in marks[low:high]]
            if not words:
                continue
            block = " ".join(words).encode()
            alone = len(plain.compress(block))
            gains = [alone - len(t.compressor.compress(block)) for t in made]
            floor = max(gains) - CLOSE - max(gains) // 4
            counts = Counter(words)
            options: list[tuple] = []
            for gain, template in sorted(zip(gains, made), key=lambda t: -t[0]):
                # The best are compared; below them the first that is confirmed is taken.
                if gain <= 0 or options and gain < floor:
                    break
                # Words that the block lacks are differences wherever the template is laid.
                if (template.counts - counts).total() > TOLERANCE * len(template.words):
                    continue
                if (stretch := _aligned(template, words)) is not None:
                    differences, first, last = stretch
                    options.append((-(last - first) + 2 * differences, differences, first, last, gain, template.license))
            if not options:
                continue
            _, differences, first, last, gain, license = min(options)
            start, end = marks[low + first].start(), marks[low + last - 1].end()
            found.setdefault((start, end), (start, end, license, gain, differences))
            todo += [(low, low + first), (low + last, high)]
    return [found[k] for k in sorted(found)]


NOTICES = (
    "doc_id {id}, start long, end long, license string, reduction long, differences long"
)


def license_notices(
    docs: DataFrame, id: str = "doc_id", text: str = "text",
    templates: list[tuple[str, str]] = TEMPLATES,
) -> DataFrame:
    """One row per notice in a text: doc_id, start, end, license, reduction, differences.

    Blocks around license words are compressed with each template as a raw dictionary; the
    templates that save most bytes (``reduction``) are confirmed by aligning words, case and
    punctuation aside, and one with at most a tenth of its words different wins, if no word
    that names the license or its version differs; where none of them is confirmed, those
    that save less are tried in turn. What lies
    beside a notice is searched again, so several in one block are all found. Spans are code
    points, end exclusive. Null and empty texts have no notices; equal rows give equal
    notices; other columns are not read. Nothing is shuffled, and a block is bounded
    however long a text is.
    """
    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        made, plain = prepared(templates)
        for batch in batches:
            rows = [
                (doc, *notice)
                for doc, whole in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist())
                for notice in notices(whole, made, plain)
            ]
            columns = list(zip(*rows)) or [[]] * 6
            types = [batch.column(0).type, pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.int64()]
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(columns, types)],
                names=["doc_id", "start", "end", "license", "reduction", "differences"],
            )

    rows = docs.select(F.col(id).alias("doc_id"), body(text).alias("text"))
    id_type = rows.schema["doc_id"].dataType.simpleString()
    return rows.where(F.col("text").rlike(TRIGGER)).mapInArrow(scan, NOTICES.format(id=id_type))


def licensed_documents(docs: DataFrame, id: str = "doc_id", text: str = "text") -> DataFrame:
    """Notices with the texts that bear them: doc_id, license, notice (the words as written)."""
    found = license_notices(docs, id, text)
    texts = docs.select(F.col(id).alias("__id"), body(text).alias("__text"))
    length = (F.col("end") - F.col("start")).cast("int")
    notice = F.col("__text").substr((F.col("start") + 1).cast("int"), length)
    return found.join(texts, F.col("doc_id").eqNullSafe(F.col("__id"))).select(
        "doc_id", "license", notice.alias("notice")
    )
