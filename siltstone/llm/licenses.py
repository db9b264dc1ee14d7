"""Licence notices in documents, by conditional compression.

Lines that mention a licence are candidate blocks. A block is compressed alone
and with each template as a raw zstandard dictionary; the template that saves
most explains the block best. The leading templates are then confirmed by their
wording: the words that differ between template and block are counted exactly,
and a template wins only if enough of its words stand in the block in order.
"""

from __future__ import annotations

import difflib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siltstone.llm.frames import bounded_batches

# Short notices as they are commonly written, with SPDX identifiers.
TEMPLATES = {
    "Apache-2.0": "Licensed under the Apache License, Version 2.0.",
    "MIT": "Released under the MIT License.",
    "GPL-3.0": "This work is licensed under the GNU General Public License, version 3.",
    "GPL-2.0": "This work is licensed under the GNU General Public License, version 2.",
    "LGPL-3.0": "This work is licensed under the GNU Lesser General Public License, version 3.",
    "AGPL-3.0": "This work is licensed under the GNU Affero General Public License, version 3.",
    "MPL-2.0": "This work is subject to the terms of the Mozilla Public License, version 2.0.",
    "BSD-3-Clause": "Redistribution and use in source and binary forms, with or without modification, are permitted under the BSD 3-Clause License.",
    "CC-BY-4.0": "Licensed under CC BY 4.0.",
    "CC-BY-SA-4.0": "Licensed under CC BY-SA 4.0.",
    "CC-BY-NC-4.0": "Licensed under CC BY-NC 4.0.",
    "CC0-1.0": "Dedicated to the public domain under CC0 1.0.",
    "Proprietary": "Copyright. All rights reserved.",
}
CUE = r"(?i)licen[cs]e|copyright|all rights reserved|public domain|redistribution"
#: Templates whose wording is compared, from the best saving on.
RANKED = 3

_WORD = re.compile(r"[\w.]*\w", re.ASCII)


def wording(text: str) -> list[str]:
    return [w.lower() for w in _WORD.findall(text)]


def differences(template: list[str], block: list[str]) -> tuple[float, list[str]]:
    """Share of the template's words that stand in the block in order, and the differing words (-missing, +other)."""
    changes, kept = [], 0
    matcher = difflib.SequenceMatcher(None, template, block, autojunk=False)
    spans = matcher.get_opcodes()
    for i, (what, a, b, c, d) in enumerate(spans):
        if what == "equal":
            kept += b - a
            continue
        changes += [f"-{w}" for w in template[a:b]]
        if 0 < i < len(spans) - 1 or what == "replace":  # text before and after the notice is no difference
            changes += [f"+{w}" for w in block[c:d]]
    return kept / max(1, len(template)), changes


class Scanner:
    """Ranks templates for a block; the results for the last blocks are kept, as notices repeat."""

    def __init__(self, templates: dict[str, str], confirm: float):
        import zstandard

        self.plain = zstandard.ZstdCompressor(level=19)
        self.given = {
            n: zstandard.ZstdCompressor(level=19, dict_data=zstandard.ZstdCompressionDict(t.encode(), dict_type=zstandard.DICT_TYPE_RAWCONTENT))
            for n, t in templates.items()
        }
        self.words = {n: wording(t) for n, t in templates.items()}
        self.confirm, self.kept = confirm, {}

    def best(self, block: str) -> tuple[str, float, float, str] | None:
        """(licence, saving, share of the wording, differences) of the confirmed winner."""
        if block in self.kept:
            return self.kept[block]
        raw, own = block.encode(), wording(block)
        alone = len(self.plain.compress(raw))
        savings = sorted(((1 - len(c.compress(raw)) / alone, n) for n, c in self.given.items()), key=lambda x: (-x[0], x[1]))
        # Equal savings rank alike, so ties with the last one looked at are looked at too.
        least = savings[min(RANKED, len(savings)) - 1][0]
        confirmed = []
        for saving, n in savings:
            if saving <= 0 or saving < least:
                break
            share, changes = differences(self.words[n], own)
            if share >= self.confirm:
                confirmed.append((len(changes), -share, -saving, n, " ".join(changes)))
        out = None
        if confirmed:
            _, share, saving, n, changes = min(confirmed)
            out = (n, -saving, -share, changes)
        if len(self.kept) >= 10_000:
            self.kept.clear()
        self.kept[block] = out
        return out


def license_spans(docs: DataFrame, templates: dict[str, str] | None = None, confirm: float = 0.85, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, license_id, start, end, saving, wording, differences) of each confirmed block.

    A block is a line; `start` and `end` are code points of the whole text.
    `wording` is the share of the template's words found in order. Null and empty
    texts have no block; repeated rows report each; lines that no template explains
    are left out.
    """
    bounded_batches(docs.sparkSession)
    chosen = dict(TEMPLATES if templates is None else templates)
    kind = docs.schema[key].dataType.simpleString()
    names = [key, "license_id", "start", "end", "saving", "wording", "differences"]
    types = [pa.string(), pa.int64(), pa.int64(), pa.float64(), pa.float64(), pa.string()]
    cue = re.compile(CUE)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scanner = Scanner(chosen, confirm)
        for batch in batches:
            found = []
            for i, whole in enumerate(batch.column(1).to_pylist()):
                done = -1
                for m in cue.finditer(whole):
                    if m.start() < done:
                        continue
                    low = whole.rfind("\n", 0, m.start()) + 1
                    high = whole.find("\n", m.end())
                    done = high = len(whole) if high < 0 else high
                    if best := scanner.best(whole[low:high]):
                        found.append((i, best[0], low, high, *best[1:]))
            if found:
                rows, *rest = zip(*found)
                yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(rows)), *(pa.array(c, t) for c, t in zip(rest, types))], names)

    some = docs.where(F.col(text).rlike(CUE)).select(key, text)
    return some.mapInArrow(run, f"{key} {kind}, license_id string, start long, end long, saving double, wording double, differences string")
