"""License scans: winnowed fingerprints pick candidates, alignment confirms them.

Texts and templates are compared by words of letters and digits, without case
and punctuation. Of every two neighbouring three-word hashes the smaller one is
a fingerprint, so any four words in common share one. The fingerprints of the
templates form an inverted index; a document's fingerprints look up candidate
places, and a banded alignment around their diagonal finds how many words of
the template occur there in order, and where.

The templates are a parameter of bounded size and travel with the function.
"""

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from echolex.llm import texts as T

GRAM = 3
BAND = 8
MIN_COVERAGE = 0.7
MAX_TEMPLATE_BYTES = 16 << 20

# Public license notices and opening paragraphs.
TEMPLATES = {
    "apache-2.0 notice": "Licensed under the Apache License, Version 2.0.",
    "apache-2.0 header": (
        'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in '
        "compliance with the License. You may obtain a copy of the License at "
        "http://www.apache.org/licenses/LICENSE-2.0"
    ),
    "bsd": (
        "Redistribution and use in source and binary forms, with or without modification, are permitted "
        "provided that the following conditions are met"
    ),
    "cc-by-4.0 notice": "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    "cc-by-nc-4.0 notice": "Licensed under CC BY-NC 4.0.",
    "gpl-3.0 notice": "This work is licensed under the GNU General Public License, version 3.",
    "gpl header": (
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU "
        "General Public License as published by the Free Software Foundation"
    ),
    "mit notice": "Released under the MIT License.",
    "mit": (
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and "
        'associated documentation files (the "Software"), to deal in the Software without restriction'
    ),
    "mpl-2.0": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
    "unlicense": "This is free and unencumbered software released into the public domain.",
}

_PLAIN = np.full(256, 0x20, np.uint8)
_PLAIN[ord("0") : ord("9") + 1] = np.arange(ord("0"), ord("9") + 1)
_PLAIN[ord("a") : ord("z") + 1] = np.arange(ord("a"), ord("z") + 1)
_PLAIN[ord("A") : ord("Z") + 1] = np.arange(ord("a"), ord("z") + 1)
_PLAIN[0x80:] = np.arange(0x80, 0x100)


def plain_words(data, offsets):
    """(words, hashes) of a slice without case and punctuation; spans keep their bytes."""
    plain = _PLAIN[data]
    words = T.find_words(plain, offsets)
    return words, T.hash_spans(plain, words.start, words.end)


def winnow(value, row):
    """Positions of the fingerprints: of every two neighbours of a row the smaller, the later of equals."""
    if not len(value):
        return np.zeros(0, np.int64)
    pair = row[1:] == row[:-1]
    right = value[1:] <= value[:-1]
    keep = np.zeros(len(value), bool)
    keep[1:] |= pair & right
    keep[:-1] |= pair & ~right
    alone = np.ones(len(value), bool)
    alone[1:] &= ~pair
    alone[:-1] &= ~pair
    return np.flatnonzero(keep | alone)


class Index:
    """Inverted index: fingerprint to (template, word position)."""

    def __init__(self, templates):
        if sum(len(t.encode()) for t in templates.values()) > MAX_TEMPLATE_BYTES:
            raise ValueError(f"templates of more than {MAX_TEMPLATE_BYTES} bytes")
        self.names = list(templates)
        _, data, offsets = next(T.slices(pa.array(list(templates.values())), MAX_TEMPLATE_BYTES))
        words, hashes = plain_words(data, offsets)
        self.hashes = [hashes[s:e] for s, e in zip(words.first[:-1], words.first[1:])]
        value, row, at = T.windows(hashes, words, GRAM, short=True)
        # A document is winnowed with other neighbours at the ends, so all grams are kept here.
        order = np.argsort(value, kind="stable")
        self.value, self.template = value[order], row[order]
        self.position = at[order] - words.first[row[order]]

    def hits(self, value):
        """(index into `value`, template, position) of every posting found."""
        low, high = (np.searchsorted(self.value, value, side) for side in ("left", "right"))
        count = high - low
        which = np.repeat(np.arange(len(value)), count)
        posting = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count) + np.repeat(low, count)
        return which, self.template[posting], self.position[posting]


def align(text, template, shift, band):
    """(matched, first, last) of the best banded alignment: template words met in order.

    `shift` is the text position of the template's first word on the middle
    diagonal. Ties prefer the shorter and then the earlier span of the text.
    """
    width = 2 * band + 1
    # Of the best path to each cell: matched words, first matched text position, last one.
    none = (0, 0, 0)
    before = [none] * width
    for i, word in enumerate(template):
        now = []
        for d in range(width):
            j = i + shift + d - band
            best = before[d]
            if 0 <= j < len(text) and text[j] == word:
                n, first, _ = before[d]
                best = (n + 1, first if n else j, j)
            if d + 1 < width:
                best = _better(best, before[d + 1])
            if d:
                best = _better(best, now[d - 1])
            now.append(best)
        before = now
    best = none
    for cell in before:
        best = _better(best, cell)
    return best


def _better(a, b):
    return a if (a[0], a[1] - a[2], -a[1]) >= (b[0], b[1] - b[2], -b[1]) else b


def matches(data, offsets, index, min_coverage=MIN_COVERAGE, band=BAND):
    """(row, template, matched, first byte, last byte) of every place that covers a template enough."""
    words, hashes = plain_words(data, offsets)
    value, row, at = T.windows(hashes, words, GRAM)
    chosen = winnow(value, row)
    value, row, at = value[chosen], row[chosen], at[chosen]
    which, template, position = index.hits(value)
    row, at = row[which], at[which]
    diagonal = at - position
    order = np.lexsort((diagonal, template, row))
    row, template, diagonal = row[order], template[order], diagonal[order]
    new = np.ones(len(row), bool)
    new[1:] = (row[1:] != row[:-1]) | (template[1:] != template[:-1]) | (np.diff(diagonal) > band)
    starts = np.flatnonzero(new)
    found = {}
    for low, high in zip(starts, np.append(starts[1:], len(row))):
        r, t = int(row[low]), int(template[low])
        first, last = int(words.first[r]), int(words.first[r + 1])
        # A chain of near diagonals is covered by steps of one band.
        for shift in range(int(diagonal[low]), int(diagonal[high - 1]) + band, band):
            pattern = index.hashes[t]
            begin = max(first, shift - band)
            end = min(last, shift + len(pattern) + band)
            n, a, b = align(hashes[begin:end].tolist(), pattern.tolist(), shift - begin, band)
            if n >= min_coverage * len(pattern):
                place = (r, t, begin + a, begin + b)
                found[place] = n
    for (r, t, a, b), n in sorted(found.items()):
        yield r, t, n, int(words.start[a] - offsets[r]), int(words.end[b] - offsets[r])


def scan_licenses(docs, templates=None, min_coverage=MIN_COVERAGE, id_col="doc_id", text_col="text"):
    """doc_id, license, coverage, matched_words, start, end, span: one row per place found.

    start and end are bytes of the text, `span` the text between them. A
    document may have several places and several templates at one place; the
    same place of a template is reported once. Null and empty texts have none.
    Repeated rows are reported each; an empty table gives no rows; other
    columns are ignored.
    """
    index = Index(TEMPLATES if templates is None else templates)
    source = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))

    def run(batches):
        for batch in batches:
            rows = []
            for at, data, offsets in T.slices(batch.column(1)):
                for r, t, n, start, end in matches(data, offsets, index, min_coverage):
                    text = data[offsets[r] + start : offsets[r] + end].tobytes().decode(errors="replace")
                    rows.append((at + r, index.names[t], n / len(index.hashes[t]), n, start, end, text))
            row, name, coverage, n, start, end, span = zip(*rows) if rows else [()] * 7
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0).take(pa.array(row, pa.int64())),
                    pa.array(name, pa.string()),
                    pa.array(coverage, pa.float64()),
                    pa.array(n, pa.int64()),
                    pa.array(start, pa.int64()),
                    pa.array(end, pa.int64()),
                    pa.array(span, pa.string()),
                ],
                names=["doc_id", "license", "coverage", "matched_words", "start", "end", "span"],
            )

    kind = source.schema["doc_id"].dataType.simpleString()
    return source.mapInArrow(
        run,
        f"doc_id {kind}, license string, coverage double, matched_words long, start long, end long, span string",
    )
