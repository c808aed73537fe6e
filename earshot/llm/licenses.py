"""License scan: exact containment join of text blocks with notice templates."""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from earshot.llm.common import map_arrow, slices

#: The phrases of the contract and their labels.
PHRASES = {
    "under the mit license": "mit",
    "apache license version 2": "apache-2",
    "cc by nc": "cc-by-nc",
}

#: Public notices, as their licenses word them, by label.
TEMPLATES = [
    ("mit", "released under the mit license"),
    (
        "mit",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
        "documentation files (the Software), to deal in the Software without restriction, including without limitation "
        "the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, "
        "and to permit persons to whom the Software is furnished to do so",
    ),
    ("apache-2", "licensed under the apache license version 2 0"),
    (
        "apache-2",
        "Licensed under the Apache License, Version 2.0 (the License); you may not use this file except in compliance "
        "with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0",
    ),
    ("cc-by-nc", "licensed under cc by nc 4 0"),
    ("cc-by-nc", "licensed under a creative commons attribution noncommercial 4 0 international license"),
    ("cc-by-sa", "licensed under a creative commons attribution sharealike 4 0 international license"),
    ("gpl-3", "this work is licensed under the gnu general public license version 3"),
    (
        "gpl-3",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General "
        "Public License as published by the Free Software Foundation, either version 3 of the License, or (at your "
        "option) any later version",
    ),
    ("mpl-2", "this source code form is subject to the terms of the mozilla public license v 2 0"),
    (
        "bsd",
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that "
        "the following conditions are met",
    ),
    (
        "isc",
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby "
        "granted, provided that the above copyright notice and this permission notice appear in all copies",
    ),
]

#: What names the license in a template, by its text; of every line one phrase has to stand there.
NAMES = {
    TEMPLATES[0][1]: [["mit"]],
    TEMPLATES[2][1]: [["apache license"], ["version 2", "license 2", "v2", "v 2"]],
    TEMPLATES[3][1]: [["apache license"], ["version 2", "license 2", "v2", "v 2"]],
    TEMPLATES[4][1]: [["cc by nc"]],
    TEMPLATES[5][1]: [["noncommercial", "non commercial"]],
    TEMPLATES[6][1]: [["sharealike", "share alike"]],
    TEMPLATES[7][1]: [["gnu general public license"], ["version 3", "license 3", "v3", "v 3"]],
    TEMPLATES[8][1]: [["gnu general public license"], ["version 3", "license 3", "v3", "v 3"]],
    TEMPLATES[9][1]: [["mozilla public license"], ["version 2", "license 2", "v2", "v 2"]],
}

#: Consecutive words of a text in which a notice has to stand, for every word of its template.
ROOM = 2


#: Bytes that no word holds become blanks, A-Z lower case; digits, a-z and all beyond ASCII stay.
_TABLE = bytes(
    c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else c + 32 if 65 <= c <= 90 else 32 for c in range(256)
)


def words(text: str | bytes) -> list[bytes]:
    raw = text if isinstance(text, bytes) else text.encode("utf-8", "surrogatepass")
    return raw.translate(_TABLE).split()


def blocks(text: str) -> Iterator[list[bytes]]:
    """Words of a text's blocks: its lines, and each paragraph of several lines, as notices wrap."""
    paragraph, lines = [], 0
    for line in [*text.split("\n"), ""]:
        own = words(line)
        if own:
            yield own
            paragraph += own
            lines += 1
        else:
            if lines > 1:
                yield paragraph
            paragraph, lines = [], 0


def _vocabulary(templates: list[tuple[str, str]]) -> frozenset[bytes]:
    return frozenset(w for _, text in templates for w in words(text))


def token_counts(docs: DataFrame, templates: list[tuple[str, str]] = TEMPLATES) -> dict[bytes, int]:
    """In how many documents each word of the templates stands: at most as many lines as they have words."""
    vocabulary = _vocabulary(templates)

    def run(batches):
        for batch in slices(batches, "text", 8 << 20):
            counts: Counter = Counter()
            for text in batch.column("text").to_pylist():
                counts.update(vocabulary.intersection(words(text or "")))
            yield list(counts), list(counts.values())

    counted = map_arrow(docs.select("text"), run, "token binary, n long").groupBy("token").agg(F.sum("n").alias("n"))
    return {bytes(r["token"]): r["n"] for r in counted.collect()}


class Index:
    """The templates' words in global order, rarest first, and which template each prefix word opens."""

    def __init__(self, templates: list[tuple[str, str]], counts: dict[bytes, int], threshold: float):
        order = sorted(_vocabulary(templates), key=lambda w: (counts.get(w, 0), w))
        self.rank = {w: i for i, w in enumerate(order)}
        self.labels = [label for label, _ in templates]
        self.tokens = [sorted({self.rank[w] for w in words(text)}) for _, text in templates]
        self.sets = [frozenset(t) for t in self.tokens]
        self.needed = [max(1, math.ceil(threshold * len(t) - 1e-9)) for t in self.tokens]
        self.openers: dict[int, list[tuple[int, int]]] = {}
        for number, (tokens, needed) in enumerate(zip(self.tokens, self.needed)):
            for at, token in enumerate(tokens[: len(tokens) - needed + 1]):
                self.openers.setdefault(token, []).append((number, at))
        self.opening = frozenset(w for w in order if self.rank[w] in self.openers)

    def matches(self, block: set[bytes]) -> list[tuple[int, float]]:
        """Every template of which `block` holds the threshold's share of words, with that share.

        A block holding `needed` words of a template holds one of its first len - needed + 1 in any
        common order (prefix), at least `needed` words in all (length), and from the first common
        word on enough of both are left (position). What passes is counted in full.
        """
        if block.isdisjoint(self.opening):
            return []
        own = sorted(self.rank[w] for w in block & self.rank.keys())
        found, seen = [], set()
        for at, token in enumerate(own):
            for number, place in self.openers.get(token, ()):
                if number in seen or len(own) < self.needed[number]:
                    continue
                seen.add(number)
                if min(len(own) - at, len(self.tokens[number]) - place) < self.needed[number]:
                    continue
                common = len(self.sets[number].intersection(own))
                if common >= self.needed[number]:
                    found.append((number, common / len(self.tokens[number])))
        return found


def is_named(block: list[bytes], template: str, threshold: float) -> bool:
    """Whether the template's words stand together in a block that contains them: `threshold` of them among
    consecutive words, `ROOM` times as many as the template has, that also name the license as `NAMES` demands.

    The words of a long line may stand far apart, and the words that two licenses differ in are few.
    """
    wanted = words(template)
    room, wanted = ROOM * len(wanted), frozenset(wanted)
    needed = max(1, math.ceil(threshold * len(wanted) - 1e-9))
    names = [[b" " + n.encode() + b" " for n in one] for one in NAMES.get(template, [])]
    places = [i for i, w in enumerate(block) if w in wanted]
    held: Counter = Counter()
    stop = 0
    for start in places:
        while stop < len(places) and places[stop] < start + room:
            held[block[places[stop]]] += 1
            stop += 1
        if len(held) >= needed:
            joined = b" " + b" ".join(block[start : start + room]) + b" "
            if all(any(n in joined for n in one) for one in names):
                return True
        held[block[start]] -= 1
        if not held[block[start]]:
            del held[block[start]]
    return False


def phrase_places(all_words: list[bytes], phrases: dict[str, str] = PHRASES) -> list[tuple[int, str]]:
    """(index of the first word, label) of every place where a phrase's words stand consecutively."""
    joined = b" " + b" ".join(all_words) + b" "
    found, starts = [], None
    for phrase, label in phrases.items():
        needle = b" " + b" ".join(words(phrase)) + b" "
        at, hits = joined.find(needle), []
        while at >= 0:
            hits.append(at)
            at = joined.find(needle, at + 1)
        if hits:
            # The blank before a word is the word's place among all blanks, counted once for the text.
            starts = np.flatnonzero(np.frombuffer(joined, np.uint8) == 32) if starts is None else starts
            found += [(i, label) for i in np.searchsorted(starts, hits).tolist()]
    return sorted(found)


def scan(
    docs: DataFrame, threshold: float = 0.8, templates: list[tuple[str, str]] = TEMPLATES, phrases: dict[str, str] = PHRASES
) -> DataFrame:
    """Per document the notices its text holds: doc_id, n_words, n_base, first_word, last_word,
    base_labels, labels, score, and matches (array of template number, label, containment and named).

    Base: places where the words of a phrase stand consecutively. Method: an exact containment join of
    the text's blocks (lines and paragraphs) with `templates`: the words' document counts over the
    whole table put them in a global order, and prefix, length and position filters leave few pairs to
    count. All that is found is in `matches`, with the largest containment of a block. It gives a label if in
    such a block the license is named (`NAMES`) and the words stand together, see `is_named`: words of
    two licenses are much the same. The index holds the templates only, a fixed list, so it goes along with the tasks.

    Labels are distinct, sorted and comma-joined; score is 1 where a phrase stands, else the largest
    containment of a match that gives a label, else 0. Null or empty text: no words, empty labels, null first and last word.
    Every row is a document of its own. Empty table: no rows. Other columns are ignored.
    """
    index = Index(templates, token_counts(docs, templates), threshold)

    def run(batches):
        for batch in slices(batches, "text", 8 << 20):
            out: list[list] = [[] for _ in range(8)]
            for text in batch.column("text").to_pylist():
                text = text or ""
                every = words(text)
                base = phrase_places(every, phrases)
                best: dict[int, float] = {}
                named: set[int] = set()
                if not index.opening.isdisjoint(every):
                    for block in blocks(text):
                        for number, share in index.matches(set(block)):
                            best[number] = max(share, best.get(number, 0.0))
                            if number not in named and is_named(block, templates[number][1], threshold):
                                named.add(number)
                base_labels = {label for _, label in base}
                labels = base_labels | {index.labels[n] for n in named}
                row = (
                    len(every),
                    len(base),
                    base[0][0] if base else None,
                    base[-1][0] if base else None,
                    ",".join(sorted(base_labels)),
                    ",".join(sorted(labels)),
                    1.0 if base else max((best[n] for n in named), default=0.0),
                    [
                        {"template": n, "label": index.labels[n], "containment": share, "named": n in named}
                        for n, share in sorted(best.items())
                    ],
                )
                for column, value in zip(out, row):
                    column.append(value)
            yield batch.column("doc_id"), *out

    return map_arrow(
        docs.select("doc_id", "text"),
        run,
        "doc_id long, n_words long, n_base long, first_word long, last_word long, base_labels string, labels string, "
        "score double, matches array<struct<template:int,label:string,containment:double,named:boolean>>",
    )


