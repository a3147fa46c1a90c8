"""Fuzzy search for short licence notices.

A text is reduced to lower-case words with single spaces.  A notice that occurs with at most ``k`` edits contains at
least one of ``k + 1`` pieces of itself unchanged (pigeonhole), so an automaton over all pieces finds the
candidate windows in one pass; only inside them does the bounded-error matching of the regex library decide, with
the edits and the span.  Exact phrases are found in the same reduced text.

Defined results: a NULL text has no words; a text without notices has zero places, NULL positions, empty labels and
score 0; repeated rows give the same; other columns are not read.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import ahocorasick
import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from daymart.llm.tables import extended

#: Exact phrases and their labels (fixed values).
PHRASES = {"cc by": "cc-by", "general public license": "gpl", "all rights reserved": "reserved"}

#: Short notices, found with up to one edit in ten characters (fixed values).
NOTICES = {
    "licensed under the apache license version 2 0": "apache-2.0",
    "released under the mit license": "mit",
    "permission is hereby granted free of charge to any person obtaining a copy": "mit",
    "licensed under the gnu general public license": "gpl",
    "redistribution and use in source and binary forms": "bsd",
    "licensed under a creative commons attribution": "cc-by",
    "licensed under cc by nc 4 0": "cc-by-nc",
    "mozilla public license version 2 0": "mpl-2.0",
}
EDITS_PER_CHARACTER = 0.1

_WORDS = bytes(c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else c + 32 if 65 <= c <= 90 else 32 for c in range(256))


@dataclass(frozen=True)
class Found:
    label: str
    first_word: int
    end_word: int
    edits: int
    score: float
    exact: bool


def reduced(text: str | None) -> tuple[str, int]:
    """Words with single spaces between and around them, and their number."""
    words = (text or "").encode().translate(_WORDS).split()
    return (" " + b" ".join(words).decode() + " " if words else ""), len(words)


def pieces(notice: str, edits: int) -> list[tuple[int, str]]:
    """``edits + 1`` pieces that cover the notice, with their offsets."""
    cuts = [round(i * len(notice) / (edits + 1)) for i in range(edits + 2)]
    return [(a, notice[a:b]) for a, b in zip(cuts, cuts[1:])]


class Search:
    def __init__(self, phrases: dict[str, str], notices: dict[str, str], rate: float = EDITS_PER_CHARACTER) -> None:
        self.phrases = phrases
        self.notices = [(notice, label, int(len(notice) * rate)) for notice, label in notices.items()]
        fuzzy = [f"(?:{regex.escape(notice, literal_spaces=True)}){{e<={edits}}}" for notice, _, edits in self.notices]
        self.patterns = [(regex.compile(f), regex.compile(f"(?b){f}")) for f in fuzzy]
        seeds: dict[str, list[tuple[int, int]]] = {}
        for k, (notice, _, edits) in enumerate(self.notices):
            for offset, piece in pieces(notice, edits):
                seeds.setdefault(piece, []).append((k, offset))
        self.automaton = ahocorasick.Automaton()
        for piece, places in seeds.items():
            self.automaton.add_word(piece, (len(piece), places))
        self.automaton.make_automaton()

    def windows(self, line: str) -> Iterator[tuple[int, int, int]]:
        """(notice, start, end) around every seed; windows of a notice that overlap are joined."""
        open_at: dict[int, list[int]] = {}
        for end, (length, places) in self.automaton.iter(line):
            for k, offset in places:
                notice, _, edits = self.notices[k]
                start = max(0, end - length + 1 - offset - edits)
                stop = min(len(line), start + len(notice) + 2 * edits)
                last = open_at.get(k)
                if last and start <= last[1]:
                    last[0], last[1] = min(last[0], start), max(last[1], stop)
                    continue
                if last:
                    yield k, *last
                open_at[k] = [start, stop]
        for k, last in open_at.items():
            yield k, *last

    def matches(self, k: int, line: str, start: int, stop: int) -> Iterator[regex.Match]:
        """All places of a notice in a window.  The next place is looked for first and its best alignment only around it, since the best
        match of a whole window hides those in front of it."""
        notice, _, edits = self.notices[k]
        anywhere, best = self.patterns[k]
        while found := anywhere.search(line, start, stop):
            match = best.search(line, found.start(), min(stop, found.start() + len(notice) + 2 * edits))
            yield match
            start = match.end()

    def find(self, line: str) -> list[Found]:
        """Exact phrases and fuzzy notices of a reduced text, with positions counted in words."""
        found = []  # label, start, end, edits, score, exact; places in characters
        for phrase, label in self.phrases.items():
            at = line.find(f" {phrase} ")
            while at >= 0:
                found.append((label, at + 1, at + 1 + len(phrase), 0, 1.0, True))
                at = line.find(f" {phrase} ", at + 1)
        for k, start, stop in self.windows(line):
            notice, label, _ = self.notices[k]
            for match in self.matches(k, line, start, stop):
                edits = sum(match.fuzzy_counts)
                first, end = match.span()
                found.append((label, first + (line[first] == " "), end - (line[end - 1] == " "), edits, 1 - edits / len(notice), False))
        if not found:
            return []
        spaces = np.flatnonzero(np.frombuffer(line.encode("utf-32-le"), np.uint32) == 32)
        first = np.searchsorted(spaces, [x[1] for x in found]) - 1
        last = np.maximum(np.searchsorted(spaces, [x[2] for x in found]), first + 1)
        return [Found(x[0], int(a), int(b), *x[3:]) for x, a, b in zip(found, first, last)]


@lru_cache(1)
def default_search() -> Search:
    return Search(PHRASES, NOTICES)


def character_spans(text: str, found: list[Found]) -> list[tuple[int, int]]:
    """Where the words of each finding stand in the text, in code points."""
    places = [m.span() for m in re.finditer(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", text)]
    return [(places[x.first_word][0], places[min(x.end_word, len(places)) - 1][1]) for x in found]


def scanned(docs: DataFrame, id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document: counts, positions and labels, and in ``notices`` every finding with its span and edits."""
    frame = docs.select(F.col(id), F.col(f"`{text}`").alias("_text"))
    schema = extended(
        frame.select(id).schema,
        "n_words long, n_base long, first_word long, last_word long, base_labels string, labels string, score double, "
        "notices array<struct<label:string,first_word:long,end_word:long,start:long,end:long,edits:int,exact:boolean>>",
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        search = default_search()
        for batch in batches:
            rows = []
            for value in batch.column("_text"):
                whole = value.as_py()
                line, n_words = reduced(whole)
                found = search.find(line)
                base = [x for x in found if x.exact]
                at = character_spans(whole, found) if found else []
                rows.append(
                    {
                        "n_words": n_words,
                        "n_base": len(base),
                        "first_word": min((x.first_word for x in base), default=None),
                        "last_word": max((x.first_word for x in base), default=None),
                        "base_labels": ",".join(sorted({x.label for x in base})),
                        "labels": ",".join(sorted({x.label for x in found})),
                        "score": max((x.score for x in found), default=0.0),
                        "notices": [
                            {"label": x.label, "first_word": x.first_word, "end_word": x.end_word, "start": a, "end": b, "edits": x.edits, "exact": x.exact}
                            for x, (a, b) in zip(found, at)
                        ],
                    }
                )
            kinds = {
                "n_words": pa.int64(), "n_base": pa.int64(), "first_word": pa.int64(), "last_word": pa.int64(),
                "base_labels": pa.string(), "labels": pa.string(), "score": pa.float64(),
                "notices": pa.list_(pa.struct([
                    ("label", pa.string()), ("first_word", pa.int64()), ("end_word", pa.int64()), ("start", pa.int64()),
                    ("end", pa.int64()), ("edits", pa.int32()), ("exact", pa.bool_()),
                ])),
            }
            yield pa.RecordBatch.from_arrays(
                [batch.column(id), *(pa.array([r[name] for r in rows], kind) for name, kind in kinds.items())], [id, *kinds]
            )

    return frame.mapInArrow(run, schema)
