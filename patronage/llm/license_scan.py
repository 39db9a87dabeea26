"""Licence scan: ordered signature rules behind a keyword search, with suppression of overlapping detections."""

from __future__ import annotations

import re
from bisect import bisect_left, bisect_right
from collections.abc import Iterator

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from patronage.llm.license_rules import Rule, rules
from patronage.llm.pieces import small

#: Phrases whose places are counted, with their labels.
PHRASES = ((b"gnu general public license", "gpl"), (b"apache license", "apache"), (b"cc by", "cc-by"), (b"mit license", "mit"))
#: Everything but a-z, 0-9 and bytes from 0x80 on separates words (A-Z are lower-cased before).
_WORDS = bytes(b if 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A or b >= 0x80 else 0x20 for b in range(256))
#: White space, and comment marks at the start of a line.
_BLANK = re.compile(r"(?:\s*(?:\A|\n)[ \t]*(?:[*#>|;]+|//+|/\*+))+\s*|\s+")


class Scanner:
    """The rules of one worker, with one automaton over all keywords."""

    def __init__(self, ordered: list[Rule]):
        self.ordered = ordered
        by_keyword: dict[str, list[int]] = {}
        for number, rule in enumerate(ordered):
            by_keyword.setdefault(rule.keyword, []).append(number)
        self.always = by_keyword.pop("", [])
        self.automaton = ahocorasick.Automaton()
        for keyword, numbers in by_keyword.items():
            self.automaton.add_word(keyword, numbers)
        self.automaton.make_automaton()

    def detect(self, text: str) -> list[tuple[int, int, Rule]]:
        """Detections that stay, by place: of the rules in order, one goes if a rule before it has a detection that contains it.

        Within one priority the longer detection comes first, then the earlier place, then the label.
        """
        plain = _BLANK.sub(" ", text.lower())
        first = {*self.always}
        if len(self.automaton):
            first.update(number for _, numbers in self.automaton.iter(plain) for number in numbers)
        found = [(m.start(), m.end(), self.ordered[n]) for n in sorted(first) for m in self.ordered[n].pattern.finditer(plain) if m.end() > m.start()]
        found.sort(key=lambda d: (d[2].priority, d[0] - d[1], d[0], d[2].label))
        kept: list[tuple[int, int, Rule]] = []
        reach: list[tuple[int, int]] = []
        for start, end, rule in found:
            if not _contained(reach, start, end):
                kept.append((start, end, rule))
                _add(reach, start, end)
        return sorted(kept, key=lambda d: (d[0], d[1]))


def _contained(reach: list[tuple[int, int]], start: int, end: int) -> bool:
    """Whether an interval of a list sorted by start, none inside another, contains this one."""
    at = bisect_right(reach, (start, 1 << 62)) - 1
    return at >= 0 and reach[at][1] >= end


def _add(reach: list[tuple[int, int]], start: int, end: int) -> None:
    """Keep the intervals sorted by start and by end; those inside the new one are no longer needed."""
    at = bisect_left(reach, (start, end))
    stop = at
    while stop < len(reach) and reach[stop][1] <= end:
        stop += 1
    reach[at:stop] = [(start, end)]


def words_of(text: str) -> bytes:
    """The words with one space between, before and after."""
    return b" " + b" ".join(text.encode().lower().translate(_WORDS).split()) + b" "


def phrase_places(words: bytes, phrase: bytes) -> list[int]:
    """Numbers of the words at which the phrase starts."""
    found, at, counted, count = [], words.find(b" " + phrase + b" "), 0, 0
    while at >= 0:
        count += words.count(b" ", counted, at)
        counted = at
        found.append(count)
        at = words.find(b" " + phrase + b" ", at + 1)
    return found


_scanners: dict = {}
_OUT = "n_words long, n_base long, first_word long, last_word long, base_labels string, labels string, score double, detections array<struct<start:int,end:int,label:string>>"
_DETECTIONS = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32()), ("label", pa.string())]))


def _scan(batches: Iterator[pa.RecordBatch], names: list[str]) -> Iterator[pa.RecordBatch]:
    scanner = _scanners.setdefault("rules", None) or Scanner(rules())
    _scanners["rules"] = scanner
    for batch in small(batches, "text"):
        columns: list[list] = [[] for _ in range(8)]
        for text in batch.column("text").to_pylist():
            text = text or ""
            words = words_of(text)
            places, base = [], set()
            for phrase, label in PHRASES:
                if found := phrase_places(words, phrase):
                    places += found
                    base.add(label)
            kept = scanner.detect(text)
            score = max([0.8 if base else 0.0, *(rule.weight for _, _, rule in kept)])
            labels = base | {rule.label for _, _, rule in kept}
            row = (max(0, words.count(b" ") - 1) if len(words) > 2 else 0, len(places), min(places, default=None), max(places, default=None))
            for column, value in zip(columns, (*row, ",".join(sorted(base)), ",".join(sorted(labels)), score, [{"start": a, "end": b, "label": r.label} for a, b, r in kept])):
                column.append(value)
        kinds = (pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.string(), pa.float64(), _DETECTIONS)
        arrays = [pa.array(c, k) for c, k in zip(columns, kinds)]
        yield pa.RecordBatch.from_arrays([*(batch.column(n) for n in names), *arrays], [*names, *(f.split()[0] for f in ("n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score", "detections"))])


def scan(docs: DataFrame, key: str = "doc_id") -> DataFrame:
    """key and, of the whole text: n_words, n_base, first_word, last_word, base_labels, labels, score, detections.

    n_base counts the places where the words of a phrase of ``PHRASES`` stand one after the other;
    first_word and last_word are the smallest and largest of these places (NULL if there is none).
    labels are those of the phrases and of the rules' detections; score is the weight of the surest
    of them, 0 if there is none. detections hold places in the lower-cased text with runs of
    white space and comment marks as one space. NULL is an empty text. One row per row of docs.
    """
    rows = docs.select(F.col(key), F.col("text"))
    kind = rows.schema[key].dataType.simpleString()
    return rows.mapInArrow(lambda it: _scan(it, [key]), f"`{key}` {kind}, {_OUT}")
