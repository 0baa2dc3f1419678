"""License scans: templates with optional and replaceable regions, compiled to token automata.

A template is mandatory wording in which ``<<beginOptional>> ... <<endOptional>>`` may be missing and
``<<var;words=2-5>>`` stands for so many words of any kind. It is compiled to a nondeterministic
automaton over words; as all regions are bounded, so is the number of words that it looks ahead.
A text is accepted where the mandatory wording matches word for word.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import DataFrame

from .words import segments, utf8

WORD = re.compile(rb"[0-9a-z\x80-\xff]+")
PART = re.compile(r"<<beginOptional>>|<<endOptional>>|<<var;words=(\d+)-(\d+)>>|[^<]+")


class Template(NamedTuple):
    label: str
    text: str
    #: Base templates are the bare phrases that are counted.
    base: bool = False


#: Fixed values.
BASE = (
    Template("gpl", "gnu general public license", True),
    Template("apache", "apache license", True),
    Template("cc-by", "cc by", True),
    Template("mit", "mit license", True),
)
#: Notices by which works name their license, and the granting sentences of short licenses.
NOTICES = (
    Template("apache-notice", "licensed under the Apache License<<beginOptional>>, Version <<var;words=1-2>><<endOptional>>"),
    Template("cc-by-notice", "licensed under <<beginOptional>>a Creative Commons<<endOptional>> CC BY<<beginOptional>>-NC<<endOptional>><<beginOptional>>-SA<<endOptional>><<beginOptional>>-ND<<endOptional>> <<var;words=2-2>>"),
    Template("cc-by-nc-notice", "licensed under <<beginOptional>>a Creative Commons<<endOptional>> CC BY-NC<<beginOptional>>-SA<<endOptional>><<beginOptional>>-ND<<endOptional>> <<var;words=2-2>>"),
    Template("gpl-notice", "licensed under the <<beginOptional>>terms of the<<endOptional>> GNU General Public License<<beginOptional>>, version <<var;words=1-2>><<endOptional>><<beginOptional>> or any later version<<endOptional>>"),
    Template("mit-notice", "released under the <<beginOptional>>terms of the<<endOptional>> MIT License"),
    Template("mit-text", "Permission is hereby granted, free of charge, to any person obtaining a copy of this <<var;words=1-6>> to deal in the <<var;words=1-3>> without restriction"),
    Template("isc-text", "Permission to use, copy, modify, and<<beginOptional>>/or<<endOptional>> distribute this <<var;words=1-3>> for any purpose with or without fee is hereby granted"),
    Template("bsd-text", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met"),
)


class Automaton:
    """States are numbers; step[s] has the state after a word, any[s] the one after whichever word, skip[s] those that need none."""

    def __init__(self, template: Template) -> None:
        self.label, self.base = template.label, template.base
        self.step: list[dict[bytes, int]] = [{}]
        self.any: list[int | None] = [None]
        self.skip: list[set[int]] = [set()]
        self.longest = 0
        begins: list[int] = []
        at = 0
        for part in PART.finditer(template.text):
            if part[0] == "<<beginOptional>>":
                begins.append(at)
            elif part[0] == "<<endOptional>>":
                self.skip[begins.pop()].add(at)
            elif part[1]:
                for i in range(int(part[2])):
                    before, at = at, self._state()
                    self.any[before] = at
                    if i >= int(part[1]):
                        self.skip[before].add(at)
            else:
                for word in WORD.findall(part[0].encode().lower()):
                    before, at = at, self._state()
                    self.step[before][word] = at
        if begins:
            raise ValueError(f"{template.label}: an optional region has no end")
        self.end = at
        self.longest = len(self.step) - 1
        first = self._open({0})
        if any(self.any[s] is not None for s in first) or self.end in first:
            raise ValueError(f"{template.label}: a template begins with a mandatory word")
        self.first = {w for s in first for w in self.step[s]}

    def _state(self) -> int:
        self.step.append({})
        self.any.append(None)
        self.skip.append(set())
        return len(self.step) - 1

    def _open(self, states: set[int]) -> set[int]:
        todo = list(states)
        while todo:
            for s in self.skip[todo.pop()]:
                if s not in states:
                    states.add(s)
                    todo.append(s)
        return states

    def match(self, words: list[bytes], at: int) -> int:
        """How many words from at on the template takes at most; 0 if it is not accepted."""
        states, taken = self._open({0}), 0
        for n in range(at, min(len(words), at + self.longest)):
            word, after = words[n], set()
            for s in states:
                if word in self.step[s]:
                    after.add(self.step[s][word])
                if self.any[s] is not None:
                    after.add(self.any[s])
            if not after:
                break
            states = self._open(after)
            if self.end in states:
                taken = n + 1 - at
        return taken


class Found(NamedTuple):
    n_words: int
    n_base: int
    first_word: int | None
    last_word: int | None
    base_labels: str
    labels: str
    score: float
    #: (label, first word, words) of every place.
    places: list[tuple[str, int, int]]


def scan(data: bytes, automata: list[Automaton]) -> Found:
    """Every place of every template in a text; long texts are read in pieces."""
    by_first: dict[bytes, list[Automaton]] = {}
    for a in automata:
        for w in a.first:
            by_first.setdefault(w, []).append(a)
    ahead = max(a.longest for a in automata)
    words, before, places = [], 0, []
    base: list[int] = []
    base_labels, labels = set(), set()

    def look(to: int) -> None:
        for i in [i for i, w in enumerate(words[:to]) if w in by_first]:
            for a in by_first[words[i]]:
                if n := a.match(words, i):
                    places.append((a.label, before + i, n))
                    labels.add(a.label)
                    if a.base:
                        base.append(before + i)
                        base_labels.add(a.label)

    for _, piece in segments(data.lower()):
        words += WORD.findall(piece)
        done = len(words) - ahead
        if done > 0:
            look(done)
            del words[:done]
            before += done
    look(len(words))
    score = 1.0 if labels - base_labels else 0.5 if labels else 0.0
    return Found(before + len(words), len(base), min(base, default=None), max(base, default=None), ",".join(sorted(base_labels)), ",".join(sorted(labels)), score, places)


def licenses(docs: DataFrame, templates: tuple[Template, ...] = BASE + NOTICES) -> DataFrame:
    """One row per document: doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score, places.

    docs needs doc_id and text; other columns are ignored. n_base counts the places of base
    templates, overlapping ones too; labels has those of all templates that are accepted. score
    is 1 if a notice or a license's text is accepted, 0.5 if only base phrases stand in the text,
    else 0. Null is an empty text: no words, no labels ('') and null first_word and last_word.
    Repeated rows are judged each for itself; an empty table gives no rows.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        automata = [Automaton(t) for t in templates]
        for batch in batches:
            found = list(zip(*(scan(x, automata) for x in utf8(batch.column("text"))), strict=True)) or [()] * 8
            kinds = [pa.int64()] * 4 + [pa.string()] * 2 + [pa.float64(), pa.list_(pa.struct([("label", pa.string()), ("word", pa.int64()), ("words", pa.int64())]))]
            found[7] = [[{"label": a, "word": b, "words": c} for a, b, c in x] for x in found[7]]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *(pa.array(x, k) for x, k in zip(found, kinds, strict=True))], names=["doc_id", *Found._fields])

    kind = dict(docs.dtypes)["doc_id"]
    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {kind}, n_words long, n_base long, first_word long, last_word long, base_labels string, labels string, score double, places array<struct<label:string,word:long,words:long>>")
