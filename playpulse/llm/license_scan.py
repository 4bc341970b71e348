"""Licence statements by template markup, matched anywhere in a text.

A template is plain wording with two kinds of markup, in the manner of licence list
templates: [[wording]] may be left out, and {{n}} stands for any words, n at most (names,
years). Everything else is mandatory, word for word; case and punctuation do not count.
Templates are compiled into token automata and started wherever a text has the first
mandatory words of one; a template is found if the automaton reaches its end.

Phrases (the base scan) are counted at all their places. Words are looked up by hash and
compared by their letters, so no collision can add a place.

The scan is one pass without a shuffle; a text of any length is scanned whole.

Defined cases: null and empty texts have no words, no labels and score 0. Other columns of
the input are not used. Rows with equal texts have equal results.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from playpulse.llm import bytewords

#: Phrases of the base scan and their labels.
PHRASES = {
    "gnu general public license": "gpl",
    "apache license": "apache",
    "cc by": "cc-by",
    "mit license": "mit",
}

#: Wording of public licences and of the usual notices.
TEMPLATES = {
    "MIT": [
        "released under the [[terms of the]] mit license",
        "licensed under the [[terms of the]] mit license",
        "permission is hereby granted free of charge to any person obtaining a copy of this "
        "software and associated documentation files the software to deal in the software "
        "without restriction including without limitation the rights to use copy modify merge "
        "publish distribute sublicense and or sell copies of the software and to permit "
        "persons to whom the software is furnished to do so subject to the following "
        "conditions the above copyright notice and this permission notice [[including the next "
        "paragraph]] shall be included in all copies or substantial portions of the software "
        "[[the software is provided as is without warranty of any kind express or implied "
        "including but not limited to the warranties of merchantability fitness for a "
        "particular purpose and noninfringement]]",
    ],
    "ISC": [
        "permission to use copy modify and or distribute this software for any purpose with or "
        "without fee is hereby granted provided that the above copyright notice and this "
        "permission notice appear in all copies",
    ],
    "BSD": [
        "redistribution and use in source and binary forms with or without modification are "
        "permitted provided that the following conditions are met [[1]] redistributions of "
        "source code must retain the above copyright notice this list of conditions and the "
        "following disclaimer [[2]] redistributions in binary form must reproduce the above "
        "copyright notice this list of conditions and the following disclaimer in the "
        "documentation and or other materials provided with the distribution "
        "[[[[3]] neither the name of {{12}} nor the names of its contributors may be used to "
        "endorse or promote products derived from this software without specific prior "
        "written permission]]",
    ],
    "Apache-2.0": [
        "licensed under the apache license version 2 0",
        "licensed under the apache license version 2 0 the license you may not use this file "
        "except in compliance with the license",
    ],
    "GPL-2.0": [
        "licensed under the gnu general public license version 2",
        "free software you can redistribute it and or modify it under the terms of the gnu "
        "general public license as published by the free software foundation either version 2 "
        "of the license [[or at your option any later version]]",
    ],
    "GPL-3.0": [
        "licensed under the gnu general public license version 3",
        "free software you can redistribute it and or modify it under the terms of the gnu "
        "general public license as published by the free software foundation either version 3 "
        "of the license [[or at your option any later version]]",
    ],
    "MPL-2.0": [
        "subject to the terms of the mozilla public license v 2 0",
    ],
    "CC-BY-4.0": [
        "licensed under [[a creative commons]] cc by 4 0",
        "licensed under a creative commons attribution 4 0 international license",
    ],
    "CC-BY-NC-4.0": [
        "licensed under [[a creative commons]] cc by nc 4 0",
        "licensed under a creative commons attribution noncommercial 4 0 international license",
    ],
    "CC-BY-SA-4.0": [
        "licensed under [[a creative commons]] cc by sa 4 0",
        "licensed under a creative commons attribution sharealike 4 0 international license",
    ],
    "all-rights-reserved": [
        "copyright {{8}} all rights reserved",
    ],
}

TEMPLATE_SCORE = 1.0
PHRASE_SCORE = 0.5

_MARKUP = re.compile(r"\[\[|\]\]|\{\{(\d+)\}\}|[^\s\[\]{}]+")


@dataclass
class Automaton:
    """Steps: ("word", bytes), ("any", most) and ("skip to", step)."""

    steps: list[tuple[str, bytes | int]] = field(default_factory=list)

    @classmethod
    def compile(cls, template: str) -> Automaton:
        steps: list[tuple[str, bytes | int]] = []
        opened: list[int] = []
        for token in _MARKUP.finditer(template):
            if token[0] == "[[":
                opened.append(len(steps))
                steps.append(("skip to", -1))
            elif token[0] == "]]":
                steps[opened.pop()] = ("skip to", len(steps))
            elif token[1]:
                steps.append(("any", int(token[1])))
            else:
                steps.append(("word", token[0].encode()))
        if opened or not steps or steps[0][0] != "word":
            raise ValueError(f"a template begins with a word and closes its brackets: {template}")
        return cls(steps)

    @property
    def opening(self) -> list[bytes]:
        """The mandatory words it begins with, three at most."""
        words: list[bytes] = []
        for kind, value in self.steps[:3]:
            if kind != "word":
                break
            words.append(value)
        return words

    def _open(self, states: set[tuple[int, int]]) -> set[tuple[int, int]]:
        """States reached without reading a word: (step, words read by an `any` step)."""
        found, todo = set(), list(states)
        while todo:
            state = todo.pop()
            if state in found:
                continue
            found.add(state)
            if state[0] < len(self.steps):
                kind, value = self.steps[state[0]]
                if kind == "skip to":
                    todo += [(state[0] + 1, 0), (value, 0)]
                elif kind == "any":
                    todo.append((state[0] + 1, 0))
        return found

    def match(self, words: bytewords.Words, start: int, stop: int) -> int | None:
        """Where the longest match from word `start` ends; None if there is none."""
        states, end = self._open({(0, 0)}), None
        for place in range(start, stop + 1):
            if any(at == len(self.steps) for at, _ in states):
                end = place
            if place == stop:
                break
            word, after = words.word(place), set()
            for at, used in states:
                if at == len(self.steps):
                    continue
                kind, value = self.steps[at]
                if kind == "word" and value == word:
                    after.add((at + 1, 0))
                elif kind == "any" and used < value:
                    after.add((at, used + 1))
            if not after:
                break
            states = self._open(after)
        return end

    def regex(self, word: str = "[^ ]+") -> str:
        """The same language as a regular expression over words that each end in a blank."""
        closing: dict[int, int] = {}
        for kind, value in self.steps:
            if kind == "skip to":
                closing[value] = closing.get(value, 0) + 1
        out = ""
        for at, (kind, value) in enumerate(self.steps):
            out += ")?" * closing.get(at, 0)
            if kind == "word":
                out += re.escape(value.decode()) + " "
            elif kind == "any":
                out += f"(?:{word} ){{0,{value}}}"
            else:
                out += "(?:"
        return out + ")?" * closing.get(len(self.steps), 0)


def _gram(words: list[bytes]) -> np.uint64:
    joined = next(bytewords.words(pa.array([b" ".join(words).decode()])))
    return bytewords.rolling(joined.hashes, len(words))[0]


def _is(words: bytewords.Words, place: int, wanted: list[bytes]) -> bool:
    return all(words.word(place + j) == w for j, w in enumerate(wanted))


def _scan(phrases: dict[str, str], templates: dict[str, list[str]], id_type: pa.DataType):
    wanted = [(p.encode().split(), label) for p, label in phrases.items()]
    automata = [(Automaton.compile(t), label) for label, ts in templates.items() for t in ts]
    sought: dict[int, dict[int, list]] = {}
    for words, label in wanted:
        sought.setdefault(len(words), {}).setdefault(int(_gram(words)), []).append((words, label, None))
    for automaton, label in automata:
        words = automaton.opening
        sought.setdefault(len(words), {}).setdefault(int(_gram(words)), []).append(
            (words, label, automaton)
        )

    def found(words: bytewords.Words) -> Iterator[tuple[int, str, int, int, bool]]:
        """(text number, label, first and end word within the text, whether a template)."""
        rows = words.rows
        for size, by_gram in sought.items():
            grams = bytewords.rolling(words.hashes, size)
            for place in np.flatnonzero(np.isin(grams, np.array(list(by_gram), np.uint64))):
                row = int(rows[place])
                first, stop = int(words.bounds[row]), int(words.bounds[row + 1])
                if place + size > stop:
                    continue
                for opening, label, automaton in by_gram[int(grams[place])]:
                    if not _is(words, place, opening):
                        continue
                    end = automaton.match(words, place, stop) if automaton else place + size
                    if end is not None:
                        yield row, label, place - first, end - first, automaton is not None

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column("doc_id").cast(id_type)
            for words in bytewords.words(batch.column("text")):
                hits: list[list] = [[] for _ in range(words.n_texts)]
                for row, *hit in found(words):
                    hits[row].append(
                        dict(zip(("label", "begin", "end", "is_template"), hit, strict=True))
                    )
                yield pa.record_batch(
                    {
                        "doc_id": ids.slice(words.first_row, words.n_texts),
                        "n_words": words.counts.astype(np.int64),
                        "found": pa.array(
                            [sorted(h, key=lambda x: (x["begin"], x["end"], x["label"])) for h in hits],
                            pa.list_(
                                pa.struct(
                                    {
                                        "label": pa.string(),
                                        "begin": pa.int64(),
                                        "end": pa.int64(),
                                        "is_template": pa.bool_(),
                                    }
                                )
                            ),
                        ),
                    }
                )

    return scan


def licenses(
    documents: DataFrame,
    phrases: dict[str, str] | None = None,
    templates: dict[str, list[str]] | None = None,
) -> DataFrame:
    """(doc_id, n_words, found) for every row: found lists (label, begin, end, is_template)."""
    kind = documents.schema["doc_id"].dataType
    scan = _scan(
        PHRASES if phrases is None else phrases,
        TEMPLATES if templates is None else templates,
        to_arrow_type(kind),
    )
    return documents.select("doc_id", F.col("text").cast("string").alias("text")).mapInArrow(
        scan,
        f"doc_id {kind.simpleString()}, n_words long, "
        "found array<struct<label:string,begin:long,end:long,is_template:boolean>>",
    )


def summary(found: DataFrame) -> DataFrame:
    """One row of figures for each row of licenses()."""
    base = F.filter("found", lambda x: ~x["is_template"])
    starts = F.transform(base, lambda x: x["begin"])
    labels = F.array_sort(F.array_distinct(F.col("found.label")))
    base_labels = F.array_sort(F.array_distinct(F.transform(base, lambda x: x["label"])))
    score = (
        F.when(F.exists("found", lambda x: x["is_template"]), F.lit(TEMPLATE_SCORE))
        .when(F.size("found") > 0, F.lit(PHRASE_SCORE))
        .otherwise(F.lit(0.0))
    )
    return found.select(
        "doc_id",
        "n_words",
        F.size(base).cast("long").alias("n_base"),
        F.array_min(starts).alias("first_word"),
        F.array_max(starts).alias("last_word"),
        F.array_join(base_labels, ",").alias("base_labels"),
        F.array_join(labels, ",").alias("labels"),
        score.alias("score"),
    )


def oracle_sql() -> str:
    """The scan as SQL for DuckDB: phrases by comparing words, templates as expressions."""
    upper, lower = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    lists, bases = [], []
    for n, (phrase, label) in enumerate(PHRASES.items()):
        test = " AND ".join(f"words[i + {j}] = '{w}'" for j, w in enumerate(phrase.split()))
        lists.append(f"list_filter(range(1, len(words) + 1), lambda i: {test}) AS p{n}")
        bases.append(f"CASE WHEN len(p{n}) > 0 THEN ['{label}'] ELSE [] END")
    places = "list_concat(" * (len(PHRASES) - 1) + "p0"
    places += "".join(f", p{n})" for n in range(1, len(PHRASES)))
    cases = []
    for label, templates in TEMPLATES.items():
        tests = " OR ".join(
            f"regexp_matches(joined, ' {Automaton.compile(t).regex()}')" for t in templates
        )
        cases.append(f"CASE WHEN {tests} THEN ['{label}'] ELSE [] END")
    return rf"""
    WITH split AS (
        SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), '{upper}', '{lower}'),
            '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words
        FROM documents
    ), placed AS (
        SELECT doc_id, words, ' ' || array_to_string(words, ' ') || ' ' AS joined,
               {", ".join(lists)}
        FROM split
    ), told AS (
        SELECT doc_id, len(words)::BIGINT AS n_words, {places} AS places,
               [{", ".join(bases)}] AS bases, [{", ".join(cases)}] AS more
        FROM placed
    )
    SELECT doc_id, n_words, len(places)::BIGINT AS n_base,
           (list_min(places) - 1)::BIGINT AS first_word,
           (list_max(places) - 1)::BIGINT AS last_word,
           array_to_string(list_sort(list_distinct(flatten(bases))), ',') AS base_labels,
           array_to_string(list_sort(list_distinct(flatten(list_concat(bases, more)))), ',')
               AS labels,
           CASE WHEN len(flatten(more)) > 0 THEN {TEMPLATE_SCORE}::DOUBLE
                WHEN len(places) > 0 THEN {PHRASE_SCORE}::DOUBLE ELSE 0::DOUBLE END AS score
    FROM told
    """
