"""License scans by template markup: optional and replaceable regions compiled to token automata."""

from __future__ import annotations

import re
from collections.abc import Mapping
from dataclasses import dataclass
from functools import cache

import pandas as pd
from pyspark.sql import DataFrame, functions as F

from corpusloom.llm.common import narrow

#: Words of the base phrases and their labels.
PHRASES: Mapping[str, str] = {"mit license": "mit", "apache license": "apache", "general public license": "gpl"}

#: Wording of public licenses as templates: [[...]] is optional, {{n}} stands for up to n words of any kind.
TEMPLATES: Mapping[str, str] = {
    "mit-notice": "[[this {{3}} is]] [[dual]] released under the [[terms of the]] MIT License",
    "mit-grant": (
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
        "documentation files (the Software), to deal in the Software without restriction, including without limitation the "
        "rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software"
    ),
    "apache-2.0-notice": "Licensed under the Apache License, Version 2.0 [[(the License)]] [[you may not use this file]]",
    "gpl-notice": (
        "[[this {{3}} is]] licensed under the [[terms of the]] GNU [[Lesser]] [[Affero]] General Public License "
        "[[as published by the Free Software Foundation]] [[either]] version {{1}} [[of the License]] [[or later]]"
    ),
    "gpl-freedom": (
        "you can redistribute it and/or modify it under the terms of the GNU [[Lesser]] [[Affero]] General Public License "
        "as published by the Free Software Foundation"
    ),
    "bsd-grant": (
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the "
        "following conditions are met"
    ),
    "isc-grant": (
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby "
        "granted, provided that the above copyright notice and this permission notice appear in all copies"
    ),
    "cc-by-notice": "licensed under [[a]] [[the]] Creative Commons Attribution {{3}} [[International]] License",
    "mpl-2.0-notice": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0",
}

_WORDS = bytes(
    b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256)
)


def words_of(text: str | None) -> list[bytes]:
    """Runs of ASCII letters and digits (lower-cased) and of characters beyond ASCII."""
    return (text or "").encode("utf-8", "surrogatepass").translate(_WORDS).split()


@dataclass(frozen=True)
class Automaton:
    """States 0 to ``final`` over words: ``step`` by a word, ``free`` by any word, ``skip`` by none."""

    step: Mapping[int, Mapping[bytes, tuple[int, ...]]]
    free: Mapping[int, tuple[int, ...]]
    skip: Mapping[int, tuple[int, ...]]
    final: int
    anchor: tuple[bytes, ...]

    def closed(self, states: set[int]) -> set[int]:
        todo = list(states)
        while todo:
            for t in self.skip.get(todo.pop(), ()):
                if t not in states:
                    states.add(t)
                    todo.append(t)
        return states

    def match(self, words: list[bytes], start: int) -> int:
        """Number of words of the longest match that begins at ``start``; 0 if there is none."""
        states, longest, at = self.closed({0}), 0, start
        while states and at < len(words):
            after: set[int] = set()
            for s in states:
                after.update(self.step.get(s, {}).get(words[at], ()))
                after.update(self.free.get(s, ()))
            states, at = self.closed(after), at + 1
            if self.final in states:
                longest = at - start
        return longest


@cache
def compiled(template: str) -> Automaton:
    """One state after each word; optional and replaceable regions add ways around or through them.

    The anchor is the longest run of mandatory words: a text without it cannot match.
    """
    step: dict[int, dict[bytes, list[int]]] = {}
    free: dict[int, list[int]] = {}
    skip: dict[int, list[int]] = {}
    state, opened, run, anchor = 0, None, [], []

    def mandatory_ends() -> None:
        nonlocal run, anchor
        anchor = run if len(run) > len(anchor) else anchor
        run = []

    for part in re.findall(r"\[\[|\]\]|\{\{\d+\}\}|[^\[\]{}]+", template):
        if part == "[[":
            mandatory_ends()
            opened = state
        elif part == "]]":
            skip.setdefault(opened, []).append(state)
            opened = None
        elif part.startswith("{{"):
            mandatory_ends()
            for _ in range(int(part[2:-2])):
                free.setdefault(state, []).append(state + 1)
                skip.setdefault(state, []).append(state + 1)
                state += 1
        else:
            for word in words_of(part):
                step.setdefault(state, {}).setdefault(word, []).append(state + 1)
                state += 1
                if opened is None:
                    run.append(word)
    mandatory_ends()
    tuples = {s: {w: tuple(t) for w, t in by.items()} for s, by in step.items()}
    return Automaton(
        tuples, {s: tuple(t) for s, t in free.items()}, {s: tuple(t) for s, t in skip.items()}, state, tuple(anchor)
    )


def _places(flat: bytes, phrase: bytes) -> list[int]:
    """Word numbers at which the phrase's words stand; ``flat`` has one blank around every word."""
    out, at, word, seen = [], flat.find(b" " + phrase + b" "), 0, 0
    while at >= 0:
        word += flat.count(b" ", seen, at)
        seen = at
        out.append(word)
        at = flat.find(b" " + phrase + b" ", at + 1)
    return out


def scan(text: str | None, phrases: Mapping[str, str], templates: Mapping[str, str]) -> tuple:
    """n_words, places of phrases, first and last place, labels of phrases, all labels, score of one text."""
    words = words_of(text)
    flat = b" " + b" ".join(words) + b" "
    places, base = [], set()
    for phrase, label in phrases.items():
        if found := _places(flat, phrase.encode()):
            places += found
            base.add(label)
    labels, score = set(base), 0.5 if base else 0.0
    for label, template in templates.items():
        automaton = compiled(template)
        if b" " + b" ".join(automaton.anchor) + b" " not in flat:
            continue
        begins = automaton.closed({0})
        entry = {w for s in begins for w in automaton.step.get(s, {})}
        anywhere = any(automaton.free.get(s) for s in begins)
        if any((anywhere or w in entry) and automaton.match(words, i) for i, w in enumerate(words)):
            labels.add(label)
            score = 1.0
    first, last = (min(places), max(places)) if places else (None, None)
    return len(words), len(places), first, last, ",".join(sorted(base)), ",".join(sorted(labels)), score


def scan_documents(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    phrases: Mapping[str, str] = PHRASES,
    templates: Mapping[str, str] = TEMPLATES,
) -> DataFrame:
    """Licence phrases and templates in every text.

    n_base counts all places of the phrases, first_word and last_word are the smallest and largest (null if none).
    The score is 1 where a template's mandatory wording stands in full, 0.5 where only a phrase does, else 0. A null text
    counts as empty: no words, no labels. Repeated rows, other columns and empty tables need no care: rows are judged
    one by one, whole.
    """
    kinds = "n_words bigint, n_base bigint, first_word bigint, last_word bigint, base_labels string, labels string, score double"

    @F.pandas_udf(kinds)
    def found(texts: pd.Series) -> pd.DataFrame:
        names = [c.split()[0] for c in kinds.split(", ")]
        out = pd.DataFrame([scan(t, phrases, templates) for t in texts], columns=names)
        return out.astype({"first_word": "Int64", "last_word": "Int64"})

    rows = narrow(docs, doc_id=id_col, text=text_col)
    return rows.select("doc_id", found("text").alias("_found")).select("doc_id", "_found.*")
