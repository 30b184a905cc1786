"""License scan: ordered signature rules with keyword gates, priority and containment.

Texts are reduced to lower-case words with single blanks. A rule is a regular expression over
that form, a label, a weight and the keywords without which it is not tried: one of its name's
and all of its form's, each a part of everything that the rule can match, so that the prefilter
changes no result. Rules run in order; a detection that lies inside the interval of a kept one is
suppressed.
"""

from __future__ import annotations

import bisect
import functools
import itertools
import re
from typing import NamedTuple

from pyspark.sql import DataFrame

from tripmill.llm.common import WORDS, arrow_rows, documents, utf8

# Phrases that always count, and their labels.
BASE = {"mit license": "mit", "apache license": "apache", "general public license": "gpl"}

#: label stem, name as a pattern over words, versions that are told apart.
FAMILIES = [
    ("mit", "mit", ()),
    ("apache", "apache(?: software)?", ("1 0", "1 1", "2 0")),
    ("gpl", "(?:gnu )?(?:general public|gpl)", ("1 0", "2 0", "3 0", "2", "3")),
    ("lgpl", "(?:gnu )?(?:lesser general public|library general public|lgpl)", ("2 0", "2 1", "3 0", "3")),
    ("agpl", "(?:gnu )?(?:affero general public|agpl)", ("1 0", "3 0", "3")),
    ("gfdl", "(?:gnu )?(?:free documentation|fdl|gfdl)", ("1 1", "1 2", "1 3")),
    ("bsd-2-clause", "(?:bsd 2 clause|2 clause bsd|simplified bsd|freebsd)", ()),
    ("bsd-3-clause", "(?:bsd 3 clause|3 clause bsd|new bsd|modified bsd|revised bsd)", ()),
    ("bsd-4-clause", "(?:bsd 4 clause|4 clause bsd|original bsd)", ()),
    ("bsd", "bsd", ()),
    ("mpl", "(?:mozilla public|mpl)", ("1 0", "1 1", "2 0")),
    ("epl", "(?:eclipse public|epl)", ("1 0", "2 0")),
    ("cddl", "(?:common development and distribution|cddl)", ("1 0", "1 1")),
    ("cpl", "(?:common public|cpl)", ("1 0",)),
    ("eupl", "(?:european union public|eupl)", ("1 0", "1 1", "1 2")),
    ("cecill", "cecill", ("1 0", "2 0", "2 1")),
    ("osl", "(?:open software|osl)", ("1 0", "2 0", "2 1", "3 0")),
    ("afl", "(?:academic free|afl)", ("1 1", "2 0", "2 1", "3 0")),
    ("artistic", "artistic", ("1 0", "2 0")),
    ("bsl", "(?:boost software|bsl)", ("1 0",)),
    ("isc", "isc", ()),
    ("zlib", "(?:zlib|zlib libpng)", ()),
    ("unlicense", "(?:the )?unlicense", ()),
    ("wtfpl", "(?:do what the fuck you want to public|wtfpl)", ("2",)),
    ("python", "(?:python software foundation|psf)", ("2", "2 0")),
    ("openssl", "openssl", ()),
    ("php", "php", ("3 0", "3 01")),
    ("ofl", "(?:sil open font|ofl)", ("1 0", "1 1")),
    ("cc0", "(?:cc0|creative commons zero)", ("1 0",)),
    ("cc-by-nc-nd", "(?:cc|creative commons) (?:by nc nd|attribution non ?commercial no ?derivatives)", ("2 0", "2 5", "3 0", "4 0")),
    ("cc-by-nc-sa", "(?:cc|creative commons) (?:by nc sa|attribution non ?commercial share ?alike)", ("2 0", "2 5", "3 0", "4 0")),
    ("cc-by-nc", "(?:cc|creative commons) (?:by nc|attribution non ?commercial)", ("2 0", "2 5", "3 0", "4 0")),
    ("cc-by-nd", "(?:cc|creative commons) (?:by nd|attribution no ?derivatives)", ("2 0", "2 5", "3 0", "4 0")),
    ("cc-by-sa", "(?:cc|creative commons) (?:by sa|attribution share ?alike)", ("2 0", "2 5", "3 0", "4 0")),
    ("cc-by", "(?:cc|creative commons) (?:by|attribution)", ("2 0", "2 5", "3 0", "4 0")),
    ("odbl", "(?:open database|odbl)", ("1 0",)),
    ("openrail", "(?:open ?rail|responsible ai)", ()),
]

#: Forms of a notice from the most to the least telling: pattern, weight, keyword, whether with a
#: version.
FORMS = [
    (r"spdx license identifier {name} {version}", 1.0, "spdx", True),
    (r"(?:licensed|released|distributed|available|published) under (?:the )?(?:terms of )?(?:the )?"
     r"{name}(?: international)?(?: licen[cs]e)?(?: version)?(?: ?v ?| ?){version}", 0.98, "under", True),
    (r"{name}(?: licen[cs]e)?(?: version)?(?: ?v ?| ?){version}(?: international)?(?: licen[cs]e)?", 0.9, "", True),
    (r"spdx license identifier {name}", 0.95, "spdx", False),
    (r"(?:licensed|released|distributed|available|published) under (?:the )?(?:terms of )?(?:the )?"
     r"{name}(?: licen[cs]e)?", 0.85, "under", False),
    (r"(?:see|under|subject to) the (?:terms of )?(?:the )?{name} licen[cs]e", 0.8, "licen", False),
    (r"{name} licen[cs]ed?", 0.7, "licen", False),
]

#: Sentences of license texts and ownership notices.
SENTENCES = [
    ("permission is hereby granted free of charge to any person obtaining a copy", "mit", 1.0),
    ("permission to use copy modify and or distribute this software for any purpose", "isc", 1.0),
    ("redistribution and use in source and binary forms with or without modification", "bsd", 1.0),
    ("you may not use this file except in compliance with the license", "apache", 0.9),
    ("this program is free software you can redistribute it and or modify it", "gpl", 0.9),
    ("this library is free software you can redistribute it and or modify it", "lgpl", 0.9),
    ("this is free and unencumbered software released into the public domain", "unlicense", 1.0),
    ("the above copyright notice and this permission notice shall be included in all copies", "mit", 1.0),
    ("neither the name of [^ ]+(?: [^ ]+){0,8} nor the names of its contributors may be used to endorse", "bsd-3-clause", 1.0),
    ("all advertising materials mentioning features or use of this software must display", "bsd-4-clause", 1.0),
    ("either version [23] of the license or at your option any later version", "gpl", 0.9),
    ("everyone is permitted to copy and distribute verbatim copies of this license document", "gpl", 0.9),
    ("this program is free software you can redistribute it and or modify it under the terms of the gnu affero", "agpl", 1.0),
    ("this source code form is subject to the terms of the mozilla public license", "mpl", 1.0),
    ("the accompanying program is provided under the terms of this eclipse public license", "epl", 1.0),
    ("unless required by applicable law or agreed to in writing software distributed under the license", "apache", 0.9),
    ("altered source versions must be plainly marked as such", "zlib", 1.0),
    ("permission is hereby granted free of charge to any person or organization obtaining a copy of the software", "bsl", 1.0),
    ("anyone is free to copy modify publish use compile sell or distribute this software", "unlicense", 1.0),
    ("everyone is permitted to copy and distribute verbatim or modified copies of this license document", "wtfpl", 1.0),
    ("waived all copyright and related or neighboring rights", "cc0", 0.9),
    ("this font software is licensed under the sil open font license", "ofl", 1.0),
    ("permission is granted to copy distribute and or modify this document under the terms of the gnu free documentation", "gfdl", 1.0),
    (r"(?:dedicated|released) (?:in)?to the public domain", "public-domain", 0.8),
    (r"copyright(?: c)?(?: \d{4})? [^ ]+(?: [^ ]+){0,6} all rights reserved", "proprietary", 0.6),
    ("all rights reserved", "proprietary", 0.4),
]


class Rule(NamedTuple):
    pattern: re.Pattern
    label: str
    weight: float
    names: tuple[bytes, ...]  # one of these, each at the start of a word
    needs: tuple[bytes, ...]  # and all of these


@functools.cache
def rules() -> tuple[Rule, ...]:
    """All rules in order of priority: sentences, then forms, telling ones first."""
    made = [_rule(p, label, weight, [_longest(p)], []) for p, label, weight in SENTENCES]
    for form, weight, word, versioned in FORMS:
        for stem, name, versions in FAMILIES:
            for version in versions if versioned else ("",):
                label = f"{stem}-{version.replace(' ', '.')}" if version else stem
                pattern = form.format(name=name, version=version)
                made.append(_rule(pattern, label, weight, _marks(name), [word, version]))
    return tuple(made)


def _rule(pattern: str, label: str, weight: float, names: list[str], needs: list[str]) -> Rule:
    own = re.compile(f" {pattern}(?= )".encode())
    return Rule(
        own, label, weight,
        tuple(f" {k}".encode() for k in names), tuple(k.encode() for k in needs if k),
    )


@functools.cache
def _gates() -> tuple[list[bytes], list[bytes]]:
    """Every keyword of a name, and every other keyword, of all rules."""
    names = {k for rule in rules() for k in rule.names}
    return sorted(names), sorted({k for rule in rules() for k in rule.needs})


def candidates(text: bytes) -> list[Rule]:
    """The rules whose keywords the text has, in order; no other rule can match."""
    names, needs = _gates()
    named = {k for k in names if k in text}
    if not named:
        return []
    there = {k for k in needs if k in text}
    return [r for r in rules() if not named.isdisjoint(r.names) and there.issuperset(r.needs)]


def _longest(sentence: str) -> str:
    plain = re.sub(r"\([^()]*\)\S*|\[\S*|\\\S+", " ", sentence)
    return max((w for w in plain.split() if w.isalnum()), key=len)


def _marks(name: str) -> list[str]:
    """What a family's name must contain: the alternatives of its first obligatory part."""
    first = re.sub(r"\(\?:[^()]*\)\?", "", name)
    group = re.match(r"\(\?:([^()]*)\)", first)
    return [w.split(" ?")[0] for w in (group[1] if group else first).split("|")]


def detections(text: bytes) -> list[tuple[int, int, str, float]]:
    """(start, end, label, weight) kept by priority and containment; text is ' word word '."""
    kept: list[tuple[int, int, str, float]] = []
    # outermost intervals by start; none contains another, so their ends ascend too
    starts: list[int] = []
    ends: list[int] = []
    for rule in candidates(text):
        for m in rule.pattern.finditer(text):
            start, end = m.start() + 1, m.end()
            at = bisect.bisect_right(starts, start)
            if at and end <= ends[at - 1]:
                continue
            kept.append((start, end, rule.label, rule.weight))
            # those that the new one contains cannot suppress anything that it does not
            first = bisect.bisect_left(starts, start)
            last = bisect.bisect_right(ends, end)
            starts[first : max(first, last)] = [start]
            ends[first : max(first, last)] = [end]
    return kept


def base_places(text: bytes) -> list[tuple[int, str]]:
    """(start, label) of every place of a base phrase."""
    found = []
    for phrase, label in BASE.items():
        own = f" {phrase} ".encode()
        at = text.find(own)
        while at >= 0:
            found.append((at + 1, label))
            at = text.find(own, at + 1)
    return found


SCANNED = (
    "doc_id bigint, n_words bigint, n_base bigint, first_word bigint, last_word bigint,"
    " base_labels string, labels string, score double, spans string"
)


def scan(docs: DataFrame) -> DataFrame:
    """One row per document: counts of words and base phrases, labels, score and spans.

    spans: label:first word:end word of kept detections. score: the greatest weight of a kept
    detection, at least 0.7 beside a base phrase, else 0. Null and empty texts have no words;
    repeated rows are scanned once each; other columns are not read. Of equal intervals the rule
    listed first stays. Texts of any length are scanned whole, each in one task.
    """

    def scan_batches(batches):
        for batch in batches:
            rows = []
            for doc_id, text in zip(batch.column("doc_id").to_pylist(), utf8(batch)):
                words = text.translate(WORDS).split()
                rows.append((doc_id, len(words), *_scan_words(words)))
            yield arrow_rows(rows, SCANNED)

    return documents(docs).mapInArrow(scan_batches, SCANNED)


_NOTHING = (0, None, None, "", "", 0.0, "")


def _scan_words(words: list[bytes]) -> tuple:
    text = b" " + b" ".join(words) + b" "
    base = base_places(text)
    found = detections(text)
    if not base and not found:
        return _NOTHING
    # the number of the word that starts at a byte, and of the one after a word's last byte
    word_starts = list(itertools.accumulate((len(w) + 1 for w in words), initial=1))
    at = [bisect.bisect_left(word_starts, start) for start, _ in base]
    labels = {label for _, label in base}
    spans = sorted(
        (bisect.bisect_left(word_starts, a), bisect.bisect_left(word_starts, b), label)
        for a, b, label, _ in found
    )
    score = max([w for *_, w in found] + [0.7] * bool(base))
    return (
        len(base),
        min(at, default=None),
        max(at, default=None),
        ",".join(sorted(labels)),
        ",".join(sorted(labels | {label for *_, label in spans})),
        score,
        ",".join(f"{label}:{a}:{b}" for a, b, label in spans),
    )
