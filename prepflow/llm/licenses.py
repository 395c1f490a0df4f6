r"""License mentions by ordered signature rules.

Rules are regular expressions over a text's lower-case words. A rule runs only where all
of its keywords occur. Detections are taken in the order of priority, then length, then
place; one that lies inside an accepted detection is suppressed.
"""

from __future__ import annotations

import re
from bisect import bisect_left, bisect_right
from dataclasses import dataclass
from itertools import accumulate

import pyarrow as pa
from pyspark.sql import DataFrame

from .common import LOWER, texts

#: Phrases whose consecutive words are always reported, with their labels (fixed values).
PHRASES = {"under the mit license": "mit", "apache license version 2": "apache-2", "cc by nc": "cc-by-nc"}

#: Names of licenses: label, full name and identifier as patterns over words, keywords of the name (fixed values).
NAMES = [
    ("agpl-3", "(gnu )?affero general public licen[sc]e( version| v)? ?3", "agpl ?v? ?3( 0)?( only| or later)?", "affero"),
    ("gpl-3", "(gnu )?general public licen[sc]e( version| v)? ?3", "gpl ?v? ?3( 0)?( only| or later)?", "general public"),
    ("gpl-2", "(gnu )?general public licen[sc]e( version| v)? ?2", "gpl ?v? ?2( 0)?( only| or later)?", "general public"),
    ("gpl", "gnu general public licen[sc]e", "gnu gpl", "gnu"),
    ("lgpl-3", "(gnu )?lesser general public licen[sc]e( version| v)? ?3", "lgpl ?v? ?3( 0)?( only| or later)?", "lesser"),
    ("lgpl-2.1", "(gnu )?lesser general public licen[sc]e( version| v)? ?2 1", "lgpl ?v? ?2 1( only| or later)?", "lesser"),
    ("lgpl-2", "(gnu )?library general public licen[sc]e( version| v)? ?2", "lgpl ?v? ?2( 0)?( only| or later)?", "library"),
    ("apache-2", "apache (software )?licen[sc]e( version| v)? ?2( 0)?", "apache 2 0", "apache"),
    ("apache-1.1", "apache (software )?licen[sc]e( version| v)? ?1 1", "apache 1 1", "apache"),
    ("mit", "(the )?mit licen[sc]e", "mit", "mit"),
    ("mit-0", "mit no attribution( licen[sc]e)?", "mit 0", "attribution"),
    ("isc", "(the )?isc licen[sc]e", "isc", "isc"),
    ("bsd-2", "(the )?(2|two) clause bsd licen[sc]e", "bsd 2 clause", "bsd"),
    ("bsd-3", "(the )?(3|three) clause bsd licen[sc]e", "bsd 3 clause", "bsd"),
    ("bsd-4", "(the )?(4|four) clause bsd licen[sc]e", "bsd 4 clause", "bsd"),
    ("bsd", "(the )?bsd( style)? licen[sc]e", "0bsd", "bsd"),
    ("mpl-2", "mozilla public licen[sc]e( version| v)? ?2( 0)?", "mpl ?v? ?2 0", "mozilla"),
    ("mpl-1.1", "mozilla public licen[sc]e( version| v)? ?1 1", "mpl ?v? ?1 1", "mozilla"),
    ("epl-2", "eclipse public licen[sc]e( version| v)? ?2( 0)?", "epl ?v? ?2 0", "eclipse"),
    ("epl-1", "eclipse public licen[sc]e( version| v)? ?1( 0)?", "epl ?v? ?1 0", "eclipse"),
    ("cddl-1", "common development and distribution licen[sc]e", "cddl ?v? ?1 0", "distribution"),
    ("eupl-1.2", "european union public licen[sc]e", "eupl ?v? ?1 2", "european"),
    ("artistic-2", "artistic licen[sc]e( version| v)? ?2( 0)?", "artistic 2 0", "artistic"),
    ("zlib", "(the )?zlib( libpng)? licen[sc]e", "zlib", "zlib"),
    ("boost-1", "boost software licen[sc]e", "bsl 1 0", "boost"),
    ("unlicense", "(the )?unlicense", "unlicense", "unlicense"),
    ("wtfpl", "do what the fuck you want to public licen[sc]e", "wtfpl", "want"),
    ("ofl-1.1", "(sil )?open font licen[sc]e", "ofl 1 1", "font"),
    ("odbl-1", "open database licen[sc]e", "odbl 1 0", "database"),
    ("pddl-1", "public domain dedication and licen[sc]e", "pddl 1 0", "dedication"),
    ("psf-2", "python software foundation licen[sc]e", "psf 2 0", "foundation"),
    ("postgresql", "(the )?postgresql licen[sc]e", "postgresql", "postgresql"),
    ("openssl", "openssl licen[sc]e", "openssl", "openssl"),
    ("ms-pl", "microsoft public licen[sc]e", "ms pl", "microsoft"),
    ("ms-rl", "microsoft reciprocal licen[sc]e", "ms rl", "microsoft"),
    ("afl-3", "academic free licen[sc]e", "afl 3 0", "academic"),
    ("osl-3", "open software licen[sc]e", "osl 3 0", "software"),
    ("ncsa", "university of illinois ncsa open source licen[sc]e", "ncsa", "ncsa"),
    ("gfdl-1.3", "gnu free documentation licen[sc]e", "gfdl 1 3", "documentation"),
    ("sspl-1", "server side public licen[sc]e", "sspl 1 0", "server"),
    ("busl-1.1", "business source licen[sc]e", "busl 1 1", "business"),
    ("elastic-2", "elastic licen[sc]e( version| v)? ?2( 0)?", "elastic 2 0", "elastic"),
    ("cc0", "(creative commons zero|cc0)( 1 0)?( universal)?", "cc0 1 0", "creative commons"),
    ("cc-by-nc-nd", "(creative commons|cc) (attribution|by) (non ?commercial|nc) (no ?derivatives|no derivs|nd)", "cc by nc nd( [1-4] 0)?", "creative commons"),
    ("cc-by-nc-sa", "(creative commons|cc) (attribution|by) (non ?commercial|nc) (share ?alike|sa)", "cc by nc sa( [1-4] 0)?", "creative commons"),
    ("cc-by-nc", "(creative commons|cc) (attribution|by) (non ?commercial|nc)", "cc by nc( [1-4] 0)?", "creative commons"),
    ("cc-by-nd", "(creative commons|cc) (attribution|by) (no ?derivatives|no derivs|nd)", "cc by nd( [1-4] 0)?", "creative commons"),
    ("cc-by-sa", "(creative commons|cc) (attribution|by) (share ?alike|sa)", "cc by sa( [1-4] 0)?", "creative commons"),
    ("cc-by", "(creative commons|cc) (attribution|by)", "cc by( [1-4] 0)?", "creative commons"),
]

#: How a license is named in running text: pattern around the name or identifier, keyword, priority, confidence.
FORMS = [
    ("spdx license identifier {id}", "spdx", 5, 1.0),
    ("permission is hereby granted .{{0,400}}{name}", "permission", 4, 0.95),
    ("(licen[sc]ed|released|distributed|available|published|shared) (under|according to) (the )?(terms of )?(the )?({name}|{id} licen[sc]e)", "", 4, 0.9),
    ("(subject to|governed by|covered by|under) (the )?(terms (and conditions )?of )?(the )?({name}|{id} licen[sc]e)", "", 3, 0.8),
    ("licen[sc]e (is )?({name}|{id})", "", 2, 0.7),
    ("{name}", "", 1, 0.6),
]
#: Signatures without a licence's name: label, pattern, keywords, confidence (fixed values).
OTHERS = [
    ("all-rights-reserved", "all rights reserved", "rights reserved", 0.3),
    ("proprietary", "(strictly )?(confidential and proprietary|proprietary and confidential)", "proprietary", 0.6),
    ("public-domain", "(dedicated to|placed in(to)?|released into) the public domain", "public domain", 0.8),
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy", "hereby charge", 0.9),
    ("isc", "permission to use copy modify and or distribute this software for any purpose", "permission distribute", 0.9),
    ("bsd", "redistribution and use in source and binary forms with or without modification", "redistribution binary", 0.9),
    ("non-commercial", "for (personal and )?non ?commercial (use|purposes) only", "only", 0.6),
    ("copyright", "copyright (c )?(19|20)[0-9][0-9]", "copyright", 0.2),
]


@dataclass(frozen=True)
class Rule:
    label: str
    pattern: re.Pattern
    keywords: tuple  # sets of words; the rule runs where all words of any set occur
    priority: int
    confidence: float


def build_rules() -> list[Rule]:
    """Every name in every form, the signatures without a name, and the phrases above all; in order of priority."""
    whole = lambda p: re.compile(rb"(?<![^ ])(?:" + p.encode() + rb")(?![^ ])", re.S)
    keys = lambda *words: frozenset(w.encode() for k in words for w in k.split())
    rules = [Rule(label, whole(phrase), (keys(phrase),), 9, 1.0) for phrase, label in PHRASES.items()]
    for form, key, priority, sure in FORMS:
        for label, name, short, name_key in NAMES:
            stem, number = re.match("([0-9]*[a-z]+0?)[^0-9]*([0-9]?)", short).groups()
            short_keys = [keys(key, stem), keys(key, stem + number), keys(key, f"{stem}v{number}")]
            by_name = [keys(key, name_key), *([keys(key, stem)] if label.startswith("cc") else [])]
            needed = (by_name if "{name}" in form else []) + (short_keys if "{id}" in form else [])
            rules.append(Rule(label, whole(form.format(name=name, id=short)), tuple(needed), priority, sure))
    rules += [Rule(label, whole(p), (keys(k),), 2, sure) for label, p, k, sure in OTHERS]
    return sorted(rules, key=lambda r: -r.priority)


def word_list(text: str) -> list[bytes]:
    r"""Words ``[^\x00-\x2F\x3A-\x60\x7B-\x7F]+`` after lower-casing A-Z, in UTF-8."""
    return text.encode().translate(LETTERS).split()


LETTERS = bytes(
    c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32 for c in LOWER
)


def detect(words: list[bytes], rules: list[Rule]) -> list[tuple[int, int, Rule]]:
    """Accepted detections as (first word, word after the last, rule), by place."""
    present = set(words)
    rules = [r for r in rules if any(k <= present for k in r.keywords)]
    if not rules:
        return []
    line, found = b" ".join(words), []
    for rule in rules:
        for m in rule.pattern.finditer(line):
            found.append((m.start(), m.end(), rule))
    found.sort(key=lambda x: (-x[2].priority, x[0] - x[1], x[0], x[2].label))
    taken, outer = [], Intervals()
    for a, b, rule in found:
        if not outer.hold(a, b):
            outer.add(a, b)
            taken.append((a, b, rule))
    starts = [0, *accumulate(len(w) + 1 for w in words[:-1])]
    return sorted(((bisect_right(starts, a) - 1, bisect_left(starts, b), r) for a, b, r in taken), key=lambda x: x[:2])


class Intervals:
    """Intervals of which none holds another, so that their starts and ends ascend together and one look tells containment."""

    def __init__(self):
        self.starts: list[int] = []
        self.ends: list[int] = []

    def hold(self, a: int, b: int) -> bool:
        i = bisect_right(self.starts, a) - 1
        return i >= 0 and self.ends[i] >= b

    def add(self, a: int, b: int) -> None:
        """Add one that no other holds; those that it holds are no longer needed."""
        i = bisect_left(self.starts, a)
        j = bisect_right(self.ends, b, lo=i)
        self.starts[i:j], self.ends[i:j] = [a], [b]


def base_places(words: list[bytes]) -> list[tuple[int, str]]:
    """(first word, label) of every place of a phrase."""
    found, present = [], set(words)
    for phrase, label in PHRASES.items():
        parts = phrase.encode().split()
        if present.issuperset(parts):
            at = -1
            for _ in range(words.count(parts[0])):
                at = words.index(parts[0], at + 1)
                if words[at : at + len(parts)] == parts:
                    found.append((at, label))
    return sorted(found)


SCHEMA = (
    "doc_id long, n_words long, n_base long, first_word long, last_word long, base_labels string, labels string, score double, "
    "detections array<struct<first:long,after:long,label:string,confidence:double>>"
)


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row for each row: word count, phrase places, labels, the best confidence as score, and the detections.

    Phrase labels are always among the labels, also where a detection of higher rank
    covers them. Null and empty texts have no words, empty label strings and score 0;
    repeated rows are scanned alike; an empty table gives an empty result.
    """

    def run(batches):
        rules = build_rules()
        for batch in batches:
            out = []
            for key, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                words = word_list(text.as_py())
                base, found = base_places(words), detect(words, rules)
                own = {label for _, label in base}
                labels = own | {r.label for _, _, r in found}
                score = max([1.0 if own else 0.0, *(r.confidence for _, _, r in found)])
                spans = [{"first": a, "after": b, "label": r.label, "confidence": r.confidence} for a, b, r in found]
                first, last = (base[0][0], base[-1][0]) if base else (None, None)
                out.append((key, len(words), len(base), first, last, ",".join(sorted(own)), ",".join(sorted(labels)), score, spans))
            kinds = [*[pa.int64()] * 5, pa.string(), pa.string(), pa.float64()]
            kinds.append(pa.list_(pa.struct([("first", pa.int64()), ("after", pa.int64()), ("label", pa.string()), ("confidence", pa.float64())])))
            columns = list(zip(*out, strict=True)) or [()] * 9
            names = [x.split()[0] for x in SCHEMA.split(", ", 8)]
            yield pa.RecordBatch.from_arrays([pa.array(list(c), k) for c, k in zip(columns, kinds, strict=True)], names=names)

    return texts(docs, id_col, text_col).mapInArrow(run, SCHEMA)
