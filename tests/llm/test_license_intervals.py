"""Detection and suppression against the plain quadratic definition, and on texts of many hits."""

import random
import time

from prepflow.llm import licenses

PIECES = [
    "under the mit license", "apache license version 2", "cc by nc", "cc by nc sa 4 0", "mit license", "licensed under the apache license version 2 0",
    "spdx license identifier mit", "permission is hereby granted free of charge to any person obtaining a copy", "gpl", "the", "license", "all rights reserved",
    "copyright c 2020", "for non commercial use only", "released into the public domain", "gnu general public license v3", "bsd 3 clause license",
]


def plain(words, rules):
    """All hits of all rules, accepted by rank unless an accepted one holds them; places by counting blanks."""
    line = b" ".join(words)
    found = [(m.start(), m.end(), r) for r in rules if any(k <= set(words) for k in r.keywords) for m in r.pattern.finditer(line)]
    found.sort(key=lambda x: (-x[2].priority, x[0] - x[1], x[0], x[2].label))
    taken = []
    for a, b, r in found:
        if not any(x <= a and b <= y for x, y, _ in taken):
            taken.append((a, b, r))
    return sorted(((line.count(b" ", 0, a), line.count(b" ", 0, b) + 1, r) for a, b, r in taken), key=lambda x: x[:2])


def test_detections_equal_the_plain_definition():
    rules, rng = licenses.build_rules(), random.Random(4)
    hits = 0
    for _ in range(150):
        words = licenses.word_list(" ".join(rng.choice(PIECES) for _ in range(rng.randrange(0, 25))))
        got = licenses.detect(words, rules)
        assert got == plain(words, rules)
        hits += len(got)
        phrases = [(p.encode().split(), label) for p, label in licenses.PHRASES.items()]
        assert licenses.base_places(words) == sorted((i, label) for i in range(len(words)) for p, label in phrases if words[i : i + len(p)] == p)
    assert hits > 300


def test_intervals_answer_like_a_list():
    rng, spans, kept = random.Random(2), licenses.Intervals(), []
    for _ in range(3000):
        a = rng.randrange(200)
        b = a + rng.randrange(1, 30)
        held = any(x <= a and b <= y for x, y in kept)
        assert spans.hold(a, b) == held
        if not held:
            kept.append((a, b))
            spans.add(a, b)
        assert spans.starts == sorted(set(spans.starts)) and spans.ends == sorted(set(spans.ends))


def test_many_hits_take_time_in_proportion():
    rules = licenses.build_rules()
    seconds = []
    for n in (5_000, 40_000):
        words = licenses.word_list("mit license cc by nc " * n)
        start = time.process_time()
        assert len(licenses.base_places(words)) == n and len(licenses.detect(words, rules)) >= n
        seconds.append(time.process_time() - start)
    assert seconds[1] < 24 * seconds[0] + 1  # eight times the words; quadratic would be 64 times
