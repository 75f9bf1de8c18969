"""Surrogates: persons without a title, and the whole of the operator against a version in memory."""

from __future__ import annotations

import itertools
import random
import time

import pytest

from glasslake.llm import pii

#: Sentences that give evidence of a person, in several languages; {} is the full name.
EVIDENCE = [
    "Later {} said that the shipment was late.", "“We are done,” said {} on leaving.", "From: {} <sales@site.org>\nSubject: order", "To: {}\n\nthe order is ready",
    "all is well.\n\nBest regards,\n{}\n", "we wait.\n\nMit freundlichen Grüßen\n\n{}\n", "hello, my name is {} and I write for help", "Ich heiße {} und frage nach.",
    "bonjour, je m'appelle {} et je cherche", "hola, me llamo {} y busco", "Am Abend schrieb {} einen Brief.", "Ayer {} dijo que no.", "ce soir {} répond enfin.",
]
#: Prose with capitals that names no person.
PLAIN = [
    "The Council said no. It Works said the paper.", "North Bridge is closed, New York Times wrote.", "From: Sales\nTo: Marketing\n\nnothing", "George Street and Victoria Station are near.",
    "Regards to all of you", "Subject: Great News Today", "In January Monday Morning went on.", "Die Firma fragte nach. The Committee wrote back.", "President said so. my name is not known",
]


def _names(n: int) -> list[tuple[str, str]]:
    """Given and family names, most of them in no list of the operator."""
    rng = random.Random(3)
    given = ["Olena", "Zoé", "Tarik", "Ngozi", "Wioletta", "Søren", "Anna", "Peter", "Jean-Luc", "Mehmet"]
    family = ["".join(rng.choice(["bra", "kel", "mo", "stav", "rin", "do", "vex", "ulf"]) for _ in range(3)).capitalize() + rng.choice(["", "son", "-Hart", "ski"]) for _ in range(n)]
    return [(given[k % len(given)], f) for k, f in enumerate(family)]


def test_untitled_persons_are_found():
    """Planted persons without a title: every mention of nine in ten is found, here of all; prose without persons has none."""
    found = planted = 0
    for (given, family), sentence in itertools.product(_names(30), EVIDENCE):
        text = sentence.format(f"{given} {family}") + f"\nWord of {family} came, and {given} left."
        got = [(text[a:b], k) for k, a, b, *_ in pii.mentions(text) if k in ("given", "family")]
        planted += 4
        found += min(2, got.count((given, "given"))) + min(2, got.count((family, "family")))
    assert found == planted, (found, planted)
    for text in PLAIN:
        assert not [text[a:b] for k, a, b, *_ in pii.mentions(text)], text


def test_evidence_of_other_shapes():
    name = lambda t: [(k, t[a:b]) for k, a, b, *_ in pii.mentions(t)]
    assert name("then Robert J. Kelman asked") == [("given", "Robert"), ("family", "Kelman")]
    assert name("Minister Kelman said") == [("family", "Kelman")]  # an office is no given name
    assert name("Regards,\nOlena\n") == [("given", "Olena")] and name("From: Olena <o@site.org>")[0] == ("given", "Olena")
    assert name("Вчера Олена Тарнова сказала, что Тарнова") == [("given", "Олена"), ("family", "Тарнова"), ("family", "Тарнова")]
    assert name("Mr. Lang Bauer met Anna Lang") == [("given", "Lang"), ("family", "Bauer"), ("given", "Anna"), ("given", "Lang")]  # one kind in a text
    assert name("") == [] and name("said said Anna") == [] and name("FROM: ") == []


def test_work_grows_with_the_text():
    """Hostile texts: very many names, spaces, letters and heads; none takes more than a few seconds for half a megabyte."""
    many = "".join(f" Mr. N{''.join('abcdefghij'[int(c)] for c in str(k))} left." for k in range(30_000))
    for text in (many, "Anna " + " " * 300_000, "A-" * 200_000, "From: " * 80_000, "Best regards,\n" * 40_000, "said Aa " * 60_000, "A " + "B." * 200_000):
        began = time.process_time()
        pii.mentions(text)
        assert time.process_time() - began < 10
    assert len(pii.mentions(many)) == 30_000


def _in_memory(rows: list[tuple[int, str | None]], key: str) -> set[tuple]:
    """All rounds of draws over all entities at once, and all mentions written."""
    found = [(d, *m, (t or "")[m[1] : m[2]]) for d, t in rows for m in pii.mentions(t or "")]
    gender: dict[tuple[str, str], str] = {}
    for _, kind, _, _, entity, g, _ in found:
        gender[kind, entity] = min(g, gender.get((kind, entity), g))
    attempt = dict.fromkeys(gender, 0)
    while True:
        drawn = {(k, e): pii.surrogate(k, e, gender[k, e], attempt[k, e], key.encode()) for k, e in attempt}
        again = set()
        for kind, entity in drawn:
            if len(entity) == 1:
                continue
            rivals = [(attempt[k, e], e) for (k, e), s in drawn.items() if k == kind and s == drawn[kind, entity] and len(e) > 1]
            if (kind, drawn[kind, entity]) in drawn or min(rivals) != (attempt[kind, entity], entity):
                again.add((kind, entity))
        if not again:
            return {(d, k, a, b, pii.render(surface, k, drawn[k, e])) for d, k, a, b, e, _, surface in found}
        for x in again:
            attempt[x] += 1


@pytest.mark.parametrize("key", ["k", "other"])
def test_surrogates_equal_those_of_memory(spark, key):
    rng = random.Random(11)
    rows: list[tuple[int, str | None]] = [(0, None), (1, "")]
    for k, (given, family) in enumerate(_names(60)):
        text = rng.choice(EVIDENCE).format(f"{given} {family}") + f" {family} {given.upper()} Mr. {family}, {given.lower()}.{k % 7}@site{k % 5}.org, 10.0.{k % 3}.{k}, +49 {100 + k % 40} 1234{k % 10}, 555-010-{1000 + k}."
        rows += [(k + 2, text), (k + 2, text)]
    got = pii.replacements(spark.createDataFrame(rows, "doc_id long, text string"), key).collect()
    want = _in_memory(rows, key)
    assert {(r.doc_id, r.kind, r.start, r.end, r.surrogate) for r in got} == want and len(got) == 2 * len(want)
