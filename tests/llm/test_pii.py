import random
import re

import pytest
from corpus_cases import EDGE

from tidegauge.llm import pii

EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")


def brute(text):
    def digits(m):
        return re.sub("[^0-9]", "", m[0])

    def luhn(number):
        twice = [int(c) * (2 if i % 2 else 1) for i, c in enumerate(number[::-1])]
        return sum(n // 10 + n % 10 for n in twice) % 10 == 0

    return {
        "email": [m.span() for m in EMAIL.finditer(text)],
        "ip": [m.span() for m in IP.finditer(text) if all(int(p) <= 255 for p in m[0].split("."))],
        "card": [m.span() for m in CARD.finditer(text) if 13 <= len(digits(m)) <= 19 and luhn(digits(m))],
        "phone": [m.span() for m in PHONE.finditer(text) if 9 <= len(digits(m)) <= 15],
    }


def test_base_equals_the_plain_patterns():
    rng = random.Random(5)
    for _ in range(20_000):
        text = "".join(rng.choice("ab1234567890..@@--+ ()%_") for _ in range(rng.randint(0, 40)))
        assert pii.base_spans(text) == brute(text), text


@pytest.mark.parametrize(
    ("kind", "text"),
    [
        ("email", "write to [john (at) example (dot) com] now"),
        ("email", "[john.doe at mail dot example dot org]!"),
        ("email", "[jane [at] corp.co.uk] ok"),
        ("email", "[jоhn@еxample.com]"),
        ("email", "[john＠example．com]"),
        ("email", "[j​ohn@exam​ple.com]"),
        ("email", "[anna AT example DOT de]"),
        ("phone", "call [plus one three two three five five five nine eight three zero] today"),
        ("phone", "[+１ (３２３) 555‑9830]"),
        ("card", "card [four one one one one one one one one one one one one one one one] ok"),
        ("card", "[4111‐1111‐1111‐1111]"),
        ("ip", "ip [one nine two dot one six eight dot one dot one]"),
        ("ip", "[192[.]168[.]1[.]1]"),
    ],
)
def test_disguises_map_back_to_the_source(kind, text):
    start, end = text.index("["), text.rindex("]") - 1
    text = text[:start] + text[start + 1 : end + 1] + text[end + 2 :]
    spans = pii.all_spans(text, pii.base_spans(text))
    assert spans[kind] == [(start, end)]


def test_clean_texts_have_none():
    for text in ("Meet me at the dot on the map.", "one two three go", "Un deux trois, soleil", "a point at issue", "версия 1.2.3"):
        assert not any(pii.all_spans(text, pii.base_spans(text)).values())


def test_table(docs_of):
    mine = "x@y.zz, and a (at) b (dot) org"
    rows = pii.find_pii(docs_of([*EDGE, (8, mine), (8, mine), (9, "1" * 20_000 + "@" * 20_000)])).collect()
    found = [(r["n_email"], r["base_email"], r["spans"]) for r in rows if r["doc_id"] == 8]
    assert found == [(2, 1, "email:0:6,email:12:30")] * 2
    assert len(rows) == len(EDGE) + 3 and sum(r["n_email"] for r in rows) == 4
    assert pii.find_pii(docs_of([])).collect() == []


@pytest.mark.parametrize(
    ("kind", "text"),
    [
        ("phone", "call [plus 49 30 1234567] today"),
        ("phone", "call [+ 49 30 1234567] today"),
        ("ip", "host [one.two.three.four] is up"),
        ("ip", "host [1 ( . ) 2 dot 3 dot 4] is up"),
        ("email", "write [juan arroba example.com] now"),
        ("email", "write [jan ät example.de] now"),
        ("email", "write [jan at example.de] now"),
        ("email", "write [jan ( at ) example.de] now"),
        ("ip", "host [one dot ſix dot three dot four] is up"),
    ],
)
def test_disguises_do_not_need_another_character(kind, text):
    start, end = text.index("["), text.rindex("]") - 1
    text = text[:start] + text[start + 1 : end + 1] + text[end + 2 :]
    for whole in (text, text + " " + "x" * 400 + " \u2014 \u201cquoted\u201d"):
        assert pii.all_spans(whole, pii.base_spans(whole))[kind] == [(start, end)]


def test_spans_are_the_same_without_the_gate(monkeypatch):
    rng = random.Random(6)
    parts = [
        *"0 1 49 . - + ( ) [ ] { } < > @ , _ a".split(), " ", " ", " ", "\t", "\n", "  ", "plus", "PLUS", "dot", "Punkt", "point",
        "at", "AT", "ät", "Ät", "arroba", "one", "Two", "ſix", "sİx", "fünf", "null", "juan", "example", "com", "de", "pl", "é",
    ]
    texts = ["".join(rng.choice(parts) for _ in range(rng.randint(2, 24))) for _ in range(60_000)]
    gated = [pii.all_spans(t, pii.base_spans(t)) for t in texts]
    closed = sum(not pii.suspicious(t) for t in texts)
    monkeypatch.setattr(pii, "suspicious", lambda text: True)
    for text, spans in zip(texts, gated, strict=True):
        assert pii.all_spans(text, pii.base_spans(text)) == spans, text
    assert closed > 5_000


@pytest.mark.parametrize(
    "text",
    [
        "write [jane (at) firma.pl] now",
        "write [info [at] site.ca].",
        "[x (at) host dot se]",
        "[x {at} mail.firma.com.au], please",
        "[kim <at> kaisha.jp]",
        "[max (ät) firma dot online]",
        "[ana arroba casa.br]",
    ],
)
def test_any_domain_after_a_sure_at(text):
    start, end = text.index("["), text.rindex("]") - 1
    text = text[:start] + text[start + 1 : end + 1] + text[end + 2 :]
    assert pii.all_spans(text, pii.base_spans(text))["email"] == [(start, end)]


def test_prose_around_the_plain_word_has_none():
    for text in ("He was at home.Then (a) he left.", "see us at noon.Bring it", "thanks @john.smith dot", "item (a) first.second"):
        assert not any(pii.all_spans(text, pii.base_spans(text)).values()), text


def test_long_names_and_what_lies_around_do_not_cut_an_address():
    for n in (10, 199, 200, 201, 500, 1_500):
        for text in (
            f"write to {'a' * n} (at) host dot org now",
            f"{'word ' * 90}jane (at) {'h' * n} dot org {'word ' * 90}",
            f"{'x ' * 300}{'b' * (n // 2)}.{'c' * (n // 2)} [at] host.museum",
            f"{'x ' * 300}{' dot '.join('abcdefgh' for _ in range(n // 40 + 1))} at host dot com {'y ' * 300}",
        ):
            found = pii.all_spans(text, pii.base_spans(text))["email"]
            whole = [m.span() for m in pii._DISGUISED.finditer(text)]
            assert found == whole and len(found) == 1, (n, text)


def test_parts_around_hints_give_what_the_whole_text_gives():
    rng = random.Random(8)
    parts = ["jane", "(at)", "[at]", " at ", "dot", " dot ", ".", "com", "org", " ", " ", "word ", "firma", "_at_", "x" * 60, "-", "\n"]
    for _ in range(400):
        text = "".join(rng.choice(parts) for _ in range(rng.randrange(5, 200)))
        whole, end = [], 0
        for m in pii._DISGUISED.finditer(text):
            whole.append(m.span())
        got, end = [], 0
        for hint in pii._HINT.finditer(text):
            if hint.start() >= end:
                for m in pii._around(text, end, *hint.span()):
                    got.append(m.span())
                    end = m.end()
        assert got == whole, text
