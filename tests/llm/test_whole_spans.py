"""Personal data: whole identifiers, disguised IP addresses and spaced marks."""

from __future__ import annotations

import random
import re

import pytest

from tableferry.llm import pii

DIGIT_WORDS = ("zero", "one", "two", "three", "four", "five", "six", "seven", "eight", "nine")


@pytest.mark.parametrize(("hidden", "kind"), [
    ("jоhn@example.com", "email"), ("john dot smith@example.com", "email"), ("john@example.cоm", "email"), ("john@mail.example [dot] com", "email"),
    ("+49 170 12345 ６７８", "phone"), ("192[.]168[.]1[.]1", "ip"), ("192 dot 168 dot 1 dot 1", "ip"), ("192.168[.]1.1", "ip"),
    ("one nine two dot one six eight dot one dot one", "ip"), ("10 (dot) 0 (dot) 0 (dot) 255", "ip"), ("jane @ example . com", "email"),
    ("jane.doe@example . org", "email"), ("jane @ mail . example . co", "email"),
])
def test_whole_identifiers_are_added(hidden, kind):
    text = f"é see {hidden}, thanks"
    base, extra = pii.all_spans(text, whole=True)
    assert [(k, text[a:b]) for k, a, b in extra] == [(kind, hidden)]
    assert base == pii.detect(text) and pii.mask(text, base + extra) == f"é see <{kind}>, thanks"


@pytest.mark.parametrize("text", [
    "1 dot 2 dot 3 dot 4 dot 5", "300 dot 1 dot 1 dot 1", "version 1.2.3 dot 4x", "we met @ home . It was late", "at home . com and more", "one dot two dot three",
    "an x192 dot 168 dot 1 dot 1", "see a@example.com . then", "1990 dot 1 dot 1 dot 1",
])
def test_plain_language_near_addresses_is_left_alone(text):
    assert pii.all_spans(text, whole=True)[1] == []


def test_planted_addresses_against_a_plain_rewriting():
    """Every planted identifier is found with its full range, however it is disguised."""
    rnd = random.Random(8)
    dots = [".", "[.]", "[dot]", " dot ", " (dot) ", " [ . ] ", "{dot}"]
    for _ in range(2000):
        parts = [rnd.randrange(256) for _ in range(4)]
        shown = [" ".join(DIGIT_WORDS[int(c)] for c in str(p)) if rnd.random() < 0.2 else str(p) for p in parts]
        joints = [rnd.choice(dots) for _ in range(3)]
        if joints == ["."] * 3:
            joints[rnd.randrange(3)] = rnd.choice(dots[1:])
        hidden = "".join(a + b for a, b in zip(shown, [*joints, ""], strict=True))
        before, after = rnd.choice(["", "é from ", "(", "host: "]), rnd.choice(["", " now", ")", ", and"])
        text = before + hidden + after
        # Plain rewriting: words to digits, marks to dots, without positions.
        plain = hidden
        for n, word in enumerate(DIGIT_WORDS):
            plain = plain.replace(word, str(n))
        plain = re.sub(r"(?<=[0-9]) (?=[0-9])", "", re.sub(r"\s*[\[({]?\s*(?:dot|\.)\s*[\])}]?\s*", ".", plain))
        assert plain == ".".join(map(str, parts))
        assert [(k, text[a:b]) for k, a, b in pii.all_spans(text, whole=True)[1]] == [("ip", hidden)], text


def test_disjoint_and_whole_spans_cover_the_same():
    rnd = random.Random(9)
    pieces = ["a@b.co", "jоhn@example.com", " dot ", "[at]", "１", "+49 170 12345", " one two three ", "192[.]168[.]1[.]1", ", ", "x", "4111 1111 1111 1111", "@", " . com "]
    for _ in range(3000):
        text = "".join(rnd.choice(pieces) for _ in range(rnd.randrange(12)))
        cover = [{n for _, a, b in sum(pii.all_spans(text, whole), []) for n in range(a, b)} for whole in (False, True)]
        assert cover[0] == cover[1]
        assert all(pii.all_spans(text, whole)[0] == pii.detect(text) for whole in (False, True))


def test_query_reports_whole_spans(spark):
    frame = spark.createDataFrame([(1, "mail jоhn@example.com now"), (2, None), (3, "")], "doc_id int, text string")
    rows = {r.doc_id: r.pii for r in pii.find_pii(frame).collect()}
    assert [(s.kind, s.start, s.end) for s in rows[1].added] == [("email", 5, 21)] and [(s.start, s.end) for s in rows[1].base] == [(7, 21)]
    assert all(rows[n].base == rows[n].added == [] for n in (2, 3))
    split = pii.find_pii(frame, whole=False).where("doc_id = 1").first().pii
    assert [(s.start, s.end) for s in split.added] == [(5, 7)]
