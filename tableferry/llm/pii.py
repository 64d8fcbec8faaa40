"""Personal data: identifiers in texts, also where they are disguised.

Base detectors find e-mail addresses, IP addresses, card and phone numbers as they stand. For
disguised ones, small transducers rewrite a text (homoglyphs, digits spelled as words, "at" and
"dot" for @ and .) and keep, for every piece of the result, the source characters it came from.
The same detectors run over the rewritten text, and their spans are mapped back.

All positions are characters (code points) of the source text. Every text is scanned in time
proportional to its length; rewriting is tried only where a text shows a sign of a disguise.
"""

from __future__ import annotations

import re
from bisect import bisect_right
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tableferry.llm.common import tidy

KINDS = ("email", "ip", "card", "phone")
#: The detectors' characters.
LOCAL = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-"
DOMAIN = re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
# A match can only begin where a run of digits does, so the searches start there.
IP = re.compile(r"(?<![0-9])[0-9]+(?:\.[0-9]+){3}")
CARD = re.compile(r"(?<![0-9])[0-9](?:[\x20-]?[0-9])++")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")

#: Characters that look like ASCII ones, beyond full-width forms.
LOOKALIKES = {
    "а": "a", "е": "e", "о": "o", "р": "p", "с": "c", "у": "y", "х": "x", "і": "i", "ј": "j", "ѕ": "s", "ԁ": "d", "һ": "h", "ԛ": "q", "ԝ": "w",
    "А": "A", "В": "B", "Е": "E", "К": "K", "М": "M", "Н": "H", "О": "O", "Р": "P", "С": "C", "Т": "T", "Х": "X", "І": "I", "Ј": "J", "Ѕ": "S",
    "α": "a", "ο": "o", "ρ": "p", "ν": "v", "ι": "i", "κ": "k", "υ": "u", "Α": "A", "Β": "B", "Ε": "E", "Ζ": "Z", "Η": "H", "Ι": "I", "Κ": "K",
    "Μ": "M", "Ν": "N", "Ο": "O", "Ρ": "P", "Τ": "T", "Υ": "Y", "Χ": "X", "ı": "i", "ⅼ": "l", "․": ".", "。": ".", "‐": "-", "‑": "-", "–": "-",
    " ": " ", " ": " ", " ": " ", " ": " ",
}
#: Digits spelled in four languages.
SPELLED = {
    "zero": "0", "oh": "0", "one": "1", "two": "2", "three": "3", "four": "4", "five": "5", "six": "6", "seven": "7", "eight": "8", "nine": "9",
    "null": "0", "eins": "1", "zwei": "2", "drei": "3", "vier": "4", "fünf": "5", "sechs": "6", "sieben": "7", "acht": "8", "neun": "9",
    "zéro": "0", "un": "1", "deux": "2", "trois": "3", "quatre": "4", "cinq": "5", "sept": "7", "huit": "8", "neuf": "9",
    "cero": "0", "uno": "1", "dos": "2", "tres": "3", "cuatro": "4", "cinco": "5", "seis": "6", "siete": "7", "ocho": "8", "nueve": "9",
}
_CODES = {ord(k): v for k, v in LOOKALIKES.items()}
_CODES |= {0xFF01 + n: chr(0x21 + n) for n in range(94)}  # full-width ASCII
_CODES |= {base + n: str(n) for base in (0x0660, 0x06F0, 0x0966, *range(0x1D7CE, 0x1D800, 10)) for n in range(10)}
HIDDEN = re.compile("[" + "".join(map(re.escape, map(chr, sorted(_CODES)))) + "]")
#: Characters without width are removed.
INVISIBLE = re.compile("[​‌‍⁠﻿­]+")
_WORD = "|".join(sorted(SPELLED, key=len, reverse=True))
#: Ten digits or more, some of which may be spelled; "plus" may precede them.
NUMBER = re.compile(rf"(?<![^\W_])(?:(?:plus|\+)[\s(-]*)?(?:(?:{_WORD}|[0-9])(?>[\s.,;/()-]{{1,4}}|(?=[0-9])|(?<=[0-9]))){{9,}}(?:{_WORD}|[0-9])(?![^\W_])", re.I)
DIGIT = re.compile(rf"{_WORD}|[0-9]", re.I)
#: Digits of a phone number, of a card number, and the fewest of either.
PHONE_DIGITS, CARD_DIGITS, LEAST = range(10, 16), range(14, 20), 10
#: A run that lists numbers of several digits ("1990, 1991 and so on") is one number only with so many different digit words.
DIFFERENT = 3
LISTED = re.compile(r"[^,;\n\r]+")
SEPARATORS = str.maketrans("-,.;:/()[]{}<>\"'!?*", " " * 19)
OPEN, SHUT = r"[\[({<]", r"[\])}>]"
#: " at " and " dot ", bare or in brackets, and in brackets without spaces.
AT = re.compile(rf"\s*+{OPEN}\s*+(?:at|@)\s*+{SHUT}\s*+|\s++(?:at|@)\s++|\s++@|@\s++|@", re.I)
DOT = rf"(?:\s*+{OPEN}\s*+(?:dot|\.|punkt|point|punto)\s*+{SHUT}\s*+|\s++(?:dot|punkt|point|punto)\s++)"
#: Names joined by dots, plain or disguised: what may stand before and after the @.
LOCALS = re.compile(rf"[A-Za-z0-9_%+-]++(?:(?:\.|{DOT})[A-Za-z0-9_%+-]++)*+", re.I)
#: A host's dots may also stand between spaces.
HOST_DOT = rf"(?:{DOT}|\s++\.\s++)"
HOSTS = re.compile(rf"[A-Za-z0-9-]++(?:(?:\.|{HOST_DOT})[A-Za-z0-9-]++)*+", re.I)
MARK = re.compile(DOT, re.I)
HOST_MARK = re.compile(HOST_DOT, re.I)
JOINT = re.compile(rf"\.|{HOST_DOT}", re.I)
#: Four numbers, as digits or as up to three digit words, joined by dots of which one is disguised; no fifth follows or precedes.
_PART = rf"(?:[0-9]{{1,3}}|(?:{_WORD})(?:[\s-](?:{_WORD})){{0,2}})"
HOST_NUMBER = re.compile(rf"(?<![^\W_])(?<![0-9]\.){_PART}(?:(?:\.|{DOT}){_PART}){{3,}}(?![^\W_])", re.I)
PART = re.compile(_PART, re.I)
LETTERS = re.compile("[A-Za-z]{2,24}")
#: The last part of an address whose @ or last dot is a bare word.
TOP = frozenset("com org net edu gov info biz io co ai app dev me de fr es it uk eu us ca ch at nl be pl ru jp cn in br au".split())
DOTS = ("dot", "punkt", "point", "punto")
#: "Write to jane at example.com" is an address, "look at example.com" is not: before a bare "at" and a plain
#: host, a name shows itself by a sign that words do not have, or by a word for mail shortly before it.
NAMELIKE = re.compile("(?=.*[A-Za-z]).*[0-9._%+]")
MAIL = re.compile(r"mail|contact|courriel|correo|kontakt|write to|reach|schreib", re.I)
NEAR = 40
NO_NAMES = frozenset("us me it them him her you we i is are be look only here there online found available directly and or arrive mail email e-mail".split())
BRACKETED = re.compile(rf"{OPEN}\s*+(?:at|@|\.)\s*+{SHUT}", re.I)
SIGN = re.compile(rf"{OPEN}\s*+(?:at|dot|@|\.|punkt|point|punto)\s*+{SHUT}|\s(?:dot|punkt|point|punto)\s|\s@|@\s|@[A-Za-z0-9.-]+\s++\.\s", re.I)
BARE = re.compile(rf"\s[Aa][Tt]\s++[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)*\.(?:{'|'.join(sorted(TOP))})(?![A-Za-z0-9@-])", re.I)

Span = tuple[str, int, int]
#: (first, end, replacement) in the source of one transducer.
Edit = tuple[int, int, str]


def emails(text: str) -> Iterator[tuple[int, int]]:
    free = 0
    for m in DOMAIN.finditer(text) if "@" in text else ():
        at = start = m.start()
        while start > free and text[start - 1] in LOCAL:
            start -= 1
        if start < at:
            yield start, m.end()
            free = m.end()


def _luhn(digits: str) -> bool:
    total = sum(map(int, digits[-1::-2])) + sum(2 * d - 9 * (d > 4) for d in map(int, digits[-2::-2]))
    return total % 10 == 0


def _digits(found: str) -> str:
    return found.translate({32: None, 40: None, 41: None, 43: None, 45: None, 46: None})


def detect(text: str) -> list[Span]:
    """The base spans, by start and then by kind."""
    spans = [("email", a, b) for a, b in emails(text)]
    for m in IP.finditer(text):
        if all(len(p.lstrip("0")) < 4 and int(p.lstrip("0") or 0) < 256 for p in m[0].split(".")):
            spans.append(("ip", m.start(), m.end()))
    for m in CARD.finditer(text):
        if m.end() - m.start() < 14:
            continue
        digits = _digits(m[0])
        if 14 <= len(digits) <= 19 and _luhn(digits):
            spans.append(("card", m.start(), m.end()))
    for m in PHONE.finditer(text) if "+" in text else ():
        if 10 <= len(_digits(m[0])) <= 15:
            spans.append(("phone", m.start(), m.end()))
    return sorted(spans, key=lambda s: (s[1], KINDS.index(s[0])))


class Traced:
    """A rewritten text with the source range of every piece of it."""

    def __init__(self, text: str):
        self.text = text
        #: Pieces: start in the text, start and end in the source, and whether they run in step.
        self.pieces = [(0, 0, len(text), True)]

    def source(self, start: int, end: int) -> tuple[int, int]:
        """The source characters that text[start:end] came from."""
        starts = [p[0] for p in self.pieces]
        first, last = (self.pieces[bisect_right(starts, at) - 1] for at in (start, end - 1))
        return (first[1] + start - first[0] if first[3] else first[1],
                last[1] + end - last[0] if last[3] else last[2])

    def apply(self, edits: list[Edit]) -> None:
        """Replace parts of the text, in order and without overlap."""
        if not edits:
            return
        out, pieces, size, at = [], [], 0, 0

        def keep(upto):
            nonlocal size
            starts = [p[0] for p in self.pieces]
            n = bisect_right(starts, at) - 1
            while n < len(self.pieces) and self.pieces[n][0] < upto:
                low, a, b, step = self.pieces[n]
                high = self.pieces[n + 1][0] if n + 1 < len(self.pieces) else len(self.text)
                x, y = max(low, at), min(high, upto)
                if x < y:
                    pieces.append((size + x - at, a + x - low if step else a, a + y - low if step else b, step))
                n += 1
            out.append(self.text[at:upto])
            size += upto - at

        for start, end, new in edits:
            keep(start)
            if new:
                pieces.append((size, *self.source(start, end), False))
                out.append(new)
                size += len(new)
            at = end
        keep(len(self.text))
        self.text, self.pieces = "".join(out), pieces or [(0, 0, 0, True)]


def invisible(text: str) -> list[Edit]:
    return [(m.start(), m.end(), "") for m in INVISIBLE.finditer(text)]


def _may_spell_number(text: str) -> bool:
    """Whether words and numbers in a row hold enough digits, of which one is spelled."""
    size, spelled = 0, False
    for token in text.lower().translate(SEPARATORS).split():
        if token in SPELLED:
            size, spelled = size + 1, True
        elif "0" <= token[0] <= "9" or "0" <= token[-1] <= "9":
            size += len(token)
            spelled |= not token.isdigit()
        elif size:
            if spelled and size >= LEAST:
                return True
            size, spelled = 0, False
    return spelled and size >= LEAST


def _is_number(digits: str) -> bool:
    return len(digits) in PHONE_DIGITS or len(digits) in CARD_DIGITS and _luhn(digits)


def spelled_numbers(text: str) -> list[Edit]:
    """Runs of digits and digit words, at least one of them, that a detector takes once they are rewritten."""
    edits = []

    def judge(start, end):
        found = [d.lower() for d in DIGIT.findall(text, start, end)]
        digits, words = "".join(SPELLED.get(d, d) for d in found), SPELLED.keys() & found
        # A number that stands there as it is, and one digit word beside it: that word is ordinary language.
        beside = sum(d in SPELLED for d in found) == 1 and detect(text[start:end])
        if words and _is_number(digits) and not beside:
            sign = "+" if text[start] == "+" or text[start: start + 4].lower() == "plus" else ""
            edits.append((start, end, sign + digits))
            return True
        return False

    for m in NUMBER.finditer(text) if _may_spell_number(text) else ():
        parts = [(p.start(), p.end()) for p in LISTED.finditer(text, m.start(), m.end())]
        lists = len(parts) > 1 and any(len(DIGIT.findall(text, *p)) > 1 for p in parts)
        if lists and len(SPELLED.keys() & {d.lower() for d in DIGIT.findall(m[0])}) < DIFFERENT or not judge(m.start(), m.end()):
            for start, end in parts if len(parts) > 1 else ():
                own = text[start:end]
                judge(start + len(own) - len(own.lstrip(" \t.;/()-")), start + len(own.rstrip(" \t.;/()-+")))
    return edits


def _may_hide_address(text: str) -> bool:
    low = text.lower()
    if ("@" in text or any(dot in low for dot in DOTS) or BRACKETED.search(text) is not None) and SIGN.search(text) is not None:
        return True
    return "at" in low and BARE.search(text) is not None


def disguised_hosts(text: str) -> list[Edit]:
    """IP addresses with a disguised dot, and their digits if they are spelled."""
    low = text.lower()
    if not (any(dot in low for dot in DOTS) or BRACKETED.search(text)):
        return []
    edits = []
    for m in HOST_NUMBER.finditer(text):
        # What lies between dots; a part's own words stand between spaces or hyphens.
        bounds = [m.start(), *(x for j in JOINT.finditer(text, m.start(), m.end()) for x in j.span()), m.end()]
        parts = ["".join(SPELLED.get(d, d) for d in DIGIT.findall(text[a:b].lower())) for a, b in zip(bounds[::2], bounds[1::2], strict=True)]
        if len(parts) == 4 and all(int(p) < 256 for p in parts) and MARK.search(text, m.start(), m.end()):
            edits.append((m.start(), m.end(), ".".join(parts)))
    return edits


def _host_end(text: str, start: int, end: int, bare_at: bool) -> int:
    """Where the longest plausible host in text[start:end] ends, or 0: its last part has letters
    only, and is a known one after a dot as a bare word and, if no dot is in brackets, a bare at.
    A dot between spaces counts before a known last part in small letters, and not after a bare at."""
    joints = [(m.start(), m.end()) for m in JOINT.finditer(text, start, end)]
    if not joints:
        return 0
    ends = [a for a, _ in joints[1:]] + [end]
    spaced = [text[a:b].strip() == "." and b - a > 1 for a, b in joints]
    bracketed = [not text[a:b].strip().isalpha() and b - a > 1 and not s for (a, b), s in zip(joints, spaced, strict=True)]
    at = found = 0
    any_bracket = False
    for (a, b), stop, bracket, space in zip(joints, ends, bracketed, spaced, strict=True):
        last = text[b:stop]
        if space:
            if bare_at:
                break
            found = stop if last in TOP else found
            continue
        any_bracket |= bracket
        if LETTERS.fullmatch(last):
            known = last.lower() in TOP
            bare_dot = text[a:b].strip().isalpha()
            if known or not bare_dot and (any_bracket or not bare_at):
                found = stop
            elif any_bracket or not bare_at:
                at = at or stop
    return found or at


def disguised_addresses(text: str) -> list[Edit]:
    """The marks of addresses with a disguised @, or a plain one and a disguised dot."""
    edits: list[Edit] = []
    place = 0 if _may_hide_address(text) else len(text)
    while local := LOCALS.search(text, place):
        place = local.end()
        at = AT.match(text, place)
        host = at and HOSTS.match(text, at.end())
        if not host or text[host.end(): host.end() + 1] in ("@", "_"):
            continue
        bare = at[0].strip().lower() == "at"
        end = _host_end(text, host.start(), host.end(), bare)
        marks = [m for a, b, pattern in ((local.start(), local.end(), MARK), (host.start(), end, HOST_MARK)) for m in pattern.finditer(text, a, b)] if end else []
        if not end or len(at[0]) == 1 and not marks:
            continue
        if bare and not marks and not NAMELIKE.match(local[0]) and (
                local[0].lower() in NO_NAMES or not MAIL.search(text, max(0, local.start() - NEAR), local.start())):
            continue
        edits += sorted([(m.start(), m.end(), ".") for m in marks] + [(at.start(), at.end(), "@")])
        place = end
    return edits


def _plain(text: str) -> str:
    """``text`` with look-alikes replaced one by one, so that positions stay; else the same object."""
    if text.isascii():
        return text
    try:  # Latin-1 has only two characters that are rewritten
        text.encode("latin-1")
        return text.translate(_CODES) if "\xa0" in text else text
    except UnicodeEncodeError:
        return text.translate(_CODES) if HIDDEN.search(text) else text


def disguised(text: str) -> list[Span]:
    """Spans in the source that only the rewritten text shows, by the same detectors."""
    plain = _plain(text)
    traced = Traced(plain)
    changed = plain is not text
    for transducer in (invisible,) * (not text.isascii()) + (spelled_numbers, disguised_hosts, disguised_addresses):
        edits = transducer(traced.text)
        changed |= bool(edits)
        traced.apply(edits)
    if not changed:
        return []
    found = [(kind, *traced.source(a, b)) for kind, a, b in detect(traced.text)]
    # A spelled number has no separators or sign to tell a phone number by.
    touched = [p for p in traced.pieces if not p[3]]
    for start, a, b, _ in touched:
        digits = re.match("[0-9]{10,15}", traced.text[start: start + 16])
        if digits and (start + len(digits[0]) == len(traced.text) or not traced.text[start + len(digits[0])].isdigit()):
            found.append(("phone", a, b))
    return found


def outside(start: int, end: int, spans: list[tuple[int, int]]) -> Iterator[tuple[int, int]]:
    """The parts of a range that none of ``spans`` (sorted, without overlap) covers."""
    for n in range(max(0, bisect_right(spans, (start,)) - 1), len(spans)):
        a, b = spans[n]
        if a >= end:
            break
        if start < a:
            yield start, a
        start = max(start, b)
    if start < end:
        yield start, end


def union(ranges: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Sorted ranges without overlap that cover what ``ranges`` do."""
    out: list[tuple[int, int]] = []
    for a, b in sorted(ranges):
        if out and a < out[-1][1]:
            out[-1] = (out[-1][0], max(b, out[-1][1]))
        else:
            out.append((a, b))
    return out


def all_spans(text: str, whole: bool = False) -> tuple[list[Span], list[Span]]:
    """Base spans, and what deobfuscation adds to them.

    An identifier that is disguised in part may hold a base span, or a part of one. Base spans
    stay as they are. With ``whole``, the identifier's full range is added, over them; else only
    the rest of it, so that no two spans overlap and all together cover it. What base spans, or
    one added span before it, cover in full is not added.
    """
    base = detect(text)
    covered = union([(a, b) for _, a, b in base])
    extra: list[Span] = []
    reach = 0
    for kind, a, b in sorted(disguised(text), key=lambda s: (s[1], KINDS.index(s[0]))):
        # Later spans begin no earlier, so only the added one that reaches farthest can cover this one.
        low = max(a, reach)
        rest = list(outside(low, b, covered)) if low < b else []
        extra += [(kind, a, b)] * bool(rest) if whole else [(kind, x, y) for x, y in rest]
        reach = max(reach, b) if rest else reach
    return base, extra


SPANS = "array<struct<kind: string, start: bigint, end: bigint>>"


def find_pii(documents: DataFrame, *, text: str = "text", into: str = "pii", whole: bool = True) -> DataFrame:
    """``documents`` with one more column, a struct of ``base`` and ``added`` spans.

    A span is (kind, start, end): code points of the text, end exclusive, by start and then in
    the order of ``KINDS``. ``added`` spans come from rewriting; each is a whole identifier, also
    where base spans lie in it. Without ``whole`` they never overlap another span: of an
    identifier that holds base spans, the parts around them are added.
    All rows and columns of ``documents`` stay, repeated rows too; a column named ``into`` is
    replaced. A null or empty text has no spans.
    """
    names = [c for c in documents.columns if c != into]
    kind = f"struct<base: {SPANS}, added: {SPANS}>"
    frame = documents.select(*names, F.lit(None).cast(kind).alias(into))
    at, last = names.index(text), len(names)

    def add(batches):
        for batch in batches:
            found = []
            for value in batch.column(at):
                base, extra = all_spans(value.as_py() or "", whole)
                found.append({name: [{"kind": k, "start": a, "end": b} for k, a, b in spans] for name, spans in (("base", base), ("added", extra))})
            yield pa.RecordBatch.from_arrays([*batch.columns[:last], pa.array(found, batch.schema.field(last).type)], names=batch.schema.names)

    return frame.mapInArrow(tidy(add), frame.schema)


def mask(text: str, spans: list[Span]) -> str:
    """``text`` with every span replaced by its kind in angle brackets; overlapping ones are one, of the first's kind."""
    out, at = [], 0
    for kind, a, b in sorted(spans, key=lambda s: (s[1], -s[2])):
        if a >= at:
            out += [text[at:a], f"<{kind}>"]
            at = b
        elif b > at:  # the rest of an overlapping span goes too
            at = b
    return "".join([*out, text[at:]])


def mask_pii(documents: DataFrame, *, text: str = "text") -> DataFrame:
    """``documents`` with every span of ``text``, base or added, replaced by its kind.

    Rows, columns and nulls stay as they are; a text without spans is not changed.
    """
    at = documents.columns.index(text)

    def replace(batches):
        for batch in batches:
            texts = []
            for value in batch.column(at).to_pylist():
                spans = detect(value or "") + disguised(value or "")
                texts.append(mask(value, spans) if spans else value)
            yield batch.set_column(at, batch.schema.field(at), pa.array(texts, batch.schema.field(at).type))

    return documents.mapInArrow(tidy(replace), documents.schema)
