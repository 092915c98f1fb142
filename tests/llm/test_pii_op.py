"""Personal data spans against Python's regular expressions."""

from __future__ import annotations

import hashlib
import re

from ledgerlake.llm import pii

BASE = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (1 + i % 2)
        total += d - 9 * (d > 9)
    return total % 10 == 0


def fine(kind: str, value: str) -> bool:
    digits = re.sub("[^0-9]", "", value)
    if kind == "ip":
        return all(int(x) <= 255 for x in value.split("."))
    if kind == "card":
        return 13 <= len(digits) <= 19 and luhn(digits)
    return kind == "email" or 9 <= len(digits) <= 15


def base_spans(text: str) -> str:
    return ",".join(f"{k}:{m.start()}:{m.end()}" for k, p in BASE.items() for m in re.finditer(p, text) if fine(k, m[0]))


TEXTS = [
    "", None, "a@b.c@d.e x_y@z.q.w..r a@b.c_d@e.f @@ a@b", "1.2.3.4.5.6.7.8.9 0001.2.3.255 1.2.3.256 12.1.2",
    "4845168114407329 7 4845 1681-1440 7329 1 4845--1681", "+1 (017) 555-7713 +49 30 123 +1234567890123456 +1 2" + " " * 50 + "x",
    "é" * 10 + "ü@ü.de 😀 a@b.de 😀 1.1.1.1", "a@b.c " * 1500 + "9" * 16, "-1" * 3000, "+1" + " " * 5000, "7" * 4000,
]


def test_base_spans(make_docs):
    got = {r.doc_id: r for r in pii.report(pii.spans(make_docs(list(enumerate(TEXTS))))).collect()}
    for i, text in enumerate(TEXTS):
        want = base_spans(text or "")
        assert got[i].base_sha256 == hashlib.sha256(want.encode()).hexdigest(), text
        kinds = [s.split(":")[0] for s in want.split(",")]
        assert (got[i].n_email, got[i].n_ip, got[i].n_card, got[i].n_phone) == tuple(kinds.count(k) for k in BASE)


def test_long_texts_take_linear_time(make_docs):
    rows = list(enumerate(["x" * 400_000, "1." * 100_000, "a." * 200_000, "+1" + " " * 300_000, "A1 " * 100_000]))
    assert pii.spans(make_docs(rows)).count() == 5


def test_places_of_very_many_candidates(make_docs):
    """Texts of more than a block of blocks of candidates: those that pass are few, all, or between others."""
    texts = ["AB12 " * 40_000 + "a@b.c", "a@b.c, " * 40_000, "1.2.3.4 1.2.3.999 " * 20_000]
    got = {r.doc_id: r for r in pii.report(pii.spans(make_docs(list(enumerate(texts))))).collect()}
    for i, text in enumerate(texts):
        assert got[i].base_sha256 == hashlib.sha256(base_spans(text).encode()).hexdigest()


def test_checksums_and_context(make_docs):
    rows = [
        (1, "IBAN: DE89 3704 0044 0532 0130 00 and GB82WEST12345698765432."), (2, "DE89 3704 0044 0532 0130 01"),
        (3, "ssn 123-45-6789"), (4, "part 123-45-6789"), (5, "ssn 000-45-6789"), (6, "call 555-123-4567"), (7, "code 555-123-4567"),
    ]
    got = {r.doc_id: [(s.kind, s.start, s.end) for s in r.spans] for r in pii.spans(make_docs(rows)).collect()}
    assert got[1] == [("iban", 6, 33), ("iban", 38, 60)]
    assert got[3] == [("ssn", 4, 15)] and got[6] == [("tel", 5, 17)]
    assert not (got[2] or got[4] or got[5] or got[7])


def test_redaction_keeps_the_rest(make_docs):
    rows = [(1, "😀 a@b.de, 1.2.3.4!"), (2, "clean"), (3, None), (4, ""), (5, "a@1.2.3.4 b")]
    docs = make_docs(rows)
    new = pii.redacted(docs)
    assert new.columns == docs.columns
    assert {r.doc_id: r.text for r in new.collect()} == {1: "😀 [EMAIL], [IP]!", 2: "clean", 3: None, 4: "", 5: "[EMAIL] b"}


def test_empty_table(make_docs):
    assert pii.report(pii.spans(make_docs([]).limit(0))).collect() == []


def test_redaction_of_very_many_spans(make_docs):
    """Spans at, across and beside the cuts of a text, many of them, characters outside the basic plane included."""
    mails = "😀x@y.de é " * 9_000
    texts = {
        0: (mails, "😀[EMAIL] é " * 9_000),
        1: (" " * 511 + "a@b.c" + " " * 2000 + "1.2.3.4", " " * 511 + "[EMAIL]" + " " * 2000 + "[IP]"),
        2: (" " * 512 + "a@b.c" + " " * 507, " " * 512 + "[EMAIL]" + " " * 507),
        3: (" " * 1536 + "1.2.3.4", " " * 1536 + "[IP]"),
        4: (" " * 510 + "a@b.c" + "é" * 5000, " " * 510 + "[EMAIL]" + "é" * 5000),
        5: ("no spans", "no spans"),
    }
    got = {r.doc_id: r.text for r in pii.redacted(make_docs([(i, t) for i, (t, _) in texts.items()])).collect()}
    assert got == {i: want for i, (_, want) in texts.items()}
