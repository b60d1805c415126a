import hashlib
import re

from lakeloom.llm import pii
from corpora import corpus

PATTERNS = {"email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
            "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}


def luhn(digits):
    total = 0
    for i, c in enumerate(reversed(digits)):
        v = int(c) * (1 + i % 2)
        total += v - 9 * (v > 9)
    return total % 10 == 0


def base(text):
    out = []
    for kind, pattern in PATTERNS.items():
        for m in re.finditer(pattern, text):
            digits = re.sub("[^0-9]", "", m.group(0))
            if {"email": lambda: True, "ip": lambda: all(int(p) <= 255 for p in m.group(0).split(".")),
                    "card": lambda: 16 <= len(digits) <= 19 and luhn(digits), "phone": lambda: 8 <= len(digits) <= 15}[kind]():
                out.append((kind, m.start(), m.end()))
    return out


HARD = [
    "a@b.c.@d.e x@y", "joe.b@x.org_x@d.e.f", "ü 1.2.3.4.5.6.7.8 256.1.1.1 0001.02.3.4 99999999999999999999.1.1.1",
    "4111111111111111 4111-1111-1111-1111 +1 (386) 555-3733 call 386-555-3733 now", "x" * 60000, "1 " * 20000,
    "a." * 20000 + "@", "+1" * 1000 + "(((((", "😀 4111 1111 1111 1111 and 378282246310005 card", "+1 2" * 4000,
    "a@b.c," * 3000, "..@..", "a@-.-", "+12345678+123456789", "1.1.1.1@1.1.1.1"]


def test_base_spans_equal_the_patterns(spark, stored):
    rows = list(enumerate(HARD)) + [(100 + (d or 0), t) for d, t in corpus(7, 10) if d is not None] + [(900, None), (901, ""), (901, "")]
    got = pii.op2_pii(spark, stored(rows)).collect()
    texts = dict(rows)
    assert len(got) == len(rows)
    for r in got:
        want = base(texts[r.doc_id] or "")
        said = ",".join(f"{k}:{a}:{b}" for k, a, b in want)
        assert r.base_sha256 == hashlib.sha256(said.encode()).hexdigest(), r.doc_id
        assert [r.n_email, r.n_ip, r.n_card, r.n_phone] == [sum(k == kind for k, _, _ in want) for kind in PATTERNS]
        assert set(filter(None, said.split(","))) <= set(filter(None, r.spans.split(",")))


def test_votes_teach_a_further_phone_but_not_a_serial_number(spark, stored):
    rows = [(i, f"please call +1 (386) 555-{1000 + i} today or mail joe{i}@example.com") for i in range(60)]
    rows += [(100, "fax (386) 555-1234 today"), (101, "serial 386 555 1234x"), (102, "nothing here")]
    got = {r.doc_id: r.spans for r in pii.op2_pii(spark, stored(rows)).collect()}
    assert got[100] == "phone:4:18" and got[101] == "" and got[102] == ""


def test_empty_table(spark, stored):
    assert pii.op2_pii(spark, stored([], "none")).count() == 0
