"""Personal data: plain identifiers against the patterns as stated, planted disguises."""

import hashlib
import random
import re
import time

import pytest

from deskline.llm.personal_data import KINDS, Edits, Folded, disguised, find_personal_data, identifiers, spelled
from deskline.llm.queries import QUERIES

SF = "/root/testdata/sf0.01"
STATED = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def luhn(digits):
    doubled = [2 * int(d) if i % 2 else int(d) for i, d in enumerate(reversed(digits))]
    return sum(d // 10 + d % 10 for d in doubled) % 10 == 0


def plain_version(text):
    found = []
    for kind, pattern in STATED.items():
        for m in re.finditer(pattern, text or ""):
            digits = re.sub("[^0-9]", "", m[0])
            fits = {
                "email": lambda: True,
                "ip": lambda: all(int(p) <= 255 for p in m[0].split(".")),
                "card": lambda: 12 <= len(digits) <= 19 and luhn(digits),
                "phone": lambda: 9 <= len(digits) <= 15,
            }[kind]
            if fits():
                found.append((kind, m.start(), m.end()))
    return sorted(found, key=lambda s: (s[1], KINDS.index(s[0])))


DISGUISED = [
    ("write to {john.doe (at) example (dot) com} now", "email", "john.doe@example.com"),
    ("{john.doe [at] mail.example [dot] org}", "email", "john.doe@mail.example.org"),
    ("ask {john AT example DOT com}, please", "email", "john@example.com"),
    ("{jane_doe@example dot com} or so", "email", "jane_doe@example.com"),
    ("é {jаne@exаmple.com}", "email", "jane@example.com"),  # Cyrillic а
    ("{jane＠example．com}", "email", "jane@example.com"),
    ("{jo​hn@exa\xadmple.com}!", "email", "john@example.com"),
    ("{fred&#64;example&#46;com}", "email", "fred@example.com"),
    ("{john @ example.com}", "email", "john@example.com"),
    ("{maria arroba ejemplo punto com}", "email", "maria@ejemplo.com"),
    ("{hans klammeraffe beispiel punkt de}", "email", "hans@beispiel.de"),
    ("ring {plus one four one five, five five five, two six seven one} now", "phone", "+14155552671"),
    ("{plus four nine double three zero one two three four five}", "phone", "+4933012345"),
    ("{+1 (555) 5O1-2234}", "phone", "+1 (555) 501-2234"),
    ("ärger: {+４９ ３０ １２３４５６７}", "phone", "+49 30 1234567"),
    ("card {four one one one one one one one one one one one one one one one}", "card", "4111111111111111"),
    ("{4l1l 1111 1111 1111}", "card", "4111 1111 1111 1111"),
    ("{quatre un un un un un un un un un un un un un un un}", "card", "4111111111111111"),
    ("{192[.]168[.]0[.]1}", "ip", "192.168.0.1"),
    ("at {one nine two dot one six eight dot zero dot one} x", "ip", "192.168.0.1"),
    ("{192 dot 168 dot 10 dot 4}", "ip", "192.168.10.4"),
]
CLEAN = [
    "look at example.com please",
    "visit us at example dot com",
    "we saw one, two, three cars",
    "The point of it, at this point, is five or six (at least).",
    "Das ist der Punkt: eins, zwei, drei und zwanzig. Ⅷ 10 Ohm",
    "plus one two three",
    "999.1.1.1 and 4111 1111 1111 1112 and +12 345",
    "пишу тебе @ вечером. Ол1 lO0l",
]


@pytest.mark.parametrize("marked, kind, identifier", DISGUISED)
def test_disguises_are_found_where_they_are(marked, kind, identifier):
    start, stop = marked.index("{"), marked.index("}") - 1
    text = marked.replace("{", "").replace("}", "")
    plain = identifiers(text)
    assert plain == plain_version(text)
    assert (kind, start, stop, identifier) in disguised(text, plain)


@pytest.mark.parametrize("text", CLEAN)
def test_clean_texts_stay_clean(text):
    plain = identifiers(text)
    assert plain == [] and disguised(text, plain) == []


def test_plain_identifiers_equal_the_stated_patterns():
    rnd = random.Random(2)
    for _ in range(30_000):
        text = "".join(rnd.choice("a.@_-+ 0123459b(é") for _ in range(rnd.randint(0, 40)))
        assert identifiers(text) == plain_version(text)


def test_the_way_back():
    rnd = random.Random(4)
    for _ in range(2_000):
        source = "".join(rnd.choice("abc…ｆ​½②") for _ in range(rnd.randint(1, 30)))
        folded = Folded(source)
        for at in range(len(folded.text)):
            start, end = folded.back(at, at + 1)
            assert end == start + 1
            assert folded.text[at] in Folded(source[start]).text
        edits, at = [], 0
        while at < len(source) and len(edits) < 5:
            start = rnd.randint(at, len(source))
            end = rnd.randint(start, min(len(source), start + 3))
            if end == start:
                break
            edits.append((start, end, rnd.choice(["", "x", "xyz"])))
            at = end
        done = Edits(source, edits)
        origin = [None] * len(done.text)
        at = size = 0
        for start, end, new in [*edits, (len(source), len(source), "")]:
            for k in range(at, start):
                origin[size] = (k, k + 1)
                size += 1
            for _ in new:
                origin[size] = (start, end)
                size += 1
            at = end
        assert [done.back(i, i + 1) for i in range(len(done.text))] == origin


def test_long_texts_take_linear_time():
    unit = ["1", "a", "a@", "1.", "+1", "one ", "one two x ", " ", "lo ", "l0 ", "а", "x at ", "x at a dot ", "(at", " dot ", "@ a.", "[ ", "double "]
    for piece in unit:
        text = piece * (300_000 // len(piece))
        began = time.monotonic()
        disguised(text, identifiers(text))
        assert time.monotonic() - began < 10, piece


def test_a_run_keeps_its_neighbours():
    text = "number one is four two four, ok"
    assert Edits(text, spelled(text)).text == "number one is 424, ok"


def test_query_equals_plain_version(spark):
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    rows = QUERIES["op11_personal_data"](spark, SF).collect()
    assert sorted(r.doc_id for r in rows) == sorted(docs)
    seen = 0
    for r in rows:
        want = plain_version(docs[r.doc_id])
        line = ",".join(f"{k}:{s}:{e}" for k, s, e in want)
        assert r.base_sha256 == hashlib.sha256(line.encode()).hexdigest()
        assert [r[f"n_{k}"] for k in KINDS] == [sum(s[0] == k for s in want) for k in KINDS]
        assert set(line.split(",")) <= set(r.spans.split(","))
        seen += len(want)
    assert seen > 50


def test_hard_rows(spark):
    text = DISGUISED[0][0].replace("{", "").replace("}", "")
    data = [(1, None, "x"), (2, "", None), (3, text, "x"), (3, text, "y"), (None, "a@b.c +1 555 123 4567", "x"), (4, "w " * 300_000 + "a@b.c", "x")]
    docs = spark.createDataFrame(data, "key long, body string, spans string")
    rows = find_personal_data(docs, "key", "body").collect()
    found = sorted(((r.id, [(s.kind, s.start, s.stop, s.plain) for s in r.spans], r.masked[-40:]) for r in rows), key=repr)
    email = [("email", 9, 40, False)]
    assert found == sorted(
        [
            (1, [], ""),
            (2, [], ""),
            (3, email, "write to [EMAIL] now"),
            (3, email, "write to [EMAIL] now"),
            (None, [("email", 0, 5, True), ("phone", 6, 21, True)], "[EMAIL] [PHONE]"),
            (4, [("email", 600_000, 600_005, True)], ("w " * 30 + "[EMAIL]")[-40:]),
        ],
        key=repr,
    )
    assert find_personal_data(docs.limit(0), "key", "body").collect() == []
