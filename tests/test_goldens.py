"""Hand-worked results for whole cleaners."""

import pytest

from deskline.operators.chat import clean_chats
from deskline.operators.email import EmailConfig, clean_emails
from deskline.operators.transcript import clean_transcripts

EMAIL = """Sent: Friday
Message-ID: <77@quarry.example>
This is an automated copy of a form

<p>We loaded <b>two hoppers</b> of gravel&nbsp;on Tuesday, GRVX 200881 and
QRY 310447, and only the second one left. [image: siding.jpg]</p>



Order SO-2031-5521, scale ticket 64 tons.  Track it at
www.quarry.example/loads or write to yard@quarry.example, night desk
+1 419-555-0188, waybill 200764413.

>> are both cars empty again?
Kind regards,
Imre, weighbridge
___
If you have received this by mistake, shred it."""

EMAIL_DEFAULT = """We loaded two hoppers of gravel\xa0on Tuesday, GRVX 200881 and
QRY 310447, and only the second one left.\x20

Order SO-2031-5521, scale ticket 64 tons. Track it at
[URL] or write to yard@quarry.example, night desk
+1 419-555-0188, waybill 200764413.

Kind regards,
Imre, weighbridge"""

EMAIL_STRICT = """We loaded two hoppers of gravel\xa0on Tuesday, [EQUIPMENT_ID] and
[EQUIPMENT_ID], and only the second one left.\x20

Order [ORDER_NUM], scale ticket 64 tons. Track it at
[URL] or write to [EMAIL], night desk
[PHONE], waybill [WAYBILL].

Kind regards,
Imre, weighbridge"""

CALL = """Queue: bulk goods
ANI: 4195550188

Operator: bulk desk [hold music]
(7:40) Caller: er, two things -- basically a refund.... ... and a new date
[beep] Caller: the gravel one, mm-hmm
Clerk 2: which month [unclear]
(7:41) Speaker 1: literally the last one
Dispatcher: right right
"""
CALL_CUSTOMER = """, two things - a refund... and a new date
the gravel one,\x20
 the last one"""

CHAT = """Platform: kiosk 9
Queue: 3

Virtual Agent: Pick one: rates, claims
Client: [file sent: scale.pdf] is 64 tons right???
Rep: see https://quarry.example/scale
2031-05-02 07:41 (Client): \U0001f6a7 the siding is shut!! go back
go back
Client: other
[disconnected]
"""
CHAT_CUSTOMER = """is 64 tons right?
the siding is shut! go back"""

# (text, expected, options)
EMAILS = [
    (EMAIL, EMAIL_DEFAULT, EmailConfig()),
    (EMAIL, EMAIL_DEFAULT, EmailConfig.ner_friendly()),
    (EMAIL, EMAIL_STRICT, EmailConfig.strict()),
    (None, "", EmailConfig()),
    ("", "", EmailConfig()),
    ("  \n ", "", EmailConfig()),
    (" \n\x1c", "", EmailConfig(normalize_whitespace=False)),
    ("  kept  ", "  kept  ", EmailConfig(normalize_whitespace=False)),
    ("a&nbsp;&nbsp;b", "a\xa0\xa0b", EmailConfig()),
    ("&amp;amp; x", "x", EmailConfig()),
    ("&copy 2024 &notit; &#x41; &#65", "© 2024 ¬it; A A", EmailConfig()),
    ("&lt;b&gt;x", "x", EmailConfig()),
    ("a &amp;lt; b", "a b", EmailConfig()),
    ("&lt;b&gt; &amp;", "&lt;b&gt; &amp;", EmailConfig(strip_html=False)),
    ("weight < 500 kg > note", "weight note", EmailConfig()),
    ("Thanks,\nBob", "Thanks,\nBob", EmailConfig()),
    ("Hi\nThanks,\nBob", "Hi", EmailConfig()),
    ("Hi\nThanks,\nBob", "Hi\nThanks,\nBob", EmailConfig(strip_signatures=False)),
    ("Hi\n___\nBob", "Hi", EmailConfig()),
    ("Hi\nThanks,\nBob\n--\nx", "Hi\nThanks,\nBob", EmailConfig()),
    ("see the Disclaimer below. more", "see the", EmailConfig()),
    ("see the Disclaimer below. more", "see the Disclaimer below. more", EmailConfig(strip_disclaimers=False)),
    ("12345678 / 23456789 / 234567890 / 2345678901", "[PHONE] / [WAYBILL] / [WAYBILL] / [PHONE]", EmailConfig.strict()),
    ("go to https://x.example/a?b and www.y.example now", "go to [URL] and [URL] now", EmailConfig()),
    ("go to https://x.example/a", "go to https://x.example/a", EmailConfig(strip_urls=False)),
    ("a\nb c", "a b", EmailConfig(max_length=2)),
    ("a\nb", "a\nb", EmailConfig(max_length=2)),
    ("a b c", "a b c", EmailConfig(max_length=0)),
    ("a b c", "a b c", EmailConfig(max_length=None)),
    ("a\r\nb\rc", "a\nb\rc", EmailConfig()),
    ("a\u200bb\ufeffc", "abc", EmailConfig()),
    ("e\u0301", "\xe9", EmailConfig()),
    ("e\u0301\u200b", "e\u0301\u200b", EmailConfig(normalize_unicode=False)),
    ("x [image: a.png] [cid:1] [Inline  Image 2] y", "x y", EmailConfig()),
    ("This is an automated message\nbody", "body", EmailConfig()),
    ("a\n\n\n\nb  c\t\td", "a\n\nb c d", EmailConfig()),
    ("x\n\n> q\ny", "x\n\ny", EmailConfig()),
    ("x\n \n\n> q\ny", "x\n\ny", EmailConfig()),
    ("From\n: a\nb", "b", EmailConfig()),
    ("From: a\nb", "From: a\nb", EmailConfig(strip_email_headers=False)),
    ("On Mon 1 Jan, Bob wrote:\nb", "b", EmailConfig()),
    ("On Mon 1 Jan, Bob wrote:\nb", "On Mon 1 Jan, Bob wrote:\nb", EmailConfig(strip_reply_headers=False)),
    ("--- FWD ---\na\n\nb", "b", EmailConfig()),
    ("--- FWD ---\na\n\nb", "--- FWD ---\na\n\nb", EmailConfig(strip_forwarded_headers=False)),
    ("--- fwd ---\na\n\nb\n" * 5, "b\n\nb\n\nb\n--- fwd ---\na\n\nb\n--- fwd ---\na\n\nb", EmailConfig()),
    ("--- fwd ---\na\n\nb\n" * 5, "b\n\nb\n\nb\n\nb\n\nb", EmailConfig(max_chain_depth=0)),
    ("--- fwd ---\na\n\nb\n" * 6, "b\n\nb\n\nb\n\nb\n\nb\n--- fwd ---\na\n\nb", EmailConfig(max_chain_depth=5)),
    ("Keep ME and drop ticket#12", "keep me and drop", EmailConfig(lowercase=True, extra_removal_patterns=(r"TICKET#\d+",))),
    ("ab", "", EmailConfig(extra_removal_patterns=("b", "^a$"))),
    ("x ticket\xa0\u0663 y", "x y", EmailConfig(extra_removal_patterns=(r"ticket\s\d",))),
    ("a-\rb", "", EmailConfig(extra_removal_patterns=("a-..",))),
]
CALLS = [
    (CALL, CALL_CUSTOMER, True),
    (None, "", True),
    (" \n", "", False),
    ("Agent: by 10:30\n[00:00:12] Customer: ok", "", True),
    ("Customer:\nAgent: hello", "Agent: hello", True),
    ("Customer 1: hi", "hi", True),
    ("Customer: I'd like to ship", "I'd to ship", True),
    ("Customer: a\nlost line\n[caller]: b", "a\nb", True),
    ("Customer: \n", "", True),
    ("Agent: hi\nsome words\nDispatcher: x", "some words", True),
    ("wait.... ok", "wait... ok", True),
    ("wait... ok", "wait... ok", True),
    ("wait... ... .. ok -- then", "wait... ok - then", False),
    ("uh-huh", "-huh", False),
    ("Call timeout is long\nhi", "hi", False),
    ("[00:01] Date: x", "Date: x", False),
    ("a [phone ringing] b [Paused for 3 minutes] c", "a b c", False),
    ("at 9:15 we", "at we", False),
    ("Agent: a\n(Customer): b\nspeaker 3: c\nRep 2: d", "a\nb\nc\nd", False),
]
CHATS = [
    (CHAT, CHAT_CUSTOMER, True),
    (None, "", False),
    ("\n", "", True),
    ("User: yes", "", True),
    ("User: yes please", "yes please", True),
    ("User: why?!.", "why.", True),
    ("Bot: see [reading list] now", "see now", False),
    ("at 12:30 ambient", "at bient", True),
    ("at 12:30 PM - we", "at we", True),
    ("2024-01-02 10:30 hi", "hi", True),
    ("no label\nBot: dropped\nkept", "no label\n\nkept", True),
    ("session ended early because\nhi", "hi", True),
    ("see http://a.example/x...", "see [URL]", True),
    ("wait... what", "wait. what", True),
    ("a ★─ b ️ \U0001fa70", "a b ️ \U0001fa70", True),
    ("Bot: hello\nUser: one\nYou: two", "hello\none\ntwo", False),
]


def check(rows, expected):
    got = {r.i: r.clean_text for r in rows}
    wrong = [(i, got[i], e) for i, e in expected if got[i] != e]
    assert not wrong, wrong


@pytest.mark.parametrize("config", sorted({c for _, _, c in EMAILS}, key=repr), ids=lambda c: "")
def test_emails(spark, config):
    cases = [(i, t, e) for i, (t, e, c) in enumerate(EMAILS) if c == config]
    df = spark.createDataFrame([(i, t) for i, t, _ in cases], "i int, raw_email string")
    out = clean_emails(df, config=config)
    assert out.columns == ["i", "raw_email", "clean_text"]
    check(out.collect(), [(i, e) for i, _, e in cases])


@pytest.mark.parametrize("customer_only", [True, False])
@pytest.mark.parametrize("cases, clean, column", [(CALLS, clean_transcripts, "raw_transcript"), (CHATS, clean_chats, "raw_chat")])
def test_dialogues(spark, cases, clean, column, customer_only):
    cases = [(i, t, e) for i, (t, e, c) in enumerate(cases) if c == customer_only]
    df = spark.createDataFrame([(i, t) for i, t, _ in cases], f"i int, {column} string")
    check(clean(df, customer_only=customer_only).collect(), [(i, e) for i, _, e in cases])


def test_other_types_become_empty_text(spark):
    df = spark.range(3)
    assert [r.clean_text for r in clean_chats(df, "id").collect()] == ["", "", ""]


def test_result_may_replace_its_input_and_leaves_other_columns(spark):
    df = spark.createDataFrame([(1, "User: hi", "x")], "k int, `a.b` string, _bound string")
    out = clean_chats(df, "a.b", "a.b")
    assert out.columns == ["k", "_bound", "a.b"]
    assert out.first().asDict() == {"k": 1, "_bound": "x", "a.b": "hi"}


def test_bad_settings_are_refused():
    with pytest.raises(ValueError):
        EmailConfig(max_chain_depth=-1)
    with pytest.raises(ValueError):
        EmailConfig(max_length=-1)


def test_bad_patterns_are_refused(spark):
    with pytest.raises(ValueError, match="bad pattern"):
        EmailConfig(extra_removal_patterns=("fine", "("))
