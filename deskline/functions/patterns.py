"""Java regular expressions used by the text operators.

Texts are judged by Python's rules (Unicode whitespace, digits and words; only
``\\n`` ends a line), so the patterns spell those rules out instead of relying
on Java's shorthands:

* ``S`` whitespace, ``N`` its complement, ``B`` whitespace other than newline;
* ``D`` decimal digit, ``W`` word character, ``X`` its complement, ``LEFT`` and
  ``RIGHT`` word edges;
* ``[^\\n]*`` for the rest of a line, ``\\z`` for the end of the text.

The patterns are shaped for the cost of long texts, which has to grow with the
length and not with its square, whatever the text holds:

* a quantifier that can never usefully give back what it took is possessive;
* a match starts with a test of its first character, before any lookbehind;
* patterns on whole lines or words walk over the text once, from the end of the
  last match (``\\G``), and take what they skip as group 1, to be put back.
"""

import string

# A character above U+FFFF inside a lookbehind makes Java step back by code point.
_HIGH_LETTER = "\U00010000"
_HIGH_DIGIT = "\U0001d7ce"

S = r"[\s\x1c-\x1f]"
N = r"[^\s\x1c-\x1f]"
B = r"[\s\x1c-\x1f&&[^\n]]"
D = r"\p{Nd}"
W = r"[\p{L}\p{N}_]"
X = r"[^\p{L}\p{N}_]"
LEFT = rf"(?<![\p{{L}}\p{{N}}_{_HIGH_LETTER}])"
RIGHT = rf"(?!{W})"

TEXT = "(?Ud)"
ANYCASE = "(?iUd)"
LINES = "(?mUd)"
ANYCASE_LINES = "(?imUd)"

# Whitespace as stripped from both ends of a text.
WHITESPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004"
    "\u2005\u2006\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"
)


def _at_line(start: str) -> str:
    """``start`` at the beginning of a line, after any blank lines and indentation.
    Group 1 is the lines before. A line's leading whitespace is read once, together
    with the blank lines above it."""
    lines = rf"(?:(?!{S}*+{start}){S}*+[^\n]*+\n)*+"
    return rf"\G((?>(?<![^\n])|[^\n]*+\n){lines}){S}*+{start}"


def _at_word(start: str) -> str:
    """``start`` at the beginning of a word. Group 1 is the words before."""
    return rf"\G({X}*+(?:(?!{start}){W}++{X}*+)*+){start}"


# Letters that fold with others than their two ASCII forms.
_FOLDS = {"i": r"Ii\u0130\u0131", "k": r"Kk\u212a", "s": r"Ss\u017f"}


def _letter(letter: str) -> str:
    """A letter in any case, as one cheap test."""
    letter = letter.lower()
    return f"(?-i:[{_FOLDS.get(letter, letter.upper() + letter)}])"


def _words(*phrases: str) -> str:
    """Alternation of phrases; a space stands for one or more whitespace
    characters, ``~`` for none or more."""
    spelled = (p.replace(" ", f"{S}++").replace("~", f"{S}*+") for p in phrases)
    return "|".join(_letter(p[0]) + p[1:] for p in spelled)


def _one_of(letters: str) -> str:
    """Looks ahead for any of some letters, in any case."""
    return "(?-i:(?=[" + "".join(_FOLDS.get(c, c.upper() + c) for c in letters) + "]))"


# ---------------------------------------------------------------------------
# All channels
# ---------------------------------------------------------------------------

HAS_TEXT = TEXT + N
WORD = TEXT + N + "++"
WORD_GAP = TEXT + S + "++"


def more_words_than(limit: int) -> str:
    return TEXT + rf"\A{S}*+(?:{N}++{S}++){{{limit}}}+{N}"


ZERO_WIDTH = r"[\u200b-\u200d\ufeff]++"
NEWLINES = r"\n{3,}+"
SPACES = r"[ \t]{2,}+"
URL = ANYCASE + rf"{_one_of('hw')}(?:{_letter('h')}ttps?://|{_letter('w')}ww\.){N}++"

# Text that normalization form C may change: anything from U+0300 on but some
# common blocks it leaves alone (checked in the tests). Kept to a few ranges: a
# finer class costs more to test than normalizing the text.
MAYBE_NOT_NFC = (
    r"(?=[\u0300-\x{10ffff}])[^\u0400-\u0482\u2010-\u2027\u2030-\u205e\u20a0-\u20bf\u2190-\u21ff\u2500-\u2adb\u4e00-\u9fff\x{1f300}-\x{1faff}]"
)

# ---------------------------------------------------------------------------
# Email. The word lists, masks and their order are fixed values.
# ---------------------------------------------------------------------------

# Anchored to the end of the previous tag, so an unclosed "<" is tried once.
HTML_TAG = r"\G([^<]*+(?:<>[^<]*+)*+)<[^>]++>"
HTML_ENTITY = TEXT + rf"&#?{W}++;"

_PLACEHOLDER = rf"\[(?:{_words('image', 'cid', 'attachment', 'inline image')})[^\]]*+"
PLACEHOLDER = ANYCASE + rf"{_PLACEHOLDER}\]|({_PLACEHOLDER}\z)"

AUTO_REPLY = ANYCASE_LINES + (
    "^(?:"
    + _words(
        "This is an? automated?",
        "Do not reply to this",
        f"You{S}++(?:have{S}++)?+(?:received|are receiving) this",
    )
    + r")[^\n]*+"
)

_FORWARD_HEAD = (
    rf"-{{3,}}+{S}*+(?:Forwarded(?:{S}++message)?+|"
    + _words("Original Message", "Begin forwarded", "FWD")
    + rf"){S}*+-{{3,}}+"
)
# The first forwarded block; group 1 is the text before it.
FIRST_FORWARD = (
    "(?isUd)"
    + rf"\A([^-]*+(?:(?!{_FORWARD_HEAD})-++[^-]*+)*+){_FORWARD_HEAD}.*?(?=\n\n|---|\z)"
)

# Forwarded blocks one after the other, up to one before which an open stretch stands: a
# dash, and then only letters and white space. A head that begins further back would have
# to reach over a stretch that holds something else.
_STRETCH = rf"(?!{_FORWARD_HEAD})-++[\s\x1c-\x1f\p{{L}}]*+"
_CLOSED = rf"{_STRETCH}[^\-\s\x1c-\x1f\p{{L}}][^-]*+"
FORWARDS_APART = (
    "(?isUd)" + rf"\G([^-]*+(?:(?:{_STRETCH}(?=-))*+{_CLOSED})*+){_FORWARD_HEAD}.*?(?=\n\n|---|\z)"
)

REPLY_HEADER = ANYCASE_LINES + rf"^On{S}[^\n]{{5,100}}(?:wrote|said){S}*+:[^\n]*+"
HEADER_LINE = ANYCASE_LINES + (
    rf"^(?:From|To|Cc|Bcc|Subject|Date|Sent|Reply-To|Message-ID){S}*+:[^\n]*+"
)
QUOTED_LINE = TEXT + _at_line(">") + r"[^\n]*+"

FROM_DISCLAIMER = ANYCASE + (
    _one_of("cdlti")
    + "(?:"
    + _words(
        "CONFIDENTIALITY NOTICE",
        "DISCLAIMER",
        "LEGAL NOTICE",
        f"This (?:e-?mail|message){S}++(?:and any attachments?{S}++)?+(?:is|are|may be) "
        "(?:confidential|privileged|intended)",
        "If you (?:have received|are not the intended)",
        "The information (?:contained|transmitted) in this",
    )
    + r")[\s\S]*+"
)

# No disclaimer phrase goes without one of these.
DISCLAIMER_WORDS = (
    "confidential",
    "disclaimer",
    "legal",
    "privileged",
    "intended",
    "received",
    "information",
)

FROM_SIGNATURE_MARK = LINES + rf"^(?:--{B}*+|_{{3,}}+)(?:\n|\z)[\s\S]*+"
FROM_CLOSING = ANYCASE + (
    r"\n(?:"
    + _words(
        "Best (?:regards|wishes)",
        "Kind regards",
        "Regards",
        "Sincerely",
        f"Thanks(?:{S}++and{S}++regards)?+",
        "Thank you",
        "Cheers",
        "Warm regards",
        "Respectfully",
        "With appreciation",
    )
    + rf")[,.]?+{B}*+\n[\s\S]*+"
)

# Spelled out, since a class of ranges is a chain of tests in Java.
_LOCAL_CHARS = string.ascii_letters + string.digits + r"._%+\-"
_LOCAL = f"[{_LOCAL_CHARS}]"
_EDGE = rf"(?:(?<=[\p{{L}}\p{{N}}_{_HIGH_LETTER}])(?!{W})|{LEFT}(?={W}))"
_DOMAIN = rf"[A-Za-z0-9.\-]+\.[A-Za-z]{{2,}}{RIGHT}"
# An address starts at the first word edge of its run of address characters; no
# later edge of that run can do better, so a run is tried once.
_TO_ADDRESS = rf"(?>{_LOCAL}*?{_EDGE})"
_ADDRESS = rf"{_LOCAL}++@{_DOMAIN}"
EMAIL_ADDRESS = TEXT + (
    rf"\G([^{_LOCAL_CHARS}]*+(?:(?!(?={_LOCAL}++@){_TO_ADDRESS}{_ADDRESS}){_LOCAL}++[^{_LOCAL_CHARS}]*+)*+"
    rf"(?={_LOCAL}++@){_TO_ADDRESS})({_ADDRESS})"
)
# Every phone number and freight id holds a run of this many digits.
FOUR_DIGITS = TEXT + rf"{D}{{4}}"
_PHONE = (
    rf"(?=[+({D}])(?<![{D}{_HIGH_DIGIT}])(?:\+?1[\s\x1c-\x1f.\-]?)?(?:\(?{D}{{3}}\)?[\s\x1c-\x1f.\-]?)?"
    rf"{D}{{3}}[\s\x1c-\x1f.\-]?{D}{{4}}(?!{D})"
)
_EQUIPMENT = rf"(?=[A-Z]){LEFT}[A-Z]{{2,4}}{S}?{D}{{6}}{RIGHT}"
_ORDER = rf"{_one_of('spwb')}{LEFT}(?:SO|PO|WB|BO)-{D}{{4}}-{D}{{4,6}}{RIGHT}"
_WAYBILL = rf"(?={D}){LEFT}{D}{{7,10}}{RIGHT}"
PHONE, EQUIPMENT_ID, ORDER_NUMBER, WAYBILL = TEXT + _PHONE, TEXT + _EQUIPMENT, ANYCASE + _ORDER, TEXT + _WAYBILL

EMAIL_MASK = "[EMAIL]"
PHONE_MASK = "[PHONE]"
EQUIPMENT_MASK = "[EQUIPMENT_ID]"
ORDER_MASK = "[ORDER_NUM]"
WAYBILL_MASK = "[WAYBILL]"
URL_MASK = "[URL]"

# A weight as written in a message; ours.
_WEIGHT = rf"(?={D}){LEFT}{D}[{D},]*+(?:\.{D}++)?+{S}?(?:lbs?|pounds?|kgs?|kilograms?|tons?|tonnes?){RIGHT}"
WEIGHT = ANYCASE + _WEIGHT

# Any entity: the leftmost, and of those that begin at one place the first kind named here.
# Group 1 is what goes before an address in its run, the others are the kinds.
ENTITY_KINDS = ("email", "equipment_id", "order_number", "weight", "phone", "waybill")
ENTITY = TEXT + (
    rf"(?<![{_LOCAL_CHARS}])(?={_LOCAL}++@)({_TO_ADDRESS})({_ADDRESS})"
    rf"|({_EQUIPMENT})|((?i:{_ORDER}))|((?i:{_WEIGHT}))|({_PHONE})|({_WAYBILL})"
)

# ---------------------------------------------------------------------------
# Call transcripts. Labels, notes and fillers are fixed values.
# ---------------------------------------------------------------------------

CALL_METADATA = ANYCASE_LINES + (
    "^(?:"
    + _words(
        "call~(?:id|date|time|duration|recording|transcript)",
        "date~:",
        "time~:",
        "duration~:",
        "agent~id~:",
        "queue~:",
        "session~id~:",
        "dnis~:",
        "ani~:",
    )
    + r")[^\n]*+"
)
CALL_TIME = TEXT + rf"(?=[\[({D}])\[?\(?{D}{{1,2}}:{D}{{2}}(?::{D}{{2}})?+\)?+\]?+{S}*+[-\u2014]?+{S}*+"

_CALL_NOTE = (
    r"\[(?:"
    + _words(
        "crosstalk",
        "inaudible",
        "overtalk",
        "pause",
        "silence",
        "laughter",
        "background~noise",
        "music",
        "hold~music",
        "beep",
        "noise",
        "ph",
        "sic",
        "unintelligible",
        "unclear",
    )
    + r")[^\]]*+"
)
CALL_NOTE = ANYCASE + rf"{_CALL_NOTE}\]|({_CALL_NOTE}\z)"

_AGENT_SIDE = _words(
    "agent", "rep(?:resentative)?+", "csx~(?:agent|rep)?+", "operator", "dispatcher", "clerk", "staff"
)
_CUSTOMER_SIDE = _words("customer", "caller", "client", "user")

CALL_LABEL = ANYCASE + _at_line(
    rf"[\[(]?+(?:{_AGENT_SIDE}|{_CUSTOMER_SIDE}|speaker{S}*+{D}*+){S}*+{D}*+[\])]?+{S}*+:{S}*+"
)
CALL_AGENT_LINE = ANYCASE + (
    _at_line(rf"[\[(]?+(?:{_AGENT_SIDE}|speaker{S}*+[02-9]{D}*+)[\])]?+{S}*+:{S}*+") + r"[^\n]*+"
)
# Group 2 is what the customer said.
CALL_CUSTOMER_LINE = ANYCASE + (
    _at_line(rf"[\[(]?+(?:{_CUSTOMER_SIDE}|speaker{S}*+1)[\])]?+{S}*+:{S}*+") + r"([^\n]*+)"
)

FILLER = ANYCASE + _at_word(
    _one_of("uhmaelyibsor")
    + "(?:"
    + _words(
        "uh+",
        "um+",
        "hmm+",
        "mhm",
        "uh-huh",
        "mm-?hmm",
        "ah+",
        "er+",
        "like",
        "you know",
        "i mean",
        "basically",
        "literally",
        "actually",
        "so yeah",
        "right right",
        "okay so",
    )
    + ")"
    + RIGHT
)
# Two or more runs of two or more dots, without a group loop that could recurse.
ELLIPSES = TEXT + (
    rf"(?:\.{{4,}}+{S}*+|\.{{2,3}}+{S}++\.{{2,}}+{S}*+)(?:\.{{2,}}+{S}*+)*+"
)
DASHES = r"-{2,}+"

# ---------------------------------------------------------------------------
# Chat logs. Labels, events, emoji ranges and button texts are fixed values.
# ---------------------------------------------------------------------------

CHAT_METADATA = ANYCASE_LINES + (
    "^(?:"
    + _words(
        "session~(?:id|start|end|duration)",
        "channel~:",
        "chat~(?:id|start|end)",
        "user~id~:",
        "bot~id~:",
        "platform~:",
        "source~:",
        "conversation~id~:",
        "timestamp~:",
        "queue~:",
        "agent~transfer~:",
    )
    + r")[^\n]*+"
)
_CLOCK_END = rf"\)?+\]?+{S}*+[-\u2014]?+{S}*+"
CHAT_TIME = ANYCASE + (
    rf"(?=[\[({D}])(?:\[?\(?{D}{{4}}-{D}{{2}}-{D}{{2}}{S}*+{D}{{2}}:{D}{{2}}(?::{D}{{2}})?+{_CLOCK_END}"
    rf"|\[?\(?{D}{{1,2}}:{D}{{2}}(?::{D}{{2}})?+{S}*+(?:AM|PM)?+{_CLOCK_END})"
)

_CHAT_EVENT = (
    r"\[(?:"
    + _words(
        "typing",
        "read",
        "delivered",
        "seen",
        "connected",
        "disconnected",
        "transferred",
        "escalated",
        "session~(?:started|ended)",
        "file~(?:sent|received)",
        "image~(?:sent|received)",
    )
    + r")[^\]]*+"
)
CHAT_EVENT = ANYCASE + rf"{_CHAT_EVENT}\]|({_CHAT_EVENT}\z)"
EMOJI = (
    r"(?=[\u2500-\x{10ffff}])[\u2500-\u2bef\x{1f600}-\x{1f64f}\x{1f300}-\x{1f5ff}\x{1f680}-\x{1f6ff}"
    r"\x{1f1e0}-\x{1f1ff}\x{1f900}-\x{1f9ff}]++"
)

_BOT_SIDE = _words(
    "bot",
    "csx~bot",
    "system",
    "assistant",
    "virtual~agent",
    "automated~response",
    "chatbot",
    "agent",
    "rep(?:resentative)?+",
)
_USER_SIDE = _words("user", "customer", "you", "client", "caller")

CHAT_LABEL = ANYCASE + _at_line(rf"[\[(]?+(?:{_BOT_SIDE}|{_USER_SIDE})[\])]?+{S}*+:{S}*+")
CHAT_BOT_LINE = ANYCASE + _at_line(rf"[\[(]?+(?:{_BOT_SIDE})[\])]?+{S}*+:{S}*+") + r"[^\n]*+"
# Group 2 is what the customer wrote.
CHAT_CUSTOMER_LINE = ANYCASE + _at_line(rf"[\[(]?+(?:{_USER_SIDE})[\])]?+{S}*+:{S}*+") + r"([^\n]*+)"

QUICK_REPLY = ANYCASE_LINES + (
    "^(?:"
    + _words(
        f"track{S}++(?:my{S}++)?+shipment",
        f"get{S}++(?:a{S}++)?+rate quote",
        f"report{S}++(?:an?{S}++)?+(?:issue|damage|loss)",
        f"schedule{S}++(?:a{S}++)?+pickup",
        f"cancel{S}++(?:my{S}++)?+shipment",
        f"speak{S}++(?:to{S}++)?+(?:an?{S}++)?+agent",
        "main menu",
        "go back",
        "yes",
        "no",
        "help",
        "start over",
        "other",
    )
    + r")(?=\n|\z)"
)
PUNCTUATION_RUN = "[!?.]+([!?.])"
