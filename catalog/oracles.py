"""The same results in DuckDB's SQL, written on their own: RE2 patterns, which have
no lookaround, so word and digit edges are marked by private-use characters first."""

from __future__ import annotations

from catalog import inputs
from deskline.operators.labels import INTENTS

# Whitespace beyond what RE2 calls \s.
WS = r"[\s\x0b\x1c-\x1f\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"
NWS = WS.replace("[", "[^", 1)
EDGE_L, EDGE_R, PLUS, PAREN = r"\x{e000}", r"\x{e001}", r"\x{e002}", r"\x{e003}"


def lit(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def sub(pattern: str, replacement: str = "", options: str = "g") -> str:
    """A step: replace in the text ``t``."""
    opts = f", {lit(options)}" if options else ""
    return f"regexp_replace(t, {lit(pattern)}, {lit(replacement)}{opts})"


def strip(expr: str) -> str:
    return f"regexp_replace({expr}, {lit(f'^{WS}+|{WS}+$')}, '', 'g')"


def chain(select: str, keys: str, steps: list[str]) -> str:
    """``select`` yields the keys and a text ``t``; each step is an expression on it. No
    text, or a blank one, gives an empty one."""
    blank = f"t IS NULL OR {strip('t')} = ''"
    ctes, last = [f"s0 AS (SELECT {keys}, CASE WHEN {blank} THEN '' ELSE t END AS t FROM ({select}))"], 0
    for i, step in enumerate(steps, 1):
        ctes.append(f"s{i} AS MATERIALIZED (SELECT {keys}, {step} AS t FROM s{i - 1})")
        last = i
    return f"WITH {', '.join(ctes)} SELECT {keys}, t AS clean_text FROM s{last}"


MARK_WORDS = sub(r"([\p{L}\p{N}_]+)", "\ue000\\1\ue001")
UNMARK = sub(f"[{EDGE_L}{EDGE_R}]")
NORMALIZE = [
    "replace(t, chr(13) || chr(10), chr(10))",
    sub(r"[\x{200b}\x{200c}\x{200d}\x{feff}]"),
    "nfc_normalize(t)",
]
WHITESPACE = [sub(r"\n{3,}", "\n\n"), sub(r"[ \t]{2,}", " "), strip("t")]


def dialogue(customer: str, agent_lines: str, label: str) -> str:
    """The customer's lines, or what is left without agent lines and labels."""
    lines = f"regexp_extract_all(t, {lit(customer)}, 1)"
    joined = f"array_to_string([{strip('x')} for x in {lines} if {strip('x')} <> ''], chr(10))"
    rest = f"regexp_replace(regexp_replace(t, {lit(agent_lines)}, '', 'g'), {lit(label)}, '', 'g')"
    return f"CASE WHEN len({lines}) > 0 THEN {joined} ELSE {rest} END"


# Fixed values, here and below: the words and marks of the patterns.

# -- chat -------------------------------------------------------------------

_BOT = r"bot|csx\s*bot|system|assistant|virtual\s*agent|automated\s*response|chatbot|agent|rep(?:resentative)?"
_USER = r"user|customer|you|client|caller"
_OPEN, _CLOSE = r"(?im)^\s*(?:\[|\()?", r"(?:\]|\))?\s*:\s*"
CHAT_LABEL = f"{_OPEN}(?:{_BOT}|{_USER}){_CLOSE}"


def chat_steps(customer_only: bool) -> list[str]:
    side = (
        dialogue(f"{_OPEN}(?:{_USER}){_CLOSE}(.*?)$", f"{_OPEN}(?:{_BOT}){_CLOSE}.*$", CHAT_LABEL)
        if customer_only
        else sub(CHAT_LABEL)
    )
    return [
        *NORMALIZE,
        sub(
            r"(?im)^(?:session\s*(?:id|start|end|duration)|channel\s*:|chat\s*(?:id|start|end)|user\s*id\s*:|bot\s*id\s*:|"
            r"platform\s*:|source\s*:|conversation\s*id\s*:|timestamp\s*:|queue\s*:|agent\s*transfer\s*:).*$"
        ),
        sub(
            r"(?i)\[?\(?\d{4}-\d{2}-\d{2}\s*\d{2}:\d{2}(?::\d{2})?\)?\]?\s*[-—]?\s*|"
            r"\[?\(?\d{1,2}:\d{2}(?::\d{2})?\s*(?:AM|PM)?\)?\]?\s*[-—]?\s*"
        ),
        sub(
            r"(?i)\[(?:typing|read|delivered|seen|connected|disconnected|transferred|escalated|session\s*(?:started|ended)|"
            r"file\s*(?:sent|received)|image\s*(?:sent|received))[^\]]*\]"
        ),
        sub(r"[\x{1F300}-\x{1F64F}\x{1F680}-\x{1F6FF}\x{1F1E0}-\x{1F1FF}\x{1F900}-\x{1F9FF}\x{2500}-\x{2BEF}]+"),
        side,
        sub(
            r"(?im)^(?:track\s+(?:my\s+)?shipment|get\s+(?:a\s+)?rate\s+quote|report\s+(?:an?\s+)?(?:issue|damage|loss)|"
            r"schedule\s+(?:a\s+)?pickup|cancel\s+(?:my\s+)?shipment|speak\s+(?:to\s+)?(?:an?\s+)?agent|main\s+menu|go\s+back|"
            r"yes|no|help|start\s+over|other)$"
        ),
        sub(r"(?i)https?://\S+|www\.\S+", "[URL]"),
        sub(r"[!?.]+([!?.])", r"\1"),
        *WHITESPACE,
    ]


# -- transcripts ------------------------------------------------------------

_AGENT = r"agent|rep(?:resentative)?|csx\s*(?:agent|rep)?|operator|dispatcher|clerk|staff"
_CUSTOMER = r"customer|caller|client|user"
CALL_LABEL = rf"{_OPEN}(?:{_AGENT}|{_CUSTOMER}|speaker\s*\d*)\s*\d*{_CLOSE}"
L, R = EDGE_L, EDGE_R
FILLERS = (
    rf"(?i){L}(?:uh+|um+|hmm+|mhm|uh{R}-{L}huh|mm{R}-{L}hmm|mmhmm|ah+|er+|like|you{R}\s+{L}know|i{R}\s+{L}mean|basically|"
    rf"literally|actually|so{R}\s+{L}yeah|right{R}\s+{L}right|okay{R}\s+{L}so){R}"
)


def transcript_steps(customer_only: bool) -> list[str]:
    side = (
        dialogue(
            rf"{_OPEN}(?:{_CUSTOMER}|speaker\s*1){_CLOSE}(.*?)$",
            rf"{_OPEN}(?:{_AGENT}|speaker\s*[02-9]\d*){_CLOSE}.*$",
            CALL_LABEL,
        )
        if customer_only
        else sub(CALL_LABEL)
    )
    return [
        *NORMALIZE,
        sub(
            r"(?im)^(?:call\s*(?:id|date|time|duration|recording|transcript)|date\s*:|time\s*:|duration\s*:|agent\s*id\s*:|"
            r"queue\s*:|session\s*id\s*:|dnis\s*:|ani\s*:).*$"
        ),
        sub(r"\[?\(?\d{1,2}:\d{2}(?::\d{2})?\)?\]?\s*[-—]?\s*"),
        sub(
            r"(?i)\[(?:crosstalk|inaudible|overtalk|pause|silence|laughter|background\s*noise|music|hold\s*music|beep|noise|ph|"
            r"sic|unintelligible|unclear)[^\]]*\]"
        ),
        side,
        MARK_WORDS,
        sub(FILLERS),
        UNMARK,
        sub(r"(?:\.{2,}\s*){2,}", "... "),
        sub(r"-{2,}", "-"),
        *WHITESPACE,
    ]


# -- email ------------------------------------------------------------------

_FORWARD = r"-{3,}\s*(?:forwarded(?:\s+message)?|original\s+message|begin\s+forwarded|fwd)\s*-{3,}"
FORWARD = sub(rf"(?is){_FORWARD}.*?(\n\n|---|$)", r"\1", options="")
_DISCLAIMER = (
    r"(?:confidentiality\s+notice|disclaimer|legal\s+notice|this\s+(?:e-?mail|message)\s+(?:and\s+any\s+attachments?\s+)?"
    r"(?:is|are|may\s+be)\s+(?:confidential|privileged|intended)|if\s+you\s+(?:have\s+received|are\s+not\s+the\s+intended)|"
    r"the\s+information\s+(?:contained|transmitted)\s+in\s+this)"
)
_MARK = r"^(?:--[ \t\r]*|_{3,})(?:\n|\z)"
_CLOSING = (
    r"\n(?:best\s+(?:regards|wishes)|kind\s+regards|regards|sincerely|thanks(?:\s+and\s+regards)?|thank\s+you|cheers|"
    r"warm\s+regards|respectfully|with\s+appreciation)[,.]?\s*\n"
)

def cut(pattern: str) -> str:
    """The text before the first match, without its trailing whitespace; the text
    itself where there is no match."""
    head = f"split_part(regexp_replace(t, {lit(pattern)}, chr(57344)), chr(57344), 1)"
    return f"CASE WHEN regexp_matches(t, {lit(pattern)}) THEN regexp_replace({head}, {lit(f'{WS}+$')}, '') ELSE t END"


SIGNATURE = (
    f"CASE WHEN regexp_matches(t, {lit('(?m)' + _MARK)}) THEN {cut('(?m)' + _MARK)} ELSE {cut('(?i)' + _CLOSING)} END"
)
DISCLAIMER = cut(f"(?i){_DISCLAIMER}")

# Phone numbers: digit runs are marked, and a "+" or "(" right after a digit is
# hidden, since a match must not start there.
_SEP = r"[\s.\-]"
_GAP = f"(?:{R}{_SEP}{L})?"
_AREA = rf"\d{{3}}(?:{R}(?:\){_SEP}?|{_SEP}){L})?"
_TAIL = rf"\d{{3}}{_GAP}\d{{4}}{R}"
_COUNTRY = rf"\+?{L}1"
_PHONE = (
    rf"{_COUNTRY}(?:{R}(?:{_SEP}\(?|{PAREN}){L})?{_AREA}{_TAIL}|{_COUNTRY}{_GAP}{_TAIL}|"
    rf"\(?{L}{_AREA}{_TAIL}|{L}{_TAIL}"
)
PHONE = [
    sub(r"(\d+)", "\ue000\\1\ue001"),
    sub(rf"{R}\+", "\ue001\ue002"),
    sub(rf"{R}\(", "\ue001\ue003"),
    sub(_PHONE, "[PHONE]"),
    sub(PLUS, "+"),
    sub(PAREN, "("),
    UNMARK,
]
_LOCAL = rf"[A-Za-z0-9._%+\-{L}{R}]"
ADDRESS = rf"[{L}{R}]+[A-Za-z0-9._%+\-]{_LOCAL}*@[A-Za-z0-9.\-{L}{R}]+\.{L}[A-Za-z]{{2,}}{R}"
EQUIPMENT = rf"{L}[A-Z]{{2,4}}(?:{R}\s{L})?\d{{6}}{R}"
ORDER = rf"(?i){L}(?:so|po|wb|bo){R}-{L}\d{{4}}{R}-{L}\d{{4,6}}{R}"
WAYBILL = rf"{L}\d{{7,10}}{R}"


def email_steps(
    depth: int = 3,
    html: bool = True,
    chain_steps: bool = True,
    cuts: bool = True,
    signatures: bool = True,
    urls: bool = True,
    mask: bool = False,
    characters: bool = True,
    extra: tuple[str, ...] = (),
    whitespace: bool = True,
    lowercase: bool = False,
    words: int | None = 512,
) -> list[str]:
    steps = []
    if html:
        # The entities that occur in the built texts and in the pages.
        steps += [
            "replace(replace(replace(replace(replace(t, '&quot;', '\"'), '&copy;', '©'), '&middot;', '·'), '&lt;', '<'), '&amp;', '&')",
            sub("<[^>]+>", " "),
            sub(r"&#?[\p{L}\p{N}_]+;", " "),
        ]
    steps += NORMALIZE if characters else NORMALIZE[:1]
    steps += [
        sub(r"(?i)\[(?:image|cid|attachment|inline\s+image)\s*[^\]]*\]"),
        sub(
            r"(?im)^(?:this\s+is\s+an?\s+automated?|do\s+not\s+reply\s+to\s+this|"
            r"you\s+(?:have\s+)?(?:received|are\s+receiving)\s+this).*$"
        ),
    ]
    if chain_steps:
        steps += [FORWARD] * depth
        steps += [
            sub(r"(?im)^on\s.{5,100}(?:wrote|said)\s*:.*$"),
            sub(r"(?im)^(?:from|to|cc|bcc|subject|date|sent|reply-to|message-id)\s*:.*$"),
        ]
    steps.append(sub(r"(?m)^\s*>+.*$"))
    if cuts:
        steps.append(DISCLAIMER)
        if signatures:
            steps.append(SIGNATURE)
    if urls:
        steps.append(sub(r"(?i)https?://\S+|www\.\S+", "[URL]"))
    if mask:
        steps += [MARK_WORDS, sub(ADDRESS, "[EMAIL]"), UNMARK, *PHONE, MARK_WORDS]
        steps += [sub(EQUIPMENT, "[EQUIPMENT_ID]"), sub(ORDER, "[ORDER_NUM]"), sub(WAYBILL, "[WAYBILL]"), UNMARK]
    steps += [sub(f"(?i){e}") for e in extra]
    if whitespace:
        steps += WHITESPACE
    if lowercase:
        steps.append("lower(t)")
    if words:
        found = f"regexp_extract_all(t, {lit(NWS + '+')})"
        steps.append(f"CASE WHEN len({found}) > {words} THEN array_to_string({found}[1:{words}], ' ') ELSE t END")
    return steps


RAW_EMAILS = f"SELECT o_orderkey AS msg_id, {inputs.EMAIL} AS t FROM orders"
RAW_CHATS = f"SELECT conv_id, turn, {inputs.CHAT} AS t FROM conversations"
RAW_CALLS = f"SELECT conv_id, turn, {inputs.TRANSCRIPT} AS t FROM conversations"


def emails(**options) -> str:
    return chain(RAW_EMAILS, "msg_id", email_steps(**options))


def chats(customer_only: bool = True) -> str:
    return chain(RAW_CHATS, "conv_id, turn", chat_steps(customer_only))


def calls(customer_only: bool = True) -> str:
    return chain(RAW_CALLS, "conv_id, turn", transcript_steps(customer_only))


def label_case(mapping: dict[str, str], column: str) -> str:
    return f"CASE {column} " + " ".join(f"WHEN {lit(k)} THEN {lit(v)}" for k, v in mapping.items()) + " END"


EVENT_CASE = label_case(inputs.EVENT_LABELS, "event_type")
LANG_CASE = label_case(inputs.LANG_LABELS, "lang")
TAXONOMY = "(VALUES " + ", ".join(f"({lit(i)})" for i in INTENTS) + ") AS taxonomy(intent)"
MAPPING = "(VALUES " + ", ".join(f"({lit(k)}, {lit(v)})" for k, v in inputs.EVENT_LABELS.items()) + ") AS mapping(from_label, to_label)"
COVERAGE = f"""
SELECT taxonomy.intent, count(e.intent) AS rows
FROM {TAXONOMY} LEFT JOIN (SELECT {EVENT_CASE} AS intent FROM events) e ON e.intent = taxonomy.intent
GROUP BY taxonomy.intent
"""

SIDES = f"""
SELECT 0 AS side, text, CASE lang WHEN 'en' THEN 'track_shipment' WHEN 'de' THEN 'get_eta' WHEN 'fr' THEN 'file_claim' END AS intent,
       source, doc_id AS row_id FROM documents
UNION ALL SELECT 1, ' ' || CASE WHEN turn % 5 <> 4 THEN text ELSE chr(9) END || chr(10), 'general_inquiry', 'synthetic', conv_id * 1000 + turn FROM conversations
UNION ALL SELECT 1, chr(10) || text, 'report_damage', 'synthetic', -doc_id FROM documents
"""
USABLE = f"""
sides AS ({SIDES}),
usable AS (SELECT side, {strip('text')} AS text, intent, source, row_id FROM sides
           WHERE text IS NOT NULL AND intent IS NOT NULL AND {strip('text')} <> ''),
merged AS (SELECT text, intent, source FROM usable
           QUALIFY row_number() OVER (PARTITION BY text ORDER BY side, row_id, intent, source) = 1)
"""


RELABELLED = f"""
SELECT text, {LANG_CASE} AS intent, 'documents' AS source FROM documents WHERE {LANG_CASE} IS NOT NULL
UNION ALL SELECT text, 'general_inquiry', 'conversations' FROM conversations WHERE turn = 0
"""


def steps_table(counts: list[tuple[str, str]]) -> str:
    return " UNION ALL ".join(
        f"SELECT {i} AS position, {lit(name)} AS step, ({count}) AS rows" for i, (name, count) in enumerate(counts)
    )


SAMPLES = """
SELECT doc_id, text, lang, source AS intent, row_number() OVER (PARTITION BY source ORDER BY doc_id) AS position
FROM documents QUALIFY position <= 3
"""


CLEAN_EMAILS = emails()
WORDS = f"len(regexp_extract_all(text, {lit(NWS + '+')}))"


def found(pattern: str, column: str = "w", group: int = 0) -> str:
    return f"array_to_string([regexp_replace(x, {lit(f'[{L}{R}]')}, '', 'g') for x in regexp_extract_all({column}, {lit(pattern)}, {group})], '|')"


def marked(column: str) -> str:
    return f"regexp_replace({column}, '([\\p{{L}}\\p{{N}}_]+)', '\ue000\\1\ue001', 'g')"


def marked_digits(column: str) -> str:
    return (
        f"regexp_replace(regexp_replace(regexp_replace({column}, '(\\d+)', '\ue000\\1\ue001', 'g'), "
        "'\ue001\\+', '\ue001\ue002', 'g'), '\ue001\\(', '\ue001\ue003', 'g')"
    )


_PHONES = (
    f"array_to_string([replace(replace(regexp_replace(x, {lit(f'[{L}{R}]')}, '', 'g'), '\ue002', '+'), '\ue003', '(') "
    f"for x in regexp_extract_all(p, {lit(_PHONE)})], '|')"
)
_WEIGHT = rf"(?i){L}\d[\d,{L}{R}]*(?:\.{L}\d+)?(?:{R}\s{L})?(?:lbs?|pounds?|kgs?|kilograms?|tons?|tonnes?){R}"

ENTITIES = (
    f"{found(ADDRESS)} AS emails, {_PHONES} AS phones, {found(WAYBILL)} AS waybills, {found(EQUIPMENT)} AS equipment_ids, "
    f"{found(ORDER)} AS order_numbers, {found(_WEIGHT)} AS weights"
)
SCORED = """
scored AS (SELECT event_id, CASE WHEN event_type = 'view' THEN -1.0 WHEN event_type <> 'error' THEN value / 20 END AS confidence
           FROM events)
"""
ROUTED = f"""
WITH {SCORED} SELECT event_id, confidence, CASE WHEN confidence >= 0.85 THEN 'accepted' ELSE 'fallback' END AS route FROM scored
"""
MIXED = (
    f"SELECT 'email' AS channel, 'email ' || msg_id AS text_id, clean_text FROM ({CLEAN_EMAILS}) "
    f"UNION ALL SELECT 'transcript', 'transcript ' || conv_id || '-' || turn, clean_text FROM ({calls()}) "
    f"UNION ALL SELECT 'chat', 'chat ' || conv_id || '-' || turn, clean_text FROM ({chats()})"
)


def split_words(column: str) -> str:
    return f"[w for w in regexp_split_to_array(lower({column}), '[^\\p{{L}}\\p{{N}}_]+') if w <> '']"


def naive_bayes(texts: str) -> str:
    """CTEs that end in ``judged``: ``id, predicted_intent, log_score, confidence`` for
    the rows ``id, text`` of ``texts``, by counts of the merged training table."""
    return f"""
{USABLE},
lessons AS (SELECT intent, {split_words('text')} AS words FROM merged),
sizes AS (SELECT intent, count(*) AS n, sum(len(words)) AS size FROM lessons GROUP BY intent),
counts AS (SELECT word, intent, count(*) AS n FROM (SELECT intent, unnest(words) AS word FROM lessons) GROUP BY ALL),
constants AS (SELECT (SELECT sum(n) FROM sizes) AS total, (SELECT count(DISTINCT word) FROM counts) AS vocabulary),
texts AS ({texts}),
times AS (SELECT id, word, count(*) AS times FROM (SELECT id, unnest({split_words('text')}) AS word FROM texts) GROUP BY ALL),
seen AS (SELECT * FROM times WHERE word IN (SELECT word FROM counts)),
lengths AS (SELECT id, sum(times) AS length FROM seen GROUP BY id),
gains AS (SELECT id, intent, sum(times * ln(1 + n)) AS gain FROM seen JOIN counts USING (word) GROUP BY ALL),
scores AS (
    SELECT id, intent, round(coalesce(gain, 0) + ln(n / total) - coalesce(length, 0) * ln(size + vocabulary), 4) AS score
    FROM (SELECT id FROM texts WHERE text IS NOT NULL) CROSS JOIN sizes CROSS JOIN constants
    LEFT JOIN lengths USING (id) LEFT JOIN gains USING (id, intent)
),
judged AS (
    SELECT id, intent AS predicted_intent, score AS log_score, 1 / sum(exp(score - top)) OVER (PARTITION BY id) AS confidence
    FROM (SELECT *, max(score) OVER (PARTITION BY id) AS top FROM scores)
    QUALIFY row_number() OVER (PARTITION BY id ORDER BY score DESC, intent) = 1
)"""


def json_list(column: str) -> str:
    return f"CASE WHEN {column} = '' THEN CAST([] AS VARCHAR[]) ELSE string_split({column}, '|') END"


SQL = {
    "chat_customer_text": chats(),
    "chat_all_turns": chats(False),
    "transcript_customer_text": calls(),
    "transcript_all_turns": calls(False),
    "email_default": CLEAN_EMAILS,
    "email_ner_friendly": CLEAN_EMAILS,
    "email_strict": emails(mask=True, words=256),
    "email_forward_depth": emails(depth=1),
    "email_forward_unlimited": emails(depth=inputs.MOST_FORWARDS + 1),
    "email_custom": emails(
        html=False, urls=False, signatures=False, lowercase=True, words=40, extra=("waybill [0-9]+", "urgent")
    ),
    "email_verbatim": emails(
        chain_steps=False, cuts=False, html=False, urls=False, whitespace=False, characters=False, words=None
    ),
    "email_html_pages": chain("SELECT page_id, html AS t FROM pages", "page_id", email_steps()),
    "email_documents_strict": chain(
        "SELECT doc_id, text AS t FROM documents", "doc_id", email_steps(mask=True, words=256)
    ),
    "mixed_channels": MIXED,
    "relabel_events": f"""
        SELECT event_id, props AS text, {EVENT_CASE} AS intent, 'events' AS source FROM events
        WHERE {EVENT_CASE} IS NOT NULL""",
    "rename_event_labels": f"SELECT event_id, props AS text, {EVENT_CASE} AS intent FROM events",
    "out_of_scope_labels": """
        SELECT doc_id, text, 'general_inquiry' AS intent, 'labels' AS source
        FROM labels JOIN documents USING (doc_id) WHERE quality = 0""",
    "label_counts": "SELECT event_type AS intent, count(*) AS rows FROM events GROUP BY event_type",
    "label_histogram": """
        SELECT event_type AS intent, count(*) AS rows, repeat('█', count(*) // 100) AS bar FROM events GROUP BY event_type""",
    "distinct_labels": "SELECT DISTINCT source FROM documents WHERE source IS NOT NULL",
    "count_distinct_labels": "SELECT count(*) AS rows, count(DISTINCT source) AS labels FROM documents",
    "taxonomy_coverage": COVERAGE,
    "missing_intents": f"SELECT intent FROM ({COVERAGE}) WHERE rows = 0",
    "mapping_preview": f"""
        WITH per_label AS (SELECT from_label, to_label, count(event_id) AS n
                           FROM {MAPPING} LEFT JOIN events ON event_type = from_label GROUP BY ALL),
        sources AS (SELECT to_label, string_agg(from_label, ' + ' ORDER BY from_label) AS labels, CAST(sum(n) AS BIGINT) AS n
                    FROM per_label GROUP BY to_label)
        SELECT intent, coalesce(labels, CASE WHEN intent = 'general_inquiry' THEN 'NO MATCH - use out-of-scope rows'
                                             ELSE 'NO MATCH - need synthetic data' END) AS labels, coalesce(n, 0) AS rows
        FROM {TAXONOMY} LEFT JOIN sources ON to_label = intent""",
    "relabelled_table": RELABELLED,
    "relabelled_table_without_key": RELABELLED,
    "relabel_funnel": steps_table(
        [
            ("support", "SELECT count(*) FROM documents"),
            ("support_kept", f"SELECT count({LANG_CASE}) FROM documents"),
            ("scoped", "SELECT count(*) FROM conversations"),
            ("scoped_kept", "SELECT count(*) FROM conversations WHERE turn = 0"),
            (
                "combined",
                f"SELECT (SELECT count({LANG_CASE}) FROM documents) + (SELECT count(*) FROM conversations WHERE turn = 0)",
            ),
        ]
    ),
    "merge_training": f"WITH {USABLE} SELECT * FROM merged",
    "merge_report": f"""
        WITH {USABLE}
        SELECT taxonomy.intent, count(merged.intent) AS rows, repeat('█', count(merged.intent) // 50) AS bar,
               count(merged.intent) = 0 AS missing
        FROM {TAXONOMY} LEFT JOIN merged ON merged.intent = taxonomy.intent GROUP BY taxonomy.intent""",
    "merge_funnel": f"WITH {USABLE} "
    + steps_table(
        [
            ("relabelled", "SELECT count(*) FROM sides WHERE side = 0"),
            ("synthetic", "SELECT count(*) FROM sides WHERE side = 1"),
            ("combined", "SELECT count(*) FROM sides"),
            ("usable", "SELECT count(*) FROM usable"),
            ("duplicates", "SELECT (SELECT count(*) FROM usable) - (SELECT count(*) FROM merged)"),
            ("final", "SELECT count(*) FROM merged"),
        ]
    ),
    "drop_duplicate_documents": """
        SELECT text, doc_id, lang FROM documents
        QUALIFY row_number() OVER (PARTITION BY text ORDER BY doc_id, lang) = 1""",
    "seeded_shuffle": "SELECT text, lang FROM documents",
    "shuffled_positions": """
        SELECT doc_id, lang, row_number() OVER (ORDER BY md5('42' || chr(31) || doc_id), doc_id) - 1 AS position FROM documents""",
    "word_stats": f"""
        SELECT lang, avg({WORDS}) AS avg_words, min({WORDS}) AS min_words, max({WORDS}) AS max_words
        FROM documents GROUP BY lang""",
    "word_counts": f"SELECT doc_id, {WORDS} AS words FROM documents",
    "samples_per_label": f"SELECT doc_id, text, intent, position FROM ({SAMPLES})",
    "prompt_rows": """
        SELECT source AS intent, '20 messages for ' || source || ' (document ' || doc_id || '), about ' || lang
               || ', such as:' || chr(10) || '- ' || text || chr(10) || '- ' || lang || chr(10) || 'Each on a line.' AS prompt
        FROM documents""",
    "reply_lines": f"""
        SELECT doc_id, {strip('line')} AS text, intent, 'synthetic' AS source
        FROM (SELECT doc_id, source AS intent, unnest(string_split(text, chr(10))) AS line FROM documents)
        WHERE length({strip('line')}) > 10""",
    "csv_roundtrip": "SELECT doc_id, nullif(text, '') AS text, nullif(lang, '') AS lang FROM documents",
    "labelled_corpus": "SELECT text, source AS intent FROM documents",
    "labelled_splits": """
        SELECT text, source AS intent, CASE lang WHEN 'en' THEN 'train' WHEN 'de' THEN 'validation' ELSE 'test' END AS split
        FROM documents""",
    "entities": f"""
        WITH marked AS (SELECT msg_id, {marked('clean_text')} AS w, {marked_digits('clean_text')} AS p FROM ({CLEAN_EMAILS}))
        SELECT msg_id, {ENTITIES} FROM marked""",
    "entities_documents": f"""
        WITH marked AS (SELECT doc_id, {marked('text')} AS w, {marked_digits('text')} AS p FROM documents)
        SELECT doc_id, {ENTITIES} FROM marked""",
    "route": ROUTED,
    "route_column": ROUTED,
    "interaction_records": f"""
        SELECT CAST(to_json({{'msg_id': msg_id, 'clean_text': clean_text}}) AS VARCHAR) AS record FROM ({CLEAN_EMAILS})""",
    "intent_baseline": f"""
        WITH {naive_bayes("SELECT conv_id || '-' || turn AS id, text FROM conversations")}
        SELECT texts.id AS turn_id, predicted_intent, log_score, round(confidence, 6) AS confidence
        FROM texts LEFT JOIN judged USING (id)""",
    "intent_regression": "SELECT count(*) AS rows, count(text) AS scored, count(*) AS routed FROM conversations",
    "interaction_pipeline": f"""
        WITH cleaned AS MATERIALIZED ({MIXED}),
        {naive_bayes('SELECT text_id AS id, clean_text AS text FROM cleaned')},
        entities AS (SELECT text_id AS id, {ENTITIES}
                     FROM (SELECT text_id, {marked('clean_text')} AS w, {marked_digits('clean_text')} AS p FROM cleaned))
        SELECT CAST(to_json({{
            'id': id, 'channel': channel, 'clean_text': clean_text, 'intent': predicted_intent,
            'confidence': round(confidence, 6),
            'route': CASE WHEN confidence >= 0.85 THEN 'accepted' ELSE 'fallback' END,
            'entities': {{'emails': {json_list('emails')}, 'phones': {json_list('phones')}, 'waybills': {json_list('waybills')},
                         'equipment_ids': {json_list('equipment_ids')}, 'order_numbers': {json_list('order_numbers')},
                         'weights': {json_list('weights')}}}
        }}) AS VARCHAR) AS record
        FROM (SELECT text_id AS id, channel, clean_text FROM cleaned) JOIN entities USING (id) LEFT JOIN judged USING (id)""",
}
