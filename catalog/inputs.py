"""Raw texts built from the given tables, by expressions that Spark and DuckDB read
alike. Every row of a table becomes one text; some are null, blank, or hold zero-width
characters and decomposed accents."""

# Forwarded blocks in an email, at most.
MOST_FORWARDS = 5


def _sometimes_missing(text: str, number: str) -> str:
    return f"""
CASE WHEN {number} % 61 = 0 THEN NULL
     WHEN {number} % 59 = 0 THEN ' ' || chr(10) || chr(9)
     ELSE {text} END
"""


_UNUSUAL = "'zero\u200bwidth \ufeffmark, cafe\u0301' || chr(10)"

EMAIL = """
'From: cust' || CAST(o_custkey AS STRING) || '@acme.example' || chr(10)
|| 'To: support@example.com' || chr(10)
|| 'Subject: Order ' || CAST(o_orderkey AS STRING) || chr(10)
|| 'Date: ' || CAST(CAST(o_orderdate AS DATE) AS STRING) || chr(10) || chr(10)
|| 'Hi team,' || chr(13) || chr(10)
|| 'Car ABCX ' || lpad(CAST(o_orderkey % 1000000 AS STRING), 6, '0')
|| ' waybill ' || CASE o_orderkey % 4
     WHEN 0 THEN CAST(2000000 + o_orderkey AS STRING)
     WHEN 1 THEN CAST(20000000 + o_orderkey AS STRING)
     WHEN 2 THEN CAST(200000000 + o_orderkey AS STRING)
     ELSE CAST(2000000000 + o_orderkey AS STRING) END
|| ' order PO-2024-' || lpad(CAST(o_orderkey % 100000 AS STRING), 5, '0')
|| '  is late, see https://track.example/t?id=' || CAST(o_orderkey AS STRING)
|| ' or call (313) 555-0147, weight ' || CAST(o_orderkey % 900 + 100 AS STRING) || ' lbs.' || chr(10)
|| CASE WHEN o_orderkey % 2 = 0 THEN '<b>Priority</b>: ' || o_orderpriority || ' &amp; urgent &copy;' || chr(10) ELSE '' END
|| CASE WHEN o_orderkey % 3 = 0 THEN chr(10) || '> earlier words' || chr(10) || '[image: logo.png]' || chr(10) ELSE '' END
|| CASE WHEN o_orderkey % 17 = 0 THEN @UNUSUAL@ ELSE '' END
|| CASE WHEN o_orderkey % 11 = 0 THEN 'On Mon, 3 Mar 2025, Jo Poe wrote:' || chr(10) ELSE '' END
|| CASE WHEN o_orderkey % 13 = 0 THEN 'This is an automated reply.' || chr(10) ELSE '' END
|| repeat('---------- Forwarded message ---------' || chr(10) || 'old text' || chr(10) || chr(10) || 'kept' || chr(10), CAST(o_orderkey % @BLOCKS@ AS INT))
|| CASE WHEN o_orderkey % 5 = 0 THEN 'Thanks,' || chr(10) || 'Customer ' || CAST(o_custkey AS STRING) || chr(10) ELSE '' END
|| CASE WHEN o_orderkey % 7 = 0 THEN '--' || chr(10) || 'CONFIDENTIALITY NOTICE: private.' || chr(10) ELSE '' END
"""
EMAIL = _sometimes_missing(EMAIL.replace("@UNUSUAL@", _UNUSUAL).replace("@BLOCKS@", str(MOST_FORWARDS + 1)), "o_orderkey")

# One log per turn: the turn's words, and lines around it that depend on its place.
CHAT = """
'Session ID: WEB-' || CAST(conv_id AS STRING) || chr(10) || 'Channel: web' || chr(10) || chr(10)
|| '[14:' || lpad(CAST(turn % 60 AS STRING), 2, '0') || ':02] '
|| CASE role WHEN 'user' THEN CASE WHEN turn % 4 = 0 THEN '[Customer]' ELSE 'User' END
             WHEN 'assistant' THEN 'Bot' ELSE 'System' END
|| ': ' || text || chr(10)
|| '[14:' || lpad(CAST(turn % 60 AS STRING), 2, '0') || ':09] [typing]' || chr(10)
|| CASE WHEN conv_id % 3 = 0 THEN 'User: Track my shipment' || chr(13) || chr(10) ELSE '' END
|| CASE WHEN conv_id % 2 = 0 THEN '(11:40 PM) Bot: see https://rail.example/h?id=' || CAST(conv_id AS STRING) || ' now!!! ok??' || chr(10) ELSE '' END
|| CASE WHEN turn % 3 = 1 THEN chr(10) || chr(10) || ' You : thanks 🚚 wait...' || chr(10) ELSE '' END
|| CASE WHEN turn % 5 = 2 THEN 'plain words [read 14:55]  and more' || chr(10) || 'help' || chr(10) ELSE '' END
|| CASE WHEN conv_id % 7 = 0 THEN 'User: ' || @UNUSUAL@ ELSE '' END
"""
CHAT = _sometimes_missing(CHAT.replace("@UNUSUAL@", _UNUSUAL), "(conv_id + turn)")

TRANSCRIPT = """
'Call ID: REC-' || CAST(conv_id AS STRING) || chr(10) || 'Duration: 00:11:05' || chr(10) || chr(10)
|| '[00:' || lpad(CAST(turn % 60 AS STRING), 2, '0') || ':03] '
|| CASE role WHEN 'user' THEN CASE WHEN turn % 4 = 0 THEN 'Speaker 1' ELSE 'Customer' END
             WHEN 'assistant' THEN 'Agent' ELSE 'Operator' END
|| ': Uh, ' || text || chr(10)
|| CASE WHEN conv_id % 3 = 0 THEN '[00:37] Caller: I mean, it is like late.... ... you know -- umm, by 16:20' || chr(13) || chr(10) || 'Agent: okay so [inaudible 2s] mm-hmm' || chr(10) ELSE '' END
|| CASE WHEN turn % 3 = 1 THEN 'Representative: literally yes, uh-huh' || chr(10) ELSE '' END
|| CASE WHEN turn % 5 = 2 THEN 'plain words [pause]  basically so  yeah' || chr(10) ELSE '' END
|| CASE WHEN conv_id % 7 = 0 THEN 'Customer: ' || @UNUSUAL@ ELSE '' END
"""
TRANSCRIPT = _sometimes_missing(TRANSCRIPT.replace("@UNUSUAL@", _UNUSUAL), "(conv_id + turn)")

EVENT_LABELS = {
    "purchase": "request_invoice",
    "view": "track_shipment",
    "signup": "schedule_pickup",
    "error": "file_claim",
    "refund": "file_claim",
}
LANG_LABELS = {"en": "track_shipment", "de": "get_eta", "fr": "get_eta"}
