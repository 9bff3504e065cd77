"""Entity spans against one Python pattern, on random texts and whole tables."""

import random
import re

from pyspark.sql import functions as F

from catalog.spark_queries import QUERIES, cleaned_emails, table
from deskline.functions.patterns import ENTITY_KINDS
from deskline.operators.records import entity_spans

SF = "/root/testdata/sf0.001"
LOCAL = r"[A-Za-z0-9._%+\-]"
PLAIN = re.compile(
    rf"(?<!{LOCAL})(?P<before>{LOCAL}*?)(?P<email>\b{LOCAL}+@[A-Za-z0-9.\-]+\.[A-Za-z]{{2,}}\b)"
    r"|(?P<equipment_id>\b[A-Z]{2,4}\s?\d{6}\b)"
    r"|(?P<order_number>\b(?i:SO|PO|WB|BO)-\d{4}-\d{4,6}\b)"
    r"|(?P<weight>\b\d[\d,]*(?:\.\d+)?\s?(?i:lbs?|pounds?|kgs?|kilograms?|tons?|tonnes?)\b)"
    r"|(?P<phone>(?<!\d)(?:\+?1[\s.\-]?)?(?:\(?\d{3}\)?[\s.\-]?)?\d{3}[\s.\-]?\d{4}(?!\d))"
    r"|(?P<waybill>\b\d{7,10}\b)"
)
PIECES = [
    "a.b@c.com", "@b.com", "x@y.z", "PO-2024-00012", "ABCX 123456", "TTX123456", "2,000 lbs", "3.5 tons", "12 kg", "1234567 lb",
    "(555) 123-4567", "+1 555 123 4567", "5551234567", "12345678", "123456789", "1234567", "a", "b.c", "@", ".com", "é", "-", "+",
    "1", "555", "0123", "AB", "po-", "١", "\x01", "\x02", "\x03", "\U0001f600", " ", " ", "\n", ",",
]


def plain_spans(text):
    return [(k, m.start(k), m.end(k), m[k]) for m in PLAIN.finditer(text) for k in ENTITY_KINDS if m[k] is not None]


def test_spans_of_random_texts(spark):
    rnd = random.Random(8)
    texts = ["".join(rnd.choice(PIECES) for _ in range(rnd.randint(0, 12))) for _ in range(6_000)]
    df = spark.createDataFrame([(i, t, 0) for i, t in enumerate(texts)], "k int, clean_text string, spans int")
    found = {r.k: [tuple(s) for s in r.spans] for r in entity_spans(df).collect()}
    wrong = [(t, found[i], plain_spans(t)) for i, t in enumerate(texts) if found[i] != plain_spans(t)]
    assert wrong[:2] == []
    assert sum(map(len, found.values())) > 3_000


def test_claims_and_hard_rows(spark):
    text = "call 1234567 or 92345678 re ABCX 123456, 1234567 lbs, to +15551234567@x.com"
    df = spark.createDataFrame([(text,), (None,), ("",), ("1234567 " * 20_000,), ("a" * 300_000 + "@",)], "clean_text string")
    rows = [r.spans for r in entity_spans(df).collect()]
    assert [(s.kind, text[s.start : s.stop]) for s in rows[0]] == [
        ("phone", "1234567"), ("waybill", "92345678"), ("equipment_id", "ABCX 123456"), ("weight", "1234567 lbs"), ("email", "15551234567@x.com"),
    ]
    assert all(s.value == text[s.start : s.stop] for s in rows[0])
    assert rows[1:3] == [[], []] and len(rows[3]) == 20_000 and rows[4] == []
    assert entity_spans(df.limit(0)).collect() == []


def test_queries_equal_the_plain_pattern(spark):
    for name, key, texts in (
        ("entity_spans", "msg_id", cleaned_emails(spark, SF).select("msg_id", F.col("clean_text").alias("t"))),
        ("entity_spans_documents", "doc_id", table(spark, SF, "documents").select("doc_id", F.col("text").alias("t"))),
    ):
        wanted = {r[0]: "|".join(f"{k}:{a}:{b}:{v}" for k, a, b, v in plain_spans(r.t or "")) for r in texts.collect()}
        found = {r[key]: r.spans for r in QUERIES[name](spark, SF).collect()}
        assert found == wanted and sum(map(bool, wanted.values())) > 5
