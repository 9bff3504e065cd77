"""What holds for every cleaner: no null, clean ends, any partitioning, long texts,
filters, mixed channels and streams."""

import random
import sys
import time
import unicodedata

import pytest
from pyspark.sql import functions as F

from deskline import EmailConfig, clean_chats, clean_emails, clean_interactions, clean_transcripts
from deskline.functions import patterns as p
from deskline.functions.text import first_words
from deskline.functions.unicode import to_nfc, unescape_html

CLEANERS = {
    "email": lambda df: clean_emails(df, "t"),
    "email strict": lambda df: clean_emails(df, "t", config=EmailConfig.strict()),
    "email all": lambda df: clean_emails(df, "t", config=EmailConfig(max_chain_depth=0, strip_emails=True)),
    "transcript": lambda df: clean_transcripts(df, "t"),
    "transcript all": lambda df: clean_transcripts(df, "t", customer_only=False),
    "chat": lambda df: clean_chats(df, "t"),
    "chat all": lambda df: clean_chats(df, "t", customer_only=False),
}
PIECES = (
    "Customer: |User:|Agent: |Bot:|\n|\n\n| |\t|\r\n|\xa0|\x85|>|> x|--|___|---|Thanks,|\nRegards\n|Forwarded message|On a b c wrote:|"
    "From: x|10:30|[typing]|[pause]|uh|like|...|!!|?|&amp;|&lt;|&nbsp;|<b>|<|e\u0301|\u200b|\ufeff|http://a.b|a@b.com|555-0123|"
    "ABCX 123456|disclaimer|[image|]|hello|word|PO-2024-00001|\U0001f624|yes|no"
).split("|")


def random_texts(count, seed):
    rng = random.Random(seed)
    return ["".join(rng.choices(PIECES, k=rng.randint(0, 25))) for _ in range(count)] + [None]


@pytest.mark.parametrize("name", CLEANERS)
def test_properties(spark, name):
    data = list(enumerate(random_texts(1500, seed=3)))
    df = spark.createDataFrame(data, "i int, t string")
    one = {r.i: r.clean_text for r in CLEANERS[name](df.repartition(1)).collect()}
    many = {r.i: r.clean_text for r in CLEANERS[name](df.repartition(9)).collect()}
    assert one == many and len(one) == len(data)
    limit = 256 if "strict" in name else 512
    for text in one.values():
        assert text is not None and text == text.strip()
        assert "\r\n" not in text and "\n\n\n" not in text and "\u200b" not in text
        assert "email" not in name or len(text.split()) <= limit


LENGTH = 400_000
LONG = {
    "dots": "." * LENGTH,
    "dot runs": ".. " * (LENGTH // 3),
    "newlines": "a" + "\n" * LENGTH + "b",
    "blank lines": "a" + " \n" * (LENGTH // 2) + "b",
    "spaces": "Agent" + " " * LENGTH + "x",
    "rep labels": "csx " * (LENGTH // 4),
    "dashes": "-" * LENGTH,
    "dash words": "--- fwd " * (LENGTH // 8),
    "tags": "<" * LENGTH,
    "half tags": "<a " * (LENGTH // 3),
    "brackets": "[image [typing [pause " * (LENGTH // 22),
    "address dots": "a." * (LENGTH // 2),
    "address ats": "a@" * (LENGTH // 2),
    "digits": "1" * LENGTH,
    "thanks": "\nThanks" * (LENGTH // 7),
    "signatures": "\nThanks,\n" * (LENGTH // 9) + "\n--\n",
    "on": "\nOn " * (LENGTH // 4),
    "quotes": "\n>" * (LENGTH // 2),
    "labels": "Customer: hello\n" * (LENGTH // 16),
    "uh": "u" + "h" * LENGTH,
    "fillers": "uh like " * (LENGTH // 8),
    "letters": "x" * LENGTH,
    "marks": "e\u0301" * (LENGTH // 3),
    "entities": "&amp;" * (LENGTH // 5),
    "words": "some words " * (LENGTH // 11),
}


@pytest.mark.parametrize("name", CLEANERS)
def test_long_texts_take_linear_time(spark, name):
    df = spark.createDataFrame(list(LONG.items()), "name string, t string").repartition(25, "name")
    start = time.time()
    assert CLEANERS[name](df).filter(F.col("clean_text").isNotNull()).count() == len(LONG)
    assert time.time() - start < 60


def test_filter_on_the_result_does_not_repeat_the_cleaning(spark):
    df = spark.createDataFrame([("x", "en")], "t string, lang string")
    plan = clean_emails(df, "t").filter("clean_text != '' and lang = 'en'")._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("(?:wrote|said)") == 1
    # The filter on another column moves below the cleaning.
    assert plan.rindex("lang#") > plan.rindex("ArrowEvalPython")


def test_steps_are_evaluated_natively(spark):
    df = spark.createDataFrame([("x",)], "t string")
    plan = clean_transcripts(df, "t")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("ArrowEvalPython") == 1 and "BatchEvalPython" not in plan and "Exchange" not in plan


def test_unescape_and_nfc_equal_the_standard_library(spark):
    import html

    rng = random.Random(4)
    chars = [chr(c) for c in (*range(0x20, 0x400), *range(0x1100, 0x1200), *range(0x1E00, 0x2200), *range(0xAC00, 0xAC20))]
    chars += ["\u0301", "\u0327", "\u0338", "<", "e", "\U0001d15e", "\ufb1d", "\u2126"] * 30
    texts = ["".join(rng.choices(chars, k=8)) for _ in range(5000)]
    names = ["amp", "copy", "lt", "nbsp", "notit", "#65", "#x41", "#xD800", "#0", "#1114112", "hearts", "zzz", "AMP"]
    texts += ["".join(rng.choice(["&", "a", ";", "", " "]) + rng.choice(names) + rng.choice([";", "", " "]) for _ in range(4)) for _ in range(3000)]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    for r in df.select("t", to_nfc(F.col("t")).alias("nfc"), unescape_html(F.col("t")).alias("plain")).collect():
        assert r.nfc == unicodedata.normalize("NFC", r.t)
        assert r.plain == html.unescape(r.t)


def test_texts_outside_the_nfc_class_never_change(spark):
    """Characters the gate lets pass are stable and never compose."""
    assigned = [chr(c) for c in range(sys.maxunicode + 1) if not 0xD800 <= c <= 0xDFFF]
    df = spark.createDataFrame([(c,) for c in assigned], "c string")
    passing = {r.c for r in df.filter(~F.col("c").rlike(p.MAYBE_NOT_NFC)).collect()}
    assert len(passing) > 20_000
    for c in passing:
        assert unicodedata.combining(c) == 0 and unicodedata.normalize("NFC", c) == c, hex(ord(c))
    for c in assigned:
        parts = unicodedata.normalize("NFD", c)
        # The later parts of whatever composes are held back.
        if unicodedata.normalize("NFC", parts) == c:
            assert not set(parts[1:]) & passing, hex(ord(c))


@pytest.mark.parametrize("limit", [1, 3, 50])
def test_first_words(spark, limit):
    rng = random.Random(5)
    texts = ["".join(rng.choices(["a", "bc", " ", "\n", "\xa0", "\x1c", "\u3000", "."], k=rng.randint(0, 120))) for _ in range(2000)]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    for r in df.select("t", first_words(F.col("t"), limit).alias("got")).collect():
        words = r.t.split()
        assert r.got == (" ".join(words[:limit]) if len(words) > limit else r.t)


@pytest.mark.parametrize("config", [EmailConfig(), EmailConfig(normalize_unicode=False)])
def test_mixed_channels_equal_each_cleaner(spark, config):
    texts = random_texts(400, seed=6)
    data = [(i, c, t) for i, t in enumerate(texts) for c in ("email", "transcript", "chat", "fax", None)]
    df = spark.createDataFrame(data, "i int, channel string, raw_text string")
    mixed = {(r.i, r.channel): r.clean_text for r in clean_interactions(df, email_config=config).collect()}
    assert len(mixed) == len(data)
    alone = spark.createDataFrame(list(enumerate(texts)), "i int, t string")
    single = {
        "email": clean_emails(alone, "t", config=config),
        "transcript": clean_transcripts(alone, "t"),
        "chat": clean_chats(alone, "t"),
    }
    for channel, df in single.items():
        for r in df.collect():
            assert mixed[r.i, channel] == r.clean_text
    assert {v for (_, c), v in mixed.items() if c in ("fax", None)} == {None}


def test_a_stream_gives_what_a_batch_gives(spark, tmp_path):
    source, target = str(tmp_path / "in"), str(tmp_path / "out")
    df = spark.createDataFrame(list(enumerate(random_texts(300, seed=7))), "i int, t string")
    df.repartition(4).write.parquet(source)
    stream = spark.readStream.schema(df.schema).parquet(source)
    query = (
        clean_chats(stream, "t")
        .writeStream.format("parquet")
        .option("checkpointLocation", str(tmp_path / "checkpoint"))
        .trigger(availableNow=True)
        .start(target)
    )
    assert query.awaitTermination(120)
    assert sorted(map(tuple, spark.read.parquet(target).select("i", "clean_text").collect())) == sorted(
        map(tuple, clean_chats(df, "t").select("i", "clean_text").collect())
    )
