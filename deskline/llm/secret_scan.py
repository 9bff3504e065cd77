"""Secrets in texts: candidates by pattern, and a random forest that removes the false
positives. Only Spark's own functions and its forest are used.
"""

from __future__ import annotations

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from deskline.functions.text import let

# Characters of a run that is a candidate wherever it stands, and of a value that is
# assigned or quoted, at least. Passwords in URLs have any length.
SHORTEST, SHORTEST_VALUE = 16, 6
_CANDIDATE = f"[A-Za-z0-9_+/.-]{{{SHORTEST},}}={{0,2}}"
# Marks around a candidate are no part of it.
_TRIM = r"\A[./-]+|[./-]+\z"
# Values: a word is cut where another name follows; what comes after the name, in quotes
# or up to the marks at its end; what is in quotes; the password of a URL.
_NEXT_NAME = r"[,;&?](?=[\"'`]?[\w.-]++[\"'`]?[=:])"
_AFTER_NAME = r"(?s)\A[^=:]*+[=:]++>?+(?!//)(.+)\z"
_OPENED = r"(?s)\A([\"'`])(.+?)(?:\1|\z)"
_END_MARKS = r"(?<![,;.\"'`])[,;.\"'`]++\z"
_QUOTED = r"(?s)([\"'`])(.+?)\1[=:]?"
_LOGIN = "://[^/:@]*+:([^/]+)@"
# Not values themselves, but what follows them is one.
_SCHEMES = ("bearer", "basic", "digest")

# Words that names and prose are made of, and words near findings.
DICTIONARY = (
    "access account action address admin after api app archive array author backup base before body buffer build bundle "
    "button cache call check class client cloud code color common compile config connection console container content "
    "context control controller copy count create current data database date debug default delete demo desktop develop "
    "device directory display document domain download driver error event example export factory field file filter folder "
    "font form format frame function get group handler header history home host html http image import index info input "
    "install instance interface internal item java key lang latest level library license limit line link list load local "
    "lock log login long main manager map master message method model module name network node number object option order "
    "output package page panel param parent password path pattern plugin point policy port print private process product "
    "profile program project property provider public query read record release remote report request reset resource "
    "response result return role root rule sample schema script search second section secret select sequence server "
    "service session set setting share simple size source stack start state static status storage store stream string "
    "style support system table target task temp template test text thread time title token tool total type unit update "
    "upload user util value version view window with word work write"
).split()
_SECRET_WORDS = "token|secret|passw|pwd|api|key|auth|bearer|credential|private|signature"
_OTHER_WORDS = "sha|md5|commit|checksum|digest|uuid|guid|etag|revision|hash|integrity|build|trace|session_id|request"

FEATURES = (
    "length",
    "digits",
    "capitals",
    "transitions",
    "symbols",
    "runs",
    "vowels",
    "coverage",
    "hex_only",
    "path_marks",
    "url",
    "assigned",
    "quoted",
    "near_secret",
    "near_other",
    "marks",
    "brackets",
    "value",
    "login",
)


def secret_candidates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id``, ``word`` (its number in the text), ``candidate`` and the features of what
    may be a secret: each run of at least 16 characters of keys and names, each value of
    at least 6 characters, whatever they are, that is quoted or assigned, and the password
    of each URL.

    Words are what spaces, tabs and line ends separate; a word may hold several
    candidates, and a value without quotes ends before a mark and another name, and before
    commas, points and semicolons at the end of the word. Length, transitions between
    kinds of characters, how much of it common words cover, marks of paths and URLs, and
    the two words before and the one after it are its features. Null texts hold nothing, a
    null id stays null.
    """
    words = F.split(F.coalesce(F.col(text_col), F.lit("")), r"[ \t\r\n]+")

    def assigns(word: Column) -> Column:
        ends = [F.endswith(word, F.lit(mark)) for mark in ("=", ":", "=>")]
        return F.coalesce(ends[0] | ends[1] | ends[2] | F.lower(word).isin(*_SCHEMES), F.lit(False))

    def may_hold(w: Column, before: Column) -> Column:
        marked = F.translate(w, "=:\"'`", "") != w
        return (F.octet_length(w) >= SHORTEST) | ((F.octet_length(w) >= SHORTEST_VALUE) & (marked | assigns(before)))

    found = let(
        words,
        lambda held: F.filter(
            F.transform(
                held,
                lambda w, i: F.when(
                    may_hold(w, F.get(held, i - 1)),
                    F.struct(
                        i.alias("word"),
                        w.alias("inside"),
                        F.concat_ws(" ", F.get(held, i - 2), F.get(held, i - 1)).alias("before"),
                        F.coalesce(F.get(held, i + 1), F.lit("")).alias("after"),
                        assigns(F.get(held, i - 1)).alias("follows"),
                    ),
                ),
            ),
            lambda x: x.isNotNull(),
        ),
    )
    rows = docs.select(F.col(id_col).alias("id"), F.explode(found).alias("x")).select("id", "x.*")
    rows = rows.withColumns({"runs": _runs(), "values": _values(), "logins": F.regexp_extract_all("inside", F.lit(_LOGIN), F.lit(1))})
    rows = rows.withColumn("candidate", F.explode(F.concat("runs", F.array_except(F.concat("values", "logins"), "runs"))))
    return _featured(rows).select("id", "word", "candidate", *FEATURES)


def _runs() -> Column:
    found = F.regexp_extract_all("inside", F.lit(_CANDIDATE), F.lit(0))
    trimmed = F.transform(found, lambda x: F.regexp_replace(x, _TRIM, ""))
    return F.filter(trimmed, lambda x: F.length(x) >= SHORTEST)


def _values() -> Column:
    """What is assigned in ``inside``, or by the word before it, or quoted there."""

    def bare(x: Column) -> Column:
        opened = F.regexp_extract(x, _OPENED, 2)
        return F.when(opened != "", opened).otherwise(F.regexp_replace(x, _END_MARKS, ""))

    parts = F.split("inside", _NEXT_NAME)
    assigned = F.transform(parts, lambda x: bare(F.regexp_extract(x, _AFTER_NAME, 1)))
    following = F.when(F.col("follows"), F.array(bare(parts[0]))).otherwise(F.array().cast("array<string>"))
    # What is quoted before a sign of assignment is a name.
    quoted = F.filter(F.regexp_extract_all("inside", F.lit(_QUOTED), F.lit(0)), lambda x: ~x.rlike(r"[=:]\z"))
    quoted = F.transform(quoted, lambda x: F.substring(x, F.lit(2), F.length(x) - 2))
    found = F.concat(assigned, following, quoted)
    return F.filter(found, lambda x: (F.length(x) >= SHORTEST_VALUE) & ~F.lower(x).isin(*_SCHEMES))


def _featured(rows: DataFrame) -> DataFrame:
    text, size = F.col("candidate"), F.length("candidate")

    def share(pattern: str) -> Column:
        return F.regexp_count(text, F.lit(pattern)) / size

    longest_first = "|".join(sorted((w for w in DICTIONARY if len(w) > 3), key=len, reverse=True))
    uncovered = F.length(F.regexp_replace(F.lower(text), longest_first, ""))
    around = F.lower(F.concat_ws(" ", "before", F.regexp_replace("inside", _CANDIDATE, " ")))
    named = F.lower(F.concat_ws(" ", "before", F.expr("substring_index(inside, candidate, 1)")))

    def flag(condition: Column) -> Column:
        return condition.cast("double")

    return rows.withColumns(
        {
            "length": F.log2(size.cast("double")),
            "digits": share("[0-9]"),
            "capitals": share("[A-Z]"),
            "transitions": share("[a-z](?=[A-Z0-9])|[A-Z](?=[0-9])|[0-9](?=[A-Za-z])"),
            "symbols": share("[_.+=-]"),
            "runs": share(r"(.)(?=\1)"),
            "vowels": share("[aeiouAEIOU]"),
            "coverage": 1 - uncovered / size,
            "hex_only": flag(text.rlike(r"\A[0-9a-fA-F]+\z")),
            "path_marks": share(r"/|\.[a-z]{1,5}\b"),
            "url": flag(F.contains("inside", F.lit("://")) | F.contains(F.lower("inside"), F.lit("www."))),
            "assigned": flag(around.rlike(r"[=:]\s*[\"'`]?\s*\z|[=:]")),
            "quoted": flag(F.col("inside").rlike("[\"'`]")),
            "near_secret": flag(named.rlike(_SECRET_WORDS)),
            "near_other": flag(F.concat_ws(" ", named, F.lower("after")).rlike(_OTHER_WORDS)),
            "marks": share("[^A-Za-z0-9_.+/=-]"),
            "brackets": share(r"[<>{}()\[\]]"),
            "value": flag(F.array_contains("values", text)),
            "login": flag(F.array_contains("logins", text)),
        }
    )


def train_secret_forest(labelled: DataFrame, text_col: str = "text", label_col: str = "secret", trees: int = 40) -> PipelineModel:
    """The forest, from texts whose candidates are all secrets (1) or all not (0). Rows
    with a null text or label teach nothing."""
    rows = labelled.where(F.col(label_col).isNotNull())
    found = secret_candidates(rows, label_col, text_col).select(F.col("id").cast("double").alias("label"), *FEATURES)
    assembler = VectorAssembler(inputCols=list(FEATURES), outputCol="features")
    forest = RandomForestClassifier(numTrees=trees, maxDepth=8, seed=7, featureSubsetStrategy="sqrt")
    return Pipeline(stages=[assembler, forest]).fit(found)


def secret_scan(docs: DataFrame, forest: PipelineModel, id_col: str = "doc_id", text_col: str = "text", threshold: float = 0.5) -> DataFrame:
    """``id``, ``word``, ``candidate``, ``score`` (share of the forest's votes) and
    ``is_secret`` (from ``threshold`` on) for every candidate of :func:`secret_candidates`.
    Documents without a candidate have no row. Nothing is shuffled."""
    judged = forest.transform(secret_candidates(docs, id_col, text_col))
    score = vector_to_array("probability")[1]
    return judged.select("id", "word", "candidate", score.alias("score")).withColumn("is_secret", F.col("score") >= threshold)


def seed_findings(spark: SparkSession, rows: int = 2600) -> DataFrame:
    """Labelled findings to start from, made by rule: keys and passwords of several kinds
    and shapes of assignment, passwords in URLs, and the strings that are taken for them. A user's own labelled
    findings take their place."""
    n = F.col("id")

    def one_of(choices: list, salt: str | int) -> Column:
        return F.element_at(F.array(*choices), F.pmod(F.xxhash64(n, F.lit(salt)), F.lit(len(choices))).cast("int") + 1)

    def one_name(names: str, salt: str) -> Column:
        return one_of([F.lit(x) for x in names.split()], salt)

    # The parts are columns, as the shapes name them often.
    table = spark.range(rows).select(
        "id",
        F.sha2(F.concat(F.lit("finding-"), n.cast("string")), 256).alias("draw"),
        F.base64(F.unhex(F.sha2(F.concat(F.lit("mixed-"), n.cast("string")), 256))).alias("mixed"),
        *[one_of([F.lit(w) for w in DICTIONARY], k).alias(f"word{k}") for k in range(5)],
        one_name("token api_key secret password auth_token client_secret access-key", "name").alias("name"),
        (F.pmod(F.xxhash64(n, F.lit("size")), F.lit(24)) + 20).cast("int").alias("size"),
        one_name("commit sha256: checksum md5 revision uuid etag: digest", "other").alias("other"),
        (F.pmod(F.xxhash64(n, F.lit("number")), F.lit(9000)) + 1000).cast("string").alias("number"),
        one_name("! @ # $ % & * - _ ? ^ ~", "mark").alias("mark"),
        one_name("password passwd pwd db_password secret api_key admin-pwd", "owner").alias("owner"),
        one_name("postgres mysql redis https mongodb amqp ftp", "server").alias("server"),
        one_name("version order room name color title model part file id", "plain").alias("plain"),
    )
    draw, mixed, name, other, number, mark, owner, server, plain = map(
        F.col, ("draw", "mixed", "name", "other", "number", "mark", "owner", "server", "plain")
    )
    word = [F.col(f"word{k}") for k in range(5)]
    # Passwords of 8 and more characters.
    passwords = [
        F.concat(F.initcap(word[0]), mark, number),
        F.substring(mixed, 1, 9),
        F.concat(word[1], F.lit("2-"), number),
        F.concat(F.substring(mixed, 3, 5), mark, F.substring(draw, 1, 4), F.lit("#$"), F.substring(mixed, 9, 6)),
        F.concat(F.translate(F.initcap(word[2]), "aeo", "430"), F.substring(draw, 5, 3), mark, F.lit("3")),
        F.concat(F.substring(mixed, 20, 3), mark, F.substring(draw, 9, 4)),
    ]
    table = table.withColumn("made", one_of(passwords, "made"))
    made = F.col("made")
    hexes, keys = F.substring(draw, F.lit(1), F.col("size")), F.substring(mixed, F.lit(1), F.col("size"))
    uuid = F.concat_ws("-", *[F.substring(draw, at, size) for at, size in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))])
    shapes = [
        (1, F.concat(owner, F.lit(' = "'), made, F.lit('"'))),
        (1, F.concat(F.lit("the "), owner, F.lit(": "), made, F.lit(" and more"))),
        (1, F.concat(F.upper(owner), F.lit("="), made)),
        (1, F.concat(F.lit('{"'), owner, F.lit('":'), F.lit('"'), made, F.lit('"}'))),
        (1, F.concat(F.lit("set "), owner, F.lit("='"), made, F.lit("'; then"))),
        (1, F.concat(server, F.lit("://"), word[3], F.lit(":"), made, F.lit("@"), word[4], F.lit(".example.com"))),
        (1, F.concat(F.lit("open "), server, F.lit("://app:"), F.substring(mixed, 5, 8), F.lit("@host/"), word[3])),
        (0, F.concat(owner, F.lit(": "), word[0], word[1])),
        (0, F.concat(owner, F.lit(' = "'), F.initcap(word[0]), F.lit("-"), word[1], F.lit('"'))),
        (0, F.concat(F.lit("the "), owner, F.lit(": required, "), owner, F.lit(": changed"))),
        (0, F.concat(owner, F.lit("=<your-"), word[0], F.lit("> "), owner, F.lit("=${"), F.upper(word[1]), F.lit("_"), F.upper(word[2]), F.lit("}"))),
        (0, F.concat(owner, F.lit(": "), F.repeat(F.lit("*"), 8), F.lit(" "), owner, F.lit("=get_"), word[0], F.lit("("), word[1], F.lit(")"))),
        (0, F.concat(owner, F.lit(' = "'), F.repeat(F.substring(F.lit("*.x-#_"), F.pmod(n, F.lit(6)).cast("int") + 1, F.lit(1)), F.pmod(n, F.lit(7)).cast("int") + 6), F.lit('"'))),
        (0, F.concat(F.lit('they say "'), word[0], word[1], F.lit("\" and '"), F.initcap(word[2]), word[3], F.lit("' here"))),
        (0, F.concat(plain, F.lit(": "), made)),
        (0, F.concat(plain, F.lit('="'), made, F.lit('" '), plain, F.lit("="), word[0], F.lit("-"), number)),
        (0, F.concat(F.lit("note: "), word[0], word[1], F.lit(" at 12:30:"), number, F.lit(" date=2024-11-"), number)),
        (0, F.concat(F.lit("mail: "), word[0], F.lit("."), word[1], F.lit("@example.com, tel: +49-30-"), number, number)),
        (0, F.concat(F.lit("http://www.example.com:8080/"), word[0], F.lit("?page="), word[1], word[2], F.lit("&lang="), word[3], number)),
        (0, F.concat(F.lit("as in "), server, F.lit("://user:password@localhost/"), word[0])),
        (0, F.concat(F.lit("with "), server, F.lit("://"), word[0], F.lit(":<"), word[1], F.lit(">@host"))),
        (1, F.concat(F.lit("it says "), name, F.lit(' = "'), hexes, F.lit('" there'))),
        (1, F.concat(name, F.lit(": "), keys)),
        (1, F.concat(F.lit("export "), F.upper(name), F.lit("="), hexes)),
        (1, F.concat(F.lit("Authorization: Bearer "), keys, F.lit("."), F.substring(draw, 1, 20))),
        (1, F.concat(F.lit("use the "), name, F.lit(" "), keys, F.lit(" for it"))),
        (1, F.concat(name, F.lit("='"), F.upper(F.substring(draw, 1, 20)), F.lit("'"))),
        (0, F.concat(other, F.lit(" "), draw)),
        (0, F.concat(F.lit("see "), other, F.lit(" "), F.substring(draw, 1, 40), F.lit(" of the build"))),
        (0, F.concat(F.lit("id "), uuid, F.lit(" is done"))),
        (0, F.concat(F.lit("/usr/lib/"), word[0], F.lit("/"), word[1], F.lit("-"), word[2], F.lit(".so"))),
        (0, F.concat(F.lit("call "), word[0], F.lit("_"), word[1], F.lit("_"), word[2], F.lit("_"), word[3], F.lit("()"))),
        (0, F.concat(F.lit("key = "), word[0], F.lit("."), F.initcap(word[1]), F.initcap(word[2]), F.initcap(word[3]))),
        (0, F.concat(F.lit("http://www.example.com/"), word[0], F.lit("/"), word[1], F.lit("-"), word[2], F.lit("/"), n.cast("string"), F.lit(".html"))),
        (0, F.concat(F.lit("password: "), F.repeat(F.lit("x"), 24))),
        (0, F.concat(F.lit("total "), F.repeat(F.lit("0123456789"), 2), n.cast("string"))),
        (0, F.concat(F.lit("the "), F.concat(*word), F.lit(" token "), F.concat(*word[1:]), F.lit("-"), word[0])),
        (0, F.concat(word[0], F.lit(" "), F.repeat(F.lit("="), 30), F.lit(" "), F.repeat(F.lit("-"), 40), F.lit(" "), F.repeat(F.lit("_."), 20))),
    ]
    kind = F.pmod(n, F.lit(len(shapes)))
    text, label = F.lit(None).cast("string"), F.lit(None).cast("int")
    for i, (secret, shape) in enumerate(shapes):
        text, label = F.when(kind == i, shape).otherwise(text), F.when(kind == i, secret).otherwise(label)
    return table.select(text.alias("text"), label.alias("secret"))

