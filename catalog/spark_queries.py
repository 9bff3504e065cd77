"""One Spark query for each operator, on the whole of the given tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from catalog import inputs
from deskline.operators import labels, profile, records, rows
from deskline.operators.channels import clean_interactions
from deskline.operators.chat import clean_chats
from deskline.operators.email import EmailConfig, clean_emails
from deskline.operators.transcript import clean_transcripts
from deskline.plans import interactions, synthetic, training
from deskline.plans.intent_baseline import (
    predict_intents,
    predict_naive_bayes,
    train_intent_baseline,
    train_naive_bayes,
)
from deskline.sources.shared import shared_folder
from deskline.sources.tables import read_csv, read_labelled, read_splits, write_csv

QUERIES = {}


def query(run):
    QUERIES[run.__name__] = run
    return run


def table(spark: SparkSession, d: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{d}/{name}.parquet")


# -- text cleaners ----------------------------------------------------------


def raw_chats(spark, d):
    turns = table(spark, d, "conversations")
    return turns.select("conv_id", "turn", F.expr(inputs.CHAT).alias("raw_chat"))


def raw_transcripts(spark, d):
    turns = table(spark, d, "conversations")
    return turns.select("conv_id", "turn", F.expr(inputs.TRANSCRIPT).alias("raw_transcript"))


def raw_emails(spark, d):
    # An order is some bytes in its file and a long chain of steps as an email: files are
    # cut by bytes into far too few tasks, so the narrow rows are spread first.
    columns = ("o_orderkey", "o_custkey", "o_orderdate", "o_orderpriority")
    context, conf = spark.sparkContext, spark.conf
    tasks = max(int(conf.get("spark.sql.shuffle.partitions")), 4 * context.defaultParallelism)
    orders = table(spark, d, "orders").select(*columns).repartition(tasks)
    return orders.select(F.col("o_orderkey").alias("msg_id"), F.expr(inputs.EMAIL).alias("raw_email"))


def emails_with(spark, d, config):
    return clean_emails(raw_emails(spark, d), config=config).select("msg_id", "clean_text")


@query
def chat_customer_text(spark, d):
    return clean_chats(raw_chats(spark, d)).select("conv_id", "turn", "clean_text")


@query
def chat_all_turns(spark, d):
    return clean_chats(raw_chats(spark, d), customer_only=False).select("conv_id", "turn", "clean_text")


@query
def transcript_customer_text(spark, d):
    return clean_transcripts(raw_transcripts(spark, d)).select("conv_id", "turn", "clean_text")


@query
def transcript_all_turns(spark, d):
    return clean_transcripts(raw_transcripts(spark, d), customer_only=False).select("conv_id", "turn", "clean_text")


@query
def email_default(spark, d):
    return emails_with(spark, d, EmailConfig())


@query
def email_ner_friendly(spark, d):
    return emails_with(spark, d, EmailConfig.ner_friendly())


@query
def email_strict(spark, d):
    return emails_with(spark, d, EmailConfig.strict())


@query
def email_forward_depth(spark, d):
    return emails_with(spark, d, EmailConfig(max_chain_depth=1))


@query
def email_forward_unlimited(spark, d):
    return emails_with(spark, d, EmailConfig(max_chain_depth=0))


@query
def email_custom(spark, d):
    return emails_with(
        spark,
        d,
        EmailConfig(
            strip_html=False,
            strip_urls=False,
            strip_signatures=False,
            lowercase=True,
            max_length=40,
            extra_removal_patterns=(r"WAYBILL [0-9]+", r"urgent"),
        ),
    )


@query
def email_verbatim(spark, d):
    return emails_with(
        spark,
        d,
        EmailConfig(
            strip_forwarded_headers=False,
            strip_reply_headers=False,
            strip_email_headers=False,
            strip_signatures=False,
            strip_disclaimers=False,
            strip_html=False,
            strip_urls=False,
            normalize_whitespace=False,
            normalize_unicode=False,
            max_length=None,
        ),
    )


@query
def email_html_pages(spark, d):
    pages = table(spark, d, "pages").select("page_id", "html")
    return clean_emails(pages, "html").select("page_id", "clean_text")


@query
def email_documents_strict(spark, d):
    documents = table(spark, d, "documents").select("doc_id", "text")
    return clean_emails(documents, "text", config=EmailConfig.strict()).select("doc_id", "clean_text")


def mixed_texts(spark, d):
    def channel(df, name, key, raw):
        text_id = F.concat(F.lit(name + " "), F.expr(key))
        return df.select(F.lit(name).alias("channel"), text_id.alias("text_id"), F.col(raw).alias("raw_text"))

    turn_key = "CAST(conv_id AS STRING) || '-' || CAST(turn AS STRING)"
    return rows.stack(
        channel(raw_emails(spark, d), "email", "CAST(msg_id AS STRING)", "raw_email"),
        channel(raw_transcripts(spark, d), "transcript", turn_key, "raw_transcript"),
        channel(raw_chats(spark, d), "chat", turn_key, "raw_chat"),
    )


@query
def mixed_channels(spark, d):
    return clean_interactions(mixed_texts(spark, d)).select("channel", "text_id", "clean_text")


# -- labels -----------------------------------------------------------------


def labelled_events(spark, d):
    return table(spark, d, "events").select(
        "event_id", F.col("props").alias("text"), F.col("event_type").alias("intent")
    )


@query
def relabel_events(spark, d):
    return labels.relabel(labelled_events(spark, d), inputs.EVENT_LABELS, "events")


@query
def rename_event_labels(spark, d):
    return labels.rename_labels(labelled_events(spark, d), inputs.EVENT_LABELS)


@query
def out_of_scope_labels(spark, d):
    quality = table(spark, d, "labels").select("doc_id", F.col("quality").alias("intent"))
    out_of_scope = labels.extract_out_of_scope(quality, "labels", class_id=0)
    return out_of_scope.join(table(spark, d, "documents").select("doc_id", "text"), "doc_id").select(
        "doc_id", "text", "intent", "source"
    )


@query
def label_counts(spark, d):
    return labels.label_counts(labelled_events(spark, d))


@query
def label_histogram(spark, d):
    return labels.label_histogram(labelled_events(spark, d), 100)


@query
def distinct_labels(spark, d):
    return labels.distinct_labels(table(spark, d, "documents"), "source")


@query
def count_distinct_labels(spark, d):
    return labels.count_distinct_labels(table(spark, d, "documents"), "source")


def relabelled_events(spark, d):
    return labels.relabel(labelled_events(spark, d), inputs.EVENT_LABELS, "events")


@query
def taxonomy_coverage(spark, d):
    return labels.taxonomy_coverage(relabelled_events(spark, d))


@query
def missing_intents(spark, d):
    return labels.missing_intents(relabelled_events(spark, d))


@query
def mapping_preview(spark, d):
    return labels.mapping_preview(labelled_events(spark, d), inputs.EVENT_LABELS)


# -- the training table -----------------------------------------------------


def support_rows(spark, d):
    return table(spark, d, "documents").select("text", F.col("lang").alias("intent"), F.col("doc_id").alias("row_id"))


def scoped_rows(spark, d):
    return table(spark, d, "conversations").select(
        "text", F.col("turn").alias("intent"), F.col("conv_id").alias("row_id")
    )


@query
def relabelled_table(spark, d):
    return training.build_relabelled_table(
        support_rows(spark, d),
        scoped_rows(spark, d),
        inputs.LANG_LABELS,
        ("documents", "conversations"),
        class_id=0,
        key=["row_id"],
    )


@query
def relabelled_table_without_key(spark, d):
    return training.build_relabelled_table(
        support_rows(spark, d), scoped_rows(spark, d), inputs.LANG_LABELS, ("documents", "conversations"), class_id=0
    )


@query
def relabel_funnel(spark, d):
    return training.relabel_funnel(support_rows(spark, d), scoped_rows(spark, d), inputs.LANG_LABELS, class_id=0)


def relabelled_side(spark, d):
    intent = F.expr("CASE lang WHEN 'en' THEN 'track_shipment' WHEN 'de' THEN 'get_eta' WHEN 'fr' THEN 'file_claim' END")
    return table(spark, d, "documents").select(
        "text", intent.alias("intent"), "source", F.col("doc_id").alias("row_id")
    )


def synthetic_side(spark, d):
    # A turn in five is white space only.
    said = F.when(F.col("turn") % 5 != 4, F.col("text")).otherwise(F.lit("\t"))
    spoken = table(spark, d, "conversations").select(
        F.concat(F.lit(" "), said, F.lit("\n")).alias("text"),
        F.lit("general_inquiry").alias("intent"),
        F.lit("synthetic").alias("source"),
        (F.col("conv_id") * 1000 + F.col("turn")).alias("row_id"),
    )
    repeated = table(spark, d, "documents").select(
        F.concat(F.lit("\n"), "text").alias("text"),
        F.lit("report_damage").alias("intent"),
        F.lit("synthetic").alias("source"),
        (-F.col("doc_id")).alias("row_id"),
    )
    return rows.stack(spoken, repeated)


def merged(spark, d):
    return training.build_training_table(relabelled_side(spark, d), synthetic_side(spark, d), order=["row_id"])


@query
def merge_training(spark, d):
    return merged(spark, d)


@query
def merge_report(spark, d):
    return training.training_report(merged(spark, d))


@query
def merge_funnel(spark, d):
    return training.training_funnel(relabelled_side(spark, d), synthetic_side(spark, d))


@query
def drop_duplicate_documents(spark, d):
    return rows.keep_first(table(spark, d, "documents").select("text", "doc_id", "lang"), ["text"], ["doc_id"])


@query
def seeded_shuffle(spark, d):
    return rows.seeded_shuffle(table(spark, d, "documents").select("text", "lang"))


@query
def shuffled_positions(spark, d):
    return rows.shuffled_positions(table(spark, d, "documents").select("doc_id", "lang"), ["doc_id"])


# -- profiles ---------------------------------------------------------------


@query
def word_stats(spark, d):
    return profile.word_stats(table(spark, d, "documents").select("lang", "text"), by=["lang"])


@query
def word_counts(spark, d):
    return profile.with_word_count(table(spark, d, "documents").select("doc_id", "text")).select("doc_id", "words")


@query
def samples_per_label(spark, d):
    documents = table(spark, d, "documents").select("doc_id", "text", F.col("source").alias("intent"))
    return profile.samples_per_label(documents, ["doc_id"], [f"src{i}" for i in range(30)])


# -- synthetic rows ---------------------------------------------------------


PROMPT = "%s messages for %s (%s), about %s, such as:\n%s\nEach on a line."


@query
def prompt_rows(spark, d):
    spec = table(spark, d, "documents").select(
        F.col("source").alias("intent"),
        F.concat(F.lit("document "), F.col("doc_id").cast("string")).alias("description"),
        F.col("lang").alias("entities"),
        F.array("text", "lang").alias("examples"),
    )
    return synthetic.prompts(spec, 20, PROMPT)


@query
def reply_lines(spark, d):
    replies = table(spark, d, "documents").select(
        "doc_id", F.col("source").alias("intent"), F.col("text").alias("raw_text")
    )
    return synthetic.messages(replies)


# -- sources ----------------------------------------------------------------


@query
def csv_roundtrip(spark, d):
    path = shared_folder(spark, "documents-csv")
    documents = table(spark, d, "documents").select("doc_id", "text", "lang")
    write_csv(documents, path)
    return read_csv(spark, path, documents.schema)


@query
def labelled_corpus(spark, d):
    return read_labelled(spark, f"{d}/documents.parquet", text_col="text", label_col="source")


@query
def labelled_splits(spark, d):
    path = shared_folder(spark, "splits")
    split = F.expr("CASE lang WHEN 'en' THEN 'train' WHEN 'de' THEN 'validation' ELSE 'test' END")
    table(spark, d, "documents").select("text", "source", split.alias("part")).write.partitionBy("part").parquet(path)
    splits = {name: f"{path}/part={name}" for name in ("train", "validation", "test")}
    return read_splits(spark, splits, keep_split=True, label_col="source")


# -- records ----------------------------------------------------------------


def cleaned_emails(spark, d):
    return emails_with(spark, d, EmailConfig.ner_friendly())


KINDS = ("emails", "phones", "waybills", "equipment_ids", "order_numbers", "weights")


def joined_entities():
    return [F.array_join(f"entities.{k}", "|").alias(k) for k in KINDS]


@query
def entities(spark, d):
    return records.extract_entities(cleaned_emails(spark, d)).select("msg_id", *joined_entities())


@query
def entities_documents(spark, d):
    documents = table(spark, d, "documents").select("doc_id", "text")
    return records.extract_entities(documents, "text").select("doc_id", *joined_entities())


def listed_spans():
    each = F.transform("spans", lambda s: F.concat_ws(":", s["kind"], s["start"], s["stop"], s["value"]))
    return F.array_join(each, "|").alias("spans")


@query
def entity_spans(spark, d):
    return records.entity_spans(cleaned_emails(spark, d)).select("msg_id", listed_spans())


@query
def entity_spans_documents(spark, d):
    documents = table(spark, d, "documents").select("doc_id", "text")
    return records.entity_spans(documents, "text").select("doc_id", listed_spans())


def scored_events(spark, d):
    """Events with a confidence, a missing one, or one that is not a number."""
    confidence = F.when(F.col("event_type") == "view", F.lit(float("nan"))).when(
        F.col("event_type") != "error", F.col("value") / 20
    )
    return table(spark, d, "events").select("event_id", confidence.alias("confidence"))


def shown(df):
    """A confidence that is not a number, as -1."""
    return df.withColumn("confidence", F.nanvl("confidence", F.lit(-1.0)))


@query
def route(spark, d):
    accepted, fallback = records.route_by_confidence(scored_events(spark, d))
    return shown(
        rows.stack(accepted.withColumn("route", F.lit("accepted")), fallback.withColumn("route", F.lit("fallback")))
    )


@query
def route_column(spark, d):
    return shown(records.with_route(scored_events(spark, d)))


@query
def interaction_records(spark, d):
    return records.to_records(cleaned_emails(spark, d))


def intent_model(spark, d):
    return train_naive_bayes(merged(spark, d))


def turns(spark, d):
    key = F.expr("CAST(conv_id AS STRING) || '-' || CAST(turn AS STRING)")
    return table(spark, d, "conversations").select(key.alias("turn_id"), "text")


@query
def intent_baseline(spark, d):
    predicted = predict_naive_bayes(intent_model(spark, d), turns(spark, d), "turn_id")
    return predicted.withColumn("confidence", F.round("confidence", 6))


@query
def intent_regression(spark, d):
    """Facts that hold for any fit: rows, those with a confidence and an intent, and those
    on the route that their confidence asks for, of both routes together."""
    model = train_intent_baseline(merged(spark, d))
    scored = records.with_route(predict_intents(model, turns(spark, d)))
    sure = F.col("confidence").between(1e-9, 1) & F.col("predicted_intent").isin(list(labels.INTENTS))
    accepted = F.coalesce(F.col("confidence") >= records.FALLBACK_THRESHOLD, F.lit(False))
    routed = F.when(accepted, "accepted").otherwise("fallback") == F.col("route")
    return scored.agg(F.count("*").alias("rows"), F.count_if(sure).alias("scored"), F.count_if(routed).alias("routed"))


@query
def interaction_pipeline(spark, d):
    """Cleaner by channel, entities, intent, route, and one JSON record for each text."""
    return interactions.process_interactions(
        mixed_texts(spark, d), intent_model(spark, d), "text_id", channel_col="channel", in_col="raw_text"
    )
