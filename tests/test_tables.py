"""Table operators on small fixtures."""

import datetime
import json
import math
import random
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from catalog import spark_queries
from deskline.operators import labels, profile, records, rows
from deskline.plans import intent_baseline, interactions, synthetic, training
from deskline.sources.shared import shared_folder
from deskline.sources.tables import NA_VALUES, read_csv, read_labelled, read_splits, write_csv, write_table

ROW = "text string, intent string, source string"


def tuples(df):
    return [tuple(r) for r in df.collect()]


# -- labels -----------------------------------------------------------------


def test_relabel(spark):
    df = spark.createDataFrame(
        [("a", "check_invoice"), ("b", "get_invoice"), ("c", "unknown"), ("d", None)], "text string, intent string"
    )
    out = labels.relabel(df, labels.SUPPORT_LABELS, "support")
    assert out.columns == ["text", "intent", "source"]
    assert sorted(tuples(out)) == [("a", "request_invoice", "support"), ("b", "request_invoice", "support")]
    renamed = labels.rename_labels(df, labels.SUPPORT_LABELS)
    assert sorted(tuples(renamed)) == [("a", "request_invoice"), ("b", "request_invoice"), ("c", None), ("d", None)]


def test_relabel_reads_only_mapped_labels(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.createDataFrame([("a", "complaint")], "text string, intent string").write.parquet(path)
    plan = labels.relabel(spark.read.parquet(path), labels.SUPPORT_LABELS, "s")._jdf.queryExecution().toString()
    assert "PushedFilters: [In(intent, [" in plan
    assert "BroadcastHashJoin" in plan


def test_out_of_scope(spark):
    df = spark.createDataFrame([("a", 42), ("b", 41), ("c", None)], "text string, intent int")
    assert tuples(labels.extract_out_of_scope(df, "scope")) == [("a", "general_inquiry", "scope")]


def test_counts_and_coverage(spark):
    df = spark.createDataFrame([("a",), ("a",), (None,), ("z",)], "intent string")
    assert tuples(labels.label_counts(df)) == [("a", 2), ("z", 1)]
    assert tuples(labels.distinct_labels(df)) == [("a",), ("z",)]
    assert tuples(labels.count_distinct_labels(df)) == [(4, 2)]
    assert sorted(tuples(labels.taxonomy_coverage(df, ["a", "b"]))) == [("a", 2), ("b", 0)]
    assert tuples(labels.missing_intents(df, ["a", "b"])) == [("b",)]
    assert tuples(labels.label_histogram(df, 2)) == [("a", 2, "█"), ("z", 1, "")]


def test_bars_are_whole(spark):
    df = spark.createDataFrame([(0,), (99,), (1_500_000,)], "n long")
    bars = [r.bar for r in df.select(labels.histogram_bar(F.col("n"), 100).alias("bar")).collect()]
    assert bars == ["", "", "█" * 15_000]


def test_mappings_of_any_size_and_tables(spark):
    mapping = {f"label {i}": f"intent {i % 300}" for i in range(10_001)}
    df = spark.range(20_000).select(F.concat(F.lit("label "), (F.col("id") % 10_500).cast("string")).alias("intent"), "id")
    table = spark.createDataFrame(list(mapping.items()), "from_label string, to_label string")
    wanted = sorted((i, mapping[f"label {i % 10_500}"]) for i in range(20_000) if i % 10_500 <= 10_000)
    for given in (mapping, table):
        out = labels.relabel(df, given, "s")
        assert sorted((r.id, r.intent) for r in out.collect()) == wanted
        renamed = labels.rename_labels(df, given)
        assert renamed.count() == 20_000 and renamed.where("intent is null").count() == 20_000 - len(wanted)
    relabelled = labels.relabel(df, table, "s")
    intents = [f"intent {i}" for i in range(301)]
    for given in (intents, spark.createDataFrame([(i,) for i in intents], "intent string")):
        found = {r.intent: r.rows for r in labels.taxonomy_coverage(relabelled, given).collect()}
        assert len(found) == 301 and found["intent 300"] == 0 and sum(found.values()) == len(wanted)
        assert tuples(labels.missing_intents(relabelled, given)) == [("intent 300",)]
    scoped = spark.createDataFrame([("t", 42, 1)], "text string, intent int, id long")
    support = df.withColumn("text", F.lit("t"))
    for given in (mapping, table):
        steps = {r.step: r.rows for r in training.relabel_funnel(support, scoped, given).collect()}
        assert (steps["support"], steps["support_kept"]) == (20_000, len(wanted))


def test_mapping_preview(spark):
    df = spark.createDataFrame([("check_invoice",), ("complaint",), ("complaint",)], "intent string")
    out = {r.intent: (r.labels, r.rows) for r in labels.mapping_preview(df, labels.SUPPORT_LABELS).collect()}
    assert len(out) == 13
    assert out["request_invoice"] == ("check_invoice + get_invoice", 1)
    assert out["file_claim"] == ("complaint", 2)
    assert out["get_rate_quote"] == ("NO MATCH - need synthetic data", 0)
    assert out["general_inquiry"] == ("NO MATCH - use out-of-scope rows", 0)


def test_no_labels_are_refused(spark):
    with pytest.raises(ValueError):
        labels.mapping_table(spark, {})
    with pytest.raises(ValueError):
        labels.taxonomy_table(spark, ())


# -- rows -------------------------------------------------------------------


def test_stack_fills_missing_columns(spark):
    a, b = spark.createDataFrame([(1, "x")], "i int, s string"), spark.createDataFrame([(2,)], "i int")
    assert tuples(rows.stack(a, b)) == [(1, "x"), (2, None)]


def test_keep_first_against_brute_force(spark):
    rng = random.Random(1)
    data = [
        ("hot" if rng.random() < 0.4 else rng.choice("abcdefgh"), rng.choice([None, 1, 2, 3]), rng.choice(["p", None, "q"]))
        for _ in range(2000)
    ]
    first = {}
    for text, order, other in data:
        key = ((order is not None, order or 0), (other is not None, other or ""))
        if text not in first or key < first[text][0]:
            first[text] = (key, (text, order, other))
    df = spark.createDataFrame(data, "text string, o int, other string").repartition(7)
    out = rows.keep_first(df, ["text"], ["o"])
    assert out.columns == ["text", "o", "other"]
    assert sorted(tuples(out), key=repr) == sorted((v for _, v in first.values()), key=repr)


def test_copies_collapse_before_the_shuffle(spark):
    df = spark.range(100_000).select(F.lit("same text").alias("text"), "id")
    df = rows.keep_first(df.repartition(8), ["text"], ["id"])
    assert tuples(df) == [("same text", 0)]
    assert "partial_min" in df._jdf.queryExecution().toString()


@pytest.mark.parametrize("key", [None, ["k"]])
def test_shuffle_depends_on_seed_and_rows_only(spark, key, monkeypatch):
    monkeypatch.setattr(rows, "_COPIES_PER_TASK", 30)
    data = [(i, "abc"[i % 3]) for i in range(500)] + [(1000 + i, "hot") for i in range(200)]
    df = spark.createDataFrame(data, "k int, s string")
    if not key:
        df = df.select("s")
    one = tuples(rows.seeded_shuffle(df.repartition(3), 42, key))
    two = tuples(rows.seeded_shuffle(df.repartition(11), 42, key))
    other = tuples(rows.seeded_shuffle(df, 7, key))
    assert one == two
    assert one != other
    assert sorted(one) == sorted(other) == sorted(tuples(df))
    assert one != sorted(one)
    # Copies of one row are spread over the whole table.
    places = [i for i, r in enumerate(one) if r[-1] == "hot"]
    assert len(places) == 200 and places[0] < 100 and places[-1] > 600


# -- the training table -----------------------------------------------------


def test_merge(spark):
    relabelled = spark.createDataFrame([("hi ", "a", "s1"), (None, "a", "s1"), (" ", "a", "s1"), ("x", None, "s1"), ("y", "a", None)], ROW)
    synthetic_rows = spark.createDataFrame([("hi", "b", "s2"), ("\xa0", "b", "s2"), ("\x1cz\n", "b", "s2")], ROW)
    merged = training.build_training_table(relabelled, synthetic_rows)
    assert merged.columns == ["text", "intent", "source"]
    assert sorted(tuples(merged), key=repr) == [("hi", "a", "s1"), ("y", "a", None), ("z", "b", "s2")]
    steps = {r.step: r.rows for r in training.training_funnel(relabelled, synthetic_rows).collect()}
    assert steps == {"relabelled": 5, "synthetic": 3, "combined": 8, "usable": 4, "duplicates": 1, "final": 3}


def test_merge_keeps_the_first_row_by_the_given_order(spark):
    keyed = ROW + ", k int"
    relabelled = spark.createDataFrame([("t", "late", "r", 5), ("t", "early", "r", 2)], keyed)
    synthetic_rows = spark.createDataFrame([("t", "synthetic", "s", 1)], keyed)
    merged = training.build_training_table(relabelled, synthetic_rows, order=["k"])
    assert tuples(merged) == [("t", "early", "r")]


def test_empty_merge(spark):
    empty = spark.createDataFrame([], ROW)
    assert tuples(training.build_training_table(empty, empty)) == []
    assert {r.rows for r in training.training_funnel(empty, empty).collect()} == {0}


@pytest.mark.parametrize("key", [(), ("k",)])
def test_relabelled_table(spark, key):
    support = spark.createDataFrame([(1, "a", "complaint"), (2, "a", "complaint"), (3, "b", "other")], "k int, text string, intent string")
    scoped = spark.createDataFrame([(1, "c", 42), (2, "d", 1)], "k int, text string, intent int")
    out = training.build_relabelled_table(support, scoped, key=key)
    assert out.columns == ["text", "intent", "source"]
    assert sorted(tuples(out)) == [("a", "file_claim", "support")] * 2 + [("c", "general_inquiry", "scope")]
    steps = {r.step: r.rows for r in training.relabel_funnel(support, scoped).collect()}
    assert steps == {"support": 3, "support_kept": 2, "scoped": 2, "scoped_kept": 1, "combined": 3}


def test_training_report(spark):
    df = spark.createDataFrame([("t", "get_eta", "s")] * 120, ROW)
    out = {r.intent: (r.rows, r.bar, r.missing) for r in training.training_report(df).collect()}
    assert len(out) == 13
    assert out["get_eta"] == (120, "██", False)
    assert out["file_claim"] == (0, "", True)


# -- profiles ---------------------------------------------------------------


def test_words(spark):
    texts = ["", "one", " two\xa0words\n", None, "a b c d"]
    df = spark.createDataFrame([(t,) for t in texts], "text string")
    assert [r.words for r in profile.with_word_count(df).collect()] == [0, 1, 2, None, 4]
    assert tuples(profile.word_stats(df)) == [(1.75, 0, 4)]


def test_samples_against_brute_force(spark):
    rng = random.Random(2)
    data = [("hot" if rng.random() < 0.4 else rng.choice(["a", "b", None]), rng.choice([None, *range(40)]), i) for i in range(1500)]
    data.append(("rare", 1, -1))
    df = spark.createDataFrame(data, "intent string, o int, id int").repartition(5)
    expected = []
    for label in ("hot", "a", "rare"):
        mine = sorted((o is not None, o or 0, i) for n, o, i in data if n == label)
        expected += [(label, o if known else None, i, pos) for pos, (known, o, i) in enumerate(mine[:3], 1)]
    out = profile.samples_per_label(df, ["o", "id"], ["hot", "a", "rare", "absent"])
    assert out.columns == ["intent", "o", "id", "position"]
    assert sorted(tuples(out), key=repr) == sorted(expected, key=repr)
    every = profile.samples_per_label(df, ["o", "id"], size=1)
    assert {r.intent for r in every.collect()} == {"hot", "a", "b", "rare"}
    assert "WindowGroupLimit" in out._jdf.queryExecution().toString()


def test_samples_for_any_order_column_and_ties(spark):
    data = [("a", 5, "x"), ("a", 5, "v"), ("a", 1, "w"), ("b", None, "u"), ("b", 2, "t"), ("b", 2, "t")]
    df = spark.createDataFrame(data, "_label string, position int, text string")
    out = profile.samples_per_label(df, ["position"], size=2, label_col="_label", out_col="rank")
    assert out.columns == ["_label", "position", "text", "rank"]
    expected = [("a", 1, "w", 1), ("a", 5, "v", 2), ("b", None, "u", 1), ("b", 2, "t", 2)]
    assert sorted(tuples(out), key=repr) == sorted(expected, key=repr)
    with pytest.raises(ValueError):
        profile.samples_per_label(df, ["position"], label_col="_label")


def test_no_text_is_shuffled_for_samples(spark, tmp_path):
    path = str(tmp_path / "t")
    rows = spark.range(50_000).select(F.lit("hot").alias("intent"), "id", F.repeat(F.lit("text "), 200).alias("text"))
    rows.write.parquet(path)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "20k")
    try:
        out = profile.samples_per_label(spark.read.parquet(path), ["id"])
        assert [(r.id, r.position) for r in out.orderBy("position").collect()] == [(0, 1), (1, 2), (2, 3)]
        plan = out._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan
    # Below the join only label and order are shuffled.
    below = plan.split("BroadcastHashJoin")[1]
    moved = [line for line in below.splitlines() if "Exchange hashpartitioning" in line]
    assert len(moved) == 1 and "ReadSchema: struct<intent:string,id:bigint>" in below


TEMPORARY = (
    "_words", "words", "position", "place", "_label", "_end", "key0", "key1", "_hash", "hash", "_first", "first", "_order0", "f0",
    "_copies", "copies", "_copy", "copy", "_chunk", "chunk", "_side", "side", "from_label", "to_label", "_features", "features",
)


def test_columns_of_any_name_are_kept(spark):
    """Every operator on a frame that has columns with the names it uses inside."""
    schema = "text string, intent string, source string, k long, " + ", ".join(f"`{c}` int" for c in TEMPORARY)
    data = [(f"text {i % 3}", "complaint", "s", i, *[100 * i + j for j in range(len(TEMPORARY))]) for i in range(6)]
    df = spark.createDataFrame(data, schema)
    kept = sorted(tuples(df.select("k", *TEMPORARY)))

    def check(out, wanted=kept):
        assert sorted(tuples(out.select("k", *TEMPORARY))) == wanted

    check(labels.relabel(df, labels.SUPPORT_LABELS, "s"))
    check(labels.rename_labels(df, labels.SUPPORT_LABELS))
    check(rows.keep_first(df, ["k"], ["_order0"]))
    check(rows.keep_first(df, ["text"], ["_order0"]), kept[:3])
    check(rows.seeded_shuffle(df))
    check(rows.seeded_shuffle(df, key=["k"]))
    check(profile.samples_per_label(df, ["k"], size=9, out_col="n"))
    by = profile.word_stats(df, by=["_words", "words"])
    assert by.count() == 6 and set(by.columns) == {"_words", "words", "avg_words", "min_words", "max_words"}
    merged = training.build_training_table(df, df.where("false"), order=["_order0", "side"])
    assert sorted(r.text for r in merged.collect()) == ["text 0", "text 1", "text 2"]
    steps = {r.step: r.rows for r in training.training_funnel(df, df).collect()}
    assert steps["combined"] == 12 and steps["final"] == 3


def test_plans_of_sorted_and_filtered_tables(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.createDataFrame([("t", 42, 1)], "text string, intent long, k long").write.parquet(path)
    scoped = spark.read.parquet(path)
    plan = labels.extract_out_of_scope(scoped, "s")._jdf.queryExecution().toString()
    assert "EqualTo(intent,42)" in plan
    once = rows.keep_first(scoped, ["text"], ["k"])._jdf.queryExecution().optimizedPlan().toString()
    struct = once.split("min(struct(")[1].split("))")[0]
    assert struct.count("k#") == 1 and struct.count("intent#") == 1


# -- synthetic rows ---------------------------------------------------------


def test_prompts(spark):
    spec = spark.createDataFrame(
        [("get_eta", "wants to know 100% when", "city, date", ["when?", "where?"])],
        "intent string, description string, entities string, examples array<string>",
    )
    [(intent, prompt)] = tuples(synthetic.prompts(spec, 20))
    assert intent == "get_eta"
    assert prompt.splitlines() == [
        "rows: 20", "intent: get_eta", "meaning: wants to know 100% when", "entities: city, date", "examples:", "- when?", "- where?",
    ]
    [(_, own)] = tuples(synthetic.prompts(spec, 5, "%s|%s|%s|%s|%s"))
    assert own == "5|get_eta|wants to know 100% when|city, date|- when?\n- where?"


def test_messages(spark):
    replies = spark.createDataFrame([("a", "short\n exactly 10\neleven char\n\n\xa0eleven char\r\n"), ("b", None)], "intent string, raw_text string")
    assert tuples(synthetic.messages(replies)) == [("eleven char", "a", "synthetic")] * 2


# -- sources ----------------------------------------------------------------

AWKWARD = ["a,b", 'say "hi"', "two\nlines", "cr\rhere", "crlf\r\nhere", "  outer ", "\t", "back\\slash", 'x\\"y', "é😤", "NA", "null", "-", "#c", "'", '"', "\n"]


def test_csv_round_trip(spark):
    path = shared_folder(spark, "csv")
    data = [(i, t) for i, t in enumerate(AWKWARD)] + [(100, None), (101, "")]
    df = spark.createDataFrame(data, "id int, text string")
    write_csv(df, path, rows_per_file=3)
    back = dict(tuples(read_csv(spark, path, df.schema)))
    assert back == {**dict(data), 101: None}
    missing = dict(tuples(read_csv(spark, path, df.schema, NA_VALUES)))
    assert missing == {**back, 10: None, 11: None}
    write_csv(df.limit(1), path)
    assert read_csv(spark, path, df.schema).count() == 1


def test_csv_of_single_lines_is_split(spark):
    path = shared_folder(spark, "csv-lines")
    df = spark.range(20_000).select("id", F.repeat(F.lit("word "), 20).alias("text"))
    write_csv(df.coalesce(1), path)
    spark.conf.set("spark.sql.files.maxPartitionBytes", "200k")
    try:
        split, whole = (read_csv(spark, path, df.schema, multi_line=m) for m in (False, True))
        assert split.rdd.getNumPartitions() > 3 and whole.rdd.getNumPartitions() > 3
        assert split.count() == whole.count() == 20_000
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


def test_readers(spark):
    root = shared_folder(spark, "corpus")
    raw = spark.createDataFrame([("hello, you", "greet", 1), ("bye", "part", 2)], "instruction string, intent string, extra int")
    write_table(raw, f"{root}/parquet")
    write_csv(raw, f"{root}/csv")
    raw.write.json(f"{root}/json")
    expected = [("bye", "part"), ("hello, you", "greet")]
    for kind in ("parquet", "csv", "json"):
        schema = None if kind == "parquet" else raw.schema
        df = read_labelled(spark, f"{root}/{kind}", "instruction", "intent", kind, schema)
        assert df.columns == ["text", "intent"] and sorted(tuples(df)) == expected
    splits = {"train": f"{root}/parquet", "test": f"{root}/parquet"}
    both = read_splits(spark, splits, text_col="instruction")
    assert both.columns == ["text", "intent"] and sorted(tuples(both)) == sorted(expected * 2)
    named = read_splits(spark, splits, keep_split=True, text_col="instruction")
    assert {r.split for r in named.collect()} == {"train", "test"}


def test_shared_folder_follows_the_session(spark):
    assert shared_folder(spark, "x").startswith(spark.conf.get("spark.checkpoint.dir"))


# -- records ----------------------------------------------------------------


def test_entities(spark):
    text = "a.b@c.com or x@y.co.uk, call 555-0123 or +1 (419) 555-0188; ABCX 123456, GATX204518, wb-2031-44870; 7310442; 2,000 lbs and 3.5 tons"
    df = spark.createDataFrame([(text,), (None,), ("",)], "clean_text string")
    found, *nothing = [r.entities.asDict() for r in records.extract_entities(df).collect()]
    assert found == {
        "emails": ["a.b@c.com", "x@y.co.uk"],
        "phones": ["555-0123", "+1 (419) 555-0188", "7310442"],
        "waybills": ["7310442"],
        "equipment_ids": ["ABCX 123456", "GATX204518"],
        "order_numbers": ["wb-2031-44870"],
        "weights": ["2,000 lbs", "3.5 tons"],
    }
    assert nothing == [dict.fromkeys(found, [])] * 2


def test_routing(spark):
    df = spark.createDataFrame([(1, 0.85), (2, 0.849), (3, None), (4, float("nan"))], "id int, confidence double")
    accepted, fallback = records.route_by_confidence(df)
    assert [r.id for r in accepted.collect()] == [1]
    assert [r.id for r in fallback.collect()] == [2, 3, 4]
    assert [r.route for r in records.with_route(df).collect()] == ["accepted", "fallback", "fallback", "fallback"]


def test_json_records(spark):
    df = spark.createDataFrame([(1, 'a "b"\n', None)], "id int, text string, missing string")
    assert tuples(records.to_records(df)) == [('{"id":1,"text":"a \\"b\\"\\n","missing":null}',)]


# -- intents ----------------------------------------------------------------


@pytest.mark.parametrize("train", [intent_baseline.train_naive_bayes, intent_baseline.train_intent_baseline])
def test_classifiers_compute_the_training_table_once(spark, train):
    read = spark.sparkContext.accumulator(0)

    def counted(batches):
        for batch in batches:
            read.add(batch.num_rows)
            yield batch

    rows = [(f"late car {i % 7}", "get_eta") for i in range(20)] + [("broken load", "report_damage")] * 10
    model = train(spark.createDataFrame(rows, "text string, intent string").mapInArrow(counted, "text string, intent string"))
    assert read.value == len(rows)
    if train is intent_baseline.train_naive_bayes:
        assert model.intents == (("get_eta", 20, 60), ("report_damage", 10, 20)) and model.vocabulary == 11
    else:
        # Intents without rows are classes too.
        assert model.stages[4].numClasses == len(labels.INTENTS)


def test_emails_are_built_in_many_tasks(spark, tmp_path):
    rows = [(k, 7, datetime.date(2024, 1, 2), "1-URGENT") for k in (1, 2, 2, None)]
    orders = spark.createDataFrame(rows, "o_orderkey long, o_custkey long, o_orderdate date, o_orderpriority string")
    orders.coalesce(1).write.parquet(str(tmp_path / "orders.parquet"))
    emails = spark_queries.raw_emails(spark, str(tmp_path))
    assert emails.rdd.getNumPartitions() >= spark.sparkContext.defaultParallelism
    found = emails.collect()
    assert Counter(r.msg_id for r in found) == Counter([1, 2, 2, None])
    assert all(f"Subject: Order {r.msg_id}\n" in r.raw_email for r in found if r.msg_id)


def test_classifiers_bear_missing_texts(spark):
    training_rows = spark.createDataFrame(
        [("late car", "get_eta"), ("late again", "get_eta"), ("broken load", "report_damage"), (None, "get_eta"), ("x", None), ("y", "unheard of")],
        "text string, intent string",
    )
    df = spark.createDataFrame(
        [(1, "when is the late car here", 0), (2, "broken broken", 0), (3, None, 0), (4, "zzz", 0), (5, "", 0)],
        "k int, text string, features int",
    )
    bayes = intent_baseline.train_naive_bayes(training_rows)
    found = {r.k: r for r in intent_baseline.predict_naive_bayes(bayes, df, "k").collect()}
    assert [found[i].predicted_intent for i in range(1, 6)] == ["get_eta", "report_damage", None, "get_eta", "get_eta"]
    assert found[3].confidence is None and found[4].confidence == pytest.approx(2 / 3, abs=1e-4)
    # ln(1/3) + 2 ln((1 + 1) / (2 + 5)): one of five words, twice.
    assert found[2].log_score == pytest.approx(-3.6041, abs=1e-3)
    none = intent_baseline.train_naive_bayes(training_rows.where("false"))
    assert {r.predicted_intent for r in intent_baseline.predict_naive_bayes(none, df, "k").collect()} == {None}
    model = intent_baseline.train_intent_baseline(training_rows, features=64, iterations=3)
    rows_out = intent_baseline.predict_intents(model, df)
    assert rows_out.columns == [*df.columns, "predicted_intent", "confidence"]
    scored = {r.k: r for r in rows_out.collect()}
    assert scored[3].predicted_intent is None and scored[3].confidence is None
    assert all(0 < scored[k].confidence <= 1 for k in (1, 2, 4, 5))
    assert {r.route for r in records.with_route(rows_out.where("k = 3")).collect()} == {"fallback"}


def judged_plainly(training, intents, texts):
    """Naive Bayes with plain dictionaries: (intent, score) of every text."""
    words = lambda text: [w for w in re.split(r"[^\w]+", text.lower()) if w]
    known = [(t, i) for t, i in training if i in intents]
    counts = {i: Counter(w for t, k in known if k == i for w in words(t)) for i in {i for _, i in known}}
    vocabulary = len(set().union(*counts.values()))
    found = []
    for text in texts:
        scores = {}
        for i, own in counts.items():
            score = math.log(sum(k == i for _, k in known) / len(known))
            for w in words(text):
                if any(w in c for c in counts.values()):
                    score += math.log((own[w] + 1) / (sum(own.values()) + vocabulary))
            scores[i] = round(score, 4)
        best = max(scores.values())
        found.append((min(i for i, s in scores.items() if s == best), best))
    return found


@pytest.mark.parametrize("common_words", [100_000, 5, 0])
def test_common_and_rare_words_give_the_same_scores(spark, common_words, monkeypatch):
    rnd = random.Random(3)
    vocabulary = [f"w{i}" for i in range(60)] + ["x" * 100]
    said = lambda n: " ".join(rnd.choice(vocabulary) for _ in range(n))
    training_rows = [(said(8), rnd.choice("abc")) for _ in range(40)] + [("hot hot", "a")]
    # One word that every text holds, and one that is in no lesson.
    texts = [f"hot never {said(rnd.randint(0, 12))}" for _ in range(200)] + ["", "never seen"]
    monkeypatch.setattr(intent_baseline, "COMMON_WORDS", 3)
    model = intent_baseline.train_naive_bayes(spark.createDataFrame(training_rows, "text string, intent string"), ["a", "b", "c"], common_words)
    assert model.rare is not None and len(model.common[0]) == min(common_words, model.vocabulary - 1)
    df = spark.createDataFrame([(1, t, "kept") for t in texts] + [(2, None, None)], "id int, text string, confidence string")
    found = intent_baseline.with_intents(model, df)
    assert found.columns == ["id", "text", "predicted_intent", "log_score", "confidence"]
    rows_out = found.collect()
    assert len(rows_out) == len(df.collect())
    by_text = {r.text: r for r in rows_out}
    assert by_text[None].predicted_intent is None and by_text[None].confidence is None
    for text, (intent, score) in zip(texts, judged_plainly(training_rows, "abc", texts)):
        assert by_text[text].log_score == pytest.approx(score, abs=2e-4)
        assert by_text[text].predicted_intent == intent


def test_interactions_are_cleaned_once(spark):
    training_rows = [("where is my order", "a"), ("please send an invoice", "b")]
    model = intent_baseline.train_naive_bayes(spark.createDataFrame(training_rows, "text string, intent string"), ["a", "b"])
    df = spark.createDataFrame([("1", "chat", "x")], "text_id string, channel string, raw_text string").repartition(2)
    plan = interactions.process_interactions(df, model, "text_id")._jdf.queryExecution().optimizedPlan().toString()
    # Two for the characters of texts, one for the words.
    assert plan.count("ArrowEvalPython") == 3
    assert "Join" not in plan and "Aggregate" not in plan


def test_interactions_with_repeated_ids(spark):
    training_rows = [("where is my order", "a"), ("please send an invoice", "b")]
    model = intent_baseline.train_naive_bayes(spark.createDataFrame(training_rows, "text string, intent string"), ["a", "b"])
    texts = [("1", "chat", "Customer: where is it"), ("1", "chat", "Customer: send an invoice"), ("2", "chat", "Customer: order"), ("2", "chat", "Customer: order")]
    df = spark.createDataFrame(texts, "text_id string, channel string, raw_text string")
    found = [json.loads(r.record) for r in interactions.process_interactions(df, model, "text_id").collect()]
    assert sorted((r["id"], r["clean_text"], r["intent"]) for r in found) == [
        ("1", "send an invoice", "b"), ("1", "where is it", "a"), ("2", "order", "a"), ("2", "order", "a"),
    ]


def test_shuffled_positions_follow_the_shuffle(spark):
    df = spark.createDataFrame([(i % 40, i // 40, "x") for i in range(500)], "a int, b int, position string")
    shuffled = [(r.a, r.b) for r in rows.seeded_shuffle(df, 5, ["a", "b"]).collect()]
    placed = rows.shuffled_positions(df.repartition(7), ["a", "b"], 5).collect()
    assert [(r.a, r.b) for r in sorted(placed, key=lambda r: r.position)] == shuffled
    assert sorted(r.position for r in placed) == list(range(500))
    old = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "23")
    assert [(r.a, r.b) for r in rows.seeded_shuffle(df, 5, ["a", "b"]).collect()] == shuffled
    spark.conf.set("spark.sql.shuffle.partitions", old)
    assert shuffled != [(r.a, r.b) for r in rows.seeded_shuffle(df, 6, ["a", "b"]).collect()]
    assert rows.shuffled_positions(df.limit(0), ["a"]).collect() == []


def test_interactions_without_an_id_keep_their_records(spark):
    training_rows = [("where is my order", "a"), ("track the order", "a"), ("please send an invoice", "b")]
    model = intent_baseline.train_naive_bayes(spark.createDataFrame(training_rows, "text string, intent string"), ["a", "b"])
    texts = [("1", "chat", "Customer: where is my order"), (None, "chat", "Customer: where is my order"), (None, "chat", "Customer: where is my order"),
             (None, "chat", "Customer: send an invoice"), (None, "fax", "unknown channel"), (None, "chat", None), ("2", "fax", "x")]
    df = spark.createDataFrame(texts, "text_id string, channel string, raw_text string")
    found = [json.loads(r.record) for r in interactions.process_interactions(df, model, "text_id").collect()]
    assert len(found) == len(texts)
    orders = [{**r, "id": None} for r in found if "order" in (r.get("clean_text") or "")]
    assert len(orders) == 3 and orders[0] == orders[1] == orders[2] and orders[0]["intent"] == "a"
    assert [r["intent"] for r in found if "invoice" in (r.get("clean_text") or "")] == ["b"]
    assert all(r["route"] in ("accepted", "fallback") for r in found)
