"""Repeated rows, ties, empty tables, very long texts and clashing column names of operators whose other cases are tested elsewhere."""

import pytest
from pyspark.sql import functions as F

from salestax_spark.llm import chat, language, mixing, secrets, warc


def test_secret_scan_cases(spark, docs):
    df = docs("password=abcdefabcdef", "password=abcdefabcdef", None, "x" * 2_000_000 + " AKIA" + "Q" * 16)
    clash = df.withColumn("secret_spans", F.lit("mine")).withColumn("Kind", F.lit("kept"))
    rows = sorted(secrets.scan_secrets(clash).collect(), key=lambda r: r.doc_id)
    assert [[(s.kind, s.start, s.end) for s in r.secret_spans] for r in rows] == [
        [("assign", 0, 21)], [("assign", 0, 21)], [], [("access", 2_000_001, 2_000_021)],
    ]
    assert {r.Kind for r in rows} == {"kept"}
    assert secrets.scan_secrets(df.limit(0)).count() == 0


def test_revisit_ties_and_repeats(spark):
    url = "http://a.example/x"
    rows = [
        (1, url, 10, "response", '"1"', "p1", {}),
        (2, url, 10, "response", '"2"', "p2", {}),  # the same time: the highest record id counts
        (2, url, 10, "response", '"2"', "p2", {}),
        (3, url, 20, "revisit", '"2"', None, {"Date": "d"}),
        (3, url, 20, "revisit", '"2"', None, {"Date": "d"}),
        (4, url, 10, "revisit", '"2"', None, {}),
        (5, url, 30, "request", '"2"', None, {}),
        (6, "http://a.example/" + "y" * 100_000, 30, "revisit", None, None, {}),
    ]
    schema = "record_id long, url string, captured_at long, record_type string, etag string, payload_digest string, headers map<string,string>"
    df = spark.createDataFrame(rows, schema).withColumn("last_modified", F.lit(None).cast("string"))
    df = df.withColumns({c: F.lit("clash") for c in ("outcome", "_slice", "_own", "Canonical_URL")})
    got = sorted((r.record_id, r.outcome, r.response_id, r.payload_digest) for r in warc.resolve_revisits(df).collect())
    assert got == [(3, "resolved", 2, "p2"), (3, "resolved", 2, "p2"), (4, "no_response", None, None), (6, "no_response", None, None)]


def test_chat_repeats_clashes_and_long_conversations(spark):
    rows = [(1, 0, "user", "a"), (1, 0, "user", "a"), (1, 0, "assistant", "b"), (1, 0, "user", None)]
    rows += [(2, i, "assistant" if i % 3 else "user", f"é{i} </turn>" + "x" * (i % 700)) for i in range(3000)]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    df = df.withColumns({c: F.lit("clash") for c in ("formatted", "loss_spans", "turns", "_pieces", "_blocks")}).repartition(4)
    out = chat.format_conversations(df).withColumn("read", chat.read_turns(F.col("formatted")))
    got = {r.conv_id: r for r in out.withColumn("loss", chat.read_loss_text(F.col("formatted"), F.col("loss_spans"))).collect()}
    assert [tuple(t) for t in got[1].read] == [("assistant", "b"), ("user", ""), ("user", "a"), ("user", "a")]
    assert [tuple(t) for t in got[2].read] == [(role, text) for _, _, role, text in rows[4:]]
    assert got[2].loss == "".join(text for _, _, role, text in rows[4:] if role == "assistant")
    assert all(got[2].formatted[s.start : s.end] for s in got[2].loss_spans)


def test_language_of_equal_sizes_and_of_long_texts(spark, docs):
    same = {"b": b"the cat sat on the mat ", "a": b"the cat sat on the mat "}
    df = docs("the cat", "the cat sat " * 100_000, "é" * 300_000)
    rows = {r.doc_id: r for r in language.identify_languages(df, same).collect()}
    # Equal sizes: the first name, with no lead.
    assert all((r.lang_pred, r.score, r.lang_rejected) == ("a", 0.0, True) for r in rows.values())


@pytest.mark.parametrize("words", [300_000])
def test_mix_of_a_very_long_text(spark, docs, words):
    df = docs("w " * words, *["v " * 10 for _ in range(30)])
    got = {r.doc_id: r for r in mixing.mix_report(df).collect()}
    # One source: its target is one and a half times its words, and the long text is taken whole or not.
    assert got[0].size == words and got[0].taken in (0, words, 2 * words)
    assert sum(r.taken for r in got.values()) <= 2 * (words + 300)
