"""Label-free fits: reliabilities of labelers at any corpus size, and thresholds that follow their population."""

import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from shoptally.llm import personal_data, quality


@pytest.mark.parametrize("size", [1, 10, 1000, 100_000])
def test_unanimous_votes_are_believed_at_every_size(size):
    # Exact spans of three vote patterns, and candidates that all labelers vote for.
    votes = np.array([[1, 0, 1, 1], [1, 0, 0, 1], [1, 1, -1, 1], [1, 1, 1, 1], [0, 0, -1, -1]])
    counts = np.array([80.0, 60.0, 20.0, 25.0, 10.0]) * size
    _, truth = personal_data.reliabilities(votes, counts, np.array([True, True, True, False, False]))
    assert truth[3] > 0.9 and truth[4] < 0.5


def test_a_bad_labeler_is_weighed_down():
    pick = np.random.default_rng(1)
    truth = pick.random(4000) < 0.5
    right = pick.random((4000, 4)) < np.array([0.9, 0.85, 0.9, 0.1])  # the last one is mostly wrong
    cast = np.where(truth[:, None] == right, 1, -1)
    votes, counts = np.unique(cast, axis=0, return_counts=True)
    table, posterior = personal_data.reliabilities(votes, counts.astype(float))
    by_row = {tuple(v): p for v, p in zip(votes, posterior, strict=True)}
    found = np.array([by_row[tuple(v)] for v in cast]) > 0.5
    majority = cast.sum(axis=1) > 0
    assert (found == truth).mean() > 0.93 > (majority == truth).mean()
    assert by_row[1, 1, 1, -1] > 0.9 and by_row[-1, -1, -1, 1] < 0.1


def test_a_span_without_support_is_rejected(spark):
    good = [(i, f"token = abcDEF{i:06d}xyz, mail a{i}@b.org") for i in range(60)]
    bad = [(100 + i, f"version {i} page 777-7777") for i in range(60)]
    spans = {r.doc_id: r.spans for r in personal_data.personal_data(spark.createDataFrame(good + bad, "doc_id int, text string")).collect()}
    assert all(re.fullmatch(r"email:.*,secret:.*", spans[i]) for i, _ in good) and not any(spans[i] for i, _ in bad)


@pytest.mark.parametrize("size", ["sf0.01", "sf0.1"])
def test_planted_secrets_are_found(spark, size):
    docs = spark.read.parquet(f"/root/testdata/{size}/documents.parquet").select("doc_id", "text")
    planted = docs.filter(F.col("text").rlike("(?i)\\b(token|secret|password|api_key)\\b *[=:] *[\"']?[A-Za-z0-9_/+-]{12,}"))
    found = personal_data.personal_data(planted.unionByName(docs.filter("doc_id % 3 = 0"))).filter(F.contains("spans", F.lit("secret")))
    want = {r.doc_id for r in planted.collect()}
    assert len(want) > 5 and len(want & {r.doc_id for r in found.collect()}) >= 0.9 * len(want)


def test_card_phone_and_digest_are_the_patterns(spark):
    text = "4111 1111-1111 1111 and 1234567890123 +49 (30) 901820-12 +1 23 4" + "5" * 12 + " 10.0.0.256 10.0.0.255"
    row = personal_data.personal_data(spark.createDataFrame([(1, text)], "doc_id int, text string")).first()
    want = []
    for kind, pattern in (("ip", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"), ("card", r"[0-9]([\x20-]?[0-9])+"), ("phone", r"\+[0-9][\x20().0-9-]+[0-9]")):
        for m in re.finditer(pattern, text):
            digits = [int(c) for c in m[0] if c.isdigit()]
            luhn = sum(d if i % 2 == 0 else sum(divmod(2 * d, 10)) for i, d in enumerate(reversed(digits))) % 10 == 0
            good = {"ip": all(int(x) <= 255 for x in m[0].split(".")) if kind == "ip" else False, "card": 13 <= len(digits) <= 19 and luhn, "phone": 9 <= len(digits) <= 15}[kind]
            if good:
                want.append(f"{kind}:{m.start()}:{m.end()}")
    import hashlib

    assert row.base_sha256 == hashlib.sha256(",".join(want).encode()).hexdigest() and len(want) >= 3


def test_long_texts_and_clashing_columns(spark):
    long_text = "a" * 200_000 + " " + "x@" * 50_000 + " 1.1.1.1"
    docs = spark.createDataFrame([(1, long_text, "r", 3), (2, None, "r", 4), (3, "", None, 5), (3, "", None, 5)], "doc_id int, text string, row string, spans int")
    out = personal_data.redacted(docs)
    assert out.columns == docs.columns and sorted((r.doc_id, r.row or "", r.spans) for r in out.collect()) == [(1, "r", 3), (2, "r", 4), (3, "", 5), (3, "", 5)]
    assert out.filter("doc_id = 1").first().text.endswith(" <IP>")


def _docs(spark, symbols, source="s"):
    rows = [(i, " ".join(["word"[: 3 + i % 2] + "abcdefghij"[(i * k) % 10] for k in range(40 + i % 20)]) + " #" * (symbols if i % 50 == 7 else 0), "en", source) for i in range(400)]
    return spark.createDataFrame(rows, "doc_id int, text string, lang string, source string")


def test_thresholds_follow_their_population(spark):
    # One more document with eight symbols: an outlier among clean texts, not among texts that hold many.
    probe = " ".join(f"w{i}" for i in range(45)) + " # # # # # # # #"
    extra = spark.createDataFrame([(9999, probe, "en", "clean"), (9998, probe, "en", "rich")], "doc_id int, text string, lang string, source string")
    rich = _docs(spark, 0, "rich").withColumn("text", F.concat("text", F.expr("repeat(' #', cast(doc_id % 12 as int))")))
    verdict = {r.doc_id: r.kept for r in quality.judge(_docs(spark, 0, "clean").unionByName(rich).unionByName(extra)).filter("doc_id > 9000").collect()}
    assert verdict == {9999: False, 9998: True}


def test_known_junk_goes_and_good_documents_stay(spark):
    sf = "/root/testdata/sf0.1"
    judged = quality.judge(spark.read.parquet(f"{sf}/documents.parquet")).filter("not base_failed").join(spark.read.parquet(f"{sf}/labels.parquet"), "doc_id")
    kept = {r.quality: r.share for r in judged.groupBy("quality").agg(F.avg(F.col("kept").cast("int")).alias("share")).collect()}
    assert kept[1] > 0.99 and kept[0] < 0.2


def test_columns_named_like_those_inside(spark):
    docs = _docs(spark, 0).withColumns({"_lang": F.lit(1), "_source": F.lit(2), "_words": F.lit(3), "_limit": F.lit(4), "fence": F.lit(5)})
    assert quality.judge(docs).count() == 400 and quality.keep_good(docs).columns == docs.columns
