"""Every stage of the pipeline against brute force, on nulls, empty and very long texts, ties, repeated rows and clashing columns."""

import random
import re

import corpus_pipeline
import pytest
from pyspark.sql import functions as F

WORDS = {"en": "the and thing with house other water under".split(), "fr": "le eau qui dans été même pour fenêtre".split()}


@pytest.fixture(scope="module")
def corpus(spark):
    rnd = random.Random(11)
    body = lambda lang, n: " ".join(rnd.choice(WORDS[lang]) + rnd.choice(("", "s", "en", "or")) for _ in range(n))
    rows = [(i, ("en", "fr")[i % 2], body(("en", "fr")[i % 2], 60), f"host{i % 3}") for i in range(120)]
    rows = [(i, lang, f"Menu | home\n{text}\nfooter of host0" if source == "host0" else text, source) for i, lang, text, source in rows]
    base = rows[7][2]
    rows += [(200, "en", None, "host1"), (201, "en", "", "host1"), (202, "en", "12 34 !!", None), (203, None, "zqxj kvwy " * 60, "host2"), (204, "fr", base, "host1"), (205, "fr", base + " eau", "host2"), (7, "fr", base, "host1")]
    rows += [(206, "en", body("en", 50) + " password=abcdefgh12 " + "0a" * 20, "host1"), (207, "en", body("en", 20_000), "host2"), (None, "en", body("en", 40), "host1")]
    return spark.createDataFrame([(i, t, lang, s, len(t or ""), 1, b"x", "y") for i, lang, t, s in rows], "doc_id bigint, text string, lang string, source string, n_chars bigint, _n_lines int, digest binary, found string")


def run(spark, name, docs):
    return dict(corpus_pipeline.STAGES)[name](spark, docs, "")


def test_stage_names_and_columns(spark, corpus):
    assert [n for n, _ in corpus_pipeline.STAGES] == ["language_id", "line_dedup", "near_dedup", "secret_scans", "best_fit_packing"]
    for name, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, corpus, "").columns == corpus.columns, name
        assert stage(spark, corpus.limit(0), "").collect() == [], name
    assert run(spark, "best_fit_packing", corpus.limit(0)).collect() == []


def test_language_stage_rejects_junk_only(spark, corpus):
    kept = {r["doc_id"]: r["lang"] for r in run(spark, "language_id", corpus).collect()}
    assert not {200, 201, 202, 203} & set(kept) and set(range(120)) | {204, 205, 207, None} <= set(kept)
    assert all(kept[i] == ("en", "fr")[i % 2] for i in range(120))


def test_line_stage(spark, corpus):
    out = run(spark, "line_dedup", corpus).collect()
    before = corpus.collect()
    assert len(out) == len(before) and {r["_n_lines"] for r in out} == {1}
    texts = sorted((str(r["doc_id"]), str(r["text"])) for r in out)
    assert texts == sorted((str(r["doc_id"]), str(r["text"] and r["text"].replace("Menu | home\n", "").replace("\nfooter of host0", ""))) for r in before)
    assert all(r["n_chars"] == len(r["text"] or "") for r in out)


def test_near_stage_keeps_one_of_a_group(spark, corpus):
    kept = [r["doc_id"] for r in run(spark, "near_dedup", corpus).collect()]
    before = corpus.collect()
    sets = {}
    for r in before:
        w = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), r["text"] or ""))
        sets[r["doc_id"]] = {tuple(w[k : k + 5]) for k in range(max(len(w) - 4, min(len(w), 1)))}
    linked = lambda a, b: sets[a] and 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b])
    ids = sorted(i for i in sets if i is not None)
    least = {i: i for i in ids}
    for _ in ids:  # until nothing changes
        new = {i: min(least[j] for j in ids if i == j or linked(i, j)) for i in ids}
        if new == least:
            break
        least = new
    assert sorted(i for i in kept if i is not None) == sorted(i for i in [r["doc_id"] for r in before] if i is not None and least[i] == i)
    assert None in kept


def test_secret_stage(spark, corpus):
    out = {(r["doc_id"], r["source"]): r for r in run(spark, "secret_scans", corpus).collect()}
    before = {(r["doc_id"], r["source"]): r for r in corpus.collect()}
    assert out.keys() == before.keys()
    changed = [k for k in out if out[k]["text"] != before[k]["text"]]
    assert changed == [(206, "host1")] and "abcdefgh12" not in out[206, "host1"]["text"] and out[206, "host1"]["n_chars"] == len(out[206, "host1"]["text"])
    assert out[200, "host1"]["text"] is None and out[206, "host1"]["found"] == "y"


def test_packing_stage_places_every_token(spark, corpus):
    out = run(spark, "best_fit_packing", corpus).collect()
    assert {r["doc_id"] for r in out} == {r["doc_id"] for r in corpus.collect()}
    bins = {}
    for r in out:
        bins.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for parts in bins.values():
        at = 0
        for offset, n in sorted(parts):
            assert offset == at
            at += n
        assert at <= 4096
    assert len(bins) <= -(-sum(r["length"] for r in out) // 4096) + 1


def test_whole_run(spark, corpus, tmp_path):
    corpus.write.parquet(f"{tmp_path}/documents.parquet")
    out = corpus_pipeline.run(spark, str(tmp_path))
    assert out.columns == ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"]
    ids = {r["doc_id"] for r in out.select("doc_id").distinct().collect()}
    assert not {200, 201, 202, 203, 204, 205} & ids and set(range(120)) <= ids
    assert out.where(F.col("length") > 4096).isEmpty()
