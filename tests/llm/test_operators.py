"""Every operator on small hard tables against brute force; every one on an empty table."""

import hashlib
import re
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from drillspark.llm import exact_dedup, language, lines, near_dedup, packing, pieces, quality, secrets, substring, toxicity
from drillspark.llm.components import components
from pyspark.sql import functions as F

WORD = re.compile(r"[^\x20\x09-\x0D]+")
BPE, PIECE = public_tokenizers.path("word_bpe_49k.json"), public_tokenizers.path("piece_bpe_32k.model")


def rows(docs):
    return [(r["doc_id"], r["text"]) for r in docs.select("doc_id", "text").collect()]


def same(df, expected):
    assert sorted(map(repr, map(tuple, df.collect()))) == sorted(map(repr, expected))


def test_line_dedup(docs):
    out = {r["doc_id"]: r for r in lines.line_dedup(docs, lines.Boilerplate(0.5, 5)).where("doc_id >= 20").collect()}
    before = dict(rows(docs))
    assert len(out) == 12
    for i, r in out.items():
        assert r["text"] == before[i].split("\n")[1] and (r["_n_lines"], r["_n_dropped"]) == (3, 2) and r["key"] == 5


def test_line_dedup_by_url_host(spark):
    rows = [(i, f"Top\nbody {i}", f"https://u:p@Site.example:80/{i}?q=1", 7) for i in range(6)] + [(9, "Top\nother", "http://else.example", 7), (10, None, "no url", 7), (11, "Top", None, 7)]
    out = lines.line_dedup(spark.createDataFrame(rows, "doc_id bigint, text string, url string, _n_lines int"), lines.Boilerplate(0.5, 5), lines.url_host(F.col("url"))).collect()
    assert {r["doc_id"]: r["text"] for r in out} == {**{i: f"body {i}" for i in range(6)}, 9: "Top\nother", 10: None, 11: "Top"}
    assert {r["doc_id"]: r["_n_lines"] for r in out}[3] == 2


def test_line_dedup_beyond_broadcast(docs, monkeypatch):
    monkeypatch.setattr(lines, "BROADCAST_BYTES", -1)
    out = lines.line_dedup(docs, lines.Boilerplate(0.5, 5)).where("doc_id >= 20").collect()
    assert len(out) == 12 and all(r["_n_dropped"] == 2 for r in out)


def test_quality(docs):
    expected = []
    for i, t in rows(docs):
        t = t or ""
        w = WORD.findall(t)
        windows = Counter(zip(w, w[1:], w[2:]))
        inside = {p for k in range(len(w) - 2) if windows[tuple(w[k : k + 3])] > 1 for p in (k, k + 1, k + 2)}
        full = [x for x in t.split("\n") if WORD.search(x)]
        expected.append((i, len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", t)), len(full) - len(set(full)), len(inside), len(w) < 50 or 100 * len(inside) > 50 * len(w)))
    out = quality.quality(docs)
    same(out.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed"), expected)
    assert out.where("base_failed and kept").isEmpty()


def brute_secrets(t):
    kinds = (("assign", r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 8), ("access", r"AKIA[A-Z0-9]+", 0, 16), ("hex", r"[0-9a-f]+", 0, 32))
    found = [(m.start(), k, m.end(), name) for k, (name, p, g, n) in enumerate(kinds) for m in re.finditer(p, t) if len(m[g]) >= n]
    return sorted(found)


def test_secrets(docs, spark):
    odd = spark.createDataFrame([(100, "token='\"x' api_KEY:abcdefgh"), (101, "é password : ñ secret=12345678é"), (102, "AKIA1 AKIA" + "Z" * 30 + "aAKIAX"), (103, "f" * 31 + " " + "f" * 33)], "doc_id bigint, text string")
    every = docs.select("doc_id", "text").union(odd)
    expected = []
    for i, t in rows(every):
        s = brute_secrets(t or "")
        c = Counter(x[3] for x in s)
        expected.append((i, c["assign"], c["access"], c["hex"], hashlib.sha256(",".join(f"{k}:{a}:{b}" for a, _, b, k in s).encode()).hexdigest()))
    same(secrets.secret_report(every).select("doc_id", "n_assign", "n_access", "n_hex", "base_sha256"), expected)


def test_secret_ledger_is_incremental(spark, tmp_path):
    ledger = secrets.SecretLedger(spark, f"file://{tmp_path}/ledger", buckets=2)
    first = spark.createDataFrame([(1, "token=abcdefgh"), (2, "x")], "doc_id bigint, text string")
    ledger.ingest(first).count()
    assert ledger.table().count() == 2
    again = secrets.SecretLedger(spark, f"file://{tmp_path}/ledger", buckets=2).ingest(first.union(spark.createDataFrame([(3, "token=abcdefgh"), (4, "new")], "doc_id bigint, text string")))
    assert {r["doc_id"]: len(r["found"]) for r in again.collect()} == {1: 1, 2: 0, 3: 1, 4: 0} and ledger.table().count() == 3


def test_secret_history(spark, tmp_path):
    make = lambda rows: spark.createDataFrame(rows, "doc_id bigint, text string")
    ledger = secrets.SecretLedger(spark, f"file://{tmp_path}/history", buckets=2)
    ledger.ingest(make([(1, "token=abcdefgh"), (2, "x"), (2, "x"), (None, None)])).count()
    ledger.ingest(make([(1, "clean now"), (3, "token=abcdefgh")])).count()
    assert sorted((str(r["doc_id"]), r["batch"], len(r["found"])) for r in ledger.history().collect()) == [("1", 1, 1), ("1", 2, 0), ("2", 1, 0), ("3", 2, 1), ("None", 1, 0)]
    assert ledger.table().count() == 4


def test_repeated_rows_are_scanned_once(spark, tmp_path, monkeypatch):
    ledger = secrets.SecretLedger(spark, f"file://{tmp_path}/repeated", buckets=2)
    docs = spark.createDataFrame([(1, "token=abcdefgh")] * 50 + [(i, f"text {i}") for i in range(300)], "doc_id bigint, text string")
    scanned, scan = [], secrets.scan
    monkeypatch.setattr(secrets, "scan", lambda texts, rules: scanned.append(texts.count()) or scan(texts, rules))
    assert ledger.ingest(docs).count() == 350 and scanned == [301]


def test_redact(docs):
    out = {r["doc_id"]: r for r in secrets.redact(docs).collect()}
    assert "AKIA" not in out[12]["text"] and "abcdefgh12" not in out[12]["text"] and out[12]["n_chars"] == len(out[12]["text"])
    assert out[1]["text"] is None and out[6]["text"] == dict(rows(docs))[6]


def test_sentencepiece(docs):
    import sentencepiece

    sp = sentencepiece.SentencePieceProcessor(model_file=PIECE)
    texts = [t or "" for _, t in rows(docs)] + ["  Hello  world\n\n éç 😀\t12", " ", "▁ x▁y", "a\x00b", "日本語 中文", "﷐ a﷑"]
    codec = pieces.Codec(pieces.Pieces(PIECE))
    texts += ["".join(map(chr, range(0xFDD0, 0xFDF0))), "x" * 300 + " " + "aB3/" * 100, "日本" * 80]
    ids, offsets = codec.encode(pa.array(texts), merging=True)
    assert [ids[a:b].tolist() for a, b in zip(offsets, offsets[1:])] == sp.encode(texts)
    assert codec.decode(ids, offsets) == sp.decode(sp.encode(texts)) == codec.decode(*codec.encode(pa.array(texts)))
    back = {r["doc_id"]: r["text"] for r in pieces.decode(pieces.encode(docs, PIECE), PIECE).collect()}
    assert back[12] == dict(rows(docs))[12] and back[1] == ""
    assert pieces.round_trip(docs, PIECE).where("not round_trip").isEmpty()


def test_viterbi():
    """The best segmentation of a small unigram model, against all segmentations."""
    vocab = [("<unk>", 0.0, 2), *[(p, s, 1) for p, s in (("▁", -2.0), ("a", -3.0), ("b", -3.1), ("ab", -4.0), ("▁a", -3.5), ("ba", -4.2), ("aba", -6.9), ("bab", -5.0))]]
    p = pieces.Pieces.of(vocab, bpe=False)
    score = {t: s for t, s, k in vocab if k == 1}

    def best(w):
        top = [0.0] + [-1e9] * len(w)
        for e in range(1, len(w) + 1):
            for s in range(e):
                if w[s:e] in score:
                    top[e] = max(top[e], top[s] + score[w[s:e]])
        return top[-1]

    words = ["abab baba", "a", "babab", "aabb abba", "ab" * 60 + "ba" * 40 + "bbb"]
    ids, offsets = pieces.Codec(p).encode(pa.array(words))
    for w, a, b in zip(words, offsets, offsets[1:]):
        got = [p.text[i] for i in ids[a:b]]
        shown = "▁" + w.replace(" ", "▁")
        assert "".join(got) == shown and sum(score[g] for g in got) == pytest.approx(sum(best("▁" + x) for x in w.split(" ")))


@pytest.mark.parametrize("group", [50_000, 3])
def test_packing(docs, group):
    import tokenizers

    tk = tokenizers.Tokenizer.from_file(BPE)
    out = packing.pack(docs.repartition(4), packing.Packing(BPE, group=group)).collect()
    expected = []
    for i, t in rows(docs):
        ids = np.array(tk.encode(t or "", add_special_tokens=False).ids + [1], "<u4")
        expected += [(i, k // 4096, k, len(ids[k : k + 4096]), zlib.crc32(ids[k : k + 4096].tobytes())) for k in range(0, len(ids), 4096)]
    assert sorted(map(repr, (tuple(r)[:5] for r in out))) == sorted(map(repr, expected))
    bins = {}
    for r in out:
        bins.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for b in bins.values():
        at = 0
        for o, n in sorted(b):
            assert o == at
            at += n
        assert at <= 4096
    assert group < 100 or len(bins) <= -(-sum(r["length"] for r in out) // 4096) + 1


def test_substring(docs):
    texts = [(i, WORD.findall(t or "")) for i, t in rows(docs)]
    seen = Counter(tuple(w[k : k + 35]) for _, w in texts for k in range(len(w) - 34))
    expected = []
    for i, w in texts:
        gone = [False] * len(w)
        for k in range(len(w) - 34):
            if seen[tuple(w[k : k + 35])] > 1:
                gone[k : k + 35] = [True] * 35
        expected.append((i, len(w), sum(gone), hashlib.sha256(" ".join(x for x, g in zip(w, gone) if not g).encode()).hexdigest()))
    same(substring.substring_dedup(docs), expected)


def test_near_dedup(docs):
    texts = {}
    for i, t in rows(docs):
        w = WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
        texts[i] = {tuple(w[k : k + 5]) for k in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} if w else set()
    least = {i: i for i in texts}

    def find(i):
        while least[i] != i:
            i = least[i]
        return i

    ids = [i for i in texts if i is not None]
    for i in ids:
        for j in ids:
            both = len(texts[i] & texts[j])
            if i < j and both and 100 * both >= 75 * len(texts[i] | texts[j]):
                a, b = find(i), find(j)
                least[max(a, b)] = min(a, b)
    out = near_dedup.near_dedup(docs.where("doc_id is not null"))
    same(out, [(i, len(texts[i]), find(i), find(i) == i) for i, _ in rows(docs) if i is not None])


def test_components(spark):
    edges = [(i, i + 1) for i in range(30, 42)] + [(9, k) for k in range(10, 20)] + [(5, 5), (70, 60), (60, 50)]
    out = {r["node"]: r["component"] for r in components(spark.createDataFrame(edges, "u bigint, v bigint")).collect()}
    assert out == {**{i: 30 for i in range(30, 43)}, **{i: 9 for i in range(9, 20)}, 70: 50, 60: 50, 50: 50}


def test_exact_dedup(docs):
    texts = [(i, t or "") for i, t in rows(docs)]
    n = Counter(t for _, t in texts)
    last = {t: max(i for i, x in texts if x == t and i is not None) for t in n if any(x == t and i is not None for i, x in texts)}
    same(exact_dedup.exact_dedup(docs), [(i, last.get(t), n[t], i == last.get(t), hashlib.sha256(t.encode()).hexdigest()) for i, t in texts])


def test_digest_index_is_persistent(spark, tmp_path):
    path = f"file://{tmp_path}/index"
    make = lambda rows: spark.createDataFrame(rows, "doc_id bigint, text string")
    exact_dedup.DigestIndex(spark, path, 2).ingest(make([(1, "a"), (2, "a"), (3, "b")])).count()
    later = {r["doc_id"]: (r["keep_id"], r["kept"]) for r in exact_dedup.DigestIndex(spark, path, 2).ingest(make([(9, "a"), (10, "c")])).collect()}
    assert later == {9: (2, False), 10: (10, True)}


def test_language(spark, docs):
    letters = {"en": ["the", "and", "thing", "with", "house"], "fr": ["le", "eau", "qui", "dans", "été"]}
    import random

    rnd = random.Random(1)
    known = [(i, " ".join(rnd.choice(letters[x]) for _ in range(60)), x) for i, x in enumerate(["en", "fr"] * 400)]
    train = spark.createDataFrame(known, "doc_id bigint, text string, lang string")
    model = language.learn(train)
    out = language.identify(train, model).join(train, "doc_id")
    assert out.where("held_out and lang_pred <> lang").isEmpty() and out.where("held_out").count() > 60
    odd = {r["doc_id"]: r for r in language.identify(docs, model).collect()}
    assert odd[1]["lang_pred"] == odd[2]["lang_pred"] == "und" and odd[1]["rejected"] and odd[1]["score"] == 0
    junk = spark.createDataFrame([(1, "zqxj kvwy " * 50)], "doc_id bigint, text string")
    assert language.identify(junk, model).first()["rejected"]
    assert language.known_language(docs.union(train.selectExpr("doc_id + 1000", "text", "lang", "null", "0l", "1", "null", "1"))).where("doc_id >= 1000").count() == 800


def test_toxicity(spark, docs):
    import random

    rnd = random.Random(2)
    plain = [f"w{rnd.choice('abcdef')}{rnd.randrange(40)}" for _ in range(100)]
    body = lambda bad: " ".join([rnd.choice(plain) for _ in range(40)] + ([rnd.choice(("idiot", "blöd", "blödian")) for _ in range(3)] if bad else []))
    text = [(i, body(i % 7 == 0)) for i in range(900)]
    d, l = spark.createDataFrame(text, "doc_id bigint, text string"), spark.createDataFrame([(i, 1, int(i % 7 == 0)) for i, _ in text], "doc_id bigint, quality int, toxic int")
    out = toxicity.toxicity(d, l).join(l, "doc_id").where("held_out")
    assert out.count() > 200 and out.where("predicted <> toxic").count() <= 2
    odd = toxicity.toxicity(docs, l.where("false"))
    assert odd.count() == docs.count() and odd.where("predicted = 1 or score is null or score not between 0 and 1").isEmpty()


@pytest.mark.parametrize("op", ["lines", "quality", "secrets", "redact", "pieces", "pack", "substring", "near", "exact", "language", "toxicity"])
def test_empty_table(spark, empty, op):
    run = {
        "lines": lambda: lines.line_dedup(empty), "quality": lambda: quality.quality(empty), "secrets": lambda: secrets.secret_report(empty), "redact": lambda: secrets.redact(empty), "pieces": lambda: pieces.round_trip(empty, PIECE),
        "pack": lambda: packing.pack(empty, packing.Packing(BPE)), "substring": lambda: substring.substring_dedup(empty), "near": lambda: near_dedup.near_dedup(empty), "exact": lambda: exact_dedup.exact_dedup(empty),
        "language": lambda: language.identify(empty, language.learn(empty)), "toxicity": lambda: toxicity.toxicity(empty, spark.createDataFrame([], "doc_id bigint, toxic int")),
    }
    assert run[op]().collect() == []
