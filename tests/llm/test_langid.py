import math
import zlib
from collections import Counter

import numpy as np

from siltstone.llm import langid


def plain_log(texts, text):
    """PPM by the book: dictionaries of contexts."""
    tree = {}
    for t in texts:
        b = langid.START + t.encode()
        for i in range(3, len(b)):
            for k in range(4):
                tree.setdefault(b[i - k : i], Counter())[b[i]] += 1
    total, b = 0.0, langid.START + text.encode()
    for i in range(3, len(b)):
        for k in (3, 2, 1, 0, -1):
            if k < 0:
                total += -math.log(256)
                break
            seen = tree.get(b[i - k : i])
            if seen is None:
                continue
            full = sum(seen.values()) + len(seen)
            if b[i] in seen:
                total += math.log(seen[b[i]] / full)
                break
            total += math.log(len(seen) / full)
    return total


TEXTS = {"aa": ["the cat sat on the mat", "then the hat"], "bb": ["der hund und die katze", "über den fluß"], "cc": ["el perro año"]}


def trees():
    languages, codes = sorted(TEXTS), {}
    for j, lang in enumerate(languages):
        for code, n in zip(*langid.grams(TEXTS[lang])):
            codes.setdefault(int(code), [0, 0, 0])[j] = n
    keys = np.array(sorted(codes))
    return langid.Trees(languages, keys, np.array([codes[k] for k in keys]))


def test_code_lengths_are_exact(monkeypatch):
    probes = ["the cat", "zzz", "über año the", "a", "漢字 the hund", "the mat " * 40]
    for window in (langid.WINDOW, 7):
        monkeypatch.setattr(langid, "WINDOW", window)
        got = trees().log_probabilities([p.encode() for p in probes])
        want = [[plain_log(TEXTS[lang], p) for lang in sorted(TEXTS)] for p in probes]
        assert np.allclose(got, want, rtol=1e-5)


def test_odd_rows(spark):
    rows = [(i, t, lang, "x") for lang, ts in TEXTS.items() for i, t in enumerate(ts * 9)]
    rows += [(100, None, "aa", ""), (101, "", "aa", ""), (102, "123 !?", None, ""), (None, "the cat", None, ""), (103, "über " * 30000, None, "")]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, score string")
    got = {(r.doc_id, r.lang_pred) for r in langid.identify_languages(df).collect()}
    assert {(100, "und"), (101, "und"), (102, "und"), (None, "aa"), (103, "bb")} <= got
    assert {r.held_out for r in langid.identify_languages(df).collect() if r.doc_id == 5} == {zlib.crc32(b"5") % 3 == 1}
    unlabelled = df.withColumn("lang", df.lang.substr(0, 0)).where("lang is null")
    assert {(r.lang_pred, r.score) for r in langid.identify_languages(unlabelled).collect()} == {("und", 0.0)}
    assert langid.identify_languages(df.limit(0)).collect() == []


def test_held_out_accuracy(spark, sf_dir):
    df = spark.read.parquet(f"{sf_dir}/documents.parquet")
    truth = {r.doc_id: r.lang for r in df.select("doc_id", "lang").collect()}
    rows = langid.identify_languages(df, train_documents=200).collect()
    unseen = [r for r in rows if r.held_out]
    assert len(rows) == len(truth) and all(0 <= r.score <= 1 for r in rows)
    assert sum(r.lang_pred == truth[r.doc_id] for r in unseen) >= 0.95 * len(unseen)


def exact_sample(rows, k, spread):
    """The k smallest distinct hashes of each language, by the hash that Spark gives each row."""
    out = {}
    for lang, h, text in rows:
        out.setdefault(lang, {})[h % spread] = text
    return {lang: sorted(found[h] for h in sorted(found)[:k]) for lang, found in out.items()}


def test_sampling_takes_the_smallest_hashes_exactly(spark):
    from pyspark.sql import functions as F

    rows = [(7, f"same id, text {i}", "en") for i in range(700)] + [(i, "one text", "en") for i in range(300)]
    rows += [(5, "copies", "de")] * 3000 + [(None, "no id", "de"), (6, "another", "de")] + [(i, f"el perro {i}", "es") for i in range(40)]
    rows += [(i, None, "fr") for i in range(9)] + [(i, "x", None) for i in range(9)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    hashed = df.where("text is not null and lang is not null").select("lang", F.xxhash64("lang", "doc_id", "text"), "text").collect()
    for k in (3, 50, 5000):
        languages, sample = langid._sample(df, k, 10)
        got = {}
        for r in sample.collect():
            got.setdefault(r.lang, []).append(r.text)
        assert languages == ["de", "en", "es"]
        assert {lang: sorted(t) for lang, t in got.items()} == exact_sample(hashed, k, langid.SPREAD), k
    assert langid._sample(df, 3, 1)[0] == ["de"]


def test_one_repeated_id_trains_and_predicts(spark):
    rows = [(1, f"the cat sat on mat {i}", "en") for i in range(2500)] + [(1, f"der hund und die katze {i}", "de") for i in range(2500)]
    rows += [(9, "the hat and the cat", None), (10, "die hunde der katzen", None)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    got = {r.doc_id: r.lang_pred for r in langid.identify_languages(df).where("doc_id > 8").collect()}
    assert got == {9: "en", 10: "de"}


def test_query_against_brute_force(spark):
    """Every row's prediction and score, by plain trees grown on all rows that aren't held out."""
    rows = [(i, t, lang) for lang, ts in TEXTS.items() for i, t in enumerate(ts * 5)]
    rows += [(50, "über the mat", None), (51, "perro und the", "aa"), (52, "", "bb"), (53, None, "cc"), (54, "99", "aa")]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    taught = {}
    for i, t, lang in set(rows):
        if t is not None and lang is not None and zlib.crc32(str(i).encode()) % 3 != 1:
            taught.setdefault(lang, []).append(t)
    want = []
    for i, t, _ in rows:
        held = zlib.crc32(str(i).encode()) % 3 == 1
        if not t or not any(map(str.isalpha, t)):
            want.append((i, held, "und", 0.0))
            continue
        logs = {lang: plain_log(ts, t) for lang, ts in sorted(taught.items())}
        best = max(sorted(logs), key=lambda lang: logs[lang])
        want.append((i, held, best, 1 / sum(math.exp(x - logs[best]) for x in logs.values())))
    got = sorted(map(tuple, langid.identify_languages(df).collect()))
    for a, b in zip(got, sorted(want), strict=True):
        assert a[:3] == b[:3] and abs(a[3] - b[3]) < 1e-4, (a, b)
