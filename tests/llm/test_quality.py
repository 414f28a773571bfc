import random
import re
from collections import Counter

from pyspark.sql import functions as F

from siltstone.llm import quality

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def fails(line):
    seen = re.sub(r"[\x20\x09-\x0D]", "", line)
    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in line)
    dense = lambda n, least, chars: n >= least and n * chars >= len(seen)
    return (
        not re.search(r"[.!?…:;؟۔।॥።။។։。！？．｡][\"'”’»)\]]*\Z", line.rstrip(" \t\n\x0b\x0c\r"))
        or dense(line.count("!!"), 3, 50)
        or dense(len(re.findall("[|•·]| [›»] ", line)), 3, 50)
        or dense(len(re.findall(r"https?://|www\.", low)), 1, 40)
        or dense(len(re.findall("|".join(quality.BOILERPLATE), low)), 1, 150)
        or sum(c in "#*$%&|<>" for c in line) * 100 > 10 * len(seen)
    )


def brute(text):
    text = text or ""
    w = WORD.findall(text)
    grams = [tuple(w[i : i + 3]) for i in range(len(w) - 2)]
    n = Counter(grams)
    repeated = {j for i, g in enumerate(grams) if n[g] > 1 for j in (i, i + 1, i + 2)}
    full = [x for x in text.split("\n") if WORD.search(x)]
    chars = sum(map(len, w))
    lost = sum(len(x) for line in full if fails(line) for x in WORD.findall(line))
    base = len(w) < 50 or 100 * len(repeated) > 50 * len(w)
    return (
        len(w), chars, sum(c in "#*$%&|<>" for c in text), len(full) - len(set(full)), len(repeated), base,
        not base and lost * 100 <= chars * 50,
    )


def texts():
    rng = random.Random(8)
    clean = lambda n: " ".join(rng.choices([f"w{i}" for i in range(300)], k=n)) + "."
    yield from (None, "", " \n\t ", "a", "a b", "a b c", "a b c a b c", "x " * 500, " é 漢🙂 " * 60)
    yield from (clean(60), clean(30) + "\n" + clean(30) + "\n" + clean(20)[:-1], "\n".join([clean(25)] * 3))
    yield from (clean(80) + "\nHome | About | News | Contact\nAll rights reserved.", "%%% ".join(["aa"] * 70) + ".")
    for _ in range(60):
        yield "".join(rng.choices(["aa ", "bb ", "cc ", "d", ". ", ".\n", "\n", "|", "%", "!! ", "\x0b", "\x85"], k=rng.randrange(1, 400)))
    for _ in range(60):
        parts = ["aa bb ", "longer words here ", "!!", " | ", " » ", "»", "·", "https://x.y ", "WWW.", "Terms of Use ", "powered by ", "#", ". ", ".\n", "؟\n", "।\n"]
        yield "".join(rng.choices(parts, weights=[9, 9] + [1] * 14, k=rng.randrange(20, 400)))
    yield clean(30000)
    yield "ab cd ef " * 20000


def test_against_brute_force(spark):
    rows = [(i, t, True) for i, t in enumerate(texts())]
    rows.append(rows[9])
    df = spark.createDataFrame(rows, "doc_id long, text string, kept boolean")
    got = sorted(quality.judge(df).select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept").collect())
    assert [tuple(r) for r in got] == sorted((i, *brute(t)) for i, t, _ in rows)
    assert quality.judge(df.limit(0)).collect() == []


def test_cleaning_keeps_columns_and_removes_lines(spark):
    text = "\n".join([" ".join(f"w{10 * i + j}" for j in range(10)) + "." for i in range(12)] + ["Home | About | News | Shop"])
    df = spark.createDataFrame([(1, text, "q", "r"), (2, "junk", "q", "r"), (3, None, "q", "r")], "doc_id long, text string, row string, w string")
    got = quality.clean_documents(df).collect()
    assert [(r.doc_id, r.text.count("Home"), r.row, r.w) for r in got] == [(1, 0, "q", "r")]


def test_no_python_and_no_shuffle(spark, sf_dir):
    df = spark.read.parquet(f"{sf_dir}/documents.parquet")
    plan = quality.judge(df)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Python" not in plan and "Arrow" not in plan
    labelled = df.join(spark.read.parquet(f"{sf_dir}/labels.parquet"), "doc_id")
    judged = quality.judge(df).join(labelled.select("doc_id", "quality"), "doc_id")
    shares = {r["quality"]: r["s"] for r in judged.where("n_words >= 50").groupBy("quality").agg(F.avg(F.col("kept").cast("int")).alias("s")).collect()}
    assert shares[1] > 0.97 and shares[0] < 0.5


def test_marks_count_by_the_length_of_the_line(spark):
    prose = " ".join(f"word{i}" for i in range(120))
    good = [f"{prose} terms of use {prose}.", f"«Oui», «non», «si» et «bien» {prose}.", f"{prose}!! {prose}!! {prose}!! ok.", "यह एक वाक्य है।", "هل هذا سؤال؟", "یہ ایک جملہ ہے۔", f"See https://a.b for {prose}."]
    bad = ["Terms of use.", "Home » News » Sport » More.", "A | B | C | D.", "BUY!! NOW!! OK!!", "https://a.b/c.", "no end"]
    df = spark.createDataFrame([(i, line) for i, line in enumerate(good + bad)], "doc_id long, text string")
    got = {r.doc_id: r.n_failed_lines for r in quality.judge(df).collect()}
    assert [got[i] for i in range(len(good + bad))] == [0] * len(good) + [1] * len(bad)
