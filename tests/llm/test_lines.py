import random
from collections import Counter

import pytest

from siltstone.llm import lines

SPACE = " \t\n\x0b\x0c\r"


def brute(rows):
    pages, seen = Counter(), Counter()
    for host, text in {(host, text) for _, text, host in rows if text is not None}:  # exact copies are one page
        pages[host] += 1
        for key in {x.strip(SPACE) for x in text.split("\n")} - {""}:
            seen[host, key] += 1
    out = []
    for i, text, host in rows:
        if text is None:
            out.append((i, None, host, 0, 0))
            continue
        keep, dropped = [], 0
        for x in text.split("\n"):
            key = x.strip(SPACE)
            bad = key and seen[host, key] >= lines.LEAST_PAGES and seen[host, key] > pages[host] * lines.MAX_RATIO
            dropped += bool(bad)
            keep += [] if bad else [x]
        out.append((i, "\n".join(keep), host, sum(bool(x.strip(SPACE)) for x in text.split("\n")), dropped))
    return sorted(out, key=lambda r: (r[0], str(r)))


@pytest.mark.parametrize("most", [10**6, 0])
def test_against_brute_force(spark, most):
    rng = random.Random(1)
    rows = []
    for i in range(400):
        host = rng.choice(["big"] * 6 + ["a", "b", None, ""])
        own = [f"line {rng.randrange(10**6)}" for _ in range(rng.randrange(0, 6))]
        common = [f" menu {k}\t" for k in range(8) if rng.random() < k / 20]
        text = own + common + rng.choice([[], [""], ["  "], common])
        rng.shuffle(text)
        rows.append((i, rng.choice(["\n".join(text)] * 20 + [None]), host))
    rows += [rows[5], (900, "same\n" * 5000, "one"), (901, "same\nsame", "one"), (902, "x", "two")]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    got = lines.drop_boilerplate(df, broadcast_lines=most).collect()
    assert sorted(map(tuple, got), key=lambda r: (r[0], str(r))) == brute(rows)
    assert any(r["__n_dropped"] for r in got)


def test_empty_and_extra_columns(spark):
    df = spark.createDataFrame([(1, "a", "h", "z")], "doc_id long, text string, source string, lines string")
    assert [tuple(r) for r in lines.drop_boilerplate(df).collect()] == [(1, "a", "h", "z", 1, 0)]
    assert lines.drop_boilerplate(df.limit(0)).collect() == []


def test_clashing_names_and_a_second_run(spark):
    names = ["doc_id", "text", "source", "__host", "__lines", "__salt", "__kept", "row", "host", "lines", "k", "bad", "kept", "t", "salt", "__n_lines"]
    rows = [(str(i), f"menu\nown line {i}", "h", *[f"mine {n}" for n in names[3:]]) for i in range(8)]
    df = spark.createDataFrame(rows, names)
    for most in (10**6, 0):
        once = lines.drop_boilerplate(df, broadcast_lines=most)
        twice = lines.drop_boilerplate(once, broadcast_lines=most)
        for got, n in ((once, 1), (twice, 0)):
            assert sorted(got.columns) == sorted([*names, "__n_dropped"])
            for r in got.collect():
                assert r.text == f"own line {r.doc_id}" and r["__n_dropped"] == n
                assert all(r[c] == f"mine {c}" for c in names[3:-1])


def test_copies_are_not_boilerplate(spark):
    rows = [(i, "one text\ncopied often", "h") for i in range(50)] + [(100 + i, f"text {i}", "h") for i in range(9)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    assert lines.drop_boilerplate(df).where("__n_dropped > 0").count() == 0


def test_a_hot_host_and_a_hot_line(spark):
    rows = [(i, f"hot line\nown {i}", "big") for i in range(3000)] + [(5000 + i, f"hot line\nother {i}", f"h{i % 40}") for i in range(120)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    got = lines.drop_boilerplate(df, broadcast_lines=0, salts=8)
    assert got.where("__n_dropped = 1").count() == 3000 and got.count() == 3120
