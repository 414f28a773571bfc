"""run() against a plain version put together from the brute-force versions of the operators' own tests."""

import random
import zlib

import public_tokenizers as P

import corpus_pipeline
from siltstone.llm import packing
from siltstone.llm.tokens import Reader
from tests.llm import test_lines, test_minhash, test_pii, test_quality


def plain(rows):
    docs = []
    for i, text, source in rows:
        if test_quality.brute(text)[-1]:
            kept = [x for x in text.split("\n") if not (test_quality.WORD.search(x) and test_quality.fails(x))]
            docs.append((i, "\n".join(kept), source))
    docs = [(i, text, source) for i, text, source, _, _ in test_lines.brute(docs)]
    keep = {i for i, _, _, kept in test_minhash.brute([(i, t) for i, t, _ in docs], 5) if kept}
    docs = [(i, t) for i, t, _ in docs if i in keep]
    reader, out = Reader(P.path("byte_bpe_50k.json"), None), []
    for i, text in docs:
        spans = sorted((s, -e, kind) for kind, s, e in test_pii.base(text))
        new, at = "", 0
        for s, e, kind in spans:
            new += text[at:s] + f"[{kind.upper()}]" if s >= at else ""
            at = max(at, -e)
        whole = packing.stream(reader.ids(new + text[at:]), 2)
        out += [(i, k, s, n, zlib.crc32(whole[s : s + n])) for k, (s, n) in enumerate(packing.cuts(len(whole), 1024))]
    return sorted(out)


def fixture():
    rng = random.Random(12)
    line = lambda: " ".join(f"w{rng.randrange(10**4)}" for _ in range(12)) + "."
    rows = []
    for i in range(120):
        body = [line() for _ in range(rng.randrange(5, 12))]
        if i % 3 == 0:
            body.append("Menu shown on many pages.")
        if i % 5 == 0:
            body.append("Home | News | About | Shop")
        if i % 7 == 0:
            body[1] = f"mail me{i}@example.com or +1 (555) 555-0{i:03d} from 10.0.0.{i}."
        rows.append((i, "\n".join(body), f"src{i % 2}"))
    rows += [(200 + i, rows[i][1].replace("w1", "w1 ", 1), "src0") for i in range(10)] + [(300, rows[4][1], "src1")]
    rows += [(400, None, "src0"), (401, "", "src0"), (402, "too short", None), (403, "word word word " * 50, "src1"), (404, line() * 900, None)]
    return rows


def test_against_plain_version(spark, tmp_path):
    rows = fixture()
    df = spark.createDataFrame([(i, t, "en", s, len(t or "")) for i, t, s in rows], "doc_id long, text string, lang string, source string, n_chars long")
    df.write.parquet(str(tmp_path / "documents.parquet"))
    got = corpus_pipeline.run(spark, str(tmp_path)).collect()
    assert sorted((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in got) == plain(rows)


def test_stages_keep_columns_and_survive_odd_tables(spark):
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    text = fixture()[0][1]
    odd = [(1, None, None, None, None), (None, text, "en", "s", 1), (None, text, "en", "s", 1), (2, text, None, "s", 1), (2, text, None, "s", 1)]
    for rows in ([], odd):
        docs = spark.createDataFrame(rows, schema)
        for name, stage in corpus_pipeline.STAGES[:-1]:
            docs = stage(spark, docs, "")
            assert docs.columns == ["doc_id", "text", "lang", "source", "n_chars"], name
        assert sorted(str(r.doc_id) for r in docs.collect()) == (["2"] if rows else [])


def test_rows_of_one_id_are_judged_by_their_texts(spark):
    words = lambda a, n: " ".join(f"v{a}x{k}" for k in range(n))
    near = words(1, 80)
    rows = [(7, words(2, 80), "p"), (7, words(3, 80), "q"), (7, words(3, 80), "q"), (9, near, "p"), (9, near + " more", "q"), (8, near, "r"), (5, words(4, 80), "s")]
    rows += [(7, None, "p"), (7, "", "p"), (None, near + " also", "t"), (None, words(6, 80), "u"), (None, words(6, 80) + " x", "u")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    got = corpus_pipeline.near_duplicates(spark, docs, "").collect()
    want = [(5, rows[6][1]), (7, ""), (7, ""), (7, rows[0][1]), (7, rows[1][1]), (8, near)]
    assert sorted((r.doc_id, r.text or "") for r in got if r.doc_id is not None) == sorted(want)
    # a copy of an id's text goes, and of copies without id one stays
    assert [r.text[:8] for r in got if r.doc_id is None] == [words(6, 80)[:8]]
