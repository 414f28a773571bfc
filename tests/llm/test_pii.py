import hashlib
import math
import random
import re

import regex

from siltstone.llm import pii

PLAIN = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def luhn(digits):
    return sum(d if i % 2 == 0 else (2 * d - 9 if d > 4 else 2 * d) for i, d in enumerate(map(int, reversed(digits)))) % 10 == 0


def base(text):
    out = []
    for kind, pattern in PLAIN.items():
        for m in re.finditer(pattern, text or ""):
            digits = re.sub("[^0-9]", "", m[0])
            ok = {
                "email": True, "ip": all(int(p) <= 255 for p in m[0].split(".")) if kind == "ip" else None,
                "card": 16 <= len(digits) <= 19 and luhn(digits), "phone": 8 <= len(digits) <= 15,
            }[kind]
            if ok:
                out.append((kind, m.start(), m.end()))
    return out


def number(rng, n):
    head = "".join(rng.choices("0123456789", k=n - 1))
    return next(head + c for c in "0123456789" if luhn(head + c))


def texts():
    rng = random.Random(4)
    yield from (None, "", "a@b", "a@b.c_d@e.f", "x@y@z.w", "1.2.3.4.5.6.7.8", "0001.002.255.000 256.1.1.1", "漢🙂a@b.cd é")
    yield from ("4111 1111-1111 1111", "+1 (555) 555-0100.", "+12345678", "++1234567 8", "+1 2", "a" * 50000, "1" * 50000, "1 " * 30000, "a." * 20000 + "@b.c")
    yield from ("a@" + "b." * 20000 + "c", "+" * 1000 + "1" * 20)
    for _ in range(400):
        yield "".join(rng.choices(["a", "B", "@", ".", "-", "+", "%", " ", "1", "2", "9", "(", ")", "é", "🙂", "_", "\n", "255", "0", number(rng, 16)], k=rng.randrange(1, 60)))


def test_base_spans(spark):
    rows = [(i, t, "s") for i, t in enumerate(texts())]
    rows.append(rows[8])
    df = spark.createDataFrame(rows, "doc_id long, text string, spans string")
    got = sorted(pii.digests(pii.find_personal_data(df)).collect())
    for r, (i, t, _) in zip(got, sorted(rows, key=lambda r: r[0])):
        want = base(t)
        joined = ",".join(f"{k}:{s}:{e}" for k, s, e in want)
        assert r.doc_id == i and r.base_sha256 == hashlib.sha256(joined.encode()).hexdigest(), (t or "")[:80]
        assert [r.n_email, r.n_ip, r.n_card, r.n_phone] == [sum(k == x for x, _, _ in want) for k in pii.KINDS]
        assert set(filter(None, joined.split(","))) <= set(r.spans.split(","))
    assert pii.digests(pii.find_personal_data(df.limit(0))).collect() == []


def test_contexts_find_unseen_identifiers(spark):
    rows = [(i, f"Please write my address: user{i}@mail.example.com today.") for i in range(8)]
    rows += [(20, "You know my address: q77731-alpha-9 well. Also see ref q77731-alpha-9 here.")]
    rows += [(30 + i, f"the item number x{i}12345 is sold") for i in range(9)] + [(50, "call my phone now: +1 (555) 555-0100")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: r.spans for r in pii.digests(pii.find_personal_data(df)).collect()}
    start = rows[8][1].index("q777")
    assert got[20] == f"email:{start}:{start + 14}"
    assert got[30] == "" and got[50].startswith("phone:") and got[0].startswith("email:")
    texts_ = {r.doc_id: r.text for r in pii.redact(df).collect()}
    assert texts_[20].startswith("You know my address: [EMAIL] well.") and texts_[0] == "Please write my address: [EMAIL] today."
    assert texts_[50] == "call my phone now: [PHONE]"


def test_second_round_builds_on_the_first(spark):
    rows = [(i, f"kindly use contact: user{i}@mail.example.com now") for i in range(6)]
    rows += [(10 + i, f"kindly use contact: handle-{i}{i}{i}{i} now") for i in range(2)]
    rows += [(20 + i, f"or by alias handle-{i}{i}{i}{i} too, or by alias user{i}@mail.example.com") for i in range(2)]
    rows += [(30, "or by alias secret-5150 only")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    found = pii.scan(df, df.text, df.doc_id)
    one, two = (pii.bootstrap(found, rounds) for rounds in (1, 3))
    assert {r.v for r in one[1].collect()} == {"handle-0000", "handle-1111"}
    assert {r.v for r in two[1].collect()} == {"handle-0000", "handle-1111", "secret-5150"}


def test_rounds_run_until_none_finds_more(spark):
    links = ["kindly use contact:", "or by alias", "reach them under", "also known as", "filed here as", "last seen with"]
    rows = [(i, f"kindly use contact: user{i}@mail.example.com now") for i in range(9)]
    for k in range(5):
        rows += [(100 * (k + 1) + i, f"{links[k]} step{k}-{i}{i}{i}{i} ok") for i in range(3)]
        rows += [(100 * (k + 1) + 10 + i, f"{links[k + 1]} step{k}-{i}{i}{i}{i} ok") for i in range(3)]
        rows += [(100 * (k + 1) + 20 + i, f"{links[k + 1]} user{50 + 10 * k + i}@mail.example.com ok") for i in range(5)]
    rows.append((900, f"{links[5]} secret-5150 ok"))
    df = spark.createDataFrame(rows, "doc_id long, text string")
    spans = {r.doc_id: r.spans for r in pii.digests(pii.find_personal_data(df)).collect()}
    for k in range(5):
        at = len(links[k]) + 1
        assert spans[100 * (k + 1)] == f"email:{at}:{at + 10}", k
    at = len(links[5]) + 1
    assert spans[900] == f"email:{at}:{at + 11}"
    found = pii.scan(df, df.text, df.doc_id)
    assert "secret-5150" not in {r.v for r in pii.bootstrap(found, 3)[1].collect()}


def test_redaction(spark):
    rows = [(1, None), (2, ""), (3, "🙂 a@b.cd, 10.0.0.1 x"), (4, "mail +12345678@x.org"), (5, "none")]
    df = spark.createDataFrame([(i, t, "k") for i, t in rows], "doc_id long, text string, th string")
    got = sorted(map(tuple, pii.redact(df).collect()))
    assert got == [(1, None, "k"), (2, "", "k"), (3, "🙂 [EMAIL], [IP] x", "k"), (4, "mail [EMAIL]", "k"), (5, "none", "k")]


def test_no_python(spark, sf_dir):
    df = spark.read.parquet(f"{sf_dir}/documents.parquet")
    plan = pii.scan(df, df.text, df.doc_id)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Exchange" not in plan


def brute_bootstrap(texts):
    """(spans added, by text) of the method as its docstring states it, with sets and loops."""
    token = regex.compile(pii.TOKEN)
    secret = regex.compile(pii.SECRET)

    def seed(v):
        for kind in pii.KINDS:
            m = re.search(PLAIN[kind], v)
            if m and any(k == kind and (s, e) == m.span() for k, s, e in base(v)):
                return kind
        return "secret" if secret.match(v) else None

    def patterns(c, i):
        l2, l1, v, r1 = c[i - 2].lower() if i > 1 else "", c[i - 1].lower() if i else "", c[i], c[i + 1].lower() if i + 1 < len(c) else ""
        if l2:
            yield ("2", l2, l1)
        if l1 and r1:
            yield ("r", l1, r1)
        if l1 and re.search("[0-9@]", v):
            yield ("s", l1, regex.sub(r"\p{L}", "a", re.sub("[0-9]", "9", v)))

    cut = {t: [(m.group(), m.start(), m.end()) for m in token.finditer(t)] for t in texts}
    graph = {}
    for found in cut.values():
        c = [v for v, _, _ in found]
        for i, v in enumerate(c):
            for p in patterns(c, i):
                graph.setdefault(p, set()).add(v)
    learned, good = {}, {}
    while True:
        kind = lambda v: learned.get(v) or seed(v)
        counts = {p: [sum(kind(v) == k for v in vs) for k in pii.ALL_KINDS] for p, vs in graph.items()}
        good = {}
        for p, n in counts.items():
            best = max(range(len(n)), key=lambda k: (n[k], -k))
            tight = p[0] == "2"
            score = n[best] / (len(graph[p]) + (0 if tight else pii.LOOSE_MORE))
            if n[best] >= (pii.LEAST_SUPPORT if tight else pii.LOOSE_SUPPORT) and score >= pii.LEAST_SCORE:
                good[p] = (pii.ALL_KINDS[best], score)
        led = {}
        for p, (k, score) in good.items():
            for v in graph[p]:
                if kind(v) is None:
                    led.setdefault(v, {}).setdefault(k, []).append(score)
        new = {}
        for v, by_kind in led.items():
            scores = {k: 1 - math.prod(max(1 - x, 1e-9) for x in xs) for k, xs in by_kind.items()}
            k = max(scores, key=lambda k: (scores[k], -pii.ALL_KINDS.index(k)))
            if scores[k] >= pii.LEAST_SCORE - 1e-9:
                new[v] = k
        if not new:
            break
        learned |= new
    out = {}
    for t, found in cut.items():
        c, own = [v for v, _, _ in found], base(t)
        spans = set()
        for i, (v, s, e) in enumerate(found):
            for p in patterns(c, i):
                k = good.get(p, (None,))[0]
                if k and (learned.get(v) == k or (k == "secret" and secret.match(v))) and not any(a < e and b > s for _, a, b in own):
                    spans.add((k, s, e))
        out[t] = sorted(spans)
    return out


def test_bootstrap_against_brute_force(spark):
    rng = random.Random(11)
    hexes = lambda n: "".join(rng.choices("0123456789abcdef", k=n - 2)) + "a1"
    words = ["the", "of", "über", "Mail", "at", "call", "x9", "(see)", "12", "a-b", "note:", "id"]
    things = [lambda: f"user{rng.randrange(40)}@mail{rng.randrange(3)}.com", lambda: f"10.0.{rng.randrange(200)}.7", lambda: f"+1 (555) 555-{rng.randrange(1000, 1040)}", lambda: f'token = "{hexes(40)}"', lambda: number(rng, 16)]
    unseen = [lambda: f"jane{rng.randrange(9)}@localhost", lambda: f"555 123 {rng.randrange(1000, 1009)}", lambda: f"2001:db8::{rng.randrange(9)}", lambda: f'token = "{hexes(12)}"', lambda: f"h{rng.randrange(9)} (at) site"]
    leads = ["write me:", "reach us under", "my address is", "host", "pay by"]
    texts_ = ["", "a", "+1 2"]
    for _ in range(260):
        parts = rng.choices(words, k=rng.randrange(2, 9))
        for _ in range(rng.randrange(0, 4)):
            k = rng.randrange(5)
            parts.append(f"{leads[k]} {(things if rng.random() < 0.85 else unseen)[k]()}" if rng.random() < 0.8 else rng.choice(unseen)())
            parts += rng.choices(words, k=2)
        texts_.append(" ".join(parts))
    texts_ += [f'of token = "{hexes(40)}" x9' for _ in range(30)]
    want = brute_bootstrap(set(texts_))
    df = spark.createDataFrame(list(enumerate(texts_)), "doc_id long, text string")
    found = pii.find_personal_data(df).collect()
    got = {texts_[r.doc_id]: sorted((x.kind, x.start, x.end) for x in r.added) for r in found}
    assert got == want
    assert sum(map(len, want.values())) > 30 and {k for xs in want.values() for k, _, _ in xs} >= {"email", "secret"}


def test_unseen_forms_are_found_by_context(spark):
    rows = [(i, f"please write to me under user{i}@mail.example.com soon") for i in range(20)]
    rows += [(30 + i, f"you can phone me at +1 (555) 555-01{i:02d} today") for i in range(20)]
    rows += [(60 + i, f'api_key = "{i:02d}{"0a1b2c3d4e5f" * 3}" # keep') for i in range(8)]
    unseen = {100: ("email", "jane@localhost"), 101: ("email", "jane.doe(at)example.com"), 102: ("phone", "555 123 4567"), 103: ("phone", "(017) 555-7713"), 104: ("secret", "9f8e7d6c5b4a")}
    around = {"email": "please write to me under %s soon", "phone": "you can phone me at %s today", "secret": 'api_key = "%s" # keep'}
    rows += [(i, around[k] % v) for i, (k, v) in unseen.items()]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: r for r in pii.digests(pii.find_personal_data(df)).collect()}
    for i, (kind, v) in unseen.items():
        at = (around[kind] % v).index(v)
        assert got[i].spans == f"{kind}:{at}:{at + len(v)}" and got[i].n_added == 1 == got[i].n_spans, (v, got[i].spans)
    assert got[60].spans.startswith("secret:11:") and got[60].n_email == 0
    assert "[SECRET]" in {r.doc_id: r.text for r in pii.redact(df).collect()}[104]


def test_a_common_word_in_a_rare_pattern_makes_no_rows(spark):
    rows = [(i, f"zork the user{i}@mail.example.com now") for i in range(4)] + [(10 + i, "see the cat and the dog by the sea " * 50) for i in range(20)]
    found = pii.scan(*(lambda df: (df, df.text, df.doc_id))(spark.createDataFrame(rows, "doc_id long, text string")))
    patterns = spark.createDataFrame([("2 zork the", "the")], "p string, l1 string")
    df = pii._followers(found, patterns)
    assert sorted(r.v for r in df.collect()) == [f"user{i}@mail.example.com" for i in range(4)]

    def joined(node):
        under = [node.executedPlan()] if node.nodeName() == "AdaptiveSparkPlan" else [node.plan()] if "QueryStage" in node.nodeName() else []
        children = node.children()
        under += [children.apply(i) for i in range(children.size())]
        own = [node.metrics().apply("numOutputRows").value()] if "Join" in node.nodeName() else []
        return own + [n for x in under for n in joined(x)]

    assert (made := joined(df._jdf.queryExecution().executedPlan())) and max(made) == 4, made


def test_more_words_and_patterns_than_are_looked_up_at_once(spark, monkeypatch):
    rows = [(i, f"zork the user{i}@mail.example.com now, and the 12 cats") for i in range(4)]
    found = pii.scan(*(lambda df: (df, df.text, df.doc_id))(spark.createDataFrame(rows, "doc_id long, text string")))
    patterns = spark.createDataFrame([("2 zork the", "the"), ("s the 99", "the"), ("r now ,", "now")], "p string, l1 string")
    want = sorted(map(tuple, pii._followers(found, patterns).collect()))
    assert len(want) == 8
    for name in ("FEW_WORDS", "MANY_WORDS", "BROADCAST_HASHES", "BROADCAST_ROWS"):
        monkeypatch.setattr(pii, name, 0)
        assert sorted(map(tuple, pii._followers(found, patterns).collect())) == want, name


def test_tokens_in_no_pattern_looked_for_never_become_rows(spark):
    rows = [(i, f"zork the user{i}@mail.example.com now") for i in range(4)] + [(10 + i, "see the cat and the dog by the sea " * 50) for i in range(20)]
    found = pii.scan(*(lambda df: (df, df.text, df.doc_id))(spark.createDataFrame(rows, "doc_id long, text string")))
    df = pii._followers(found, spark.createDataFrame([("2 zork the", "the")], "p string, l1 string"))
    assert sorted(r.v for r in df.collect()) == [f"user{i}@mail.example.com" for i in range(4)]

    def generated(node):
        under = [node.executedPlan()] if node.nodeName() == "AdaptiveSparkPlan" else [node.plan()] if "QueryStage" in node.nodeName() else []
        children = node.children()
        under += [children.apply(i) for i in range(children.size())]
        own = [node.metrics().apply("numOutputRows").value()] if node.nodeName() == "Generate" else []
        return own + [n for x in under for n in generated(x)]

    # patterns, and below them all tokens
    assert generated(df._jdf.queryExecution().executedPlan()) == [4, 9016]


def test_no_pattern_is_lost_where_bits_are_few(spark, monkeypatch):
    rows = [(i, f"a{i} b{i} c{i} d{i}") for i in range(3000)]
    found = pii.scan(*(lambda df: (df, df.text, df.doc_id))(spark.createDataFrame(rows, "doc_id long, text string")))
    patterns = spark.createDataFrame([(f"2 a{i} b{i}", f"b{i}") for i in range(0, 3000, 2)], "p string, l1 string")
    want = {f"c{i}" for i in range(0, 3000, 2)}
    assert {r.v for r in pii._followers(found, patterns).collect()} == want
    monkeypatch.setattr(pii, "BITS", 0)
    assert {r.v for r in pii._followers(found, patterns).collect()} == want
    assert pii._followers(found, patterns.limit(0)).collect() == []


def test_common_patterns_are_ruled_out_on_the_smallest_part(spark, monkeypatch):
    rows = [(i, f"of the user{i}@mail.example.com and zork by user{i}@mail.example.com end") for i in range(40)]
    rows += [(100 + i, f"zork by handle-{i} end") for i in range(4)] + [(200 + i, f"part of the word{i} here") for i in range(300)]
    found = pii.scan(*(lambda df: (df, df.text, df.doc_id))(spark.createDataFrame(rows, "doc_id long, text string")))
    calls, followers = [], pii._followers
    monkeypatch.setattr(pii, "PARTS", (4, 2))
    monkeypatch.setattr(pii, "_followers", lambda texts, patterns: calls.append({r.p for r in patterns.collect()}) or followers(texts, patterns))
    learned = {r.v for r in pii.bootstrap(found)[1].collect()}
    assert learned == {f"handle-{i}" for i in range(4)}
    assert "2 of the" in calls[0] and "2 zork by" in calls[0]
    assert not any("2 of the" in x for x in calls[1:]) and all(any("2 zork by" in x for x in calls[k:k + 1]) for k in (1, 2))
