import base64
import hashlib
import random

import public_tokenizers as P
import pytest
import tiktoken

from siltstone.llm import encode
from siltstone.llm.bpe import Codec, codec

PATH = P.path("byte_bpe_multi_50k.tiktoken")


@pytest.fixture(scope="module")
def reference():
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(PATH, "rb"))}
    return tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})


def texts():
    rng = random.Random(3)
    alphabet = "abcdeéßñ 漢字🙂\n\t'1234567890.,#́‍"
    yield from ("", " ", "a", "I'll don't 're", "\r\n\r\n  x", "<|endoftext|>", "\x00\x7f")
    yield from ("".join(rng.choices(alphabet, k=rng.randrange(1, 200))) for _ in range(300))
    yield from ("a" * 5000, "ab" * 4000, "".join(rng.choices("abc", k=20000)), "é漢" * 3000, "1" * 4001, "=" * 3000)


def test_same_ids_as_the_library(reference):
    own = codec(PATH, P.PATTERN)
    for text in texts():
        ids = own.encode(text)
        assert ids == reference.encode_ordinary(text), text[:50]
        assert own.decode(ids) == text.encode()


def test_piece_against_plain_merging():
    """Random ranks over two letters give long chains of merges, stale entries and equal ranks."""
    rng = random.Random(5)
    for _ in range(200):
        known = [b"a", b"b"]
        for _ in range(rng.randrange(1, 40)):
            known.append(rng.choice(known) + rng.choice(known))
        known = list(dict.fromkeys(known))
        ranks = dict(zip(known, [0, 1, *rng.sample(range(2, 3000), len(known) - 2)]))
        own = Codec(ranks, ".+")
        data = bytes(rng.choices(b"ab", k=rng.randrange(1, 120)))
        parts = [data[i : i + 1] for i in range(len(data))]
        while data not in ranks:
            pairs = [(ranks[x + y], i) for i, (x, y) in enumerate(zip(parts, parts[1:])) if x + y in ranks]
            if not pairs:
                break
            i = min(pairs)[1]
            parts[i : i + 2] = [parts[i] + parts[i + 1]]
        assert own.encode_piece(data) == ([ranks[data]] if data in ranks else [ranks[x] for x in parts])
        assert not any(own.words)


def test_operator(spark, reference):
    rows = [(1, None, "a"), (2, "", "b"), (3, "Hello world", "c"), (3, "Hello world", "c"), (4, "x" * 30000, "d")]
    df = spark.createDataFrame(rows, "doc_id long, text string, ids string")
    got = sorted(map(tuple, encode.round_trip_digests(df, PATH, P.PATTERN, "doc_id", "text").collect()))
    want = []
    for i, text, _ in rows:
        ids = reference.encode_ordinary(text or "")
        want.append((i, len(ids), hashlib.sha256(encode.little_endian_ids(ids)).hexdigest(), hashlib.sha256((text or "").encode()).hexdigest()))
    assert got == sorted(want)
    encoded = encode.encode_documents(df, PATH, P.PATTERN, "doc_id", "text")
    decoded = dict(map(tuple, encode.decode_documents(encoded, PATH, P.PATTERN).collect()))
    assert decoded[4] == b"x" * 30000 and decoded[1] == b""
    assert encode.round_trip_digests(df.limit(0), PATH, P.PATTERN, "doc_id", "text").collect() == []
