import base64
import hashlib
import random

import public_tokenizers
import pytest
import tiktoken

from metroflux.llm.byte_bpe import ByteBpe, decode, encode, encode_digest

PATH, PATTERN = public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN
ODD = ["", " ", "\n\t ", "Hello  World's 123", "a<|endoftext|>b", "it's we'll 'tis ''s '' 's1 x's", "日本語 ñ😀 ﬁ İstanbul",
       "x\x00y\xa0z w\x1c\x85　 q", "½²³ ٣ 7a8B!c'd", "a \n b\r\n\r\n c   ", "ab" * 40_000, "the quick brown fox's 12 " * 9_000]


@pytest.fixture(scope="module")
def library():
    with open(PATH, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding("reference", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})


@pytest.mark.parametrize("part, run", [(1, 2), (3, 4), (7, 3), (1 << 15, 1 << 12)])
def test_parts_encode_as_the_whole(library, part, run):
    bpe, rng = ByteBpe(PATH, PATTERN, part, run), random.Random(part)
    alphabet = "abST'sretvmld  \n\t 019!?.-_`\xa0　éß日😀\x1c\x85 ½"
    texts = ODD[:-2] + ["".join(rng.choice(alphabet) for _ in range(rng.randint(0, 60))) for _ in range(4000)]
    for text in texts + ([] if part < 100 else ODD[-2:]):
        want = library.encode_ordinary(text)
        assert bpe.encode(text) == want, text[:80]
        assert bpe.decode(want) == text.encode()
        spans = list(bpe.parts(text))
        assert "".join(text[a:b] for a, b, _ in spans) == text


def test_every_neighbour_of_a_cut(library):
    bpe = ByteBpe(PATH, PATTERN, 1, 2)
    marks = [chr(c) for c in range(128)] + list("\x85\xa0\u1680\u2000\u200a\u200b\u2028\u2029\u202f\u205f\u3000\u180e\ufeffé日٣½ßǅ😀")
    for a in marks:
        for b in marks:
            for text in (f"x{a}{b}s 1", f"'{a}{b}  {a}", f"{a} {b}{a}{b}"):
                assert bpe.encode(text) == library.encode_ordinary(text), repr(text)


def test_runs_of_white_space_beyond_the_engine(library):
    bpe = ByteBpe(PATH, PATTERN)
    for tail, last in (("x", " x"), ("\nx", "\nx"), ("", "")):
        text = "a" + " " * 1_000_000 + tail
        ids = bpe.encode(text)
        assert bpe.decode(ids) == text.encode()
        short = "a" + " " * 3000 + tail  # every blank but the last is a token of its own here, as in the library
        want = library.encode_ordinary(short)
        assert ids[:2000] == want[:2000] and ids[-3:] == want[-3:] and len(ids) - len(want) == 997_000


def test_frames(spark, frame, library):
    rows = [(i, t) for i, t in enumerate(ODD)] + [(None, "no id"), (99, None), (3, ODD[3]), (3, "other text")]
    df = frame(rows)
    out = decode(encode(df, PATH, PATTERN, name="tokens"), PATH, PATTERN, ids="tokens").collect()
    assert len(out) == len(rows) and all(r.ids == "x" for r in out)
    for r in out:
        assert r.tokens == library.encode_ordinary(r.text or "") and bytes(r.decoded) == (r.text or "").encode()
    got = sorted((tuple(r) for r in encode_digest(df, PATH, PATTERN).collect()), key=str)
    sha = lambda b: hashlib.sha256(b).hexdigest()
    want = []
    for i, t in rows:
        ids = library.encode_ordinary(t or "")
        want.append((i, len(ids), sha(" ".join(map(str, ids)).encode()), sha((t or "").encode())))
    assert got == sorted(want, key=str)
    assert encode_digest(df.limit(0), PATH, PATTERN).count() == 0 == encode(df.limit(0), PATH, PATTERN).count()
    half = spark.createDataFrame([(1, library.encode_ordinary("日")[:1]), (2, None), (3, [])], "doc_id long, ids array<int>").coalesce(1)
    assert [r.decoded for r in decode(half, PATH, PATTERN).orderBy("doc_id").collect()][1:] == [None, b""]
