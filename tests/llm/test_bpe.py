import hashlib
import random

import public_tokenizers
import pytest
from tokenizers import Tokenizer

from metroflux.llm.bpe import BpeEncoder, decode, encode, encode_digest
from metroflux.llm.token_counts import count_tokens, frequent_pieces

PATH = public_tokenizers.path("word_bpe_49k.json")
ODD = ["", " ", "\n\t ", "Hello  World's 123", "a<|endoftext|>b<|startoftext|>", "<|ENDOFTEXT|>", "it's we'll 'tis ''s",
       "日本語 ñ😀 ﬁ İstanbul ΣΑΣ", "x\x00y\xa0z w\x1c\x85", "é é Å ǅ ǆ", "ab" * 3000 + "the" * 500, "½²³ ٣ 7"]


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


def ids_of(enc, text):
    out = []
    for piece, special in enc.parts(text):
        out += [special] if special is not None else [i for p in enc.pretokens(piece) for i in enc.encode_pretoken(p)]
    return out


def test_ids_equal_the_library(library):
    enc, rng = BpeEncoder(PATH), random.Random(3)
    alphabet = "abcdefgHIJ  \n'sStTreVEml.,!?0123éñß²½ \x1c\x85\xa0_-ΣσİÿŸ日"
    texts = ODD + ["".join(rng.choice(alphabet) for _ in range(rng.randint(0, 60))) for _ in range(3000)]
    for text in texts:
        want = library.encode(text, add_special_tokens=False).ids
        assert ids_of(enc, text) == want
        assert enc.decode(want) == library.decode(want, skip_special_tokens=False)


def test_every_plane_of_characters(library):
    enc = BpeEncoder(PATH)
    for c in list(range(0x600)) + list(range(0x600, 0x110000, 97)):
        if not 0xD800 <= c < 0xE000:
            text = f"a{chr(c)}b {chr(c)}1"
            assert ids_of(enc, text) == library.encode(text, add_special_tokens=False).ids, hex(c)


def test_cuts_are_certain():
    enc = BpeEncoder(PATH)
    symbols = "thxqzjjkqqing"
    fragments = enc.cut(symbols)
    assert "".join(fragments) == symbols and len(fragments) > 1
    whole = [enc.vocab[s] for s in enc._merge_short([*symbols[:-1], symbols[-1] + enc.suffix])]
    assert list(enc.encode_pretoken(symbols)) == whole


def test_short_and_long_merging_agree():
    enc, rng = BpeEncoder(PATH), random.Random(5)
    for _ in range(300):
        symbols = [rng.choice("thenaioring") for _ in range(rng.randint(2, 120))]
        assert enc._merge_short(list(symbols)) == enc._merge_long(list(symbols))


def test_memo_stays_within_its_bytes():
    from metroflux.llm.bpe import Memo
    made = []
    memo = Memo(lambda k: made.append(k) or k.encode(), 10_000)
    for i in range(500):
        assert memo[f"key{i % 60}"] == f"key{i % 60}".encode()
        assert len(memo) * Memo.ENTRY <= 10_000
    assert memo["x" * 300] and "x" * 300 not in memo and len(made) > 60


def test_memo_keeps_what_is_asked_for_often():
    from metroflux.llm.bpe import Memo
    made = []
    memo = Memo(lambda k: made.append(k) or k.encode(), 20_000)
    for i in range(2000):
        assert memo["often"] == b"often" and memo[f"once{i}"] == f"once{i}".encode()
        assert len(memo) * Memo.ENTRY <= 20_000
    assert made.count("often") == 1


def test_frames(spark, frame, library):
    rows = [(i, t) for i, t in enumerate(ODD)] + [(None, "no id"), (99, None), (3, ODD[3]), (3, "other text")]
    df = frame(rows)
    out = decode(encode(df, PATH), PATH).collect()
    assert len(out) == len(rows) and "row" in df.columns
    for r in out:
        e = library.encode(r.text or "", add_special_tokens=False).ids
        assert r.ids == e and r.decoded == library.decode(e, skip_special_tokens=False)
    digest = {(r.doc_id, r.n_tokens): r for r in encode_digest(df, PATH).collect()}
    e = library.encode(ODD[3], add_special_tokens=False).ids
    assert digest[3, len(e)].ids_sha256 == hashlib.sha256(" ".join(map(str, e)).encode()).hexdigest()
    assert digest[99, 0].ids_sha256 == digest[99, 0].decoded_sha256 == hashlib.sha256(b"").hexdigest()
    assert encode_digest(df.limit(0), PATH).count() == 0
    some = spark.createDataFrame([(1, [320]), (2, None), (3, [])], "doc_id long, ids array<int>").coalesce(1)
    assert [r.decoded for r in decode(some, PATH).orderBy("doc_id").collect()] == ["a</w>", None, ""]


@pytest.mark.parametrize("frequent", [0, 5, 200_000])
def test_token_counts(spark, frame, library, frequent):
    rows = [(i, t) for i, t in enumerate(ODD)] + [(None, "no id"), (99, None), (3, ODD[3]), (3, ODD[3])]
    got = sorted(((r.doc_id, r.n_bytes, r.n_tokens, r.over_limit) for r in count_tokens(frame(rows), PATH, frequent=frequent, limit=5).collect()), key=str)
    want = []
    for i, t in rows:
        n = len(library.encode(t or "", add_special_tokens=False).ids)
        want.append((i, len((t or "").encode()), n, n > 5))
    assert got == sorted(want, key=str)
    assert count_tokens(frame([]), PATH, frequent=frequent).count() == 0


def test_frequent_pieces_stay_within_their_bound(spark):
    freqs = [1] * 500 + [2] * 100 + [3] * 40 + [50, 51, 52, 900, 10**6, 10**12]
    rows = [(f"p{i}", n, 1) for i, n in enumerate(freqs)] + [("x" * 65, 10**9, 9)]
    pieces = spark.createDataFrame(rows, "pretoken string, freq long, pieces long")
    of = dict((p, n) for p, n, _ in rows)
    for bound, least in ((10_000, 1), (146, 2), (145, 3), (46, 3), (45, 50), (6, 50), (1, 10**12), (0, None)):
        got = {r.pretoken for r in frequent_pieces(pieces, bound, 64).collect()}
        assert len(got) <= bound
        assert got == {p for p, n in of.items() if least and n >= least and len(p) <= 64}, bound
    assert frequent_pieces(pieces.limit(0), 5, 64).count() == 0
